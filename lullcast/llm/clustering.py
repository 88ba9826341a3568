"""Centroid clustering with lower bounds that loosen less than the centroids drift.

Every vector keeps its cluster, an upper bound of the distance to that centroid and a lower
bound of the distance to all others. A cluster's vectors lie in a sphere around its centroid.
When another centroid moves from p to q, the distance of no vector x in that sphere falls by
more than the largest |x-p| - |x-q| in the sphere, which is found in the plane through the
three centroids: points where it is 2a lie on a hyperbola, inside the cone of its asymptotes
at the middle of p and q, whose half angle has the cosine 2a / |p-q|. So it is below |p-q|
times the cosine of the smallest angle at which the sphere is seen from that middle. Vectors
whose bounds don't decide are compared with all centroids in whole numbers.
"""

from __future__ import annotations

import hashlib
import pickle
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DoubleType, StructType

from lullcast.workspace import materialize, new_path

CLUSTERS = 8
ROUNDS = 10
SCALE = 1024
SEED = "3"
#: Vectors of a block, which is one row of the written table, and blocks of a bucket.
BLOCK_ROWS = 2048
BUCKET_BLOCKS = 256
MOST_BUCKETS = 10_000
#: Beyond this, squared distances may leave 64 bits: such blocks are reckoned in Python's integers.
LARGE = 1 << 26
#: Room for rounding in bounds, relative and absolute.
ROUNDING = 1e-9

BLOCK = "block bigint, ids binary, numbers binary, rows int"
STATE = "block bigint, cluster binary, upper binary, lower binary, moves binary"


def whole_numbers(values: np.ndarray, scale: int = SCALE) -> np.ndarray:
    """floor(scale * value), exact: 64-bit integers or, where too large, Python's."""
    scaled = np.floor(values.astype(np.float64) * scale)
    if not scaled.size or np.abs(scaled).max() < LARGE:
        return scaled.astype(np.int64)
    return np.array([[int(v) for v in row] for row in scaled], object)


def squared(vectors: np.ndarray, centroids: np.ndarray) -> np.ndarray:
    """Exact squared distances, one column for each centroid."""
    if vectors.dtype == object or centroids.dtype == object or np.abs(centroids).max() >= LARGE:
        vectors, centroids = vectors.astype(object), centroids.astype(object)
    return np.stack([((vectors - c) ** 2).sum(axis=1) for c in centroids], axis=1)


def _root(squares: np.ndarray) -> np.ndarray:
    return np.sqrt(squares.astype(np.float64))


def loosening(centres: np.ndarray, moved: np.ndarray, radii: np.ndarray) -> np.ndarray:
    """``[i, j]``: by how much at most the distance of a vector of cluster i, at most
    ``radii[i]`` away from its centroid, to centroid j falls when that moves. At most the
    centroid's drift."""
    centres, moved = centres.astype(np.float64), moved.astype(np.float64)
    k = len(centres)
    out = np.zeros((k, k))
    for j in range(k):
        path = moved[j] - centres[j]
        drift = np.linalg.norm(path)
        if drift == 0:
            continue
        middle = (centres[j] + moved[j]) / 2
        for i in range(k):
            seen = centres[i] - middle
            apart = np.linalg.norm(seen)
            if apart <= radii[i]:
                out[i, j] = drift
                continue
            along = np.clip(seen @ path / (apart * drift), -1, 1)
            nearest = np.arccos(along) - np.arcsin(radii[i] / apart)
            out[i, j] = drift * np.cos(min(max(nearest, 0.0), np.pi / 2))
    return out


def assigned(vectors: np.ndarray, centroids: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Exact: the nearest centroid (ties: smaller number), its distance and that of the next."""
    apart = squared(vectors, centroids)
    own = np.argmin(apart, axis=1).astype(np.int32)
    near = apart[np.arange(len(own)), own]
    if len(centroids) == 1:
        return own, _root(near), np.full(len(own), np.inf)
    others = apart.copy()
    others[np.arange(len(own)), own] = others.max() + 1
    return own, _root(near), _root(others.min(axis=1))


def reassigned(
    vectors: np.ndarray, own: np.ndarray, upper: np.ndarray, lower: np.ndarray,
    centroids: np.ndarray, drift: np.ndarray, loosened: np.ndarray,
) -> tuple[np.ndarray, np.ndarray, np.ndarray, int]:
    """Clusters and bounds after the centroids moved, and how many vectors were compared
    with all of them. ``loosened[i, j]`` as from ``loosening``."""
    others = np.where(np.eye(len(centroids), dtype=bool), 0, loosened).max(axis=1)
    upper, lower, own = upper + drift[own], lower - others[own], own.copy()
    open_ = np.flatnonzero(upper * (1 + ROUNDING) + ROUNDING >= lower)
    for c in np.unique(own[open_]):  # first the own distance anew
        some = open_[own[open_] == c]
        upper[some] = _root(squared(vectors[some], centroids[c : c + 1])[:, 0])
    open_ = open_[upper[open_] * (1 + ROUNDING) + ROUNDING >= lower[open_]]
    if len(open_):
        own[open_], upper[open_], lower[open_] = assigned(vectors[open_], centroids)
    return own, upper, lower, len(open_)


def usable(vectors: DataFrame, vector: str, size: int) -> DataFrame:
    """``vec_id`` and ``v`` of vectors of ``size`` finite components."""
    finite = F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    rows = vectors.select(
        F.col("vec_id").cast("string").alias("vec_id"),
        F.col(f"`{vector}`").cast(ArrayType(DoubleType())).alias("v"),
    )
    return rows.where(F.col("v").isNotNull() & (F.size("v") == size)).where(finite)


def blocks(rows: DataFrame, size: int) -> DataFrame:
    """The vectors in blocks, written by bucket, so that no round shuffles them."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        number = TaskContext.get().partitionId() << 33
        for batch in batches:
            for begin in range(0, batch.num_rows, BLOCK_ROWS):
                part = batch.slice(begin, BLOCK_ROWS)
                numbers = part.column(1).flatten().to_numpy().astype("<f8")
                with pa.BufferOutputStream() as sink:
                    with pa.ipc.new_stream(sink, schema) as out:
                        out.write_batch(pa.RecordBatch.from_arrays([part.column(0)], schema=schema))
                    ids = sink.getvalue().to_pybytes()
                row = [[number], [ids], [numbers.tobytes()], [part.num_rows]]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, t) for c, t in zip(row, kinds)], ["block", "ids", "numbers", "rows"]
                )
                number += 1

    schema = pa.schema([("vec_id", pa.string())])
    kinds = [pa.int64(), pa.binary(), pa.binary(), pa.int32()]
    made = materialize(rows.mapInArrow(cut, BLOCK), "blocks")
    return made


def _bucketed(df: DataFrame, label: str, buckets: int) -> DataFrame:
    path = new_path(df.sparkSession, label)
    name = "lullcast_" + path.rsplit("/", 1)[-1].replace("-", "_")
    df.repartition(buckets, "block").write.bucketBy(buckets, "block").option("path", path).saveAsTable(
        name, format="parquet"
    )
    return df.sparkSession.table(name)


class Clustering:
    """Blocks of vectors, the state of each, and the centroids. Only per-cluster sums come
    to the driver."""

    def __init__(self, spark: SparkSession, rows: DataFrame, size: int, scale: int):
        self.spark, self.size, self.scale = spark, size, scale
        self.read = _reader(size, scale)
        cut = blocks(rows, size)
        n = cut.count()
        self.buckets = min(max(1, -(-n // BUCKET_BLOCKS), min(n, spark.sparkContext.defaultParallelism)), MOST_BUCKETS)
        self.blocks = _bucketed(cut, "vectors", self.buckets)
        self.counts, self.sums, self.scanned = None, None, []

    def start(self, centroids: np.ndarray) -> None:
        read, k = self.read, len(centroids)

        def first(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for block, numbers in zip(batch.column(0), batch.column(1)):
                    vectors = read(numbers.as_py())
                    own, upper, lower = assigned(vectors, centroids)
                    yield _state(block, own, upper, lower, _moves(vectors, None, own, k, upper, len(own)))

        self.centroids = centroids
        self._keep(self.blocks.select("block", "numbers").mapInArrow(first, STATE))

    def step(self) -> None:
        """Replace every non-empty centroid by the floored mean, then assign again."""
        k, old = len(self.centroids), self.centroids
        made = [
            [s // n for s in sums] if n else list(c)
            for n, sums, c in zip(self.counts, self.sums, old.tolist())
        ]
        new = np.array(made, object)
        if np.abs(new).max() < LARGE:
            new = new.astype(np.int64)
        loosened = loosening(old, new, np.array(self.radii)) * (1 + ROUNDING) + ROUNDING
        drift = np.linalg.norm((new - old).astype(np.float64), axis=1) * (1 + ROUNDING)
        read = self.read

        def again(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for block, numbers, *state in zip(*(batch.column(c) for c in range(5))):
                    own, upper, lower = (np.frombuffer(s.as_py(), t) for s, t in zip(state, ("<i4", "<f8", "<f8")))
                    vectors = read(numbers.as_py())
                    now, upper, lower, scanned = reassigned(vectors, own, upper, lower, new, drift, loosened)
                    yield _state(block, now, upper, lower, _moves(vectors, own, now, k, upper, scanned))

        self.centroids = new
        # the narrow side is kept in memory, bucket by bucket
        state = self.state.select("block", "cluster", "upper", "lower").hint("shuffle_hash")
        joined = self.blocks.select("block", "numbers").join(state, "block")
        self._keep(joined.select("block", "numbers", "cluster", "upper", "lower").mapInArrow(again, STATE))

    def _keep(self, state: DataFrame) -> None:
        self.state = _bucketed(state, "state", self.buckets)
        # one row per cluster from each task, then these in one task
        k = len(self.centroids)
        found = self.state.select("moves").mapInArrow(_added(k, self.size), "sums binary")
        total = found.repartition(1).mapInArrow(_added(k, self.size), "sums binary").first()
        counts, sums, radii, scanned = pickle.loads(total.sums)
        if self.counts is not None:
            counts = [a + b for a, b in zip(counts, self.counts)]
            sums = [[a + b for a, b in zip(*s)] for s in zip(sums, self.sums)]
        self.counts, self.sums, self.radii = counts, sums, radii
        self.scanned.append(scanned)


def _reader(size: int, scale: int):
    return lambda numbers: whole_numbers(np.frombuffer(numbers, "<f8").reshape(-1, size), scale)


def _moves(vectors, before, now, k: int, upper, scanned: int) -> bytes:
    """What a block adds to each cluster: rows and component sums (those that left it taken
    off), the largest upper bound of its rows, and how many rows were scanned; pickled, as
    sums are integers of any length."""
    counts, radii = [0] * k, [0.0] * k
    sums = [[0] * vectors.shape[1] for _ in range(k)]
    moved = np.arange(len(now)) if before is None else np.flatnonzero(before != now)
    for c in range(k):
        for sign, of in ((1, now), (-1, before)):
            some = moved[of[moved] == c] if of is not None else []
            if len(some):
                counts[c] += sign * len(some)
                sums[c] = [a + sign * int(b) for a, b in zip(sums[c], vectors[some].sum(axis=0))]
        radii[c] = float(upper[now == c].max(initial=0.0))
    return pickle.dumps((counts, sums, radii, scanned))


def _state(block, own, upper, lower, moves: bytes) -> pa.RecordBatch:
    values = [block.as_py(), own.astype("<i4").tobytes(), upper.astype("<f8").tobytes(),
              lower.astype("<f8").tobytes(), moves]
    kinds = [pa.int64(), *[pa.binary()] * 4]
    return pa.RecordBatch.from_arrays(
        [pa.array([v], t) for v, t in zip(values, kinds)], ["block", "cluster", "upper", "lower", "moves"]
    )


def _added(k: int, size: int):
    """Add up what blocks, or other tasks, give (see ``_moves``)."""

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts, sums, radii, scanned = [0] * k, [[0] * size for _ in range(k)], [0.0] * k, 0
        for batch in batches:
            for moves in batch.column(0):
                some, own, far, more = pickle.loads(moves.as_py())
                counts = [a + b for a, b in zip(counts, some)]
                sums = [[a + b for a, b in zip(*s)] if n or any(s[1]) else s[0] for n, *s in zip(some, sums, own)]
                radii, scanned = [max(r) for r in zip(radii, far)], scanned + more
        made = pa.array([pickle.dumps((counts, sums, radii, scanned))], pa.binary())
        yield pa.RecordBatch.from_arrays([made], ["sums"])

    return add


def first_centroids(rows: DataFrame, k: int, seed: str, scale: int) -> np.ndarray:
    """The vectors whose id has the smallest hash; of equal ids the smaller vector."""
    order = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce("vec_id", F.lit(""))), 256)
    chosen = rows.withColumn("_order", order).orderBy("_order", "v").limit(k).collect()
    return whole_numbers(np.array([r.v for r in chosen], np.float64), scale)


def digest(centroid: np.ndarray) -> str:
    return hashlib.sha256(",".join(str(int(c)) for c in centroid).encode()).hexdigest()


def centroid_clusters(
    vectors: DataFrame,
    k: int = CLUSTERS,
    rounds: int = ROUNDS,
    vec_id: str = "vec_id",
    vector: str = "embedding",
    size: int = 64,
    scale: int = SCALE,
    seed: str = SEED,
) -> DataFrame:
    """vec_id, ``cluster``, ``distance`` (squared), ``cluster_inertia``, ``inertia`` and
    ``centroid_sha256`` for every vector of ``size`` finite components, after ``rounds`` means.

    Equal to assigning every vector by its exact distance in every round. Other vectors, and
    null ones, take no part. Rows that repeat are all kept; null ids are ids, drawn as empty
    text. With fewer than ``k`` vectors each is a centroid. Sums that 64 bits can't hold are
    null. An empty table gives no rows; other columns are ignored.
    """
    spark = vectors.sparkSession
    id_type = vectors.select(F.col(f"`{vec_id}`").alias("vec_id")).schema["vec_id"].dataType
    rows = usable(vectors.select(F.col(f"`{vec_id}`").alias("vec_id"), F.col(f"`{vector}`")), vector, size)
    start = first_centroids(rows, k, seed, scale)
    result = StructType().add("vec_id", id_type).add("cluster", "integer").add("distance", "long")
    result = result.add("cluster_inertia", "long").add("inertia", "long").add("centroid_sha256", "string")
    if not len(start):
        return spark.createDataFrame([], result)
    found = Clustering(spark, rows, size, scale)
    found.start(start)
    for _ in range(rounds):
        found.step()
    return result_rows(found, id_type.simpleString())


def _sum_or_null(numbers: Column) -> Column:
    """Null as soon as one number is, unlike SQL's sum."""
    return F.when(F.count(numbers) == F.count("*"), F.try_sum(numbers))


def result_rows(found: Clustering, id_type: str) -> DataFrame:
    read, centroids = found.read, found.centroids

    def spell(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for ids, numbers, own in zip(*(batch.column(c) for c in range(3))):
                vectors, own = read(numbers.as_py()), np.frombuffer(own.as_py(), "<i4")
                apart = np.empty(len(own), object)
                for c in np.unique(own):
                    apart[own == c] = squared(vectors[own == c], centroids[c : c + 1])[:, 0]
                names = pa.ipc.open_stream(ids.as_py()).read_all().column(0).combine_chunks()
                texts = pa.array([str(a) for a in apart], pa.string())
                yield pa.RecordBatch.from_arrays([names, pa.array(own, pa.int32()), texts], ["vec_id", "cluster", "apart"])

    state = found.state.select("block", "cluster").hint("shuffle_hash")
    joined = found.blocks.select("block", "ids", "numbers").join(state, "block")
    rows = joined.select("ids", "numbers", "cluster").mapInArrow(spell, "vec_id string, cluster int, apart string")
    rows = materialize(rows.select(F.expr(f"CAST(vec_id AS {id_type})").alias("vec_id"), "cluster", "apart"), "distances")
    whole = F.expr("try_cast(apart AS decimal(38,0))")
    own = rows.groupBy("cluster").agg(_sum_or_null(whole).alias("_own"))
    total = own.agg(_sum_or_null(F.col("_own"))).first()[0]
    digests = [(c, digest(v)) for c, v in enumerate(centroids)]
    facts = own.join(F.broadcast(found.spark.createDataFrame(digests, "cluster int, centroid_sha256 string")), "cluster")
    facts = facts.withColumn("_all", F.lit(None if total is None else str(total)))
    return rows.join(F.broadcast(facts), "cluster").select(
        "vec_id", "cluster",
        F.expr("try_cast(apart AS bigint)").alias("distance"),
        F.expr("try_cast(_own AS bigint)").alias("cluster_inertia"),
        F.expr("try_cast(_all AS bigint)").alias("inertia"),
        "centroid_sha256",
    )
