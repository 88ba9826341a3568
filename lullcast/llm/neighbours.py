"""Approximate nearest neighbours: a vantage-point tree per shard.

Largest inner product becomes smallest distance by one more component that gives all
vectors of a shard the same norm. Subtrees are skipped by the triangle inequality, whose
bound is multiplied by ``factor``: with factor 1 no neighbour is lost, with more, fewer
subtrees are visited. Blocks of queries walk a tree together.
"""

from __future__ import annotations

from dataclasses import dataclass, field

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from lullcast.workspace import materialize

FACTOR = 4.0
#: Vectors of a shard and queries of a block; both are held by one task.
SHARD_ROWS = 8192
BLOCK_ROWS = 2048
LEAF = 64


@dataclass
class Node:
    """Points ``begin`` to ``end`` of the tree's order. An inner node knows its vantage
    point and, for both children, the least and largest distance to it."""

    begin: int
    end: int
    vantage: int = -1
    ranges: list[tuple[float, float]] = field(default_factory=list)
    children: list[Node] = field(default_factory=list)


class Tree:
    def __init__(self, vectors: np.ndarray, leaf: int = LEAF, seed: int = 7):
        self.vectors = np.asarray(vectors, np.float64)
        squares = np.einsum("ij,ij->i", self.vectors, self.vectors)
        self.most = float(squares.max())
        self.extra = np.sqrt((self.most - squares).clip(0))
        self.order = np.arange(len(self.vectors))
        self.random = np.random.default_rng(seed)
        self.leaf = leaf
        self.root = self._build(0, len(self.order))

    def _build(self, begin: int, end: int) -> Node:
        node = Node(begin, end)
        if end - begin <= self.leaf:
            return node
        own = self.order[begin:end]
        node.vantage = int(own[self.random.integers(len(own))])
        apart = self._apart(own, node.vantage)
        sort = np.argsort(apart, kind="stable")
        self.order[begin:end], apart = own[sort], apart[sort]
        middle = len(own) // 2
        node.ranges = [(apart[0], apart[middle - 1]), (apart[middle], apart[-1])]
        node.children = [self._build(begin, begin + middle), self._build(begin + middle, end)]
        return node

    def _apart(self, points: np.ndarray, vantage: int) -> np.ndarray:
        d = self.vectors[points] - self.vectors[vantage]
        e = self.extra[points] - self.extra[vantage]
        return np.sqrt(np.einsum("ij,ij->i", d, d) + e * e)

    def search(self, queries: np.ndarray, k: int, factor: float = FACTOR) -> np.ndarray:
        """The ``k`` nearest found for each query, as positions (-1: no more)."""
        walk = _Walk(self, np.asarray(queries, np.float64), k, factor)
        walk.home(self.root, np.arange(len(queries)))
        walk.visit(self.root, np.arange(len(queries)))
        return walk.found


class _Walk:
    def __init__(self, tree: Tree, queries: np.ndarray, k: int, factor: float):
        self.tree, self.queries, self.factor = tree, queries, factor
        self.squares = np.einsum("ij,ij->i", queries, queries) + tree.most
        self.near = np.full((len(queries), k), np.inf)
        self.found = np.full((len(queries), k), -1)
        self.homes = np.full(len(queries), -1)

    def distances(self, active: np.ndarray, points: np.ndarray) -> np.ndarray:
        products = self.queries[active] @ self.tree.vectors[points].T
        return np.sqrt((self.squares[active][:, None] - 2 * products).clip(0))

    def home(self, node: Node, active: np.ndarray) -> None:
        """Begin with the leaf on whose side of every vantage point a query lies."""
        if not len(active):
            return
        if not node.children:
            self.homes[active] = node.begin
            self._take(node, active)
            return
        to = self.distances(active, np.array([node.vantage]))[:, 0]
        outside = to > (node.ranges[0][1] + node.ranges[1][0]) / 2
        self.home(node.children[0], active[~outside])
        self.home(node.children[1], active[outside])

    def visit(self, node: Node, active: np.ndarray) -> None:
        if not node.children:
            self._take(node, active[self.homes[active] != node.begin])
            return
        to = self.distances(active, np.array([node.vantage]))[:, 0]
        for child, (low, high) in zip(node.children, node.ranges):
            # rounding must not hide a point at the very bound
            bound = np.maximum(to - high, low - to) - 1e-7
            open_ = bound * self.factor <= self.near[active, -1]
            if open_.any():
                self.visit(child, active[open_])

    def _take(self, node: Node, active: np.ndarray) -> None:
        if not len(active):
            return
        points = self.tree.order[node.begin : node.end]
        near = np.concatenate((self.near[active], self.distances(active, points)), axis=1)
        found = np.concatenate(
            (self.found[active], np.broadcast_to(points, (len(active), len(points)))), axis=1
        )
        best = np.argsort(near, axis=1, kind="stable")[:, : self.near.shape[1]]
        self.near[active] = np.take_along_axis(near, best, 1)
        self.found[active] = np.take_along_axis(found, best, 1)


def usable(vector: Column) -> Column:
    """Not null or empty, all components finite, not all zero."""
    finite = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return vector.isNotNull() & finite & F.exists(vector, lambda x: x != 0)


def nearest(
    vectors: DataFrame,
    is_query: Column,
    k: int = 20,
    vec_id: str = "vec_id",
    vector: str = "embedding",
    factor: float = FACTOR,
    shard_rows: int = SHARD_ROWS,
    block_rows: int = BLOCK_ROWS,
) -> DataFrame:
    """query_id, rank, vec_id, score: for every row with ``is_query``, the ``k`` other rows
    with the largest inner product that were found (fewer only if there are fewer), ties to
    the smaller vec_id.

    Vectors that are null, empty or zero, or hold null or non-finite components take no
    part, nor do rows without an id; vectors of another length than the query's are no
    candidates for it. Equal vectors are indexed once with their ``k + 1`` smallest ids, as
    no other can be in a result. A row is left out of its own result by id. An empty table
    gives no rows; other columns are ignored.
    """
    rows = vectors.select(
        F.col(f"`{vec_id}`").alias("vec_id"), F.col(f"`{vector}`").alias("v"), is_query.alias("_query")
    ).where(usable(F.col("v")) & F.col("vec_id").isNotNull())
    id_type = rows.schema["vec_id"].dataType.simpleString()

    same = Window.partitionBy("v").orderBy("vec_id")
    first = rows.select("vec_id", "v").distinct().withColumn("_k", F.row_number().over(same))
    distinct = first.where(F.col("_k") <= k + 1).groupBy("v").agg(F.sort_array(F.collect_list("vec_id")).alias("ids"))
    distinct = materialize(distinct.withColumn("dim", F.size("v")), "distinct-vectors")
    asked = materialize(rows.where("_query").select("vec_id", "v").distinct(), "queries")
    shards = -(-distinct.count() // shard_rows) or 1
    blocks = -(-asked.count() // block_rows) or 1

    indexed = distinct.withColumn("shard", F.pmod(F.xxhash64("v"), F.lit(shards)).cast("int"))
    each_block = F.sequence(F.lit(0), F.lit(blocks - 1))
    trees = indexed.select("dim", "shard", "v", "ids").groupBy("dim", "shard").agg(
        F.collect_list(F.struct("v", "ids")).alias("points")  # shard_rows, on average
    )
    trees = trees.withColumn("block", F.explode(each_block))
    queries = asked.select(
        F.col("vec_id").alias("query_id"),
        "v",
        F.size("v").alias("dim"),
        F.pmod(F.xxhash64("vec_id"), F.lit(blocks)).cast("int").alias("block"),
        F.explode(F.sequence(F.lit(0), F.lit(shards - 1))).alias("shard"),
    )

    def search(index: pd.DataFrame, block: pd.DataFrame) -> pd.DataFrame:
        if not len(index) or not len(block):
            return pd.DataFrame({c: [] for c in ("query_id", "vec_id", "score")})
        points = index["points"].iloc[0]
        tree = Tree(np.array([p["v"] for p in points], np.float64))
        wanted = np.array(block["v"].tolist(), np.float64)
        out = []
        for own, q, found in zip(block["query_id"], wanted, tree.search(wanted, k + 1, factor)):
            found = found[found >= 0]
            scores = (tree.vectors[found] * q).sum(axis=1)
            some = [(-s, i) for s, at in zip(scores, found) for i in points[at]["ids"] if i != own]
            out += [(own, i, -s) for s, i in sorted(some)[:k]]
        return pd.DataFrame(out, columns=["query_id", "vec_id", "score"])

    key = ["dim", "shard", "block"]
    found = (
        trees.groupBy(*key)
        .cogroup(queries.groupBy(*key))
        .applyInPandas(search, f"query_id {id_type}, vec_id {id_type}, score double")
    )
    best = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    ranked = found.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k)
    return ranked.select("query_id", "rank", "vec_id", "score")
