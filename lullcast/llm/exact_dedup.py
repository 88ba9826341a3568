"""Exact deduplication by content-defined chunk recipes.

A text is cut where a rolling hash of its bytes says so, hence equal passages give equal
chunks wherever they stand. Chunks are reduced to distinct ones, and their 128-bit
identifiers are verified: no identifier may stand for two contents, else all are made anew
with another seed. A document is then the ordered list of its identifiers; documents are
equal when these lists are, and no long text moves after the chunks were reduced.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lullcast.llm.common import attach_groups, text_or_empty
from lullcast.workspace import materialize

WINDOW = 16
LEAST, MOST = 256, 8192
#: One place in so many (a power of two) is a cut.
MEAN_BITS = 10
SEEDS = 8
_BASE = np.uint64(0x9E3779B97F4A7C15)
_INVERSE = np.uint64(pow(0x9E3779B97F4A7C15, -1, 1 << 64))
_STEP = 1 << 20


def cuts(data: bytes) -> list[int]:
    """Ends of the chunks of ``data``, the last one included; none for no data."""
    n = len(data)
    if n <= LEAST:
        return [n] if n else []
    ends, last = [], 0
    for place in _candidates(data):
        while place - last > MOST:
            last += MOST
            ends.append(last)
        if place - last >= LEAST:
            ends.append(place)
            last = place
    while n - last > MOST:
        last += MOST
        ends.append(last)
    return ends + [n] if last < n else ends


def _candidates(data: bytes) -> Iterator[int]:
    """Places after which the hash of the last WINDOW bytes has its upper bits zero."""
    codes = np.frombuffer(data, np.uint8)
    for begin in range(0, max(len(data) - WINDOW, 0), _STEP):
        part = codes[begin : begin + _STEP + WINDOW].astype(np.uint64) + np.uint64(1)
        n = len(part)
        powers = _powers(n)
        sums = np.cumsum(part * powers[0][:n])
        sums[WINDOW:] -= sums[:-WINDOW].copy()
        hashes = sums[WINDOW - 1 :] * powers[1][: n - WINDOW + 1]
        # the product spreads the window's value over the upper bits
        hashes = (hashes ^ (hashes >> np.uint64(29))) * _BASE
        found = np.flatnonzero(hashes >> np.uint64(64 - MEAN_BITS) == 0)
        yield from (found[found < _STEP] + (begin + WINDOW)).tolist()


_POWERS: list[np.ndarray] = []


def _powers(n: int) -> list[np.ndarray]:
    if not _POWERS:
        size = _STEP + WINDOW
        for base in (_BASE, _INVERSE):
            factors = np.full(size, base, np.uint64)
            factors[0] = 1
            _POWERS.append(np.cumprod(factors))
    return _POWERS


def chunks(text: str | None) -> list[bytes]:
    data = (text or "").encode("utf-8", "surrogatepass")
    ends = cuts(data)
    return [data[a:b] for a, b in zip([0, *ends], ends)]


def identifier(chunk: bytes, seed: int, size: int) -> bytes:
    return xxhash.xxh3_128_digest(chunk, seed)[:size]


def chunk_table(documents: DataFrame, text: str, seed: int, size: int = 16) -> DataFrame:
    """The distinct pairs of identifier and chunk: the dictionary of all texts."""

    def explode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found: dict[bytes, bytes] = {}
            held = 0
            for value in batch.column(0):
                for chunk in chunks(value.as_py()):
                    key = identifier(chunk, seed, size)
                    if found.setdefault(key, chunk) != chunk:
                        yield _dictionary({key: chunk})
                    held += len(chunk)
                if held > 4 << 20:
                    yield _dictionary(found)
                    found, held = {}, 0
            yield _dictionary(found)

    made = documents.select(text_or_empty(text).alias("text"))
    return made.mapInArrow(explode, "id binary, chunk binary").distinct()


def _dictionary(found: dict[bytes, bytes]) -> pa.RecordBatch:
    columns = [pa.array(list(x), pa.binary()) for x in (found.keys(), found.values())]
    return pa.RecordBatch.from_arrays(columns, ["id", "chunk"])


def verified_seed(documents: DataFrame, text: str, size: int = 16) -> int:
    """The first seed under which no identifier stands for two different chunks."""
    for seed in range(SEEDS):
        pairs = chunk_table(documents, text, seed, size).groupBy("id").count()
        if pairs.where("count > 1").isEmpty():
            return seed
    raise ValueError(f"{8 * size}-bit identifiers clash under each of {SEEDS} seeds")


def recipes(documents: DataFrame, text: str, seed: int, size: int = 16) -> DataFrame:
    """``documents`` without the text, with ``recipe``: its chunks' identifiers in order."""
    kept = [c for c in documents.columns if c != text]
    schema = documents.select(*(F.col(f"`{c}`") for c in kept)).schema.add("recipe", "binary")

    def spell(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            made = [
                b"".join(identifier(c, seed, size) for c in chunks(v.as_py()))
                for v in batch.column(batch.num_columns - 1)
            ]
            columns = [*batch.columns[:-1], pa.array(made, pa.binary())]
            yield pa.RecordBatch.from_arrays(columns, [*batch.schema.names[:-1], "recipe"])

    ordered = documents.select(*(F.col(f"`{c}`") for c in kept), text_or_empty(text).alias("_text"))
    return ordered.mapInArrow(spell, schema)


def exact_groups(
    documents: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    digest: Column | None = None,
    size: int = 16,
    with_recipe: bool = False,
) -> DataFrame:
    """One row per row of ``documents``: doc_id, ``keep_id``, ``group_size``, ``kept`` and,
    if asked for, ``digest``, an expression over the columns of ``documents``, and the
    ``recipe``, which is equal for equal texts.

    Null texts count as empty; empty texts are one group. Of a group the largest doc_id
    stays (null ids are smallest). Rows that repeat both id and text are all kept or all
    dropped; ``group_size`` counts rows. Texts of any length are cut into chunks whole. An
    empty table gives no rows; other columns are ignored.
    """
    given = [F.col(f"`{doc_id}`").alias("doc_id"), F.col(f"`{text}`").alias("text")]
    rows = documents.select(*given, *([] if digest is None else [digest.alias("digest")]))
    seed = verified_seed(rows, "text", size)
    spelled = materialize(recipes(rows, "text", seed, size), "recipes")
    groups = spelled.groupBy("recipe").agg(
        F.max("doc_id").alias("keep_id"), F.count("*").alias("group_size")
    )
    groups = materialize(groups, "recipe-groups")
    out = attach_groups(spelled, groups, "recipe", "group_size", "doc_id")
    kept = F.col("doc_id").eqNullSafe(F.col("keep_id")).alias("kept")
    more = (["digest"] if digest is not None else []) + (["recipe"] if with_recipe else [])
    return out.select("doc_id", "keep_id", "group_size", kept, *more)
