"""SimHash near-duplicates through pigeonhole blocks.

A fingerprint of 64 bits is split into blocks; of two fingerprints that differ in at most
``distance`` bits, enough blocks are equal that they share one combination of them.
Fingerprints are joined on these combinations and verified. Equal fingerprints are
collapsed first. A combination shared by more than ``BUCKET`` fingerprints is not expanded
to pairs: its members meet through the halfway points between them instead, which finds
exactly the same links.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lullcast.llm.common import attach_groups, text_or_empty
from lullcast.llm.components import components
from lullcast.workspace import materialize

SEED = 42
SHINGLE = 3
DISTANCE = 2
BLOCKS = 4
BUCKET = 32


def fingerprint(text: str, width: int = SHINGLE, seed: int = SEED) -> int:
    """The 64-bit SimHash over the word shingles of ``text``, as a signed number."""
    words = text.encode("utf-8", "surrogatepass").lower().split()
    if not words:
        return 0
    joined = b" ".join(words)
    ends = np.cumsum([len(w) + 1 for w in words]).tolist()
    starts = [0, *ends]
    digest = xxhash.xxh64_intdigest
    width = min(width, len(words))
    spans = zip(starts, ends[width - 1 :])
    hashes = np.array([digest(joined[a : b - 1], seed) for a, b in spans], "<u8")
    ones = np.zeros(64, np.int64)
    for begin in range(0, len(hashes), 1 << 16):
        part = hashes[begin : begin + (1 << 16)]
        bits = np.unpackbits(part.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        ones += bits.sum(0, dtype=np.int64)
    chosen = np.packbits(ones * 2 > len(hashes), bitorder="little")
    return int(chosen.view("<i8")[0])


def fingerprints(
    documents: DataFrame, doc_id: str = "doc_id", text: str = "text", digest: Column | None = None
) -> DataFrame:
    """doc_id, ``digest`` if asked for, and ``fp`` of every row; a null text counts as empty."""
    given = [F.col(f"`{doc_id}`").alias("doc_id"), *([] if digest is None else [digest.alias("digest")])]
    kind = documents.select(*given).schema

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            *kept, texts = batch.columns
            made = pa.array([fingerprint(v.as_py()) for v in texts], pa.int64())
            yield pa.RecordBatch.from_arrays([*kept, made], names)

    made_schema = kind.add("fp", "long")
    names = made_schema.names
    return documents.select(*given, text_or_empty(text)).mapInArrow(run, made_schema)


def block_masks(blocks: int = BLOCKS, distance: int = DISTANCE) -> list[int]:
    """Masks of the bits that must be equal, one for each choice of unequal blocks."""
    edges = [64 * k // blocks for k in range(blocks + 1)]
    parts = [((1 << edges[k + 1]) - 1) ^ ((1 << edges[k]) - 1) for k in range(blocks)]
    return [sum(c) for c in combinations(parts, blocks - distance)]


def _signed(mask: int) -> int:
    return mask - (1 << 64) if mask >> 63 else mask


def links(nodes: DataFrame, distance: int = DISTANCE, blocks: int = BLOCKS, bucket: int = BUCKET) -> DataFrame:
    """Pairs ``a < b`` of distinct fingerprints ``fp`` of the written table ``nodes``:
    every pair at most ``distance`` (1 or 2) bits apart is among them or is joined by a
    path of such pairs."""
    if distance not in (1, 2):
        raise ValueError("halfway points serve distances 1 and 2")
    masks = [_signed(m) for m in block_masks(blocks, distance)]
    keys = F.array(*(F.struct(F.lit(k).alias("mask"), F.col("fp").bitwiseAND(F.lit(m)).alias("key"))
                     for k, m in enumerate(masks)))
    blocked = nodes.select("fp", F.explode(keys).alias("_at")).select("fp", "_at.mask", "_at.key")
    counts = blocked.groupBy("mask", "key").count().where("count > 1")
    shared = materialize(blocked.join(counts, ["mask", "key"]), "blocks")

    small = shared.where(F.col("count") <= bucket).groupBy("mask", "key")
    lists = small.agg(F.sort_array(F.collect_list("fp")).alias("fps"))
    pairs = lists.select(F.posexplode("fps").alias("_k", "a"), "fps").select(
        "a", F.explode(F.expr("slice(fps, _k + 2, size(fps))")).alias("b")
    )
    crowded = shared.where(F.col("count") > bucket).select("fp").distinct()
    flips = F.array(*(F.lit(_signed(1 << k)) for k in range(64)), F.lit(0))
    halfway = crowded.select("fp", F.explode(flips).alias("_flip")).select(
        "fp", F.col("fp").bitwiseXOR(F.col("_flip")).alias("_point")
    )
    halfway = materialize(halfway, "halfway")
    least = halfway.groupBy("_point").agg(F.min("fp").alias("a"), F.count("*").alias("_n")).where("_n > 1")
    met = halfway.join(least, "_point").where("a < fp").select("a", F.col("fp").alias("b"))
    near = F.bit_count(F.col("a").bitwiseXOR(F.col("b"))) <= distance
    return pairs.unionByName(met).where(near).distinct()


def near_groups(
    documents: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    distance: int = DISTANCE,
    digest: Column | None = None,
) -> DataFrame:
    """One row per row of ``documents``: doc_id, ``fingerprint`` (16 hex digits) and
    ``component_id``, the smallest doc_id reachable over links. If asked for also ``digest``,
    an expression over the columns of ``documents``, and ``root``, the component's smallest
    fingerprint, which tells components apart even where an id has several texts.

    Texts without words have fingerprint zero and are linked like any other; null texts
    count as empty, null ids are never the smallest unless alone. Rows that repeat are all
    returned. Texts of any length are read whole. An empty table gives no rows.
    """
    prints = materialize(fingerprints(documents, doc_id, text, digest), "fingerprints")
    grouped = prints.groupBy("fp").agg(F.min("doc_id").alias("least"), F.count("*").alias("n"))
    nodes = materialize(grouped, "distinct-fingerprints")
    found = components(links(nodes, distance))
    roots = nodes.join(found.withColumnRenamed("node", "fp"), "fp", "left")
    roots = roots.withColumn("root", F.coalesce("root", "fp"))
    least = roots.groupBy("root").agg(F.min("least").alias("component_id"))
    labelled = materialize(roots.join(least, "root").select("fp", "component_id", "n", "root"), "near-groups")
    out = attach_groups(prints, labelled, "fp", "n", "doc_id")
    digits = F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint")
    return out.select("doc_id", digits, "component_id", *([] if digest is None else ["digest", "root"]))
