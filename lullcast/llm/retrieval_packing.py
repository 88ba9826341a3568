"""Packing documents beside their lexical neighbours.

Whole windows of a long document are sequences of their own. What is left of every document
goes to a shard, beside others whose heaviest term is the same. A shard is an inverted index
with BM25 weights: a seed document asks it for neighbours not yet used, which fill the seed's
window from the nearest on. The one that no longer fits is cut, and its rest is the next
seed, so windows are full. Terms are the tokens that are packed. How often each occurs is
counted over all documents; a table of that is as long as the vocabulary.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type
from pyspark.sql.types import LongType, StructField, StructType

from lullcast.llm.packing import ids_of
from lullcast.workspace import materialize

CAPACITY = 1024
END_ID = 0
#: Documents of a shard on average; a task holds their rests, each shorter than a window.
SHARD_DOCS = 1024
K1, B = 1.2, 0.75
#: Rows and tokens a task holds before it passes them on.
HELD_ROWS = 1 << 14
HELD_TOKENS = 1 << 21

PIECE = "start bigint, length bigint, ids_crc32 bigint, doc_tokens bigint, sequence_id bigint, offset bigint"
CUT = f"kind string, number bigint, {PIECE}, ids binary"


def crc(ids: np.ndarray) -> int:
    return zlib.crc32(ids.astype("<u4").tobytes())


def cut_windows(
    documents: DataFrame, tokenizer: str, capacity: int = CAPACITY, end_id: int = END_ID
) -> DataFrame:
    """Rows of three kinds: ``window``, a full window of one document; ``rest``, the last and
    shorter part of a document with its ``ids``; ``terms``, in how many of a task's documents
    each id occurs (``ids``: id and count by turns), without a document."""
    from pyspark import TaskContext

    doc_type = documents.schema["doc_id"].dataType
    names = ["doc_id", "kind", "number", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset", "ids"]
    kinds = [to_arrow_type(doc_type), pa.string(), *[pa.int64()] * 7, pa.binary()]

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = ids_of(tokenizer)
        number = fresh = TaskContext.get().partitionId() << 33
        out, held = [], 0
        seen: list[np.ndarray] = []
        for batch in batches:
            for doc, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                ids = np.append(encode(text.as_py() or ""), end_id).astype("<u4")
                seen.append(np.unique(ids))
                whole = len(ids) // capacity * capacity
                for begin in range(0, whole, capacity):
                    fresh += 1
                    own = crc(ids[begin : begin + capacity])
                    out.append((doc, "window", None, begin, capacity, own, len(ids), -fresh, 0, None))
                if whole < len(ids):
                    rest = ids[whole:]
                    out.append((doc, "rest", number, whole, len(rest), None, len(ids), None, None, rest.tobytes()))
                number, held = number + 1, held + len(ids)
                if held > HELD_TOKENS or len(out) > HELD_ROWS:
                    out.append(counted(seen))
                    yield rows(out)
                    out, held, seen = [], 0, []
        if out:
            out.append(counted(seen))
            yield rows(out)

    def counted(seen: list[np.ndarray]) -> tuple:
        terms, counts = np.unique(np.concatenate(seen), return_counts=True)
        both = np.stack((terms, counts), axis=1).astype("<u4")
        return (None, "terms", *[None] * 7, both.tobytes())

    def rows(out: list[tuple]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), kinds)], names)

    return documents.select("doc_id", "text").mapInArrow(cut, f"doc_id {doc_type.simpleString()}, {CUT}")


def document_counts(cut: DataFrame) -> np.ndarray:
    """In how many documents each id occurs; one number per id of the vocabulary comes to
    the driver."""

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros(0, np.int64)
        for batch in batches:
            for ids in batch.column(0):
                terms, n = np.frombuffer(ids.as_py(), "<u4").reshape(-1, 2).T
                if len(terms) and terms[-1] >= len(counts):
                    counts = np.append(counts, np.zeros(terms[-1] + 1 - len(counts), np.int64))
                counts[terms] += n
        found = np.flatnonzero(counts)
        yield pa.RecordBatch.from_arrays([pa.array(found, pa.int64()), pa.array(counts[found])], ["term", "n"])

    partial = cut.where("kind = 'terms'").select("ids").mapInArrow(add, "term bigint, n bigint")
    found = partial.groupBy("term").agg(F.sum("n").alias("n")).toPandas()
    counts = np.zeros(int(found["term"].max()) + 1 if len(found) else 0, np.int64)
    counts[found["term"]] = found["n"]
    return counts


def rarity(counts: np.ndarray, documents: int) -> np.ndarray:
    """BM25's inverse document frequency; zero for a term of at least half of all documents."""
    return np.log((documents - counts + 0.5) / (counts + 0.5)).clip(0)


@dataclass
class Terms:
    """Distinct terms of every document of a list, one after the other, with their weights."""

    owner: np.ndarray
    term: np.ndarray
    weight: np.ndarray

    @classmethod
    def of(cls, texts: list[np.ndarray], rare: np.ndarray, mean: float) -> Terms:
        lengths = np.array([len(t) for t in texts])
        key = np.repeat(np.arange(len(texts)) << 32, lengths) + np.concatenate(texts).astype(np.int64)
        key, often = np.unique(key, return_counts=True)
        owner, term = key >> 32, key & 0xFFFFFFFF
        own = rare[term] > 0
        owner, term, often = owner[own], term[own], often[own]
        damping = K1 * (1 - B + B * lengths[owner] / mean)
        return cls(owner, term, rare[term] * often * (K1 + 1) / (often + damping))


def heaviest(terms: Terms, n: int) -> np.ndarray:
    """The heaviest term of each of ``n`` documents (ties: smallest), -1 without any."""
    out = np.full(n, -1)
    order = np.lexsort((terms.term, -terms.weight, terms.owner))
    owners, first = np.unique(terms.owner[order], return_index=True)
    out[owners] = terms.term[order][first]
    return out


class Index:
    """The inverted index of a shard: for every term its documents and their weights."""

    def __init__(self, terms: Terms, documents: int):
        order = np.lexsort((terms.owner, terms.term))
        self.documents = documents
        self.owner, self.weight = terms.owner[order], terms.weight[order]
        self.terms, begin = np.unique(terms.term[order], return_index=True)
        self.begin = np.append(begin, len(order))
        self.bounds = np.searchsorted(terms.owner, np.arange(documents + 1))
        self.asked = np.searchsorted(self.terms, terms.term)

    def scores(self, seed: int) -> np.ndarray:
        """The BM25 score of every document for all terms of ``seed``."""
        asked = self.asked[self.bounds[seed] : self.bounds[seed + 1]]
        begin, n = self.begin[asked], self.begin[asked + 1] - self.begin[asked]
        # the places of all postings of these terms
        at = np.repeat(begin - np.append(0, np.cumsum(n)[:-1]), n) + np.arange(n.sum())
        return np.bincount(self.owner[at], self.weight[at], self.documents)


def fill(index: Index, lengths: np.ndarray, capacity: int) -> Iterator[tuple[int, int, int, int, int]]:
    """``document, start, length, window, offset``: every document wholly placed.

    The longest unused document is the first seed. Neighbours follow by score (ties: earlier
    documents) until one no longer fits; it is cut and its rest is the next seed. All windows
    but the last are full.
    """
    order = np.argsort(-lengths, kind="stable")
    unused = np.ones(len(lengths), bool)
    next_, left, window = 0, int(lengths.sum()), 0
    seed, start = -1, 0
    while left:
        if seed < 0:
            while not unused[order[next_]]:
                next_ += 1
            seed, start = int(order[next_]), 0
            unused[seed] = False
        own = int(lengths[seed]) - start
        yield seed, start, own, window, 0
        filled, left = own, left - own
        pool = np.flatnonzero(unused)
        if filled < capacity and len(pool):
            near = pool[np.argsort(-index.scores(seed)[pool], kind="stable")]
        else:
            near = pool[:0]
        seed, start = -1, 0
        for other in near:
            if filled == capacity:
                break
            some = min(int(lengths[other]), capacity - filled)
            yield int(other), 0, some, window, filled
            filled, left = filled + some, left - some
            unused[other] = False
            if some < lengths[other]:
                seed, start = int(other), some
        window += 1


def powers(n: int) -> Iterator[tuple[int, int]]:
    """``begin, end`` of the parts of 0 to ``n`` that are powers of two, the largest first."""
    begin = 0
    while begin < n:
        end = begin + (1 << ((n - begin).bit_length() - 1))
        yield begin, end
        begin = end


def shard_plan(counts: list[tuple[int, int]], shard_docs: int) -> list[tuple[int, int, int]]:
    """``home, first, n``: documents of a home go to shards ``first`` to ``first + n - 1``.
    Homes with many documents have shards of their own, others share one with the next."""
    plan, shard, room = [], 0, shard_docs
    for home, n in sorted(counts):
        if n > room and room < shard_docs:
            shard, room = shard + 1, shard_docs
        split = -(-n // shard_docs)
        plan.append((home, shard, split))
        if split > 1:
            shard, room = shard + split, shard_docs
        else:
            room -= n
    return plan


def retrieval_packed(
    documents: DataFrame,
    tokenizer: str,
    capacity: int = CAPACITY,
    end_id: int = END_ID,
    shard_docs: int = SHARD_DOCS,
) -> DataFrame:
    """Pieces of all documents: doc_id, start, length, ids_crc32, doc_tokens, sequence_id,
    offset and ``shard`` (null for a full window of one document).

    Every id of every document lies in one piece. All sequences are full but those at the
    end of a shard, whose lengths are powers of two; so none needs padding. Documents of one
    home term are dealt to its shards by row number, so copies and hot terms make more
    shards, not larger ones. A null text is empty: the end id alone. Rows that repeat are
    packed as often as they occur; null ids are ids. Texts without rare terms have no
    neighbours and fill windows in order. An empty table gives no rows; other columns are
    ignored.
    """
    spark = documents.sparkSession
    cut = materialize(cut_windows(documents, tokenizer, capacity, end_id), "windows", "kind")
    counts = document_counts(cut)
    total = int(counts[end_id]) if len(counts) > end_id else 0  # every document holds the end id
    rare = rarity(counts, total)
    rests = cut.where("kind = 'rest'").select("doc_id", "number", "start", "length", "doc_tokens", "ids")
    mean = rests.agg(F.avg("length")).first()[0] or 1.0
    with_home = StructType([*rests.schema, StructField("home", LongType())])

    def to_homes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in (batch.slice(k, 1000) for k in range(0, batch.num_rows, 1000)):
                texts = [np.frombuffer(v.as_py(), "<u4") for v in part.column(5)]
                homes = heaviest(Terms.of(texts, rare, mean), len(texts))
                yield pa.RecordBatch.from_arrays([*part.columns, pa.array(homes, pa.int64())], with_home.names)

    homed = rests.mapInArrow(to_homes, with_home)
    homes = homed.groupBy("home").count().collect()  # a row per id of the vocabulary at most
    plan = spark.createDataFrame(shard_plan([(r[0], r[1]) for r in homes], shard_docs), "home bigint, first bigint, n bigint")
    dealt = homed.join(F.broadcast(plan), "home").withColumn("shard", F.col("first") + F.pmod("number", "n"))

    def pack(shard: pd.DataFrame) -> pd.DataFrame:
        shard = shard.sort_values("number", kind="stable")
        texts = [np.frombuffer(v, "<u4") for v in shard["ids"]]
        lengths = np.array([len(t) for t in texts])
        own, starts, sizes = (shard[c].tolist() for c in ("shard", "start", "doc_tokens"))
        docs = shard["doc_id"].tolist()
        index = Index(Terms.of(texts, rare, mean), len(texts))
        pieces = list(fill(index, lengths, capacity))
        last = int(lengths.sum()) // capacity
        tail = list(powers(int(lengths.sum()) % capacity))
        out = []
        for doc, start, length, window, offset in pieces:
            # (begin in the piece, end, sequence, offset)
            places = [(0, length, window, offset)]
            if window == last:
                places = [
                    (max(a, offset) - offset, min(b, offset + length) - offset, last + k, max(a, offset) - a)
                    for k, (a, b) in enumerate(tail)
                    if a < offset + length and offset < b
                ]
            for a, b, sequence, at in places:
                ids = texts[doc][start + a : start + b]
                out.append((docs[doc], starts[doc] + start + a, b - a, crc(ids), sizes[doc],
                            ((own[0] + 1) << 32) + sequence, at, own[0]))
        return pd.DataFrame(out, columns=[*result])

    result = ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset", "shard"]
    # ids as text: pandas would turn a null beside whole numbers into floats
    doc_type = documents.schema["doc_id"].dataType.simpleString()
    by_text = dealt.drop("home", "first", "n").withColumn("doc_id", F.col("doc_id").cast("string"))
    packed = by_text.groupBy("shard").applyInPandas(pack, f"doc_id string, {PIECE}, shard bigint")
    packed = packed.withColumn("doc_id", F.expr(f"CAST(doc_id AS {doc_type})"))
    windows = cut.where("kind = 'window'").withColumn("shard", F.lit(None).cast("bigint"))
    return windows.select(*result).unionByName(packed.select(*result))
