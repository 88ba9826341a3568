"""Packing into fixed-length sequences, planned on the histogram of lengths.

Best fit works on counts: all pieces of one length are placed at once, longest first, into
the class of open sequences with the least room that still takes them. The plan is a list
of runs (length, first rank, sequences, pieces per sequence, offset); its size depends on
the capacity and never on the number of documents. Pieces then take their slots by a join
on length and rank within the length.
"""

from __future__ import annotations

from bisect import bisect_left, insort
from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from lullcast.llm.common import as_row, row_and
from lullcast.workspace import materialize

CAPACITY = 1024
END_ID = 2
SALTS = 256
PIECES = "piece int, start bigint, length bigint, ids binary"
PLAN = "length bigint, first_rank bigint, n bigint, first_sequence bigint, each bigint, offset bigint"

_ENCODERS: dict[object, object] = {}


def encoder(path: str):
    """The tokenizer in ``path``; a ``.json`` file is read through the ranks beside it.

    Ids are those of the ``tokenizers`` library; the same vocabulary as ranks encodes
    several times faster.
    """
    if path not in _ENCODERS:
        import base64

        import public_tokenizers
        import tiktoken

        with open(path.removesuffix(".json") + ".tiktoken", "rb") as file:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, file)}
        _ENCODERS[path] = tiktoken.Encoding(
            "ranks",
            pat_str=public_tokenizers.PATTERN,
            mergeable_ranks=ranks,
            special_tokens={"<|endoftext|>": 50256},
        )
    return _ENCODERS[path]


def ids_of(path: str) -> Callable[[str], np.ndarray]:
    """The function from a text to its ids. Where the fast encoder gives up, which it does on
    some hundred thousand white-space characters in a row, the ``tokenizers`` library itself
    encodes the text."""
    fast = encoder(path)

    def ids(text: str) -> np.ndarray:
        try:
            return fast.encode_to_numpy(text, allowed_special="all")
        except ValueError:
            if (path, "whole") not in _ENCODERS:
                from tokenizers import Tokenizer

                _ENCODERS[path, "whole"] = Tokenizer.from_file(path)
            return np.array(_ENCODERS[path, "whole"].encode(text, add_special_tokens=False).ids, np.uint32)

    return ids


def cut_pieces(
    documents: DataFrame, tokenizer: str, capacity: int = CAPACITY, end_id: int = END_ID
) -> DataFrame:
    """Pieces of at most ``capacity`` tokens of every document: doc_id, piece, start, length
    and ``ids`` (little-endian unsigned 32-bit).

    The rest of a long document is its first piece, so all others are full. A null text is
    empty: one piece of the end id alone. A text of any length is encoded whole.
    """

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = ids_of(tokenizer)
        for batch in batches:
            out: list[tuple] = []
            held = 0
            for doc, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                ids = np.append(encode(text.as_py() or ""), end_id).astype("<u4")
                for k, (a, b) in enumerate(spans(len(ids), capacity)):
                    out.append((doc, k, a, b - a, ids[a:b].tobytes()))
                held += len(ids)
                if held > 1 << 20:
                    yield _rows(out, schema)
                    out, held = [], 0
            yield _rows(out, schema)

    doc_type = documents.schema["doc_id"].dataType
    from pyspark.sql.pandas.types import to_arrow_type

    kinds = [to_arrow_type(doc_type), pa.int32(), pa.int64(), pa.int64(), pa.binary()]
    schema = pa.schema(list(zip(("doc_id", "piece", "start", "length", "ids"), kinds)))
    return documents.select("doc_id", "text").mapInArrow(
        cut, f"doc_id {doc_type.simpleString()}, {PIECES}"
    )


def _rows(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    columns = list(zip(*rows)) if rows else [[] for _ in schema]
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, schema)], schema=schema)


def spans(n: int, capacity: int) -> Iterator[tuple[int, int]]:
    begin = 0
    for end in range(n % capacity or capacity, n + 1, capacity):
        yield begin, end
        begin = end


def plan_runs(histogram: Iterable[tuple[int, int]], capacity: int) -> list[tuple[int, ...]]:
    """Best-fit decreasing over ``(length, count)``: rows of PLAN.

    A run places pieces ``first_rank .. first_rank + n - 1`` of its length, ``each`` to a
    sequence, from ``offset`` on.
    """
    rooms: list[int] = []  # sorted rooms that have open sequences
    open_runs: dict[int, list[tuple[int, int]]] = {}  # room -> [(first sequence, how many)]
    plan: list[tuple[int, ...]] = []
    fresh = 0

    def keep(room: int, first: int, count: int) -> None:
        if room and count:
            if room not in open_runs:
                insort(rooms, room)
            open_runs.setdefault(room, []).append((first, count))

    def place(length: int, rank: int, left: int, first: int, count: int, room: int) -> int:
        """Fill sequences of one run as far as pieces last; how many pieces were placed."""
        each = room // length
        full = min(count, left // each)
        if full:
            plan.append((length, rank, full * each, first, each, capacity - room))
            keep(room - each * length, first, full)
        placed = full * each
        if full < count:
            if some := left - placed:
                plan.append((length, rank + placed, some, first + full, some, capacity - room))
                keep(room - some * length, first + full, 1)
                full, placed = full + 1, left
            keep(room, first + full, count - full)
        return placed

    for length, count in sorted(histogram, reverse=True):
        rank = 0
        while rank < count:
            at = bisect_left(rooms, length)
            if at < len(rooms):
                room = rooms[at]
                runs = open_runs[room]
                first, many = runs.pop()
                if not runs:
                    del open_runs[room], rooms[at]
            else:
                room, first = capacity, fresh
                many = -(-(count - rank) // (capacity // length))
                fresh += many
            rank += place(length, rank, count - rank, first, many, room)
    return plan


def place_pieces(pieces: DataFrame, keys: list[str], capacity: int = CAPACITY) -> DataFrame:
    """``pieces``, a written table with a ``length`` of 1 to ``capacity``, with
    ``sequence_id`` and ``offset``.

    Ranks within a length are counted by hash buckets of ``keys``, as one length may hold
    any share of the rows. Rows that are equal in all keys are told apart by their number.
    The histogram has a row per length and the plan is bounded by the capacity, so both
    may go through the driver and be broadcast.
    """
    spark = pieces.sparkSession
    salt = F.pmod(F.xxhash64(*keys), F.lit(SALTS)).cast("int")
    salted = pieces.select(as_row(pieces), "length", salt.alias("_salt"))
    counts = materialize(salted.groupBy("length", "_salt").count(), "length-counts")
    before = Window.partitionBy("length").orderBy("_salt").rowsBetween(Window.unboundedPreceding, -1)
    counts = counts.withColumn("_before", F.coalesce(F.sum("count").over(before), F.lit(0)))
    histogram = counts.groupBy("length").agg(F.sum("count")).collect()
    runs = plan_runs([(r[0], r[1]) for r in histogram], capacity)
    plan = spark.createDataFrame(runs, PLAN).withColumnRenamed("length", "_length")
    own = Window.partitionBy("length", "_salt").orderBy(*(f"row.{c}" for c in keys))
    ranked = (
        salted.withColumn("_number", F.row_number().over(own) - 1)
        .join(counts.drop("count"), ["length", "_salt"])
        .withColumn("_rank", F.col("_before") + F.col("_number"))
    )
    at = F.col("_rank") - F.col("first_rank")
    fits = (F.col("length") == F.col("_length")) & at.between(F.lit(0), F.col("n") - 1)
    placed = ranked.join(F.broadcast(plan), fits)
    sequence = F.col("first_sequence") + F.floor(at / F.col("each"))
    offset = F.col("offset") + F.pmod(at, F.col("each")) * F.col("length")
    return placed.select(*row_and(placed, sequence_id=sequence, offset=offset))


def sequences(placed: DataFrame) -> DataFrame:
    """The packed sequences: sequence_id, ``ids`` (concatenated) and ``doc_ids`` in order.
    A sequence holds at most ``capacity`` pieces."""
    parts = F.array_sort(F.collect_list(F.struct("offset", "doc_id", "ids")))
    joined = F.aggregate(
        "parts", F.lit(b"").cast("binary"), lambda whole, p: F.concat(whole, p["ids"])
    )
    grouped = placed.groupBy("sequence_id").agg(parts.alias("parts"))
    return grouped.select("sequence_id", joined.alias("ids"), F.col("parts.doc_id").alias("doc_ids"))


def pack(documents: DataFrame, tokenizer: str, capacity: int = CAPACITY) -> DataFrame:
    """All pieces with their place; ``ids`` kept (see ``sequences``).

    Nulls, ties and repeated rows: a null text is empty, rows that repeat are packed as
    often as they occur, an empty table gives no rows. Other columns are ignored.
    """
    pieces = materialize(cut_pieces(documents, tokenizer, capacity), "pieces")
    return place_pieces(pieces, ["doc_id", "piece", "start", "ids"], capacity)
