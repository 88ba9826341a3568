"""Spelling variants: words one edit apart, found through a dictionary of trie-node pairs.

Words are kept in two tries, one of them reversed, whose nodes are numbered. A word with
position i skipped is the pair (node of the prefix before i, node of the suffix after i); the
word cut at i without skipping is such a pair, too. Two words share a skipped pair exactly if
they differ by one replaced character, and a skipped pair of one is a cut pair of the other
exactly if a character is deleted. Pairs are two integers, so no string is joined, and at most
one word per character of the alphabet shares a skipped pair, so no group is large.
"""

from __future__ import annotations

import re
import zlib
from bisect import bisect_right
from collections import Counter
from collections.abc import Iterator
from math import ceil, log2, log10

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from lullcast.workspace import materialize

#: Lower-cased runs of seven letters and more; a shorter run can't become a word.
LEAST_LENGTH = 7
LEAST_COUNT = 2
#: A form occurs at least so many times as often as its variant.
FORM_FACTOR = 10
#: One run in so many, drawn by checksum, loses a letter.
DROP_ONE_IN = 31
#: Words that one task numbers, on average, and draws per border between two such parts.
PART_WORDS = 100_000
DRAWS = 50
#: Borders need not be whole words.
BORDER_LENGTH = 256
#: Texts beyond this length are read word by word, distinct words beyond this number passed on.
LONG_TEXT = 1 << 22
HELD_WORDS = 1 << 19
HELD_KEYS = 1 << 18
CUT, SKIP, SKIP_AGAIN = 0, 1, 2


def word_counts(documents: DataFrame, least: int = LEAST_LENGTH, drop_one_in: int = DROP_ONE_IN) -> DataFrame:
    """``word, n`` for every distinct word of at least ``least`` code points, all texts counted."""
    runs = re.compile("[a-zÀ-ÿ]{%d,}" % least)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: Counter[str] = Counter()
        for batch in batches:
            for doc, text in zip(batch.column(0), batch.column(1)):
                if (text := text.as_py()) is None:
                    continue
                # only A-Z: the bytes of other letters have no lower case
                text = text.encode("utf-8", "surrogatepass").lower().decode("utf-8", "replace")
                found = runs.findall(text) if len(text) < LONG_TEXT else (m[0] for m in runs.finditer(text))
                begun = zlib.crc32(f"{doc.as_py() or ''}:".encode())
                for run, n in Counter(found).items():
                    h = zlib.crc32(run.encode(), begun)
                    if h % drop_one_in == 0:
                        at = h % len(run)
                        run = run[:at] + run[at + 1 :]
                        if len(run) < least:
                            continue
                    held[run] += n
                if len(held) > HELD_WORDS:
                    yield _counted(held)
                    held.clear()
        yield _counted(held)

    ids = F.col("doc_id").cast("string").alias("doc_id")
    counted = documents.select(ids, "text").mapInArrow(count, "word string, n bigint")
    return counted.groupBy("word").agg(F.sum("n").alias("n"))


def _counted(held: Counter) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.array(held.keys(), pa.string()), pa.array(held.values(), pa.int64())], ["word", "n"]
    )


def borders(rows: DataFrame, text: str, part_words: int) -> list[str]:
    """Values of ``text`` that split the rows into parts of about ``part_words``: one to the
    driver for each part, chosen from DRAWS as many."""
    parts = -(-rows.count() // part_words)
    if parts < 2:
        return []
    one_in = max(1, part_words // DRAWS)
    drawn = rows.where(F.pmod(F.xxhash64(text, F.lit(11)), F.lit(one_in)) == 0)
    drawn = sorted(r[0] for r in drawn.select(F.substring(text, 1, BORDER_LENGTH)).collect())
    return sorted({drawn[k * len(drawn) // parts] for k in range(1, parts)} if drawn else set())


def common_prefix(a: str, b: str) -> int:
    n = min(len(a), len(b))
    if a[:n] == b[:n]:
        return n
    k = 0
    while a[k] == b[k]:
        k += 1
    return k


class Numbering:
    """Numbers of trie nodes along words that come in their order.

    A node has one number wherever it is met. Within a part it is numbered when its first
    word comes. A prefix shared by words of two parts is a prefix of the border between
    them, as that lies between the words: prefixes of borders are numbered before, by the
    same rule, with negative numbers.
    """

    def __init__(self, split: list[str]):
        self.split = split
        self.paths: list[list[int]] = []
        path, last, fresh = [0], "", 0
        for border in split:
            path = path[: common_prefix(last, border) + 1]
            new = len(border) + 1 - len(path)
            path = path + [-(fresh + k + 1) for k in range(new)]
            fresh, last = fresh + new, border
            self.paths.append(path)
        self.part = -1

    def path(self, part: int, word: str) -> list[int]:
        """The node of every prefix of ``word``, the empty one included."""
        if part != self.part:
            self.part, self.last, self.now, self.fresh = part, "", [0], 0
        path = self.now[: common_prefix(self.last, word) + 1]
        for k in (part - 1, part):
            if 0 <= k < len(self.split):
                shared = common_prefix(self.split[k], word) + 1
                path += self.paths[k][len(path) : shared]
        new = len(word) + 1 - len(path)
        begin = (part << 40) + self.fresh + 1
        path += range(begin, begin + new)
        self.fresh, self.last, self.now = self.fresh + new, word, path
        return path


def in_parts(rows: DataFrame, text: str, split: list[str]) -> DataFrame:
    """``rows`` with their ``part`` between the borders, every part in one task and in order."""
    from pyspark.sql.pandas.functions import pandas_udf

    @pandas_udf("int")
    def part_of(texts):
        return texts.map(lambda t: bisect_right(split, t)).astype("int32")

    part = part_of(text) if split else F.lit(0)
    return rows.withColumn("part", part).repartition("part").sortWithinPartitions("part", text)


def numbered_words(words: DataFrame, part_words: int = PART_WORDS) -> DataFrame:
    """``id, word, n, nodes``: ids in code-point order, ``nodes`` the trie node of every prefix."""
    split = borders(words, "word", part_words)

    def number(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        numbering, place, before = Numbering(split), 0, -1
        for batch in batches:
            ids, nodes = [], []
            for part, word in zip(batch.column(2).to_pylist(), batch.column(0).to_pylist()):
                place, before = (place + 1 if part == before else 0), part
                ids.append((part << 40) + place)
                nodes.append(np.array(numbering.path(part, word), np.int64))
            made = [pa.array(ids, pa.int64()), batch.column(0), batch.column(1), pa.array(nodes, pa.list_(pa.int64()))]
            yield pa.RecordBatch.from_arrays(made, ["id", "word", "n", "nodes"])

    rows = in_parts(words.select("word", "n"), "word", split)
    return rows.mapInArrow(number, "id bigint, word string, n bigint, nodes array<bigint>")


def node_pairs(numbered: DataFrame, part_words: int = PART_WORDS) -> DataFrame:
    """``prefix, suffix, kind, id, n``: a CUT pair for every cut of a word, a SKIP pair for
    every position left out; SKIP_AGAIN where leaving out the position before gives the
    same rest."""
    turned = numbered.select(F.reverse("word").alias("turned"), "id", "n", "nodes")
    split = borders(turned, "turned", part_words)
    names = ["prefix", "suffix", "kind", "id", "n"]

    def pairs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        numbering = Numbering(split)
        for batch in batches:
            out, held = [], 0
            columns = (batch.column(k) for k in (4, 0, 1, 2, 3))
            for part, text, own, n, nodes in zip(*columns):
                text = text.as_py()
                after = np.array(numbering.path(part.as_py(), text)[::-1], np.int64)
                before = nodes.values.to_numpy()
                letters = np.frombuffer(text[::-1].encode("utf-32-le"), np.uint32)
                kinds = np.where(letters[1:] == letters[:-1], SKIP_AGAIN, SKIP)
                kind = np.concatenate((np.full(len(before), CUT), [SKIP], kinds))
                pair = (np.concatenate((before, before[:-1])), np.concatenate((after, after[1:])))
                out.append((*pair, kind, np.full(len(kind), own.as_py()), np.full(len(kind), n.as_py())))
                held += len(kind)
                if held > HELD_KEYS:
                    yield _pairs(out, names)
                    out, held = [], 0
            if out:
                yield _pairs(out, names)

    rows = in_parts(turned, "turned", split)
    return rows.mapInArrow(pairs, "prefix bigint, suffix bigint, kind int, id bigint, n bigint")


def _pairs(out: list[tuple], names: list[str]) -> pa.RecordBatch:
    columns = [np.concatenate(c) for c in zip(*out)]
    columns[2] = columns[2].astype(np.int32)
    return pa.RecordBatch.from_arrays([pa.array(c) for c in columns], names)


def near_words(pairs: DataFrame) -> DataFrame:
    """``id, n_near, best`` for every word that has near words: how many there are and, as
    (n, -id), the most frequent of them, of equals that with the smallest id.

    A skipped pair belongs to at most one word per letter, a cut pair to one word, so a
    group has some hundred rows at most. Each near word counts in one group only.
    """
    same = Window.partitionBy("prefix", "suffix")
    shared = pairs.withColumn("_all", F.count("*").over(same)).where("_all > 1")
    # skipped pairs first, the most frequent word leading
    ordered = same.orderBy(F.col("kind") == CUT, F.desc("n"), "id")
    whole = ordered.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    skipped, fresh = F.col("kind") != CUT, F.col("kind") == SKIP
    me = F.struct("n", (-F.col("id")).alias("id"))
    facts = shared.select(
        "kind", "id",
        F.row_number().over(ordered).alias("_row"),
        F.first(F.when(skipped, me)).over(whole).alias("_most"),
        F.lead(F.when(skipped, me)).over(ordered).alias("_next"),
        F.max(F.when(fresh, me)).over(whole).alias("_most_fresh"),
        F.max(F.when(~skipped, me)).over(whole).alias("_cut"),
        F.sum(skipped.cast("int")).over(whole).alias("_skipped"),
        F.sum(fresh.cast("int")).over(whole).alias("_fresh"),
    )
    replaced = F.when(F.col("_row") == 1, F.col("_next")).otherwise(F.col("_most"))
    shorter = F.when(fresh, F.col("_cut"))
    found = facts.select(
        "id",
        F.when(skipped, F.col("_skipped") - 1 + shorter.isNotNull().cast("int"))
        .otherwise(F.col("_fresh")).alias("near"),
        F.when(skipped, F.greatest(replaced, shorter)).otherwise(F.col("_most_fresh")).alias("best"),
    ).where("near > 0")
    return found.groupBy("id").agg(F.sum("near").alias("n_near"), F.max("best").alias("best"))


def roots(forms: DataFrame, most: int) -> DataFrame:
    """``id, root`` from ``id, form``: the last form reached. As a form occurs at least
    FORM_FACTOR times as often, a chain has few steps; each round doubles those taken."""
    steps = log10(max(most, 10)) / log10(FORM_FACTOR) + 1
    reached = forms.select("id", F.col("form").alias("root"))
    for _ in range(ceil(log2(steps))):
        further = reached.select(F.col("id").alias("root"), F.col("root").alias("_further"))
        joined = reached.join(further, "root", "left")
        reached = materialize(joined.select("id", F.coalesce("_further", "root").alias("root")), "roots")
    return reached


def spelling_groups(
    documents: DataFrame,
    least: int = LEAST_LENGTH,
    least_count: int = LEAST_COUNT,
    drop_one_in: int = DROP_ONE_IN,
    part_words: int = PART_WORDS,
) -> DataFrame:
    """word, form, root, n, n_near and form_n for every word of ``documents`` (doc_id, text)
    with at least ``least`` code points that occurs ``least_count`` times or more.

    Near words differ by exactly one inserted, deleted or replaced code point, all of them
    are found. Null texts hold no words, empty ones neither; a null id is drawn as empty
    text. Rows that repeat count as often as they occur. Of near words with equal n the
    smallest in code-point order is the form. Very long words are single words. An empty
    table gives no rows; other columns are ignored.
    """
    counted = word_counts(documents, least, drop_one_in).where(F.col("n") >= least_count)
    words = materialize(numbered_words(materialize(counted, "word-counts"), part_words), "words")
    near = materialize(near_words(node_pairs(words, part_words)), "near-words")
    most = near.agg(F.max("best.n")).first()[0] or 0
    narrow = words.select("id", "word", "n")
    linked = narrow.join(near, "id", "left")
    is_form = F.col("best.n") >= F.col("n") * FORM_FACTOR
    linked = linked.select(
        "id", "word", "n",
        F.coalesce("n_near", F.lit(0).cast("bigint")).alias("n_near"),
        F.when(is_form, -F.col("best.id")).alias("form"),
        F.when(is_form, F.col("best.n")).alias("form_n"),
    )
    linked = materialize(linked, "linked-words")
    forms = linked.where("form IS NOT NULL").select("id", "form")
    named = narrow.select(F.col("id").alias("_named"), F.col("word").alias("_name"))
    spelled = (
        forms.join(roots(forms, most), "id")
        .join(named.withColumnsRenamed({"_named": "form", "_name": "_form"}), "form")
        .join(named.withColumnsRenamed({"_named": "root", "_name": "_root"}), "root")
        .select("id", "_form", "_root")
    )
    return linked.join(spelled, "id", "left").select(
        "word", F.col("_form").alias("form"), F.coalesce("_root", "word").alias("root"),
        "n", "n_near", "form_n",
    )
