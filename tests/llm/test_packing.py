import zlib
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from lullcast.llm.packing import END_ID, cut_pieces, ids_of, pack, plan_runs, sequences, spans

JSON = public_tokenizers.path("byte_bpe_50k.json")


def placed(histogram, capacity):
    """Every piece's (length, sequence, offset) by the plan."""
    out = []
    for length, first, n, sequence, each, offset in plan_runs(histogram, capacity):
        out += [(length, first + j, sequence + j // each, offset + j % each * length) for j in range(n)]
    return out


def best_fit(histogram, capacity):
    rooms = []
    for length, count in sorted(histogram, reverse=True):
        for _ in range(count):
            fitting = [r for r in rooms if r >= length]
            if fitting:
                rooms.remove(min(fitting))
                rooms.append(min(fitting) - length)
            else:
                rooms.append(capacity - length)
    return len(rooms)


@settings(max_examples=150, deadline=None)
@given(st.dictionaries(st.integers(1, 30), st.integers(1, 40), max_size=12))
def test_plan_is_best_fit_decreasing(counts):
    slots = placed(counts.items(), 30)
    assert len(slots) == sum(counts.values())
    assert {(n, r) for n, r, _, _ in slots} == {(n, r) for n, c in counts.items() for r in range(c)}
    by_sequence = {}
    for length, _, sequence, offset in slots:
        by_sequence.setdefault(sequence, []).append((offset, length))
    for own in by_sequence.values():
        end = 0
        for offset, length in sorted(own):
            assert offset == end
            end += length
        assert end <= 30
    assert len(by_sequence) == best_fit(counts.items(), 30)


def test_plan_size_does_not_follow_the_counts():
    few = plan_runs([(k, 3) for k in range(1, 200)], 1024)
    many = plan_runs([(k, 3_000_000) for k in range(1, 200)], 1024)
    assert len(many) < 20 * len(few)
    assert sum(r[2] for r in many) == 199 * 3_000_000


def test_spans():
    assert list(spans(5, 10)) == [(0, 5)]
    assert list(spans(10, 10)) == [(0, 10)]
    assert list(spans(25, 10)) == [(0, 5), (5, 15), (15, 25)]


@pytest.mark.parametrize("text", [
    "", "plain words", " " * 3000 + "x", "<|endoftext|> in a text", "é 日本語 👩‍👩‍👧 　 ﻿", "a" * 50_000,
])
def test_ids_are_those_of_the_tokenizer_file(text):
    expected = Tokenizer.from_file(JSON).encode(text, add_special_tokens=False).ids
    assert ids_of(JSON)(text).tolist() == expected


@pytest.mark.parametrize("text", [" " * 3_000_000, "\n" * 3_000_000, "x" + "\t" * 3_000_000 + "y", "\u3000" * 700_000])
def test_very_long_white_space(text):
    expected = Tokenizer.from_file(JSON).encode(text, add_special_tokens=False).ids
    assert ids_of(JSON)(text).tolist() == expected


def test_pack_very_long_white_space(spark, documents):
    rows = pack(documents([(1, " " * 3_000_000, "a"), (2, "b", "a")]), JSON).select("doc_id", "length").collect()
    assert sum(r.length for r in rows if r.doc_id == 1) == 3_000_001


def test_pack(spark, documents, odd):
    rows = pack(documents(odd), JSON, 64).collect()
    tokenizer = Tokenizer.from_file(JSON)
    expected = []
    for doc, text, _ in odd:
        ids = [*tokenizer.encode(text or "", add_special_tokens=False).ids, END_ID]
        expected += [(doc, k, a, ids[a:b]) for k, (a, b) in enumerate(spans(len(ids), 64))]
    key = lambda x: tuple(str(v) for v in x)
    found = [(r.doc_id, r.piece, r.start, np.frombuffer(r.ids, "<u4").tolist()) for r in rows]
    assert sorted(found, key=key) == sorted(expected, key=key)
    by_sequence = {}
    for r in rows:
        assert r.length == len(r.ids) // 4
        by_sequence.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for own in by_sequence.values():
        own.sort()
        assert [o for o, _ in own] == [0, *np.cumsum([n for _, n in own])[:-1]]
        assert sum(own[-1]) <= 64
    assert len(by_sequence) == best_fit(Counter(r.length for r in rows).items(), 64)
    total = sum(r.length for r in rows)
    packed = sequences(pack(documents(odd), JSON, 64))
    assert packed.select(F.sum(F.octet_length("ids"))).first()[0] == 4 * total


def test_pack_nothing(documents):
    assert pack(documents([]), JSON).collect() == []


def test_crc_of_ids(spark, documents):
    ids = cut_pieces(documents([(1, "some text", "a")]), JSON).select("ids", F.crc32("ids").alias("c")).first()
    assert ids.c == zlib.crc32(ids.ids)
