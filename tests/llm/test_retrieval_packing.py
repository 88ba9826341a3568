import math
import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from lullcast.llm.retrieval_packing import (
    B, K1, Index, Terms, fill, heaviest, powers, rarity, retrieval_packed, shard_plan,
)

JSON = public_tokenizers.path("byte_bpe_50k.json")


def check(rows, given_rows, capacity):
    """Every id once, sequences gapless, no padding; the documents by sequence."""
    tokenizer = Tokenizer.from_file(JSON)
    expected = Counter()
    ids = {}
    for doc, text, _ in given_rows:
        own = [*tokenizer.encode(text or "", add_special_tokens=False).ids, 0]
        ids[doc, len(own)] = own
        expected.update((doc, k, i) for k, i in enumerate(own))
    found, sequences = Counter(), defaultdict(list)
    for r in rows:
        own = ids[r.doc_id, r.doc_tokens][r.start : r.start + r.length]
        assert len(own) == r.length > 0
        assert zlib.crc32(np.array(own, "<u4").tobytes()) == r.ids_crc32
        found.update((r.doc_id, r.start + k, i) for k, i in enumerate(own))
        sequences[r.sequence_id].append((r.offset, r.length, r.doc_id))
    assert found == expected
    for own in sequences.values():
        own.sort()
        end = 0
        for offset, length, _ in own:
            assert offset == end
            end += length
        assert end <= capacity and end & (end - 1) == 0
    assert Counter(sum(n for _, n, _ in s) for s in sequences.values())
    return sequences


@pytest.mark.parametrize("shard_docs", [1024, 7, 1])
def test_packs_everything(documents, odd, shard_docs):
    big = 2**60
    rows = odd + [(big + 1, "large ids", "a"), (big + 2, "beside a null", "a"), (9, " " * 1_000_000, "a")]
    found = retrieval_packed(documents(rows), JSON, 64, shard_docs=shard_docs).collect()
    check(found, rows, 64)


def test_nothing(documents):
    assert retrieval_packed(documents([]), JSON).collect() == []
    [only] = retrieval_packed(documents([(1, None, "a")]), JSON).collect()
    assert (only.doc_id, only.start, only.length, only.doc_tokens, only.offset) == (1, 0, 1, 1, 0)


def test_neighbours_share_windows(documents, words):
    """Texts on two subjects, dealt by turns: a window holds one subject, but at its border."""
    subjects = [[f"{name}{k}" for k in range(40)] for name in ("river", "engine")]
    import random

    r = random.Random(4)
    rows = [(i, " ".join(r.choice(subjects[i % 2]) for _ in range(25)), "a") for i in range(120)]
    rows += [(1000 + i, " ".join(words(30, i)), "a") for i in range(200)]
    found = retrieval_packed(documents(rows), JSON, 512).collect()
    sequences = check(found, rows, 512)
    mixed = sum(
        len({doc % 2 for _, _, doc in own if doc < 1000}) > 1
        for own in sequences.values()
        if len(own) > 2
    )
    assert mixed <= 4


def test_scores_are_bm25():
    r = np.random.default_rng(0)
    texts = [r.integers(0, 30, r.integers(1, 60)) for _ in range(40)]
    counts = np.bincount(np.concatenate([np.unique(t) for t in texts]), minlength=31)
    rare, mean = rarity(counts, 40), np.mean([len(t) for t in texts])
    index = Index(Terms.of(texts, rare, mean), 40)
    for seed in range(40):
        scores = index.scores(seed)
        for d, text in enumerate(texts):
            expected = 0.0
            for t in set(texts[seed].tolist()):
                idf = max(0.0, math.log((40 - counts[t] + 0.5) / (counts[t] + 0.5)))
                f = (text == t).sum()
                expected += idf * f * (K1 + 1) / (f + K1 * (1 - B + B * len(text) / mean))
            assert scores[d] == pytest.approx(expected)


def test_fill_takes_the_nearest_unused():
    r = np.random.default_rng(1)
    texts = [r.integers(0, 50, r.integers(1, 20)) for _ in range(30)]
    lengths = np.array([len(t) for t in texts])
    counts = np.bincount(np.concatenate([np.unique(t) for t in texts]), minlength=51)
    index = Index(Terms.of(texts, rarity(counts, 30), lengths.mean()), 30)
    windows = defaultdict(list)
    for doc, start, length, window, offset in fill(index, lengths, 40):
        windows[window].append((offset, doc, start, length))
    used, placed = set(), Counter()
    for w in sorted(windows):
        seed = windows[w][0][1]
        assert w or seed == int(np.argmax(lengths))
        used.add(seed)
        scores = index.scores(seed)
        for _, doc, _, _ in windows[w][1:]:
            assert scores[doc] == max(scores[d] for d in range(30) if d not in used)
            used.add(doc)
        for _, doc, _, length in windows[w]:
            placed[doc] += length
        size = sum(x[3] for x in windows[w])
        assert size == 40 or w == max(windows)
    assert [placed[d] for d in range(30)] == lengths.tolist()


def test_heaviest_term():
    rare = np.array([0.0, 1.0, 2.0, 1.0])
    terms = Terms.of([np.array([0, 0]), np.array([3, 1]), np.array([0, 2, 1])], rare, 2.0)
    assert heaviest(terms, 3).tolist() == [-1, 1, 2]


@settings(max_examples=200, deadline=None)
@given(st.dictionaries(st.integers(-1, 50), st.integers(1, 60), max_size=20), st.integers(1, 20))
def test_shards_are_bounded(counts, most):
    held = Counter()
    for home, first, n in shard_plan(list(counts.items()), most):
        each = -(-counts[home] // n)
        assert each <= most
        for k in range(n):
            held[first + k] += each
    assert all(n <= most for n in held.values())


def test_powers():
    assert [b - a for a, b in powers(300)] == [256, 32, 8, 4]
    assert list(powers(0)) == []
