import hashlib

from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from lullcast.llm import exact_dedup
from lullcast.llm.exact_dedup import LEAST, MOST, chunk_table, chunks, cuts, exact_groups, verified_seed


@settings(max_examples=60, deadline=None)
@given(st.binary(max_size=400), st.integers(1, 400))
def test_cuts_cover_the_text(data, times):
    data = data * times
    ends = cuts(data)
    assert (ends[-1] if ends else 0) == len(data)
    sizes = [b - a for a, b in zip([0, *ends], ends)]
    assert all(0 < n <= MOST for n in sizes)
    assert all(n >= LEAST for n in sizes[:-1])


def test_cuts_follow_the_content(words):
    text = " ".join(words(20_000))
    own, moved = chunks(text), chunks("a line before\n" + text)
    assert 20 < len(own)
    assert len(set(own) & set(moved)) >= len(set(own)) - 3


def test_blocks_do_not_show(words, monkeypatch):
    data = " ".join(words(20_000)).encode()
    ends = cuts(data)
    monkeypatch.setattr(exact_dedup, "_STEP", 4096)
    assert cuts(data) == ends


def test_groups(documents, odd):
    digest = F.sha2(F.coalesce("text", F.lit("")), 256)
    rows = exact_groups(documents(odd), digest=digest).collect()
    assert len(rows) == len(odd)
    groups = {}
    for doc, text, _ in odd:
        groups.setdefault(hashlib.sha256((text or "").encode()).hexdigest(), []).append(doc)
    for r in rows:
        own = groups[r.digest]
        keep = max((d for d in own if d is not None), default=None)
        assert r.doc_id in own
        assert (r.keep_id, r.group_size, r.kept) == (keep, len(own), r.doc_id == keep)


def test_clashing_identifiers_are_noticed(documents, words):
    frame = documents([(i, " ".join(words(300, i)), "a") for i in range(12)])
    seed = verified_seed(frame, "text", 2)
    pairs = chunk_table(frame, "text", seed, 2)
    assert pairs.count() == pairs.select("id").distinct().count()
    assert len({r.keep_id for r in exact_groups(frame, size=2).collect()}) == 12


def test_too_short_identifiers_are_refused(documents, words):
    frame = documents([(i, " ".join(words(3000, i)), "a") for i in range(30)])
    try:
        verified_seed(frame, "text", 1)
    except ValueError as e:
        assert "clash" in str(e)
    else:
        raise AssertionError


def test_nothing(documents):
    assert exact_groups(documents([])).collect() == []


def test_hot_group(documents):
    rows = exact_groups(documents([(i, "same" if i % 3 else f"own {i}", "a") for i in range(600)])).collect()
    assert len(rows) == 600
    assert {r.group_size for r in rows} == {1, 400}
