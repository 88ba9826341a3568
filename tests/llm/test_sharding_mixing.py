import re
import zlib
from collections import Counter, defaultdict

import pytest

from lullcast.llm.mixing import emitted, mixed, source_targets
from lullcast.llm.sharding import interleaved_shards, write_shards


def test_shards(documents, odd):
    rows = interleaved_shards(documents(odd), 4, also_by=("text",)).collect()
    assert len(rows) == len(odd)
    slots = defaultdict(list)
    for r in rows:
        slots[r.shard].append(r.slot)
    assert max(map(len, slots.values())) - min(map(len, slots.values())) <= 1
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    mixture = Counter((r.shard, r.source) for r in rows)
    total = Counter(s for _, _, s in odd)
    for s, n in total.items():
        for shard in range(4):
            assert abs(mixture[shard, s] - n / 4) <= 2
    assert rows[0].row == "x"  # a given column of an internal name stays
    again = interleaved_shards(documents(odd[::-1]), 4, also_by=("text",)).collect()
    key = lambda r: (str(r.doc_id), r.shard, r.slot)
    assert sorted(map(key, rows)) == sorted(map(key, again))


def test_shards_of_nothing_and_of_few(documents):
    assert interleaved_shards(documents([])).collect() == []
    rows = interleaved_shards(documents([(1, "a", "a"), (2, "b", "b")]), 16).collect()
    assert all(r.slot == 0 for r in rows) and len({r.shard for r in rows}) == 2


def test_written_shards(spark, documents, odd, tmp_path):
    path = str(tmp_path / "shards")
    write_shards(interleaved_shards(documents(odd), 4, also_by=("text",)), path)
    assert spark.read.parquet(path).groupBy("shard").count().count() == 4


def filled(sizes, weights, wanted, most=2):
    """Targets by resharing the excess until none is above."""
    target, open_ = dict.fromkeys(sizes, 0.0), set(sizes)
    left = wanted
    while open_:
        share = left / sum(weights[s] for s in open_)
        full = {s for s in open_ if share * weights[s] > most * sizes[s]}
        if not full:
            for s in open_:
                target[s] = share * weights[s]
            break
        for s in full:
            target[s] = most * sizes[s]
            left -= target[s]
        open_ -= full
    return target


@pytest.mark.parametrize("sizes", [
    {"a": 10, "b": 1000, "c": 30}, {"a": 1000, "b": 1}, {"a": 5}, {"a": 0, "b": 7, "c": 7, "d": 0}, {"a": 0},
])
def test_targets(spark, sizes):
    rows = [(f"0{s}", n) for s, n in sizes.items()]
    found = source_targets(spark.createDataFrame(rows, "_source string, source_size bigint")).collect()
    weights = {s: (3, 1, 2)[k % 3] for k, s in enumerate(sorted(sizes))}
    expected = filled(sizes, weights, 1.5 * sum(sizes.values()))
    assert {r._source[1:]: r.target for r in found} == pytest.approx(expected)
    assert all(r.rate <= 2 for r in found)


def test_mix(documents, odd, words):
    rows = odd + [(1000 + i, " ".join(words(30, i)), "many") for i in range(400)]
    found = mixed(documents(rows)).collect()
    sizes = defaultdict(int)
    for _, text, source in rows:
        sizes[source] += len(re.findall("[^\x20\x09-\x0d]+", text or ""))
    order = sorted((s for s in sizes if s is not None)) + [None]
    weights = {s: (3, 1, 2)[k % 3] for k, s in enumerate(order)}
    target = filled(sizes, weights, 1.5 * sum(sizes.values()))
    taken = defaultdict(int)
    for r in found:
        assert r.source_size == sizes[r.source]
        assert r.target == pytest.approx(target[r.source])
        assert int(r.rate) <= r.copies <= int(r.rate) + 1 <= 3
        assert r.copies <= 2
        taken[r.source] += r.size * r.copies
    assert taken["many"] == pytest.approx(target["many"], rel=0.15)
    emitted_rows = emitted(mixed(documents(rows))).groupBy("doc_id", "text").count().collect()
    assert sum(r["count"] for r in emitted_rows) == sum(r.copies for r in found)


def test_mix_nothing(documents):
    assert mixed(documents([])).collect() == []
    assert [r.copies for r in mixed(documents([(1, None, None)])).collect()] == [0]


def test_facts_beyond_the_broadcast(documents, odd, monkeypatch):
    from lullcast.llm import common

    key = lambda r: (str(r.doc_id), r.copies, r.target)
    small = sorted(map(key, mixed(documents(odd)).collect()))
    monkeypatch.setattr(common, "BROADCAST_ROWS", 0)
    assert sorted(map(key, mixed(documents(odd)).collect())) == small


def test_shard_query(spark):
    import os

    from lullcast.llm.queries import op3_shards

    sf = "/root/testdata/sf0.001"
    if not os.path.isdir(sf):
        pytest.skip("no test tables")
    rows = op3_shards(spark, sf).collect()
    text = {r.doc_id: r.text or "" for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    assert {r.doc_id: (r.size, r.text_crc32) for r in rows} == {
        d: (len(t.encode()) + 1, zlib.crc32(t.encode())) for d, t in text.items()
    }
    counts = Counter(r.shard for r in rows)
    assert set(counts) == set(range(16)) and max(counts.values()) - min(counts.values()) <= 1
    assert all(r.grown_shard is None and r.law == "rows" for r in rows)
