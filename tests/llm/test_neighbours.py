import numpy as np
import pytest
from pyspark.sql import functions as F

from lullcast.llm.neighbours import Tree, nearest

SCHEMA = "vec_id bigint, embedding array<float>, v string, shard string"


def brute(rows, k, every=20):
    ok = [(i, np.array(v, np.float32).astype(float)) for i, v in rows if i is not None and v and None not in v
          and np.isfinite(np.array(v, float)).all() and np.any(np.array(v))]
    out = {}
    for q, x in ok:
        if q % every == 0:
            scored = sorted((-float((y * x).sum()), i) for i, y in ok if i != q and len(y) == len(x))
            out[q] = [(i, -s) for s, i in scored[:k]]
    return out


@pytest.fixture(scope="module")
def rows():
    r = np.random.default_rng(2)
    centres = r.normal(size=(8, 12))
    made = [(i, (centres[i % 8] + r.normal(size=12) * 0.6).tolist()) for i in range(1500)]
    made += [(2000 + i, [1.0] * 12) for i in range(200)]  # one hot vector
    made += [(3000, None), (3001, []), (3020, [0.0] * 12), (3040, [float("nan")] + [1.0] * 11), (3060, [None] + [1.0] * 11),
             (3080, [float("inf")] * 12), (3100, [1.0, 2.0]), (3120, [2.0, 1.0]), (None, [1.0] * 12)]
    return made


def found(spark, rows, **options):
    frame = spark.createDataFrame([(*r, "x", "x") for r in rows], SCHEMA)
    out = {}
    for r in nearest(frame, F.pmod("vec_id", F.lit(20)) == 0, **options).collect():
        out.setdefault(r.query_id, []).append((r["rank"], r.vec_id, r.score))
    return {q: [(i, s) for _, i, s in sorted(own)] for q, own in out.items()}


def test_factor_one_is_exact(spark, rows):
    expected = brute(rows, 20)
    got = found(spark, rows, factor=1.0, shard_rows=300, block_rows=40)
    assert set(got) == {q for q, own in expected.items() if own}
    for q, own in got.items():
        assert [s for _, s in own] == pytest.approx([s for _, s in expected[q]], abs=1e-9)
        assert [i for i, _ in own] == [i for i, _ in expected[q]]


def test_recall_of_the_default(spark, rows):
    expected, got = brute(rows, 20), found(spark, rows, shard_rows=300)
    hits = [len({i for i, _ in got[q]} & {i for i, _ in expected[q]}) / max(len(expected[q]), 1) for q in expected]
    assert np.mean(hits) >= 0.9


def test_larger_factors_visit_less():
    r = np.random.default_rng(4)
    tree = Tree(r.normal(size=(4000, 3)))
    taken = []
    from lullcast.llm import neighbours

    original = neighbours._Walk._take

    def counting(self, node, active):
        taken.append(len(active))
        original(self, node, active)

    neighbours._Walk._take = counting
    try:
        seen = []
        for factor in (1.0, 4.0):
            taken.clear()
            tree.search(r.normal(size=(50, 3)), 5, factor)
            seen.append(sum(taken))
    finally:
        neighbours._Walk._take = original
    assert seen[1] < seen[0] < 50 * 4000 / 64


def test_few_and_none(spark):
    assert found(spark, [(0, [1.0, 0.0]), (1, [0.5, 0.5])]) == {0: [(1, pytest.approx(0.5))]}
    assert found(spark, []) == {}
    assert found(spark, [(1, [1.0, 0.0])]) == {}
