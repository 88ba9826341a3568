import datetime
import math
import random

from lullcast.operators.state import StateSpec, series_state, step_features
from lullcast.schema import PanelSchema
from lullcast.streaming import updates
from lullcast.streaming.updates import FeatureTable, feature_names

ROLES = PanelSchema("ds", "y", ("id",))
SPEC = StateSpec(lags=(1, 3), windows=(4, 7))
START = datetime.date(2021, 1, 1)


def run(spark, folder, out, marks):
    rows = spark.readStream.schema("id string, ds date, y double").parquet(folder)
    features = FeatureTable(out, ROLES, SPEC)
    features.start(rows, marks).awaitTermination()
    return features.features(spark).collect()


def test_stream_equals_the_state_and_ignores_old_rows(spark, panel, tmp_path):
    rng = random.Random(5)
    series = {n: [rng.choice([0, 0, 1, 4.5]) for _ in range(20)] for n in "ab"}
    whole = panel(**series)
    folder, out, marks = (str(tmp_path / n) for n in ("in", "out", "marks"))
    cut = START + datetime.timedelta(days=12)
    whole.filter(whole.ds < cut).repartition(3).write.parquet(folder)
    first = run(spark, folder, out, marks)
    assert len(first) == 24 and all(r.n_ignored == 0 for r in first)

    late = panel(a=[77, 77])
    whole.filter(whole.ds >= cut).union(late).repartition(1).write.mode("append").parquet(folder)
    rows = run(spark, folder, out, marks)
    assert len(rows) == 40
    last = {r.id: r for r in rows if (r.ds - START).days == 19}
    assert (last["a"].n_ignored, last["b"].n_ignored) == (2, 0)
    for want in step_features(series_state(whole, ROLES, SPEC), SPEC).collect():
        got = last[want.id]
        assert got.n_obs == 20
        for name in feature_names(SPEC):
            assert math.isclose(got[name], want[name], abs_tol=1e-9), name


def random_batches(panel, n_batches, seed):
    """A panel of uneven series cut into batches, and all of it."""
    rng = random.Random(seed)
    series = {n: [rng.choice([0, 0, None, 1, 4.5]) for _ in range(rng.randint(1, 40))] for n in "abcd"}
    whole = panel(**series)
    size = -(-40 // n_batches)
    cut = lambda k: START + datetime.timedelta(days=k * size)
    return whole, [whole.filter((whole.ds >= cut(k)) & (whole.ds < cut(k + 1))) for k in range(n_batches)]


def same(found, wanted):
    assert len(found) == len(wanted)
    for name in feature_names(SPEC):
        assert math.isclose(found[name], wanted[name], abs_tol=1e-9), name


def test_one_batch_or_many_and_a_new_base(spark, panel, tmp_path, monkeypatch):
    monkeypatch.setattr(updates, "COMPACT_EVERY", 3)
    whole, batches = random_batches(panel, 8, 3)
    once, often = (FeatureTable(str(tmp_path / n), ROLES, SPEC) for n in ("once", "often"))
    once.apply(whole, 0)
    for k, rows in enumerate(batches):
        often.apply(rows, k)
    assert sorted(p.name for p in (tmp_path / "often" / "base").iterdir()) == ["batch=2", "batch=5"]
    key = lambda r: (r.id, r.ds)
    first, second = (sorted(t.features(spark).collect(), key=key) for t in (once, often))
    assert [key(r) for r in first] == [key(r) for r in second] and len(first) == whole.count()
    for a, b in zip(first, second):
        assert (a.n_obs, a.n_ignored) == (b.n_obs, 0)
        same(a, b)
    types = once._types(whole)
    states = [sorted(t.state(spark, types, n).collect(), key=lambda r: r.id) for t, n in ((once, 0), (often, 7))]
    assert states[0] == states[1]


def test_a_replayed_batch_changes_nothing(spark, panel, tmp_path):
    whole, batches = random_batches(panel, 3, 4)
    table = FeatureTable(str(tmp_path / "t"), ROLES, SPEC)
    for k, rows in enumerate(batches):
        table.apply(rows, k)
    seen = sorted(table.features(spark).collect(), key=str)
    table.apply(batches[1], 1)
    table.apply(batches[2].union(batches[2]), 2)  # even with other rows
    assert sorted(table.features(spark).collect(), key=str) == seen
    # a batch that broke off is written anew
    (tmp_path / "t" / "changes" / "batch=2" / "_SUCCESS").unlink()
    table.apply(batches[2], 2)
    assert sorted(table.features(spark).collect(), key=str) == seen


def test_the_update_needs_no_python_worker(spark, panel, tmp_path):
    table = FeatureTable(str(tmp_path / "t"), ROLES, SPEC)
    table.apply(panel(a=[1, 0, 2]), 0)
    plan = table._changed(panel(a=[1, 0, 2, 5]), 1)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Pandas" not in plan and "Arrow" not in plan


def test_rows_without_key_or_date_and_repeated_days(spark, tmp_path):
    rows = [("a", START, 1.0), ("a", START, 9.0), (None, START, 1.0), ("a", None, 1.0), ("b", START, None)]
    table = FeatureTable(str(tmp_path / "t"), ROLES, SPEC)
    table.apply(spark.createDataFrame(rows, "id string, ds date, y double").coalesce(1), 0)
    found = {r.id: r for r in table.features(spark).collect()}
    assert set(found) == {"a", "b"}
    assert (found["a"].lag_1, found["a"].n_obs, found["a"].n_ignored) == (1.0, 1, 1)
    assert (found["b"].lag_1, found["b"].days_since_last_sale, found["b"].rolling_zero_count_7d) == (0.0, 1.0, 1.0)
    table.apply(spark.createDataFrame([], "id string, ds date, y double"), 1)
    assert table.features(spark).count() == 2
