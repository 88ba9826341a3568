import datetime
import math
import random
import statistics

import pytest
from pyspark.sql import functions as F

from lullcast.config import settings
from lullcast.operators import windows
from lullcast.plans.features import feature_frame
from lullcast.plans.panels import dense_daily_panel
from lullcast.schema import PanelSchema
from lullcast.workspace import MANY_PARTITIONS, compiled_apart

GOLDEN_Y = [0, 0, 3, 0, 2, 0, 0, 0, 5, 0]
GOLDEN = {
    "lag_1": [0, 0, 0, 3, 0, 2, 0, 0, 0, 5],
    "lag_7": [0, 0, 0, 0, 0, 0, 0, 0, 0, 3],
    "roll_mean_7": [0, 0, 0, 1, 0.75, 1, 0.833333, 0.714286, 0.714286, 1.428571],
    "roll_std_7": [0, 0, 0, 1.732051, 1.5, 1.414214, 1.32916, 1.253566, 1.253566, 1.98806],
    "roll_min_7": [0] * 10,
    "roll_max_7": [0, 0, 0, 3, 3, 3, 3, 3, 3, 5],
    "days_since_last_sale": [0, 0, 0, 1, 0, 1, 2, 3, 0, 1],
    "rolling_zero_count_7d": [0, 1, 2, 2, 3, 3, 4, 5, 5, 4],
    "avg_interdemand_interval": [
        0, 0, 0, 0, 0.25, 0.2, 0.333333, 0.571429, 0.875, 0.777778,
    ],
}


def by_day(df, *names):
    rows = df.orderBy("ds").collect()
    return {n: [round(float(r[n]), 6) for r in rows] for n in names}


def test_golden_series(panel, roles):
    df = panel(a=GOLDEN_Y).repartition(3)
    out = windows.lag_rolling_features(df, roles, [1, 7], [7])
    out = windows.intermittency_features(out, roles)
    assert by_day(out, *GOLDEN) == {n: [float(v) for v in vs] for n, vs in GOLDEN.items()}


def test_days_since_start_and_zero_run(panel, roles):
    df = panel(a=GOLDEN_Y)
    counted = windows.days_since_sale(df, roles, pre_first_sale="count")
    runs = windows.zero_run(df, roles)
    wanted = [1, 2, 0, 1, 0, 1, 2, 3, 0, 1]
    assert by_day(counted, "days_since_last_sale")["days_since_last_sale"] == wanted
    assert by_day(runs, "zero_run")["zero_run"] == wanted
    with pytest.raises(ValueError):
        windows.days_since_sale(df, roles, pre_first_sale="other")


def expected_stats(values, i, n):
    known = [v for v in values[max(0, i - n) : i] if v is not None]
    if not known:
        return [0.0] * 4
    deviation = statistics.stdev(known) if len(known) > 1 else 0.0
    return [statistics.fmean(known), deviation, min(known), max(known)]


def test_rolling_against_brute_force(panel, roles):
    rng = random.Random(3)
    series = {
        "mixed": [rng.choice([None, 0, 0, 1.1, rng.uniform(0, 9)]) for _ in range(90)],
        "constant": [4.1] * 70,
        "short": [2.0],
        "unknown": [None] * 40,
        "large": [1e9 + rng.random() for _ in range(60)],
    }
    out = windows.rolling_features(panel(**series), roles, [7, 14, 28, 5])
    for r in out.collect():
        i = (r.ds - datetime.date(2021, 1, 1)).days
        for n in (5, 7, 14, 28):
            got = [r[f"roll_{s}_{n}"] for s in ("mean", "std", "min", "max")]
            for a, b in zip(got, expected_stats(series[r.id], i, n), strict=True):
                assert math.isclose(a, b, rel_tol=1e-9, abs_tol=1e-7), (r.id, i, n, got)
    flat = out.filter("id = 'constant'").agg(F.max("roll_std_28"), F.max("roll_std_7")).first()
    assert flat[0] == 0.0 and flat[1] == 0.0


def test_offsets_count_rows_not_days(spark, roles):
    days = [datetime.date(2021, 1, d) for d in (1, 2, 9)]
    df = spark.createDataFrame([("a", d, float(i)) for i, d in enumerate(days)], "id string, ds date, y double")
    assert by_day(windows.lag_features(df, roles, [1]), "lag_1")["lag_1"] == [0, 0, 1]


def test_null_keys_leave_and_series_do_not_mix(panel, roles, spark):
    df = panel(a=[1, 2], b=[5, 6]).union(
        spark.createDataFrame([(None, datetime.date(2021, 1, 1), 9.0)], "id string, ds date, y double")
    )
    out = windows.report_features(df, roles)
    assert {(r.id, r.y): r.lag_1 for r in out.collect()} == {
        ("a", 1): 0, ("a", 2): 1, ("b", 5): 0, ("b", 6): 5,
    }


def test_one_exchange_for_the_whole_chain(panel, roles):
    frame = feature_frame(panel(a=GOLDEN_Y, b=GOLDEN_Y), roles, settings(), datetime.date(2021, 1, 1))
    plan = frame._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1
    assert plan.count("Sort [") == 1


def test_features_do_not_see_the_present_or_the_future(panel, roles):
    values = [0, 2, 0, 0, 1, 0, 4, 0, 0, 3] * 5
    changed = values[:30] + [v + 7 for v in values[30:]]
    cfg, origin = settings(), datetime.date(2021, 1, 1)
    a, b = (
        {r.ds: r for r in feature_frame(panel(a=v), roles, cfg, origin).collect()}
        for v in (values, changed)
    )
    day = origin + datetime.timedelta(days=30)
    for name in a[day].__fields__:
        if name != "y":
            assert a[day][name] == b[day][name], name
    assert a[day].y != b[day].y


def test_null_target_counts_as_no_sale(panel, roles):
    out = windows.intermittency_features(panel(a=[3, None, None, 1]), roles)
    got = by_day(out, "days_since_last_sale", "rolling_zero_count_7d")
    assert got["days_since_last_sale"] == [0, 1, 2, 0]
    assert got["rolling_zero_count_7d"] == [0, 0, 1, 2]


def test_dense_panel_fills_every_day(spark):
    rows = [("a", "2021-01-03", 2.0), ("a", "2021-01-03", 1.0), ("b", "2021-01-01", 4.0), ("b", "2021-01-05", 1.0)]
    df = spark.createDataFrame(rows, "k string, d string, v double")
    roles = PanelSchema("ds", "y", ("id",))
    out = dense_daily_panel(df, roles, F.to_date("d"), F.col("v"), ["k"])
    got = {}
    for r in out.orderBy("id", "ds").collect():
        got.setdefault(r.id, []).append(r.y)
    assert got == {"a": [0, 0, 3, 0, 0], "b": [4, 0, 0, 0, 1]}


def test_leap_days_and_long_years(spark):
    from lullcast.functions.calendar import date_flags, date_parts

    days = ["2024-02-29", "2023-02-28", "2020-12-31", "2024-12-29", "2024-12-30"]
    df = spark.createDataFrame([(d,) for d in days], "d string").withColumn("d", F.to_date("d"))
    got = [
        (r.week, r.dow, r.year, r.is_month_end)
        for r in df.select(
            *[c.alias(n) for n, c in {**date_parts(F.col("d")), **date_flags(F.col("d"))}.items()]
        ).collect()
    ]
    assert got == [(9, 3, 2024, 1), (9, 1, 2023, 1), (53, 3, 2020, 1), (52, 6, 2024, 0), (1, 0, 2024, 0)]


CHUNKED = {
    "lags": lambda d, s, n: windows.lag_features(d, s, [1, 3, 9], n),
    "rolling": lambda d, s, n: windows.rolling_features(d, s, [7, 14, 28], n),
    "since": lambda d, s, n: windows.days_since_sale(d, s, chunk_rows=n),
    "since_count": lambda d, s, n: windows.days_since_sale(d, s, pre_first_sale="count", chunk_rows=n),
    "intermittency": lambda d, s, n: windows.intermittency_features(d, s, chunk_rows=n),
    "known_before": lambda d, s, n: windows.intermittency_features(d, s, False, "count", n),
    "zero_run": lambda d, s, n: windows.zero_run(d, s, chunk_rows=n),
    "report": lambda d, s, n: windows.report_features(d, s, n),
}


@pytest.mark.parametrize("name", CHUNKED)
def test_chunks_give_the_features_of_whole_series(spark, roles, panel, name):
    """Long runs without a sale over several chunks, nulls, and days that are missing."""
    rng = random.Random(2)
    quiet = lambda n: [0.0] * n
    busy = lambda n: [rng.choice([0, 0, None, 1, 4.5]) for _ in range(n)]
    df = panel(a=quiet(45) + busy(60) + quiet(130) + busy(40), b=busy(3), c=quiet(70))
    df = df.filter("dayofmonth(ds) <> 13")
    whole = CHUNKED[name](df, roles, None)
    for size in (1, 30, 1000):
        found = CHUNKED[name](df, roles, size).select(whole.columns)
        key = lambda r: (r.id, r.ds)
        for a, b in zip(sorted(whole.collect(), key=key), sorted(found.collect(), key=key), strict=True):
            assert tuple(a)[:3] == tuple(b)[:3]
            assert tuple(a)[3:] == pytest.approx(tuple(b)[3:], abs=1e-9)


def test_one_long_series_takes_many_tasks(spark, panel):
    rng = random.Random(3)
    df = panel(a=[rng.choice([0, 2]) for _ in range(400)]).drop("id")
    alone = PanelSchema("ds", "y")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        found = windows.lag_features(df, alone, [1, 7], chunk_rows=50)
        assert len(found.groupBy(F.spark_partition_id()).agg(F.sum("lag_7")).collect()) > 1
        assert found.count() == 400
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")


def test_date_features_are_compiled_apart_from_windows(panel, roles):
    """One method for both is too long for the JIT compiler; partitions stay as they are."""
    rows = panel(a=[1, 0, 2], b=[0, 0, 3]).repartition(3, "id")
    frame = feature_frame(rows, roles, settings(), finite=True)
    plan = frame._jdf.queryExecution().optimizedPlan().toString()
    assert plan.startswith("Project ")
    assert plan.index("Project ") < plan.index(f"Repartition {MANY_PARTITIONS}, false") < plan.index("Window ")
    assert frame.count() == 6
    assert compiled_apart(rows).rdd.getNumPartitions() == 3
