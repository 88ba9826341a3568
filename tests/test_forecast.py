import datetime
import math
import random

from pyspark.sql import functions as F

from lullcast.config import settings
from lullcast.operators.forecast import (
    RuleScorer,
    forecast_long,
    forecast_wide,
    recursive_forecast,
)
from lullcast.operators.state import (
    StateSpec,
    push_observation,
    series_state,
    step_features,
    update_state,
)
from lullcast.operators.windows import intermittency_features, lag_rolling_features
from lullcast.plans.features import feature_frame

START = datetime.date(2021, 1, 1)
RNG = random.Random(11)
LONG = [RNG.choice([0, 0, 0, 1, 2.5, 7]) for _ in range(400)]
SERIES = {"long": LONG, "mid": LONG[:40], "short": [0, 3, 0], "zeros": [0] * 30, "one": [4]}


class EveryFeature:
    """A scorer that reads all features, with a rule that depends on several."""

    def __init__(self, names):
        self.inputs = frozenset(names)

    def score(self, df):
        p = 1 / (1 + F.col("days_since_last_sale") + F.col("rolling_zero_count_7d") / 10)
        q = F.col("lag_1") / 2 + F.col("roll_max_28") / 3 + F.col("roll_std_7") + F.col("fw_sin_1")
        q = q + F.col("lag_7") / 5 + F.col("avg_interdemand_interval") / 9 + F.col("dow") / 50
        return df.withColumns({"p": p, "q": q})


def test_state_features_equal_the_windows(panel, roles):
    """Features from the state must be those the windows give the following row."""
    spec = StateSpec()
    grown = {name: [*values, 99] for name, values in SERIES.items()}
    rows = lag_rolling_features(panel(**grown), roles, spec.lags, spec.windows)
    rows = intermittency_features(rows, roles, include_current=False, pre_first_sale="count")
    want = {r.id: r for r in rows.filter("y = 99").collect()}
    state = series_state(panel(**SERIES), roles, spec)
    for r in step_features(state, spec).collect():
        for name in want[r.id].__fields__:
            if name not in ("id", "ds", "y"):
                assert math.isclose(r[name], want[r.id][name], abs_tol=1e-9), (r.id, name)


def test_pushing_equals_rebuilding(panel, roles):
    spec = StateSpec()
    pushed = push_observation(series_state(panel(**SERIES), roles, spec), F.lit(2.0), spec)
    rebuilt = series_state(panel(**{n: [*v, 2.0] for n, v in SERIES.items()}), roles, spec)
    assert sorted(map(str, pushed.collect())) == sorted(map(str, rebuilt.select(pushed.columns).collect()))


def test_old_and_absent_rows_leave_the_state(panel, roles):
    spec = StateSpec(lags=(1, 2), windows=(2,))
    state = series_state(panel(a=[1, 2], b=[3, 4], c=[5, 6]), roles, spec)
    new = panel(a=[9], b=[8]).withColumn(
        "ds", F.when(F.col("id") == "a", F.lit(datetime.date(2021, 2, 1))).otherwise(F.col("ds"))
    )
    out = {r.id: (r.last_ds.isoformat(), r.n_obs, r.hist) for r in update_state(state, new, roles, spec).collect()}
    assert out == {
        "a": ("2021-02-01", 3, [1, 2, 9]),
        "b": ("2021-01-02", 2, [3, 4]),
        "c": ("2021-01-02", 2, [5, 6]),
    }


def test_zero_padding(panel, roles):
    spec = StateSpec(lags=(1, 3), windows=(4,), short_history="zero_pad")
    row = step_features(series_state(panel(a=[0, 4]), roles, spec), spec).first()
    assert row.hist == [0] * 7 + [4] and row.ring == [0] * 26 + [1, 0]
    assert (row.roll_mean_4, row.lag_3, row.rolling_zero_count_7d) == (1, 0, 6)
    assert math.isclose(row.avg_interdemand_interval, 1 / 28)


def test_recursion_equals_training_features_step_by_step(panel, roles):
    """Append each forecast to the panel and recompute all features by windows."""
    cfg = settings({"cv": {"horizon": 3}})
    frame = feature_frame(panel(**SERIES), roles, cfg, START)
    scorer = EveryFeature([c for c in frame.columns if c not in ("id", "ds", "y")])
    forecast = recursive_forecast(panel(**SERIES), roles, scorer, 0.3, cfg, origin=F.lit(START))
    got = {(r.id, r.step): r for r in forecast_long(forecast, roles, 3).collect()}

    history = {n: list(v) for n, v in SERIES.items()}
    for step in (1, 2, 3):
        grown = {n: [*v, -1] for n, v in history.items()}
        rows = scorer.score(feature_frame(panel(**grown), roles, cfg, START).filter("y = -1"))
        for r in rows.collect():
            yhat = max(0.0, r.q) if r.p > 0.3 else 0.0
            mine = got[r.id, step]
            assert mine.ds == r.ds
            for a, b in ((mine.p, r.p), (mine.q, r.q), (mine.yhat, yhat)):
                assert math.isclose(a, b, abs_tol=1e-9), (r.id, step)
            history[r.id].append(yhat)
    assert any(r.yhat > 0 for r in got.values()) and all(r.yhat >= 0 for r in got.values())


def test_series_start_after_their_own_last_day(panel, roles):
    cfg = settings({"cv": {"horizon": 2}})
    forecast = recursive_forecast(panel(a=[1] * 3, b=[1] * 9), roles, RuleScorer(), 0.2, cfg)
    first = forecast_long(forecast, roles, 2).filter("step = 1").collect()
    assert {r.id: (r.ds - START).days for r in first} == {"a": 3, "b": 9}
    assert forecast_wide(forecast, roles, 2).columns == ["id", "D1", "D2"]


def test_steps_add_no_shuffle_and_long_plans_are_cut(panel, roles):
    def plan(h):
        cfg = settings({"cv": {"horizon": h}})
        df = recursive_forecast(panel(**SERIES), roles, RuleScorer(), 0.2, cfg)
        return df, df._jdf.queryExecution().executedPlan().toString()

    assert plan(2)[1].count("Exchange") == plan(7)[1].count("Exchange") == 1
    df, text = plan(15)
    assert "Window" not in text and "parquet" in text
    assert df.count() == len(SERIES)


def test_unknown_values_stay_unknown_in_the_state(panel, roles):
    spec = StateSpec(lags=(1, 2), windows=(3,))
    row = step_features(series_state(panel(a=[2, None, None]), roles, spec), spec).first()
    assert row.hist == [2, None, None]
    assert (row.lag_1, row.roll_mean_3, row.roll_min_3, row.days_since_last_sale) == (0, 2, 2, 2)
