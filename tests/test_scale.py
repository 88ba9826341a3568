"""Plans and results when one series holds a third of all rows."""

import datetime
import random
import re

import pytest
from pyspark.sql import functions as F

from lullcast.config import settings
from lullcast.operators.cleaning import keep_first, prepare_panel
from lullcast.operators.folds import fold_class_balance, validation_rows
from lullcast.operators.forecast import RuleScorer, recursive_forecast
from lullcast.operators.hurdle import threshold_scores
from lullcast.operators.sampling import number_rows
from lullcast.operators.state import StateSpec, series_state
from lullcast.plans.panels import daily_totals, dense_daily_panel
from lullcast.schema import PanelSchema
from lullcast.sources.readers import read_panel
from lullcast.plans.training import train

ROLES = PanelSchema("ds", "y", ("id",))
DAYS = 50


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture(scope="module")
def sales(spark):
    """30,000 transactions; a third of them belong to one series and a third to one day."""
    n = F.col("id")
    return spark.range(30_000).repartition(6).select(
        F.when(n % 3 == 0, "hot").otherwise(F.concat(F.lit("s"), n % 40)).alias("key"),
        F.when(n % 3 == 1, 7).otherwise(F.pmod(F.xxhash64(n), F.lit(DAYS))).cast("int").alias("day"),
        (n % 5).cast("double").alias("value"),
        n.alias("line"),
    ).withColumn("date", F.date_add(F.lit("2022-01-01").cast("date"), F.col("day")))


def test_hot_series_reach_the_windows_as_days(sales):
    totals = daily_totals(sales, ROLES, F.col("date"), F.col("value"), ["key"])
    text = plan(totals)
    assert text.index("functions=[sum") < text.index("Exchange") < text.index("functions=[partial_sum")
    assert re.search(r"hashpartitioning\(id#\d+, ds#\d+", text)
    panel = dense_daily_panel(sales, ROLES, F.col("date"), F.col("value"), ["key"])
    sizes = panel.groupBy("id").count().select("count").distinct().collect()
    assert [r[0] for r in sizes] == [DAYS]
    total, kept = sales.agg(F.sum("value")).first()[0], panel.agg(F.sum("y")).first()[0]
    assert total == kept


def test_dedup_sends_one_row_per_task_and_pair(sales):
    roles = PanelSchema("date", "value", ("key",))
    out = keep_first(sales, roles, ["line"])
    assert re.search(r"WindowGroupLimit.*Partial", plan(out))
    want = {}
    for r in sales.collect():
        pair = (r.key, r.date)
        want[pair] = min(want.get(pair, (r.line, r.value)), (r.line, r.value))
    assert {((r.key, r.date), (r.line, r.value)) for r in out.collect()} == set(want.items())


def test_numbering_spreads_a_hot_series(sales):
    numbered = number_rows(sales, ["key", "date", "line"], "n")
    assert "SinglePartition" not in re.split("BroadcastExchange", plan(numbered))[0]
    hot = numbered.filter("key = 'hot'").select(F.floor(F.col("n") / 3000).alias("part"))
    assert hot.distinct().count() == 10


def test_state_is_bounded(sales):
    panel = dense_daily_panel(sales, ROLES, F.col("date"), F.col("value"), ["key"])
    spec = StateSpec(lags=(1, 7), windows=(7,))
    longest = series_state(panel, ROLES, spec).agg(F.max(F.size("hist")), F.max(F.size("ring"))).first()
    assert tuple(longest) == (8, 28)


def test_no_operator_multiplies_rows_by_a_grid_or_by_folds(sales):
    panel = dense_daily_panel(sales, ROLES, F.col("date"), F.col("value"), ["key"])
    pairs = panel.select("y", (F.col("y") / 20).alias("p"), F.lit(1.0).alias("q"))
    for df in (
        threshold_scores(pairs, settings()),
        validation_rows(panel, "ds", 7, 0.5),
        fold_class_balance(panel, ROLES, 7, 0.5, 1, 1, 7),
        recursive_forecast(panel, ROLES, RuleScorer(), 0.2, settings()),
    ):
        text = plan(df)
        assert "CartesianProduct" not in text and "NestedLoopJoin" not in text


def test_negative_targets_never_reach_the_models(spark, tmp_path):
    """Returns (negative quantities) of several shops, in the middle and at the end."""
    rng = random.Random(12)
    first = datetime.date(2023, 3, 15)
    rows = [
        (first + datetime.timedelta(days=k), shop, -rng.randint(1, 9) if k in (17, 39) else rng.choice([0, 2, 5]))
        for shop in ("north", "south", "east", "west")
        for k in range(40)
    ]
    path = tmp_path / "quantities.csv"
    path.write_text("day,shop,pieces\n" + "".join(f"{d},{s},{y}\n" for d, s, y in rows), encoding="utf-8")
    cfg = settings(
        {
            "data": {"date_col": "day", "target_col": "pieces", "id_cols": ["shop"], "non_negative_cols": ["pieces"]},
            "features": {"lags": [1, 7], "rollings": [7]},
            "cv": {"horizon": 3, "init_train_ratio": 0.8, "tail_days": 100},
            "model": {"classifier": {"maxIter": 2}, "regressor": {"maxIter": 2}},
        }
    )
    panel, roles = read_panel(spark, str(path), cfg)
    found = {(r.day, r.shop): r.pieces for r in panel.collect()}
    assert found == {(d, s): max(y, 0) for d, s, y in rows}
    made = train(panel, roles, cfg)
    assert made.folds == 2 and made.features and 0 < made.threshold < 1


def test_prepared_panel_against_brute_force(spark):
    rng = random.Random(8)
    rows = [
        (rng.choice(["a", "a", "a", " b", None]), f"2022-01-{rng.randint(1, 9):02d}", rng.uniform(-2, 4), i)
        for i in range(300)
    ]
    df = spark.createDataFrame(rows, "store_id string, date string, sales double, line int")
    roles = PanelSchema("date", "sales", ("store_id",))
    want = {}
    for key, date, y, _ in rows:
        if key is not None:
            want.setdefault((key.strip(), date), max(y, 0.0))
    out = prepare_panel(df.repartition(5), roles, settings(), ["line"])
    assert {(r.id, str(r.date)): r.sales for r in out.collect()} == want
