"""Folds, splits, gates, sampling, reshaping, metrics and thresholds."""

from __future__ import annotations

from pyspark.sql import functions as F

from lullcast.operators import folds, metrics, reshape
from lullcast.operators.forecast import RuleScorer, ZeroScorer
from lullcast.operators.hurdle import best_threshold, hurdle, threshold_scores
from lullcast.operators.sampling import oversample_positives
from lullcast.operators.windows import (
    intermittency_features,
    rolling_features,
)
from lullcast.plans.report import data_report, report_table
from lullcast.sources.readers import read_batches
from lullcast.workspace import materialize, new_path
from workload.registry import (
    BATCH_CFG,
    CFG,
    SUPPLIER,
    SUPPLIER_SQL,
    USER,
    USER_SQL,
    case,
    cents,
    last_event_day,
    last_ship_day,
    rounded,
    ship_days,
    six,
    supplier_panel,
    table,
    user_days,
    user_panel,
)
from workload.windows import BY_ID, RUNS, ZERO, ZERO_RUN

H = 7
RATIO = 0.7


def fold_sql(source: str = "panel", horizon: int = H, ratio: float = RATIO) -> str:
    """CTEs ``ranked`` (days with places) and ``folds``."""
    return f"""
    ranked AS (
      SELECT ds, row_number() OVER (ORDER BY ds) AS place, count(*) OVER () AS n,
             lag(ds) OVER (ORDER BY ds) AS day_before
      FROM (SELECT DISTINCT ds FROM {source})),
    started AS (
      SELECT *, greatest(1, CAST(floor(n * CAST({ratio} AS DOUBLE)) AS BIGINT)) AS start FROM ranked),
    folds AS (
      SELECT CAST((place - 1 - start) // {horizon} AS INTEGER) AS fold,
             min(day_before) AS train_end, min(ds) AS val_start, max(ds) AS val_end
      FROM started WHERE place - 1 >= start
      GROUP BY 1 HAVING count(*) = {horizon})
    """


@case(f"WITH {SUPPLIER_SQL}, {fold_sql()} SELECT * FROM folds")
def rolling_origin_folds(spark, sf_dir):
    return folds.rolling_origin_folds(supplier_panel(spark, sf_dir), "ds", H, RATIO)


@case(
    f"""
    WITH {SUPPLIER_SQL}, {fold_sql()},
    tails AS (SELECT ds, lag(ds, 29) OVER (ORDER BY ds) IS NOT NULL AS long_enough,
                     lag(ds, 28) OVER (ORDER BY ds) AS start FROM ranked)
    SELECT folds.*, CASE WHEN long_enough THEN start END AS tail_start
    FROM folds JOIN tails ON tails.ds = folds.val_start
    """
)
def folds_with_tails(spark, sf_dir):
    return folds.folds_with_tails(supplier_panel(spark, sf_dir), "ds", H, RATIO, 28)


@case(
    f"""
    WITH {SUPPLIER_SQL}, {fold_sql()}
    SELECT id, ds, y, fold, train_end FROM panel
    JOIN folds ON panel.ds BETWEEN val_start AND val_end
    """
)
def fold_rows(spark, sf_dir):
    return folds.validation_rows(supplier_panel(spark, sf_dir), "ds", H, RATIO)


@case(
    f"""
    WITH {SUPPLIER_SQL}
    SELECT id, ds, ds IN (SELECT DISTINCT ds FROM panel ORDER BY ds DESC LIMIT 28)
      AND (SELECT count(DISTINCT ds) FROM panel) > 28 AS is_validation
    FROM panel
    """
)
def tail_split(spark, sf_dir):
    start = folds.calendar_tail_start(ship_days(spark, sf_dir), "ds", 28)
    return folds.tail_split(supplier_panel(spark, sf_dir), "ds", 28, start=start).drop("y")


@case(
    """
    SELECT event_id, CASE WHEN CAST(ts AS DATE) >= (SELECT max(CAST(ts AS DATE)) FROM events) - 6
                     THEN 'valid' ELSE 'train' END AS split
    FROM events
    """
)
def calendar_split(spark, sf_dir):
    events = table(spark, sf_dir, "events").select("event_id", F.to_date("ts").alias("ds"))
    return folds.calendar_split(events, "ds", 7, last=last_event_day(spark, sf_dir)).drop("ds")


@case(
    f"""
    WITH {SUPPLIER_SQL}, marked AS (
      SELECT *, ds >= (SELECT max(ds) FROM panel) - 27 AS late FROM panel)
    SELECT id, max(ds) FILTER (WHERE NOT late) AS train_max,
           min(ds) FILTER (WHERE late) AS valid_min,
           coalesce(max(ds) FILTER (WHERE NOT late) >= min(ds) FILTER (WHERE late), false) AS leaks
    FROM marked GROUP BY id
    """
)
def leakage_check(spark, sf_dir):
    start = folds.calendar_tail_start(ship_days(spark, sf_dir), "ds", 28)
    marked = folds.tail_split(supplier_panel(spark, sf_dir), "ds", 28, start=start)
    return folds.leakage_report(marked, "ds", "is_validation", "id")


@case(
    f"""
    WITH {SUPPLIER_SQL}, {fold_sql()},
    per_day AS (SELECT ds, count(*) FILTER (WHERE y > 0) AS pos,
                       count(*) FILTER (WHERE NOT y > 0) AS neg FROM panel GROUP BY ds),
    placed AS (SELECT p.*, place FROM per_day p JOIN ranked USING (ds)),
    ends AS (SELECT folds.fold, folds.train_end, place AS last_place
             FROM folds JOIN ranked ON ranked.ds = folds.train_end),
    counted AS (
      SELECT fold, train_end, sum(pos) AS n_pos, sum(neg) AS n_neg
      FROM ends JOIN placed
        ON place <= CASE WHEN last_place <= 28 THEN last_place ELSE last_place - 28 END
      GROUP BY 1, 2)
    SELECT fold, train_end, CAST(n_pos AS BIGINT) AS n_pos, CAST(n_neg AS BIGINT) AS n_neg,
           CASE WHEN n_pos = 0 OR n_neg = 0 THEN 'single_class'
                WHEN n_pos < 40000 OR n_neg < 10 THEN 'too_few' ELSE 'fit' END AS gate
    FROM counted
    """
)
def fold_gates(spark, sf_dir):
    panel = supplier_panel(spark, sf_dir)
    return folds.fold_class_balance(panel, SUPPLIER, H, RATIO, 40000, 10)


@case(
    f"""
    WITH {USER_SQL}
    SELECT id, count(*) FILTER (WHERE y > 0) AS n_pos, count(*) FILTER (WHERE NOT y > 0) AS n_neg,
           CASE WHEN count(*) FILTER (WHERE y > 0) = 0 OR count(*) FILTER (WHERE NOT y > 0) = 0
                THEN 'single_class'
                WHEN count(*) FILTER (WHERE y > 0) < 10 OR count(*) FILTER (WHERE NOT y > 0) < 5
                THEN 'too_few' ELSE 'fit' END AS gate
    FROM panel GROUP BY id
    """
)
def series_gates(spark, sf_dir):
    return folds.class_balance(user_panel(spark, sf_dir), USER, 10, 5, "id")


@case(
    f"""
    WITH {SUPPLIER_SQL},
    n AS (SELECT count(*) AS total, count(*) FILTER (WHERE y > 0) AS pos FROM panel),
    numbered AS (
      SELECT id, ds, y, row_number() OVER (
        ORDER BY md5(CAST(id AS VARCHAR) || '|' || CAST(ds AS VARCHAR)), id, ds) - 1 AS i
      FROM panel WHERE y > 0),
    draws AS (
      SELECT CAST(concat('0x', substr(md5('42:' || CAST(k AS VARCHAR)), 1, 15)) AS BIGINT)
             % (SELECT pos FROM n) AS i
      FROM generate_series(0, (SELECT CAST(ceil(CAST(0.3 AS DOUBLE) * total) AS BIGINT) - pos - 1
                               FROM n)) g(k))
    SELECT id, ds, y FROM panel
    UNION ALL SELECT id, ds, y FROM draws JOIN numbered USING (i)
    """
)
def oversampled_positives(spark, sf_dir):
    panel = materialize(supplier_panel(spark, sf_dir), "panel")
    return oversample_positives(panel, "y", ["id", "ds"], 0.3)


STEPS = ", ".join(f"max(y) FILTER (WHERE step = {h}) AS D{h}" for h in range(1, H + 1))


@case(
    f"""
    WITH {USER_SQL.split(", \ndays AS")[0]}
    SELECT id, {STEPS}
    FROM (SELECT *, row_number() OVER ({BY_ID}) AS step FROM daily) WHERE step <= {H} GROUP BY id
    """
)
def wide_steps(spark, sf_dir):
    steps = reshape.first_steps(user_days(spark, sf_dir), USER, H)
    return reshape.wide_by_step(steps, ["id"], "y", H)


@case(
    """
    SELECT 'TEST_' || event_type AS test_name, CAST(user_id AS VARCHAR) AS id,
           CAST(ts AS DATE) AS day, greatest(sum(round(value * 100)), 0) AS y
    FROM events GROUP BY 1, 2, 3
    """
)
def united_batches(spark, sf_dir):
    """One batch file per event type, written and read as one panel."""
    folder = new_path(spark, "batches")
    days = table(spark, sf_dir, "events").groupBy(
        F.col("user_id").alias("shop"), F.to_date("ts").alias("day"), "event_type"
    ).agg(F.sum(cents()).cast("bigint").alias("sold"))
    for r in days.select("event_type").distinct().collect():
        batch = days.filter(F.col("event_type") == r[0]).drop("event_type")
        batch.write.option("header", True).csv(f"{folder}/TEST_{r[0]}.csv")
    panel, _ = read_batches(spark, folder, BATCH_CFG, "shop bigint, day string, sold bigint")
    return panel.select("test_name", "id", "day", F.col("sold").alias("y"))


TYPES = ("click", "error", "purchase", "signup", "view")


@case(
    "SELECT CAST(ts AS DATE) AS ds, "
    + ", ".join(
        f"CASE WHEN count(*) FILTER (WHERE event_type = '{t}') > 0 THEN "
        f"count(*) FILTER (WHERE event_type = '{t}') END AS \"{t}\""
        for t in TYPES
    )
    + " FROM events GROUP BY 1"
)
def wide_by_date(spark, sf_dir):
    events = table(spark, sf_dir, "events")
    counts = events.groupBy(F.to_date("ts").alias("ds"), "event_type").agg(
        F.count("*").alias("n")
    )
    return reshape.wide_by_date(counts, "ds", "event_type", "n")


PAIRS = f"""
pairs AS (
  SELECT id, ds, y,
         (7 - coalesce(sum(CASE WHEN y = 0 THEN {ZERO} + 1 ELSE {ZERO} END) OVER w, 0)) / 7 AS p,
         coalesce(avg(y) OVER w, {ZERO}) AS q
  FROM panel WINDOW w AS ({BY_ID} ROWS BETWEEN 7 PRECEDING AND 1 PRECEDING))
"""
LOSS = "abs(y - {f}) / greatest(abs(y) + abs({f}), CAST(1e-6 AS DOUBLE))"


def rule_pairs(spark, sf_dir):
    """Each day's rule forecast from the 7 days before it: ``id, ds, y, p, q``."""
    rolled = rolling_features(supplier_panel(spark, sf_dir), SUPPLIER, [7])
    featured = intermittency_features(rolled, SUPPLIER)
    return RuleScorer().score(featured).select("id", "ds", "y", "p", "q")


@case(
    f"""
    WITH {SUPPLIER_SQL}, {PAIRS}
    SELECT id, {six(f"100 * sum({LOSS.format(f='q')}) / count(*)")} AS wsmape,
           {six(f"100 * sum((1 + y) * {LOSS.format(f='q')}) / sum(1 + y)")} AS weighted
    FROM pairs GROUP BY id
    """
)
def forecast_error(spark, sf_dir):
    errors = rule_pairs(spark, sf_dir).groupBy("id").agg(
        metrics.wsmape("y", "q").alias("wsmape"),
        metrics.wsmape("y", "q", F.col("y") + 1).alias("weighted"),
    )
    return rounded(errors, "wsmape", "weighted")


@case(
    f"""
    WITH {SUPPLIER_SQL}, {PAIRS},
    grid AS (SELECT CAST(0.01 AS DOUBLE) + i * CAST(0.01 AS DOUBLE) AS t
             FROM generate_series(0, 98) g(i)),
    chances AS (SELECT p, sum({LOSS.format(f='q')}) AS on_loss,
                       sum({LOSS.format(f='CAST(0 AS DOUBLE)')}) AS off_loss, count(*) AS n
                FROM pairs GROUP BY p)
    SELECT {six("t")} AS threshold,
           {six("100 * sum(CASE WHEN p > t THEN on_loss ELSE off_loss END) / sum(n)")} AS score
    FROM grid CROSS JOIN chances GROUP BY t
    """
)
def threshold_errors(spark, sf_dir):
    return rounded(threshold_scores(rule_pairs(spark, sf_dir), CFG), "threshold", "score")


@case(
    f"""
    WITH {SUPPLIER_SQL}, {PAIRS},
    grid AS (SELECT CAST(0.01 AS DOUBLE) + i * CAST(0.01 AS DOUBLE) AS t
             FROM generate_series(0, 98) g(i)),
    chances AS (SELECT p, sum({LOSS.format(f='q')}) AS on_loss,
                       sum({LOSS.format(f='CAST(0 AS DOUBLE)')}) AS off_loss, count(*) AS n
                FROM pairs GROUP BY p),
    scores AS (SELECT t, 100 * sum(CASE WHEN p > t THEN on_loss ELSE off_loss END) / sum(n) AS s
               FROM grid CROSS JOIN chances GROUP BY t)
    SELECT {six("t")} AS threshold, {six("s")} AS score
    FROM scores ORDER BY round(s, 9), t LIMIT 1
    """
)
def chosen_threshold(spark, sf_dir):
    return rounded(best_threshold(rule_pairs(spark, sf_dir), CFG), "threshold", "score")


@case(
    f"""
    WITH {SUPPLIER_SQL}, {PAIRS}
    SELECT id, ds, {six("CASE WHEN p > 0.2 THEN greatest(0, q) ELSE 0 END")} AS yhat FROM pairs
    """
)
def hurdle_forecast(spark, sf_dir):
    pairs = rule_pairs(spark, sf_dir)
    return rounded(pairs.select("id", "ds", hurdle(F.col("p"), F.col("q"), 0.2).alias("yhat")), "yhat")


@case(
    f"""
    WITH {SUPPLIER_SQL}
    SELECT id, ds, {ZERO} AS p, {ZERO} AS q, {ZERO} AS yhat FROM panel
    """
)
def zero_forecast(spark, sf_dir):
    scored = ZeroScorer().score(supplier_panel(spark, sf_dir))
    return scored.select("id", "ds", "p", "q", hurdle(F.col("p"), F.col("q"), 0.5).alias("yhat"))


@case(
    """
    SELECT c_nationkey, count(*) FILTER (WHERE c_mktsegment = 'MACHINERY') AS n_unknown,
           count(*) FILTER (WHERE c_mktsegment <> 'MACHINERY' AND c_acctbal < 0) AS n_negative
    FROM customer GROUP BY 1
    """
)
def prediction_check(spark, sf_dir):
    guess = F.when(F.col("c_mktsegment") != "MACHINERY", F.col("c_acctbal"))
    customers = table(spark, sf_dir, "customer").select("c_nationkey", guess.alias("guess"))
    return metrics.prediction_report(customers, "guess", "c_nationkey")


@case(
    f"""
    WITH {SUPPLIER_SQL}, marked AS (
      SELECT *, CASE WHEN ds >= (SELECT max(ds) FROM panel) - 27 THEN 'valid' ELSE 'train'
                END AS split FROM panel)
    SELECT split, count(*) AS n, {six("var_samp(y)")} AS y_var,
           CAST(count(DISTINCT isodow(ds)) AS INTEGER) AS n_dow,
           CAST(count(DISTINCT month(ds)) AS INTEGER) AS n_month
    FROM marked GROUP BY split
    """
)
def data_report_by_split(spark, sf_dir):
    panel = supplier_panel(spark, sf_dir)
    splits, _ = data_report(report_table(panel, "id", "y", is_panel=True, last=last_ship_day(spark, sf_dir)), "id", "y")
    return rounded(splits, "y_var")


@case(
    f"""
    WITH {SUPPLIER_SQL}, {RUNS},
    rep AS (SELECT y, lag(y, 1) OVER ({BY_ID}) AS l, {ZERO_RUN} AS zero_run FROM runs)
    SELECT bool_and(isfinite(coalesce(l, 0)) AND isfinite(zero_run)) AS x_isfinite,
           bool_and(isfinite(y)) AS y_isfinite,
           bool_or(zero_run IS NULL) AS x_has_nan, bool_or(y IS NULL) AS y_has_nan
    FROM rep
    """
)
def data_report_finite(spark, sf_dir):
    panel = supplier_panel(spark, sf_dir)
    return data_report(report_table(panel, "id", "y", is_panel=True, last=last_ship_day(spark, sf_dir)), "id", "y")[1]
