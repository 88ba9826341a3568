"""State, recursion, incremental updates and filling of templates."""

from __future__ import annotations

from dataclasses import replace

from pyspark.sql import functions as F

from lullcast.config import settings
from lullcast.operators.forecast import (
    RuleScorer,
    ZeroScorer,
    forecast_long,
    forecast_wide,
    recursive_forecast,
)
from lullcast.operators.reshape import first_steps, predictions_with_truth
from lullcast.operators.state import (
    StateSpec,
    push_observation,
    series_state,
    step_features,
    update_features,
)
from lullcast.operators.submission import fill_by_id, fill_by_row_key
from lullcast.schema import PanelSchema
from lullcast.streaming.updates import FeatureTable
from lullcast.workspace import materialize, new_path
from workload.dates import columns
from workload.registry import (
    CFG,
    SUPPLIER,
    SUPPLIER_SQL,
    USER,
    USER_SQL,
    case,
    last_ship_day,
    rounded,
    six,
    supplier_panel,
    table,
    user_panel,
)
from workload.windows import LAGS, WINDOWS, ZERO, since_sql

SPEC = StateSpec()
THRESHOLD = 0.2


PADDED = "list_concat(list_transform(range({n}), lambda x: CAST(0 AS DOUBLE)), {values})"


def recursion_sql(
    horizon: int, threshold: float, source: str = "panel", padded: bool = False
) -> str:
    """CTEs ``step0 … stepH``: the last 28 values as a list that each forecast joins."""
    values = "list(y ORDER BY ds)"
    values = PADDED.format(n=28, values=values) if padded else values
    parts = [
        f"""step0 AS (SELECT id, max(ds) AS last_ds, ({values})[-28:] AS h
            FROM {source} GROUP BY id)"""
    ]
    for k in range(1, horizon + 1):
        kept = "".join(f", p_{j}, q_{j}, yhat_{j}" for j in range(1, k))
        parts.append(
            f"""scored{k} AS (
              SELECT id, last_ds, h{kept},
                     (7 - len(list_filter(h[-7:], lambda x: x = 0))) / CAST(7 AS DOUBLE) AS p_{k},
                     list_sum(h[-7:]) / len(h[-7:]) AS q_{k} FROM step{k - 1}),
            given{k} AS (
              SELECT *, CASE WHEN p_{k} > {threshold} THEN greatest({ZERO}, q_{k}) ELSE {ZERO} END
                     AS yhat_{k} FROM scored{k}),
            step{k} AS (SELECT * EXCLUDE (h), list_append(h, yhat_{k})[-28:] AS h FROM given{k})"""
        )
    return ", ".join(parts)


def long_sql(horizon: int) -> str:
    return " UNION ALL ".join(
        f"""SELECT id, CAST({k} AS INTEGER) AS step, CAST(last_ds + {k} AS DATE) AS ds,
        {six(f"yhat_{k}")} AS yhat, {six(f"p_{k}")} AS p, {six(f"q_{k}")} AS q FROM step{horizon}"""
        for k in range(1, horizon + 1)
    )


def horizon(h: int) -> dict:
    return settings({"cv": {"horizon": h}})


def rule_forecast(panel, schema, h: int = 7):
    return recursive_forecast(panel, schema, RuleScorer(), THRESHOLD, horizon(h))


@case(f"WITH {SUPPLIER_SQL}, {recursion_sql(7, THRESHOLD)} {long_sql(7)}")
def recursive_rule_forecast(spark, sf_dir):
    forecast = rule_forecast(supplier_panel(spark, sf_dir), SUPPLIER)
    return rounded(forecast_long(forecast, SUPPLIER, 7), "yhat", "p", "q")


@case(
    f"""
    WITH {USER_SQL}, {recursion_sql(7, THRESHOLD)}
    SELECT id, {", ".join(f"{six(f'yhat_{k}')} AS D{k}" for k in range(1, 8))} FROM step7
    """
)
def wide_rule_forecast(spark, sf_dir):
    forecast = rule_forecast(user_panel(spark, sf_dir), USER)
    return rounded(forecast_wide(forecast, USER, 7), *[f"D{k}" for k in range(1, 8)])


@case(f"WITH {USER_SQL}, {recursion_sql(16, 0.8)} {long_sql(16)}")
def long_rule_forecast(spark, sf_dir):
    panel = user_panel(spark, sf_dir)
    forecast = recursive_forecast(panel, USER, RuleScorer(), 0.8, horizon(16))
    return rounded(forecast_long(forecast, USER, 16), "yhat", "p", "q")


@case(
    f"""
    WITH {USER_SQL}
    SELECT id, {", ".join(f"{ZERO} AS D{k}" for k in range(1, 8))} FROM (SELECT DISTINCT id FROM panel)
    """
)
def recursive_zero_forecast(spark, sf_dir):
    panel = user_panel(spark, sf_dir)
    return forecast_wide(recursive_forecast(panel, USER, ZeroScorer(), 0.5, CFG), USER, 7)


CUT = "(SELECT max(ds) - 7 FROM panel)"


@case(
    f"""
    WITH {SUPPLIER_SQL}, past AS (SELECT * FROM panel WHERE ds <= {CUT}),
    {recursion_sql(7, THRESHOLD, "past")}, forecast AS ({long_sql(7)}),
    truth AS (SELECT id, y, CAST(row_number() OVER (PARTITION BY id ORDER BY ds) AS INTEGER) AS step
              FROM panel WHERE ds > {CUT})
    SELECT id, step, f.ds, yhat, p, q, y FROM forecast f JOIN truth USING (id, step)
    """
)
def forecasts_with_truth(spark, sf_dir):
    panel = materialize(supplier_panel(spark, sf_dir), "panel")
    cut = F.date_sub(last_ship_day(spark, sf_dir), 7)
    past, ahead = panel.filter(F.col("ds") <= cut), panel.filter(F.col("ds") > cut)
    forecast = forecast_long(rule_forecast(past, SUPPLIER), SUPPLIER, 7)
    truth = first_steps(ahead, SUPPLIER, 7)
    return rounded(predictions_with_truth(forecast, truth, ["id"], "y"), "yhat", "p", "q")


def list_features(values: str, sinces: str) -> dict[str, str]:
    """Features of the row after the last element of two SQL lists."""
    out = {f"lag_{n}": f"coalesce({values}[-{n}], {ZERO})" for n in LAGS}
    for n in WINDOWS:
        w = f"{values}[-{n}:]"
        out[f"roll_mean_{n}"] = six(f"list_avg({w})")
        out[f"roll_std_{n}"] = six(f"coalesce(list_stddev_samp({w}), 0)")
        out[f"roll_min_{n}"] = f"list_min({w})"
        out[f"roll_max_{n}"] = f"list_max({w})"
    out["days_since_last_sale"] = f"{sinces}[-1]"
    zeros = f"len(list_filter({values}[-7:], lambda x: x = 0))"
    out["rolling_zero_count_7d"] = f"CAST({zeros} AS DOUBLE)"
    out["avg_interdemand_interval"] = six(f"list_avg({sinces}[-28:])")
    return out


STEP_FEATURES = columns(list_features("h", "s"))
ROUNDED_STEP = [f"roll_{s}_{n}" for n in WINDOWS for s in ("mean", "std")]
ROUNDED_STEP += ["avg_interdemand_interval"]
NEXT_ROW = f"""
SELECT id, last_ds, n_obs, {STEP_FEATURES}
FROM (SELECT id, max(ds) AS last_ds, CAST(count(*) AS INTEGER) AS n_obs,
             list(y ORDER BY ds) AS h, list(since ORDER BY ds) AS s
      FROM since GROUP BY id)
"""


@case(f"WITH {SUPPLIER_SQL}, since AS ({since_sql('0')}) {NEXT_ROW}")
def next_step_features(spark, sf_dir):
    state = series_state(supplier_panel(spark, sf_dir), SUPPLIER, SPEC)
    return rounded(step_features(state, SPEC), *ROUNDED_STEP).drop("hist", "ring")


NEXT_PADDED_ROW = NEXT_ROW.replace(
    "list(y ORDER BY ds)", PADDED.format(n=366, values="list(y ORDER BY ds)")
).replace("list(since ORDER BY ds)", PADDED.format(n=28, values="list(since ORDER BY ds)"))
ZERO_PAD = settings({"features": {"short_history": "zero_pad"}})


@case(f"WITH {USER_SQL}, since AS ({since_sql('0')}) {NEXT_PADDED_ROW}")
def padded_step_features(spark, sf_dir):
    spec = StateSpec.from_settings(ZERO_PAD)
    state = series_state(user_panel(spark, sf_dir), USER, spec)
    return rounded(step_features(state, spec), *ROUNDED_STEP).drop("hist", "ring")


@case(
    f"WITH {USER_SQL}, {recursion_sql(7, THRESHOLD, padded=True)} {long_sql(7)}"
)
def padded_rule_forecast(spark, sf_dir):
    panel = user_panel(spark, sf_dir)
    forecast = recursive_forecast(panel, USER, RuleScorer(), THRESHOLD, ZERO_PAD)
    return rounded(forecast_long(forecast, USER, 7), "yhat", "p", "q")


@case(f"WITH {USER_SQL}, since AS ({since_sql('0')}) {NEXT_ROW}")
def updated_features(spark, sf_dir):
    panel = user_panel(spark, sf_dir)
    last = table(spark, sf_dir, "events").select(F.max(F.to_date("ts"))).scalar()
    state = series_state(panel.filter(F.col("ds") < last), USER, SPEC)
    updated = update_features(state, panel.filter(F.col("ds") == last), USER, SPEC)
    return rounded(updated, *ROUNDED_STEP).drop("hist", "ring")


@case(
    f"""
    WITH {USER_SQL}, since AS ({since_sql('0')})
    SELECT id, ds AS day, y, since FROM (
      SELECT *, row_number() OVER (PARTITION BY id ORDER BY ds DESC) AS back FROM since)
    WHERE back <= 28
    """
)
def pushed_state(spark, sf_dir):
    panel = user_panel(spark, sf_dir)
    last = table(spark, sf_dir, "events").select(F.max(F.to_date("ts"))).scalar()
    state = series_state(panel.filter(F.col("ds") < last), USER, SPEC)
    newest = panel.filter(F.col("ds") == last).select("id", F.col("y").alias("new_y"))
    moved = push_observation(state.join(newest, "id"), "new_y", SPEC)
    recent = F.slice("hist", F.size("hist") - F.size("ring") + 1, F.size("ring"))
    paired = F.arrays_zip(recent.alias("y"), F.col("ring").alias("since"))
    rows = moved.select("id", "last_ds", F.size("ring").alias("n"), F.posexplode(paired))
    return rows.select(
        "id",
        F.expr("date_sub(last_ds, n - 1 - pos)").alias("day"),
        F.col("col")["y"].alias("y"),
        F.col("col")["since"].alias("since"),
    )


@case(
    f"""
    WITH {SUPPLIER_SQL}, {recursion_sql(7, THRESHOLD)}
    SELECT s_suppkey AS id, s_name,
           {", ".join(
               f"coalesce(CASE WHEN s_nationkey % 7 = {k - 1} THEN s_acctbal END, "
               f"{six(f'yhat_{k}')}) AS D{k}" for k in range(1, 8))},
           CAST(NULL AS DOUBLE) AS D8
    FROM supplier LEFT JOIN step7 ON s_suppkey = step7.id
    """
)
def filled_template(spark, sf_dir):
    forecast = rule_forecast(supplier_panel(spark, sf_dir), SUPPLIER)
    names = [f"D{k}" for k in range(1, 8)]
    wide = rounded(forecast_wide(forecast, SUPPLIER, 7), *names)
    cells = [
        F.when(F.col("s_nationkey") % 7 == k - 1, F.col("s_acctbal")).alias(f"D{k}")
        for k in range(1, 9)
        if k < 8
    ]
    template = table(spark, sf_dir, "supplier").select(
        F.col("s_suppkey").alias("id"),
        "s_name",
        *cells,
        F.lit(None).cast("double").alias("D8"),
    )
    return fill_by_id(template, wide)


KINDS = {
    " click ": "click", "sign　up.1": "sign_up.1", "view": "view", "err`or ": "err`or",
    "purchase 1.5L": "purchase_1.5L", "other": "other",
}
#: How the events' types are named in the forecasts.
NAMES = {"signup": "sign_up.1", "error": "err`or", "purchase": "purchase_1.5L"}
NAMED_TYPE = "CASE event_type " + " ".join(
    f"WHEN '{kind}' THEN '{name}'" for kind, name in NAMES.items()
) + " ELSE event_type END"
BATCH_SQL = "'TEST_' || lpad(CAST(user_id % 10 AS VARCHAR), 2, '0')"


@case(
    f"""
    WITH base AS (
      SELECT {BATCH_SQL} AS test_name, CAST(day(ts) AS INTEGER) AS step,
        {NAMED_TYPE} AS event_type FROM events),
    hits AS (
      SELECT test_name, step, event_type, CAST(count(*) AS DOUBLE) AS yhat FROM base
      WHERE step <= 7 GROUP BY 1, 2, 3),
    template AS (SELECT DISTINCT test_name, step FROM base)
    SELECT test_name || CASE WHEN step = 9 THEN '' ELSE '+영업' || step || '일' END AS row_key,
           {", ".join(
               f'''coalesce((SELECT yhat FROM hits WHERE hits.test_name = t.test_name
               AND hits.step = t.step AND hits.event_type = '{kind}'), -1) AS "{name}"'''
               for name, kind in KINDS.items())}
    FROM template t
    """
)
def filled_row_keys(spark, sf_dir):
    events = table(spark, sf_dir, "events")
    batch = F.concat(F.lit("TEST_"), F.lpad((F.col("user_id") % 10).cast("string"), 2, "0"))
    base = events.select(
        batch.alias("test_name"), F.dayofmonth("ts").alias("step"), F.expr(NAMED_TYPE).alias("id")
    )
    predictions = (
        base.filter("step <= 7")
        .groupBy("test_name", "step", "id")
        .agg(F.count("*").cast("double").alias("yhat"))
    )
    day = F.concat(F.lit("+영업"), F.col("step").cast("string"), F.lit("일"))
    key = F.concat("test_name", F.when(F.col("step") == 9, "").otherwise(day))
    template = base.select("test_name", "step").distinct()
    cells = [F.lit(-1.0).alias(name) for name in KINDS]
    template = template.select(key.alias("row_key"), *cells)
    return fill_by_row_key(template, predictions, "row_key")


STREAM_SPEC = StateSpec(lags=(1, 2, 7), windows=(7, 14))
STREAM_NAMES = ["roll_mean_7", "roll_std_7", "roll_mean_14", "roll_std_14"]
STREAM_NAMES += ["avg_interdemand_interval"]


def _stream_sql(intermittency: bool = True) -> str:
    w = "(PARTITION BY id ORDER BY ds ROWS BETWEEN {} PRECEDING AND CURRENT ROW)"
    out = {f"lag_{n}": f"coalesce(lag(y, {n - 1}) OVER v, {ZERO})" for n in STREAM_SPEC.lags}
    for n in STREAM_SPEC.windows:
        frame = w.format(n - 1)
        out[f"roll_mean_{n}"] = six(f"avg(y) OVER {frame}")
        out[f"roll_std_{n}"] = six(f"coalesce(stddev_samp(y) OVER {frame}, 0)")
        out[f"roll_min_{n}"] = f"min(y) OVER {frame}"
        out[f"roll_max_{n}"] = f"max(y) OVER {frame}"
    if not intermittency:
        return columns(out)
    out["days_since_last_sale"] = "since"
    out["rolling_zero_count_7d"] = (
        f"sum(CASE WHEN y = 0 THEN {ZERO} + 1 ELSE {ZERO} END) OVER {w.format(6)}"
    )
    out["avg_interdemand_interval"] = six(f"avg(since) OVER {w.format(27)}")
    return columns(out)


@case(
    f"""
    WITH {USER_SQL}, s AS ({since_sql('0')})
    SELECT id, ds, rn AS n_obs, CAST(0 AS BIGINT) AS n_ignored, {_stream_sql()}
    FROM s WINDOW v AS (PARTITION BY id ORDER BY ds)
    """
)
def streamed_features(spark, sf_dir):
    return rounded(_streamed(spark, sf_dir, STREAM_SPEC), *STREAM_NAMES)


@case(
    f"""
    WITH {USER_SQL}, s AS ({since_sql('0')})
    SELECT id, ds, rn AS n_obs, CAST(0 AS BIGINT) AS n_ignored, {_stream_sql(False)}
    FROM s WINDOW v AS (PARTITION BY id ORDER BY ds)
    """
)
def streamed_lags_and_windows(spark, sf_dir):
    spec = replace(STREAM_SPEC, intermittency=False)
    return rounded(_streamed(spark, sf_dir, spec), *STREAM_NAMES[:-1])


def _streamed(spark, sf_dir, spec):
    source, out, marks = (new_path(spark, f"stream-{n}") for n in ("in", "out", "marks"))
    user_panel(spark, sf_dir).write.parquet(source)
    rows = spark.readStream.schema("id bigint, ds date, y double").parquet(source)
    features = FeatureTable(out, USER, spec)
    features.start(rows, marks).awaitTermination()
    return features.features(spark)


BATCHED = PanelSchema("ds", "y", ("id",), "test_name")


@case(
    f"""
    WITH daily AS (
      SELECT {BATCH_SQL} || '/' || event_type AS id, CAST(ts AS DATE) AS ds,
             CAST(count(*) AS DOUBLE) AS y FROM events GROUP BY 1, 2),
    {recursion_sql(7, THRESHOLD, "daily")}, forecast AS ({long_sql(7)})
    SELECT split_part(id, '/', 1) AS test_name, split_part(id, '/', 2) AS id, step, ds, yhat, p, q
    FROM forecast
    """
)
def batched_rule_forecast(spark, sf_dir):
    events = table(spark, sf_dir, "events")
    batch = F.concat(F.lit("TEST_"), F.lpad((F.col("user_id") % 10).cast("string"), 2, "0"))
    days = events.groupBy(
        batch.alias("test_name"), F.col("event_type").alias("id"), F.to_date("ts").alias("ds")
    ).agg(F.count("*").cast("double").alias("y"))
    forecast = rule_forecast(days, BATCHED)
    return rounded(forecast_long(forecast, BATCHED, 7), "yhat", "p", "q")
