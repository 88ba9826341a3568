"""Lags, rolling statistics, intermittency measures and the feature chain."""

from __future__ import annotations

from pyspark.sql import functions as F

from lullcast.operators import windows
from lullcast.operators.cleaning import with_series_id
from lullcast.plans.features import feature_frame
from lullcast.plans.panels import daily_totals
from lullcast.schema import SINGLE_SERIES, PanelSchema
from workload.dates import CYCLES, FLAGS, PARTS, columns, fourier_sql
from workload.registry import (
    CFG,
    SUPPLIER,
    SUPPLIER_DAYS_SQL,
    SUPPLIER_SQL,
    USER,
    USER_SQL,
    USER_TYPE,
    USER_TYPE_SQL,
    case,
    first_event_day,
    rounded,
    six,
    ship_day,
    supplier_days,
    supplier_panel,
    table,
    user_panel,
    user_type_days,
)

LAGS = (1, 2, 7, 14, 28, 365)
WINDOWS = (7, 14, 28)
ZERO = "CAST(0 AS DOUBLE)"


def lag_sql(lags=LAGS) -> dict[str, str]:
    return {f"lag_{n}": f"coalesce(lag(y, {n}) OVER w, {ZERO})" for n in lags}


def roll_sql(by: str) -> dict[str, str]:
    out = {}
    for n in WINDOWS:
        w = f"OVER ({by} ROWS BETWEEN {n} PRECEDING AND 1 PRECEDING)"
        out[f"roll_mean_{n}"] = six(f"coalesce(avg(y) {w}, 0)")
        out[f"roll_std_{n}"] = six(f"coalesce(stddev_samp(y) {w}, 0)")
        out[f"roll_min_{n}"] = f"coalesce(min(y) {w}, {ZERO})"
        out[f"roll_max_{n}"] = f"coalesce(max(y) {w}, {ZERO})"
    return out


INEXACT = [f"roll_{s}_{n}" for n in WINDOWS for s in ("mean", "std")]
BY_ID = "PARTITION BY id ORDER BY ds"


@case(f"WITH {SUPPLIER_SQL} SELECT id, ds, {columns(lag_sql())} FROM panel WINDOW w AS ({BY_ID})")
def lag_features(spark, sf_dir):
    panel = supplier_panel(spark, sf_dir)
    return windows.lag_features(panel, SUPPLIER, LAGS).drop("y")


@case(f"WITH {SUPPLIER_SQL} SELECT id, ds, {columns(roll_sql(BY_ID))} FROM panel")
def rolling_features(spark, sf_dir):
    panel = supplier_panel(spark, sf_dir)
    rolled = windows.rolling_features(panel, SUPPLIER, WINDOWS)
    return rounded(rolled, *INEXACT).drop("y")


BY_TYPE = "PARTITION BY user_id, event_type ORDER BY ds"


@case(
    f"""
    WITH {USER_TYPE_SQL}
    SELECT user_id, event_type, ds, {columns({**lag_sql((1, 7)), **roll_sql(BY_TYPE)})} FROM daily
    WINDOW w AS ({BY_TYPE})
    """
)
def gappy_rolling_features(spark, sf_dir):
    days = user_type_days(spark, sf_dir)
    rolled = windows.lag_rolling_features(days, USER_TYPE, (1, 7), WINDOWS)
    return rounded(rolled, *INEXACT).drop("y")


def since_sql(before: str, source: str = "panel", by: str = BY_ID) -> str:
    """A CTE body that adds ``rn`` and ``since``, 0 or ``rn`` before the first sale."""
    return f"""
      SELECT *, CAST(rn - coalesce(max(CASE WHEN y > 0 THEN rn END) OVER (
                 {by} ROWS UNBOUNDED PRECEDING), {before}) AS DOUBLE) AS since
      FROM (SELECT *, row_number() OVER ({by}) AS rn FROM {source})
    """


@case(
    f"""
    WITH {SUPPLIER_SQL}, s AS ({since_sql("rn")})
    SELECT id, ds, since AS days_since_last_sale FROM s
    """
)
def days_since_sale(spark, sf_dir):
    return windows.days_since_sale(supplier_panel(spark, sf_dir), SUPPLIER).drop("y")


@case(
    f"""
    WITH {SUPPLIER_SQL}, s AS ({since_sql("0")})
    SELECT id, ds, since AS days_since_last_sale FROM s
    """
)
def days_since_sale_from_start(spark, sf_dir):
    panel = supplier_panel(spark, sf_dir)
    return windows.days_since_sale(panel, SUPPLIER, pre_first_sale="count").drop("y")


ZEROS = f"""coalesce(sum(CASE WHEN y = 0 THEN {ZERO} + 1 ELSE {ZERO} END) OVER (
  {BY_ID} ROWS BETWEEN 7 PRECEDING AND 1 PRECEDING), {ZERO})"""
INTERVAL = six(
    f"""coalesce(avg(since) OVER (
  {BY_ID} ROWS BETWEEN 28 PRECEDING AND 1 PRECEDING), 0)"""
)


@case(
    f"""
    WITH {SUPPLIER_SQL}, s AS ({since_sql("rn")})
    SELECT id, ds, since AS days_since_last_sale, {ZEROS} AS rolling_zero_count_7d,
           {INTERVAL} AS avg_interdemand_interval
    FROM s
    """
)
def intermittency_features(spark, sf_dir):
    out = windows.intermittency_features(supplier_panel(spark, sf_dir), SUPPLIER)
    return rounded(out, "avg_interdemand_interval").drop("y")


@case(
    f"""
    WITH {SUPPLIER_SQL}, s AS ({since_sql("0")})
    SELECT id, ds, coalesce(lag(since) OVER ({BY_ID}), {ZERO}) AS days_since_last_sale,
           {ZEROS} AS rolling_zero_count_7d, {INTERVAL} AS avg_interdemand_interval
    FROM s
    """
)
def intermittency_known_before(spark, sf_dir):
    panel = supplier_panel(spark, sf_dir)
    out = windows.intermittency_features(panel, SUPPLIER, False, "count")
    return rounded(out, "avg_interdemand_interval").drop("y")


@case(
    f"""
    WITH {SUPPLIER_DAYS_SQL},
    total AS (SELECT ds, sum(y) AS y FROM daily GROUP BY ds)
    SELECT '{SINGLE_SERIES}' AS id, ds, {columns({**lag_sql(), **roll_sql("ORDER BY ds")})}
    FROM total WINDOW w AS (ORDER BY ds)
    """
)
def single_series_features(spark, sf_dir):
    schema = PanelSchema("ds", "y")
    items = table(spark, sf_dir, "lineitem")
    total = daily_totals(items, schema, ship_day(), F.col("l_quantity"), [])
    rolled = windows.lag_rolling_features(total, schema, LAGS, WINDOWS)
    return with_series_id(rounded(rolled, *INEXACT), schema).drop("y")


@case(
    """
    SELECT o_orderkey,
           CASE WHEN o_orderstatus = 'P' THEN 0 ELSE o_totalprice END AS price,
           CASE WHEN o_orderstatus = 'F' THEN '0' ELSE o_orderpriority END AS priority
    FROM orders
    """
)
def zero_filled(spark, sf_dir):
    status = F.col("o_orderstatus")
    orders = table(spark, sf_dir, "orders").select(
        "o_orderkey",
        F.when(status != "P", F.col("o_totalprice")).alias("price"),
        F.when(status != "F", F.col("o_orderpriority")).alias("priority"),
    )
    return windows.zero_fill(orders)


ZERO_RUN = f"""CASE WHEN y = 0 THEN CAST(row_number() OVER (
  PARTITION BY id, run ORDER BY ds) AS DOUBLE) ELSE {ZERO} END"""
RUNS = f"""
runs AS (
  SELECT *, sum(CASE WHEN (y = 0) IS DISTINCT FROM before THEN 1 ELSE 0 END) OVER (
           {BY_ID} ROWS UNBOUNDED PRECEDING) AS run
  FROM (SELECT *, lag(y = 0) OVER ({BY_ID}) AS before FROM panel))
"""


@case(f"WITH {SUPPLIER_SQL}, {RUNS} SELECT id, ds, {ZERO_RUN} AS zero_run FROM runs")
def zero_runs(spark, sf_dir):
    return windows.zero_run(supplier_panel(spark, sf_dir), SUPPLIER).drop("y")


REPORT_ROLL = f"({BY_ID} ROWS BETWEEN 7 PRECEDING AND 1 PRECEDING)"
REPORT_SQL = {
    **lag_sql((1, 7, 14, 28)),
    "ma7": six(f"coalesce(avg(y) OVER {REPORT_ROLL}, 0)"),
    "sum7": f"coalesce(sum(y) OVER {REPORT_ROLL}, {ZERO})",
    "zero_run": ZERO_RUN,
}


@case(
    f"""
    WITH {SUPPLIER_SQL}, {RUNS}
    SELECT id, ds, {columns(REPORT_SQL)} FROM runs WINDOW w AS ({BY_ID})
    """
)
def report_features(spark, sf_dir):
    out = windows.report_features(supplier_panel(spark, sf_dir), SUPPLIER)
    return rounded(out, "ma7").drop("y")


CHAIN = {
    **lag_sql(),
    **roll_sql(BY_ID),
    "days_since_last_sale": f"coalesce(lag(since) OVER ({BY_ID}), {ZERO})",
    "rolling_zero_count_7d": ZEROS,
    "avg_interdemand_interval": INTERVAL,
    **PARTS,
    **CYCLES,
    **FLAGS,
    **fourier_sql("t"),
}
ROUNDED_CHAIN = [*INEXACT, "avg_interdemand_interval", *CYCLES, *fourier_sql("t")]


@case(
    f"""
    WITH {USER_SQL}, s AS ({since_sql("0")}),
    dated AS (SELECT *, date_diff('day', (SELECT min(ds) FROM panel), ds) AS t FROM s)
    SELECT id, ds, y, {columns(CHAIN)} FROM dated WINDOW w AS ({BY_ID})
    """
)
def feature_chain(spark, sf_dir):
    panel = user_panel(spark, sf_dir)
    out = feature_frame(panel, USER, CFG, first_event_day(spark, sf_dir))
    return rounded(out, *ROUNDED_CHAIN)


@case(
    f"""
    WITH {SUPPLIER_DAYS_SQL}
    SELECT id, ds, y, {columns({**lag_sql((1, 7)), **PARTS, **CYCLES, **FLAGS})}
    FROM daily WINDOW w AS ({BY_ID})
    """
)
def feature_chain_without_intermittency(spark, sf_dir):
    days = supplier_days(spark, sf_dir)
    features = {
        "lags": [1, 7],
        "rollings": [],
        "fourier": {"weekly_K": 0, "yearly_K": 0},
        "intermittency": {"enable": False},
    }
    return rounded(feature_frame(days, SUPPLIER, {"features": features}), *CYCLES)
