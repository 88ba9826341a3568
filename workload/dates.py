"""Calendar, Fourier, row-key and tail functions."""

from __future__ import annotations

import math

from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from lullcast.functions import arrays
from lullcast.functions.calendar import (
    cyclic_parts,
    date_flags,
    date_parts,
    fourier_terms,
    report_calendar_parts,
)
from lullcast.operators.forecast import attach_future_calendar, future_calendar
from lullcast.operators.models import fit_regressor, model_input
from lullcast.operators.state import StateSpec, series_state
from lullcast.operators.submission import parse_row_keys
from workload.registry import (
    CFG,
    SUPPLIER,
    SUPPLIER_SQL,
    USER,
    case,
    first_event_day,
    rounded,
    six,
    supplier_panel,
    table,
    user_panel,
)


def order_days(spark, sf_dir):
    return table(spark, sf_dir, "orders").select("o_orderkey", F.to_date("o_orderdate").alias("ds"))


ORDER_DAYS = "(SELECT o_orderkey, CAST(o_orderdate AS DATE) AS ds FROM orders)"
PARTS = {
    "dow": "CAST(isodow(ds) - 1 AS INTEGER)",
    "week": "CAST(week(ds) AS INTEGER)",
    "month": "CAST(month(ds) AS INTEGER)",
    "quarter": "CAST(quarter(ds) AS INTEGER)",
    "year": "CAST(year(ds) AS INTEGER)",
}
EDGES = {
    "is_month_start": "CAST(day(ds) = 1 AS INTEGER)",
    "is_month_end": "CAST(ds = last_day(ds) AS INTEGER)",
}
FLAGS = {**EDGES, "is_weekend": "CAST(isodow(ds) IN (6, 7) AS INTEGER)"}
CYCLES = {
    f"{name}_{f}": six(f"{f}(2 * pi() * {PARTS[name]} / {period})")
    for name, period in (("dow", 7), ("week", 52), ("month", 12), ("quarter", 4))
    for f in ("sin", "cos")
}


def fourier_sql(days: str, weekly_k: int = 3, yearly_k: int = 10) -> dict[str, str]:
    return {
        f"{prefix}_{f}_{k}": six(f"{f}({2 * math.pi * k!r} * CAST({days} AS DOUBLE) / {period})")
        for prefix, period, top in (("fw", "7.0", weekly_k), ("fy", "365.25", yearly_k))
        for k in range(1, top + 1)
        for f in ("sin", "cos")
    }


def columns(expressions: dict[str, str]) -> str:
    return ", ".join(f'{e} AS "{name}"' for name, e in expressions.items())


@case(f"SELECT o_orderkey, {columns(PARTS)} FROM {ORDER_DAYS}")
def calendar_date_parts(spark, sf_dir):
    return order_days(spark, sf_dir).withColumns(date_parts(F.col("ds"))).drop("ds")


@case(f"SELECT o_orderkey, {columns(CYCLES)} FROM {ORDER_DAYS}")
def cyclic_date_parts(spark, sf_dir):
    parts = cyclic_parts(F.col("ds"))
    return rounded(order_days(spark, sf_dir).withColumns(parts), *parts).drop("ds")


@case(f"SELECT o_orderkey, {columns(FLAGS)} FROM {ORDER_DAYS}")
def calendar_flags(spark, sf_dir):
    return order_days(spark, sf_dir).withColumns(date_flags(F.col("ds"))).drop("ds")


@case(
    f"""
    SELECT o_orderkey, CAST({PARTS["dow"]} AS DOUBLE) AS dow_code,
           CAST({PARTS["week"]} - 1 AS DOUBLE) AS week_code
    FROM {ORDER_DAYS}
    """
)
def calendar_categories(spark, sf_dir):
    rows = order_days(spark, sf_dir).withColumns(date_parts(F.col("ds")))
    priced = rows.join(table(spark, sf_dir, "orders").select("o_orderkey", "o_totalprice"), "o_orderkey")
    names = ["dow", "week"]
    fitted = fit_regressor(priced, "o_totalprice", names, names, params={"maxIter": 1})
    coded, vector = model_input(fitted, rows)
    codes = coded.select("o_orderkey", vector_to_array(vector).alias("v"))
    return codes.select("o_orderkey", F.col("v")[0].alias("dow_code"), F.col("v")[1].alias("week_code"))


ORDER_ORIGIN = "(SELECT min(CAST(o_orderdate AS DATE)) FROM orders)"


@case(
    f"""
    SELECT o_orderkey, {columns(fourier_sql("t"))}
    FROM (SELECT o_orderkey, date_diff('day', {ORDER_ORIGIN}, ds) AS t FROM {ORDER_DAYS})
    """
)
def fourier_date_terms(spark, sf_dir):
    days = order_days(spark, sf_dir)
    terms = fourier_terms(F.col("ds"), days.select(F.min("ds")).scalar())
    return rounded(days.withColumns(terms), *terms).drop("ds")


REPORT_PARTS = {**PARTS, **EDGES, "dom": "CAST(day(ds) AS INTEGER)"}
del REPORT_PARTS["quarter"], REPORT_PARTS["year"]


@case(f"SELECT o_orderkey, {columns(REPORT_PARTS)} FROM {ORDER_DAYS}")
def report_calendar(spark, sf_dir):
    return order_days(spark, sf_dir).withColumns(report_calendar_parts(F.col("ds"))).drop("ds")


FUTURE = f"""
  SELECT last_ds, CAST(step AS INTEGER) AS step, ds, {columns({**PARTS, **FLAGS, **CYCLES})},
         {columns(fourier_sql("t"))}
  FROM (
    SELECT last_ds, step, CAST(last_ds + CAST(step AS INTEGER) AS DATE) AS ds,
           date_diff('day', (SELECT min(CAST(ts AS DATE)) FROM events),
                     CAST(last_ds + CAST(step AS INTEGER) AS DATE)) AS t
    FROM (SELECT DISTINCT last_ds FROM lasts) CROSS JOIN generate_series(1, 7) g(step))
"""
LASTS = """
lasts AS (SELECT user_id AS id, max(CAST(ts AS DATE)) AS last_ds FROM events GROUP BY 1)
"""


def user_days(spark, sf_dir):
    events = table(spark, sf_dir, "events")
    return events.select(F.col("user_id").alias("id"), F.to_date("ts").alias("ds"))


def future_of_users(spark, sf_dir):
    origin = first_event_day(spark, sf_dir)
    future = future_calendar(user_days(spark, sf_dir), USER, 7, origin, CFG)
    return rounded(future, *CYCLES, *fourier_sql("t"))


@case(f"WITH {LASTS} {FUTURE}")
def future_date_features(spark, sf_dir):
    return future_of_users(spark, sf_dir)


@case(f"WITH {LASTS} SELECT id, f.* FROM lasts JOIN ({FUTURE}) f USING (last_ds)")
def future_lookup(spark, sf_dir):
    lasts = user_days(spark, sf_dir).groupBy("id").agg(F.max("ds").alias("last_ds"))
    steps = lasts.select("id", "last_ds", F.explode(F.sequence(F.lit(1), F.lit(7))).alias("step"))
    return attach_future_calendar(steps, future_of_users(spark, sf_dir))


@case(
    """
    SELECT event_id,
      CASE WHEN event_type <> 'error'
           THEN 'TEST_' || lpad(CAST(user_id % 10 AS VARCHAR), 2, '0') END AS test_name,
      CASE WHEN event_type NOT IN ('error', 'view') THEN CAST(day(ts) AS INTEGER) END AS step
    FROM events
    """
)
def row_keys(spark, sf_dir):
    events = table(spark, sf_dir, "events")
    name = F.concat(F.lit("TEST_"), F.lpad((F.col("user_id") % 10).cast("string"), 2, "0"))
    day = F.dayofmonth("ts").cast("string")
    kind = F.col("event_type")
    key = (
        F.when(kind == "error", F.concat(name, F.lit(" 영업"), day, F.lit("일")))
        .when(kind == "view", F.concat(name, F.lit("+영업일")))
        .otherwise(F.concat(name, F.lit("+영업"), day, F.lit("일+9")))
    )
    keyed = events.select("event_id", key.alias("row_key"))
    return parse_row_keys(keyed, "row_key").drop("row_key")


@case(
    f"""
    WITH {SUPPLIER_SQL},
    numbered AS (
      SELECT id, y, row_number() OVER (PARTITION BY id ORDER BY ds DESC) AS back FROM panel),
    places AS (
      SELECT id, CAST(p AS INTEGER) AS pos
      FROM (SELECT DISTINCT id FROM panel) CROSS JOIN generate_series(0, 365) g(p))
    SELECT places.id, pos, coalesce(y, CAST(0 AS DOUBLE)) AS y
    FROM places LEFT JOIN numbered ON numbered.id = places.id AND back = 366 - pos
    """
)
def padded_tail(spark, sf_dir):
    spec = StateSpec(short_history="zero_pad")
    state = series_state(supplier_panel(spark, sf_dir), SUPPLIER, spec)
    return state.select("id", F.posexplode("hist").alias("pos", "y"))


@case(
    """
    WITH daily AS (SELECT user_id AS id, CAST(ts AS DATE) AS ds, sum(round(value * 100)) AS y
                   FROM events GROUP BY 1, 2),
    days AS (SELECT CAST(unnest(generate_series(min(ds), max(ds), INTERVAL 1 DAY)) AS DATE) AS ds
             FROM daily),
    panel AS (SELECT s.id, d.ds, coalesce(t.y, CAST(0 AS DOUBLE)) AS y
              FROM (SELECT DISTINCT id FROM daily) s CROSS JOIN days d
              LEFT JOIN daily t ON t.id = s.id AND t.ds = d.ds),
    places AS (SELECT id, CAST(p AS INTEGER) AS pos
               FROM (SELECT DISTINCT id FROM panel) CROSS JOIN generate_series(0, 39) g(p))
    SELECT places.id, pos, coalesce(y, CAST(0 AS DOUBLE)) AS y
    FROM places LEFT JOIN (
      SELECT id, y, row_number() OVER (PARTITION BY id ORDER BY ds DESC) AS back FROM panel) n
      ON n.id = places.id AND back = 40 - pos
    """
)
def padded_short_history(spark, sf_dir):
    state = series_state(user_panel(spark, sf_dir), USER, StateSpec())
    return state.select("id", F.posexplode(arrays.pad_left(F.col("hist"), 40)).alias("pos", "y"))
