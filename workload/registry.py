"""Registration of queries with their SQL, and the panels they start from."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType

from lullcast.config import settings
from lullcast.plans.panels import daily_totals, dense_daily_panel
from lullcast.schema import PanelSchema

Query = Callable[[SparkSession, str], DataFrame]


@dataclass(frozen=True)
class Case:
    query: Query
    sql: str | None


CASES: dict[str, Case] = {}

SUPPLIER = PanelSchema("ds", "y", ("id",))
USER = PanelSchema("ds", "y", ("id",))
USER_TYPE = PanelSchema("ds", "y", ("user_id", "event_type"))
CFG = settings()
BATCH_CFG = settings(
    {
        "data": {
            "date_col_candidates": ["day"],
            "target_col_candidates": ["sold"],
            "id_cols": ["shop", "menu"],
        }
    }
)


def case(sql: str | None = None) -> Callable[[Query], Query]:
    """Register the function under its own name."""

    def register(query: Query) -> Query:
        assert query.__name__ not in CASES
        CASES[query.__name__] = Case(query, sql)
        return query

    return register


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


#: More columns that are rounded without decimal numbers make one method that is too long for the
#: JIT compiler (``feature_chain``, 41 columns, did not end in 100 s for 45); results are the same.
FEW = 6


def rounded(df: DataFrame, *names: str) -> DataFrame:
    """Six digits, for values whose last bits depend on the engine."""
    doubles = {f.name for f in df.schema if isinstance(f.dataType, DoubleType)} if len(names) <= FEW else set()
    return df.withColumns({n: _six_digits(F.col(n)) if n in doubles else F.round(n, 6) for n in names})


def _six_digits(x: Column) -> Column:
    """What ``F.round(x, 6)`` gives. That makes a decimal number of every value; here only values
    near the middle of two results, large ones and those that are no numbers take that way."""
    millionths = x * 1e6
    nearest = F.rint(millionths)
    plain = (F.abs(millionths - nearest) < 0.499) & (F.abs(nearest) < 1e12)
    return F.when(plain, (nearest + 0.0) / 1e6).otherwise(F.round(x, 6))  # 0.0: no negative zero


def six(expression: str) -> str:
    """The SQL counterpart of ``rounded``, with no negative zero."""
    value = f"round(CAST({expression} AS DOUBLE), 6)"
    return f"CASE WHEN {value} = 0 THEN CAST(0 AS DOUBLE) ELSE {value} END"


def ship_day() -> Column:
    return F.to_date("l_shipdate")


def supplier_panel(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Daily quantity per supplier, 0 on days without a shipment: ``id, ds, y``."""
    items = table(spark, sf_dir, "lineitem")
    return dense_daily_panel(items, SUPPLIER, ship_day(), F.col("l_quantity"), ["l_suppkey"])


def supplier_days(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The shipment days only."""
    items = table(spark, sf_dir, "lineitem")
    return daily_totals(items, SUPPLIER, ship_day(), F.col("l_quantity"), ["l_suppkey"])


def first_ship_day(spark: SparkSession, sf_dir: str) -> Column:
    return table(spark, sf_dir, "lineitem").select(F.min(ship_day())).scalar()


def ship_days(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every shipment's day, the narrow side of the supplier panel."""
    return table(spark, sf_dir, "lineitem").select(ship_day().alias("ds"))


def last_ship_day(spark: SparkSession, sf_dir: str) -> Column:
    return table(spark, sf_dir, "lineitem").select(F.max(ship_day())).scalar()


def last_event_day(spark: SparkSession, sf_dir: str) -> Column:
    return table(spark, sf_dir, "events").select(F.max(F.to_date("ts"))).scalar()


def cents() -> Column:
    return F.round(F.col("value") * 100)


def user_panel(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Daily value per user in cents, 0 on other days: ``id, ds, y``."""
    events = table(spark, sf_dir, "events")
    return dense_daily_panel(events, USER, F.to_date("ts"), cents(), ["user_id"])


def user_days(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The days with an event only, those whose values sum up to 0 included."""
    events = table(spark, sf_dir, "events")
    return daily_totals(events, USER, F.to_date("ts"), cents(), ["user_id"])


def first_event_day(spark: SparkSession, sf_dir: str) -> Column:
    return table(spark, sf_dir, "events").select(F.min(F.to_date("ts"))).scalar()


def user_type_days(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events per user, type and day; days without events are absent."""
    events = table(spark, sf_dir, "events")
    return daily_totals(
        events, USER_TYPE, F.to_date("ts"), F.lit(1), ["user_id", "event_type"]
    )


_DENSE = """
days AS (
  SELECT CAST(unnest(generate_series(min(ds), max(ds), INTERVAL 1 DAY)) AS DATE) AS ds
  FROM daily),
panel AS (
  SELECT s.id, d.ds, coalesce(t.y, CAST(0 AS DOUBLE)) AS y
  FROM (SELECT DISTINCT id FROM daily) s CROSS JOIN days d
  LEFT JOIN daily t ON t.id = s.id AND t.ds = d.ds)
"""

SUPPLIER_DAYS_SQL = """
daily AS (
  SELECT l_suppkey AS id, CAST(l_shipdate AS DATE) AS ds, sum(l_quantity) AS y
  FROM lineitem GROUP BY 1, 2)
"""
SUPPLIER_SQL = f"{SUPPLIER_DAYS_SQL}, {_DENSE}"
USER_SQL = f"""
daily AS (
  SELECT user_id AS id, CAST(ts AS DATE) AS ds, sum(round(value * 100)) AS y
  FROM events GROUP BY 1, 2), {_DENSE}
"""
USER_TYPE_SQL = """
daily AS (
  SELECT user_id, event_type, CAST(ts AS DATE) AS ds, CAST(count(*) AS DOUBLE) AS y
  FROM events GROUP BY 1, 2, 3)
"""
