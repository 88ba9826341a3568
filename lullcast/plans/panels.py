"""From transactions to a daily panel."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lullcast.functions.names import column
from lullcast.schema import PanelSchema


def daily_totals(
    df: DataFrame, schema: PanelSchema, day: Column, value: Column, keys: Sequence[str]
) -> DataFrame:
    """One row per (series, day) that has transactions.

    The sum is combined before the shuffle, and the shuffle is by series *and* day,
    so the transactions of a busy series are spread out.
    """
    named = [column(k).alias(s) for k, s in zip(keys, schema.series, strict=True)]
    rows = df.select(*named, day.alias(schema.date), value.cast("double").alias("_value"))
    return rows.groupBy(*schema.series, schema.date).agg(F.sum("_value").alias(schema.target))


def fill_days(daily: DataFrame, schema: PanelSchema, first: Column, last: Column) -> DataFrame:
    """Add a 0 for every day from ``first`` to ``last`` that a series lacks.

    Each row is stretched to the day before the next one, so that no second table
    of all (series, day) pairs has to be built and joined. The number of partitions is
    given, because AQE would merge them by their size before the rows multiply.
    """
    if schema.keys:
        n = int(daily.sparkSession.conf.get("spark.sql.shuffle.partitions"))
        daily = daily.repartition(n, *schema.keys)
    w = schema.by_date()
    date, y = schema.date, schema.target
    spans = daily.select(
        *schema.keys,
        F.col(date).alias("_seen"),
        F.col(y).alias("_y"),
        F.when(F.lag(date).over(w).isNull(), first).otherwise(F.col(date)).alias("_from"),
        F.coalesce(F.date_sub(F.lead(date).over(w), 1), last).alias("_to"),
    )
    days = spans.select(
        *schema.keys, F.explode(F.sequence("_from", "_to")).alias(date), "_seen", "_y"
    )
    value = F.when(F.col(date) == F.col("_seen"), F.col("_y")).otherwise(F.lit(0.0))
    return days.select(*schema.keys, date, value.alias(y))


def dense_daily_panel(
    df: DataFrame, schema: PanelSchema, day: Column, value: Column, keys: Sequence[str]
) -> DataFrame:
    """Daily totals with zeros on every other day of the table's date range."""
    days = df.select(day.alias("_day"))
    first = days.select(F.min("_day")).scalar()
    last = days.select(F.max("_day")).scalar()
    return fill_days(daily_totals(df, schema, day, value, keys), schema, first, last)
