"""Parsing, de-duplication, clipping and the guards on a panel."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lullcast.functions.names import column
from lullcast.functions.text import series_id
from lullcast.schema import PanelSchema


def parse_dates(df: DataFrame, date: str) -> DataFrame:
    """Strict: a value that is not a date fails the job."""
    return df.withColumn(date, F.to_date(column(date)))


def parse_dates_leniently(df: DataFrame, date: str) -> DataFrame:
    """Rows whose date cannot be read are dropped."""
    parsed = F.try_to_timestamp(column(date).cast("string")).cast("date")
    return df.withColumn(date, parsed).filter(column(date).isNotNull())


def keys_as_text(df: DataFrame, schema: PanelSchema) -> DataFrame:
    return df.withColumns({k: column(k).cast("string") for k in schema.series})


def drop_null_keys(df: DataFrame, schema: PanelSchema) -> DataFrame:
    """A row without a series key belongs to no series."""
    for key in schema.series:
        df = df.filter(column(key).isNotNull())
    return df


def count_null_keys(df: DataFrame, schema: PanelSchema) -> DataFrame:
    """How many rows ``drop_null_keys`` would leave out."""
    lacking = F.lit(False)
    for key in schema.series:
        lacking = lacking | column(key).isNull()
    return df.agg(
        F.count("*").alias("n_rows"), F.count_if(lacking).alias("n_without_key")
    )


def with_series_id(df: DataFrame, schema: PanelSchema, name: str = "id") -> DataFrame:
    return df.withColumn(name, series_id(schema.series))


def keep_first(
    df: DataFrame, schema: PanelSchema, tie_break: Sequence[str | Column]
) -> DataFrame:
    """The first row per (series, date) in the order of ``tie_break``.

    Spark limits each group before the shuffle too, so a pair that repeats very
    often sends one row per map task. Afterwards a series has at most one row per
    calendar day, which bounds every later per-series window.
    """
    w = Window.partitionBy(*schema.partition(), column(schema.date)).orderBy(*tie_break)
    ranked = df.withColumn("_place", F.row_number().over(w))
    return ranked.filter(F.col("_place") == 1).drop("_place")


def require_one_row_per_day(df: DataFrame, schema: PanelSchema) -> None:
    """Raise if a (series, date) repeats: ``keep_first`` has to run before.

    Counts are combined before the shuffle, so a frequent pair costs nothing extra.
    """
    counts = df.groupBy(*map(column, schema.keys), column(schema.date)).agg(F.count("*").alias("n_rows"))
    found = counts.filter(F.col("n_rows") > 1).limit(5).collect()
    if found:
        raise ValueError(f"several rows for one series and date: {found}")


def clip_negatives(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Negative values become 0; nulls stay."""
    return df.withColumns({c: F.when(column(c) < 0, 0).otherwise(column(c)) for c in columns})


def non_negative_columns(cfg: dict, schema: PanelSchema) -> list[str]:
    """The configured columns, the target when none are configured."""
    return list(cfg.get("data", {}).get("non_negative_cols", [schema.target]))


def short_series(
    df: DataFrame, keys: Sequence[str], min_rows: int = 28
) -> DataFrame:
    """Series with too little history, with their row counts."""
    counts = df.groupBy(*map(column, keys)).agg(F.count("*").alias("n_rows"))
    return counts.filter(F.col("n_rows") < min_rows)


def require_context(df: DataFrame, keys: Sequence[str], min_rows: int = 28) -> None:
    """Raise if any series is short, naming the first five."""
    found = short_series(df, keys, min_rows).orderBy(*map(column, keys)).limit(5).collect()
    if found:
        names = [", ".join(str(r[k]) for k in keys) for r in found]
        raise ValueError(f"some series have fewer than {min_rows} rows: {names}")


def prepare_panel(
    df: DataFrame, schema: PanelSchema, cfg: dict, tie_break: Sequence[str | Column]
) -> DataFrame:
    """Parse, key, de-duplicate and clip: the panel every later operator expects."""
    out = keys_as_text(parse_dates(df, schema.date), schema)
    y = column(schema.target).cast("double")
    out = out.withColumn(schema.target, F.when(~F.isnan(y), y))
    out = keep_first(drop_null_keys(out, schema), schema, tie_break)
    out = clip_negatives(out, non_negative_columns(cfg, schema))
    return with_series_id(out, schema)
