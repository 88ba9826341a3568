"""From a feature frame to the columns a model is fitted on."""

from __future__ import annotations

import math
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lullcast.functions.names import column
from lullcast.workspace import materialize

# Fixed value: the category of an unknown text value.
MISSING = "missing"
#: Columns whose extremes one pass finds.
PROFILE_COLUMNS = 24


def scrub(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Infinite, NaN and null numbers become 0, null text becomes ``missing``."""
    changes = {}
    for name in columns or df.columns:
        kind, c = df.schema[name].dataType, column(name)
        if isinstance(kind, T.FractionalType) and not isinstance(kind, T.DecimalType):
            finite = ~F.isnan(c) & (F.abs(c) < F.lit(math.inf))
            changes[name] = F.when(finite, c).otherwise(F.lit(0.0).cast(kind))
        elif isinstance(kind, T.NumericType):
            changes[name] = F.coalesce(c, F.lit(0).cast(kind))
        elif isinstance(kind, T.StringType):
            changes[name] = F.coalesce(c, F.lit(MISSING))
    return df.withColumns(changes)


def column_profile(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Per column: rows, known rows, and whether it takes two values or more.

    One pass and one row per task: a column varies exactly if its extremes differ,
    which needs no distinct count.
    """
    facts = [F.count("*").alias("n_rows")]
    for i, name in enumerate(columns):
        facts += [
            F.count(column(name)).alias(f"known_{i}"),
            (F.min(column(name)) < F.max(column(name))).alias(f"varies_{i}"),
        ]
    one_row = df.agg(*facts)
    per_column = F.array(
        *[
            F.struct(
                F.lit(name).alias("column"),
                F.col(f"known_{i}").alias("n_known"),
                F.coalesce(F.col(f"varies_{i}"), F.lit(False)).alias("keep"),
            )
            for i, name in enumerate(columns)
        ]
    )
    return one_row.select("n_rows", F.inline(per_column))


def informative_columns(df: DataFrame, columns: Sequence[str]) -> list[str]:
    """The columns with two values or more, in their given order."""
    if not columns:
        return []
    kept = {r["column"] for r in column_profile(df, columns).filter("keep").collect()}
    return [c for c in columns if c in kept]


@dataclass(frozen=True)
class ClassProfile:
    """Row counts and column extremes per (validation?, sale?) group of a table."""

    counts: dict[tuple[bool, bool], int]
    extremes: dict[tuple[bool, bool], dict[str, tuple]]

    def count(self, validation: bool, sale: bool) -> int:
        return self.counts.get((validation, sale), 0)

    def varying(self, columns: Sequence[str], *groups: tuple[bool, bool]) -> list[str]:
        """Columns with two values or more over the groups taken together."""
        out = []
        for name in columns:
            ends = [self.extremes[g][name] for g in groups if g in self.extremes]
            known = [v for pair in ends for v in pair if v is not None]
            if known and min(known) < max(known):
                out.append(name)
        return out


def class_profile(
    df: DataFrame, target: str, columns: Sequence[str], validation: Column | None = None
) -> ClassProfile:
    """What the gate and both models have to know about a table.

    Each pass reads ``PROFILE_COLUMNS`` of the columns: the extremes of all at once make one
    method that is too long for the JIT compiler (measured: four times slower). At most four
    rows a pass reach the driver.
    """
    sale = F.coalesce(column(target) > 0, F.lit(False)).alias("_sale")
    held_out = (F.lit(False) if validation is None else validation).alias("_held_out")
    counts: dict[tuple[bool, bool], int] = {}
    extremes: dict[tuple[bool, bool], dict[str, tuple]] = {}
    for start in range(0, max(len(columns), 1), PROFILE_COLUMNS):
        part = columns[start : start + PROFILE_COLUMNS]
        ends = [
            c
            for i, name in enumerate(part)
            for c in (F.min(column(name)).alias(f"min_{i}"), F.max(column(name)).alias(f"max_{i}"))
        ]
        rows = (
            df.select(*map(column, part), sale, held_out)
            .groupBy("_held_out", "_sale")
            .agg(F.count("*").alias("n"), *ends)
            .collect()
        )
        for r in rows:
            group = (r["_held_out"], r["_sale"])
            counts[group] = r["n"]
            found = {name: (r[f"min_{i}"], r[f"max_{i}"]) for i, name in enumerate(part)}
            extremes.setdefault(group, {}).update(found)
    return ClassProfile(counts, extremes)


def candidate_features(df: DataFrame, drop: Sequence[str]) -> list[str]:
    """Columns that can enter a model: numbers and text not in ``drop``."""
    usable = (T.NumericType, T.StringType, T.BooleanType)
    return [
        f.name for f in df.schema.fields if f.name not in drop and isinstance(f.dataType, usable)
    ]


def drop_columns(df: DataFrame, names: Sequence[str]) -> DataFrame:
    """Drop by name; names that are absent are ignored."""
    return df.drop(*names)


def align_features(
    df: DataFrame, features: Sequence[str], keep: Sequence[str] = ()
) -> DataFrame:
    """Exactly the frozen feature list, in order: absent ones 0, others dropped."""
    aligned = [column(c) if c in df.columns else F.lit(0).alias(c) for c in features]
    return df.select(*map(column, keep), *aligned)


def require_same_features(first: Sequence[str], second: Sequence[str]) -> None:
    if list(first) != list(second):
        raise ValueError(f"feature lists differ: {list(first)} and {list(second)}")


def category_codes(df: DataFrame, column_name: str, output: str) -> DataFrame:
    """Codes 0, 1, … in the order of the values, nulls as ``missing``.

    Values are numbered inside the ranges they were written in, and each range starts
    where the counts of the ones before it end, so there may be any number of them.
    """
    known = scrub(df, [column_name])
    values = known.select(column(column_name).alias("_value")).distinct()
    ranged = values.repartitionByRange("_value").withColumn("_range", F.spark_partition_id())
    written = materialize(ranged, "categories")
    counts = written.groupBy("_range").agg(F.count("*").alias("_n"))
    before = Window.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    starts = counts.select("_range", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_start"))
    inside = Window.partitionBy("_range").orderBy("_value")
    numbered = written.withColumn("_place", F.row_number().over(inside) - 1).join(starts, "_range")
    code = (F.col("_start") + F.col("_place")).cast("double").alias(output)
    codes = numbered.select("_value", code)
    coded = known.join(codes, column(column_name) == F.col("_value"))
    return coded.select(*map(column, known.columns), column(output))
