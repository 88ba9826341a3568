"""Isotonic regression over many tasks: pools are made within ranges of values and then
across their borders; only the outermost pools of each range come to the driver."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from lullcast.functions.names import column
from lullcast.workspace import discard, materialize

#: Distinct values of a range, on average; a task pools one range.
RANGE_ROWS = 100_000
POOLS = "range int, low double, high double, total double, weight double"


def pooled(rows: pd.DataFrame) -> pd.DataFrame:
    """Neighbours in order of ``low`` are united as long as an earlier mean is not below a
    later one."""
    rows = rows.sort_values("low")
    out: list[list[float]] = []
    for low, high, total, weight in rows[["low", "high", "total", "weight"]].itertuples(index=False):
        while out and out[-1][2] * weight >= total * out[-1][3]:
            low, _, before, more = out.pop()
            total, weight = total + before, weight + more
        out.append([low, high, total, weight])
    made = pd.DataFrame(out, columns=["low", "high", "total", "weight"], dtype=float)
    first = int(rows["range"].iloc[0]) if len(rows) else 0
    return made.assign(range=np.int32(first))[["range", "low", "high", "total", "weight"]]


def in_ranges(rows: DataFrame, value: str, range_rows: int) -> DataFrame:
    """``rows`` with their ``range``: numbers that ascend with ``value``, a null-free number."""
    ranges = max(1, -(-rows.count() // range_rows))
    return rows.repartitionByRange(ranges, value).withColumn("range", F.spark_partition_id())


def _violated(pools: DataFrame) -> list[tuple[int, int]]:
    """Neighbouring ranges whose pools at the border must be united: (left, right)."""
    ends = pools.groupBy("range").agg(
        F.min_by(F.struct("total", "weight"), "low").alias("first"),
        F.max_by(F.struct("total", "weight"), "low").alias("last"),
    )
    rows = sorted(ends.collect(), key=lambda r: r["range"])
    return [
        (a["range"], b["range"])
        for a, b in zip(rows, rows[1:])
        if a["last"]["total"] * b["first"]["weight"] >= b["first"]["total"] * a["last"]["weight"]
    ]


def _apart(borders: list[tuple[int, int]]) -> dict[int, int]:
    """Right range to left range of borders that share no range: of neighbouring borders
    every second, so that a long falling stretch halves each round."""
    chosen: dict[int, int] = {}
    taken = -1
    for left, right in borders:
        if left != taken:
            chosen[right] = left
            taken = right
    return chosen


def isotonic_pools(
    df: DataFrame, value: str, label: str, range_rows: int = RANGE_ROWS
) -> DataFrame:
    """``low, high, mean``: the pools of the isotonic fit of ``label`` on ``value``, a written
    table; rows with a null take no part.

    Rows of one value are one weighted row first. In each round the first pools of a range
    go to its left neighbour if the border between them is violated, twice as many as in the
    round before, and are pooled there; what is moved too far does no harm. So a task holds
    about one range, or as many pools as become one.
    """
    spark = df.sparkSession
    rows = df.select(column(value).cast("double").alias("low"), column(label).cast("double").alias("y")).dropna()
    distinct = rows.groupBy("low").agg(F.sum("y").alias("total"), F.count("*").cast("double").alias("weight"))
    ranged = in_ranges(materialize(distinct, "values"), "low", range_rows)
    ranged = ranged.select("range", "low", F.col("low").alias("high"), "total", "weight")
    written = [materialize(ranged, "ranges")]
    pools = materialize(written[0].groupBy("range").applyInPandas(pooled, POOLS), "pools")
    many = 1
    while borders := _violated(pools):
        to = _apart(borders)
        moves = spark.createDataFrame(list(to.items()), "range int, left int")
        place = F.row_number().over(Window.partitionBy("range").orderBy("low"))
        dealt = pools.join(F.broadcast(moves), "range", "left").withColumn("_place", place)
        goes = F.col("left").isNotNull() & (F.col("_place") <= many)
        dealt = dealt.withColumn("range", F.when(goes, F.col("left")).otherwise(F.col("range")))
        again = dealt.select("range", "low", "high", "total", "weight").groupBy("range")
        written.append(pools)
        pools = materialize(again.applyInPandas(pooled, POOLS), "pools")
        many *= 2
    fit = materialize(pools.select("low", "high", (F.col("total") / F.col("weight")).alias("mean")), "isotonic")
    discard(spark, *written, pools)
    return fit


@dataclass
class Isotonic:
    """A fitted step function with straight lines between its pools."""

    pools: DataFrame
    range_rows: int = RANGE_ROWS

    def transform(self, df: DataFrame, value: str, output: str) -> DataFrame:
        """``df`` with the fitted mean; values beyond the outer pools get theirs, null none.

        Distinct values and the pools' ends are put in one order and cut into ranges; each
        value looks for the nearest end on either side in its range, or among the outermost
        ends of the other ranges.
        """
        x = column(value).cast("double")
        wanted = df.select(x.alias("x")).dropna().distinct()
        ends = self.pools.select(F.explode(F.array("low", "high")).alias("x"), F.col("mean").alias("end")).distinct()
        both = wanted.withColumn("end", F.lit(None).cast("double")).unionByName(ends)
        ranged = materialize(in_ranges(both, "x", self.range_rows), "lookups")
        known = F.when(F.col("end").isNotNull(), F.struct("x", "end"))

        outer = ranged.groupBy("range").agg(F.min(known).alias("first"), F.max(known).alias("last"))
        every = Window.orderBy("range")  # a row per range
        outer = outer.select(
            "range",
            F.last("last", True).over(every.rowsBetween(Window.unboundedPreceding, -1)).alias("before"),
            F.first("first", True).over(every.rowsBetween(1, Window.unboundedFollowing)).alias("after"),
        )
        order = Window.partitionBy("range").orderBy("x")
        so_far = order.rangeBetween(Window.unboundedPreceding, Window.currentRow)
        to_come = order.rangeBetween(Window.currentRow, Window.unboundedFollowing)
        near = ranged.select("*", F.last(known, True).over(so_far).alias("a"), F.first(known, True).over(to_come).alias("b"))
        near = near.where("end IS NULL").join(F.broadcast(outer), "range")
        a, b = F.coalesce("a", "before"), F.coalesce("b", "after")
        share = F.try_divide(F.col("x") - F.col("_a.x"), F.col("_b.x") - F.col("_a.x"))
        between = F.col("_a.end") + F.coalesce(share, F.lit(0.0)) * (F.col("_b.end") - F.col("_a.end"))
        found = near.select("x", a.alias("_a"), b.alias("_b")).select(
            F.col("x").alias("_x"), F.coalesce(between, "_a.end", "_b.end").alias("_fitted")
        )
        joined = df.withColumn("_value", x).join(found, F.col("_value") == F.col("_x"), "left")
        return joined.select(*map(column, df.columns), F.col("_fitted").alias(output))
