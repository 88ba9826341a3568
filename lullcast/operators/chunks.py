"""One long series over many tasks: chunks of its rows, each behind a halo of earlier rows.

Windows that look a bounded number of rows back need no more than the halo. What looks back
to the beginning (row number, last sale, last row that is not zero) is carried: months are
counted and chunks reduced to one row each, and running sums and maxima over those few rows
say what lies before a chunk.
"""

from __future__ import annotations

from dataclasses import replace

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from lullcast.functions.names import column
from lullcast.schema import PanelSchema

CHUNK = "_chunk"
NUMBER, LAST_SALE, LAST_STOP, IS_HALO = "_number", "_last_sale", "_last_stop", "_is_halo"
#: Rows of a chunk without its halo; a chunk is a window partition.
CHUNK_ROWS = 100_000


def numbered(df: DataFrame, schema: PanelSchema) -> DataFrame:
    """Rows with their number in the series, from 1; no task numbers more than a month."""
    keys = [*map(column, schema.keys), F.col("_month")]
    rows = df.withColumn("_month", F.trunc(column(schema.date), "month"))
    counts = rows.groupBy(*keys).agg(F.count("*").alias("_n"))
    earlier = Window.partitionBy(*schema.partition()).orderBy("_month")
    before = F.sum("_n").over(earlier.rowsBetween(Window.unboundedPreceding, -1))
    offsets = counts.withColumn("_before", F.coalesce(before, F.lit(0))).drop("_n")
    within = F.row_number().over(Window.partitionBy(*keys).orderBy(column(schema.date)))
    joined = rows.withColumn("_within", within).join(offsets, [*schema.keys, "_month"])
    return joined.withColumn(NUMBER, F.col("_before") + F.col("_within")).drop("_month", "_within", "_before")


def in_chunks(
    df: DataFrame, schema: PanelSchema, halo: int, chunk_rows: int = CHUNK_ROWS
) -> tuple[DataFrame, PanelSchema]:
    """The rows of every chunk and of the ``halo`` rows before it, and a schema whose series
    are chunks. A chunk has at least as many rows as its halo, so a row stands in two at most.
    Besides its number a row knows the numbers of the last sale and of the last row that is
    not 0 before its chunk's halo."""
    size = max(chunk_rows, halo, 1)
    y = column(schema.target)
    first = F.floor((F.col(NUMBER) - 1) / size)
    last = F.floor((F.col(NUMBER) - 1 + halo) / size)
    rows = numbered(df, schema).withColumn("_own", first)

    is_zero = F.coalesce(y == 0, F.lit(False))
    not_in_halo = F.col(NUMBER) <= (F.col("_own") + 1) * size - halo
    marks = {LAST_SALE: F.when(y > 0, F.col(NUMBER)), LAST_STOP: F.when(~is_zero, F.col(NUMBER))}
    reduced = rows.groupBy(*map(column, schema.keys), "_own").agg(
        *(F.max(m).alias(name) for name, m in marks.items()),
        *(F.max(F.when(not_in_halo, m)).alias(f"{name}_early") for name, m in marks.items()),
    )
    order = Window.partitionBy(*schema.partition()).orderBy("_own")
    before = order.rowsBetween(Window.unboundedPreceding, -2)
    carried = reduced.select(
        *map(column, schema.keys),
        F.col("_own").alias(CHUNK),
        # the chunk just before counts without the rows that are this one's halo
        *(F.greatest(F.max(name).over(before), F.lag(f"{name}_early").over(order)).alias(name) for name in marks),
    )
    copies = rows.withColumn(CHUNK, F.explode(F.sequence("_own", last)))
    # behind the last chunk nothing follows that the last rows could be a halo of
    copies = copies.withColumn(IS_HALO, F.col(CHUNK) > F.col("_own")).drop("_own")
    joined = copies.join(carried, [*schema.keys, CHUNK])
    # dealt explicitly: rows that happen to lie in one task would otherwise stay there
    joined = joined.repartition(*map(column, schema.keys), F.col(CHUNK))
    return joined, replace(schema, series=(*schema.series, CHUNK))


def from_day(df: DataFrame, schema: PanelSchema, halo: int, first) -> tuple[DataFrame, PanelSchema]:
    """The rows from day ``first`` on as one chunk per series, with its halo and what is
    carried. Needs the partitioning that the windows need, no further shuffle."""
    y, w = column(schema.target), schema.by_date()
    whole = w.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    is_early = column(schema.date) < F.lit(first)
    is_zero = F.coalesce(y == 0, F.lit(False))
    counted = df.withColumns(
        {NUMBER: F.row_number().over(w), "_early": F.count_if(is_early).over(whole)}
    )
    before_halo = F.col(NUMBER) <= F.col("_early") - halo
    marked = counted.withColumns(
        {
            LAST_SALE: F.max(F.when((y > 0) & before_halo, F.col(NUMBER))).over(whole),
            LAST_STOP: F.max(F.when(~is_zero & before_halo, F.col(NUMBER))).over(whole),
        }
    )
    kept = marked.filter(~before_halo).drop("_early")
    made = kept.withColumns({IS_HALO: is_early, CHUNK: F.lit(0)})
    return made, replace(schema, series=(*schema.series, CHUNK))


def out_of_chunks(df: DataFrame) -> DataFrame:
    return df.filter(~F.col(IS_HALO)).drop(CHUNK, NUMBER, LAST_SALE, LAST_STOP, IS_HALO)
