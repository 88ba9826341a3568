"""Shards that all match the mixture of sources: proportional stratified interleaving.

Rows are shuffled by a seeded hash within their source and ranked. Sorted by fractional
rank, (rank + 1/2) / rows of the source, every source is spread evenly over the whole
order, so any cut of it holds the sources in their proportions.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from lullcast.llm.common import as_row, row_and
from lullcast.workspace import materialize

#: Ranges of the shuffle order, and of fractional ranks, that are numbered side by side.
RANGES = 4096


def shuffle_order(seed: str, key: Column) -> Column:
    """60 bits of the MD5 of seed and key; the order of equal values is by key."""
    digest = F.md5(F.concat(F.lit(f"{seed}:"), F.coalesce(key.cast("string"), F.lit(""))))
    return F.conv(F.substring(digest, 1, 15), 16, 10).cast("bigint")


def interleaved_shards(
    documents: DataFrame,
    shards: int = 16,
    source: str = "source",
    doc_id: str = "doc_id",
    seed: str = "shards",
    also_by: tuple[str, ...] = (),
) -> DataFrame:
    """``documents`` with ``shard`` (0 to ``shards`` - 1; sizes differ by one row at most)
    and ``slot`` (gapless from 0 in each shard).

    Both ranks are exact, but no source is ranked in one task: rows are numbered within
    ranges of their order, and ranges are offset by running counts. A null source is a
    source of its own, null ids come first. Rows with equal ids are ordered by ``also_by``;
    rows equal in these too are interchangeable. An empty table gives no rows. Given columns
    ``shard`` and ``slot`` are replaced.
    """
    ties = [F.col("_id"), *(F.col(f"row.`{c}`") for c in also_by)]
    rows = documents.select(
        as_row(documents),
        F.concat(F.when(F.col(f"`{source}`").isNull(), "0").otherwise("1"),
                 F.coalesce(F.col(f"`{source}`").cast("string"), F.lit(""))).alias("_source"),
        F.col(f"`{doc_id}`").alias("_id"),
        shuffle_order(seed, F.col(f"`{doc_id}`")).alias("_order"),
    ).withColumn("_range", F.shiftright("_order", 48))

    counts = materialize(rows.groupBy("_source", "_range").count(), "source-ranges")
    own = Window.partitionBy("_source")
    before = own.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select(
        "_source", "_range",
        F.coalesce(F.sum("count").over(before), F.lit(0)).alias("_before"),
        F.sum("count").over(own).alias("_of_source"),
    )
    number = F.row_number().over(Window.partitionBy("_source", "_range").orderBy("_order", *ties)) - 1
    ranked = (
        rows.withColumn("_number", number)
        .join(offsets, ["_source", "_range"])
        .withColumn("_rank", F.col("_before") + F.col("_number"))
        .withColumn("_fraction", (F.col("_rank") * 2 + 1) / (F.col("_of_source") * 2))
        .withColumn("_part", F.floor(F.col("_fraction") * RANGES))
        .drop("_before", "_number", "_range", "_of_source", "_order", "_id")
    )
    ranked = materialize(ranked, "ranked")
    parts = materialize(ranked.groupBy("_part").count(), "parts")
    every = Window.partitionBy(F.lit(0))  # one row per range: RANGES at most
    starts = parts.select(
        "_part",
        F.coalesce(
            F.sum("count").over(every.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)),
            F.lit(0),
        ).alias("_start"),
        F.sum("count").over(every).alias("_all"),
    )
    within = Window.partitionBy("_part").orderBy("_fraction", "_source", "_rank")
    placed = (
        ranked.withColumn("_at", F.row_number().over(within) - 1)
        .join(F.broadcast(starts), "_part")
        .withColumn("_at", F.col("_start") + F.col("_at"))
    )
    placed = placed.withColumn("_shard", F.expr(f"(_at * {shards}) div _all"))
    first = F.expr(f"(_shard * _all + {shards - 1}) div {shards}")
    return placed.select(
        *row_and(placed, shard=F.col("_shard").cast("int"), slot=F.col("_at") - first)
    )


def write_shards(sharded: DataFrame, path: str) -> None:
    """One folder per shard, rows in slot order within every file."""
    out = sharded.repartition("shard", F.expr("slot div 100000")).sortWithinPartitions("shard", "slot")
    out.write.partitionBy("shard").parquet(path)
