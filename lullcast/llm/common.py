"""What several operators of this package share: tables, words, joins that survive hot keys."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from lullcast.workspace import materialize

#: Space and the control characters from tab to carriage return separate words.
WORD = "[^\\x20\\x09-\\x0D]+"
#: A side with at most so many narrow rows may be broadcast.
BROADCAST_ROWS = 100_000
#: A key that holds at least one in so many rows is spread over SPREAD salts.
HOT_SHARE = 200
SPREAD = 32


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def as_row(df: DataFrame) -> Column:
    """All columns of ``df`` in one, so that names made beside it can't clash with them."""
    return F.struct(*(F.col(f"`{c}`") for c in df.columns)).alias("row")


def row_and(df: DataFrame, **made: Column) -> list[Column]:
    """The columns of ``row`` and those ``made``, which replace columns of their names."""
    names = {c.lower() for c in made}
    kept = [c for c in df.schema["row"].dataType.names if c.lower() not in names]
    return [*(F.col(f"row.`{c}`") for c in kept), *(c.alias(n) for n, c in made.items())]


def text_or_empty(name: str = "text") -> Column:
    return F.coalesce(F.col(name), F.lit(""))


def uniform(seed: str, key: Column) -> Column:
    """A number in [0, 1) of 52 bits, drawn from the MD5 of seed and key."""
    digest = F.md5(F.concat(F.lit(f"{seed}:"), F.coalesce(key.cast("string"), F.lit(""))))
    return F.conv(F.substring(digest, 1, 13), 16, 10).cast("bigint") / F.lit(float(1 << 52))


def sampled(rows: DataFrame, order: str, n: int, by: str | None = None) -> DataFrame:
    """At most ``n`` rows (for each value of ``by``), in the order of a uniform number of
    60 bits. Rows are cut off by their share first, so that little more than ``n`` rows
    meet in one task however many there are; of fewer than ``n`` rows all are taken."""
    key = F.lit("") if by is None else F.col(by)
    rows = rows.withColumn("_of", key)
    counts = materialize(rows.groupBy("_of").agg(F.count("*").alias("_n")), "sample-sizes")
    share = (F.lit(1.25 * n + 100) / F.col("_n")) * float(1 << 60)
    near = attach_facts(rows, counts, "_of").where(F.col(order) <= share)
    first = Window.partitionBy("_of").orderBy(order)
    numbered = near.withColumn("_place", F.row_number().over(first))
    return numbered.where(F.col("_place") <= n).drop("_of", "_n")


def attach_facts(rows: DataFrame, facts: DataFrame, key: str) -> DataFrame:
    """Left join of ``facts``, a written table with one row per (non-null) ``key``.

    It is broadcast if it was counted and found small; otherwise every fact is copied
    for each salt, so that the rows of a hot key go to many tasks.
    """
    if facts.limit(BROADCAST_ROWS + 1).count() <= BROADCAST_ROWS:
        return rows.join(F.broadcast(facts), key, "left")
    salt = F.pmod(F.xxhash64(*(F.col(f"`{c}`") for c in rows.columns)), F.lit(SPREAD))
    salted = facts.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(SPREAD - 1))))
    return rows.withColumn("_salt", salt.cast("int")).join(salted, [key, "_salt"], "left").drop("_salt")


def attach_groups(rows: DataFrame, groups: DataFrame, key: str, size: str, row_id: str) -> DataFrame:
    """Inner join of ``groups``, a written table with one row and its ``size`` per ``key``.

    At most HOT_SHARE groups can hold a HOT_SHARE-th of all rows each; only their hashes
    come to the driver, and only their rows are salted.
    """
    total = groups.agg(F.sum(size)).first()[0] or 0
    hot_rows = groups.where(F.col(size) * HOT_SHARE >= total).where(F.col(size) > SPREAD)
    hot = [r[0] for r in hot_rows.select(F.xxhash64(key)).collect()]
    if not hot:
        return rows.join(groups, key)
    is_hot = F.xxhash64(key).isin(hot)
    salt = F.when(is_hot, F.pmod(F.xxhash64(row_id), F.lit(SPREAD))).otherwise(F.lit(0).cast("bigint"))
    every = F.sequence(F.lit(0).cast("bigint"), F.lit(SPREAD - 1).cast("bigint"))
    salts = F.when(is_hot, every).otherwise(F.array(F.lit(0).cast("bigint")))
    salted = groups.withColumn("_salt", F.explode(salts))
    return rows.withColumn("_salt", salt).join(salted, [key, "_salt"]).drop("_salt")
