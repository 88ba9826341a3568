"""Mixing sources to target weights by repetition.

Word counts are summed per source; the targets share the wanted total by weight, none
above a given multiple of its source. A document is then taken floor(rate) times, and once
more if its seeded hash falls below the rate's fraction.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from lullcast.llm.common import WORD, as_row, attach_facts, row_and, uniform
from lullcast.workspace import materialize

WEIGHTS = (3, 1, 2)


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("bigint")


def source_targets(
    totals: DataFrame,
    weights: tuple[int, ...] = WEIGHTS,
    share: tuple[int, int] = (3, 2),
    most: int = 2,
) -> DataFrame:
    """``_source, source_size`` (one row per source) with its ``target`` and ``rate``.

    Weights repeat in the order of the sources. A source is full at ``most`` times its
    size; resharing what is above by weight ends at the level where the sources with the
    least room per weight are full and all others get the level times their weight. The
    windows see one row per source.
    """
    everything = Window.partitionBy(F.lit(0))
    ordered = everything.orderBy("_source")
    place = F.pmod(F.row_number().over(ordered) - 1, F.lit(len(weights)))
    weight = F.element_at(F.array(*map(F.lit, weights)), (place + 1).cast("int"))
    rows = totals.withColumn("_weight", weight.cast("bigint"))
    full = F.col("source_size") * most
    rows = rows.withColumn("_room", full / F.col("_weight"))
    by_room = everything.orderBy("_room", "_source")
    before = by_room.rowsBetween(Window.unboundedPreceding, -1)
    onward = by_room.rowsBetween(Window.currentRow, Window.unboundedFollowing)
    wanted = F.sum("source_size").over(everything) * share[0] / share[1]
    left = wanted - F.coalesce(F.sum(full).over(before), F.lit(0))
    # the level if all sources with less room are full; it falls short of the room of the
    # first source that is not, and from there on it is the level
    rows = rows.withColumn("_level", left / F.sum("_weight").over(onward))
    level = F.min(F.when(F.col("_level") <= F.col("_room"), F.struct("_room", "_source", "_level")))
    rows = rows.withColumn("_level", level.over(everything)["_level"])
    target = F.least(full.cast("double"), F.col("_level") * F.col("_weight"))
    rows = rows.withColumn("target", F.coalesce(target, full.cast("double")))
    rate = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(F.lit(0.0))
    return rows.select("_source", "source_size", "target", rate.alias("rate"))


def mixed(
    documents: DataFrame,
    doc_id: str = "doc_id",
    source: str = "source",
    text: str = "text",
    seed: str = "mix",
    weights: tuple[int, ...] = WEIGHTS,
) -> DataFrame:
    """``documents`` with ``size`` (words), ``source_size``, ``target``, ``rate`` and
    ``copies``, how often the mix takes the row.

    A null text has size 0 and a null source is the last source. Rows with equal ids draw
    the same number; sources without words are taken 0 times. An empty table gives no rows. Given columns of
    these names are replaced.
    """
    name = F.col(f"`{source}`").cast("string")
    sized = documents.select(
        as_row(documents),
        F.when(name.isNull(), F.lit("1")).otherwise(F.concat(F.lit("0"), name)).alias("_source"),
        word_count(F.col(f"`{text}`")).alias("size"),
    )
    totals = sized.groupBy("_source").agg(F.sum("size").alias("source_size"))
    facts = materialize(source_targets(materialize(totals, "source-sizes"), weights), "targets")
    out = attach_facts(sized, facts, "_source")
    draw = uniform(seed, F.col(f"row.`{doc_id}`")) < F.col("rate") - F.floor("rate")
    copies = F.floor("rate") + draw.cast("bigint")
    made = {c: F.col(c) for c in ("size", "source_size", "target", "rate")}
    return out.select(*row_and(out, **made, copies=copies))


def emitted(mix: DataFrame) -> DataFrame:
    """Every row of ``mixed`` as often as it was taken, with ``copy`` from 0."""
    each = F.explode(F.sequence(F.lit(0), F.col("copies").cast("int") - 1))
    return mix.where("copies > 0").withColumn("copy", each)
