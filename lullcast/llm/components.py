"""Connected components by alternating large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lullcast.llm.common import BROADCAST_ROWS
from lullcast.workspace import materialize

ROUNDS = 60


def components(edges: DataFrame) -> DataFrame:
    """``node, root`` for every node of ``edges`` (a, b); root is the smallest node reached.

    Each round hangs the neighbours of a node on the smallest of them. Minima are combined
    before any shuffle, and rounds pass through written tables, so neither a node with very
    many neighbours nor a lost executor holds up more than one round. Edges from a node to
    itself are ignored; null ends are not edges.
    Of more than BROADCAST_ROWS edges nothing is broadcast: their files, by which Spark judges,
    take a few bytes an edge, rows on the driver many more.
    """
    hung = materialize(_hung(edges.select("a", "b")), "stars")
    seen = None
    for _ in range(ROUNDS):
        mark = _mark(hung)
        if mark == seen or not mark[0]:
            break
        seen = mark
        many = mark[0] > BROADCAST_ROWS
        hung = materialize(_small_star(_large_star(hung, many), many), "stars")
    else:
        raise RuntimeError(f"components did not settle in {ROUNDS} rounds")
    tips = hung.select(F.col("b").alias("node"), F.col("a").alias("root"))
    roots = hung.select(F.col("a").alias("node"), F.col("a").alias("root"))
    return tips.unionByName(roots).distinct()


def _hung(edges: DataFrame) -> DataFrame:
    """Edges as (smaller, larger), each once."""
    least, most = F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")
    return edges.where("a <> b").select(least, most).distinct()


def _mark(edges: DataFrame) -> tuple:
    both = F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))
    return tuple(edges.agg(F.count("*"), both).first())


def _merged(rows: DataFrame, many: bool) -> DataFrame:
    return rows.hint("merge") if many else rows


def _large_star(edges: DataFrame, many: bool = False) -> DataFrame:
    turned = edges.select(F.col("b").alias("a"), F.col("a").alias("b"))
    both = edges.unionByName(turned)
    least = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"))
    larger = edges.join(_merged(least, many), "a")  # b > a already
    return _hung(larger.select(F.col("m").alias("a"), "b"))


def _small_star(edges: DataFrame, many: bool = False) -> DataFrame:
    least = edges.groupBy("b").agg(F.min("a").alias("m"))
    others = edges.join(_merged(least, many), "b").where("a <> m").select(F.col("m").alias("a"), F.col("a").alias("b"))
    own = least.select(F.col("m").alias("a"), "b")
    return _hung(others.unionByName(own))
