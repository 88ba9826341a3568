"""A corpus from raw documents to packed sequences, in five stages.

Each stage reads what its predecessor wrote and works on all of it; all but the last return
the columns of ``documents``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from lullcast.llm import langid, mixing, packing, simhash
from lullcast.llm.common import as_row, table
from lullcast.llm.exact_dedup import exact_groups
from lullcast.llm.queries import TOKENIZER
from lullcast.workspace import discard, materialize, written


def known_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language the models accept; the column ``lang`` stays as it is. Texts
    that are null or without a letter go. Rows that repeat stay alike, ids play no part."""
    models = langid.learn(docs)
    rest = [c for c in docs.columns if c != "text"]
    rows = docs.select(as_row(docs.select(*(F.col(f"`{c}`") for c in rest))), "text")
    found = langid.identify(rows, models, with_text=True).where(~F.col("rejected"))
    return found.select(*(F.col("text" if c == "text" else f"row.`{c}`") for c in docs.columns))


def row_digest(docs: DataFrame) -> Column:
    """128 bits that stand for a whole row, nulls told apart."""
    return F.md5(F.to_json(as_row(docs)))


def rows_of(docs: DataFrame, digests: DataFrame) -> DataFrame:
    """The rows of ``docs`` whose digest is in ``digest``, and of equal rows only one."""
    keyed = docs.select(as_row(docs), row_digest(docs).alias("_digest"))
    chosen = digests.select(F.col("digest").alias("_digest")).distinct()
    found = keyed.join(chosen, "_digest", "left_semi")
    equal = Window.partitionBy("_digest").orderBy("_digest")
    return found.withColumn("_k", F.row_number().over(equal)).where("_k = 1").select("row.*")


def exact_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of every group of equal texts, that with the largest doc_id (nulls are
    smallest; of several rows with that id the one with the smallest digest). Null texts
    are empty ones; an id with several texts keeps each; columns are those of ``docs``,
    whatever their names. No rows give none."""
    groups = exact_groups(docs, digest=row_digest(docs), with_recipe=True).where("kept")
    return rows_of(docs, groups.groupBy("recipe").agg(F.min("digest").alias("digest")))


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each SimHash component, that with the smallest doc_id (null ids last; of
    several rows with that id the one with the smallest digest). Null texts are empty ones,
    an id's texts may be in several components; columns are those of ``docs``. No rows give
    none."""
    groups = simhash.near_groups(docs, digest=row_digest(docs))
    first = F.struct(F.col("doc_id").isNull(), "doc_id", "digest")
    return rows_of(docs, groups.groupBy("root").agg(F.min(first)["digest"].alias("digest")))


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mixture takes them. A null source is a source; rows that
    repeat are drawn by their id alike. No rows give none."""
    return mixing.emitted(mixing.mixed(docs)).select(*docs.columns)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all documents with their places in sequences. Null texts are empty, rows
    that repeat are packed as often as they occur. No rows give none."""
    pieces = packing.cut_pieces(docs, TOKENIZER)
    narrow = pieces.select("doc_id", "piece", "start", "length", F.crc32("ids").alias("ids_crc32"))
    keys = ["doc_id", "piece", "start", "ids_crc32"]
    return packing.place_pieces(materialize(narrow, "pieces"), keys)


STAGES = [
    ("language", known_language),
    ("exact_dedup", exact_dedup),
    ("near_dedup", near_dedup),
    ("mix", mix),
    ("pack", pack),
]
#: SQL can express neither the models nor the fingerprints.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each written as Parquet and read again. A stage's input
    is deleted when its output is written; at the end only the result is left."""

    def stages() -> DataFrame:
        docs, before = table(spark, sf_dir, "documents"), None
        for name, stage in STAGES:
            docs = written(spark, name, lambda: stage(spark, docs, sf_dir))
            if before is not None:
                discard(spark, before)
            before = docs
        return docs

    return written(spark, "pipeline", stages)
