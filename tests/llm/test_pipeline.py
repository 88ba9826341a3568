import os
import random

import pytest
from pyspark.sql import functions as F

import __spark_entry__
import corpus_pipeline
from lullcast import workspace
from lullcast.llm.queries import ORACLES, QUERIES
from lullcast.workspace import materialize
from workload.compare import connect, differences
from workload.registry import CASES, Case

SF = "/root/testdata/sf0.001"
needs_tables = pytest.mark.skipif(not os.path.isdir(SF), reason="no test tables")


def test_registered():
    assert set(QUERIES) | {"pipeline"} <= set(__spark_entry__.queries())
    assert set(ORACLES) <= set(__spark_entry__.oracle_sql())
    assert [name for name, _ in corpus_pipeline.STAGES] == ["language", "exact_dedup", "near_dedup", "mix", "pack"]


@needs_tables
@pytest.mark.parametrize("name", ORACLES)
def test_equals_sql(spark, name, monkeypatch):
    monkeypatch.setitem(CASES, name, Case(QUERIES[name], ORACLES[name]))
    assert differences(spark, connect(SF), name, SF) == ""


@needs_tables
def test_run(spark):
    rows = corpus_pipeline.run(spark, SF)
    assert rows.columns == ["doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"]
    full = rows.groupBy("sequence_id").agg(F.sum("length").alias("n"))
    assert full.where("n > 1024").count() == 0
    assert full.where("n < 512").count() <= 1


def test_stages_keep_columns_and_nulls(spark, documents, odd, words):
    german = [(500 + i, f"das ist der satz {' '.join(words(12, i))}", "de") for i in range(30)]
    docs = documents(odd + german).withColumn("lang", F.when(F.col("doc_id") >= 500, "de"))
    docs = materialize(docs, "docs")
    seen = docs
    for name, stage in corpus_pipeline.STAGES[1:-1]:
        seen = materialize(stage(spark, seen, SF), name)
        assert seen.columns == docs.columns
    texts = [r.text for r in materialize(corpus_pipeline.exact_dedup(spark, docs, SF), "x").collect()]
    assert sorted(t or "" for t in texts) == sorted({t or "" for _, t, _ in odd + german})
    assert corpus_pipeline.pack(spark, seen, SF).count() > 0


@pytest.mark.parametrize("stage", [corpus_pipeline.exact_dedup, corpus_pipeline.near_dedup])
@pytest.mark.parametrize("rows, kept", [
    ([(7, "two words here", "a"), (9, "two words here", "a"), (7, "another text altogether", "a")], 2),
    ([(None, "dup", "a"), (5, "dup", "a"), (None, "unique", "a")], 2),
    ([(None, "dup", "a"), (None, "dup", "b"), (None, "dup", "b"), (None, "other", "a")], 2),
    ([(3, "dup", None), (3, "dup", "x"), (3, "dup", "x"), (3, None, "x"), (3, "", "x")], 2),
])
def test_one_row_of_each_text_stays(spark, documents, stage, rows, kept):
    docs = materialize(documents(rows), "docs")
    found = materialize(stage(spark, docs, SF), "found").collect()
    assert len(found) == kept
    assert {r.text or "" for r in found} == {t or "" for _, t, _ in rows}
    best = max if stage is corpus_pipeline.exact_dedup else min
    for r in found:
        ids = [i for i, t, _ in rows if (t or "") == (r.text or "") and i is not None]
        assert r.doc_id == (best(ids) if ids else None)


@needs_tables
@pytest.mark.parametrize("name", [*QUERIES, "pipeline"])
def test_only_the_result_is_left_in_the_shared_folder(spark, name, tmp_path, monkeypatch):
    monkeypatch.setattr(workspace, "shared_folder", lambda spark: str(tmp_path))
    found = __spark_entry__.queries()[name](spark, SF)
    assert found.count() > 0 and len(os.listdir(tmp_path)) == 1


def test_failures_leave_nothing(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(workspace, "shared_folder", lambda spark: str(tmp_path))

    def fails():
        materialize(spark.range(3), "first")
        return spark.range(3).select(F.raise_error(F.lit("no")))

    with pytest.raises(Exception, match="no"):
        workspace.written(spark, "result", fails)
    assert os.listdir(tmp_path) == []


def test_stages_of_nothing(spark, documents):
    docs = documents([])
    for name, stage in corpus_pipeline.STAGES:
        docs = materialize(stage(spark, docs, SF), name)
        assert docs.count() == 0


def test_language_stage(spark, documents):
    rows = [(i, f"der hund und die katze {i}", "a") for i in range(40)] + [(90, None, "a"), (91, "12 !", "a")]
    docs = documents(rows).withColumn("lang", F.lit("de"))
    kept = corpus_pipeline.known_language(spark, docs, SF).collect()
    assert {r.doc_id for r in kept} == set(range(40))


@pytest.mark.parametrize("of_rare", [1, 2])
def test_rare_languages_stay(spark, documents, of_rare):
    """Clean documents of a language that has no or a single held-back text, and one of the
    latter's words without a label."""
    rare = ["llwyn", "mynydd", "cwm", "ysgol", "gwyn", "ddu", "afon", "bwrdd"]
    r = random.Random(3)
    say = lambda of, n: " ".join(r.choice(of) for _ in range(n))
    common = ["the", "river", "house", "and", "morning", "is", "over", "water"]
    rows = [(i, say(common, 60), "a") for i in range(60)] + [(100 + i, say(rare, 60), "a") for i in range(of_rare + 1)]
    lang = F.when(F.col("doc_id") < 60, "en").when(F.col("doc_id") < 100 + of_rare, "cy")
    docs = documents(rows).withColumn("lang", lang)
    kept = {x.doc_id for x in corpus_pipeline.known_language(spark, docs, "").collect()}
    assert kept == {i for i, _, _ in rows}
