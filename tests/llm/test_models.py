import hashlib
import math
import os
import random
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from lullcast.llm import langid, quality
from lullcast.llm.quality import features, fit
from lullcast.llm.queries import op6_quality, op8_language

SF = "/root/testdata/sf0.01"
needs_tables = pytest.mark.skipif(not os.path.isdir(SF), reason="no test tables")


def test_features():
    at, values = quality.features("a b a b a")
    assert len(at) == 4 and (np.diff(at) > 0).all()
    assert values @ values == pytest.approx(1)
    assert len(quality.features("")[0]) == 0
    assert len(quality.features("one")[0]) == 1


def test_ftrl_by_hand():
    """Two updates of one weight, computed from the published formulas."""
    model = quality.Ftrl(1, alpha=0.5, beta=1.0, l1=0.1, l2=0.2)
    at, one = np.array([0]), np.array([1.0])
    model.update(at, one, 1)
    z, n = -0.5 - 0.5 / 0.5 * 0, 0.25
    assert model.z[0] == pytest.approx(z) and model.n[0] == pytest.approx(n)
    w = -(z + 0.1) / ((1 + 0.5) / 0.5 + 0.2)
    assert model.weights(at)[0] == pytest.approx(w)
    model.update(at, one, 0)
    g = 1 / (1 + math.exp(-w))
    sigma = (math.sqrt(n + g * g) - math.sqrt(n)) / 0.5
    assert model.z[0] == pytest.approx(z + g - sigma * w)


@pytest.fixture(scope="module")
def labelled():
    r = random.Random(5)
    common = [f"w{i}" for i in range(300)]
    rows = []
    for i in range(600):
        good = i % 3 > 0
        own = [r.choice(common) for _ in range(60)] + ([] if good else ["spam", "click", "now"] * 3)
        r.shuffle(own)
        rows.append((i, " ".join(own), int(good)))
    return rows


def test_quality(spark, labelled):
    frame = spark.createDataFrame([(*r, "x") for r in labelled], "doc_id bigint, text string, label int, score string")
    weights = quality.fit(frame, frame.where("doc_id < 400"), bits=14)
    found = {r.doc_id: r.score for r in quality.score(frame, weights).collect()}
    rest = [(found[d], y) for d, _, y in labelled if d >= 400]
    assert np.mean([(s >= 0.5) == y for s, y in rest]) > 0.95
    text = dict((d, t) for d, t, _ in labelled)[401]
    at, values = quality.features(text, 14)
    by_hand = quality.logistic(weights[at] @ values + weights[-1])
    assert found[401] == pytest.approx(by_hand, abs=1e-5)


def test_quality_odd(documents, odd):
    none = documents([]).withColumn("label", F.lit(1))
    weights = quality.fit(none, none, bits=10)
    rows = quality.score(documents(odd), weights).collect()
    assert len(rows) == len(odd) and {r.score for r in rows} == {0.5}
    assert "text" not in rows[0] and rows[0].row == "x"
    nulls = documents(odd).withColumn("label", F.lit(None).cast("int"))
    assert not quality.fit(nulls, nulls, bits=10).any()
    ones = documents(odd).withColumn("label", F.lit(1))
    assert quality.fit(ones, ones, bits=10).any()


@needs_tables
def test_quality_held_out(spark):
    scored = op6_quality(spark, SF).where("held_out")
    rows = scored.join(spark.read.parquet(f"{SF}/labels.parquet"), "doc_id").collect()
    good = [r.score for r in rows if r.quality == 1]
    bad = [r.score for r in rows if r.quality == 0]
    assert np.mean([g > b for g in good for b in bad]) > 0.9


def test_letters():
    codes = langid.letters("  Ab, C1\n")
    assert "".join(map(chr, codes)) == "ab c "
    assert len(langid.letters("123 !")) == 0 and len(langid.letters("")) == 0
    assert "".join(map(chr, langid.letters("É𝐀"))).startswith("é")


def plain_model(texts, order):
    """Interpolated Kneser-Ney over dictionaries, from the published formulas."""
    counts = [Counter() for _ in range(order + 1)]
    for text in texts:
        padded = " " * (order - 1) + "".join(map(chr, langid.letters(text)))
        for i in range(order - 1, len(padded)):
            for n in range(1, order + 1):
                counts[n][padded[i - n + 1 : i + 1]] += 1
    used = [None] * (order + 1)
    used[order] = counts[order]
    for n in range(1, order):
        used[n] = Counter(g[1:] for g in counts[n + 1])
    discounts = [None]
    for n in range(1, order + 1):
        n1, n2 = (sum(1 for c in used[n].values() if c == k) for k in (1, 2))
        discounts.append(n1 / (n1 + 2 * n2) if n1 and n2 else 0.5)
    totals, kinds = defaultdict(int), defaultdict(int)
    for n in range(1, order + 1):
        for g, c in used[n].items():
            totals[n, g[:-1]] += c
            kinds[n, g[:-1]] += 1
    floor = 1 / (2 * len(used[1]))

    def probability(gram):
        p = floor
        for n in range(1, order + 1):
            g = gram[-n:]
            total = totals[n, g[:-1]]
            if total:
                own = max(used[n][g] - discounts[n], 0) / total if g in used[n] else 0.0
                p = own + discounts[n] * kinds[n, g[:-1]] / total * p
        return p

    def entropy(text):
        padded = " " * (order - 1) + "".join(map(chr, langid.letters(text)))
        n = len(padded) - order + 1
        return -sum(math.log(probability(padded[i : i + order])) for i in range(n)) / max(n, 1)

    return entropy


def test_entropies_equal_the_formulas(spark):
    texts = ["the cat sat on the mat", "That cat, the other cat!", "", "on on on"]
    models = langid.fit_models(spark.createDataFrame([("en", t) for t in texts], "lang string, text string"), 3)
    plain = plain_model(texts, 3)
    asked = ["the hat", "zzz", "cat on mat " * 20, "12", "Österreich"]
    found, sizes = langid.Scorer(models)(asked)
    assert list(found[:, 0]) == pytest.approx([plain(t) if n else 0.0 for t, n in zip(asked, sizes)])


def test_long_texts_are_scored_whole(spark, monkeypatch):
    texts = ["the cat sat on the mat", "a dog"]
    models = langid.fit_models(spark.createDataFrame([("en", t) for t in texts], "lang string, text string"))
    asked = ["the cat and a dog " * 50, "sat", "the cat and a dog " * 50]
    whole, _ = langid.Scorer(models)(asked)
    monkeypatch.setattr(langid, "_BLOCK", 37)
    parts, _ = langid.Scorer(models)(asked)
    assert parts == pytest.approx(whole)


def test_languages_odd(spark, documents, odd):
    models = langid.learn(documents(odd))
    assert models == {}
    rows = langid.identify(documents(odd), models).collect()
    assert {(r.guess, r.rejected, r.confidence) for r in rows} == {("und", True, 0.0)}
    rows = [(i, f"das ist ein satz {i}", "de") for i in range(20)] + [(99, None, "de"), (98, "x", None)]
    frame = spark.createDataFrame([(*r, "z") for r in rows], "doc_id bigint, text string, lang string, size string")
    found = {r.doc_id: r for r in langid.identify(frame, langid.learn(frame)).collect()}
    assert found[99].guess == "und" and found[99].rejected
    assert found[3].guess == "de" and not found[3].rejected
    assert langid.identify(frame.limit(0), {}).collect() == []


@needs_tables
def test_languages_held_out(spark):
    found = op8_language(spark, SF)
    documents = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "lang")
    rows = found.where("held_out").join(documents, "doc_id").collect()
    assert np.mean([r.lang_pred == r.lang for r in rows]) > 0.98
    assert np.mean([r.rejected for r in rows]) < 0.01


def test_foreign_text_is_rejected(spark):
    r = random.Random(1)
    parts = ["ing", "the", "on", "er", "th", "an"]
    texts = [" ".join("".join(r.choices(parts, k=2)) for _ in range(60)) for _ in range(80)]
    frame = spark.createDataFrame([(i, t, "en") for i, t in enumerate(texts)], "doc_id bigint, text string, lang string")
    models = langid.learn(frame)
    asked = spark.createDataFrame([(1, "xqzv kjwq " * 40), (2, texts[0])], "doc_id bigint, text string")
    assert {x.doc_id: x.rejected for x in langid.identify(asked, models).collect()} == {1: True, 2: False}


@needs_tables
@pytest.mark.parametrize("unseen", ["de", "en"])
def test_an_unseen_language_is_rejected(spark, unseen):
    """Models without one of the languages: how much of it is accepted, and of the others rejected."""
    rows = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").where("lang is not null")
    models = langid.learn(rows.where(F.col("lang") != unseen))
    found = langid.identify(rows.select("lang", "text"), models).where("size > 200").groupBy("lang")
    rejected = {r[0]: r[1] for r in found.agg(F.avg(F.col("rejected").cast("int"))).collect()}
    print(rejected)
    assert rejected.pop(unseen) > 0.8
    assert max(rejected.values()) < 0.02


def ftrl_by_rows(rows, bits, passes, alpha=4.0, beta=1.0, l1=0.01, l2=0.01):
    """Weights by the published update, one coordinate at a time."""
    z, n = {}, {}

    def weight(k):
        if abs(z.get(k, 0.0)) <= l1:
            return 0.0
        return -(z[k] - math.copysign(l1, z[k])) / ((beta + math.sqrt(n[k])) / alpha + l2)

    for _ in range(passes):
        for text, label in rows:
            at, values = features(text, bits)
            vector = {**dict(zip(at.tolist(), values.tolist())), "bias": 1.0}
            p = 1 / (1 + math.exp(-sum(weight(k) * v for k, v in vector.items())))
            for k, v in vector.items():
                g, w, before = (p - label) * v, weight(k), n.get(k, 0.0)
                z[k] = z.get(k, 0.0) + g - (math.sqrt(before + g * g) - math.sqrt(before)) / alpha * w
                n[k] = before + g * g
    return {k: weight(k) for k in z}


def test_fit_equals_the_update_by_hand(spark, words):
    rows = [(i, " ".join(words(30, i, 40))) for i in range(60)]
    labels = [(i, float(i % 2)) for i in range(50)] + [(50, 0.7), (51, None), (None, 1.0), (999, 1.0)]
    documents = spark.createDataFrame(rows, "doc_id bigint, text string")
    found = fit(documents, spark.createDataFrame(labels, "doc_id bigint, label double"), bits=10, passes=3)
    order = lambda i: int(hashlib.md5(f"quality:{i}".encode()).hexdigest()[:15], 16)
    wanted = ftrl_by_rows([(rows[i][1], i % 2) for i in sorted(range(50), key=order)], 10, 3)
    assert found[-1] == pytest.approx(wanted.pop("bias"))
    for k in range(1 << 10):
        assert found[k] == pytest.approx(wanted.get(k, 0.0), abs=1e-12)
