import random

import pytest
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.regression import IsotonicRegression
from pyspark.sql import functions as F

from lullcast.operators import isotonic
from lullcast.operators.isotonic import Isotonic, isotonic_pools


def shaped(kind, n=300):
    r = random.Random(7)
    for i in range(n):
        p = r.choice((r.random(), round(r.random(), 1)))
        chance = {"rising": p, "falling": 1 - p, "flat": 0.5, "bump": 4 * p * (1 - p), "steps": round(p, 1)}[kind]
        yield (p, float(chance if kind == "steps" else r.random() < chance))


@pytest.mark.parametrize("kind", ["rising", "falling", "flat", "bump", "steps"])
@pytest.mark.parametrize("range_rows", [7, 100_000])
def test_equals_mllib(spark, kind, range_rows):
    df = spark.createDataFrame([*shaped(kind), (None, 1.0), (0.4, None)], "p double, c double")
    fitted = Isotonic(isotonic_pools(df, "p", "c", range_rows), range_rows)
    model = IsotonicRegression(featuresCol="v", labelCol="c", weightCol="n")
    train = df.dropna().groupBy("p").agg(F.avg("c").alias("c"), F.count("*").cast("double").alias("n"))
    as_vector = VectorAssembler(inputCols=["p"], outputCol="v")
    model = model.fit(as_vector.transform(train))
    asked = spark.createDataFrame([(x / 97 - 0.2,) for x in range(140)] + [(0.5,)] * 3, "p double")
    asked = asked.unionByName(train.select("p"))
    wanted = {r.p: r.prediction for r in model.transform(as_vector.transform(asked)).collect()}
    found = fitted.transform(asked, "p", "fit").collect()
    assert len(found) == asked.count()
    for r in found:
        assert r.fit == pytest.approx(wanted[r.p], abs=1e-12)
    assert fitted.transform(spark.createDataFrame([(None,)], "p double"), "p", "fit").first().fit is None


def test_a_million_chances_and_few_rows_to_the_driver(spark, monkeypatch):
    """Ten ranges of as many distinct chances; only their outermost pools are collected."""
    seen = []
    violated = isotonic._violated
    monkeypatch.setattr(isotonic, "_violated", lambda pools: seen.append(pools.select("range").distinct().count()) or violated(pools))
    draw = F.pmod(F.xxhash64("id"), F.lit(1000)) / 1000
    df = spark.range(1_000_000).select((F.col("id") / 1e6).alias("p"), (draw < F.col("id") / 1e6).cast("double").alias("c"))
    pools = isotonic_pools(df, "p", "c")
    assert 0 < max(seen) <= 10 and len(seen) < 12
    rows = pools.orderBy("low").collect()
    assert all(a.mean < b.mean and a.high < b.low for a, b in zip(rows, rows[1:]))
    assert 100 < len(rows) < 100_000
    assert all(abs(r.mean - (r.low + r.high) / 2) < 0.1 for r in rows[5:-5])


def test_nothing_to_fit(spark):
    empty = spark.createDataFrame([], "p double, c double")
    fitted = Isotonic(isotonic_pools(empty, "p", "c"))
    assert fitted.transform(spark.createDataFrame([(0.5,)], "p double"), "p", "fit").first().fit is None
