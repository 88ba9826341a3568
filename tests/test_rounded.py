"""Rounding to six digits without a decimal number for every value."""

import math
import struct
import time

from pyspark.sql import functions as F

from workload.registry import FEW, rounded


def bits(value):
    return None if value is None else struct.pack("d", value) if not math.isnan(value) else "nan"


def test_rounds_like_spark(spark):
    awkward = [
        None, math.nan, math.inf, -math.inf, 0.0, -0.0, 1e-7, -1e-7, 4.9999999999999994e-7, 5e-7, -5e-7, 1.5e-6, 2.5e-6,
        1.0000005, -1.0000005, 1.0000004999999999, 0.1234565, 999999.9999995, 999999.9999994, 1e6 + 0.0000005,
        123456789.1234565, 1e12 + 0.3, 9007199254740993.0, 1e300, -1e300, 5e-324, 1 / 3, -2 / 3, 1 / 28, 0.5,
    ]
    near = [(k + 0.5) * 1e-6 * (1 + e) for k in range(0, 2_000_000, 9973) for e in (0, 1e-16, -1e-16, 3e-16, 1e-9, -1e-9)]
    rows = spark.createDataFrame([(v,) for v in [*awkward, *near, *(-v for v in near)]], "x double")
    spread = spark.range(50_000).select(((F.rand(3) - 0.5) * F.pow(F.lit(10.0), F.rand(4) * 16 - 4)).alias("x"))
    found = rounded(rows.union(spread).withColumn("y", F.col("x")), "y").withColumn("want", F.round("x", 6)).collect()
    assert [r.x for r in found if bits(r.y) != bits(r.want)] == []


def test_other_kinds_are_rounded_by_spark(spark):
    kinds = spark.sql("SELECT CAST(1.23456789 AS DECIMAL(12, 8)) AS a, CAST(1.23456789 AS FLOAT) AS b, 7 AS c")
    found, want = rounded(kinds, "a", "b", "c"), kinds.select(*(F.round(c, 6).alias(c) for c in "abc"))
    assert found.schema.simpleString() == want.schema.simpleString() and found.collect() == want.collect()


def test_takes_less_time_than_decimals(spark):
    values = spark.range(0, 3_000_000, 1, 4).select((F.col("id") / 28).alias("x"))

    def seconds(df):
        taken = []
        for _ in range(3):
            began = time.perf_counter()
            df.write.format("noop").mode("overwrite").save()
            taken.append(time.perf_counter() - began)
        return min(taken)

    assert seconds(rounded(values, "x")) < 0.7 * seconds(values.withColumn("x", F.round("x", 6)))


def test_many_columns_keep_short_code(spark):
    for n, short in ((FEW, False), (FEW + 1, True)):
        names = [f"c{i}" for i in range(n)]
        wide = spark.range(3).select(*((F.col("id") / (i + 3)).alias(c) for i, c in enumerate(names)))
        out = rounded(wide, *names)
        assert ("rint" not in out._jdf.queryExecution().analyzed().toString().lower()) == short
        assert out.collect() == wide.select(*(F.round(c, 6).alias(c) for c in names)).collect()
