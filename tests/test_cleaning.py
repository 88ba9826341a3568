import datetime
import math

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from lullcast.config import settings
from lullcast.functions.text import normalize_name, row_key_batch, row_key_step
from lullcast.operators import cleaning, matrix
from lullcast.schema import PanelSchema


def values(df, column, *order):
    return [r[column] for r in df.orderBy(*order).collect()]


def test_clip_leaves_no_negatives_and_keeps_nulls(spark):
    df = spark.createDataFrame([(-1, 3), (2, -4), (None, 0)], "a bigint, b bigint")
    out = cleaning.clip_negatives(df, ["a", "b"])
    assert sorted((r.a is None, r.a or 0, r.b) for r in out.collect()) == [
        (False, 0, 3), (False, 2, 0), (True, 0, 0),
    ]


def test_clipped_columns_default_to_the_target():
    roles = PanelSchema("ds", "y")
    assert cleaning.non_negative_columns({"data": {}}, roles) == ["y"]
    assert cleaning.non_negative_columns({"data": {"non_negative_cols": []}}, roles) == []


def test_names_and_ids(spark):
    df = spark.createDataFrame(
        [("  a  b\t", "x　y"), ("a b", "\x1cz\n"), (None, "k")], "a string, b string"
    )
    roles = PanelSchema("ds", "y", ("a", "b"))
    kept = cleaning.with_series_id(cleaning.drop_null_keys(df, roles), roles)
    assert values(kept, "id", "b") == ["a_b__z", "a_b__x_y"]
    single = cleaning.with_series_id(df, PanelSchema("ds", "y"))
    assert {r.id for r in single.collect()} == {"__single__"}
    assert df.select(normalize_name(F.col("a")).alias("n")).filter("n is null").count() == 1


def test_row_keys(spark):
    keys = ["TEST_00+영업3일", "TEST_01+a07+9", "plain", "TEST_02+일", None]
    df = spark.createDataFrame([(k,) for k in keys], "k string")
    out = df.select("k", row_key_batch(F.col("k")).alias("b"), row_key_step(F.col("k")).alias("n"))
    assert [(r.b, r.n) for r in out.collect()] == [
        ("TEST_00", 3), ("TEST_01", 7), (None, None), ("TEST_02", None), (None, None),
    ]


def test_lenient_and_strict_dates(spark):
    df = spark.createDataFrame([("2021-02-03",), ("soon",), ("2021-02-30",)], "ds string")
    kept = cleaning.parse_dates_leniently(df, "ds").collect()
    assert [r.ds for r in kept] == [datetime.date(2021, 2, 3)]
    with pytest.raises(PySparkException):
        cleaning.parse_dates(df, "ds").collect()


def test_first_of_duplicates_stays_even_if_one_pair_dominates(spark):
    rows = [("hot", "2021-01-01", 500 - i, i) for i in range(500)] + [("b", "2021-01-01", 7, 0)]
    df = spark.createDataFrame(rows, "id string, ds string, y bigint, o bigint").repartition(7)
    out = cleaning.keep_first(df, PanelSchema("ds", "y", ("id",)), ["o"])
    assert values(out, "y", "id") == [7, 500]
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert plan.count("WindowGroupLimit") == 2


def test_prepared_panel(spark):
    df = spark.createDataFrame(
        [("a ", "2021-01-02", -3.0, 1), ("a ", "2021-01-02", 5.0, 2), (None, "2021-01-01", 1.0, 3),
         ("a ", "2021-01-01", float("nan"), 4)],
        "store_id string, date string, sales double, line int",
    )
    roles = PanelSchema("date", "sales", ("store_id",))
    out = cleaning.prepare_panel(df, roles, settings(), ["line"]).orderBy("date").collect()
    assert [(r.id, str(r.date), r.sales) for r in out] == [
        ("a", "2021-01-01", None), ("a", "2021-01-02", 0.0),
    ]
    facts = cleaning.count_null_keys(df, roles).first()
    assert (facts.n_rows, facts.n_without_key) == (4, 1)


def test_context_guard_names_short_series(panel):
    ok, short = panel(a=[1] * 28), panel(a=[1] * 28, b=[1] * 27)
    cleaning.require_context(ok, ["id"])
    with pytest.raises(ValueError, match="fewer than 28.*'b'"):
        cleaning.require_context(short, ["id"])


def test_scrub(spark):
    df = spark.createDataFrame(
        [(math.inf, None, None), (float("nan"), 3, "x"), (-math.inf, 4, ""), (2.5, 5, "y")],
        "a double, b int, c string",
    )
    assert [tuple(r) for r in matrix.scrub(df).collect()] == [
        (0.0, 0, "missing"), (0.0, 3, "x"), (0.0, 4, ""), (2.5, 5, "y"),
    ]


def test_informative_columns(spark):
    df = spark.createDataFrame(
        [(1, None, 2, "a"), (1, None, None, "b")], "one int, none int, gap int, text string"
    )
    assert matrix.informative_columns(df, df.columns) == ["text"]
    assert matrix.informative_columns(df, []) == []


def test_alignment(spark):
    df = spark.createDataFrame([(1, 2, 3)], "a int, b int, extra int")
    out = matrix.align_features(df, ["b", "new", "a"])
    assert out.columns == ["b", "new", "a"] and tuple(out.first()) == (2, 0, 1)
    with pytest.raises(ValueError):
        matrix.require_same_features(["a"], ["b"])


def test_category_codes(spark):
    df = spark.createDataFrame([("b",), ("a",), (None,)], "k string")
    codes = {r.k: r.code for r in matrix.category_codes(df, "k", "code").collect()}
    assert codes == {"a": 0.0, "b": 1.0, "missing": 2.0}
    many = spark.range(30_000).select(F.format_string("%08d", F.col("id") * 7919 % 30_000).alias("a.k"))
    coded = matrix.category_codes(many.repartition(5), "a.k", "code")
    assert coded.filter(F.col("`a.k`").cast("double") != F.col("code")).count() == 0
    assert coded.count() == 30_000
