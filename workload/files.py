"""Batch files, templates, submissions, the feature cache and saved artifacts."""

from __future__ import annotations

from pyspark.sql import functions as F

from lullcast.operators import windows
from lullcast.operators.models import fit_classifier, fit_regressor
from lullcast.plans.training import scorer_from
from lullcast.sources.readers import read_batches, read_template, read_wide
from lullcast.sources.store import (
    MONTH,
    Artifacts,
    cache_key,
    cached_features,
    load_artifacts,
    save_artifacts,
)
from lullcast.sources.writers import write_submission, write_wide
from lullcast.workspace import materialize, new_path
from workload.dates import columns
from workload.registry import (
    BATCH_CFG,
    CFG,
    SUPPLIER,
    SUPPLIER_SQL,
    case,
    rounded,
    six,
    supplier_panel,
    table,
)
from workload.models import CHANCE, ONE_TREE, WEEKDAYS, weekday_rows
from workload.windows import BY_ID, lag_sql

BATCH_STEMS = ("TEST_00", "TEST_0 1", "TEST_0+2%20")


@case(
    """
    SELECT ['TEST_00', 'TEST_0 1', 'TEST_0+2%20'][CAST(user_id % 3 AS INTEGER) + 1] AS test_name,
           CAST(user_id AS VARCHAR) || '__' || event_type || '_x' AS id,
           CAST(ts AS DATE) AS day,
           CAST(count(*) AS DOUBLE) AS sold
    FROM events GROUP BY 1, 2, 3
    """
)
def batch_files(spark, sf_dir):
    folder = new_path(spark, "batches")
    menu = F.concat(F.lit(" "), "event_type", F.lit(" x"))
    days = table(spark, sf_dir, "events").groupBy(
        F.col("user_id").alias("shop"), menu.alias("menu"), F.to_date("ts").alias("day")
    ).agg(F.count("*").alias("sold"))
    for k in range(3):
        names = days.columns[k:] + days.columns[:k]  # every file orders its columns differently
        batch = days.filter(F.col("shop") % 3 == k).select(*names)
        batch.write.option("header", True).csv(f"{folder}/{BATCH_STEMS[k]}.csv")
    panel, _ = read_batches(
        spark, folder, BATCH_CFG, "shop bigint, menu string, day string, sold bigint"
    )
    return panel.select("test_name", "id", "day", "sold")


@case(
    """
    SELECT CAST(s_suppkey AS VARCHAR) AS id, s_name AS "name",
           CASE WHEN s_nationkey = 3 THEN NULL ELSE s_acctbal END AS D1, CAST(NULL AS VARCHAR) AS D2
    FROM supplier
    """
)
def submission_file(spark, sf_dir):
    path = new_path(spark, "submission")
    suppliers = table(spark, sf_dir, "supplier")
    out = suppliers.select(
        F.col("s_suppkey").alias("id"),
        F.col("s_name").alias("name"),
        F.when(F.col("s_nationkey") != 3, F.col("s_acctbal")).alias("D1"),
        F.lit("NaN").alias("D2"),
        F.col("s_suppkey").alias("_row"),
    )
    write_submission(out, ["id", "name", "D1", "D2"], path)
    return read_template(spark, path).select("id", "name", F.col("D1").cast("double"), "D2")


@case(
    """
    SELECT CAST(o_orderdate AS DATE) AS date, 'customer "' || o_custkey || '", all' AS series,
           min(o_totalprice) AS value
    FROM orders GROUP BY 1, 2
    """
)
def wide_file(spark, sf_dir):
    """A column for every customer, more than a pivot takes at sf0.1."""
    orders = table(spark, sf_dir, "orders")
    name = F.format_string('customer "%d", all', "o_custkey")
    path = new_path(spark, "wide")
    days = orders.select(F.to_date("o_orderdate").alias("ds"), name.alias("id"), F.col("o_totalprice").alias("y"))
    write_wide(days, "ds", "id", "y", path)
    return read_wide(spark, path)


@case(f"WITH {SUPPLIER_SQL} SELECT id, ds, y, {columns(lag_sql())} FROM panel WINDOW w AS ({BY_ID})")
def cached_feature_table(spark, sf_dir):
    """Written for a panel without its last 40 days, then brought up to date."""
    base, key = new_path(spark, "cache"), cache_key(CFG, sf_dir)
    panel = materialize(supplier_panel(spark, sf_dir), "panel")  # digests and builds read it, twice each
    last = panel.agg(F.max("ds")).first()[0]
    lags = CFG["features"]["lags"]

    def features(rows):
        def build(first=None):
            make = lambda s: [windows.lag_layers(s, lags)]
            return windows.with_layers(rows, SUPPLIER, max(lags), make, first=first)

        return cached_features(spark, base, key, "ds", build, rows)

    features(panel.where(F.col("ds") <= F.date_sub(F.lit(last), 40)))
    return features(panel).drop(MONTH)


@case(
    f"""
    WITH {SUPPLIER_SQL}, {WEEKDAYS}
    SELECT dow, {six(CHANCE)} AS p, {six("amount")} AS q, 'ds' AS date_name, 'y' AS target_name,
           'id' AS series_name, CAST(0.37 AS DOUBLE) AS threshold, CAST(1 AS INTEGER) AS n_features,
           (SELECT min(ds) FROM panel) AS origin
    FROM groups
    """
)
def artifact_facts(spark, sf_dir):
    """Two fitted models, saved, loaded, and asked for every weekday."""
    path = new_path(spark, "artifacts")
    rows = weekday_rows(spark, sf_dir)
    classifier = fit_classifier(rows, "y", ["dow"], ["dow"], params=ONE_TREE)
    regressor = fit_regressor(rows, "y", ["dow"], ["dow"], params=ONE_TREE)
    first = rows.select(F.min("ds")).first()[0]
    made = Artifacts(
        SUPPLIER, CFG, ["dow"], ["dow"], 0.37, str(first),
        classifier=classifier.model, regressor=regressor.model, regressor_features=["dow"],
    )
    save_artifacts(spark, made, path)
    back = load_artifacts(spark, path)
    scored = scorer_from(back).score(rows.select("dow").distinct())
    return rounded(scored, "p", "q").select(
        "dow", "p", "q",
        F.lit(back.schema.date).alias("date_name"),
        F.lit(back.schema.target).alias("target_name"),
        F.lit(back.schema.series[0]).alias("series_name"),
        F.lit(back.threshold).alias("threshold"),
        F.lit(len(back.features)).alias("n_features"),
        F.lit(back.origin).cast("date").alias("origin"),
    )
