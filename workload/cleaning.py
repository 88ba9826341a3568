"""Loading, role resolution, cleaning and the model matrix."""

from __future__ import annotations

from pyspark.sql import functions as F

from lullcast.functions.text import normalize_name
from lullcast.operators import cleaning, matrix
from lullcast.plans.panels import daily_totals
from lullcast.schema import PanelSchema, canonical_date, resolve_roles
from lullcast.sources.readers import first_rows, read_panel
from workload.registry import (
    CFG,
    USER_TYPE,
    USER_TYPE_SQL,
    case,
    table,
    user_type_days,
)

LINEITEM_ROLES = {
    **CFG,
    "data": {
        "date_col_candidates": ["ship_date", "l_shipdate"],
        "target_col": "l_quantity",
        "id_cols": ["l_suppkey", "no_such_key"],
    },
}
FIRST_LINE = ["l_orderkey", "l_linenumber", "l_partkey", "l_quantity"]


@case(
    """
    WITH ranked AS (
      SELECT CAST(l_suppkey AS VARCHAR) AS id, CAST(l_shipdate AS DATE) AS ds, l_quantity AS y,
             row_number() OVER (
               PARTITION BY l_suppkey, CAST(l_shipdate AS DATE)
               ORDER BY l_orderkey, l_linenumber, l_partkey, l_quantity) AS place
      FROM lineitem WHERE l_suppkey IS NOT NULL)
    SELECT id, ds, CASE WHEN y < 0 THEN 0 ELSE y END AS y FROM ranked WHERE place = 1
    """
)
def panel_load(spark, sf_dir):
    path = f"{sf_dir}/lineitem.parquet"
    panel, roles = read_panel(spark, path, LINEITEM_ROLES, "parquet", tie_break=FIRST_LINE)
    return panel.select("id", F.col(roles.date).alias("ds"), F.col(roles.target).alias("y"))


@case(
    """
    SELECT l_suppkey, l_shipdate, l_orderkey, l_linenumber, l_quantity FROM lineitem
    ORDER BY l_suppkey, l_shipdate, l_orderkey, l_linenumber, l_quantity LIMIT 1000
    """
)
def capped_scan(spark, sf_dir):
    order = ["l_suppkey", "l_shipdate", "l_orderkey", "l_linenumber", "l_quantity"]
    return first_rows(table(spark, sf_dir, "lineitem").select(*order), 1000, *order)


@case("SELECT user_id, CAST(ts AS DATE) AS ds, value AS y FROM events")
def role_projection(spark, sf_dir):
    events = table(spark, sf_dir, "events")
    cfg = {
        "data": {
            "date_col": "day",
            "date_col_candidates": ["date", "ts"],
            "target_col_candidates": ["sales", "value"],
            "id_col_candidates": ["store_id", "user_id"],
        }
    }
    roles = resolve_roles(events.columns, cfg)
    return events.select(
        *roles.series, F.to_date(roles.date).alias("ds"), F.col(roles.target).alias("y")
    )


@case("SELECT o_custkey, o_orderdate AS ds, o_totalprice FROM orders")
def detected_date(spark, sf_dir):
    orders = table(spark, sf_dir, "orders").select("o_custkey", "o_orderdate", "o_totalprice")
    return canonical_date(orders, "o_custkey", "o_totalprice")


@case(
    """
    SELECT o_orderkey, CAST(o_orderdate AS DATE) AS ds FROM orders
    WHERE o_orderpriority NOT LIKE '5%'
    """
)
def lenient_dates(spark, sf_dir):
    text = F.date_format("o_orderdate", "yyyy-MM-dd")
    broken = F.when(F.col("o_orderpriority").startswith("5"), F.concat(F.lit("on "), text))
    orders = table(spark, sf_dir, "orders").select(
        "o_orderkey", F.coalesce(broken, text).alias("ds")
    )
    return cleaning.parse_dates_leniently(orders, "ds")


@case("SELECT o_orderkey, CAST(o_orderdate AS DATE) AS ds FROM orders")
def strict_dates(spark, sf_dir):
    text = F.date_format("o_orderdate", "yyyy-MM-dd").alias("ds")
    return cleaning.parse_dates(table(spark, sf_dir, "orders").select("o_orderkey", text), "ds")


@case(
    """
    SELECT p_partkey, p_brand, CAST(dense_rank() OVER (ORDER BY p_brand) - 1 AS DOUBLE) AS code
    FROM part
    """
)
def key_categories(spark, sf_dir):
    part = table(spark, sf_dir, "part").select("p_partkey", "p_brand")
    return matrix.category_codes(part, "p_brand", "code")


@case(
    """
    SELECT user_id, ds, event_id, value FROM (
      SELECT user_id, CAST(ts AS DATE) AS ds, event_id, value,
             row_number() OVER (PARTITION BY user_id, CAST(ts AS DATE) ORDER BY event_id) AS place
      FROM events) WHERE place = 1
    """
)
def kept_first(spark, sf_dir):
    events = table(spark, sf_dir, "events")
    days = events.select("user_id", F.to_date("ts").alias("ds"), "event_id", "value")
    return cleaning.keep_first(days, PanelSchema("ds", "value", ("user_id",)), ["event_id"])


WHITE_SQL = r"[\t-\r\x1c-\x1f\x{85}\p{Z}]+"


@case(
    f"""
    SELECT doc_id, regexp_replace(
      regexp_replace(text, '^{WHITE_SQL}|{WHITE_SQL}$', '', 'g'), '{WHITE_SQL}', '_', 'g') AS name
    FROM documents
    """
)
def normalized_documents(spark, sf_dir):
    documents = table(spark, sf_dir, "documents")
    return documents.select("doc_id", normalize_name(F.col("text")).alias("name"))


@case("SELECT p_partkey, replace(p_name, ' ', '_') AS name FROM part")
def normalized_names(spark, sf_dir):
    spaced = F.concat(
        F.lit(" \t"),
        F.replace("p_name", F.lit(" "), F.lit(" \u3000 ")),
        F.lit("\u3000\n"),
    )
    return table(spark, sf_dir, "part").select(
        "p_partkey", normalize_name(spaced).alias("name")
    )


@case(
    f"""
    WITH {USER_TYPE_SQL}
    SELECT CAST(user_id AS VARCHAR) || '__' || event_type AS id, ds, y FROM daily
    WHERE user_id IS NOT NULL AND event_type IS NOT NULL
    """
)
def series_ids(spark, sf_dir):
    days = cleaning.drop_null_keys(user_type_days(spark, sf_dir), USER_TYPE)
    return cleaning.with_series_id(days, USER_TYPE).select("id", "ds", "y")


@case(
    """
    SELECT count(*) AS n_rows, count(*) FILTER (WHERE c_mktsegment = 'MACHINERY') AS n_without_key
    FROM customer
    """
)
def rows_without_key(spark, sf_dir):
    segment = F.when(F.col("c_mktsegment") != "MACHINERY", F.col("c_mktsegment"))
    customers = table(spark, sf_dir, "customer").select(segment.alias("segment"))
    return cleaning.count_null_keys(customers, PanelSchema("ds", "y", ("segment",)))


@case(
    """
    SELECT c_custkey, CASE WHEN c_acctbal < 0 THEN 0 ELSE c_acctbal END AS c_acctbal FROM customer
    """
)
def clipped_negatives(spark, sf_dir):
    customers = table(spark, sf_dir, "customer").select("c_custkey", "c_acctbal")
    return cleaning.clip_negatives(customers, ["c_acctbal"])


@case(
    """
    SELECT user_id, count(*) AS n_rows FROM (SELECT DISTINCT user_id, CAST(ts AS DATE) FROM events)
    GROUP BY user_id HAVING count(*) < 28
    """
)
def short_series(spark, sf_dir):
    schema = PanelSchema("ds", "y", ("user_id",))
    events = table(spark, sf_dir, "events")
    days = daily_totals(events, schema, F.to_date("ts"), F.lit(1), ["user_id"])
    return cleaning.short_series(days, ["user_id"], 28)


@case("SELECT l_orderkey, l_linenumber, l_quantity FROM lineitem")
def dropped_columns(spark, sf_dir):
    items = table(spark, sf_dir, "lineitem")
    kept = ("l_orderkey", "l_linenumber", "l_quantity")
    return matrix.drop_columns(items, [c for c in items.columns if c not in kept] + ["no_such"])


@case(
    """
    SELECT c_custkey,
           CASE WHEN c_nationkey = 3 OR c_acctbal < 0 OR c_acctbal > 9000 THEN 0 ELSE c_acctbal
           END AS balance,
           CASE WHEN c_nationkey = 4 THEN 0 ELSE c_nationkey END AS nation
    FROM customer
    """
)
def scrubbed_numbers(spark, sf_dir):
    balance, nation = F.col("c_acctbal"), F.col("c_nationkey")
    dirty = (
        F.when(balance < 0, float("inf"))
        .when(balance > 9000, float("nan"))
        .when(nation != 3, balance)
    )
    customers = table(spark, sf_dir, "customer").select(
        "c_custkey", dirty.alias("balance"), F.when(nation != 4, nation).alias("nation")
    )
    return matrix.scrub(customers)


@case(
    """
    SELECT c_custkey,
           CASE WHEN c_mktsegment = 'MACHINERY' THEN 'missing' ELSE c_mktsegment END AS segment
    FROM customer
    """
)
def filled_categories(spark, sf_dir):
    segment = F.when(F.col("c_mktsegment") != "MACHINERY", F.col("c_mktsegment"))
    customers = table(spark, sf_dir, "customer").select("c_custkey", segment.alias("segment"))
    return matrix.scrub(customers)


PROFILE_COLUMNS = {
    "l_quantity": "l_quantity",
    "l_tax": "l_tax",
    "l_returnflag": "l_returnflag",
    "l_linenumber": "l_linenumber",
    "one_value": "1",
    "one_value_or_null": "CASE WHEN l_tax > 0.04 THEN 7 END",
    "all_null": "CAST(NULL AS DOUBLE)",
}


@case(
    " UNION ALL ".join(
        f"""SELECT count(*) AS n_rows, '{name}' AS "column", count({e}) AS n_known,
        count(DISTINCT {e}) > 1 AS keep FROM lineitem"""
        for name, e in PROFILE_COLUMNS.items()
    )
)
def column_profile(spark, sf_dir):
    items = table(spark, sf_dir, "lineitem")
    named = items.select(*[F.expr(e).alias(name) for name, e in PROFILE_COLUMNS.items()])
    return matrix.column_profile(named, list(PROFILE_COLUMNS))


@case(
    """
    SELECT l_orderkey, l_linenumber, l_tax, CAST(0 AS INTEGER) AS not_there, l_quantity
    FROM lineitem
    """
)
def aligned_features(spark, sf_dir):
    items = table(spark, sf_dir, "lineitem")
    frozen = ["l_tax", "not_there", "l_quantity"]
    return matrix.align_features(items, frozen, keep=["l_orderkey", "l_linenumber"])
