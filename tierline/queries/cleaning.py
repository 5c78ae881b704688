"""Queries for the clean and transform steps."""

from __future__ import annotations

from pyspark.sql import functions as F

from tierline.mapping import (CUSTOM, ColumnRule, dated_key, day, decimal2, generated,
                              identity_key, integer, phone, string, table)
from tierline.operators.clean import clean, drop_duplicate_rows, fill_defaults
from tierline.operators.transform import transform
from tierline.queries.registry import AS_OF, RUN_ID, given, query, source
from tierline.session import scratch_path
from tierline.sources.bronze import null_row

_DAY = "date_format(o_orderdate, 'yyyy-MM-dd')"


@query("dedup_rows", """
    SELECT DISTINCT * FROM (
      SELECT * FROM orders UNION ALL SELECT * FROM orders WHERE o_orderstatus = 'F')""")
def dedup_rows(spark, sf_dir):
    orders = given(spark, sf_dir, "orders")
    return drop_duplicate_rows(orders.unionByName(orders.filter("o_orderstatus = 'F'")))


@query("fill_defaults", """
    SELECT c_custkey, coalesce(CASE WHEN c_mktsegment <> 'BUILDING' THEN c_mktsegment END, '_') AS segment,
           CASE WHEN c_acctbal < 0 THEN 0.0 ELSE c_acctbal END AS balance,
           CASE WHEN c_nationkey >= 10 THEN c_nationkey ELSE 0 END AS nation,
           CASE WHEN c_nationkey < 10 THEN c_nationkey END AS unfilled
    FROM customer""")
def fill_defaults_query(spark, sf_dir):
    """Text, NaN and whole-number fills, and a default the type cannot hold."""
    dirty = source(spark, sf_dir, "customer", "c_custkey",
                   "CASE WHEN c_mktsegment <> 'BUILDING' THEN c_mktsegment END AS segment",
                   "CASE WHEN c_acctbal < 0 THEN double('NaN') ELSE c_acctbal END AS balance",
                   "CASE WHEN c_nationkey >= 10 THEN c_nationkey END AS nation",
                   "CASE WHEN c_nationkey < 10 THEN c_nationkey END AS unfilled")
    wrong_default = ColumnRule("customer", "unfilled", "unfilled", "integer", "_")
    rules = [c("customer") for c in (string("segment"), decimal2("balance"), integer("nation"))]
    return fill_defaults(dirty, rules + [wrong_default])


_DIRTY_ORDERS = """
      SELECT o_orderkey, CASE WHEN o_orderstatus = 'P' THEN NULL ELSE o_custkey END AS o_custkey,
             CASE WHEN o_orderpriority = '5-LOW' THEN NULL ELSE o_orderpriority END AS o_orderpriority,
             o_totalprice
      FROM orders
      UNION ALL
      SELECT o_orderkey, 0, CASE WHEN o_orderpriority = '5-LOW' THEN NULL ELSE o_orderpriority END,
             o_totalprice
      FROM orders WHERE o_orderstatus = 'P'
      UNION ALL
      SELECT o_orderkey, o_custkey, '_', o_totalprice FROM orders
      WHERE o_orderpriority = '5-LOW' AND o_orderstatus <> 'P'"""


@query("clean_chain", f"""
    SELECT o_orderkey, o_custkey, coalesce(o_orderpriority, '_') AS o_orderpriority FROM (
      SELECT DISTINCT o_orderkey, coalesce(o_custkey, 0) AS o_custkey, o_orderpriority, o_totalprice
      FROM ({_DIRTY_ORDERS}))""")
def clean_chain(spark, sf_dir):
    """Rows made equal by an early fill fold, those made equal by the last do not."""
    dirty = spark.sql(_DIRTY_ORDERS.replace("FROM orders", "FROM {orders}"),
                      orders=given(spark, sf_dir, "orders"))
    return clean(dirty, table("orders", integer("o_orderkey"), integer("o_custkey"),
                              string("o_orderpriority")))


@query("cast_date", """
    SELECT o_orderkey, CASE o_orderstatus WHEN 'F' THEN NULL WHEN 'P' THEN NULL
                       ELSE CAST(o_orderdate AS DATE) END AS order_day
    FROM orders""")
def cast_date(spark, sf_dir):
    """Text with a time part and plain text are no dates."""
    text = source(spark, sf_dir, "orders", "o_orderkey", f"""
        CASE o_orderstatus WHEN 'F' THEN concat('on ', {_DAY}) WHEN 'P' THEN concat({_DAY}, ' 00:00')
        ELSE {_DAY} END AS order_day""")
    return clean(text, table("orders", integer("o_orderkey"), day("order_day")))


@query("cast_float_round", """
    SELECT DISTINCT l_orderkey, l_partkey, l_suppkey, CAST(l_linenumber AS BIGINT) AS l_linenumber,
           round(CAST(l_extendedprice AS FLOAT), 2) AS l_extendedprice,
           round(CAST(l_discount AS FLOAT), 2) AS l_discount
    FROM lineitem""")
def cast_float_round(spark, sf_dir):
    rows = source(spark, sf_dir, "lineitem", "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber",
                  "cast(l_extendedprice AS string) AS l_extendedprice", "l_discount")
    return clean(rows, table(
        "lineitem", integer("l_orderkey"), integer("l_partkey"), integer("l_suppkey"),
        integer("l_linenumber"), decimal2("l_extendedprice"), decimal2("l_discount")))


@query("cast_long_string", """
    SELECT p_partkey, CAST(trunc(p_retailprice) AS BIGINT) AS price_text,
           CAST(trunc(p_retailprice) AS BIGINT) AS price_number,
           CASE WHEN p_type <> 'SMALL' THEN CAST(p_size AS BIGINT) END AS size,
           CAST(p_partkey AS VARCHAR) AS label
    FROM part""")
def cast_long_string(spark, sf_dir):
    """Fractions are cut off, blanks ignored, other text gives null."""
    rows = source(spark, sf_dir, "part", "p_partkey",
                  "cast(p_retailprice AS string) AS price_text", "p_retailprice AS price_number",
                  "CASE WHEN p_type = 'SMALL' THEN concat('size ', p_size)"
                  " ELSE concat(' ', p_size, ' ') END AS size", "p_partkey AS label")
    return clean(rows, table("part", integer("p_partkey"), integer("price_text"),
                             integer("price_number"), integer("size"), string("label")))


@query("phone_last10", """
    SELECT CAST(c_custkey AS BIGINT) AS c_custkey,
           right(CAST(CASE WHEN c_mktsegment = 'BUILDING' THEN c_custkey
                      ELSE 910000000000 + c_custkey * 7919 END AS VARCHAR), 10) AS phone,
           '2024-05-01 06:00:00' AS last_updated, '7' AS etl_run_id
    FROM customer""")
def phone_last10(spark, sf_dir):
    rows = source(spark, sf_dir, "customer", "c_custkey",
                  "CASE WHEN c_mktsegment = 'BUILDING' THEN c_custkey"
                  " ELSE 910000000000 + c_custkey * 7919 END AS phone")
    mapping = table("customer", integer("c_custkey"), phone("phone"))
    return transform(clean(rows, mapping), mapping, RUN_ID, AS_OF)


@query("key_identity", """
    SELECT c_custkey AS dwid, c_custkey, c_name,
           '2024-05-01 06:00:00' AS last_updated, '7' AS etl_run_id FROM customer""")
def key_identity(spark, sf_dir):
    mapping = table("customer", identity_key("c_custkey"), integer("c_custkey"), string("c_name"))
    rows = given(spark, sf_dir, "customer")
    return transform(clean(rows, mapping), mapping, RUN_ID, AS_OF)


@query("key_date_id", """
    SELECT CAST(concat(CAST(epoch(CAST(o_orderdate AS DATE)) AS BIGINT), o_orderkey) AS BIGINT) AS dwid,
           CAST(o_orderdate AS DATE) AS date, o_orderkey,
           '2024-05-01 06:00:00' AS last_updated, '7' AS etl_run_id FROM orders""")
def key_date_id(spark, sf_dir):
    rows = source(spark, sf_dir, "orders", f"{_DAY} AS date", "o_orderkey")
    mapping = table("orders", dated_key("o_orderkey"), day("date"), integer("o_orderkey"))
    return transform(clean(rows, mapping), mapping, RUN_ID, AS_OF)


@query("key_date_two_ids", """
    SELECT DISTINCT concat(CAST(epoch(CAST(l_shipdate AS DATE)) AS BIGINT), l_partkey, l_suppkey) AS dwid,
           CAST(l_shipdate AS DATE) AS date, l_partkey, l_suppkey, l_orderkey,
           '2024-05-01 06:00:00' AS last_updated, '7' AS etl_run_id FROM lineitem""")
def key_date_two_ids(spark, sf_dir):
    rows = source(spark, sf_dir, "lineitem", "date_format(l_shipdate, 'yyyy-MM-dd') AS date",
                  "l_partkey", "l_suppkey", "l_orderkey")
    mapping = table("lineitem", dated_key("l_partkey", "l_suppkey", cast_to="string"), day("date"),
                    integer("l_partkey"), integer("l_suppkey"), integer("l_orderkey"))
    return transform(clean(rows, mapping), mapping, RUN_ID, AS_OF)


@query("expression_casts", """
    SELECT l_orderkey, l_partkey, l_suppkey, CAST(trunc(l_extendedprice * l_discount) AS BIGINT) AS rebate,
           CAST(l_quantity / 8 AS FLOAT) AS eighths, CAST(l_shipdate AS DATE) AS shipped,
           concat(l_returnflag, '/', l_linestatus) AS flags,
           '2024-05-01 06:00:00' AS last_updated, '7' AS etl_run_id FROM lineitem""")
def expression_casts(spark, sf_dir):
    """Expressions of each type; unlike source columns, floats are not rounded."""
    mapping = table("lineitem", integer("l_orderkey"), integer("l_partkey"), integer("l_suppkey"),
                    generated("rebate", "integer", "l_extendedprice * l_discount"),
                    generated("eighths", "float", "l_quantity / 8"),
                    generated("shipped", "date", "date_format(l_shipdate, 'yyyy-MM-dd')"),
                    generated("flags", "string", "concat(l_returnflag, '/', l_linestatus)"))
    return transform(given(spark, sf_dir, "lineitem"), mapping, RUN_ID, AS_OF)


@query("audit_columns", """
    SELECT c_name, c_custkey, '2024-05-01 06:00:00' AS last_updated, '7' AS etl_run_id
    FROM customer""")
def audit_columns(spark, sf_dir):
    mapping = table("customer", string("c_name"), integer("c_custkey"))
    return transform(clean(given(spark, sf_dir, "customer"), mapping), mapping, RUN_ID, AS_OF)


@query("rename_project", """
    SELECT s_suppkey AS supplier, s_name AS company, '2024-05-01 06:00:00' AS last_updated,
           '7' AS etl_run_id FROM supplier""")
def rename_project(spark, sf_dir):
    """Unmapped columns are dropped, mapped ones renamed."""
    mapping = table("supplier", integer("s_suppkey", "supplier"), string("s_name", "company"))
    return transform(clean(given(spark, sf_dir, "supplier"), mapping), mapping, RUN_ID, AS_OF)


def _custom(name):
    return ColumnRule("orders", "NA", name, "string", is_generated="Y", transformation=CUSTOM)


@query("custom_omitted", """
    SELECT o_orderkey, '2024-05-01 06:00:00' AS last_updated, '7' AS etl_run_id FROM orders""")
def custom_omitted(spark, sf_dir):
    mapping = table("orders", integer("o_orderkey"), lambda _: _custom("size_class"))
    return transform(given(spark, sf_dir, "orders"), mapping, RUN_ID, AS_OF)


@query("custom_supplied", """
    SELECT o_orderkey, CASE WHEN o_totalprice >= 250000 THEN 'large' ELSE 'small' END AS size_class,
           '2024-05-01 06:00:00' AS last_updated, '7' AS etl_run_id FROM orders""")
def custom_supplied(spark, sf_dir):
    mapping = table("orders", integer("o_orderkey"), lambda _: _custom("size_class"))
    return transform(
        given(spark, sf_dir, "orders"), mapping, RUN_ID, AS_OF,
        {"size_class": lambda df: F.when(df.o_totalprice >= 250000, "large").otherwise("small")})


@query("custom_sql_function", """
    SELECT o_orderkey, o_totalprice, CASE WHEN o_totalprice >= 250000 THEN 'large' ELSE 'small' END || ' ' || o_orderstatus AS size_class,
           CAST(year(o_orderdate) AS VARCHAR) AS season, '2024-05-01 06:00:00' AS last_updated, '7' AS etl_run_id FROM orders""")
def custom_sql_function(spark, sf_dir):
    """Custom columns come from SQL functions of the catalog, found by table and column name."""
    base = scratch_path(spark, "functions")
    database = "tierline_" + base[-8:]
    spark.sql(f"CREATE DATABASE {database} LOCATION '{base}'")
    spark.sql(f"""CREATE FUNCTION {database}.orders__size_class(o_totalprice DOUBLE, o_orderstatus STRING) RETURNS STRING
                  RETURN concat(CASE WHEN o_totalprice >= 250000 THEN 'large' ELSE 'small' END, ' ', o_orderstatus)""")
    spark.sql(f"""CREATE FUNCTION {database}.orders__season(o_orderdate TIMESTAMP) RETURNS STRING
                  RETURN CAST(year(o_orderdate) AS STRING)""")
    price = ColumnRule("orders", "o_totalprice", "o_totalprice", "float")
    mapping = table("orders", integer("o_orderkey"), lambda _: price, lambda _: _custom("size_class"), lambda _: _custom("season"),
                    lambda _: _custom("nobody_supplies"))
    try:
        return transform(given(spark, sf_dir, "orders"), mapping, RUN_ID, AS_OF, functions=database)
    finally:  # the functions' bodies are part of the plan by now
        spark.sql(f"DROP DATABASE {database} CASCADE")


@query("null_row_union", """
    SELECT o_orderkey, o_orderstatus, o_totalprice FROM orders UNION ALL SELECT NULL, NULL, NULL""")
def null_row_union(spark, sf_dir):
    orders = source(spark, sf_dir, "orders", "o_orderkey", "o_orderstatus", "o_totalprice")
    return orders.unionByName(null_row(spark, orders.schema))
