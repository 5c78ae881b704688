"""Whole bronze-to-silver runs: orders as flagship, then the fourteen dairy tables."""

from __future__ import annotations

from pyspark.sql import functions as F


from tierline.mapping import (TableMapping, dated_key, day, decimal2, integer, read_mapping,
                              string, table)
from tierline.operators import quality
from tierline.plans.dairy import MAPPING
from tierline.plans.jobs import load_silver_table, silver_rows
from tierline.plans.parameters import FULL_LOAD, INCREMENTAL_LOAD
from tierline.queries.registry import AS_OF, RUN_ID, given, query, source
from tierline.session import scratch_path
from tierline.sources.bronze import write_bronze
from tierline.sources.snapshots import date_slices, hash_slices

_ORDERS = table(
    "orders", dated_key("o_orderkey"), integer("o_orderkey"),
    integer("o_custkey", "customer", "ColumnValues 'customer' >= 1"),
    string("o_orderstatus", rule="ColumnValues 'o_orderstatus' in ['F','O']"),
    decimal2("o_totalprice"), day("date"), string("o_orderpriority", "priority"))

_BRONZE_ORDERS = [
    "o_orderkey", "CASE WHEN o_orderpriority <> '3-MEDIUM' THEN o_custkey END AS o_custkey",
    "o_orderstatus", "o_totalprice", "date_format(o_orderdate, 'yyyy-MM-dd') AS date",
    "CASE WHEN o_orderpriority <> '5-LOW' THEN o_orderpriority END AS o_orderpriority"]

_SILVER_ORDERS = f"""
    SELECT CAST(concat(CAST(epoch(CAST(o_orderdate AS DATE)) AS BIGINT), o_orderkey) AS BIGINT) AS dwid,
           o_orderkey, o_custkey AS customer, o_orderstatus,
           round(CAST(o_totalprice AS FLOAT), 2) AS o_totalprice, CAST(o_orderdate AS DATE) AS date,
           CASE WHEN o_orderpriority <> '5-LOW' THEN o_orderpriority ELSE '_' END AS priority,
           '{AS_OF}' AS last_updated, '{RUN_ID}' AS etl_run_id
    FROM (SELECT * REPLACE (CASE WHEN o_orderpriority <> '3-MEDIUM' THEN o_custkey ELSE 0 END AS o_custkey)
          FROM orders)
    WHERE o_orderstatus IN ('F', 'O') AND o_custkey >= 1"""


def bronze_orders(spark, sf_dir):
    """Orders as they come: with nulls, dates as text, and delivered twice when shipped."""
    rows = source(spark, sf_dir, "orders", *_BRONZE_ORDERS)
    return rows.unionByName(rows.filter("o_orderstatus = 'F'"))


@query("silver_orders", _SILVER_ORDERS)
def silver_orders(spark, sf_dir):
    return quality.passed_rows(
        silver_rows(bronze_orders(spark, sf_dir), _ORDERS, RUN_ID, AS_OF))


@query("silver_orders_stored", _SILVER_ORDERS)
def silver_orders_stored(spark, sf_dir):
    """The same through bronze files, the reject sink and a stored silver table."""
    base = scratch_path(spark, "silver")
    write_bronze(bronze_orders(spark, sf_dir), f"{base}/bronze", RUN_ID, "orders")
    return load_silver_table(spark, _ORDERS, f"{base}/bronze", f"{base}/silver", f"{base}/rejected",
                             RUN_ID, FULL_LOAD, AS_OF, hash_slices(8)).read()


_SHIFTED = "CASE o_orderstatus WHEN 'O' THEN 'P' WHEN 'P' THEN 'F' ELSE 'O' END"


def _run_sql(run: int, status: str, window: str) -> str:
    """Passing rows of one run over the orders of a date window."""
    return (_SILVER_ORDERS.replace(f"'{RUN_ID}' AS etl_run_id", f"'{run}' AS etl_run_id")
            .replace("REPLACE (", f"REPLACE ({status} AS o_orderstatus, ")
            .replace("FROM orders)", f"FROM orders WHERE {window})"))


@query("silver_orders_incremental", f"""
    WITH base AS ({_run_sql(1, "o_orderstatus", "o_orderdate < DATE '2000-01-01'")}),
    batch AS ({_run_sql(2, _SHIFTED, "o_orderdate >= DATE '1999-07-01'")})
    SELECT * FROM base WHERE NOT EXISTS (SELECT 1 FROM batch WHERE batch.dwid = base.dwid)
    UNION ALL SELECT * FROM batch""")
def silver_orders_incremental(spark, sf_dir):
    """A full load, then an incremental one; rows the rules reject update nothing."""
    base = scratch_path(spark, "silver")
    runs = ((1, FULL_LOAD, "date < '2000-01-01'", "o_orderstatus"),
            (2, INCREMENTAL_LOAD, "date >= '1999-07-01'", _SHIFTED))
    for run, load_type, window, status in runs:
        rows = bronze_orders(spark, sf_dir).filter(window)
        write_bronze(rows.withColumn("o_orderstatus", F.expr(status)), f"{base}/bronze", run, "orders")
        stored = load_silver_table(
            spark, _ORDERS, f"{base}/bronze", f"{base}/silver", f"{base}/rejected", run, load_type,
            AS_OF, date_slices(days=36500))
    return stored.read()


@query("mapping_from_csv", f"""
    SELECT p_partkey, p_name, p_brand, p_type, CAST(p_size AS BIGINT) AS p_size,
           round(CAST(p_retailprice AS FLOAT), 2) AS p_retailprice,
           '{AS_OF}' AS last_updated, '{RUN_ID}' AS etl_run_id FROM part""")
def mapping_from_csv(spark, sf_dir):
    """A mapping file drawn up from a table's own schema, read back and applied."""
    part = given(spark, sf_dir, "part")
    cast_to = {"bigint": "integer", "int": "integer", "double": "float", "string": "string"}
    rows = [("part", name, name, cast_to[dtype], "0", "N", "NA", "NA", "NA")
            for name, dtype in part.dtypes]
    path = scratch_path(spark, "mapping")
    header = ("source_table string, source_column string, target_column string, cast_to string, "
              "na_default string, is_generated string, transformation string, expr string, dq_rule string")
    spark.createDataFrame(rows, header).coalesce(1).write.csv(path, header=True)
    mapping = read_mapping(spark, path)["part"]
    return silver_rows(part, mapping, RUN_ID, AS_OF)


# The dairy tables, fed from the given ones. Each entry: given table and the
# source columns as (name, expression, type), valid in both SQL dialects.
_DAY = {"orders": "substring(CAST(o_orderdate AS {text}), 1, 10)",
        "lineitem": "substring(CAST(l_shipdate AS {text}), 1, 10)"}
_BIG, _TEXT, _REAL = "BIGINT", "{text}", "DOUBLE"
_FEEDS = {
    "farmers_data": ("customer", [
        ("farmer_id", "c_custkey", _BIG), ("name", "c_name", _TEXT),
        ("gender", "CASE c_mktsegment WHEN 'BUILDING' THEN 'F' WHEN 'FURNITURE' THEN NULL ELSE 'M' END", _TEXT),
        ("phone", "910000000000 + c_custkey", _BIG), ("col_id", "c_nationkey", _BIG),
        ("cattle_capacity", "CASE WHEN c_acctbal > 0 THEN c_nationkey END", _BIG),
        ("aadhar", "c_custkey * 31", _BIG), ("pan", "c_mktsegment", _TEXT), ("bank_ac", "c_custkey * 37", _BIG)]),
    "collection_center_data": ("supplier", [
        ("col_id", "s_suppkey", _BIG), ("chl_id", "s_nationkey", _BIG), ("owner", "s_name", _TEXT),
        ("location", "CASE WHEN s_acctbal > 0 THEN s_name END", _TEXT), ("phone", "s_suppkey", _BIG),
        ("aadhar", "s_suppkey * 31", _BIG), ("pan", "s_name", _TEXT), ("bank_ac", "s_suppkey * 37", _BIG)]),
    "chilling_center_data": ("supplier", [
        ("chl_id", "s_suppkey", _BIG), ("owner", "s_name", _TEXT), ("location", "s_name", _TEXT),
        ("phone", "910000000000 + s_suppkey", _BIG),
        ("aadhar", "CASE WHEN s_acctbal > 0 THEN s_suppkey END", _BIG), ("pan", "s_name", _TEXT),
        ("bank_ac", "s_suppkey * 37", _BIG)]),
    "logistics_contractor_data": ("supplier", [
        ("contractor_id", "s_suppkey", _BIG), ("owner", "s_name", _TEXT), ("vehicle_no", "s_name", _TEXT),
        ("phone", "CASE WHEN s_acctbal > 0 THEN 910000000000 + s_suppkey END", _BIG),
        ("aadhar", "s_name", _TEXT), ("pan", "s_name", _TEXT), ("bank_ac", "s_suppkey * 37", _BIG)]),
    "routes_data": ("part", [
        ("route_id", "concat('R', p_partkey)", _TEXT), ("stops", "p_name", _TEXT), ("distance", "p_size", _BIG),
        ("cost", "CASE WHEN p_size > 10 THEN p_size * 3 END", _BIG)]),
    "distributor_data": ("customer", [
        ("distributor_id", "c_custkey", _BIG), ("name", "c_name", _TEXT), ("phone", "910000000000 + c_custkey", _BIG),
        ("area", "CASE WHEN c_acctbal > 0 THEN c_mktsegment END", _TEXT)]),
    "products_data": ("part", [
        ("product_id", "p_partkey", _BIG), ("name", "p_name", _TEXT), ("price", "p_size", _BIG),
        ("sl", "p_type", _TEXT), ("recipe_id", "CASE WHEN p_size > 10 THEN p_brand END", _TEXT)]),
    "recipe_data": ("part", [
        ("recipe_id", "p_brand", _TEXT), ("raw_material", "p_name", _TEXT), ("quantity_per_unit_ml", "p_size", _BIG)]),
    "collection_center_procurement": ("lineitem", [
        ("farmer_id", "l_orderkey", _BIG), ("date", _DAY["lineitem"], _TEXT), ("quantity", "l_quantity", _BIG),
        ("fat", "l_tax", _REAL), ("snf", "l_discount", _REAL), ("amount", "l_extendedprice", _REAL),
        ("col_id", "CASE WHEN l_returnflag = 'A' THEN l_suppkey END", _BIG)]),
    "chilling_center_procurement": ("lineitem", [
        ("col_id", "l_suppkey", _BIG), ("quantity", "l_quantity", _BIG), ("fat", "l_tax", _REAL),
        ("snf", "CASE WHEN l_returnflag = 'A' THEN l_discount END", _REAL), ("date", _DAY["lineitem"], _TEXT),
        ("qa_check", "l_linestatus", _TEXT), ("commission", "l_extendedprice", _REAL),
        ("route_id", "concat('R', l_partkey)", _TEXT), ("chl_id", "l_orderkey", _BIG)]),
    "aggregated_procurement": ("orders", [
        ("chl_id", "o_custkey", _BIG), ("quantity", "o_orderkey", _BIG),
        ("fat", "CASE WHEN o_orderstatus = 'F' THEN 3.456 END", _REAL), ("snf", "8.5", _REAL),
        ("date", "CASE WHEN o_orderpriority <> '5-LOW' THEN " + _DAY["orders"] + " END", _TEXT),
        ("qa_check", "o_orderstatus", _TEXT), ("route_id", "o_orderpriority", _TEXT)]),
    "daily_logistics": ("orders", [
        ("route_id", "concat('R', o_custkey)", _TEXT), ("contractor_id", "o_orderkey", _BIG),
        ("material", "CASE WHEN o_orderstatus = 'F' THEN o_orderpriority END", _TEXT), ("date", _DAY["orders"], _TEXT)]),
    "production_data": ("lineitem", [
        ("batch_no", "concat(l_orderkey, '-', l_linenumber)", _TEXT), ("date", _DAY["lineitem"], _TEXT),
        ("product_id", "l_partkey", _BIG), ("quantity", "l_quantity", _BIG)]),
    "sales_data": ("lineitem", [
        ("sales_id", "concat(l_orderkey, '-', l_linenumber)", _TEXT), ("date", _DAY["lineitem"], _TEXT),
        ("product_id", "l_partkey", _BIG), ("quantity", "l_quantity", _BIG), ("distributor_id", "l_suppkey", _BIG),
        ("route_id", "CASE WHEN l_returnflag = 'A' THEN l_linestatus END", _TEXT)]),
}
_WHERE = {"farmers_data": "WHERE gender IN ('F', 'M') AND cattle_capacity >= 2"}


def _feed_columns(name: str, text: str) -> list[str]:
    return [f"CAST({e} AS {t}) AS {n}".replace("{text}", text) for n, e, t in _FEEDS[name][1]]


def _feed_sql(mapping: TableMapping) -> str:
    """Expected silver rows: fill, distinct, fill the last column, cast, key, filter."""
    given_table, columns = _FEEDS[mapping.name]
    types = {n: t for n, _, t in columns}
    defaults = {r.source_column: r.na_default for r in mapping.source_rules}
    last = mapping.source_rules[-1].source_column

    def filled(name):
        default = f"'{defaults[name]}'" if types[name] == _TEXT else f"TRY_CAST('{defaults[name]}' AS {types[name]})"
        return f"coalesce({name}, {default}) AS {name}"

    def shaped(rule):
        n = rule.source_column
        value = {"date": f"CAST({n} AS DATE)", "float": f"round(CAST({n} AS FLOAT), 2)",
                 "integer": f"CAST({n} AS BIGINT)", "string": f"CAST({n} AS VARCHAR)"}[rule.cast_to]
        return f"{value} AS {n}"

    def target(rule):
        if rule.transformation == "PHONE":
            return f"right(CAST(phone AS VARCHAR), 10) AS {rule.target_column}"
        if rule.transformation == "EXPR":
            e = rule.expr.replace("unix_timestamp(date,'yyyy-MM-dd')", "CAST(epoch(date) AS BIGINT)")
            return f"CAST({e} AS {'BIGINT' if rule.cast_to == 'integer' else 'VARCHAR'}) AS {rule.target_column}"
        return f"{rule.source_column} AS {rule.target_column}"

    rules = mapping.source_rules
    names = [r.source_column for r in rules]
    return f"""
    WITH raw AS (SELECT {', '.join(_feed_columns(mapping.name, 'VARCHAR'))} FROM {given_table}),
    unique_rows AS (SELECT DISTINCT {', '.join(n if n == last else filled(n) for n in names)} FROM raw),
    complete AS (SELECT {', '.join(filled(n) if n == last else n for n in names)} FROM unique_rows),
    typed AS (SELECT {', '.join(shaped(r) for r in rules)} FROM complete)
    SELECT {', '.join(target(r) for r in mapping.rules)},
           '{AS_OF}' AS last_updated, '{RUN_ID}' AS etl_run_id
    FROM typed {_WHERE.get(mapping.name, '')}"""


def _register(mapping: TableMapping) -> None:
    @query(f"silver_{mapping.name}", _feed_sql(mapping))
    def run(spark, sf_dir):
        rows = source(spark, sf_dir, _FEEDS[mapping.name][0], *_feed_columns(mapping.name, "STRING"))
        evaluated = silver_rows(rows, mapping, RUN_ID, AS_OF)
        return quality.passed_rows(evaluated) if mapping.dq_rules else evaluated


for _mapping in MAPPING.values():
    _register(_mapping)
