"""Queries for days without rows, broken input, failing tables and expressions without a value."""

from __future__ import annotations

from datetime import date, timedelta

from pyspark.sql import functions as F

from tierline.mapping import CUSTOM, ColumnRule, generated, identity_key, integer, string, table
from tierline.operators.quality import ruleset_text
from tierline.operators.transform import transform
from tierline.plans.date_dim import date_dim
from tierline.plans.jobs import bronze_to_silver, landing_to_bronze
from tierline.plans.parameters import FULL_LOAD
from tierline.queries.registry import AS_OF, RUN_ID, given, query, source
from tierline.session import scratch_path
from tierline.sources.bronze import write_bronze
from tierline.sources.landing import land_payload, read_json, write_json
from tierline.sources.snapshots import SnapshotTable

_RULE = "ColumnValues 'segment' in ['BUILDING','MACHINERY']"
_CUSTOMER = table("customer", identity_key("id"), integer("id"), string("name"), string("segment", rule=_RULE))
_SUPPLIER = table("supplier", identity_key("id"), integer("id"), string("name"))
_MAPPING = {"customer": _CUSTOMER, "supplier": _SUPPLIER}


def _land(spark, sf_dir, base, suppliers="true"):
    write_json(source(spark, sf_dir, "customer", "c_custkey AS id", "c_name AS name", "c_mktsegment AS segment"),
               f"{base}/landing/dims/customer.json")
    write_json(source(spark, sf_dir, "supplier", "s_suppkey AS id", "s_name AS name").filter(suppliers),
               f"{base}/landing/dims/supplier.json")


def _silver(spark, base, mapping=None):
    return bronze_to_silver(spark, f"{base}/bronze", f"{base}/silver", f"{base}/rejected", RUN_ID, FULL_LOAD,
                            mapping or _MAPPING, as_of=AS_OF)


@query("quiet_day_to_silver", f"""
    SELECT 'customer' AS "table", count(*) AS n, CAST(coalesce(sum(c_custkey), 0) AS BIGINT) AS ids, 'success' AS status
    FROM customer WHERE c_mktsegment IN ('BUILDING', 'MACHINERY')
    UNION ALL SELECT 'supplier', 0, 0, 'success'""")
def quiet_day_to_silver(spark, sf_dir):
    """From landing to silver on a day on which one table has no rows."""
    base = scratch_path(spark, "quiet")
    _land(spark, sf_dir, base, "id < 0")
    landing_to_bronze(spark, f"{base}/landing", f"{base}/bronze", RUN_ID, mapping=_MAPPING)
    status, _ = _silver(spark, base)
    parts = [SnapshotTable(spark, f"{base}/silver/{name}").read().agg(
        F.lit(name).alias("table"), F.count(F.lit(1)).alias("n"), F.coalesce(F.sum("id"), F.lit(0)).cast("bigint").alias("ids"),
        F.lit(status).alias("status")) for name in _MAPPING]
    return parts[0].unionByName(parts[1])


@query("corrupt_lines_rejected", """
    SELECT CASE WHEN c_custkey % 10 = 0 THEN 'corrupt' ELSE 'bronze' END AS went,
           count(*) AS n, CAST(sum(c_custkey) AS BIGINT) AS ids FROM customer GROUP BY 1""")
def corrupt_lines_rejected(spark, sf_dir):
    """Lines cut off in the middle are set aside and become no rows."""
    base = scratch_path(spark, "corrupt")
    whole = F.to_json(F.struct(F.col("c_custkey").alias("id"), F.col("c_name").alias("name")))
    broken = F.concat(F.lit('{"id": '), F.col("c_custkey").cast("string"), F.lit(', "na'))
    given(spark, sf_dir, "customer").select(F.when(F.col("c_custkey") % 10 == 0, broken).otherwise(whole).alias("line")).write.text(
        f"{base}/landing/dims/customer.json")
    landing_to_bronze(spark, f"{base}/landing", f"{base}/bronze", RUN_ID, mapping=_MAPPING)
    good = spark.read.parquet(f"{base}/bronze/{RUN_ID}/customer").select(F.lit("bronze").alias("went"), "id")
    bad = spark.read.text(f"{base}/bronze/corrupt/{RUN_ID}/customer/{RUN_ID}").select(
        F.lit("corrupt").alias("went"), F.regexp_extract(F.get_json_object("value", "$._corrupt_record"), "[0-9]+", 0).cast("bigint").alias("id"))
    return good.unionByName(bad).groupBy("went").agg(F.count(F.lit(1)).alias("n"), F.sum("id").alias("ids"))


@query("payload_text_window", """
    SELECT o_orderkey AS id, strftime(o_orderdate, '%Y-%m-%d') AS date FROM orders
    WHERE CAST(o_orderdate AS DATE) BETWEEN DATE '1997-01-15' AND DATE '1998-06-30'""")
def payload_text_window(spark, sf_dir):
    """Tables delivered as JSON text: only rows of the window are landed."""
    base = scratch_path(spark, "text-window")
    rows = source(spark, sf_dir, "orders", "o_custkey", "named_struct('id', o_orderkey, 'date', "
                  "date_format(o_orderdate, 'yyyy-MM-dd')) AS row")
    lists = rows.groupBy("o_custkey").agg(F.to_json(F.collect_list("row")).alias("orders"))
    write_json(lists.select(F.struct("orders").alias("data")), f"{base}/documents")
    land_payload(spark, f"{base}/documents", f"{base}/landing", "facts", ("orders",), multi_line=False,
                 window=("1997-01-15", "1998-06-30"))
    return read_json(spark, f"{base}/landing/facts/orders.json", "id bigint, date string")


@query("expression_null_on_error", """
    SELECT l_orderkey, CAST(l_linenumber AS BIGINT) AS l_linenumber,
           CASE WHEN l_linenumber <> 1 THEN CAST(trunc(100.0 / (l_linenumber - 1)) AS BIGINT) END AS share,
           CAST(TRY_CAST(l_returnflag AS INTEGER) AS BIGINT) AS flag,
           '2024-05-01 06:00:00' AS last_updated, '7' AS etl_run_id FROM lineitem""")
def expression_null_on_error(spark, sf_dir):
    """Division by zero and an unusable cast inside an expression give null, in any session."""
    mapping = table("lineitem", integer("l_orderkey"), integer("l_linenumber"),
                    generated("share", "integer", "100 / (l_linenumber - 1)"),
                    generated("flag", "integer", "CAST(l_returnflag AS INT)"))
    lines = source(spark, sf_dir, "lineitem", "l_orderkey", "CAST(l_linenumber AS BIGINT) AS l_linenumber", "l_returnflag")
    return transform(lines, mapping, RUN_ID, AS_OF)


@query("silver_run_outcome", f"""
    SELECT 'partial' AS status, true AS names_the_table, (SELECT count(*) FROM supplier) AS suppliers,
           (SELECT count(*) FROM customer WHERE c_mktsegment IN ('BUILDING', 'MACHINERY')) AS customers,
           'Rules = [' || '{_RULE.replace("'", '"')}' || ']' AS rules""")
def silver_run_outcome(spark, sf_dir):
    """A table without input fails; the others are loaded and the run is partial."""
    base = scratch_path(spark, "outcome")
    _land(spark, sf_dir, base)
    landing_to_bronze(spark, f"{base}/landing", f"{base}/bronze", RUN_ID, mapping=_MAPPING)
    missing = table("missing", identity_key("id"), integer("id"))
    status, problems = _silver(spark, base, _MAPPING | {"missing": missing})
    suppliers, customers = (SnapshotTable(spark, f"{base}/silver/{n}").read().agg(F.count(F.lit(1)).alias(f"{n}s"))
                            for n in ("supplier", "customer"))
    return suppliers.crossJoin(customers).select(
        F.lit(status).alias("status"), F.lit("table:missing" in problems).alias("names_the_table"), "suppliers", "customers",
        F.lit(ruleset_text(_CUSTOMER.dq_rules)).alias("rules"))


@query("silver_table_timeout", """
    SELECT 'partial' AS status, true AS names_the_table, (SELECT count(*) FROM supplier) AS suppliers, false AS slow_loaded""")
def silver_table_timeout(spark, sf_dir):
    """A table that hangs is cancelled after its time; the other one is loaded and the run is partial."""
    base = scratch_path(spark, "timeout")
    _land(spark, sf_dir, base)
    landing_to_bronze(spark, f"{base}/landing", f"{base}/bronze", RUN_ID, mapping=_MAPPING)
    waits = ColumnRule("customer", "NA", "waits", "string", is_generated="Y", transformation=CUSTOM)
    slow = table("customer", identity_key("id"), integer("id"), lambda _: waits)
    status, problems = bronze_to_silver(
        spark, f"{base}/bronze", f"{base}/silver", f"{base}/dq_failed", RUN_ID, FULL_LOAD, {"customer": slow, "supplier": _SUPPLIER},
        as_of=AS_OF, custom={"customer": {"waits": lambda _: F.expr("reflect('java.lang.Thread', 'sleep', 60000L)")}},
        table_seconds={"customer": 2})
    suppliers = SnapshotTable(spark, f"{base}/silver/supplier").read().agg(F.count(F.lit(1)).alias("suppliers"))
    return suppliers.select(
        F.lit(status).alias("status"), F.lit("customer took longer than 2 s" in problems).alias("names_the_table"), "suppliers",
        F.lit(SnapshotTable(spark, f"{base}/silver/customer").exists()).alias("slow_loaded"))


@query("date_span_checked", """
    SELECT n_nationkey, n_nationkey < 11 AS accepted,
           CASE WHEN n_nationkey < 11 THEN CAST(12 - n_nationkey AS BIGINT) ELSE 0 END AS days FROM nation""")
def date_span_checked(spark, sf_dir):
    """A calendar from a day for each nation to the 12th of January: a start on or after its end is refused."""
    end, rows = date(2020, 1, 12), []
    for (key,) in given(spark, sf_dir, "nation").select("n_nationkey").collect():
        try:
            rows.append((key, True, date_dim(spark, str(date(2020, 1, 1) + timedelta(days=key)), str(end)).count()))
        except ValueError:
            rows.append((key, False, 0))
    kind = dict(given(spark, sf_dir, "nation").dtypes)["n_nationkey"]
    return spark.createDataFrame(rows, f"n_nationkey {kind}, accepted boolean, days long")
