"""Queries for landing and bronze: JSON scans, payload documents, date windows."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, functions as F

from tierline import files
from tierline.plans.jobs import landing_to_bronze
from tierline.queries.registry import RUN_ID, given, query, source
from tierline.session import scratch_path
from tierline.sources import variant_bronze
from tierline.sources.bronze import read_bronze
from tierline.sources.landing import (fact_window, land_payload, payload_table, read_json,
                                      read_payload, scan_landing, write_json)


@query("landing_scan", """
    SELECT 'customer' AS table_name, count(*) AS n, CAST(sum(c_custkey) AS BIGINT) AS keys FROM customer
    UNION ALL SELECT 'orders', count(*), CAST(sum(o_orderkey) AS BIGINT) FROM orders""")
def landing_scan(spark, sf_dir):
    """One scan over all landed files, told apart by the table name in the path."""
    landing = scratch_path(spark, "landing")
    write_json(source(spark, sf_dir, "customer", "c_custkey AS key"), f"{landing}/dims/customer.json")
    write_json(source(spark, sf_dir, "orders", "o_orderkey AS key"), f"{landing}/facts/orders.json")
    return (scan_landing(spark, landing).groupBy("table_name")
            .agg(F.count(F.lit(1)).alias("n"), F.sum("key").alias("keys")))


@query("json_to_bronze", """
    SELECT event_id, event_type, CAST(json_extract_string(props, '$.k') AS BIGINT) AS k, value
    FROM events""")
def json_to_bronze(spark, sf_dir):
    """Rows with a nested value: to JSON, landed, types inferred, to Parquet and back."""
    base = scratch_path(spark, "bronze")
    rows = given(spark, sf_dir, "events").select(
        "event_id", "event_type", "value", F.from_json("props", "k bigint").alias("props"))
    write_json(rows, f"{base}/landing/facts/events.json")
    landing_to_bronze(spark, f"{base}/landing", f"{base}/bronze", RUN_ID)
    return read_bronze(spark, f"{base}/bronze", RUN_ID, "events").select(
        "event_id", "event_type", "props.k", "value")


_EVENTS_SQL = """
    SELECT event_id, event_type, CAST(json_extract_string(props, '$.k') AS BIGINT) AS k, value FROM events"""


def _nested_events(spark, sf_dir):
    return given(spark, sf_dir, "events").select("event_id", "event_type", "value", F.from_json("props", "k bigint").alias("props"))


@query("bronze_variant", _EVENTS_SQL)
def bronze_variant(spark, sf_dir):
    """The same rows, their JSON parsed once into variants and typed from those."""
    base = scratch_path(spark, "bronze")
    write_json(_nested_events(spark, sf_dir), f"{base}/landing/facts/events.json")
    variant_bronze.landing_to_typed(spark, f"{base}/landing", f"{base}/bronze", RUN_ID)
    return read_bronze(spark, f"{base}/bronze", RUN_ID, "events").select("event_id", "event_type", "props.k", "value")


@query("bronze_available_now", _EVENTS_SQL)
def bronze_available_now(spark, sf_dir):
    """Landed in two parts, each taken by a run of the stream in batches; a third run finds nothing new."""
    base, rows = scratch_path(spark, "bronze"), _nested_events(spark, sf_dir)
    for part in (rows.filter("event_type = 'click'"), rows.filter("event_type <> 'click' OR event_type IS NULL"), None):
        if part is not None:
            part.repartition(3).write.mode("append").option("ignoreNullFields", False).json(f"{base}/landing/facts/events.json")
        variant_bronze.start_landing_stream(spark, f"{base}/landing", f"{base}/bronze", RUN_ID, f"{base}/checkpoint",
                                            max_files=2).awaitTermination()
    variant_bronze.settle(spark, f"{base}/bronze", RUN_ID)
    return read_bronze(spark, f"{base}/bronze", RUN_ID, "events").select("event_id", "event_type", "props.k", "value")


def _documents(spark, sf_dir):
    """API documents: per customer a list of one buyer and one of two amounts."""
    path = scratch_path(spark, "documents")
    buyer = "array(named_struct('id', c_custkey, 'name', c_name))"
    amounts = ("array(named_struct('id', c_custkey, 'kind', 'balance', 'amount', c_acctbal),"
               " named_struct('id', c_custkey, 'kind', 'limit', 'amount', c_acctbal + 1000))")
    write_json(source(spark, sf_dir, "customer",
                      f"named_struct('buyers', {buyer}, 'amounts', {amounts},"
                      f" 'as_text', to_json({buyer})) AS data"), path)
    return path


@query("payload_split", """
    SELECT c_custkey AS id, 'balance' AS kind, c_acctbal AS amount FROM customer
    UNION ALL SELECT c_custkey, 'limit', c_acctbal + 1000 FROM customer""")
def payload_split(spark, sf_dir):
    return payload_table(read_payload(spark, _documents(spark, sf_dir), multi_line=False), "amounts")


def _list_lines(spark, rows, path):
    """The elements of a list, stored once: all but the last, with commas, and the last."""
    rows.select(F.monotonically_increasing_id().alias("place"), "value").write.parquet(path)
    stored = spark.read.parquet(path)
    last = stored.agg(F.max("place")).first()[0]
    return [stored.filter(F.col("place") < F.lit(last)).select(F.concat("value", F.lit(",")).alias("value")),
            stored.filter(F.col("place") == F.lit(last)).select("value")]


def _write_document(spark, base, parts):
    """One file below ``base``/document: texts, and frames of JSON text as elements of lists, in the order given.

    Rows become JSON in many tasks. One file is written by one task, which only copies stored lines: it neither sorts
    nor holds them. Texts are stored as well: the copy keeps the order as long as all that it reads has hosts, or nothing.
    """
    lines = []
    for n, part in enumerate(parts):
        path = f"{base}/parts/{n}"
        if isinstance(part, str):
            spark.createDataFrame([(part,)], "value string").coalesce(1).write.parquet(path)
            lines.append(spark.read.parquet(path))
        else:
            lines += _list_lines(spark, part, path)
    reduce(DataFrame.unionAll, lines).coalesce(1).write.text(f"{base}/document")
    files.delete(spark, f"{base}/parts")


@query("payload_huge_document", """
    SELECT 'orders' AS name, o_orderkey AS id, o_orderpriority AS note, o_totalprice AS amount FROM orders
    UNION ALL SELECT 'customer', c_custkey, c_name || '}, {"', c_acctbal FROM customer""")
def payload_huge_document(spark, sf_dir):
    """One document in one file, its rows cut out by byte ranges, landed and read as JSON."""
    base = scratch_path(spark, "document")
    orders = source(spark, sf_dir, "orders",
                    "to_json(named_struct('id', o_orderkey, 'note', o_orderpriority, 'amount', o_totalprice)) AS value")
    customers = source(spark, sf_dir, "customer",
                       '''to_json(named_struct('id', c_custkey, 'note', concat(c_name, '}, {"'), 'amount', c_acctbal)) AS value''')
    _write_document(spark, base, ['{"status": {"rows": [{"id": 0}]}, "data": {"orders": [', orders,
                                  '], "empty": [], "customer": [', customers, ']}}'])
    land_payload(spark, f"{base}/document", f"{base}/landing", "facts", ("orders", "customer", "empty"), by_ranges=True)
    landed = [read_json(spark, f"{base}/landing/facts/{n}.json", "id long, note string, amount double")
              .select(F.lit(n).alias("name"), "*") for n in ("orders", "customer")]
    return landed[0].unionByName(landed[1])


@query("payload_text_landed", "SELECT c_custkey AS id, c_name AS name FROM customer")
def payload_text_landed(spark, sf_dir):
    """A table delivered as JSON text is landed as it is and read as JSON."""
    landing = scratch_path(spark, "landing")
    land_payload(spark, _documents(spark, sf_dir), landing, "dims", ("as_text",), multi_line=False)
    return read_json(spark, f"{landing}/dims/as_text.json")


@query("fact_window", """
    SELECT o_orderkey, o_totalprice FROM orders
    WHERE CAST(o_orderdate AS DATE) BETWEEN DATE '1997-01-15' AND DATE '1998-06-30'""")
def fact_window_query(spark, sf_dir):
    return fact_window(given(spark, sf_dir, "orders"), "1998-06-30", "1997-01-15", "1",
                       column="o_orderdate").select("o_orderkey", "o_totalprice")


@query("fact_window_one_day", """
    SELECT event_id, event_type FROM events WHERE CAST(ts AS DATE) = DATE '2024-01-17'""")
def fact_window_one_day(spark, sf_dir):
    """Without backfill the start date is ignored."""
    return fact_window(given(spark, sf_dir, "events"), "2024-01-17", "2024-01-01", "0",
                       column="ts").select("event_id", "event_type")
