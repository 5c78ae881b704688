"""Queries for full loads, keyed upserts, the catalog and the calendar."""

from __future__ import annotations

from pyspark.sql import functions as F

from tierline.functions.scalars import business_quarter
from tierline.mapping import dated_key, day, integer, string, table
from tierline.operators.clean import clean
from tierline.operators.transform import transform
from tierline.operators.upsert import conflicting_keys, key_collisions, matched_keys, upsert
from tierline.plans.date_dim import load_date_dim
from tierline.queries.registry import given, query, source
from tierline.session import scratch_path
from tierline.sources.bucketed import BucketedTable
from tierline.sources.landing import fact_window
from tierline.sources.snapshots import SnapshotTable, date_slices, hash_slices

_ORDERS = table("orders", dated_key("o_orderkey"), day("date"), integer("o_orderkey"),
                string("o_orderstatus"), string("o_orderpriority"))
_SLICES = date_slices(days=36500)
_EARLIER, _LATER = "2024-05-01 06:00:00", "2024-05-02 06:00:00"


def _order_rows(spark, sf_dir, first, last, status, run_id, as_of):
    """Orders of a date window with a key that is null for low priority."""
    orders = fact_window(given(spark, sf_dir, "orders"), last, first, "1", column="o_orderdate")
    rows = orders.selectExpr("date_format(o_orderdate, 'yyyy-MM-dd') AS date", "o_orderkey",
                             f"{status} AS o_orderstatus", "o_orderpriority")
    shaped = transform(clean(rows, _ORDERS), _ORDERS, run_id, as_of)
    return shaped.withColumn("dwid", F.when(F.col("o_orderpriority") != "5-LOW", F.col("dwid")))


def _base(spark, sf_dir):
    return _order_rows(spark, sf_dir, "0001-01-01", "1999-12-31", "o_orderstatus", 1, _EARLIER)


def _batch(spark, sf_dir):
    return _order_rows(spark, sf_dir, "1999-07-01", "9999-12-30", "concat(o_orderstatus, '+')", 2, _LATER)


_KEYED = """
    SELECT CASE WHEN o_orderpriority <> '5-LOW' THEN CAST(concat(
             CAST(epoch(CAST(o_orderdate AS DATE)) AS BIGINT), o_orderkey) AS BIGINT) END AS dwid,
           CAST(o_orderdate AS DATE) AS date, o_orderkey, o_orderstatus, o_orderpriority FROM orders"""
_MERGED_SQL = f"""
    WITH keyed AS ({_KEYED}),
    base AS (SELECT *, '{_EARLIER}' AS last_updated, '1' AS etl_run_id
             FROM keyed WHERE date < DATE '2000-01-01'),
    batch AS (SELECT dwid, date, o_orderkey, o_orderstatus || '+' AS o_orderstatus, o_orderpriority,
                     '{_LATER}' AS last_updated, '2' AS etl_run_id
              FROM keyed WHERE date >= DATE '1999-07-01')
    SELECT * FROM base WHERE NOT EXISTS (SELECT 1 FROM batch WHERE batch.dwid = base.dwid)
    UNION ALL SELECT * FROM batch"""


@query("scd1_merge", _MERGED_SQL)
def scd1_merge(spark, sf_dir):
    """Stored form: full load of one window, then an upsert of an overlapping one."""
    target = SnapshotTable(spark, scratch_path(spark, "orders"), slice_by=_SLICES)
    target.full_load(_base(spark, sf_dir))
    target.upsert(_batch(spark, sf_dir))
    return target.read()


@query("scd1_bucketed", _MERGED_SQL)
def scd1_bucketed(spark, sf_dir):
    """The same with the table in buckets by key."""
    base = scratch_path(spark, "bucketed")
    database = "tierline_" + base[-8:]
    spark.sql(f"CREATE DATABASE {database} LOCATION '{base}/database'")
    target = BucketedTable(spark, f"{base}/orders", database, "orders", buckets=8)
    target.full_load(_base(spark, sf_dir))
    target.upsert(_batch(spark, sf_dir))
    return _kept(spark.sql(f"SELECT * FROM {database}.orders"), database)


@query("scd1_merge_plan", _MERGED_SQL)
def scd1_merge_plan(spark, sf_dir):
    """The same as one lazy plan."""
    return upsert(_base(spark, sf_dir), _batch(spark, sf_dir))


@query("scd1_repeated_keys", """
    SELECT l_orderkey, l_partkey, l_suppkey,
           CASE WHEN o_orderkey IS NULL THEN l_returnflag ELSE o_orderpriority END AS note
    FROM lineitem LEFT JOIN orders ON l_orderkey = o_orderkey AND o_orderstatus = 'F'
    UNION ALL
    SELECT o_orderkey, NULL, NULL, o_orderpriority FROM orders
    WHERE o_orderstatus = 'F' AND o_orderkey NOT IN (SELECT l_orderkey FROM lineitem)""")
def scd1_repeated_keys(spark, sf_dir):
    """Existing rows that share a key are all updated; their other columns stay."""
    lines = source(spark, sf_dir, "lineitem", "l_orderkey", "l_partkey", "l_suppkey",
                   "l_returnflag AS note")
    notes = source(spark, sf_dir, "orders", "o_orderkey AS l_orderkey", "o_orderpriority AS note",
                   "o_orderstatus").filter("o_orderstatus = 'F'").drop("o_orderstatus")
    return upsert(lines, notes, "l_orderkey")


@query("merge_conflicts", """
    SELECT l_orderkey FROM lineitem WHERE l_orderkey IN (SELECT o_orderkey FROM orders)
    GROUP BY l_orderkey HAVING count(*) > 1""")
def merge_conflicts(spark, sf_dir):
    """Keys an upsert of all lines into the orders would refuse."""
    orders = source(spark, sf_dir, "orders", "o_orderkey AS l_orderkey")
    lines = source(spark, sf_dir, "lineitem", "l_orderkey")
    return conflicting_keys(lines, matched_keys(orders, lines, "l_orderkey"), "l_orderkey")


@query("full_load", """
    SELECT s_suppkey AS dwid, s_name, s_acctbal FROM supplier""")
def full_load(spark, sf_dir):
    """The second load replaces the first."""
    target = SnapshotTable(spark, scratch_path(spark, "supplier"), slice_by=hash_slices(4))
    target.full_load(source(spark, sf_dir, "supplier", "s_suppkey AS dwid", "upper(s_name) AS s_name",
                            "0D AS s_acctbal"))
    target.full_load(source(spark, sf_dir, "supplier", "s_suppkey AS dwid", "s_name", "s_acctbal"))
    target.expire(keep=1, seconds=0)
    return target.read()


def _kept(result, database):
    """The rows of a query on registered tables, written, so that the catalog's entries can go.

    Others may share the catalog, and partitions are looked up when a query is planned.
    """
    spark, path = result.sparkSession, scratch_path(result.sparkSession, "result")
    result.write.parquet(path)
    spark.sql(f"DROP DATABASE {database} CASCADE")
    return spark.read.schema(result.schema).parquet(path)


@query("catalog_sql", """
    SELECT n_name, count(*) AS customers, CAST(sum(CAST(c_acctbal AS DECIMAL(18,2))) AS DOUBLE) AS balance
    FROM customer JOIN nation ON c_nationkey = n_nationkey GROUP BY n_name""")
def catalog_sql(spark, sf_dir):
    """Ad-hoc SQL over registered tables."""
    base = scratch_path(spark, "catalog")
    database = "tierline_" + base[-8:]
    for name, key, slices in (("customer", "c_custkey", 4), ("nation", "n_nationkey", 1)):
        target = SnapshotTable(spark, f"{base}/{name}", key=key, slice_by=hash_slices(slices, key))
        target.full_load(given(spark, sf_dir, name))
        target.register(database, name, f"{base}/database")
    result = spark.sql(f"""
        SELECT n_name, count(*) AS customers,
               CAST(sum(CAST(c_acctbal AS DECIMAL(18,2))) AS DOUBLE) AS balance
        FROM {database}.customer JOIN {database}.nation ON c_nationkey = n_nationkey
        GROUP BY n_name""")
    return _kept(result, database)


@query("dim_date", """
    WITH span AS (SELECT CAST(min(o_orderdate) AS DATE) AS first, CAST(max(o_orderdate) AS DATE) AS last FROM orders),
    days AS (SELECT CAST(unnest(range(first, last + INTERVAL 1 DAY, INTERVAL 1 DAY)) AS DATE) AS date FROM span),
    sold AS (SELECT CAST(o_orderdate AS DATE) AS date, count(*) AS orders FROM orders GROUP BY 1)
    SELECT date, CAST(year(date) AS INT) AS year, CAST(month(date) AS INT) AS month,
           CAST(day(date) AS INT) AS day, CAST(dayofweek(date) + 1 AS INT) AS day_of_week,
           CAST(weekofyear(date) AS INT) AS week_of_year,
           CAST(CASE WHEN month(date) BETWEEN 3 AND 5 THEN 1 WHEN month(date) BETWEEN 6 AND 8 THEN 2
                     WHEN month(date) BETWEEN 9 AND 11 THEN 3 ELSE 4 END AS INT) AS quarter,
           coalesce(orders, 0) AS orders
    FROM days LEFT JOIN sold USING (date)""")
def dim_date(spark, sf_dir):
    """Stored calendar over the span of the orders, with the orders of each day."""
    day_of_order = F.col("o_orderdate").cast("date")
    orders = given(spark, sf_dir, "orders")
    first, last = orders.agg(F.min(day_of_order), F.max(day_of_order)).first()
    calendar = load_date_dim(spark, scratch_path(spark, "gold"), str(first), str(last)).read()
    sold = orders.groupBy(day_of_order.alias("date")).agg(F.count(F.lit(1)).alias("orders"))
    return calendar.join(sold, "date", "left").na.fill({"orders": 0})


@query("business_quarter", """
    SELECT CAST(CASE WHEN month(l_shipdate) IN (3, 4, 5) THEN 1 WHEN month(l_shipdate) IN (6, 7, 8) THEN 2
                     WHEN month(l_shipdate) IN (9, 10, 11) THEN 3 ELSE 4 END AS INT) AS quarter,
           count(*) AS lines, CAST(sum(CAST(l_quantity AS BIGINT)) AS BIGINT) AS quantity
    FROM lineitem GROUP BY 1""")
def business_quarter_query(spark, sf_dir):
    lines = given(spark, sf_dir, "lineitem")
    return (lines.groupBy(business_quarter(F.month("l_shipdate")).alias("quarter"))
            .agg(F.count(F.lit(1)).alias("lines"),
                 F.sum(F.col("l_quantity").cast("bigint")).alias("quantity")))


@query("catalog_after_expiry", """
    SELECT c_custkey, CASE WHEN c_custkey IN (1, 2) THEN 'new' ELSE c_name END AS c_name FROM customer""")
def catalog_after_expiry(spark, sf_dir):
    """A view registered before its table was changed and expired still returns all of its rows."""
    base = scratch_path(spark, "catalog")
    database = "tierline_" + base[-8:]
    target = SnapshotTable(spark, f"{base}/customer", key="c_custkey", slice_by=hash_slices(4, "c_custkey"))
    rows = source(spark, sf_dir, "customer", "c_custkey", "c_name")
    target.full_load(rows)
    for key in (1, 2):
        target.upsert(rows.filter(F.col("c_custkey") == key).withColumn("c_name", F.lit("new")))
        target.expire(seconds=0)
    target.register(database, "customer", f"{base}/database")
    for key in (3, 4):
        target.upsert(rows.filter(F.col("c_custkey") == key).withColumn("c_name", F.lit("later")))
        target.expire(seconds=0)
    return _kept(spark.sql(f"SELECT c_custkey, c_name FROM {database}.customer"), database)


@query("catalog_many_slices", """
    SELECT o_orderpriority, count(*) AS orders, count(*) FILTER (CAST(o_orderdate AS DATE) >= DATE '2001-06-01') AS updated,
           CAST(sum(CAST(o_totalprice AS DECIMAL(18,2))) AS DOUBLE) AS total
    FROM orders WHERE o_orderstatus <> 'P' GROUP BY o_orderpriority""")
def catalog_many_slices(spark, sf_dir):
    """A registered table of a thousand slices, some of them in a second folder, read by SQL."""
    base = scratch_path(spark, "catalog")
    database = "tierline_" + base[-8:]
    target = SnapshotTable(spark, f"{base}/orders", key="o_orderkey", slice_by=date_slices(2))
    orders = source(spark, sf_dir, "orders", "o_orderkey", "CAST(o_orderdate AS DATE) AS date", "o_orderstatus",
                    "o_orderpriority", "o_totalprice", "'first' AS load")
    target.full_load(orders.filter("o_orderkey % 16 > 0 OR date < DATE '2001-06-01'"))
    target.upsert(orders.filter("date >= DATE '2001-06-01'").withColumn("load", F.lit("second")))
    target.register(database, "orders", f"{base}/database")
    return _kept(spark.sql(f"""
        SELECT o_orderpriority, count(*) AS orders, count_if(load = 'second') AS updated,
               CAST(sum(CAST(o_totalprice AS DECIMAL(18,2))) AS DOUBLE) AS total
        FROM {database}.orders WHERE o_orderstatus <> 'P' GROUP BY o_orderpriority"""), database)


@query("schema_evolution", """
    WITH rows AS (SELECT *, o_orderdate >= DATE '2000-01-01' AS late FROM orders)
    SELECT o_orderkey AS dwid, CASE WHEN late THEN o_totalprice ELSE CAST(floor(o_totalprice) AS DOUBLE) END AS amount,
           CASE WHEN o_orderkey % 3 > 0 THEN o_orderstatus END AS status, CASE WHEN late THEN o_orderpriority END AS priority
    FROM rows WHERE o_orderkey % 3 > 0 OR late""")
def schema_evolution(spark, sf_dir):
    """A batch with a changed, a new and a lost column; the table is registered and read by SQL."""
    base = scratch_path(spark, "evolution")
    database = "tierline_" + base[-8:]
    target = SnapshotTable(spark, f"{base}/orders", slice_by=hash_slices(8))
    target.full_load(source(spark, sf_dir, "orders", "o_orderkey AS dwid", "CAST(floor(o_totalprice) AS BIGINT) AS amount",
                            "o_orderstatus AS status").filter("dwid % 3 > 0"))
    batch = given(spark, sf_dir, "orders").filter("o_orderdate >= '2000-01-01'")
    target.upsert(batch.selectExpr("o_orderkey AS dwid", "o_totalprice AS amount", "o_orderpriority AS priority"), evolve=True)
    target.register(database, "orders", f"{base}/database")
    return _kept(spark.sql(f"SELECT * FROM {database}.orders"), database)


@query("upsert_column_sets", """
    SELECT o_orderkey AS dwid, o_orderstatus || CASE WHEN o_orderkey % 2 = 0 THEN '+' ELSE '' END AS status,
           CASE WHEN o_orderkey % 3 > 0 THEN 'old' ELSE 'new' END AS note,
           CASE WHEN o_orderkey % 3 > 0 THEN o_totalprice END AS price
    FROM orders WHERE o_orderkey % 3 > 0 OR o_orderkey % 2 = 0""")
def upsert_column_sets(spark, sf_dir):
    """Existing rows take one column of the batch, new rows two."""
    target = SnapshotTable(spark, scratch_path(spark, "sets"), slice_by=hash_slices(4))
    rows = source(spark, sf_dir, "orders", "o_orderkey AS dwid", "o_orderstatus AS status", "'old' AS note", "o_totalprice AS price")
    target.full_load(rows.filter("dwid % 3 > 0"))
    batch = rows.filter("dwid % 2 = 0").withColumns({"status": F.concat("status", F.lit("+")), "note": F.lit("new")})
    target.upsert(batch, update=["status"], insert=["status", "note"])
    return target.read()


@query("key_collisions", """
    WITH rows AS (SELECT CAST(concat(l_partkey, l_suppkey) AS BIGINT) AS dwid, {'a': l_partkey, 'b': l_suppkey} AS ids,
                         l_linenumber = 1 AS stored FROM lineitem)
    SELECT dwid, min(ids).a AS part, min(ids).b AS supplier, max(ids).a AS other_part, max(ids).b AS other_supplier
    FROM rows WHERE dwid IN (SELECT dwid FROM rows WHERE NOT stored) GROUP BY dwid HAVING min(ids) <> max(ids)""")
def key_collisions_query(spark, sf_dir):
    """Keys joined from two ids that an upsert refuses: other ids, in the batch or in the table, give the same key."""
    lines = source(spark, sf_dir, "lineitem", "CAST(concat(l_partkey, l_suppkey) AS BIGINT) AS dwid", "l_partkey", "l_suppkey", "l_linenumber")
    stored, batch = lines.filter("l_linenumber = 1"), lines.filter("l_linenumber <> 1")
    ids = ("l_partkey", "l_suppkey")
    found = key_collisions(batch, matched_keys(stored, batch, witness=ids), witness=ids)
    return found.selectExpr("dwid", "first.l_partkey AS part", "first.l_suppkey AS supplier",
                            "other.l_partkey AS other_part", "other.l_suppkey AS other_supplier")
