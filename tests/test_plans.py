"""The physical plans that matter at scale."""

from __future__ import annotations

import re
from contextlib import contextmanager

import pytest

from tierline.mapping import integer, string, table
from tierline.operators import quality
from tierline.operators.clean import clean
from tierline.operators.upsert import matched_keys, new_rows, updated_rows
from tierline.plans.dairy import MAPPING
from tierline.plans.jobs import silver_rows
from tierline.queries import QUERIES
from tierline.queries.registry import given
from tierline.queries.silver import bronze_orders, _ORDERS
from tierline.sources.landing import fact_window
from tierline.sources.snapshots import SnapshotTable

SF_DIR = "/root/testdata/sf0.001"


def plan(df) -> str:
    return df._jdf.queryExecution().explainString(
        df.sparkSession._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted"))


def exchanges(text: str) -> int:
    return len(re.findall(r"^\(\d+\) Exchange", text, re.M))


def folded_before_shuffle(text: str) -> bool:
    """Whether a shuffle of the plan takes in partial aggregates."""
    return bool(re.search(r"Exchange \(\d+\)\n[^\n]*HashAggregate", text))


def test_silver_takes_one_shuffle_and_no_python(spark):
    text = plan(silver_rows(bronze_orders(spark, SF_DIR), _ORDERS, 1, "x"))
    assert exchanges(text) == 1
    assert "Python" not in text and "Arrow" not in text


def test_equal_rows_fold_before_the_shuffle(spark):
    """A third of the rows are one row; what is shuffled is one copy per task."""
    rows = spark.range(0, 60000, 1, 8).selectExpr("if(id % 3 = 0, -1, id) AS a", "'x' AS b")
    cleaned = clean(rows, table("t", integer("a"), string("b")))
    with tiny_partitions(spark):
        assert cleaned.count() == 40001
    assert folded_before_shuffle(plan(cleaned)) and exchanges(plan(cleaned)) == 1


def test_no_query_calls_python_or_crosses(spark):
    for name in ("clean_chain", "dq_rule_outcomes", "business_quarter", "scd1_merge_plan", "run_log_latest",
                 "status_gate", *(f"silver_{t}" for t in MAPPING)):
        text = plan(QUERIES[name](spark, SF_DIR))
        assert "Python" not in text and "CartesianProduct" not in text and "NestedLoop" not in text, name


def test_window_reaches_the_scan(spark):
    text = plan(fact_window(given(spark, SF_DIR, "orders"), "1998-06-30", "1997-01-15", "1", "o_orderdate"))
    assert "GreaterThanOrEqual(o_orderdate,1997-01-15T00:00)" in text
    assert "LessThan(o_orderdate,1998-07-01T00:00)" in text


def test_quality_filter_adds_no_shuffle(spark):
    df = given(spark, SF_DIR, "customer")
    text = plan(quality.passed_rows(quality.evaluate(df, ["ColumnValues 'c_acctbal' >= 0"])))
    assert exchanges(text) == 0 and "concat" not in text


def test_small_batch_leaves_the_table_unshuffled(spark):
    orders = given(spark, SF_DIR, "orders").withColumnRenamed("o_orderkey", "dwid")
    batch = orders.filter("o_orderstatus = 'F'")
    keys = plan(matched_keys(orders, batch, batch_is_small=True))
    assert "BroadcastHashJoin LeftSemi BuildRight" in keys
    assert "ReadSchema: struct<o_orderkey:bigint>" in keys
    assert exchanges(keys) == 2  # distinct keys of the batch, distinct matches
    updated = plan(updated_rows(orders, batch))
    assert "BroadcastHashJoin LeftOuter BuildRight" in updated and exchanges(updated) == 0


def test_large_batch_splits_by_key_with_the_table_on_the_left(spark):
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        orders = given(spark, SF_DIR, "orders").withColumnRenamed("o_orderkey", "dwid")
        assert "SortMergeJoin LeftOuter" in plan(updated_rows(orders, orders))
        assert "SortMergeJoin LeftSemi" in plan(matched_keys(orders, orders))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


@contextmanager
def tiny_partitions(spark):
    """Adaptive execution as if the test's partitions were large ones."""
    values = {"spark.sql.autoBroadcastJoinThreshold": "-1",
              "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
              "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "20000",
              "spark.sql.adaptive.advisoryPartitionSizeInBytes": "10000",
              "spark.sql.shuffle.partitions": "16"}
    before = {k: spark.conf.get(k, None) for k in values}
    for k, v in values.items():
        spark.conf.set(k, v)
    try:
        yield
    finally:
        for k, v in before.items():
            spark.conf.set(k, v) if v is not None else spark.conf.unset(k)


def executed(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_a_hot_key_of_the_table_is_split(spark):
    """A third of the rows share one key; adaptive execution splits that join task."""
    current = spark.range(0, 60000, 1, 8).selectExpr("if(id % 3 = 0, -1, id) AS dwid", "string(id) AS a")
    batch = spark.range(-1, 1000).selectExpr("id AS dwid", "'new' AS a")
    with tiny_partitions(spark):
        updated = updated_rows(current, batch)
        assert sum(r.a == "new" for r in updated.collect()) == 20000 + 666
        assert "skew=true" in executed(updated)


@pytest.mark.parametrize("hot", ["-1L", "CAST(NULL AS bigint)"])
def test_a_hot_new_key_of_the_batch_is_split(spark, hot):
    """The same for a key, or none, in a third of the new rows."""
    batch = spark.range(0, 60000, 1, 8).selectExpr(f"if(id % 3 = 0, {hot}, id) AS dwid", "string(id) AS a")
    with tiny_partitions(spark):
        new = new_rows(batch, spark.range(1, 1000).withColumnRenamed("id", "dwid"))
        assert len(new.collect()) == 60000 - 666
        assert "skew=true" in executed(new)


def test_hot_keys_are_folded_before_the_shuffle(spark):
    """However many rows carry a key, each task sends it on once."""
    current = spark.range(0, 60000, 1, 8).selectExpr("if(id % 3 = 0, -1, id % 7) AS dwid")
    with tiny_partitions(spark):
        keys = matched_keys(current, current)
        assert sorted(r.dwid for r in keys.collect()) == [-1, 0, 1, 2, 3, 4, 5, 6]
        assert folded_before_shuffle(plan(keys))


def test_a_hot_slice_is_split_when_written(spark, tmp_path):
    """Half of the keys fall into one slice; it is written by several tasks."""
    with tiny_partitions(spark):
        target = SnapshotTable(spark, f"{tmp_path}/t", slice_by="if(dwid % 2 = 0, 0, dwid % 7)")
        target.full_load(spark.range(0, 80000, 1, 8).selectExpr("id AS dwid", "uuid() AS a"))
    files = {s: len(list(tmp_path.glob(f"t/data/*/slice_no={s}/*.parquet"))) for s in (0, 3)}
    assert files[0] > 4 and files[3] <= files[0]
