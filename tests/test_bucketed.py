import random
from collections import Counter

import pytest

from tierline.operators.upsert import DuplicateKeyError
from tierline.sources.bucketed import BucketedTable
from test_upsert import SCHEMA, by_hand


@pytest.fixture
def target(spark, tmp_path):
    database = f"tierline_buckets_{tmp_path.name.replace('-', '_').lower()[-30:]}"
    spark.sql(f"CREATE DATABASE IF NOT EXISTS `{database}` LOCATION '{tmp_path}/db'")
    yield BucketedTable(spark, f"{tmp_path}/t", database, "t", buckets=6)
    spark.sql(f"DROP DATABASE `{database}` CASCADE")


def test_loads_against_brute_force(spark, target):
    chance = random.Random(12)
    state = [(chance.choice([None, 0, 0, *range(40)]), f"s{i}") for i in range(80)]
    target.full_load(spark.createDataFrame(state, SCHEMA))
    for load in range(3):
        batch = [(k, f"b{load}") for k in chance.sample(range(60), 20)] + [(None, f"b{load}")] * 2
        target.upsert(spark.createDataFrame(batch, SCHEMA))
        expected = by_hand(state, batch)
        assert Counter(map(tuple, target.read().collect())) == expected
        state = list(expected.elements())
    assert Counter(map(tuple, spark.table(f"{target.database}.t").collect())) == expected
    assert target.versions() == [3, 4]


def test_only_the_batch_is_shuffled(spark, target):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        target.full_load(spark.range(5000).selectExpr("id AS dwid", "'a' AS a"))
        batch = target.dealt(spark.range(2000, 7000).selectExpr("id AS dwid", "'b' AS a"))
        merged = target.merged(batch)
        assert merged.groupBy("a").count().collect()
        plan = merged._jdf.queryExecution().executedPlan().toString()
        exchanges = plan.count("Exchange hashpartitioning")
        # The batch meets the table twice; nothing above a scan of the table is exchanged.
        assert exchanges <= 2 and plan.count("Bucketed: true") == 2, plan
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_conflicts_and_the_first_upsert(spark, target):
    target.upsert(spark.createDataFrame([(1, "a"), (2, "b")], SCHEMA))
    with pytest.raises(DuplicateKeyError):
        target.upsert(spark.createDataFrame([(1, "x"), (1, "y")], SCHEMA))
    assert sorted(map(tuple, target.read().collect())) == [(1, "a"), (2, "b")] and target.versions() == [1]
    other = BucketedTable(spark, target.root, target.database, "t", buckets=99)
    assert other.buckets() == 6
    other.upsert(spark.createDataFrame([(2, "B"), (3, "c")], SCHEMA))
    assert sorted(map(tuple, target.read().collect())) == [(1, "a"), (2, "B"), (3, "c")]
    with pytest.raises(FileExistsError):
        target._save(target.read(), 1, 6)
