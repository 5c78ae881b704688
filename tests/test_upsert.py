from collections import Counter

import pytest
from hypothesis import HealthCheck, given, settings, strategies as st

from tierline.operators.upsert import (DuplicateKeyError, check_conflicts, conflicting_keys,
                                       matched_keys, updated_rows, upsert)

SCHEMA = "dwid bigint, a string"


def by_hand(current, batch):
    """What the upsert must give, row by row."""
    new = {k: a for k, a in batch if k is not None}
    existing = {k for k, _ in current if k is not None}
    kept = [(k, new.get(k, a)) if k is not None else (k, a) for k, a in current]
    return Counter(kept + [(k, a) for k, a in batch if k is None or k not in existing])


def test_fixture(spark, rows):
    current = spark.createDataFrame([(None, "a"), (1, "b")], SCHEMA)
    batch = spark.createDataFrame([(None, "n"), (1, "u")], SCHEMA)
    assert rows(upsert(current, batch)) == [(None, "a"), (None, "n"), (1, "u")]


key = st.one_of(st.none(), st.integers(0, 6))


@settings(max_examples=15, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.tuples(key, st.text("xy", max_size=2)), max_size=10),
       st.lists(st.tuples(st.integers(0, 9), st.text("pq", max_size=2)), max_size=6,
                unique_by=lambda r: r[0]), st.booleans())
def test_against_brute_force(spark, current, batch, with_null):
    batch = batch + [(None, "n")] * with_null
    got = upsert(spark.createDataFrame(current, SCHEMA), spark.createDataFrame(batch, SCHEMA))
    assert Counter(map(tuple, got.collect())) == by_hand(current, batch)


def test_rows_that_share_a_key_are_all_updated(spark, rows):
    current = spark.createDataFrame([(1, "a"), (1, "b"), (2, "c")], SCHEMA)
    batch = spark.createDataFrame([(1, "new")], SCHEMA)
    assert rows(upsert(current, batch)) == [(1, "new"), (1, "new"), (2, "c")]


def test_new_rows_may_share_a_key(spark, rows):
    batch = spark.createDataFrame([(9, "a"), (9, "b")], SCHEMA)
    assert rows(upsert(spark.createDataFrame([(1, "x")], SCHEMA), batch)) == [(1, "x"), (9, "a"), (9, "b")]


def test_null_values_overwrite(spark, rows):
    current = spark.createDataFrame([(1, "a")], SCHEMA)
    assert rows(upsert(current, spark.createDataFrame([(1, None)], SCHEMA))) == [(1, None)]


def test_columns_only_the_table_has(spark, rows):
    current = spark.createDataFrame([(1, "a", True), (2, "b", False)], SCHEMA + ", own boolean")
    batch = spark.createDataFrame([(1, "u"), (3, "n")], SCHEMA)
    assert rows(upsert(current, batch)) == [(1, "u", True), (2, "b", False), (3, "n", None)]
    assert updated_rows(current, batch).columns == ["dwid", "a", "own"]


@pytest.mark.parametrize("small", [True, False])
def test_conflicts(spark, rows, small):
    current = spark.createDataFrame([(1, "a"), (1, "a2"), (2, "b")], SCHEMA)
    batch = spark.createDataFrame([(1, "x"), (1, "y"), (2, "z"), (9, "n"), (9, "n"), (None, "q"), (None, "q")], SCHEMA)
    matched = matched_keys(current, batch, batch_is_small=small)
    assert rows(matched) == [(1,), (2,)]
    assert rows(conflicting_keys(batch, matched)) == [(1,)]
    with pytest.raises(DuplicateKeyError, match=r"\[1\]"):
        check_conflicts(batch, matched)


def test_twice_is_once(spark, rows):
    current = spark.createDataFrame([(1, "a"), (2, "b")], SCHEMA)
    batch = spark.createDataFrame([(2, "u"), (3, "n")], SCHEMA)
    once = upsert(current, batch)
    assert rows(upsert(once, batch)) == rows(once)
