from datetime import date

import pytest
from hypothesis import HealthCheck, given, settings, strategies as st
from pyspark.sql import functions as F

from tierline.functions.casts import to_clean_type, to_long
from tierline.mapping import ColumnRule, day, decimal2, integer, string, table
from tierline.operators.clean import clean, fill_defaults

ABC = table("t", integer("a"), string("b"), string("c"))


def literal_chain(df, mapping):
    """The defined order, literally: distinct, then fill, once per column."""
    for rule in mapping.source_rules:
        df = fill_defaults(df.dropDuplicates(), [rule])
    return df.select(*(r.source_column for r in mapping.source_rules))


def test_clean_chain_keeps_rows_made_equal_by_the_last_fill(spark, rows):
    df = spark.createDataFrame(
        [(1, None, "p"), (1, "_", "p"), (None, "_", "p"), (0, "_", "p"), (0, "_", None), (0, "_", "_")],
        "a bigint, b string, c string")
    assert rows(clean(df, ABC)) == [(0, "_", "_"), (0, "_", "_"), (0, "_", "p"), (1, "_", "p")]


@settings(max_examples=12, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.tuples(st.sampled_from([None, 0, 1]), st.sampled_from([None, "_", "x"]),
                          st.sampled_from([None, "_", "y"]), st.sampled_from([None, 5])), max_size=12))
def test_one_distinct_equals_the_chain(spark, rows, data):
    df = spark.createDataFrame(data, "a bigint, b string, c string, unmapped int")
    assert rows(clean(df, ABC)) == rows(literal_chain(df, ABC))


def test_unmapped_columns_count_as_part_of_the_row(spark, rows):
    df = spark.createDataFrame([(1, "x"), (1, "y"), (1, "y")], "a bigint, other string")
    assert rows(clean(df, table("t", integer("a")))) == [(1,), (1,)]


def test_fill_by_type(spark, rows):
    df = spark.createDataFrame([(None, float("nan"), None, None)], "a bigint, b double, c bigint, d string")
    rules = [ColumnRule("t", n, n, "integer", d) for n, d in (("a", "0"), ("b", "0"), ("c", "_"), ("d", "_"))]
    assert rows(fill_defaults(df, rules)) == [(0, 0.0, None, "_")]


def test_nan_with_an_unusable_default_becomes_null(spark, rows):
    df = spark.createDataFrame([(float("nan"),)], "b double")
    assert rows(fill_defaults(df, [ColumnRule("t", "b", "b", "float", "_")])) == [(None,)]


def test_column_names_with_dots(spark, rows):
    df = spark.createDataFrame([(None,)], "`a.b` bigint")
    assert rows(clean(df, table("t", integer("a.b"))).toDF("x")) == [(0,)]


def test_date_pattern(spark, rows):
    df = spark.createDataFrame([(1, "2022-01-01"), (2, "2022-1-1"), (3, "x"), (4, None),
                                (5, "2022-02-30"), (6, "2022-01-01 10:00")], "i bigint, d string")
    assert rows(clean(df, table("t", day("d"), integer("i")))) == rows(spark.createDataFrame(
        [(date(2022, 1, 1), 1), (None, 2), (None, 3), (date(2022, 1, 1), 4), (None, 5), (None, 6)],
        "d date, i bigint"))


def test_float_rounds_half_up_after_the_cast(spark):
    df = spark.createDataFrame([(1.005,), (2.675,), (0.125,)], "f double")
    got = [round(r[0], 4) for r in clean(df, table("t", decimal2("f"))).collect()]
    assert sorted(got) == [0.13, 1.0, 2.67]
    assert clean(df, table("t", decimal2("f"))).dtypes == [("f", "float")]


@pytest.mark.parametrize("text, expected", [
    (" 12 ", 12), ("1.7", 1), ("-3.9 ", -3), (".5", 0), ("-.5", 0), (".", 0), ("12.", 12), ("x", None),
    ("1.2.3", None), ("", None), ("9223372036854775808", None), ("1e3", None), ("+4.0", 4)])
def test_long_from_text(spark, text, expected):
    df = spark.createDataFrame([(text,)], "t string")
    assert df.select(to_long(F.col("t"), df.schema[0].dataType)).first()[0] == expected


@pytest.mark.parametrize("number, expected", [
    (1.7, 1), (-1.7, -1), (1e30, 2**63 - 1), (-1e30, -(2**63)), (float("nan"), 0)])
def test_long_from_double(spark, number, expected):
    df = spark.createDataFrame([(number,)], "d double")
    assert df.select(to_long(F.col("d"), df.schema[0].dataType)).first()[0] == expected


@pytest.mark.parametrize("ansi", ["true", "false"])
def test_bad_values_end_as_null_not_default(spark, rows, ansi):
    before = spark.conf.get("spark.sql.ansi.enabled")
    spark.conf.set("spark.sql.ansi.enabled", ansi)
    try:
        df = spark.createDataFrame([("x", "y", "z")], "a string, b string, c string")
        assert rows(clean(df, table("t", integer("a"), decimal2("b"), day("c")))) == [(None, None, None)]
    finally:
        spark.conf.set("spark.sql.ansi.enabled", before)


def test_casts_equal_those_with_ansi_off(spark):
    """The casts against Spark's own non-ANSI cast, over text and numbers."""
    texts = [" 1", "1.5", "-0.9", "abc", "", "1e2", "99999999999999999999", "true", "+7", "0x1", "5 5", "NaN"]
    df = spark.createDataFrame([(t, float(i) * 1e18) for i, t in enumerate(texts)], "t string, d double")
    ours = df.select(*(to_clean_type(F.col(f.name), f.dataType, target).alias(f"{f.name}_{target}")
                       for f in df.schema for target in ("bigint", "string"))).collect()
    before = spark.conf.get("spark.sql.ansi.enabled")
    spark.conf.set("spark.sql.ansi.enabled", "false")
    try:
        plain = df.selectExpr(*(f"CAST({n} AS {t})" for n in ("t", "d") for t in ("bigint", "string"))).collect()
    finally:
        spark.conf.set("spark.sql.ansi.enabled", before)
    assert [tuple(r) for r in ours] == [tuple(r) for r in plain]


def test_unknown_type_is_an_error(spark):
    df = spark.createDataFrame([(1,)], "a bigint")
    rule = ColumnRule("t", "a", "a", "money", "0")
    with pytest.raises(ValueError, match="unknown type"):
        clean(df, table("t", lambda _: rule))
