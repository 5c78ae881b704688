from datetime import datetime

import pytest
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

from tierline.mapping import (CUSTOM, ColumnRule, dated_key, day, generated, identity_key, integer,
                              phone, read_mapping, string, table)
from tierline.operators.clean import clean
from tierline.operators.transform import transform

AS_OF = "2024-05-01 06:00:00"


def run(df, mapping, **more):
    return transform(clean(df, mapping), mapping, 3, AS_OF, **more)


def test_phone(spark, rows):
    df = spark.createDataFrame([(919876543210,), (12345,), (None,)], "phone bigint")
    out = run(df, table("t", phone("phone")))
    assert out.dtypes[0] == ("phone", "string")
    assert rows(out, "phone") == [("0",), ("12345",), ("9876543210",)]


def test_phone_needs_equal_source_and_target(spark):
    df = spark.createDataFrame([(1,)], "tel bigint")
    rule = ColumnRule("t", "tel", "phone", "integer", "0", transformation="PHONE")
    with pytest.raises(AnalysisException):
        run(df, table("t", lambda _: rule))


def test_keys(spark, rows):
    df = spark.createDataFrame([("2023-01-01", 7, 1), ("bad", 7, 2)], "date string, id bigint, other bigint")
    columns = day("date"), integer("id"), integer("other")
    assert rows(run(df, table("t", identity_key("id"), *columns)), "dwid") == [(7,), (7,)]
    assert rows(run(df, table("t", dated_key("id"), *columns)), "dwid") == [(None,), (16725312007,)]
    two = table("t", dated_key("id", "other", cast_to="string"), *columns)
    assert rows(run(df, two), "dwid") == [(None,), ("167253120071",)]


def test_text_keys_can_collide(spark, rows):
    df = spark.createDataFrame([("2023-01-01", 1, 12), ("2023-01-01", 11, 2)], "date string, a bigint, b bigint")
    keys = rows(run(df, table("t", dated_key("a", "b", cast_to="string"), day("date"),
                              integer("a"), integer("b"))), "dwid")
    assert keys[0] == keys[1]


def test_order_rename_and_audit_columns(spark):
    df = spark.createDataFrame([("x", 1, True)], "name string, id bigint, unmapped boolean")
    mapping = table("t", identity_key("id"), string("name", "full_name"), integer("id"))
    out = run(df, mapping)
    assert out.columns == mapping.insert_columns == ["dwid", "full_name", "id", "last_updated", "etl_run_id"]
    assert mapping.update_columns == ["full_name", "id", "last_updated", "etl_run_id"]
    assert tuple(out.first()) == (1, "x", 1, AS_OF, "3")


def test_load_time_forms(spark):
    df = spark.createDataFrame([(1,)], "id bigint")
    mapping = table("t", integer("id"))
    given = transform(df, mapping, 1, datetime(2024, 1, 2, 3, 4, 5)).first()["last_updated"]
    assert given == "2024-01-02 03:04:05"
    now = transform(df, mapping, 1).first()["last_updated"]
    assert datetime.strptime(now, "%Y-%m-%d %H:%M:%S")


def test_custom_columns(spark):
    rule = ColumnRule("t", "NA", "size", "string", is_generated="Y", transformation=CUSTOM)
    mapping = table("t", integer("id"), lambda _: rule)
    df = spark.createDataFrame([(5,)], "id bigint")
    assert "size" not in run(df, mapping).columns
    assert run(df, mapping, custom={"size": lambda d: F.lit("big")}).first()["size"] == "big"


def test_custom_columns_by_sql_functions(spark, tmp_path):
    rules = [ColumnRule("t", "NA", n, "string", is_generated="Y", transformation=CUSTOM) for n in ("size", "given", "other")]
    mapping = table("t", integer("id"), string("note"), *(lambda _, r=r: r for r in rules))
    spark.sql(f"CREATE DATABASE IF NOT EXISTS tierline_fn LOCATION '{tmp_path}/fn'")
    spark.sql("CREATE OR REPLACE FUNCTION tierline_fn.t__size(id BIGINT, note STRING) RETURNS STRING RETURN concat(note, id)")
    spark.sql("CREATE OR REPLACE FUNCTION tierline_fn.t__given() RETURNS STRING RETURN 'catalog'")
    spark.sql("CREATE OR REPLACE FUNCTION tierline_fn.u__other() RETURNS STRING RETURN 'of another table'")
    df = spark.createDataFrame([(5, "n")], "id bigint, note string")
    row = run(df, mapping, functions="tierline_fn").first()
    assert (row["size"], row["given"]) == ("n5", "catalog") and "other" not in row
    assert run(df, mapping, functions="tierline_fn", custom={"given": lambda d: F.lit("code")}).first()["given"] == "code"
    assert "size" not in run(df, mapping, functions="no_such_database").columns


def test_expression_types(spark):
    df = spark.createDataFrame([("1.7", 2.345)], "t string, d double")
    mapping = table("t", generated("whole", "integer", "t"), generated("real", "float", "d"),
                    generated("text", "string", "d"), generated("none", "date", "t"))
    out = transform(df, mapping, 1, AS_OF)
    assert [t for _, t in out.dtypes[:4]] == ["bigint", "float", "string", "date"]
    row = out.first()
    assert (row.whole, round(row.real, 3), row.text, row.none) == (1, 2.345, "2.345", None)


def test_mapping_file(spark, tmp_path):
    path = tmp_path / "mapping.csv"
    path.write_text(
        "source_table,source_column,target_column,cast_to,na_default,is_generated,transformation,expr,dq_rule\n"
        "b,NA,dwid,integer,NA,Y,EXPR,\"concat(unix_timestamp(date,'yyyy-MM-dd'), id)\",NA\n"
        "b,date,date,date,2022-01-01,N,NA,NA,NA\n"
        "a,kind,kind,string,_,N,NA,NA,\"ColumnValues 'kind' in ['F','M']\"\n"
        "b,id,id,integer,0,N,NA,NA,NA\n")
    mapping = read_mapping(spark, str(path))
    assert list(mapping) == ["a", "b"]
    assert mapping["a"].dq_rules == ["ColumnValues 'kind' in ['F','M']"]
    assert mapping["b"] == table("b", dated_key("id"), day("date"), integer("id"))


def test_expressions_without_a_value_are_null_in_any_session(spark):
    from tierline.mapping import generated, integer, table
    mapping = table("t", generated("x", "integer", "100 / q"), generated("y", "integer", "cast(s AS int) + 1"), integer("q"))
    before = spark.conf.get("spark.sql.ansi.enabled")
    for mode in ("true", "false"):
        spark.conf.set("spark.sql.ansi.enabled", mode)
        try:
            rows = transform(spark.sql("SELECT * FROM VALUES (0L, 'a'), (4L, '5') AS t(q, s)"), mapping, 1, "now")
            assert sorted((r.q, r.x, r.y) for r in rows.collect()) == [(0, None, None), (4, 25, 6)]
            assert spark.conf.get("spark.sql.ansi.enabled") == mode
        finally:
            spark.conf.set("spark.sql.ansi.enabled", before)
