"""Queries for the data-quality step."""

from __future__ import annotations

from pyspark.sql import functions as F

from tierline.operators import quality
from tierline.queries.registry import given, query
from tierline.session import scratch_path
from tierline.sources.bronze import write_rejected

RULES = ["ColumnValues 'c_mktsegment' in ['BUILDING','MACHINERY','FURNITURE']",
         "ColumnValues 'c_acctbal' >= 0", "ColumnValues 'c_nationkey' != 3"]
_KEPT = ["c_mktsegment IN ('BUILDING','MACHINERY','FURNITURE')", "c_acctbal >= 0", "c_nationkey <> 3"]
_TEXTS = [quality.rule_text(r) for r in RULES]
_ALL = " AND ".join(_KEPT)
_COLUMNS = "c_custkey, c_name, c_nationkey, c_acctbal, c_mktsegment"


def _texts(conditions):
    return "concat_ws('; ', " + ", ".join(
        f"CASE WHEN {c} THEN '{t}' END" for c, t in zip(conditions, _TEXTS)) + ")"


_FAIL_SQL = _texts([f"NOT ({c})" for c in _KEPT])


def _evaluated(spark, sf_dir):
    return quality.evaluate(given(spark, sf_dir, "customer"), RULES)


def _flat(df, *columns):
    lists = {"rules_pass": quality.RULES_PASS, "rules_fail": quality.RULES_FAIL,
             "rules_skip": quality.RULES_SKIP}
    return df.select(*columns, F.col(quality.RESULT).alias("result"),
                     *(F.concat_ws("; ", c).alias(n) for n, c in lists.items()))


@query("dq_row_outcomes", f"""
    SELECT c_custkey, CASE WHEN {_ALL} THEN 'Passed' ELSE 'Failed' END AS result,
           {_texts(_KEPT)} AS rules_pass, {_FAIL_SQL} AS rules_fail, '' AS rules_skip
    FROM customer""")
def dq_row_outcomes(spark, sf_dir):
    return _flat(_evaluated(spark, sf_dir), "c_custkey")


@query("dq_rule_outcomes", " UNION ALL ".join(f"""
    SELECT '{t}' AS "Rule",
           CASE WHEN count(*) FILTER (NOT ({c})) = 0 THEN 'Passed' ELSE 'Failed' END AS "Outcome",
           count(*) FILTER (NOT ({c})) AS failed_rows, count(*) AS evaluated_rows
    FROM customer""" for c, t in zip(_KEPT, _TEXTS)))
def dq_rule_outcomes(spark, sf_dir):
    return quality.rule_outcomes(_evaluated(spark, sf_dir), RULES)


@query("dq_passed", f"SELECT {_COLUMNS} FROM customer WHERE {_ALL}")
def dq_passed(spark, sf_dir):
    return quality.passed_rows(_evaluated(spark, sf_dir))


@query("dq_failed", f"""
    SELECT {_COLUMNS}, 'Failed' AS result, {_texts(_KEPT)} AS rules_pass,
           {_FAIL_SQL} AS rules_fail, '' AS rules_skip
    FROM customer WHERE NOT ({_ALL})""")
def dq_failed(spark, sf_dir):
    return _flat(quality.failed_rows(_evaluated(spark, sf_dir)), *_COLUMNS.split(", "))


@query("dq_rejects_json", f"""
    SELECT c_custkey, 'Failed' AS result, {_FAIL_SQL} AS rules_fail
    FROM customer WHERE NOT ({_ALL})""")
def dq_rejects_json(spark, sf_dir):
    """Failing rows written as JSON and read back."""
    failed = quality.failed_rows(_evaluated(spark, sf_dir))
    path = write_rejected(failed, scratch_path(spark, "rejected"), "customer", 7)
    return _flat(spark.read.schema(failed.schema).json(path), "c_custkey").drop(
        "rules_pass", "rules_skip")


@query("dq_comparisons", """
    SELECT p_partkey, CASE WHEN p_size > 5 AND p_size < 45 AND p_retailprice <= 950.5
                            AND p_type = 'SMALL' AND p_size != 10 THEN 'Passed' ELSE 'Failed' END AS result
    FROM part""")
def dq_comparisons(spark, sf_dir):
    rules = ['ColumnValues "p_size" > 5', 'ColumnValues "p_size" < 45',
             'ColumnValues "p_retailprice" <= 950.5', 'ColumnValues "p_type" = "SMALL"',
             'ColumnValues "p_size" != 10']
    return quality.evaluate(given(spark, sf_dir, "part"), rules).select(
        "p_partkey", F.col(quality.RESULT).alias("result"))
