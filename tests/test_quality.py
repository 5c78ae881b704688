import pytest
from pyspark.sql import functions as F

from tierline.operators import quality as q

RULES = ["ColumnValues 'gender' in ['F','M']", "ColumnValues 'cattle' >= 2"]


@pytest.fixture
def evaluated(spark):
    df = spark.createDataFrame([("F", 3), ("_", 1), (None, 5)], "gender string, cattle bigint")
    return q.evaluate(df, RULES)


def test_outcomes_per_row(evaluated, rows):
    first, second = map(q.rule_text, RULES)
    assert rows(evaluated, "gender", q.RULES_PASS, q.RULES_FAIL, q.RULES_SKIP, q.RESULT) == [
        (None, [second], [first], [], "Failed"),
        ("F", [first, second], [], [], "Passed"),
        ("_", [], [first, second], [], "Failed")]


def test_outcome_types(evaluated):
    assert dict(evaluated.dtypes)[q.RULES_PASS] == "array<string>"
    assert dict(evaluated.dtypes)[q.RESULT] == "string"


def test_split_loses_nothing(evaluated):
    passed, failed = q.passed_rows(evaluated), q.failed_rows(evaluated)
    assert passed.columns == ["gender", "cattle"]
    assert failed.columns == ["gender", "cattle", *q.OUTCOME_COLUMNS]
    assert passed.count() + failed.count() == evaluated.count() == 3


def test_rule_outcomes(evaluated, rows):
    first, second = map(q.rule_text, RULES)
    assert rows(q.rule_outcomes(evaluated, RULES)) == sorted([
        (first, "Failed", 2, 3), (second, "Failed", 1, 3)], key=str)


def test_rule_outcomes_of_no_rows(evaluated, rows):
    counts = {r[2:] for r in rows(q.rule_outcomes(evaluated.limit(0), RULES))}
    assert counts == {(0, 0)}


def test_ruleset_text():
    assert q.ruleset_text(RULES) == (
        'Rules = [ColumnValues "gender" in ["F","M"],ColumnValues "cattle" >= 2]')


def test_no_rules_leave_rows_untouched(spark):
    df = spark.range(3)
    assert q.evaluate(df, []) is df


@pytest.mark.parametrize("rule, kept", [
    ("ColumnValues 'n' > 2", [3]), ("ColumnValues 'n' < 2", [1]), ("ColumnValues 'n' <= 2", [1, 2]),
    ("ColumnValues 'n' = 2", [2]), ("ColumnValues 'n' != 2", [1, 3]), ("ColumnValues 'n' in [1, 3]", [1, 3]),
    ("ColumnValues 't' >= 2.5", [3]), ("ColumnValues 'n' in ['1']", [1]), ("ColumnValues 't' = 'x'", [1]),
    ("ColumnValues 'n' >= -1", [1, 2, 3])])
def test_rule_forms(spark, rule, kept):
    df = spark.createDataFrame([(1, "x"), (2, "2"), (3, "3.0")], "n int, t string")
    got = df.filter(q.rule_condition(rule, df.schema)).select("n").collect()
    assert sorted(r[0] for r in got) == kept


@pytest.mark.parametrize("rule", ["IsComplete 'a'", "ColumnValues 'a' in 3", "ColumnValues 'a' >= [1]",
                                  "ColumnValues 'a' in []", "ColumnValues 'a' > 1 and 2", "ColumnValues 'a' = b"])
def test_unsupported_rules_are_errors(spark, rule):
    with pytest.raises(ValueError, match="Unsupported"):
        q.rule_condition(rule, spark.range(1).schema)


def test_null_never_keeps_a_rule(spark):
    df = spark.createDataFrame([(None,)], "a int")
    for rule in ("ColumnValues 'a' != 1", "ColumnValues 'a' in [1]"):
        assert df.select(q.rule_condition(rule, df.schema).alias("k")).filter(F.col("k")).count() == 0
