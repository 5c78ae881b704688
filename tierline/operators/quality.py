"""Row-level data-quality rules of the form ``ColumnValues "c" in [..]`` or ``>= n``."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.types import NumericType, StructType

from tierline.operators.clean import quoted

# Names of the outcome columns and the two outcomes.
RULES_PASS = "DataQualityRulesPass"
RULES_FAIL = "DataQualityRulesFail"
RULES_SKIP = "DataQualityRulesSkip"
RESULT = "DataQualityEvaluationResult"
OUTCOME_COLUMNS = [RULES_PASS, RULES_FAIL, RULES_SKIP, RESULT]
PASSED, FAILED = "Passed", "Failed"

_RULE = re.compile(r'^\s*ColumnValues\s+"([^"]+)"\s*(in|>=|<=|!=|=|>|<)\s*(.+?)\s*$')
_VALUE = re.compile(r'"([^"]*)"|(-?\d+(?:\.\d+)?)')
_COMPARE = {
    ">=": lambda c, v: c >= v, ">": lambda c, v: c > v,
    "<=": lambda c, v: c <= v, "<": lambda c, v: c < v,
    "=": lambda c, v: c == v, "!=": lambda c, v: c != v,
}


def rule_text(rule: str) -> str:
    """Rule with double quotes, the form reports show."""
    return rule.replace("'", '"')


def ruleset_text(rules: list[str]) -> str:
    return "Rules = [" + ",".join(rule_text(r) for r in rules) + "]"


def _operand(column: Column, schema: StructType, name: str, textual: bool) -> Column:
    dtype = next((f.dataType for f in schema if f.name.lower() == name.lower()), None)
    if textual:
        return column.cast("string")
    return column if isinstance(dtype, NumericType) else column.try_cast("double")


def rule_condition(rule: str, schema: StructType) -> Column:
    """True where the row keeps the rule; a null value never does."""
    match = _RULE.match(rule_text(rule))
    if not match:
        raise ValueError(f"Unsupported data-quality rule: {rule}")
    name, operator, operand = match.groups()
    listed = operator == "in"
    if listed != (operand.startswith("[") and operand.endswith("]")):
        raise ValueError(f"Unsupported data-quality rule: {rule}")
    found = list(_VALUE.finditer(operand))
    leftover = _VALUE.sub("", operand.strip("[]")).replace(",", "").strip()
    if leftover or not found or (not listed and len(found) > 1):
        raise ValueError(f"Unsupported data-quality rule: {rule}")
    textual = any(m.group(1) is not None for m in found)
    values = [m.group(0).strip('"') if textual
              else float(m.group(2)) if "." in m.group(2) else int(m.group(2))
              for m in found]
    column = _operand(quoted(name), schema, name, textual)
    kept = column.isin(*values) if listed else _COMPARE[operator](column, F.lit(values[0]))
    return F.coalesce(kept, F.lit(False))


def _listed(rules: list[str], conditions: list[Column]) -> Column:
    """The texts whose condition holds; ``concat`` keeps this inside codegen."""
    nothing = F.array().cast("array<string>")
    return F.concat(nothing, *(
        F.when(holds, F.array(F.lit(rule_text(rule)))).otherwise(nothing)
        for rule, holds in zip(rules, conditions)))


def evaluate(df: DataFrame, rules: list[str]) -> DataFrame:
    """Add the four outcome columns; without rules the rows pass untouched."""
    if not rules:
        return df
    kept = [rule_condition(r, df.schema) for r in rules]
    all_kept = kept[0]
    for condition in kept[1:]:
        all_kept = all_kept & condition
    return df.select(
        "*",
        _listed(rules, kept).alias(RULES_PASS),
        _listed(rules, [~k for k in kept]).alias(RULES_FAIL),
        F.array().cast("array<string>").alias(RULES_SKIP),
        F.when(all_kept, PASSED).otherwise(FAILED).alias(RESULT))


def passed_rows(evaluated: DataFrame) -> DataFrame:
    """Rows that keep every rule, without the outcome columns."""
    return evaluated.filter(F.col(RESULT) == PASSED).drop(*OUTCOME_COLUMNS)


def failed_rows(evaluated: DataFrame) -> DataFrame:
    """Rows that break a rule, with the outcome columns."""
    return evaluated.filter(F.col(RESULT) == FAILED)


def rule_outcomes(evaluated: DataFrame, rules: list[str]) -> DataFrame:
    """One row per rule with its counts, from a single pass without a row shuffle."""
    texts = [rule_text(r) for r in rules]
    counts = evaluated.agg(
        F.count(F.lit(1)).alias("rows"),
        *(F.count_if(F.array_contains(RULES_FAIL, text)).alias(f"broken_{i}")
          for i, text in enumerate(texts)))
    per_rule = F.array(*(
        F.struct(F.lit(text).alias("Rule"), F.col(f"broken_{i}").alias("failed_rows"))
        for i, text in enumerate(texts)))
    return (counts.select("rows", F.inline(per_rule))
            .select("Rule",
                    F.when(F.col("failed_rows") == 0, PASSED).otherwise(FAILED).alias("Outcome"),
                    "failed_rows",
                    F.col("rows").alias("evaluated_rows")))
