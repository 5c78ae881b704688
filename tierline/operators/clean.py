"""Clean step: drop duplicate rows, fill nulls, cast, keep mapped columns."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.types import DataType

from tierline.functions.casts import fill_null, to_clean_type
from tierline.mapping import ColumnRule, TableMapping


def quoted(name: str) -> Column:
    return F.col("`" + name.replace("`", "``") + "`")


def drop_duplicate_rows(df: DataFrame) -> DataFrame:
    """Distinct rows over every column, also the unmapped ones."""
    return df.dropDuplicates()


def column_types(df: DataFrame, columns: list[Column]) -> list[DataType]:
    """Types of the expressions over ``df``, from one analysis of them all."""
    named = (c.alias(f"c{i}") for i, c in enumerate(columns))
    return [f.dataType for f in df.select(*named).schema] if columns else []


def fill_defaults(df: DataFrame, rules: list[ColumnRule]) -> DataFrame:
    """Fill nulls of the rules' source columns; other columns pass through."""
    columns = [quoted(r.source_column) for r in rules]
    filled = {r.source_column: fill_null(column, dtype, r.na_default)
              for r, column, dtype in zip(rules, columns, column_types(df, columns))}
    return df.withColumns(filled) if filled else df


def clean(df: DataFrame, mapping: TableMapping) -> DataFrame:
    """Clean one table; the result keeps the source column names.

    The defined order is "drop duplicates, fill column" once per mapped column.
    That equals one distinct between filling all columns but the last and
    filling the last, so rows that only become equal by the last fill or by a
    cast stay apart. One shuffle is enough; it hashes whole rows, so a hot
    column value cannot overload a task, and repeated rows are already folded
    before the shuffle.
    """
    rules = mapping.source_rules
    columns = [quoted(r.source_column) for r in rules]
    types = column_types(df, columns)
    distinct = drop_duplicate_rows(fill_defaults(df, rules[:-1]))
    return fill_defaults(distinct, rules[-1:]).select(*(
        to_clean_type(column, dtype, r.spark_type).alias(r.source_column)
        for r, column, dtype in zip(rules, columns, types)))
