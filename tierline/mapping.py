"""Column mapping: which source column becomes which silver column, and how."""

from __future__ import annotations

import re
from collections.abc import Iterable
from dataclasses import dataclass, fields

from pyspark.sql import SparkSession

# Markers and type names used in mapping files.
UNSET = "NA"
PHONE = "PHONE"
EXPRESSION = "EXPR"
CUSTOM = "CUSTOM"
SPARK_TYPES = {"date": "date", "string": "string", "integer": "bigint", "float": "float"}
NULL_DEFAULTS = {"date": "2022-01-01", "string": "_", "integer": "0", "float": "0"}

KEY = "dwid"
AUDIT_COLUMNS = ("last_updated", "etl_run_id")


@dataclass(frozen=True)
class ColumnRule:
    """One mapping row. Field names are the header of the mapping file."""

    source_table: str
    source_column: str
    target_column: str
    cast_to: str
    na_default: str = UNSET
    is_generated: str = "N"
    transformation: str = UNSET
    expr: str = UNSET
    dq_rule: str = UNSET

    @property
    def spark_type(self) -> str:
        try:
            return SPARK_TYPES[self.cast_to]
        except KeyError:
            raise ValueError(
                f"{self.source_table}.{self.target_column}: unknown type {self.cast_to!r}"
            ) from None


@dataclass(frozen=True)
class TableMapping:
    """The mapping rows of one table, in file order."""

    name: str
    rules: tuple[ColumnRule, ...]

    @property
    def source_rules(self) -> list[ColumnRule]:
        return [r for r in self.rules if r.is_generated == "N"]

    @property
    def dq_rules(self) -> list[str]:
        return [r.dq_rule for r in self.rules if r.dq_rule != UNSET]

    @property
    def key_parts(self) -> tuple[str, ...]:
        """Silver columns that the key's expression is made of, as far as they hold the ids as they are."""
        words = {w for r in self.rules if r.target_column == KEY for w in re.findall(r"\w+", r.expr)}
        return tuple(r.target_column for r in self.source_rules
                     if r.source_column in words and r.target_column != KEY and r.transformation == UNSET)

    @property
    def insert_columns(self) -> list[str]:
        """Columns a new row fills: all mapped ones, then the audit columns."""
        return [r.target_column for r in self.rules] + list(AUDIT_COLUMNS)

    @property
    def update_columns(self) -> list[str]:
        """Columns an existing row takes over: the same without the key."""
        return [c for c in self.insert_columns if c != KEY]


def by_table(rules: Iterable[ColumnRule]) -> dict[str, TableMapping]:
    """Group rules by table; tables in name order, rules in given order."""
    grouped: dict[str, list[ColumnRule]] = {}
    for rule in rules:
        grouped.setdefault(rule.source_table, []).append(rule)
    return {name: TableMapping(name, tuple(grouped[name])) for name in sorted(grouped)}


def read_mapping(spark: SparkSession, path: str) -> dict[str, TableMapping]:
    """Read a mapping CSV (header, quoted commas, every field a string)."""
    names = [f.name for f in fields(ColumnRule)]
    rows = (spark.read.csv(path, header=True, inferSchema=False, escape='"')
            .select(*names)
            .na.fill("")
            .collect())
    return by_table(ColumnRule(**row.asDict()) for row in rows)


# Builders, for mappings written in Python instead of CSV. Each returns a
# function of the table name so that a table reads as a plain list of columns.

def _column(cast_to: str, source: str, target: str | None, rule: str, transformation=UNSET):
    return lambda table: ColumnRule(
        table, source, target or source, cast_to, NULL_DEFAULTS[cast_to],
        transformation=transformation, dq_rule=rule)


def integer(source: str, target: str | None = None, rule: str = UNSET):
    return _column("integer", source, target, rule)


def string(source: str, target: str | None = None, rule: str = UNSET):
    return _column("string", source, target, rule)


def decimal2(source: str, target: str | None = None, rule: str = UNSET):
    return _column("float", source, target, rule)


def day(source: str, target: str | None = None, rule: str = UNSET):
    return _column("date", source, target, rule)


def phone(source: str):
    return _column("integer", source, None, UNSET, PHONE)


def generated(target: str, cast_to: str, expression: str):
    return lambda table: ColumnRule(
        table, UNSET, target, cast_to, is_generated="Y",
        transformation=EXPRESSION, expr=expression)


def identity_key(column: str, cast_to: str = "integer"):
    """Key taken from one id column."""
    return generated(KEY, cast_to, column)


def dated_key(*ids: str, cast_to: str = "integer"):
    """Key joined as text from the epoch seconds of ``date`` and the ids."""
    parts = ", ".join(("unix_timestamp(date,'yyyy-MM-dd')",) + ids)
    return generated(KEY, cast_to, f"concat({parts})")


def table(name: str, *columns) -> TableMapping:
    return TableMapping(name, tuple(column(name) for column in columns))
