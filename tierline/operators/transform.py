"""Transform step: rename, derive, and add the audit columns."""

from __future__ import annotations

import json
import threading
from collections.abc import Callable, Iterator, Mapping
from contextlib import contextmanager
from datetime import datetime

from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.types import StructType

from tierline.functions.casts import to_type
from tierline.functions.scalars import phone_tail
from tierline.mapping import CUSTOM, EXPRESSION, PHONE, TableMapping
from tierline.operators.clean import column_types, quoted

LOAD_TIME_FORMAT = "yyyy-MM-dd HH:mm:ss"

#: Derivation of a ``CUSTOM`` column, looked up by target column name.
CustomColumns = Mapping[str, Callable[[DataFrame], Column]]


def load_time(as_of: datetime | str | None) -> Column:
    """Load time as text; pass ``as_of`` so that all writes of a run agree."""
    if as_of is None:
        return F.date_format(F.current_timestamp(), LOAD_TIME_FORMAT)
    if isinstance(as_of, datetime):
        as_of = as_of.strftime("%Y-%m-%d %H:%M:%S")
    return F.lit(as_of)


_ANSI = "spark.sql.ansi.enabled"
_planning = threading.RLock()


@contextmanager
def null_on_error(spark: SparkSession) -> Iterator[None]:
    """Expressions resolved within give null where they have no value, whatever the session's mode.

    An expression takes its mode when it is resolved and keeps it.
    """
    with _planning:
        before = spark.conf.get(_ANSI)
        spark.conf.set(_ANSI, "false")
        try:
            yield
        finally:
            spark.conf.set(_ANSI, before)


def function_parameters(spark: SparkSession, function: str) -> list[str] | None:
    """Names of a SQL function's parameters, as the catalog keeps them; None if there is no such function."""
    if not spark.catalog.functionExists(function):
        return None
    for row in spark.sql(f"DESCRIBE FUNCTION EXTENDED {function}").collect():
        label, _, rest = row[0].partition(": ")
        if label == "Usage" and rest.startswith("{"):
            return StructType.fromDDL(json.loads(rest).get("sqlFunction.inputParam", "")).names
    return None  # a function of another kind


def catalog_columns(spark: SparkSession, mapping: TableMapping, functions: str) -> CustomColumns:
    """Derivations of ``CUSTOM`` columns by SQL functions ``<functions>.<table>__<target>``.

    Their parameters are named after cleaned columns.
    """
    found = {}
    for rule in mapping.rules:
        function = f"`{functions}`.`{mapping.name}__{rule.target_column}`"
        names = function_parameters(spark, function) if rule.transformation == CUSTOM else None
        if names is not None:
            call = f"{function}({', '.join(f'`{n}`' for n in names)})"
            found[rule.target_column] = lambda df, call=call: F.expr(call)
    return found


def transform(df: DataFrame, mapping: TableMapping, run_id: int | str,
              as_of: datetime | str | None = None,
              custom: CustomColumns | None = None, functions: str | None = None) -> DataFrame:
    """Silver columns in mapping order, then ``last_updated`` and ``etl_run_id``.

    Expressions see the cleaned columns under their source names; those without
    a value, as by division by zero, are null. A ``CUSTOM`` column comes from
    ``custom``, else from a SQL function of the database ``functions``
    (:func:`catalog_columns`); one that neither has is left out.
    """
    if functions:
        custom = {**catalog_columns(df.sparkSession, mapping, functions), **(custom or {})}
    with null_on_error(df.sparkSession):
        return _transformed(df, mapping, run_id, as_of, custom)


def _transformed(df: DataFrame, mapping: TableMapping, run_id: int | str, as_of: datetime | str | None,
                 custom: CustomColumns | None) -> DataFrame:
    derived = [r for r in mapping.rules if r.transformation == EXPRESSION]
    types = dict(zip(derived, column_types(df, [F.expr(r.expr) for r in derived])))
    columns = []
    for rule in mapping.rules:
        if rule.transformation == PHONE:
            value = phone_tail(quoted(rule.target_column))
        elif rule.transformation == EXPRESSION:
            value = to_type(F.expr(rule.expr), types[rule], rule.spark_type)
        elif rule.transformation == CUSTOM:
            if not custom or rule.target_column not in custom:
                continue
            value = custom[rule.target_column](df)
        else:
            value = quoted(rule.source_column)
        columns.append(value.alias(rule.target_column))
    return df.select(*columns,
                     load_time(as_of).alias("last_updated"),
                     F.lit(str(run_id)).alias("etl_run_id"))
