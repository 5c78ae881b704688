"""Casts that give null on bad input whatever the session's ANSI setting is.

The results are those of Spark 3 casts with ANSI mode off, which is what jobs
written for that release expect.
"""

from __future__ import annotations

from pyspark.sql import Column, functions as F
from pyspark.sql.types import (DataType, DateType, DoubleType, FloatType, StringType,
                               TimestampNTZType, TimestampType)

_LONG_MAX, _LONG_MIN = 2**63 - 1, -(2**63)
# Optional sign, optional digits, a point and further digits: "1.7", ".5", "-3."
_POINT_NUMBER = r"^(\s*[+-]?)(\d*)\.\d*\s*$"


def fill_null(column: Column, dtype: DataType, default: str) -> Column:
    """Replace null (and NaN) by ``default`` read as the column's own type.

    A default the type cannot hold, such as ``_`` for a number, fills nothing.
    """
    if isinstance(dtype, (DoubleType, FloatType)):
        column = F.nanvl(column, F.lit(None).cast(dtype))
    return F.coalesce(column, F.lit(default).try_cast(dtype))


def to_day(column: Column, dtype: DataType) -> Column:
    """Date from ``yyyy-MM-dd`` text; other text gives null."""
    if isinstance(dtype, DateType):
        return column
    if isinstance(dtype, (TimestampType, TimestampNTZType)):
        return column.cast("date")
    return F.try_to_date(column.cast("string"), "yyyy-MM-dd")


def to_long(column: Column, dtype: DataType) -> Column:
    """Whole number: fractions are cut off, floats out of range are clamped."""
    if isinstance(dtype, StringType):
        whole = F.regexp_replace(column, _POINT_NUMBER, "$10$2")
        return F.coalesce(column.try_cast("bigint"),
                          F.when(column.contains("."), whole.try_cast("bigint")))
    if isinstance(dtype, (DoubleType, FloatType)):
        return (F.when(F.isnan(column), F.lit(0).cast("bigint"))
                .when(column >= float(_LONG_MAX), F.lit(_LONG_MAX))
                .when(column <= float(_LONG_MIN), F.lit(_LONG_MIN))
                .otherwise(column.try_cast("bigint")))
    if isinstance(dtype, DateType):
        return F.lit(None).cast("bigint")
    return column.try_cast("bigint")


def to_type(column: Column, dtype: DataType, target: str) -> Column:
    """Plain cast to one of the mapping's Spark types."""
    if target == "bigint":
        return to_long(column, dtype)
    return column.try_cast(target)


def to_clean_type(column: Column, dtype: DataType, target: str) -> Column:
    """Cast of a source column: dates by pattern, floats rounded to cents."""
    if target == "date":
        return to_day(column, dtype)
    if target == "float":
        return F.round(column.try_cast("float"), 2)
    return to_type(column, dtype, target)
