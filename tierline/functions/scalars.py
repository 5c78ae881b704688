"""Scalar expressions shared by the silver and gold tables."""

from __future__ import annotations

from pyspark.sql import Column, functions as F


def phone_tail(column: Column) -> Column:
    """Last ten characters; shorter values stay as they are."""
    return F.substring(column.cast("string"), -10, 10)


def business_quarter(month: Column) -> Column:
    """Quarter of a year that begins in March (December to February is 4)."""
    quarter = (F.floor(F.pmod(month + 9, F.lit(12)) / 3) + 1).cast("int")
    return F.when(month.between(1, 12), quarter)
