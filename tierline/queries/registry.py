"""Registry of queries and of the SQL that must give the same rows."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}

#: Load time used wherever a result has to be repeatable.
AS_OF = "2024-05-01 06:00:00"
RUN_ID = 7


def query(name: str, sql: str):
    def register(fn):
        QUERIES[name] = fn
        ORACLES[name] = sql
        return fn
    return register


def given(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def source(spark: SparkSession, sf_dir: str, table: str, *columns: str) -> DataFrame:
    """Columns of a given table as SQL expressions."""
    return given(spark, sf_dir, table).selectExpr(*columns)
