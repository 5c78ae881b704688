"""Bronze layer: Parquet per run and table, and the rejected-row sink."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.types import (DateType, FloatType, IntegerType, StringType, StructField,
                               StructType)


def bronze_path(bronze: str, run_id: int | str, table: str) -> str:
    return f"{bronze}/{run_id}/{table}"


def write_bronze(df: DataFrame, bronze: str, run_id: int | str, table: str) -> str:
    path = bronze_path(bronze, run_id, table)
    df.write.mode("overwrite").parquet(path)
    return path


def read_bronze(spark: SparkSession, bronze: str, run_id: int | str, table: str) -> DataFrame:
    return spark.read.parquet(bronze_path(bronze, run_id, table))


def write_rejected(df: DataFrame, rejected: str, table: str, run_id: int | str) -> str:
    """Write failing rows as JSON, outcome columns included."""
    path = f"{rejected}/{table}/{run_id}"
    df.write.mode("overwrite").json(path)
    return path


# Columns of the all-null test row.
NULL_ROW_SCHEMA = StructType([
    StructField("chl_id", StringType()),
    StructField("date", DateType()),
    StructField("fat", FloatType()),
    StructField("qa_check", StringType()),
    StructField("quantity", IntegerType()),
    StructField("route_id", StringType()),
    StructField("snf", FloatType()),
])


def null_row(spark: SparkSession, schema: StructType = NULL_ROW_SCHEMA) -> DataFrame:
    """One row of nulls, to test null handling by a union with a source."""
    return spark.range(0, 1, 1, 1).select(
        *(F.lit(None).cast(f.dataType).alias(f.name) for f in schema))
