"""Helpers shared by the text operators."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from tierline.session import scratch_path

#: The white space that separates words in the contracts of these operators.
SPACES = r"[\x20\x09-\x0D]+"


def stored(df: DataFrame, purpose: str) -> DataFrame:
    """The rows written to the shared folder and read back.

    Cuts lineage: what comes later never recomputes ``df``, also when an
    executor is lost. The folder goes when the application ends.
    """
    spark = df.sparkSession
    path = scratch_path(spark, purpose)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def shuffle_partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def whole_text(column: str = "text") -> Column:
    """The text, a null one as empty."""
    return F.coalesce(F.col(column).cast("string"), F.lit(""))


def groups_for(rows: int, target: int) -> int:
    """How many groups of about ``target`` rows hold ``rows`` rows."""
    return max(1, math.ceil(rows / target))
