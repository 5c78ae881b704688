"""Gold: the calendar dimension with a business quarter."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame, SparkSession, functions as F

from tierline.functions.scalars import business_quarter
from tierline.sources.snapshots import SnapshotTable

# Default span, and what is said of one that ends too early.
DEFAULT_SPAN = ("2022-01-01", "2025-12-31")
SPAN_PROBLEM = "End date must be after start date."


def date_dim(spark: SparkSession, start: str = DEFAULT_SPAN[0],
             end: str = DEFAULT_SPAN[1]) -> DataFrame:
    """One row per day from ``start`` to ``end``, both included."""
    first, last = (datetime.strptime(text, "%Y-%m-%d").date() for text in (start, end))
    if first >= last:
        raise ValueError(SPAN_PROBLEM)
    day = F.col("date")
    return (spark.range((last - first).days + 1)
            .select(F.date_add(F.lit(first), F.col("id").cast("int")).alias("date"))
            .select("date",
                    F.year(day).alias("year"), F.month(day).alias("month"),
                    F.dayofmonth(day).alias("day"), F.dayofweek(day).alias("day_of_week"),
                    F.weekofyear(day).alias("week_of_year"),
                    business_quarter(F.month(day)).alias("quarter")))


def load_date_dim(spark: SparkSession, gold: str, start: str = DEFAULT_SPAN[0],
                  end: str = DEFAULT_SPAN[1], preview: bool = False) -> SnapshotTable:
    """Replace ``<gold>/dim_date``; the earlier version is readable until then."""
    target = SnapshotTable(spark, f"{gold}/dim_date", key="date")
    df = date_dim(spark, start, end)
    target.full_load(df.coalesce(1))
    target.expire()
    if preview:
        target.read().show()
    return target
