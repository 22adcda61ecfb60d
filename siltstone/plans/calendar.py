"""Calendar dimension."""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# Calendar bounds.
FIRST_DAY = date(1940, 1, 1)
LAST_DAY = date(2026, 12, 31)


def dim_date(spark: SparkSession, first: date = FIRST_DAY, last: date = LAST_DAY) -> DataFrame:
    """One row per day. Day, month, year and quarter are text; ``date_id`` is yyyymmdd as integer."""
    days = spark.range(0, (last - first).days + 1, 1, 1)
    dated = days.select(F.date_add(F.lit(first), F.col("id").cast("int")).alias("date"))
    date_id = F.year("date") * 10000 + F.month("date") * 100 + F.day("date")
    return dated.select(
        date_id.alias("date_id"),
        "date",
        F.date_format("date", "dd").alias("day_nbr"),
        F.date_format("date", "MM").alias("month_nbr"),
        F.date_format("date", "yyyy").alias("year"),
        F.quarter("date").cast("string").alias("quarter"),
    )
