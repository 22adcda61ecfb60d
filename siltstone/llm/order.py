"""Running totals over the whole of a table in a given order, without one task that sees all rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from siltstone.session import written

# monotonically_increasing_id keeps the partition number above this bit.
_PARTITION_BIT = 33


def with_total_before(df: DataFrame, order: Sequence[str], value: str, name: str) -> DataFrame:
    """``df`` with the sum of ``value`` over all rows before each row, 0 for the first.

    Rows are range-sorted and written once, summed within each range, and shifted by the sums of the
    ranges before, one small row per range. Rows that tie on ``order`` are taken in no fixed order.
    """
    placed = written(
        df.repartitionByRange(*order).sortWithinPartitions(*order).withColumn("_place", F.monotonically_increasing_id()),
        "ordered",
    ).withColumn("_range", F.shiftright("_place", _PARTITION_BIT))
    held = placed.groupBy("_range").agg(F.sum(value).alias("_sum"))
    earlier = Window.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    offsets = written(
        held.select("_range", F.coalesce(F.sum("_sum").over(earlier), F.lit(0)).alias("_offset")), "ordered-offsets"
    )
    within = Window.partitionBy("_range").orderBy("_place").rowsBetween(Window.unboundedPreceding, -1)
    before = F.coalesce(F.sum(value).over(within), F.lit(0)) + F.col("_offset")
    return placed.join(offsets, "_range").withColumn(name, before).select(*df.columns, name)
