"""Series operators over (group, order) rows.

A group may hold a third of all rows, so nothing here sends a whole group to one task. Positions come
from a range partitioning over group and order, and trailing windows run on fixed-size pieces of a
group with the rows before the piece copied in.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from siltstone.session import written

PIECE_ROWS = 1_000_000
#: Spark's own bound for limiting ranks before the shuffle (spark.sql.optimizer.windowGroupLimitThreshold).
RANKED_IN_TASK = 1_000
# monotonically_increasing_id keeps the partition number above this bit.
_PARTITION_BIT = 33


def join_null_safe(left: DataFrame, right: DataFrame, names: Sequence[str], how: str = "inner") -> DataFrame:
    """Equi-join in which NULL keys meet; the right side's keys are dropped."""
    renamed = right.select(*(F.col(n).alias(f"_r_{n}") if n in names else F.col(n) for n in right.columns))
    on = reduce(lambda a, b: a & b, (left[n].eqNullSafe(renamed[f"_r_{n}"]) for n in names))
    return left.join(renamed, on, how).drop(*(f"_r_{n}" for n in names))


def _placed(df: DataFrame, group: Sequence[str], order: Sequence[str]) -> DataFrame:
    """Rows range-partitioned by (group, order) and sorted, with their place and range, written once.

    A large group is cut over several partitions. Places cannot shift if a task is redone.
    """
    keys = [*group, *order]
    placed = df.repartitionByRange(*keys).sortWithinPartitions(*keys)
    placed = written(placed.withColumn("_place", F.monotonically_increasing_id()), "row-index")
    return placed.withColumn("_range", F.shiftright("_place", _PARTITION_BIT))


def _with_spans(placed: DataFrame, group: Sequence[str]) -> DataFrame:
    """Placed rows with what their range holds of their group: _first place, _held rows, _before and _after it.

    One small row per group and range is written, so that the planner knows their size and broadcasts
    them if small, without first shuffling the rows they are joined to.
    """
    held = placed.groupBy(*group, "_range").agg(F.min("_place").alias("_first"), F.count("*").alias("_held"))
    ranges = Window.partitionBy(*group).orderBy("_range")
    before = F.sum("_held").over(ranges.rowsBetween(Window.unboundedPreceding, -1))
    after = F.sum("_held").over(ranges.rowsBetween(1, Window.unboundedFollowing))
    spans = held.select(
        *group, "_range", "_first", "_held",
        F.coalesce(before, F.lit(0)).alias("_before"), F.coalesce(after, F.lit(0)).alias("_after"),
    )
    return join_null_safe(placed, written(spans, "row-offsets"), [*group, "_range"])


def with_row_index(df: DataFrame, group: Sequence[str], order: Sequence[str], name: str = "row_index") -> DataFrame:
    """0-based position of each row in its group.

    What each range of the sorted rows holds of each group gives the offset to add to a row's place.
    ``order`` should end in a unique column, or ties are numbered in no fixed order.
    """
    return _with_spans(_placed(df, group, order), group).select(
        *df.columns, (F.col("_place") - F.col("_first") + F.col("_before")).alias(name)
    )


def moving_averages(
    df: DataFrame,
    group: Sequence[str],
    order: Sequence[str],
    value: str,
    windows: dict[str, int],
    piece_rows: int = PIECE_ROWS,
) -> DataFrame:
    """Trailing means over the last n set values per output name; NULL until n rows exist.

    Rows without a value are dropped first. Each group is cut into pieces of ``piece_rows`` and the
    last n-1 rows of a piece are copied to the next, so a window never needs more than one piece.
    """
    reach = max(windows.values()) - 1
    size = max(piece_rows, reach, 1)
    indexed = with_row_index(df.where(F.col(value).isNotNull()), group, order, "_row")
    own = F.floor(F.col("_row") / size)
    also_next = F.col("_row") % size >= size - reach
    pieces = indexed.withColumn("_own", own).withColumn(
        "_piece",
        F.explode(F.when(also_next, F.array("_own", F.col("_own") + 1)).otherwise(F.array("_own"))),
    )
    by_row = Window.partitionBy(*group, "_piece").orderBy("_row")
    means = []
    for name, n in windows.items():
        frame = by_row.rowsBetween(-(n - 1), 0)
        means.append(F.when(F.count(value).over(frame) == n, F.avg(value).over(frame)).alias(name))
    return pieces.select("*", *means).where("_piece = _own").select(*df.columns, *windows)


def last_rows(df: DataFrame, group: Sequence[str], order: Sequence[str], n: int = 1) -> DataFrame:
    """The last ``n`` rows per group; of rows that tie on ``order`` any may be taken.

    Up to ``RANKED_IN_TASK`` rows, Spark limits the rank in each task before the shuffle, so at most n rows
    per group and task are moved. Beyond, it would send whole groups to one task each; a row's rank is then
    what comes after it in its range and group plus what later ranges hold of the group.
    """
    if n <= RANKED_IN_TASK:
        newest_first = Window.partitionBy(*group).orderBy(*(F.col(c).desc() for c in order))
        return df.withColumn("_rank", F.row_number().over(newest_first)).where(F.col("_rank") <= n).drop("_rank")
    spans = _with_spans(_placed(df, group, order), group)
    later = F.col("_first") + F.col("_held") - 1 - F.col("_place") + F.col("_after")
    return spans.where(later < n).select(*df.columns)


def latest_summary(df: DataFrame, group: Sequence[str], order: Sequence[str], date: str, value: str) -> DataFrame:
    """Groups, newest date, lowest and highest value over the latest row of each group."""
    return last_rows(df, group, order).agg(
        F.count("*").alias("group_cnt"),
        F.max(date).alias("latest"),
        F.min(value).alias("min_value"),
        F.max(value).alias("max_value"),
    )


def set_positions(df: DataFrame, group: Sequence[str], order: Sequence[str], value: str, name: str = "row_index") -> DataFrame:
    """Rows that have a value, numbered from 0 in their group: what a fit, its error and a forecast are made from."""
    return with_row_index(df.where(F.col(value).isNotNull()), group, order, name)


def linear_fit(indexed: DataFrame, group: Sequence[str], value: str, row_index: str = "row_index", min_rows: int = 5, also: Sequence[Column] = ()) -> DataFrame:
    """Least squares of ``value`` on the row index per group, for groups of at least ``min_rows`` set values.

    Rows without a value are left out; ``set_positions`` numbers the others without gaps.
    """
    return (
        indexed.groupBy(*group)
        .agg(
            F.count(value).alias("row_cnt"),
            F.regr_slope(value, row_index).alias("slope"),
            F.regr_intercept(value, row_index).alias("intercept"),
            *also,
        )
        .where(F.col("row_cnt") >= min_rows)
    )


def fit_error(indexed: DataFrame, fit: DataFrame, group: Sequence[str], value: str, row_index: str = "row_index") -> DataFrame:
    """Mean absolute error of each group's fit over the rows it was made from.

    The lines are written first, so that the join to all rows is planned by their true size.
    """
    lines = written(fit.select(*group, "slope", "intercept"), "fit")
    gap = F.abs(F.col(value) - (F.col("slope") * F.col(row_index) + F.col("intercept")))
    return join_null_safe(indexed, lines, group).groupBy(*group).agg(F.avg(gap).alias("mae"))


def forecast(indexed: DataFrame, group: Sequence[str], date: str, value: str, days: int, row_index: str = "row_index") -> DataFrame:
    """The ``days`` dates after the last one that has a value in each group, with the fitted value at each."""
    is_set = F.col(value).isNotNull()
    last = F.max(F.when(is_set, F.col(date).cast("date"))).alias("_last")
    place = F.max(F.when(is_set, F.col(row_index))).alias("_place")
    fit = linear_fit(indexed, group, value, row_index, also=[last, place])
    steps = fit.withColumn("step", F.explode(F.sequence(F.lit(1), F.lit(days))))
    return steps.select(
        *group,
        F.date_add("_last", F.col("step")).alias("forecast_date"),
        (F.col("slope") * (F.col("_place") + F.col("step")) + F.col("intercept")).alias("forecast"),
    )


def to_long(df: DataFrame, ids: Sequence[str], values: Sequence[str], name: str = "series", value: str = "value") -> DataFrame:
    """Value columns to (ids, series, value) rows."""
    return df.unpivot(list(ids), list(values), name, value)


def bars_to_long(df: DataFrame, date: str, tickers: Sequence[str], measures: Sequence[str], separator: str = "_", group: str = "ticker") -> DataFrame:
    """One ``<measure><separator><ticker>`` column each, to one row per date and ticker with the measures
    as columns. Tickers with no value on a date are left out."""
    per_ticker = F.array(
        *(
            F.struct(F.lit(t).alias(group), *(F.col(f"`{m}{separator}{t}`").alias(m) for m in measures))
            for t in tickers
        )
    )
    rows = df.select(date, F.inline(per_ticker))
    return rows.dropna(how="all", subset=list(measures))
