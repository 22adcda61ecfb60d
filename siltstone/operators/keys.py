"""Key statistics and key joins."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from siltstone.functions.cleaning import trimmed

KEY_SEPARATOR = "|"


def any_null(columns: Sequence[str], blank: Sequence[str] = ()) -> Column:
    """True when a column is NULL, or one of ``blank`` has no text."""
    tests = [F.col(c).isNull() for c in columns] + [F.coalesce(trimmed(c) == "", F.lit(False)) for c in blank]
    return reduce(lambda a, b: a | b, tests)


def joined_key(columns: Sequence[str]) -> Column:
    """Key parts as one text; a NULL part makes the whole key NULL."""
    parts: list[Column] = []
    for c in columns:
        parts += [F.lit(KEY_SEPARATOR), F.col(c).cast("string")]
    return F.concat(*parts[1:])


def null_key_rows(df: DataFrame, columns: Sequence[str], blank: Sequence[str] = ()) -> DataFrame:
    """Rows with a missing key part; 0 for no rows."""
    hit = F.when(any_null(columns, blank), 1).otherwise(0)
    return df.agg(F.coalesce(F.sum(hit), F.lit(0)).alias("null_pk_rows"))


def null_key_cells(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Missing key cells over all columns; NULL for no rows."""
    cells = [F.sum(F.when(F.col(c).isNull(), 1).otherwise(0)) for c in columns]
    return df.agg(reduce(lambda a, b: a + b, cells).alias("null_pk_cells"))


def duplicate_keys(df: DataFrame, column: str) -> DataFrame:
    """Rows less distinct set keys, so a NULL key counts as a duplicate."""
    return df.agg((F.count("*") - F.count_distinct(column)).alias("dupes"))


def duplicate_joined_keys(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    return df.agg((F.count("*") - F.count_distinct(joined_key(columns))).alias("dupes"))


def repeated_key_groups(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """How many key groups hold more than one row; NULL forms a group."""
    return df.groupBy(*columns).count().where(F.col("count") > 1).agg(F.count("*").alias("dupes"))


def longest_text(df: DataFrame, key: str, text: str) -> DataFrame:
    """Longest text per key (NULL counts as empty); the greatest text wins among equals.

    Distinct pairs come first: they hash-aggregate before the shuffle, so a key that fills a third of
    the input reaches the sort-based second step as a few rows.
    """
    pairs = df.select(key, text).distinct()
    order = F.struct(F.length(F.coalesce(F.col(text), F.lit(""))), F.col(text))
    return pairs.groupBy(key).agg(F.max_by(text, order).alias(text))


def latest_value(df: DataFrame, key: str, value: str) -> DataFrame:
    """Greatest text value per key, both set, over distinct pairs (see ``longest_text``)."""
    pairs = df.select(key, value).dropna().distinct()
    return pairs.groupBy(key).agg(F.max(value).alias(value))


def attach_date_id(fact: DataFrame, calendar: DataFrame, date: str, how: str = "inner") -> DataFrame:
    """Add the calendar's ``date_id``. No hint is given: Spark broadcasts the calendar when its known
    size allows, and otherwise sort-merges with skewed dates split at run time."""
    days = calendar.select(F.col("date").alias("_day"), "date_id")
    return fact.join(days, fact[date] == days["_day"], how).drop("_day")


def enrich_left(df: DataFrame, lookup: DataFrame, key: str, values: Sequence[str]) -> DataFrame:
    """Left join to the lookup's distinct (key, values); a key with two values multiplies rows."""
    return df.join(lookup.select(key, *values).distinct(), key, "left")


def latest_partition(df: DataFrame, partition: str) -> DataFrame:
    """Rows of the greatest partition value. A scalar subquery finds it first, so only its folder is read."""
    newest = df.select(F.col(partition).alias("_newest")).distinct().agg(F.max("_newest"))
    return df.where(F.col(partition) == newest.scalar())
