"""Where queries and the SQL stating their results are registered."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    def register(function: Query) -> Query:
        if name in QUERIES:
            raise ValueError(f"query registered twice: {name}")
        QUERIES[name] = lambda spark, sf_dir: plain(function(spark, sf_dir))
        if sql is not None:
            ORACLES[name] = sql
        return function

    return register


def plain(df: DataFrame) -> DataFrame:
    """Dates and zone-less times as text and structs as columns, so that results compare by value."""
    columns = []
    for f in df.schema.fields:
        column = F.col(f"`{f.name}`")
        if isinstance(f.dataType, T.StructType):
            columns += [column[n].alias(f"{f.name}_{n}") for n in f.dataType.names]
        elif isinstance(f.dataType, (T.DateType, T.TimestampType, T.TimestampNTZType)):
            columns.append(column.cast("string").alias(f.name))
        else:
            columns.append(column)
    return df.select(*columns)


# --- fragments of the checking engine's SQL ---------------------------------------------------


def clean(x: str) -> str:
    return f"replace(trim({x}), '\"', '')"


def key(x: str, width: int = 6) -> str:
    return f"lpad({clean(x)}, {width}, '0')"


def day(x: str, *formats: str) -> str:
    tries = [f"cast(try_strptime({x}, '{f}') as date)" for f in formats]
    return tries[0] if len(tries) == 1 else f"coalesce({', '.join(tries)})"


ISO, US, COMPACT = "%Y-%m-%d", "%m/%d/%Y", "%Y%m%d"


def text(x: str) -> str:
    return f"cast({x} as varchar)"


def nulls(dtype: str, *names: str) -> str:
    return ", ".join(f"cast(null as {dtype}) as {n}" for n in names)


def date_id(x: str) -> str:
    return f"cast(strftime({x}, '%Y%m%d') as integer)"


IN_CALENDAR = "between date '1940-01-01' and date '2026-12-31'"
