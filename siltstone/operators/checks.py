"""Declarative data checks: missing keys, duplicate keys, row counts.

All checks of a table come from one scan. Rows are first counted per key, which combines before the
shuffle and leaves one row per key however often it occurs; the totals follow from those counts.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from siltstone.functions.cleaning import trimmed
from siltstone.operators.keys import any_null, joined_key
from siltstone.sources.schemas import INGEST_DT

ZERO, GT_ZERO, GE_ONE = "zero", "gt_zero", "ge_one"
_HOLDS = {
    ZERO: lambda v: v == 0,
    GT_ZERO: lambda v: v > 0,
    GE_ONE: lambda v: v >= 1,
}


@dataclass(frozen=True)
class TableChecks:
    """What a table's key must satisfy.

    ``duplicates``: ``distinct`` (rows less distinct keys), ``joined`` (the same over the parts as one
    text) or ``groups`` (key groups of more than one row). ``nulls``: ``rows`` (0 for an empty
    partition), ``cells`` (NULL, and so an error, for an empty one).
    """

    table: str
    key: Sequence[str]
    duplicates: str
    nulls: str = "rows"
    null_columns: Sequence[str] = ()
    not_blank: Sequence[str] = ()
    dates: Sequence[str] = ()


# The checked keys of the curated tables, and how each is judged.
TABLE_CHECKS = (
    TableChecks("dim_facility", ["ccn_provnum"], "distinct"),
    TableChecks(
        "fact_ownership",
        ["ccn_provnum", "association_date", "ownership_role", "owner_type", "ownership_pct", "owner_name"],
        "joined",
    ),
    TableChecks("dim_measure", ["measure_code"], "distinct"),
    TableChecks("fact_facility_covid", ["ccn_provnum"], "distinct", "cells", dates=["vax_data_last_update"]),
    TableChecks(
        "fact_state_covid_vax_avgs", ["state", "date_vax_data_last_updated"], "groups", "cells", ["state"]
    ),
    TableChecks(
        "fact_survey_event", ["ccn_provnum", "survey_date", "survey_type"], "groups", not_blank=["survey_type"]
    ),
    TableChecks("fact_penalties", ["ccn_provnum", "penalty_date", "penalty_type", "penalty_amt"], "joined", "cells"),
    TableChecks(
        "fact_quality_measure_score",
        ["ccn_provnum", "measure_code", "measure_period"],
        "groups",
        not_blank=["measure_code", "measure_period"],
    ),
    TableChecks(
        "fact_citations",
        ["ccn_provnum", "survey_date", "deficiency_tag_nbr", "survey_type"],
        "joined",
        "cells",
        ["ccn_provnum", "survey_date", "deficiency_tag_nbr", "survey_type", "date_id"],
    ),
    TableChecks("fact_staffing_daily", ["ccn_provnum", "workdate"], "groups"),
    TableChecks("fact_survey_cycle_summary", ["ccn_provnum", "inspection_cycle"], "joined", "cells"),
)
RAW_HEADER_TEXT = "CMS CERTIFICATION NUMBER (CCN)"


def _total(flags: Sequence[Column]) -> Column:
    return reduce(lambda a, b: a + b, [F.sum(F.when(f, 1).otherwise(0)) for f in flags])


def check_table(df: DataFrame, rules: TableChecks, partition: str | None = None) -> DataFrame:
    """One row per check: name, table, partition, value, expectation, outcome."""
    if partition is not None:
        df = df.where(F.col(INGEST_DT) == partition)
    columns = rules.null_columns or rules.key
    flags = (
        [any_null(columns, rules.not_blank)]
        if rules.nulls == "rows"
        else [F.col(c).isNull() for c in columns]
    )
    keys = {
        "distinct": lambda: [F.col(rules.key[0]).alias("_k0")],
        "joined": lambda: [joined_key(rules.key).alias("_k0")],
        "groups": lambda: [F.col(c).alias(f"_k{i}") for i, c in enumerate(rules.key)],
    }[rules.duplicates]()
    per_key = df.groupBy(*keys).agg(
        F.count("*").alias("n"),
        _total(flags).alias("nulls"),
        *(_total([F.col(d).isNull()]).alias(f"nulls_{d}") for d in rules.dates),
    )
    rows = F.coalesce(F.sum("n"), F.lit(0))
    repeated = (
        F.count(F.when(F.col("n") > 1, 1)) if rules.duplicates == "groups" else rows - F.count("_k0")
    )
    missing = F.sum("nulls")
    values = {
        "nullpk": (F.coalesce(missing, F.lit(0)) if rules.nulls == "rows" else missing, ZERO),
        "dupes": (repeated, ZERO),
        **{f"nulldates_{d}": (F.sum(f"nulls_{d}"), ZERO) for d in rules.dates},
        "rowcnt": (rows, GT_ZERO),
    }
    totals = per_key.agg(*(v.cast("bigint").alias(k) for k, (v, _) in values.items()))
    results = totals.select(
        F.inline(
            F.array(
                *(
                    F.struct(
                        F.lit(f"{rules.table}_{name}").alias("check_name"),
                        F.col(name).alias("value"),
                        F.lit(expectation).alias("expectation"),
                    )
                    for name, (_, expectation) in values.items()
                )
            )
        )
    )
    return with_outcome(results, rules.table, partition)


def check_raw_header(df: DataFrame, table: str, key: str, partition: str | None = None) -> DataFrame:
    """Raw table: has rows, and none of them is a header line read as data."""
    if partition is not None:
        df = df.where(F.col(INGEST_DT) == partition)
    is_header = F.upper(trimmed(key)) == RAW_HEADER_TEXT
    totals = df.agg(F.count("*").alias("rows"), F.count(F.when(is_header, 1)).alias("headers"))
    results = totals.select(
        F.expr(
            f"stack(2, '{table}_num_records', rows, '{GT_ZERO}', '{table}_bad_headers', headers, '{ZERO}')"
            " as (check_name, value, expectation)"
        )
    )
    return with_outcome(results, table, partition)


def with_outcome(results: DataFrame, table: str, partition: str | None) -> DataFrame:
    """Judge values: ``passed``, ``failed``, or ``error`` where there is no value."""
    holds = None
    for expectation, test in _HOLDS.items():
        is_this = F.col("expectation") == expectation
        holds = F.when(is_this, test(F.col("value"))) if holds is None else holds.when(is_this, test(F.col("value")))
    outcome = F.when(F.col("value").isNull() | holds.isNull(), "error").when(holds, "passed").otherwise("failed")
    return results.select(
        "check_name",
        F.lit(table).alias("table_name"),
        F.lit(partition).cast("string").alias("partition"),
        "value",
        "expectation",
        outcome.alias("outcome"),
    )


def expectation_of(check_name: str) -> str:
    """Expectation a check's name ends in."""
    for ending in (GT_ZERO, GE_ONE, ZERO):
        if check_name.lower().endswith(f"_{ending}"):
            return ending
    raise ValueError(f"check name must end in _zero, _gt_zero or _ge_one: {check_name}")


def judge(df: DataFrame, check_name: str, table: str, partition: str | None = None) -> DataFrame:
    """A one-number frame as a check named by its expectation; only its first column is judged."""
    value = df.select(F.col(f"`{df.columns[0]}`").cast("bigint").alias("value"))
    results = value.select(
        F.lit(check_name).alias("check_name"), "value", F.lit(expectation_of(check_name)).alias("expectation")
    )
    return with_outcome(results, table, partition)


def run_checks(
    tables: Mapping[str, DataFrame],
    partitions: Mapping[str, Sequence[str]] | None = None,
    rules: Sequence[TableChecks] = TABLE_CHECKS,
) -> DataFrame:
    """Results of every table's checks, for every loaded partition named."""
    parts = [
        check_table(tables[r.table], r, partition)
        for r in rules
        if r.table in tables
        for partition in (partitions or {}).get(r.table, [None])
    ]
    return reduce(DataFrame.unionByName, parts)


def enforce(results: DataFrame) -> dict[str, object]:
    """Raise on the first check (in rule order) that did not pass; else the run's counters.

    Collects one row per check.
    """
    rows = results.collect()
    for row in rows:
        if row["outcome"] != "passed":
            raise AssertionError(
                f"{row['check_name']} ({row['partition']}): expected {row['expectation']}, got {row['value']}"
            )
    return {"checks_passed": len(rows), "checks_failed": 0}


def run_summary(results: DataFrame, tables: Sequence[str], partitions_added: int) -> dict[str, object]:
    """Counters and names of a build, from its check results."""
    rows = results.collect()
    failed = [row["check_name"] for row in rows if row["outcome"] != "passed"]
    return {
        "partitions_added": partitions_added,
        "transformed_tables": len(tables),
        "transformed_table_names": list(tables),
        "checks_passed": len(rows) - len(failed),
        "checks_failed": len(failed),
        "failed_checks": failed,
    }
