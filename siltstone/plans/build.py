"""Build run: bind every dataset to its latest date, build the curated tables, check and publish them."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession

from siltstone.operators.checks import enforce, run_checks
from siltstone.operators.incremental import bind_dates
from siltstone.plans import models
from siltstone.plans.calendar import dim_date
from siltstone.sinks.writers import replace_table
from siltstone.sources.readers import at_date
from siltstone.sources.schemas import INGEST_DT

Raw = Callable[[str], DataFrame]

DATASETS = (
    "provider", "swing_bed", "ownership", "claims_measures", "mds_measures", "snf_measures",
    "covid_provider", "covid_state", "survey_dates", "penalties", "fire_citations", "health_citations",
    "staffing", "survey_summary",
)
# Which datasets' dates a curated table carries; dimensions carry the run date.
TABLE_DATASETS = {
    "fact_ownership": ("ownership",),
    "fact_facility_covid": ("covid_provider",),
    "fact_state_covid_vax_avgs": ("covid_state",),
    "fact_survey_event": ("survey_dates",),
    "fact_penalties": ("penalties",),
    "fact_quality_measure_score": ("claims_measures", "mds_measures"),
    "fact_citations": ("fire_citations", "health_citations"),
    "fact_staffing_daily": ("staffing",),
    "fact_survey_cycle_summary": ("survey_summary",),
}
# Facts that look their date up in the calendar.
DATED_TABLES = (
    "fact_ownership", "fact_survey_event", "fact_penalties", "fact_citations", "fact_staffing_daily",
)
TABLES = ("dim_date", "dim_facility", "dim_measure", *TABLE_DATASETS)


def latest_raw(raw: Mapping[str, DataFrame], inventory: DataFrame, keys: Mapping[str, str] | None = None) -> tuple[dict[str, DataFrame], dict[str, str]]:
    """Each raw frame cut to its dataset's latest landing date, and those dates.

    ``keys`` maps our dataset names to the dataset keys of the inventory where they differ.
    """
    keys = {name: (keys or {}).get(name, name) for name in raw}
    dates = bind_dates(inventory, sorted(keys.values()))
    bound = {name: dates[key] for name, key in keys.items()}
    return {name: at_date(df, bound[name]) for name, df in raw.items()}, bound


def curated_table(spark: SparkSession, name: str, raw: Raw, run_date: str) -> DataFrame:
    """One dimension or fact; ``raw`` gives a dataset's frame bound to one date."""
    if name == "dim_date":
        return dim_date(spark)
    if name == "dim_facility":
        return models.dim_facility(raw("provider"), raw("swing_bed"), run_date)
    if name == "dim_measure":
        sources = ("claims_measures", "mds_measures", "snf_measures", "swing_bed")
        return models.dim_measure(*map(raw, sources), run_date)
    frames = [raw(dataset) for dataset in TABLE_DATASETS[name]]
    if name in DATED_TABLES:
        frames.append(dim_date(spark))
    return getattr(models, name)(*frames)


def check_partitions(dates: Mapping[str, str], run_date: str) -> dict[str, list[str]]:
    """Every partition a build loads, per table."""
    loaded = {table: sorted({dates[d] for d in datasets}) for table, datasets in TABLE_DATASETS.items()}
    return {**loaded, "dim_facility": [run_date], "dim_measure": [run_date]}


def build(spark: SparkSession, raw: Mapping[str, DataFrame], inventory: DataFrame, root: str, run_date: str, raw_roots: Sequence[str] = ()) -> DataFrame:
    """Replace every curated table below ``root``, then check them; raises on the first failed check.

    A table that would overlap one of ``raw_roots``, where the raw data lie, is refused.
    """
    bound, dates = latest_raw(raw, inventory)
    for name in TABLES:
        df = curated_table(spark, name, bound.__getitem__, run_date)
        replace_table(df, f"{root}/{name}", partition=None if name == "dim_date" else INGEST_DT, sources=raw_roots)
    stored = {name: spark.read.parquet(f"{root}/{name}") for name in check_partitions(dates, run_date)}
    results = run_checks(stored, check_partitions(dates, run_date))
    enforce(results)
    return results
