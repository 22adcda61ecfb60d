"""File state between runs: what is known, what changed, what the next state is.

State is a frame of one row per file name. It is only ever joined and aggregated by name, so it can
hold as many files as the lake does.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from siltstone.functions.paths import (
    dataset_key,
    date_in_path,
    file_name,
    partition_folder,
    required,
    table_folder,
)
from siltstone.functions.cleaning import blank_to_null
from siltstone.operators.keys import latest_value
from siltstone.session import written
from siltstone.sources.schemas import FILE_ENTRY, INGEST_DT, INVENTORY

STATE_COLUMNS = tuple(FILE_ENTRY.names)
#: Latest dates, one per dataset, that may become literals of a filter.
DATASETS_AS_LITERALS = 5_000


@dataclass(frozen=True)
class Run:
    """One ingest run."""

    ingest_dt: str
    run_ts_utc: str
    source: str = "files"
    bucket: str = ""
    raw_prefix: str = "raw"


def _set(column: str) -> Column:
    return F.coalesce(F.col(column) != "", F.lit(False))


def prior_state(entries: DataFrame) -> DataFrame:
    """One entry per file name out of the lists of a manifest.

    Entries need a name and a hash. The first list in the order of precedence wins, then the first
    place in it.
    """
    fields = [c for c in STATE_COLUMNS if c in entries.columns and c != "filename"]
    named = entries.where(_set("filename") & _set("sha256")).withColumn("filename", file_name("filename"))
    first = F.min_by(F.struct(*fields), F.struct("list_rank", "list_position"))
    return named.groupBy("filename").agg(first.alias("_e")).select("filename", "_e.*")


def with_existence(prior: DataFrame, stored: DataFrame, path: str = "s3_key") -> DataFrame:
    """Flag entries whose stored object is in the listing ``stored`` (column ``path``)."""
    listed = stored.select(F.col("path").alias("_stored")).distinct()
    return (
        prior.join(listed, prior[path] == listed["_stored"], "left")
        .withColumn("object_exists", F.col("_stored").isNotNull())
        .drop("_stored")
    )


def name_collisions(current: DataFrame) -> DataFrame:
    """File names that come from more than one path of this run."""
    return current.groupBy("filename").agg(F.count("*").alias("files")).where(F.col("files") > 1)


def join_prior(current: DataFrame, prior: DataFrame) -> DataFrame:
    """New files with the hash, path and object flag known for their name."""
    known = prior.select(
        "filename",
        F.col("sha256").alias("prior_sha256"),
        F.col("s3_key").alias("prior_s3_key"),
        F.col("object_exists").alias("prior_object_exists"),
    )
    return current.join(known, "filename", "left")


def change_status() -> Column:
    """Unchanged only if the hash is equal and the stored object is still there."""
    same = F.col("prior_sha256") == F.col("sha256")
    return (
        F.when(F.col("prior_sha256").isNull(), "new")
        .when(~same, "changed")
        .when(F.coalesce(F.col("prior_object_exists"), F.lit(False)), "unchanged")
        .otherwise("heal")
    )


def detect_changes(current: DataFrame, prior: DataFrame) -> DataFrame:
    """Each file of this run as ``new``, ``changed``, ``heal`` or ``unchanged``."""
    return join_prior(current, prior).withColumn("status", change_status())


def landed_path(run: Run) -> Column:
    name = F.col("filename")
    return F.concat(
        F.lit(f"{run.raw_prefix}/"), dataset_key(name), F.lit(f"/{INGEST_DT}={run.ingest_dt}/"), name
    )


def landed_entries(changes: DataFrame, run: Run) -> DataFrame:
    """State entries of the files this run stores."""
    return changes.where(F.col("status") != "unchanged").select(
        "filename",
        dataset_key("filename").alias("dataset_key"),
        landed_path(run).alias("s3_key"),
        "size_bytes",
        "sha256",
        F.lit(run.ingest_dt).alias("data_ingest_dt"),
        F.lit(run.ingest_dt).alias("last_seen_run_ingest_dt"),
        F.lit(run.run_ts_utc).alias("last_seen_run_ts_utc"),
    )


def merge_state(prior: DataFrame, changes: DataFrame, run: Run) -> DataFrame:
    """Next state: landed entries replace, unchanged ones are refreshed, files not seen are kept.

    A name that comes twice in one run counts once: a stored file goes before a skipped one, then the
    greater hash. An unchanged entry without a date gets the one in its path.
    """
    old = prior.select("filename", F.struct(*(_state_field(prior, c) for c in STATE_COLUMNS)).alias("old"))
    pick = F.struct((F.col("status") != "unchanged"), F.col("sha256"))
    seen = changes.groupBy("filename").agg(
        F.max_by(F.struct("status", "sha256", "size_bytes"), pick).alias("now")
    )
    merged = old.join(seen, "filename", "full")
    is_seen = F.col("now").isNotNull()
    is_landed = is_seen & (F.col("now.status") != "unchanged")
    old_date = blank_to_null("old.data_ingest_dt")
    values = {
        "dataset_key": F.when(is_landed, dataset_key("filename")).otherwise(F.col("old.dataset_key")),
        "s3_key": F.when(is_landed, landed_path(run)).otherwise(F.col("old.s3_key")),
        "size_bytes": F.when(is_seen, F.col("now.size_bytes")).otherwise(F.col("old.size_bytes")),
        "sha256": F.when(is_seen, F.col("now.sha256")).otherwise(F.col("old.sha256")),
        "data_ingest_dt": F.when(is_landed, F.lit(run.ingest_dt))
        .when(is_seen, F.coalesce(old_date, date_in_path("old.s3_key")))
        .otherwise(F.col("old.data_ingest_dt")),
        "last_seen_run_ingest_dt": F.when(is_seen, F.lit(run.ingest_dt)).otherwise(
            F.col("old.last_seen_run_ingest_dt")
        ),
        "last_seen_run_ts_utc": F.when(is_seen, F.lit(run.run_ts_utc)).otherwise(
            F.col("old.last_seen_run_ts_utc")
        ),
    }
    status = F.when(is_seen, F.col("now.status")).otherwise("carried").alias("status")
    return merged.select("filename", *(v.alias(k) for k, v in values.items()), status)


def _state_field(df: DataFrame, name: str) -> Column:
    if name in df.columns:
        return F.col(name)
    return F.lit(None).cast(FILE_ENTRY[name].dataType).alias(name)


def existing_only(files: DataFrame, stored: DataFrame, path: str = "s3_key") -> DataFrame:
    """Entries with a path whose object is in the listing."""
    listed = stored.select(F.col("path").alias("_stored"))
    rows = files.where(_set(path))
    return rows.join(listed, rows[path] == listed["_stored"], "left_semi")


def missing_objects(files: DataFrame, stored: DataFrame, path: str = "s3_key") -> DataFrame:
    """Entries the inventory leaves out: no path, or no stored object."""
    listed = stored.select(F.col("path").alias("_stored"))
    return files.join(listed, files[path] == listed["_stored"], "left_anti")


def inventory(state: DataFrame, stored: DataFrame, run: Run) -> DataFrame:
    """Flat file inventory: the file's own landing date, else the one in its path, and the run's columns."""
    live = existing_only(state, stored)
    own_date = F.coalesce(blank_to_null("data_ingest_dt"), date_in_path("s3_key"))
    return live.select(
        own_date.alias(INGEST_DT),
        F.lit(run.ingest_dt).alias("manifest_run_ingest_dt"),
        F.lit(run.run_ts_utc).alias("run_ts_utc"),
        F.lit(run.source).alias("source"),
        F.lit(run.bucket).alias("bucket"),
        F.lit(run.raw_prefix).alias("raw_prefix"),
        *INVENTORY.names[6:],
    )


def latest_dates(files: DataFrame) -> DataFrame:
    """Latest landing date per dataset."""
    return latest_value(files, "dataset_key", INGEST_DT)


def bind_dates(files: DataFrame, datasets: list[str]) -> dict[str, str]:
    """Latest date of each named dataset, for literal partition filters. A missing one is an error.

    Only the named datasets' rows, one each, come to the driver.
    """
    rows = latest_dates(files.where(F.col("dataset_key").isin(datasets))).collect()
    dates = {row["dataset_key"]: row[INGEST_DT] for row in rows}
    missing = sorted(set(datasets) - set(dates))
    if missing:
        raise LookupError(f"no landed date for datasets: {', '.join(missing)}")
    return dates


def keep_latest(rows: DataFrame, files: DataFrame, literals: int = DATASETS_AS_LITERALS) -> DataFrame:
    """Rows of each dataset's own latest date, for frames that hold many datasets.

    The (dataset, date) pairs, one per dataset, become literals, so that a table in folders is pruned before
    it is read. More than ``literals`` of them are written and joined instead.
    """
    latest = latest_dates(files).where(F.col("dataset_key").isNotNull() & F.col(INGEST_DT).isNotNull())
    pairs = latest.limit(literals + 1).collect()
    if len(pairs) > literals:
        return rows.join(written(latest, "latest-dates"), ["dataset_key", INGEST_DT], "left_semi")
    datasets: dict[str, list[str]] = {}
    for pair in pairs:
        datasets.setdefault(pair[INGEST_DT], []).append(pair["dataset_key"])
    wanted = [F.col("dataset_key").isin(sorted(keys)) & (F.col(INGEST_DT) == date) for date, keys in sorted(datasets.items())]
    return rows.where(reduce(lambda a, b: a | b, wanted, F.lit(False)))


def partition_plan(files: DataFrame, tables: DataFrame, root: str = "") -> DataFrame:
    """Which (table, date, folder) partitions the landed files call for.

    Folders are made distinct before the join, so it moves one row per folder, not per file. A path
    that is not ``…/<table>/ingest_dt=<date>/<file>`` is an error.
    """
    folder = required(partition_folder("s3_key", root), "unexpected object path", F.col("s3_key"))
    folders = files.where(_set("s3_key") & _set(INGEST_DT)).select(INGEST_DT, folder.alias("location")).distinct()
    base = required(table_folder("location"), "no landing date in folder", F.col("location"))
    wanted = tables.where(F.col("partitioned_by_ingest_dt")).select(
        "table_name", F.concat(F.regexp_replace("table_location", r"/+$", ""), F.lit("/")).alias("base")
    )
    return folders.withColumn("base", base).join(wanted, "base").select("table_name", INGEST_DT, "location").distinct()


def table_partitions(files: DataFrame) -> DataFrame:
    """Table folders seen in a file listing, with how they are partitioned."""
    folder = F.regexp_replace("path", r"[^/]*$", "")
    base = F.coalesce(table_folder(folder), folder)
    return (
        files.select(base.alias("table_location"), table_folder(folder).isNotNull().alias("partitioned_by_ingest_dt"))
        .distinct()
        .withColumn("table_name", F.element_at(F.split(F.regexp_replace("table_location", "/$", ""), "/"), -1))
        .select("table_name", "partitioned_by_ingest_dt", "table_location")
    )
