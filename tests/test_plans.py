"""Ingest and build runs over files, and sinks."""

from __future__ import annotations

import shutil

import pytest
from pyspark.sql import functions as F

from siltstone.operators.incremental import Run
from siltstone.plans.build import DATASETS, build, check_partitions
from siltstone.plans.ingest import ingest_folder, run_ledger
from siltstone.sinks import writers
from siltstone.sources import readers
from siltstone.sources.schemas import RAW_COLUMNS
from siltstone.workload.inputs import derived

SF_DIR = "/root/testdata/sf0.001"


def test_ingest_runs(spark, tmp_path):
    source, lake = tmp_path / "in", tmp_path / "lake"
    source.mkdir()
    for name, text in {"Survey Dates.csv": "h\n1\n", "b.json": "{}", "note.txt": "no"}.items():
        (source / name).write_text(text)

    def run(day):
        return ingest_folder(spark, f"file://{source}", str(lake), Run(day, f"{day}T00:00:00+00:00"))

    first = run("2024-01-01")
    assert (first["status"], first["uploaded"], first["skipped_unchanged"], first["errors"]) == ("ok", 2, 0, 0)
    landed = lake / "raw/survey_dates/ingest_dt=2024-01-01/Survey Dates.csv"
    assert landed.read_text() == "h\n1\n"

    (source / "b.json").write_text('{"x":1}')
    (source / "c.csv").write_text("new")
    second = run("2024-01-08")
    assert (second["uploaded"], second["skipped_unchanged"]) == (2, 1)

    landed.unlink()
    (source / "c.csv").unlink()
    third = run("2024-01-15")
    assert (third["uploaded"], third["skipped_unchanged"]) == (1, 1)
    inventory = readers.read_inventory(spark, f"{lake}/control/inventory")
    assert {(r.filename, r.ingest_dt, r.last_seen_run_ingest_dt) for r in inventory.collect()} == {
        ("Survey Dates.csv", "2024-01-15", "2024-01-15"),
        ("b.json", "2024-01-08", "2024-01-15"),
        ("c.csv", "2024-01-08", "2024-01-08"),
    }
    assert len(list((lake / "control/state/archive").iterdir())) == 3


def test_failed_copy_is_an_error_not_a_state(spark, tmp_path):
    source, lake = tmp_path / "in", tmp_path / "lake"
    source.mkdir()
    (source / "a.csv").write_text("1")
    (source / "b.csv").write_text("2")
    (lake / "raw/a").mkdir(parents=True)
    (lake / "raw/a/ingest_dt=2024-01-01").write_text("a file where a folder must be")
    result = ingest_folder(spark, f"file://{source}", str(lake), Run("2024-01-01", "2024-01-01T00:00:00"))
    assert (result["status"], result["uploaded"], result["errors"]) == ("partial_failure", 1, 1)
    assert (lake / "quarantine/a/ingest_dt=2024-01-01/a.csv").read_text() == "1"
    assert [r.filename for r in readers.read_inventory(spark, f"{lake}/control/inventory").collect()] == ["b.csv"]
    runs = spark.read.json(f"{lake}/control/runs")
    assert {(r.filename, r.list_name) for r in runs.collect()} == {("a.csv", "errors"), ("b.csv", "files")}


def test_a_finished_run_is_not_done_again(spark, tmp_path):
    source, lake = tmp_path / "in", tmp_path / "lake"
    source.mkdir()
    (source / "a.csv").write_text("1")
    (source / "empty.json").write_text("")
    run = Run("2024-01-01", "2024-01-01T00:00:00+00:00")
    first = ingest_folder(spark, str(source), str(lake), run)
    (source / "b.csv").write_text("2")
    assert ingest_folder(spark, str(source), str(lake), run) == first
    assert first["uploaded"] == 2 and (lake / "raw/empty/ingest_dt=2024-01-01/empty.json").read_bytes() == b""
    (ledger,) = run_ledger(spark, str(lake)).collect()
    assert (ledger.status, ledger.counts_uploaded, str(ledger.ingest_dt)) == ("ok", 2, "2024-01-01")
    # A run that broke off before its ledger row is done again, over what it left.
    second = Run("2024-01-02", "2024-01-02T00:00:00+00:00")
    ingest_folder(spark, str(source), str(lake), second)
    shutil.rmtree(lake / "control/ledger/ingest_dt=2024-01-02")
    again = ingest_folder(spark, str(source), str(lake), second)
    assert (again["uploaded"], again["skipped_unchanged"]) == (0, 3)
    assert run_ledger(spark, str(lake)).count() == 2


def test_files_of_one_name_are_errors_unless_they_are_equal(spark, tmp_path):
    source, lake = tmp_path / "in", tmp_path / "lake"
    for folder, name, text in (("x", "a.csv", "1"), ("y", "a.csv", "2"), ("x", "b.csv", "3"), ("y", "b.csv", "3")):
        (source / folder).mkdir(parents=True, exist_ok=True)
        (source / folder / name).write_text(text)
    found = ingest_folder(spark, str(source), str(lake), Run("2024-01-01", "t"))
    assert (found["uploaded"], found["errors"], found["quarantined"]) == (1, 2, 2)
    assert {p.read_text() for p in (lake / "quarantine").rglob("a.csv")} == {"1", "2"}
    assert not (lake / "raw/a").exists() and (lake / "raw/b/ingest_dt=2024-01-01/b.csv").read_text() == "3"


def test_a_failed_quarantine_is_recorded(spark, tmp_path):
    source, lake = tmp_path / "in", tmp_path / "lake"
    source.mkdir()
    (source / "a.csv").write_text("1")
    for folder in ("raw", "quarantine"):
        (lake / folder).mkdir(parents=True)
        (lake / folder / "a").write_text("a file where a folder must be")
    found = ingest_folder(spark, str(source), str(lake), Run("2024-01-01", "t"))
    assert (found["errors"], found["quarantined"]) == (1, 0)
    (row,) = spark.read.json(f"{lake}/control/runs").collect()
    assert row.list_name == "errors" and row.error and row.quarantine_error


@pytest.fixture
def raw_lake(spark, tmp_path):
    """All raw datasets as CSV with two landing dates, the older one empty of use."""
    for dataset in DATASETS:
        df = derived(spark, SF_DIR, dataset)
        full = df.select(*(F.col(f"`{c}`") if c in df.columns else F.lit(None).cast("string").alias(c) for c in RAW_COLUMNS[dataset]))
        for day, part in (("2024-01-01", full.limit(3)), ("2024-01-08", full)):
            part.coalesce(1).write.option("header", True).option("escape", "\\").csv(f"{tmp_path}/raw/{dataset}/ingest_dt={day}")
    return tmp_path


def test_build_binds_the_latest_date_and_checks(spark, raw_lake):
    raw = {}
    for dataset in DATASETS:
        path = f"{raw_lake}/raw/{dataset}"
        raw[dataset] = readers.read_headed_csv(spark, path) if dataset == "penalties" else readers.read_fixed_csv(spark, path, dataset)
    rows = [(d, day) for d in DATASETS for day in ("2024-01-01", "2024-01-08")]
    inventory = spark.createDataFrame(rows, "dataset_key string, ingest_dt string")
    with pytest.raises(AssertionError, match="nulldates"):
        build(spark, raw, inventory, f"{raw_lake}/curated", "2024-02-01")
    facts = spark.read.parquet(f"{raw_lake}/curated/fact_survey_event")
    assert {str(r[0]) for r in facts.select("ingest_dt").distinct().collect()} == {"2024-01-08"}
    assert facts.count() == derived(spark, SF_DIR, "survey_dates").where("survey_date <> ''").count()
    assert spark.read.parquet(f"{raw_lake}/curated/dim_date").count() == 31777


def test_partitions_to_check():
    dates = {d: "2024-01-01" for d in DATASETS} | {"mds_measures": "2024-01-08"}
    assert check_partitions(dates, "2024-02-01")["fact_quality_measure_score"] == ["2024-01-01", "2024-01-08"]
    assert check_partitions(dates, "2024-02-01")["dim_measure"] == ["2024-02-01"]


def test_replacing_never_touches_sources(spark, tmp_path):
    df = spark.range(3).withColumn("ingest_dt", F.lit("d"))
    for target in ("/lake/raw", "/lake", "/lake/raw/x"):
        with pytest.raises(ValueError, match="overlaps"):
            writers.replace_table(df, target, sources=["/lake/raw"])
    writers.guard_target("/lake/raw2", ["/lake/raw"])
    writers.replace_table(df, f"{tmp_path}/t", clear=False)
    with pytest.raises(Exception, match="PATH_ALREADY_EXISTS"):
        writers.replace_table(df, f"{tmp_path}/t", clear=False)


def test_appended_ids_go_on(spark, tmp_path):
    for values in ([5.5, 7.2], [], [1.0]):
        writers.append_rows(spark.createDataFrame([(v,) for v in values], "value double"), f"{tmp_path}/t", ["value"])
    stored = spark.read.parquet(f"{tmp_path}/t")
    assert sorted((r.id, r.value) for r in stored.collect()) == [(1, 5.5), (2, 7.2), (3, 1.0)]


def test_latest_manifest_may_hold_what_was_read_from_it(spark, tmp_path):
    first = spark.createDataFrame([("a", "1")], "filename string, sha256 string")
    _, latest = writers.write_manifest(first, str(tmp_path), ingest_dt="d1", run_id="1")
    again = spark.read.schema(first.schema).json(latest).withColumn("sha256", F.lit("2"))
    archive, latest = writers.write_manifest(again, str(tmp_path), ingest_dt="d1", run_id="2")
    assert [tuple(r) for r in spark.read.schema(first.schema).json(latest).collect()] == [("a", "2")]
    with pytest.raises(Exception, match="PATH_ALREADY_EXISTS"):
        writers.write_manifest(first, str(tmp_path), ingest_dt="d1", run_id="2")


def test_one_large_output_folder_is_written_by_several_tasks(spark, tmp_path):
    old = spark.conf.get("spark.sql.adaptive.advisoryPartitionSizeInBytes")
    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "64k")
    try:
        rows = spark.range(0, 60_000, 1, 8).select(
            "id", F.sha2(F.col("id").cast("string"), 256).alias("text"),
            F.when(F.col("id") % 10 < 8, "hot").otherwise(F.concat(F.lit("k"), F.col("id") % 10)).alias("dataset_key"),
            F.lit("2024-01-01").alias("ingest_dt"),
        )
        writers.land_raw(rows, f"{tmp_path}/raw")
    finally:
        spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", old)
    hot = list((tmp_path / "raw/dataset_key=hot/ingest_dt=2024-01-01").glob("*.parquet"))
    assert len(hot) > 4
    assert spark.read.parquet(f"{tmp_path}/raw").count() == 60_000


def test_published_tables(spark, tmp_path):
    df = spark.createDataFrame([(1, "2024-01-01"), (2, "2024-01-08")], "id int, ingest_dt string")
    writers.replace_table(df, f"{tmp_path}/facts")
    writers.replace_table(df.select("id"), f"{tmp_path}/days", partition=None)
    for _ in range(2):
        writers.publish_tables(spark, "curated_test", str(tmp_path), ["facts", "days"])
    assert spark.table("curated_test.facts").where("ingest_dt = '2024-01-08'").select("id").collect() == [(2,)]
    assert spark.table("curated_test.days").count() == 2
