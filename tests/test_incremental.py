from __future__ import annotations

import pytest

from siltstone.operators import incremental as inc
from siltstone.sources.schemas import FILE_ENTRY

RUN = inc.Run("2024-02-01", "2024-02-01T00:00:00+00:00")
PRIOR = [
    ("same.csv", "same", "raw/same/ingest_dt=2024-01-01/same.csv", 1, "h1", None, "old", "old"),
    ("edited.csv", "edited", "raw/edited/ingest_dt=2024-01-01/edited.csv", 1, "h2", "2024-01-01", "old", "old"),
    ("lost.csv", "lost", "raw/lost/ingest_dt=2024-01-01/lost.csv", 1, "h3", "2024-01-01", "old", "old"),
    ("gone.csv", "gone", "raw/gone/ingest_dt=2024-01-01/gone.csv", 1, "h4", "2024-01-01", "old", "old"),
]


@pytest.fixture
def prior(spark):
    return spark.createDataFrame(PRIOR, FILE_ENTRY)


@pytest.fixture
def stored(spark):
    return spark.createDataFrame([(p[2],) for p in PRIOR if p[0] != "lost.csv"], "path string")


@pytest.fixture
def current(spark):
    rows = [("same.csv", 1, "h1"), ("edited.csv", 2, "h2b"), ("lost.csv", 1, "h3"), ("New File.csv", 5, "h5")]
    return spark.createDataFrame(rows, "filename string, size_bytes bigint, sha256 string")


def changes(current, prior, stored):
    return inc.detect_changes(current, inc.with_existence(prior, stored))


def test_status(current, prior, stored):
    assert {r.filename: r.status for r in changes(current, prior, stored).collect()} == {
        "same.csv": "unchanged", "edited.csv": "changed", "lost.csv": "heal", "New File.csv": "new",
    }


def test_next_state(current, prior, stored):
    state = {r.filename: r for r in inc.merge_state(prior, changes(current, prior, stored), RUN).collect()}
    assert {n: r.status for n, r in state.items()} == {
        "same.csv": "unchanged", "edited.csv": "changed", "lost.csv": "heal", "gone.csv": "carried", "New File.csv": "new",
    }
    assert (state["same.csv"].data_ingest_dt, state["same.csv"].last_seen_run_ingest_dt) == ("2024-01-01", "2024-02-01")
    assert state["same.csv"].s3_key == PRIOR[0][2]
    assert (state["edited.csv"].sha256, state["edited.csv"].size_bytes) == ("h2b", 2)
    assert state["New File.csv"].s3_key == "raw/new_file/ingest_dt=2024-02-01/New File.csv"
    assert tuple(state["gone.csv"])[:8] == ("gone.csv", *PRIOR[3][1:])


def test_same_name_twice_in_one_run(spark, prior, stored):
    twice = spark.createDataFrame(
        [("same.csv", 1, "h1"), ("same.csv", 9, "h9")], "filename string, size_bytes bigint, sha256 string"
    )
    assert [tuple(r) for r in inc.name_collisions(twice).collect()] == [("same.csv", 2)]
    state = inc.merge_state(prior, changes(twice, prior, stored), RUN).where("filename = 'same.csv'").collect()
    assert [(r.status, r.sha256) for r in state] == [("changed", "h9")]


def test_landed_entries(current, prior, stored):
    landed = inc.landed_entries(changes(current, prior, stored), RUN)
    assert landed.columns == FILE_ENTRY.names
    assert {r.filename for r in landed.collect()} == {"edited.csv", "lost.csv", "New File.csv"}


def test_prior_state_prefers_the_first_list(spark):
    rows = [
        ("files", 0, 1, "x/a.csv", "2"), ("files", 0, 0, "a.csv", "1"), ("all_files", 3, 0, "a.csv", "9"),
        ("skipped_unchanged", 1, 0, "b.csv", ""), ("all_files", 3, 1, "b.csv", "7"), ("files", 0, 2, None, "1"),
    ]
    entries = spark.createDataFrame(rows, "list_name string, list_rank int, list_position int, filename string, sha256 string")
    assert {tuple(r) for r in inc.prior_state(entries).collect()} == {("a.csv", "1"), ("b.csv", "7")}


def test_inventory(prior, stored):
    rows = {r.filename: r for r in inc.inventory(prior, stored, RUN).collect()}
    assert set(rows) == {"same.csv", "edited.csv", "gone.csv"}
    assert (rows["same.csv"].ingest_dt, rows["same.csv"].manifest_run_ingest_dt) == ("2024-01-01", "2024-02-01")
    assert inc.missing_objects(prior, stored).select("filename").first()[0] == "lost.csv"


def test_binding_dates(spark):
    rows = [("a", "2024-01-01"), ("a", "2024-01-08"), ("b", "2024-01-01"), (None, "2025-01-01"), ("c", None)]
    files = spark.createDataFrame(rows, "dataset_key string, ingest_dt string")
    assert inc.bind_dates(files, ["a", "b"]) == {"a": "2024-01-08", "b": "2024-01-01"}
    with pytest.raises(LookupError, match="c, d"):
        inc.bind_dates(files, ["a", "c", "d"])
    assert sorted(tuple(r) for r in inc.keep_latest(files, files).collect()) == [("a", "2024-01-08"), ("b", "2024-01-01")]


def test_partition_plan(spark):
    files = spark.createDataFrame(
        [("raw/a/ingest_dt=2024-01-01/1.csv", "2024-01-01"), ("raw/a/ingest_dt=2024-01-01/2.csv", "2024-01-01"),
         ("raw/b/ingest_dt=2024-01-01/1.csv", "2024-01-01"), ("raw/a/ingest_dt=2024-01-02/1.csv", None), ("", "2024-01-01")],
        "s3_key string, ingest_dt string",
    )
    listing = spark.createDataFrame(
        [("lake/raw/a/ingest_dt=2023-12-31/x.csv",), ("lake/raw/b/x.csv",)], "path string"
    )
    tables = inc.table_partitions(listing)
    assert {tuple(r) for r in tables.collect()} == {("a", True, "lake/raw/a/"), ("b", False, "lake/raw/b/")}
    plan = inc.partition_plan(files, tables, "lake")
    assert [tuple(r) for r in plan.collect()] == [("a", "2024-01-01", "lake/raw/a/ingest_dt=2024-01-01/")]
    bad = spark.createDataFrame([("raw/a/1.csv", "2024-01-01")], "s3_key string, ingest_dt string")
    with pytest.raises(Exception, match="no landing date in folder"):
        inc.partition_plan(bad, tables, "lake").collect()
