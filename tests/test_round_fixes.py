"""Cases that once lost data or gave wrong answers: odd file names, missing values, uneven series, shared folders."""

from __future__ import annotations

import datetime as dt
from types import SimpleNamespace

import pytest

from siltstone import session
from siltstone.operators import keys, series
from siltstone.operators.incremental import Run
from siltstone.plans.ingest import ingest_folder
from siltstone.sinks.writers import guard_target
from siltstone.sources.readers import read_by_extension, series_rows

NAMES = ("a#1.csv", "a#2.csv", "b%20c.csv", "d+e f.csv", "wie?ß.csv")


def test_ingest_keeps_odd_names(spark, tmp_path):
    source, lake = tmp_path / "in", tmp_path / "lake"
    source.mkdir()
    for i, name in enumerate(NAMES):
        (source / name).write_text(f"x\n{i}\n")
    found = ingest_folder(spark, str(source), str(lake), Run("2024-02-01", "2024-02-01T05:00:00+00:00"))
    assert (found["uploaded"], found["errors"]) == (len(NAMES), 0)
    landed = {p.name: p.read_text() for p in (lake / "raw").rglob("*") if p.suffix == ".csv" and p.is_file()}
    assert landed == {name: f"x\n{i}\n" for i, name in enumerate(NAMES)}
    assert spark.read.json(f"{lake}/control/inventory").count() == len(NAMES)
    again = ingest_folder(spark, str(source), str(lake), Run("2024-02-02", "2024-02-02T05:00:00+00:00"))
    assert (again["uploaded"], again["skipped_unchanged"]) == (0, len(NAMES))


def test_fit_and_forecast_leave_out_missing_values(spark):
    values = [0.0, 1.0, None, 2.0, 3.0, 4.0, 5.0, None]
    rows = [("g", dt.date(2024, 1, i + 1), v) for i, v in enumerate(values)]
    df = spark.createDataFrame(rows, "g string, d date, v double")
    placed = series.set_positions(df, ["g"], ["d"], "v")
    (fit,) = series.linear_fit(placed, ["g"], "v").collect()
    assert (fit.row_cnt, round(fit.slope, 9), round(fit.intercept, 9)) == (6, 1.0, 0.0)
    ahead = sorted(tuple(r) for r in series.forecast(placed, ["g"], "d", "v", 2).collect())
    assert [(g, d, round(v, 9)) for g, d, v in ahead] == [
        ("g", dt.date(2024, 1, 8), 6.0),
        ("g", dt.date(2024, 1, 9), 7.0),
    ]


def test_forecast_stays_on_the_line_of_gapped_positions(spark):
    rows = [("g", dt.date(2024, 1, i + 1), None if i == 3 else float(i), i) for i in range(8)]
    df = spark.createDataFrame(rows, "g string, d date, v double, row_index long")
    (ahead,) = series.forecast(df, ["g"], "d", "v", 1).collect()
    assert round(ahead.forecast, 9) == 8.0


def test_series_keep_the_keys_of_all(spark):
    doc = '{"cases": {"d1": 1}, "deaths": {"d1": 2, "d2": 3}}'
    df = spark.createDataFrame([(1, doc), (2, '{"deaths": {"d9": 4}}'), (3, None)], "id int, doc string")
    found = series_rows(df, "doc", ["cases", "deaths"]).select("id", "date", "cases", "deaths").collect()
    assert sorted(map(tuple, found)) == [(1, "d1", 1, 2), (1, "d2", None, 3), (2, "d9", None, 4)]


def test_unknown_endings_are_refused(spark, tmp_path):
    (tmp_path / "a.csv").write_text("x\n1\n")
    (tmp_path / "b.xml").write_text("<x/>")
    with pytest.raises(ValueError, match="xml"):
        read_by_extension(spark, str(tmp_path))


def test_latest_partition_reads_one_folder(spark, tmp_path):
    path = str(tmp_path / "t")
    spark.createDataFrame([(1, "a"), (2, "b")], "x int, p string").write.partitionBy("p").parquet(path)
    latest = keys.latest_partition(spark.read.parquet(path), "p")
    assert [tuple(r) for r in latest.collect()] == [(2, "b")]
    plan = latest._jdf.queryExecution().executedPlan().toString()
    filters = next(line for line in plan.splitlines() if "PartitionFilters" in line)
    assert "ubquery" in filters.split("PartitionFilters", 1)[1]


def test_a_cluster_needs_a_shared_folder():
    context = SimpleNamespace(getCheckpointDir=lambda: None, master="spark://host:7077")
    cluster = SimpleNamespace(sparkContext=context, conf=SimpleNamespace(get=lambda key, default: default))
    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        session.shared_folder(cluster)


def test_a_target_over_its_source_is_refused():
    with pytest.raises(ValueError):
        guard_target("s3a://lake/raw/curated", ["s3a://lake/raw"])


@pytest.mark.parametrize(
    "target, source, refused",
    [
        ("s3a://lake/raw/../raw/x", "s3a://lake/raw", True),
        ("s3a://lake//raw/./x/", "s3://lake/raw", True),
        ("/lake/curated/../raw", "file:///lake/raw", True),
        ("file:/lake", "/lake/raw", True),
        ("/", "/lake/raw", True),
        ("s3a://lake/raw#2/x", "s3a://lake/raw", False),
        ("s3a://lake/raw2", "s3a://lake/raw", False),
        ("s3a://other/raw", "s3a://lake/raw", False),
    ],
)
def test_targets_are_guarded_however_they_are_spelled(target, source, refused):
    if refused:
        with pytest.raises(ValueError, match="overlaps"):
            guard_target(target, [source])
    else:
        guard_target(target, [source])
