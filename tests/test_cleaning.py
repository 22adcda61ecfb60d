from __future__ import annotations

from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

from siltstone.functions import cleaning as c
from siltstone.functions import paths


def apply(spark, expression, values, dtype="string"):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, x {dtype}")
    return [r[0] for r in df.orderBy("i").select(expression(F.col("x"))).collect()]


@pytest.mark.parametrize(
    "value, expected",
    [
        ("15009", "015009"), ('"15009"', "015009"), ('  "15 009" ', "15 009"), ("1234567", "123456"),
        ("", "000000"), ('"', "000000"), (None, None), ("\t75\n", "000075"), ("01A193", "01A193"),
    ],
)
def test_key(spark, value, expected):
    assert apply(spark, c.padded_key, [value]) == [expected]


def test_zip(spark):
    assert apply(spark, c.zip_code, ["501", "99501-1234", None]) == ["00501", "99501", None]


def test_numbers(spark):
    texts = ["12", " 12 ", "1.5", "", "x", None, '"3"']
    assert apply(spark, lambda x: c.to_number(x, "int"), texts) == [12, 12, None, None, None, None, None]
    assert apply(spark, lambda x: c.unquoted_number(x, "int"), ['"3"', ' "4" ']) == [3, 4]
    assert apply(spark, lambda x: c.to_number(x, "double"), ["1e3", "-2", "12%"]) == [1000.0, -2.0, None]


DATES = {
    "2024-02-29": (date(2024, 2, 29), None, None),
    "2023-02-29": (None, None, None),
    "2024-2-9": (date(2024, 2, 9), None, None),
    "2/9/2024": (None, date(2024, 2, 9), None),
    "02/30/2024": (None, None, None),
    "20240209": (None, None, date(2024, 2, 9)),
    "20241309": (None, None, None),
    "2024-02-09 10:00": (None, None, None),
    "2024": (None, None, None),
    "2024-02": (None, None, None),
    "x2024-02-09": (None, None, None),
    "2/9/24": (None, None, None),
    "": (None, None, None),
}


@pytest.mark.parametrize("place, pattern", [(0, c.ISO_DATE), (1, c.US_DATE), (2, c.COMPACT_DATE)])
def test_dates(spark, place, pattern):
    assert apply(spark, lambda x: c.parse_date(x, pattern), list(DATES)) == [v[place] for v in DATES.values()]


def test_dates_agree_with_the_pattern_parser(spark):
    texts = [f"{y}{a}{m}{a}{d}" for y in ("2024", "1999") for m in ("1", "02", "13") for d in ("5", "29", "31") for a in "-/"]
    fast = apply(spark, lambda x: c.parse_date(x, c.ISO_DATE), texts)
    assert fast == apply(spark, lambda x: F.try_to_date(x, c.ISO_DATE), texts)


def test_either_date(spark):
    both = lambda x: c.parse_date(x, c.US_DATE, c.ISO_DATE)
    assert apply(spark, both, ["2/9/2024", "2024-02-09", "soon"]) == [date(2024, 2, 9)] * 2 + [None]
    other = lambda x: c.parse_date(x, "dd.MM.yyyy", c.ISO_DATE)
    assert apply(spark, other, ["09.02.2024", "2024-02-09"]) == [date(2024, 2, 9)] * 2


def test_date_in_text(spark):
    texts = ["since 1/2/2003, then 4/5/2006", "NO DATE PROVIDED", "since 2/30/2024", None]
    assert apply(spark, c.date_in_text, texts) == [date(2003, 1, 2), None, None, None]
    assert apply(spark, c.us_date_text, texts) == ["1/2/2003", None, "2/30/2024", None]


def test_period(spark):
    texts = [" 20230101-20231231 ", "20230101-20239999", "2023Q1-2023Q4", None]
    start, end = [apply(spark, lambda x, i=i: c.period_bounds(x)[i], texts) for i in (0, 1)]
    assert start == [date(2023, 1, 1), date(2023, 1, 1), None, None]
    assert end == [date(2023, 12, 31), None, None, None]


def test_flags(spark):
    texts = ["y", " YES ", "True", "t", "1", "N", "no", "FALSE", "f", "0", "maybe", "", None]
    assert apply(spark, c.flag, texts) == [True] * 5 + [False] * 5 + [None] * 3


def test_compact_filter(spark):
    assert apply(spark, c.is_compact_date, ["20240101", " 20240101 ", "2024-1-1", "202401011", None]) == [
        True, True, False, False, None,
    ]


def test_ratio_and_band(spark):
    df = spark.createDataFrame([(1.0, 2.0), (1.0, 0.0), (1.0, None), (None, 2.0)], "a double, b double")
    assert [r[0] for r in df.select(c.guarded_ratio("a", "b")).collect()] == [0.5, None, None, None]
    assert [r[0] for r in df.select(c.product_or_zero("a", "b")).collect()] == [2.0, 0.0, 0.0, 0.0]
    bands = apply(spark, c.body_mass_band, [18.4, 18.5, 24.9, 25.0, 30.0, None], "double")
    assert bands == ["Underweight", "Normal weight", "Normal weight", "Overweight", "Obese", None]
    assert apply(spark, lambda x: F.round(c.body_mass(x, F.lit(70)), 2), [170.0], "double") == [24.22]


def test_wall_time_drops_the_offset(spark):
    assert apply(spark, c.iso_wall_time, ["2026-03-15T05:34:29.935139+02:00"]) == [
        datetime(2026, 3, 15, 5, 34, 29, 935139)
    ]


def test_status_and_counts(spark):
    assert apply(spark, c.run_status, [0, 2], "int") == ["ok", "partial_failure"]
    counts = apply(spark, lambda x: c.counts_struct(uploaded=x, errors=x * 2), [3], "int")[0]
    assert counts.asDict() == {"uploaded": 3, "errors": 6, "total_files_seen": 9}


def test_reverse_only_where_present(spark):
    df = spark.createDataFrame([("abc",)], "FirstName string")
    assert c.with_reversed_text(df, "FirstName").first()[0] == "cba"
    assert c.with_reversed_text(df, "other").first()[0] == "abc"


def test_required(spark):
    df = spark.createDataFrame([("a", " "), ("a", None), (None, "b"), ("a", "b")], "x string, y string")
    assert c.keep_required(df, ["x", "y"], not_blank=["y"]).collect() == [("a", "b")]


@pytest.mark.parametrize(
    "name, key",
    [
        ("NH Ownership  Oct2024.csv", "nh_ownership_oct2024"), ("a.json.csv", "a"), ("a.csv.json", "a.csv"),
        ("A___B.CSV", "a__b"), ("plain", "plain"),
    ],
)
def test_dataset_key(spark, name, key):
    assert apply(spark, paths.dataset_key, [name]) == [key]


def test_paths(spark):
    keys = ["raw/a/ingest_dt=2024-01-02/f.csv", "a/f.csv", None]
    assert apply(spark, paths.date_in_path, keys) == ["2024-01-02", None, None]
    folders = apply(spark, lambda x: paths.partition_folder(x, "lake/"), keys)
    assert folders == ["lake/raw/a/ingest_dt=2024-01-02/", None, None]
    assert apply(spark, paths.table_folder, [folders[0], "lake/raw/a/"]) == ["lake/raw/a/", None]
    with pytest.raises(Exception, match="unexpected path: a/f.csv"):
        apply(spark, lambda x: paths.required(paths.partition_folder(x), "unexpected path", x), keys[1:2])
