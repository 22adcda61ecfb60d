"""Series operators against pandas, with one group holding most rows and pieces far smaller than it."""

from __future__ import annotations

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from siltstone.operators import series


@pytest.fixture(scope="module")
def data():
    rng = np.random.default_rng(7)
    n = 600
    frame = pd.DataFrame(
        {
            "g": np.where(rng.random(n) < 0.7, "hot", rng.choice(["b", "c", None], n)),
            "d": pd.Timestamp("2024-01-01") + pd.to_timedelta(rng.integers(0, 90, n), "D"),
            "id": rng.permutation(n),
            "v": np.round(rng.normal(size=n), 3),
        }
    )
    frame.loc[rng.random(n) < 0.1, "v"] = np.nan
    return frame.sort_values(["g", "d", "id"]).reset_index(drop=True)


@pytest.fixture(scope="module")
def df(spark, data):
    rows = [
        (r.g, r.d.date(), int(r.id), None if np.isnan(r.v) else float(r.v))
        for r in data.sample(frac=1, random_state=1).itertuples()
    ]
    return spark.createDataFrame(rows, "g string, d date, id int, v double").repartition(5)


def test_row_index(df, data):
    found = {r.id: r.row_index for r in series.with_row_index(df, ["g"], ["d", "id"]).collect()}
    expected = data.groupby("g", dropna=False).cumcount()
    assert found == dict(zip(data["id"], expected))


def test_row_index_without_groups(df, data):
    found = {r.id: r.row_index for r in series.with_row_index(df, [], ["id"]).collect()}
    assert found == {i: i for i in data["id"]}


@pytest.mark.parametrize("piece_rows", [1, 49, 60, 10_000])
def test_moving_averages(df, data, piece_rows):
    out = series.moving_averages(df, ["g"], ["d", "id"], "v", {"m1": 1, "m20": 20, "m50": 50}, piece_rows)
    found = out.toPandas().set_index("id").sort_index()
    kept = data.dropna(subset=["v"])
    assert len(found) == len(kept)
    for n in (1, 20, 50):
        rolled = kept.groupby("g", dropna=False)["v"].transform(lambda s, n=n: s.rolling(n).mean())
        expected = pd.Series(rolled.values, index=kept["id"]).sort_index()
        np.testing.assert_allclose(found[f"m{n}"], expected, atol=1e-9, equal_nan=True)


def test_last_rows(df, data):
    found = {r.id for r in series.last_rows(df, ["g"], ["d", "id"], 20).collect()}
    assert found == set(data.groupby("g", dropna=False).tail(20)["id"])


def test_fit_error_and_forecast(df, data):
    indexed = series.with_row_index(df.where("v is not null"), ["g"], ["d", "id"])
    fit = series.linear_fit(indexed, ["g"], "v")
    mae = {r.g: r.mae for r in series.fit_error(indexed, fit, ["g"], "v").collect()}
    ahead = series.forecast(indexed, ["g"], "d", "v", 7).toPandas()
    for g, rows in data.dropna(subset=["v"]).groupby("g", dropna=False):
        g = None if pd.isna(g) else g
        x = np.arange(len(rows))
        slope, intercept = np.polyfit(x, rows["v"], 1)
        assert mae[g] == pytest.approx(np.abs(rows["v"] - (slope * x + intercept)).mean())
        mine = ahead[ahead["g"].isna() if g is None else ahead["g"] == g].sort_values("forecast_date")
        np.testing.assert_allclose(mine["forecast"], slope * np.arange(len(rows), len(rows) + 7) + intercept)
        last = rows["d"].max()
        assert list(pd.to_datetime(mine["forecast_date"])) == list(pd.date_range(last + pd.Timedelta(days=1), periods=7))


def test_short_groups_have_no_fit(spark):
    rows = [("a", i, float(i)) for i in range(4)] + [("b", i, float(i)) for i in range(5)]
    indexed = spark.createDataFrame(rows, "g string, row_index int, v double")
    assert [tuple(r) for r in series.linear_fit(indexed, ["g"], "v").collect()] == [("b", 5, 1.0, 0.0)]


def test_latest_summary(df, data):
    latest = data.groupby("g", dropna=False).tail(1)
    row = series.latest_summary(df, ["g"], ["d", "id"], "d", "v").first()
    assert (row.group_cnt, pd.Timestamp(row.latest)) == (len(latest), latest["d"].max())
    assert (row.min_value, row.max_value) == (latest["v"].min(), latest["v"].max())


def test_many_last_rows_of_one_group(spark):
    """Beyond the rank limit no window over a group is planned; NULL orders go first, so they come last here."""
    n = 12_000
    rows = spark.range(n).select(
        F.when(F.col("id") % 3 > 0, "hot").otherwise(F.when(F.col("id") % 2 == 0, "cold")).alias("g"),
        F.when(F.col("id") % 11 > 0, F.col("id") % 500).alias("d"), "id",
    )
    found = series.last_rows(rows, ["g"], ["d", "id"], 5_000)
    wanted = []
    for g in ("hot", "cold", None):
        ids = [i for i in range(n) if ("hot" if i % 3 else "cold" if i % 2 == 0 else None) == g]
        wanted += sorted(ids, key=lambda i: (i % 500 if i % 11 else -1, i))[-5_000:]
    assert sorted(r.id for r in found.collect()) == sorted(wanted) and found.columns == rows.columns
    assert "row_number" not in found._jdf.queryExecution().executedPlan().toString()
    assert series.last_rows(rows.limit(0), ["g"], ["d"], 5_000).count() == 0
