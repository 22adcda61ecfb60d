"""Series operators over the events table: groups by type, ordered by time and id."""

from __future__ import annotations

from pyspark.sql import functions as F

from siltstone.operators import series
from siltstone.workload.inputs import table
from siltstone.workload.registry import query

GROUP, ORDER = ["event_type"], ["ts", "event_id"]
_INDEXED = """with i as (select event_id, event_type, ts, value,
  row_number() over (partition by event_type order by ts, event_id) - 1 n from events)"""
_SET = _INDEXED.replace("from events", "from events where value is not null")
_FIT = f"""{_SET},
fit as (select event_type, count(*) row_cnt, regr_slope(value, n) m, regr_intercept(value, n) b,
  max(cast(ts as date)) last_day from i group by 1 having count(*) >= 5)"""


def _events(spark, sf_dir):
    return table(spark, sf_dir, "events").select("event_id", "event_type", "ts", "value")


def _indexed(spark, sf_dir):
    return series.with_row_index(_events(spark, sf_dir), GROUP, ORDER)


def _set(spark, sf_dir):
    return series.set_positions(_events(spark, sf_dir), GROUP, ORDER, "value")


@query(
    "moving_average",
    """select event_id, event_type, value,
  case when count(value) over w20 = 20 then round(avg(value) over w20, 4) end ma_20,
  case when count(value) over w50 = 50 then round(avg(value) over w50, 4) end ma_50
from events window w20 as (partition by event_type order by ts, event_id rows between 19 preceding and current row),
  w50 as (partition by event_type order by ts, event_id rows between 49 preceding and current row)""",
)
def _moving(spark, sf_dir):
    means = series.moving_averages(_events(spark, sf_dir), GROUP, ORDER, "value", {"ma_20": 20, "ma_50": 50})
    return means.drop("ts").withColumns({n: F.round(n, 4) for n in ("ma_20", "ma_50")})


@query(
    "latest_row_per_group",
    """select event_type, event_id, value from (select *, row_number() over (
  partition by event_type order by ts desc, event_id desc) r from events) where r = 1""",
)
def _latest(spark, sf_dir):
    return series.last_rows(_events(spark, sf_dir), GROUP, ORDER).drop("ts")


@query("row_index", f"{_INDEXED} select event_id, event_type, cast(n as bigint) row_index from i")
def _row_index(spark, sf_dir):
    return _indexed(spark, sf_dir).select("event_id", "event_type", "row_index")


@query(
    "last_n_rows",
    """select event_type, event_id, value from (select *, row_number() over (
  partition by event_type order by ts desc, event_id desc) r from events) where r <= 20""",
)
def _last_n(spark, sf_dir):
    return series.last_rows(_events(spark, sf_dir), GROUP, ORDER, 20).drop("ts")


@query(
    "latest_min_max",
    """with l as (select * from (select *, row_number() over (partition by user_id order by ts desc, event_id desc) r
  from events) where r = 1)
select count(*) group_cnt, cast(cast(max(ts) as date) as varchar) latest, min(value) min_value, max(value) max_value from l""",
)
def _latest_min_max(spark, sf_dir):
    events = table(spark, sf_dir, "events").select("event_id", "user_id", "ts", "value")
    summary = series.latest_summary(events, ["user_id"], ORDER, "ts", "value")
    return summary.withColumn("latest", F.col("latest").cast("date"))


@query("linear_fit", f"{_FIT} select event_type, row_cnt, round(m, 8) slope, round(b, 4) intercept from fit")
def _fit(spark, sf_dir):
    fit = series.linear_fit(_set(spark, sf_dir), GROUP, "value")
    return fit.select("event_type", "row_cnt", F.round("slope", 8).alias("slope"), F.round("intercept", 4).alias("intercept"))


@query("fit_mae", f"{_FIT} select event_type, round(avg(abs(value - (m * n + b))), 4) mae from i join fit using (event_type) group by 1")
def _mae(spark, sf_dir):
    indexed = _set(spark, sf_dir)
    error = series.fit_error(indexed, series.linear_fit(indexed, GROUP, "value"), GROUP, "value")
    return error.withColumn("mae", F.round("mae", 4))


@query(
    "extend_with_forecast",
    f"""{_FIT} select event_type, cast(cast(last_day + cast(k as integer) as date) as varchar) forecast_date,
  round(m * (row_cnt - 1 + k) + b, 4) forecast from fit, unnest(generate_series(1, 14)) t(k)""",
)
def _forecast(spark, sf_dir):
    ahead = series.forecast(_set(spark, sf_dir), GROUP, "ts", "value", 14)
    return ahead.withColumn("forecast", F.round("forecast", 4))
