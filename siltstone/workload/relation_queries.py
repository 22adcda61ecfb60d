"""Joins, aggregates, top-k, set operations and reshaping over the given tables."""

from __future__ import annotations

from datetime import date

from pyspark.sql import functions as F

from siltstone.functions import cleaning as c
from siltstone.functions.paths import date_in_path
from siltstone.operators import incremental, keys, series
from siltstone.plans.calendar import dim_date
from siltstone.plans.models import measure_codes
from siltstone.workload.inputs import ctes, derived, raw, spark_sql, table
from siltstone.workload.model_queries import CHANGES_SQL, FILES_PER_RUN, run_manifests
from siltstone.workload.registry import query

SHORT_CALENDAR = (date(1940, 1, 1), date(2000, 12, 31))
LINE = ("l_orderkey", "l_partkey", "l_linenumber")


def _shipped(spark, sf_dir):
    return table(spark, sf_dir, "lineitem").select(*LINE, F.col("l_shipdate").cast("date").alias("ship_date"))


_SHIPPED_SQL = """with l as (select l_orderkey, l_partkey, l_linenumber, cast(l_shipdate as date) d from lineitem)
select l_orderkey, l_partkey, l_linenumber, cast(d as varchar) ship_date, {0} date_id from l {1}"""
_ID = "cast(strftime(d, '%Y%m%d') as integer)"


@query("join_date_dim_inner", _SHIPPED_SQL.format(_ID, "where d <= date '2000-12-31'"))
def _date_inner(spark, sf_dir):
    return keys.attach_date_id(_shipped(spark, sf_dir), dim_date(spark, *SHORT_CALENDAR), "ship_date")


@query("join_date_dim_left", _SHIPPED_SQL.format(f"case when d <= date '2000-12-31' then {_ID} end", ""))
def _date_left(spark, sf_dir):
    return keys.attach_date_id(_shipped(spark, sf_dir), dim_date(spark, *SHORT_CALENDAR), "ship_date", "left")


@query(
    "join_enrich_left",
    """with r as (select distinct c_custkey k, n_regionkey region from customer join nation on c_nationkey = n_nationkey
    where c_custkey % 4 <> 0
  union select c_custkey, 9 from customer where c_custkey % 50 = 0)
select o_orderkey, o_custkey, region from orders left join r on o_custkey = k""",
)
def _enrich(spark, sf_dir):
    """Orders with their customer's region; every fiftieth customer has a second one."""
    lookup = spark_sql(
        spark,
        sf_dir,
        "select c_custkey o_custkey, n_regionkey region from {customer} join {nation} on c_nationkey = n_nationkey"
        " where c_custkey % 4 <> 0 union all select c_custkey, 9 from {customer} where c_custkey % 50 = 0"
        " union all select c_custkey, 9 from {customer} where c_custkey % 50 = 0",
    )
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey")
    return keys.enrich_left(orders, lookup, "o_custkey", ["region"])


@query(
    "join_latest_scalar",
    """with o as (select o_orderkey, strftime(o_orderdate, '%Y-%m') as month from orders)
select o_orderkey, month from o where month = (select max(month) from o)""",
)
def _latest(spark, sf_dir):
    orders = table(spark, sf_dir, "orders").select("o_orderkey", F.date_format("o_orderdate", "yyyy-MM").alias("month"))
    return keys.latest_partition(orders, "month")


@query(
    "unnest_sequence",
    """select o_orderkey, cast(n as integer) n, cast(cast(cast(o_orderdate as date) + cast(n as integer) as date) as varchar) as day
from orders, unnest(generate_series(0, o_orderkey % 4)) t(n)""",
)
def _unnest(spark, sf_dir):
    steps = F.sequence(F.lit(0), (F.col("o_orderkey") % 4).cast("int"))
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_orderdate", F.explode(steps).alias("n"))
    return orders.select("o_orderkey", "n", F.date_add(F.col("o_orderdate").cast("date"), F.col("n")).alias("day"))


_SUBQUERY = """select o_orderkey, datediff(cast(o_orderdate as date),
  (select min(cast(o_orderdate as date)) from {orders})) days_since_first from {orders}"""


@query(
    "scalar_subquery",
    """select o_orderkey, cast(date_diff('day', (select min(cast(o_orderdate as date)) from orders),
  cast(o_orderdate as date)) as integer) days_since_first from orders""",
)
def _subquery(spark, sf_dir):
    return spark_sql(spark, sf_dir, _SUBQUERY)


@query(
    "join_manifest_prior",
    f"{CHANGES_SQL} select filename, size_bytes, sha256, prior_sha256, prior_s3_key,"
    " object_exists prior_object_exists from joined",
)
def _manifest_prior(spark, sf_dir):
    return incremental.join_prior(derived(spark, sf_dir, "files_now"), derived(spark, sf_dir, "files_prior"))


@query(
    "semi_join_existing",
    f"""{ctes('files_prior')} select filename, s3_key,
  case when object_exists then 'live' else 'missing' end state from files_prior""",
)
def _semi_join(spark, sf_dir):
    files = derived(spark, sf_dir, "files_prior")
    stored = files.where("object_exists").select(F.col("s3_key").alias("path"))
    live = incremental.existing_only(files, stored).select("filename", "s3_key", F.lit("live").alias("state"))
    missing = incremental.missing_objects(files, stored)
    return live.unionByName(missing.select("filename", "s3_key", F.lit("missing").alias("state")))


_TABLES_SQL = """(select distinct lang || '_table' || v.suffix table_name, 'lake/raw/' || lang table_location,
  lang <> 'de' partitioned from documents, (values (''), ('_copy')) v(suffix))"""
PLAN_SQL = f"""{ctes('file_names')}
select distinct table_name, regexp_extract(s3_key, 'ingest_dt=([^/]*)/', 1) ingest_dt,
  'lake/' || regexp_replace(s3_key, '[^/]*$', '') as location
from file_names join {_TABLES_SQL} t
  on t.partitioned and s3_key like 'raw/%' and 'lake/' || split_part(s3_key, '/ingest_dt=', 1) = table_location"""


def planned_partitions(spark, sf_dir):
    """Two tables per language over the same folder; one language's tables are not partitioned.

    Every sixth file lies loose, without a landing date, and is for the operator to leave out.
    """
    files = derived(spark, sf_dir, "file_names").select("s3_key", date_in_path("s3_key").alias("ingest_dt"))
    lang = table(spark, sf_dir, "documents").select("lang").distinct()
    tables = lang.select(
        F.explode(F.array(F.lit(""), F.lit("_copy"))).alias("suffix"), "lang"
    ).select(
        F.concat("lang", F.lit("_table"), "suffix").alias("table_name"),
        F.concat(F.lit("lake/raw/"), "lang").alias("table_location"),
        (F.col("lang") != "de").alias("partitioned_by_ingest_dt"),
    )
    return incremental.partition_plan(files, tables, "lake")


@query("join_partition_location", PLAN_SQL)
def _partition_location(spark, sf_dir):
    return planned_partitions(spark, sf_dir).orderBy("table_name", "ingest_dt", "location")


# --- aggregates ---------------------------------------------------------------------------------


@query("distinct_by_group", "select distinct l_suppkey, l_returnflag from lineitem")
def _distinct(spark, sf_dir):
    return table(spark, sf_dir, "lineitem").select("l_suppkey", "l_returnflag").distinct()


@query(
    "max_by_length",
    f"""{ctes('claims_measures')},
r as (select measure_code, nullif(measure_description, '') d, row_number() over (partition by measure_code
  order by length(measure_description) desc, measure_description desc) r from claims_measures)
select measure_code, d measure_description from r where r = 1""",
)
def _max_by_length(spark, sf_dir):
    claims = derived(spark, sf_dir, "claims_measures").withColumn(
        "measure_description", c.blank_to_null("measure_description")
    )
    return keys.longest_text(claims, "measure_code", "measure_description")


@query("count_rows", "select count(*) row_cnt from orders where o_orderdate >= date '1998-01-01' and o_orderdate < date '1999-01-01'")
def _count_rows(spark, sf_dir):
    return c.keep_date_range(
        table(spark, sf_dir, "orders"), "o_orderdate", date(1998, 1, 1), date(1999, 1, 1)
    ).agg(F.count("*").alias("row_cnt"))


# Lines with gaps in their key: a third of them share one order, some have no part or flag.
_GAPS_SQL = """with g as (select case when l_partkey % 3 = 0 then 1 when l_partkey % 17 = 0 then null else l_orderkey end a,
  l_linenumber b, case when l_partkey % 11 = 0 then null when l_partkey % 13 = 0 then ' ' else l_returnflag end f
from lineitem)"""


def _gaps(spark, sf_dir):
    part, flag = F.col("l_partkey"), F.col("l_returnflag")
    return table(spark, sf_dir, "lineitem").select(
        F.when(part % 3 == 0, 1).when(part % 17 != 0, F.col("l_orderkey")).alias("a"),
        F.col("l_linenumber").alias("b"),
        F.when(part % 11 == 0, None).when(part % 13 == 0, " ").otherwise(flag).alias("f"),
    )


@query("dupes_single_key", f"{_GAPS_SQL} select count(*) - count(distinct a) dupes from g")
def _dupes_single(spark, sf_dir):
    return keys.duplicate_keys(_gaps(spark, sf_dir), "a")


@query("dupes_concat_key", f"{_GAPS_SQL} select count(*) - count(distinct a || '|' || b || '|' || f) dupes from g")
def _dupes_concat(spark, sf_dir):
    return keys.duplicate_joined_keys(_gaps(spark, sf_dir), ["a", "b", "f"])


@query("dupes_group_having", f"{_GAPS_SQL} select count(*) dupes from (select a, b, f from g group by a, b, f having count(*) > 1)")
def _dupes_groups(spark, sf_dir):
    return keys.repeated_key_groups(_gaps(spark, sf_dir), ["a", "b", "f"])


@query(
    "null_key_rows",
    f"{_GAPS_SQL} select count(*) filter (a is null or b is null or f is null or trim(f) = '') null_pk_rows from g",
)
def _null_rows(spark, sf_dir):
    return keys.null_key_rows(_gaps(spark, sf_dir), ["a", "b", "f"], blank=["f"])


@query(
    "null_key_cells",
    f"""{_GAPS_SQL} select cast(sum(case when a is null then 1 else 0 end) + sum(case when b is null then 1 else 0 end)
  + sum(case when f is null then 1 else 0 end) as bigint) null_pk_cells from g""",
)
def _null_cells(spark, sf_dir):
    return keys.null_key_cells(_gaps(spark, sf_dir), ["a", "b", "f"])


@query("max_partition", "select max(strftime(o_orderdate, '%Y-%m')) latest from orders")
def _max_partition(spark, sf_dir):
    months = table(spark, sf_dir, "orders").select(F.date_format("o_orderdate", "yyyy-MM").alias("month"))
    return months.distinct().agg(F.max("month").alias("latest"))


@query("mean_std", "select round(avg(value), 4) mean_value, round(stddev_samp(value), 4) std_dev from events")
def _mean_std(spark, sf_dir):
    return table(spark, sf_dir, "events").agg(
        F.round(F.avg("value"), 4).alias("mean_value"), F.round(F.stddev_samp("value"), 4).alias("std_dev")
    )


_SALES_SQL = """with s as (select o_orderkey, o_custkey, o_totalprice, o_orderpriority, c_mktsegment,
  cast(cast(o_orderdate as date) as varchar) order_day from orders join customer on o_custkey = c_custkey
where strftime(o_orderdate, '%Y') = '1997' and o_orderpriority in ('1-URGENT', '2-HIGH', '5-LOW'))"""


def _sales(spark, sf_dir):
    """Orders of a year and of chosen priorities, as the dashboard's filters leave them."""
    orders = table(spark, sf_dir, "orders").select(
        "o_orderkey", "o_custkey", "o_totalprice", "o_orderpriority",
        F.col("o_orderdate").cast("date").cast("string").alias("order_day"),
    )
    return c.keep_year_and_members(orders, "order_day", "1997", "o_orderpriority", ["1-URGENT", "2-HIGH", "5-LOW"])


@query(
    "kpi_totals",
    f"""{_SALES_SQL} select cast(trunc(sum(o_totalprice)) as bigint) total_sales,
  cast(trunc(sum(o_totalprice / 16)) as bigint) total_profit, count(distinct o_custkey) customers from s""",
)
def _kpi(spark, sf_dir):
    return _sales(spark, sf_dir).agg(
        F.sum("o_totalprice").cast("bigint").alias("total_sales"),
        F.sum(F.col("o_totalprice") / 16).cast("bigint").alias("total_profit"),
        F.count_distinct("o_custkey").alias("customers"),
    )


@query("trend_by_month", f"{_SALES_SQL} select order_day[1:7] as month, round(sum(o_totalprice), 2) sales from s group by 1")
def _trend(spark, sf_dir):
    month = c.prefix("order_day", 7).alias("month")
    return _sales(spark, sf_dir).groupBy(month).agg(F.round(F.sum("o_totalprice"), 2).alias("sales"))


@query(
    "array_sizes",
    f"""{CHANGES_SQL} select cast(cast(regexp_extract(filename, '_([0-9]+)[.]', 1) as bigint) // {FILES_PER_RUN} as varchar) source,
  cast(count(*) filter (status <> 'unchanged' and size_bytes <= 15000) as integer) uploaded,
  cast(count(*) filter (status = 'unchanged' and size_bytes <= 15000) as integer) skipped_unchanged,
  cast(count(*) filter (size_bytes > 15000) as integer) errors from changes group by 1""",
)
def _array_sizes(spark, sf_dir):
    return run_manifests(spark, sf_dir).select(
        "source",
        F.size("files").alias("uploaded"),
        F.size("skipped_unchanged").alias("skipped_unchanged"),
        F.size("errors").alias("errors"),
    )


# --- top-k, sorts and sets ------------------------------------------------------------------------


@query("sort_by_date", "select o_orderkey, cast(cast(o_orderdate as date) as varchar) order_day from orders")
def _sort(spark, sf_dir):
    day = F.col("o_orderdate").cast("date").alias("order_day")
    return table(spark, sf_dir, "orders").select("o_orderkey", day).orderBy("order_day", "o_orderkey")


@query(
    "topk_by_sum",
    "select o_custkey, round(sum(o_totalprice), 2) sales from orders group by 1 order by sales desc, o_custkey limit 5",
)
def _topk(spark, sf_dir):
    per = table(spark, sf_dir, "orders").groupBy("o_custkey").agg(F.round(F.sum("o_totalprice"), 2).alias("sales"))
    return per.orderBy(F.desc("sales"), "o_custkey").limit(5)


@query("distinct_sorted_values", "select distinct strftime(o_orderdate, '%Y') as year, o_orderpriority from orders")
def _distinct_sorted(spark, sf_dir):
    day = F.col("o_orderdate").cast("date").cast("string")
    pairs = table(spark, sf_dir, "orders").select(c.prefix(day, 4).alias("year"), "o_orderpriority")
    return pairs.distinct().orderBy("year", "o_orderpriority")


@query(
    "union_all_four",
    f"""{ctes('claims_measures', 'mds_measures', 'snf_measures', 'swing_bed')}
select measure_code, nullif(measure_description, '') measure_description from claims_measures
union all select measure_code, nullif(measure_description, '') from mds_measures
union all select replace(measure_code, '"', ''), null from snf_measures
union all select measure_code, null from swing_bed""",
)
def _union_four(spark, sf_dir):
    return measure_codes(
        *(raw(spark, sf_dir, n) for n in ("claims_measures", "mds_measures", "snf_measures", "swing_bed"))
    )


@query(
    "union_all_aligned",
    """select o_orderkey id, 'order' kind, o_totalprice price, cast(null as double) tax from orders
union all select l_orderkey, 'line', l_extendedprice, l_tax from lineitem""",
)
def _union_aligned(spark, sf_dir):
    lines = table(spark, sf_dir, "lineitem").select(
        F.col("l_orderkey").alias("id"), F.lit("line").alias("kind"), F.col("l_extendedprice").alias("price"),
        F.col("l_tax").alias("tax"),
    )
    orders = table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("id"), F.lit("order").alias("kind"), F.col("o_totalprice").alias("price")
    )
    return c.with_missing_columns(orders, lines.schema).unionByName(lines)


@query("drop_duplicates", "select distinct l_orderkey, l_linenumber from lineitem")
def _drop_duplicates(spark, sf_dir):
    lines = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber")
    return lines.dropDuplicates(["l_orderkey", "l_linenumber"])


@query(
    "wide_to_long",
    """select cast(cast(ts as date) as varchar) as day, event_type ticker, round(sum(value), 4) total, count(*) volume
from events group by 1, 2""",
)
def _wide_to_long(spark, sf_dir):
    """Daily figures with a column per event type and figure, back to a row per day and type."""
    events = table(spark, sf_dir, "events")
    types = sorted(row[0] for row in events.select("event_type").distinct().collect())  # as many as columns
    wide = (
        events
        .groupBy(F.col("ts").cast("date").alias("day"))
        .pivot("event_type", types)
        .agg(F.round(F.sum("value"), 4).alias("total"), F.count("value").alias("volume"))
    )
    wide = wide.select(
        "day", *(F.col(f"{t}_{m}").alias(f"{m}_{t}") for t in types for m in ("total", "volume"))
    )
    return series.bars_to_long(wide, "day", types, ("total", "volume"))


@query(
    "series_to_long",
    """select l_orderkey, l_partkey, l_linenumber, 'l_quantity' series, l_quantity as value from lineitem
union all select l_orderkey, l_partkey, l_linenumber, 'l_extendedprice', l_extendedprice from lineitem
union all select l_orderkey, l_partkey, l_linenumber, 'l_tax', l_tax from lineitem""",
)
def _series_to_long(spark, sf_dir):
    return series.to_long(table(spark, sf_dir, "lineitem"), LINE, ("l_quantity", "l_extendedprice", "l_tax"))
