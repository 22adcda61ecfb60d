"""Incremental state and data checks."""

from __future__ import annotations

from pyspark.sql import functions as F

from siltstone.functions.paths import date_in_path
from siltstone.operators import incremental
from siltstone.operators.checks import TABLE_CHECKS, check_raw_header, check_table, run_checks
from siltstone.plans.build import curated_table
from siltstone.workload import model_queries as m
from siltstone.workload.inputs import LANDED, RUN_DATE, ctes, derived, raw, shared_raw, spark_sql
from siltstone.workload.relation_queries import PLAN_SQL, planned_partitions
from siltstone.workload.registry import query
from siltstone.workload.stage_queries import INVENTORY_SQL, STATE_SQL, next_inventory, next_state

# --- file state -----------------------------------------------------------------------------------


@query(
    "prior_state",
    f"""{ctes('files_now', 'files_prior')},
entries as (
  select 'in/' || filename filename, case when size_bytes % 3 = 0 then '' else sha256 end sha256, s3_key, 0 list_rank, size_bytes list_position
    from files_prior
  union all select filename, sha256, null, 1, size_bytes from files_now
  union all select filename, sha256, s3_key, 3, size_bytes + 1 from files_prior
  union all select filename, sha256, 'later', 3, size_bytes + 2 from files_prior),
named as (select split_part(filename, '/', -1) filename, sha256, s3_key, list_rank, list_position from entries where sha256 <> ''),
r as (select *, row_number() over (partition by filename order by list_rank, list_position) r from named)
select filename, sha256, s3_key from r where r = 1""",
)
def _prior_state(spark, sf_dir):
    """Three manifest lists that name the same files; those without a hash do not count."""
    prior, now = derived(spark, sf_dir, "files_prior"), derived(spark, sf_dir, "files_now")
    size, hash_ = F.col("size_bytes"), F.col("sha256")

    def entries(df, name, sha, path, rank, position):
        return df.select(
            name.alias("filename"), sha.alias("sha256"), path.alias("s3_key"),
            F.lit(rank).alias("list_rank"), position.alias("list_position"),
        )

    name, path, none = F.col("filename"), F.col("s3_key"), F.lit(None).cast("string")
    listed = (
        entries(prior, F.concat(F.lit("in/"), name), F.when(size % 3 == 0, "").otherwise(hash_), path, 0, size)
        .unionByName(entries(now, name, hash_, none, 1, size))
        .unionByName(entries(prior, name, hash_, path, 3, size + 1))
        .unionByName(entries(prior, name, hash_, F.lit("later"), 3, size + 2))
    )
    return incremental.prior_state(listed)


@query("change_detect", f"{m.CHANGES_SQL} select filename, size_bytes, sha256, status from changes")
def _change_detect(spark, sf_dir):
    """The object flag comes from a listing of the store."""
    prior = derived(spark, sf_dir, "files_prior")
    stored = prior.where("object_exists").select(F.col("s3_key").alias("path"))
    known = incremental.with_existence(prior.drop("object_exists"), stored)
    changes = incremental.detect_changes(derived(spark, sf_dir, "files_now"), known)
    return changes.select("filename", "size_bytes", "sha256", "status")


@query("state_merge", f"{STATE_SQL} select * from state")
def _state_merge(spark, sf_dir):
    return next_state(spark, sf_dir)


@query("inventory_flatten", f"{INVENTORY_SQL} select * from inv")
def _inventory(spark, sf_dir):
    return next_inventory(spark, sf_dir)


# Dataset per language; landing dates differ per file.
_LANDED_FILES_SQL = f"""{ctes('file_names')},
landed as (select doc_id, split_part(s3_key, '/', 2) dataset_key,
  nullif(regexp_extract(s3_key, 'ingest_dt=([^/]*)/', 1), '') ingest_dt from file_names where s3_key like 'raw/%'),
latest as (select dataset_key, max(ingest_dt) ingest_dt from landed
  where dataset_key is not null and ingest_dt is not null group by 1)"""


def _landed_files(spark, sf_dir):
    """All files; every sixth lies loose, without a landing date, and is for the operators to leave out."""
    return derived(spark, sf_dir, "file_names").select(
        "doc_id", F.get(F.split("s3_key", "/"), F.lit(1)).alias("dataset_key"), date_in_path("s3_key").alias("ingest_dt")
    )


@query("latest_date_per_dataset", f"{_LANDED_FILES_SQL} select * from latest")
def _latest_dates(spark, sf_dir):
    return incremental.latest_dates(_landed_files(spark, sf_dir))


@query("bind_latest_partition", f"{_LANDED_FILES_SQL} select l.* from landed l join latest using (dataset_key, ingest_dt)")
def _bind_latest(spark, sf_dir):
    files = _landed_files(spark, sf_dir)
    return incremental.keep_latest(files, files)


@query("partition_plan", PLAN_SQL)
def _partition_plan(spark, sf_dir):
    return planned_partitions(spark, sf_dir)


# --- data checks ------------------------------------------------------------------------------------

_MODEL_SQL = {
    "dim_facility": (m.FACILITY_SQL, RUN_DATE),
    "fact_ownership": (m.OWNERSHIP_SQL, LANDED),
    "dim_measure": (m.MEASURE_SQL, RUN_DATE),
    "fact_facility_covid": (m.COVID_PROVIDER_SQL, LANDED),
    "fact_state_covid_vax_avgs": (m.COVID_STATE_SQL, LANDED),
    "fact_survey_event": (m.SURVEY_EVENT_SQL, LANDED),
    "fact_penalties": (m.PENALTIES_SQL, LANDED),
    "fact_quality_measure_score": (m.SCORES_SQL, LANDED),
    "fact_citations": (m.CITATIONS_SQL, LANDED),
    "fact_staffing_daily": (m.STAFFING_SQL, LANDED),
    "fact_survey_cycle_summary": (m.SUMMARY_SQL, LANDED),
}


def _check_values_sql(rules) -> dict[str, tuple[str, str]]:
    """Each check of a table as its own scalar query, by the textbook form."""
    columns = rules.null_columns or rules.key
    if rules.nulls == "rows":
        tests = [f"{c} is null" for c in columns] + [f"trim({c}) = ''" for c in rules.not_blank]
        missing = f"coalesce(sum(case when {' or '.join(tests)} then 1 else 0 end), 0)"
    else:
        missing = " + ".join(f"sum(case when {c} is null then 1 else 0 end)" for c in columns)
    joined = " || '|' || ".join(f"cast({c} as varchar)" for c in rules.key)
    keys = ", ".join(rules.key)
    dupes = {
        "distinct": f"select count(*) - count(distinct {rules.key[0]}) from t",
        "joined": f"select count(*) - count(distinct {joined}) from t",
        "groups": f"select count(*) from (select {keys} from t group by {keys} having count(*) > 1)",
    }[rules.duplicates]
    dates = {
        f"nulldates_{d}": (f"select sum(case when {d} is null then 1 else 0 end) from t", "zero")
        for d in rules.dates
    }
    return {
        "nullpk": (f"select {missing} from t", "zero"),
        "dupes": (dupes, "zero"),
        **dates,
        "rowcnt": ("select count(*) from t", "gt_zero"),
    }


def _table_check_sql(rules) -> str:
    sql, partition = _MODEL_SQL[rules.table]
    parts = [
        f"select '{rules.table}_{name}' check_name, ({value}) as value, '{expectation}' expectation"
        for name, (value, expectation) in _check_values_sql(rules).items()
    ]
    return f"""with t as ({sql}), v as ({' union all '.join(parts)})
select check_name, '{rules.table}' table_name, '{partition}' as partition, cast(value as bigint) as value, expectation,
  case when value is null then 'error'
    when case expectation when 'zero' then value = 0 when 'gt_zero' then value > 0 end then 'passed'
    else 'failed' end outcome from v"""


def curated(spark, sf_dir, name):
    return curated_table(spark, name, lambda dataset: raw(spark, sf_dir, dataset), RUN_DATE)


def _one_table(rules):
    def run(spark, sf_dir):
        return check_table(curated(spark, sf_dir, rules.table), rules, _MODEL_SQL[rules.table][1])

    return run


for _rules in TABLE_CHECKS:
    query(f"checks_{_rules.table}", _table_check_sql(_rules))(_one_table(_rules))


_ALL_CHECKS_SQL = " union all ".join(f"(select * from ({_table_check_sql(r)}))" for r in TABLE_CHECKS)


@query("run_checks", _ALL_CHECKS_SQL)
def _run_checks(spark, sf_dir):
    inputs = shared_raw(spark, sf_dir)
    tables = {name: curated_table(spark, name, inputs, RUN_DATE) for name in _MODEL_SQL}
    return run_checks(tables, {name: [partition] for name, (_, partition) in _MODEL_SQL.items()})


@query(
    "checks_fact_facility_covid_null_dates",
    f"select * from ({_table_check_sql(TABLE_CHECKS[3])}) where check_name like '%nulldates%'",
)
def _null_dates(spark, sf_dir):
    covid = curated(spark, sf_dir, "fact_facility_covid")
    return check_table(covid, TABLE_CHECKS[3], LANDED).where(F.col("check_name").contains("nulldates"))


_OWNERSHIP_WITH_HEADERS = """select case when o_orderkey % 1000 = 7 then ' CMS Certification Number (CCN) '
  else cast(o_custkey as string) end cms_certification_number_ccn from {orders}"""


@query(
    "checks_raw_ownership",
    f"""with t as (select case when o_orderkey % 1000 = 7 then 'x' end header from orders),
v as (select 'raw_ownership_num_records' check_name, (select count(*) from t) as value, 'gt_zero' expectation
  union all select 'raw_ownership_bad_headers', (select count(header) from t), 'zero')
select check_name, 'raw_ownership' table_name, '{LANDED}' as partition, value, expectation,
  case when case expectation when 'zero' then value = 0 else value > 0 end then 'passed' else 'failed' end outcome from v""",
)
def _raw_ownership(spark, sf_dir):
    rows = spark_sql(spark, sf_dir, _OWNERSHIP_WITH_HEADERS).withColumn("ingest_dt", F.lit(LANDED))
    return check_raw_header(rows, "raw_ownership", "cms_certification_number_ccn", LANDED)
