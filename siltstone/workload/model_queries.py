"""Curated models over the derived raw inputs."""

from __future__ import annotations

from pyspark.sql import functions as F

from siltstone.operators.incremental import detect_changes
from siltstone.plans import models
from siltstone.plans.calendar import dim_date
from siltstone.sources.schemas import HOUR_COLUMNS
from siltstone.workload.inputs import LANDED, RUN_DATE, RUN_TS, ctes, derived, raw, table
from siltstone.workload.registry import (
    COMPACT,
    IN_CALENDAR,
    ISO,
    US,
    clean,
    date_id,
    day,
    key,
    nulls,
    query,
    text,
)

CCN = "cms_certification_number_ccn"

_ownership_day = day("regexp_extract(association_date, '([0-9]{1,2}/[0-9]{1,2}/[0-9]{4})', 1)", US)
OWNERSHIP_SQL = f"""{ctes('ownership')},
dated as (select *, {_ownership_day} d from ownership)
select {key(CCN)} ccn_provnum, {text('d')} association_date, {date_id('d')} date_id, owner_name, owner_type,
  ownership_percentage ownership_pct, role_played_by_owner_or_manager_in_facility ownership_role,
  '{LANDED}' ingest_dt
from dated where d {IN_CALENDAR}"""

FACILITY_SQL = f"""{ctes('provider', 'swing_bed')},
regions as (select distinct {key(CCN)} k, try_cast({clean('cms_region')} as integer) cms_region from swing_bed)
select {key('ccn_provnum')} ccn_provnum, {clean('provider_name')} provider_name,
  {nulls('varchar', 'provider_address', 'avg_residents_per_day_footnote')},
  {clean('provider_city')} provider_city, {clean('provider_state')} provider_state,
  {key('provider_zip_code', 5)} provider_zip_code, cms_region,
  try_cast(number_of_certified_beds as integer) number_of_certified_beds,
  try_cast(avg_residents_per_day as double) avg_residents_per_day,
  try_cast(adjusted_total_nurse_staffing_hours_per_resident_per_day as double)
    adjusted_total_nurse_staffing_hours_per_resident_per_day,
  try_cast(adjusted_rn_staffing_hours_per_resident_per_day as double)
    adjusted_rn_staffing_hours_per_resident_per_day,
  {nulls('double', *(h for h in models.FACILITY_HOURS if h not in (
      'adjusted_total_nurse_staffing_hours_per_resident_per_day',
      'adjusted_rn_staffing_hours_per_resident_per_day')))},
  '{RUN_DATE}' ingest_dt
from provider left join regions on {key('ccn_provnum')} = k"""

MEASURE_SQL = f"""{ctes('claims_measures', 'mds_measures', 'snf_measures', 'swing_bed')},
codes as (
  select measure_code, measure_description from claims_measures
  union all select measure_code, measure_description from mds_measures
  union all select {clean('measure_code')}, null from snf_measures
  union all select {clean('measure_code')}, null from swing_bed),
ranked as (
  select measure_code, nullif(measure_description, '') d, row_number() over (
    partition by measure_code
    order by length(coalesce(measure_description, '')) desc, coalesce(measure_description, '') desc) r
  from codes)
select measure_code, d measure_description, '{RUN_DATE}' ingest_dt from ranked where r = 1"""

COVID_PROVIDER_SQL = f"""{ctes('covid_provider')}
select {key(CCN)} ccn_provnum, cast(null as varchar) state,
  pct_residents_up_to_date_vaxes pct_residents_w_up_to_date_vaxes,
  cast(null as varchar) pct_staff_w_up_to_date_vaxes,
  {text(day('vax_data_last_update', ISO, US))} vax_data_last_update, '{LANDED}' ingest_dt
from covid_provider"""

_unquoted = "replace({0}, '\"', '')".format
COVID_STATE_SQL = f"""{ctes('covid_state')}
select upper(trim({_unquoted('state_raw')})) state,
  try_cast({_unquoted('pct_residents_up_to_date_raw')} as double) pct_residents_w_up_to_date_vaxes,
  try_cast({_unquoted('pct_staff_up_to_date_raw')} as double) pct_staff_w_up_to_date_vaxes,
  {text(day(_unquoted('vax_data_last_updated_raw'), US))} date_vax_data_last_updated, '{LANDED}' ingest_dt
from covid_state"""

SURVEY_EVENT_SQL = f"""{ctes('survey_dates')},
dated as (select *, {day('survey_date', ISO)} d from survey_dates)
select {key(CCN)} ccn_provnum, {text('d')} survey_date, {date_id('d')} date_id, type_of_survey survey_type,
  try_cast(survey_cycle as integer) survey_cycle, '{LANDED}' ingest_dt
from dated where d {IN_CALENDAR}"""

PENALTIES_SQL = f"""{ctes('penalties')},
dated as (select *, {day('"penalty date"', US, ISO)} d, try_cast({clean('"fine amount"')} as double) amount,
  {day(clean('"payment denial start date"'), US, ISO)} s from penalties)
select {key('"cms certification number (ccn)"')} ccn_provnum, {text('d')} penalty_date, {date_id('d')} date_id,
  "penalty type" penalty_type, amount penalty_amt, {text('s')} penalty_start_dt,
  try_cast("payment denial length in days" as integer) penalty_denial_length, '{LANDED}' ingest_dt
from dated where d {IN_CALENDAR} and amount is not null"""

_QUARTERLY = [f"{q}_measure_score" for q in models.QUARTERS]
_FOOTNOTES = [f"{n}_footnote" for n in _QUARTERLY]


def _scores_sql(source: str, score: str, footnote: str, own: str) -> str:
    is_period = "regexp_full_match(measure_period, '[0-9]{8}-[0-9]{8}')"
    return f"""select {key(CCN)} ccn_provnum, measure_code, measure_period,
  case when {is_period} then {text(day('substr(measure_period, 1, 8)', COMPACT))} end measure_period_start_date,
  case when {is_period} then {text(day('substr(measure_period, 10, 8)', COMPACT))} end measure_period_end_date,
  cast(try_cast({score} as double) as varchar) score, {footnote} footnote,
  {nulls('varchar', 'start_date', 'end_date', 'measure_date_range')}, resident_type,
  case upper(trim(used_in_quality_measure_five_star_rating)) when 'YES' then true when 'N' then false end
    used_in_quality_measure_five_star_rating,
  {own}, '{LANDED}' ingest_dt
from {source}"""


_claims_own = f"""{nulls('double', *_QUARTERLY, 'four_quarter_avg_score')},
  {nulls('varchar', *_FOOTNOTES, 'four_quarter_avg_score_footnote')},
  try_cast(adjusted_score as double) adjusted_score, try_cast(observed_score as double) observed_score,
  cast(null as double) expected_score"""
_mds_own = f"""try_cast(q1_measure_score as double) q1_measure_score, {nulls('double', *_QUARTERLY[1:])},
  try_cast(four_quarter_average_score as double) four_quarter_avg_score, {nulls('varchar', *_FOOTNOTES)},
  footnote_for_four_quarter_average_score four_quarter_avg_score_footnote,
  {nulls('double', 'adjusted_score', 'observed_score', 'expected_score')}"""
SCORES_SQL = f"""{ctes('claims_measures', 'mds_measures')}
{_scores_sql('claims_measures', 'adjusted_score', 'footnote_for_score', _claims_own)}
union all by name
{_scores_sql('mds_measures', 'four_quarter_average_score', 'footnote_for_four_quarter_average_score', _mds_own)}"""


def _citation_sql(source: str, correction: str, idr: str) -> str:
    return f"""select {CCN}, {day('survey_date', ISO)} d, deficiency_tag_number, survey_type,
  scope_severity_code, inspection_cycle, {correction} correction, {idr} idr from {source}"""


CITATIONS_SQL = f"""{ctes('fire_citations', 'health_citations')},
stacked as (
  {_citation_sql('fire_citations', day('correction_date', ISO), 'null')}
  union all {_citation_sql('health_citations', 'null', 'citation_under_idr')})
select {key(CCN)} ccn_provnum, {text('d')} survey_date,
  case when d {IN_CALENDAR} then {date_id('d')} end date_id,
  deficiency_tag_number deficiency_tag_nbr, survey_type,
  {nulls('varchar', 'deficiency_prefix', 'deficiency_category', 'deficiency_desc', 'deficiency_corrected',
         'standard_deficiency', 'complaint_deficiency', 'infection_control_inspection_deficiency', 'citation_iidr')},
  scope_severity_code, {text('correction')} correction_date,
  try_cast(inspection_cycle as integer) inspection_cycle, idr citation_idr, '{LANDED}' ingest_dt
from stacked where d is not null"""

_given_hours = ("hrs_rn", "hrs_lpn", "hrs_cna", "hrs_medaide_ctr")
STAFFING_SQL = f"""{ctes('staffing')},
dated as (select *, {day('workdate', COMPACT)} d from staffing where regexp_full_match(workdate, '[0-9]{{8}}'))
select {key('provnum')} ccn_provnum, {text('d')} workdate, {date_id('d')} date_id, county_fips,
  try_cast(mdscensus as integer) mdscensus,
  {', '.join(f'try_cast({h} as double) {h}' for h in _given_hours)},
  {nulls('double', *(h for h in HOUR_COLUMNS if h not in _given_hours))}, '{LANDED}' ingest_dt
from dated where d {IN_CALENDAR}"""

_given_counts = {
    "ttl_nbr_health_deficiences": "total_number_of_health_deficiencies",
    "cnt_egress_deficiencies": "count_of_egress_deficiencies",
    "cnt_electrical_deficiences": "count_of_electrical_deficiencies",
}
SUMMARY_SQL = f"""{ctes('survey_summary')}
select {key(CCN)} ccn_provnum, try_cast({clean('inspection_cycle')} as integer) inspection_cycle,
  {text(day(clean('health_survey_date'), ISO))} health_survey_date,
  {text(day(clean('fire_safety_survey_date'), ISO))} first_safety_survey_date,
  {', '.join(f'try_cast({clean(r)} as integer) {n}' for n, r in _given_counts.items())},
  {nulls('integer', *(n for n in models.SUMMARY_COUNTS if n not in _given_counts))}, '{LANDED}' ingest_dt
from survey_summary"""

_one_raw = {
    "fact_ownership": (models.fact_ownership, "ownership", OWNERSHIP_SQL, True),
    "fact_facility_covid": (models.fact_facility_covid, "covid_provider", COVID_PROVIDER_SQL, False),
    "fact_state_covid_vax_avgs": (models.fact_state_covid_vax_avgs, "covid_state", COVID_STATE_SQL, False),
    "fact_survey_event": (models.fact_survey_event, "survey_dates", SURVEY_EVENT_SQL, True),
    "fact_penalties": (models.fact_penalties, "penalties", PENALTIES_SQL, True),
    "fact_staffing_daily": (models.fact_staffing_daily, "staffing", STAFFING_SQL, True),
    "fact_survey_cycle_summary": (models.fact_survey_cycle_summary, "survey_summary", SUMMARY_SQL, False),
}


def _single_source(model, dataset: str, dated: bool):
    def run(spark, sf_dir):
        df = raw(spark, sf_dir, dataset)
        return model(df, dim_date(spark)) if dated else model(df)

    return run


for _name, (_model, _dataset, _sql, _dated) in _one_raw.items():
    query(_name, _sql)(_single_source(_model, _dataset, _dated))


@query(
    "dim_date",
    """with days as (select cast(d as date) d from unnest(generate_series(
    date '1940-01-01', date '2026-12-31', interval 1 day)) t(d)),
used as (select cast(o_orderdate as date) d, count(*) n from orders group by 1)
select cast(strftime(days.d, '%Y%m%d') as integer) date_id, cast(days.d as varchar) date,
  strftime(days.d, '%d') day_nbr, strftime(days.d, '%m') month_nbr, strftime(days.d, '%Y') as year,
  cast(quarter(days.d) as varchar) as quarter, cast(coalesce(n, 0) as bigint) order_cnt
from days left join used on days.d = used.d""",
)
def _dim_date(spark, sf_dir):
    """Every calendar day with the orders that fall on it."""
    per_day = table(spark, sf_dir, "orders").groupBy(F.col("o_orderdate").cast("date").alias("date")).count()
    return (
        dim_date(spark)
        .join(per_day, "date", "left")
        .withColumn("order_cnt", F.coalesce("count", F.lit(0)))
        .drop("count")
    )


@query("dim_facility", FACILITY_SQL)
def _dim_facility(spark, sf_dir):
    return models.dim_facility(raw(spark, sf_dir, "provider"), raw(spark, sf_dir, "swing_bed"), RUN_DATE)


@query("dim_measure", MEASURE_SQL)
def _dim_measure(spark, sf_dir):
    sources = (raw(spark, sf_dir, n) for n in ("claims_measures", "mds_measures", "snf_measures", "swing_bed"))
    return models.dim_measure(*sources, RUN_DATE)


@query("fact_quality_measure_score", SCORES_SQL)
def _scores(spark, sf_dir):
    return models.fact_quality_measure_score(
        raw(spark, sf_dir, "claims_measures"), raw(spark, sf_dir, "mds_measures")
    )


@query("fact_citations", CITATIONS_SQL)
def _fact_citations(spark, sf_dir):
    return models.fact_citations(
        raw(spark, sf_dir, "fire_citations"), raw(spark, sf_dir, "health_citations"), dim_date(spark)
    )


@query(
    "vw_facility_staffing_metrics_latest",
    f"""with f as ({FACILITY_SQL}),
runs as (select * from f union all select * replace ('2024-01-15' as ingest_dt) from f),
latest as (select max(ingest_dt) d from runs)
select ccn_provnum, provider_name, provider_city, provider_state, provider_zip_code, cms_region,
  number_of_certified_beds, avg_residents_per_day, adjusted_total_nurse_staffing_hours_per_resident_per_day,
  adjusted_rn_staffing_hours_per_resident_per_day,
  round(coalesce(avg_residents_per_day, 0.0)
    * coalesce(adjusted_total_nurse_staffing_hours_per_resident_per_day, 0.0), 6) estimated_total_nurse_hours_per_day,
  adjusted_total_nurse_staffing_hours_per_resident_per_day nurse_hours_per_patient,
  case when coalesce(number_of_certified_beds, 0) > 0
    then round(avg_residents_per_day / number_of_certified_beds, 6) end occupancy_proxy, ingest_dt
from runs, latest where ingest_dt = d""",
)
def _metrics(spark, sf_dir):
    newest = _dim_facility(spark, sf_dir)
    older = newest.withColumn("ingest_dt", F.lit("2024-01-15"))
    view = models.facility_staffing_metrics_latest(newest.unionByName(older))
    return view.withColumns(
        {c: F.round(c, 6) for c in ("estimated_total_nurse_hours_per_day", "occupancy_proxy")}
    )


CHANGES_SQL = f"""{ctes('files_now', 'files_prior')},
joined as (select n.*, p.sha256 prior_sha256, p.s3_key prior_s3_key, p.object_exists
  from files_now n left join files_prior p on n.filename = p.filename),
changes as (select *, case when prior_sha256 is null then 'new' when prior_sha256 <> sha256 then 'changed'
  when object_exists then 'unchanged' else 'heal' end status from joined)"""
FILES_PER_RUN = 50


def run_manifests(spark, sf_dir):
    """A manifest document per run of at most ``FILES_PER_RUN`` files, so that no document grows."""
    changes = detect_changes(derived(spark, sf_dir, "files_now"), derived(spark, sf_dir, "files_prior"))
    number = F.regexp_extract("filename", "_([0-9]+)[.]", 1).cast("bigint")
    run = F.floor(number / FILES_PER_RUN).cast("string")
    entry = F.struct("filename", "sha256", "size_bytes")
    stored = F.col("status") != "unchanged"
    too_long = F.col("size_bytes") > 15000
    return changes.groupBy(run.alias("source")).agg(
        F.collect_list(F.when(stored & ~too_long, entry)).alias("files"),
        F.collect_list(F.when(~stored & ~too_long, entry)).alias("skipped_unchanged"),
        F.collect_list(F.when(too_long, entry)).alias("errors"),
        F.lit(RUN_TS).alias("run_ts_utc"),
        F.lit(RUN_DATE).alias("ingest_dt"),
    )


@query(
    "control_watermark",
    f"""{CHANGES_SQL},
m as (select cast(cast(regexp_extract(filename, '_([0-9]+)[.]', 1) as bigint) // {FILES_PER_RUN} as varchar) run,
  count(*) filter (status <> 'unchanged' and size_bytes <= 15000) u,
  count(*) filter (status = 'unchanged' and size_bytes <= 15000) s,
  count(*) filter (size_bytes > 15000) e from changes group by 1)
select '2024-02-01 05:34:29.935139' run_ts, '{RUN_TS}' run_ts_utc,
  case when e = 0 then 'ok' else 'partial_failure' end status,
  'control/'||run||'/manifest.json' manifest_s3_key, u counts_uploaded, s counts_skipped_unchanged,
  e counts_errors, u + s + e counts_total_files_seen, '{RUN_DATE}' ingest_dt
from m""",
)
def _control_watermark(spark, sf_dir):
    path = F.concat(F.lit("control/"), "source", F.lit("/manifest.json"))
    return models.control_watermark(run_manifests(spark, sf_dir), path)
