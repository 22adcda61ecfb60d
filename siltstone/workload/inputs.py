"""Raw, all-text inputs derived from the given tables, dirty on purpose.

The statements are portable between Spark and the SQL engine used to check results, so both sides
start from the same rows. ``$sha(x)`` stands for the SHA-256 function of either side.
"""

from __future__ import annotations

import re
from collections.abc import Callable
from functools import cache, partial

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from siltstone.functions.cleaning import with_missing_columns
from siltstone.sources.schemas import INGEST_DT, raw_schema

TABLES = (
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events", "documents",
)
LANDED = "2024-01-01"
RUN_DATE = "2024-02-01"
RUN_TS = "2024-02-01T05:34:29.935139+00:00"


def _us(column: str) -> str:
    day = f"cast(cast({column} as date) as string)"
    return f"substr({day},6,2)||'/'||substr({day},9,2)||'/'||substr({day},1,4)"


def _iso(column: str) -> str:
    return f"cast(cast({column} as date) as string)"


def _compact(column: str) -> str:
    return f"replace({_iso(column)},'-','')"


def _measures(score: str, second: str, footnote: str, marker: str) -> str:
    return f"""
select cast(l_suppkey as string) cms_certification_number_ccn, p_brand measure_code,
  case when p_size%4=0 then '' else p_type end measure_description,
  case when l_linenumber%2=0 then {_compact('l_shipdate')}||'-'||{_compact('l_shipdate')}
    else substr({_iso('l_shipdate')},1,4)||'Q1' end measure_period,
  cast(l_quantity as string) {score},
  case when l_linenumber=3 then 'NA' else cast(l_tax as string) end {second},
  '{marker} '||l_linestatus {footnote}, l_returnflag resident_type,
  case l_linenumber%3 when 0 then ' yes ' when 1 then 'N' else '?' end used_in_quality_measure_five_star_rating
from {{lineitem}} join {{part}} on l_partkey=p_partkey"""


INPUT_SQL: dict[str, str] = {
    "provider": """
select case s_suppkey%3 when 0 then '"'||cast(s_suppkey as string)||'"'
    when 1 then ' '||cast(s_suppkey as string)||' ' else cast(s_suppkey as string) end ccn_provnum,
  '"'||s_name||'"' provider_name, substr(n_name,1,2) provider_state, ' "City '||n_name||'" ' provider_city,
  cast(s_suppkey%1000*7 as string) provider_zip_code,
  case when s_suppkey%7=0 then 'N/A' else cast(50+s_suppkey%100 as string) end number_of_certified_beds,
  cast(s_suppkey%40 as string)||'.5' avg_residents_per_day,
  cast(s_suppkey%6 as string)||'.25' adjusted_total_nurse_staffing_hours_per_resident_per_day,
  case when s_suppkey%5=0 then '' else cast(s_suppkey%3 as string)||'.125' end adjusted_rn_staffing_hours_per_resident_per_day
from {supplier} join {nation} on s_nationkey=n_nationkey""",
    "swing_bed": """
select '"'||cast(case when s_suppkey%2=0 then s_suppkey else -s_suppkey end as string)||'"' cms_certification_number_ccn,
  '"'||cast(n_regionkey as string)||'"' cms_region, 'S_'||cast(s_suppkey%5 as string) measure_code
from {supplier} join {nation} on s_nationkey=n_nationkey""",
    "snf_measures": """
select cast(c_custkey as string) cms_certification_number_ccn, '"'||c_mktsegment||'"' measure_code,
  cast(c_acctbal as string) score
from {customer}""",
    "ownership": f"""
select cast(o_custkey%100 as string) cms_certification_number_ccn, c_name owner_name, o_orderpriority owner_type,
  case when o_custkey%5=0 then 'NOT APPLICABLE' else cast(o_custkey%101 as string)||'%' end ownership_percentage,
  o_orderstatus role_played_by_owner_or_manager_in_facility,
  case when o_orderkey%10=0 then 'NO DATE PROVIDED' else 'since '||{_us('o_orderdate')} end association_date
from {{orders}} join {{customer}} on o_custkey=c_custkey""",
    "claims_measures": _measures("adjusted_score", "observed_score", "footnote_for_score", "claim"),
    "mds_measures": _measures(
        "four_quarter_average_score", "q1_measure_score", "footnote_for_four_quarter_average_score", "mds"
    ),
    "covid_provider": f"""
select '"'||cast(o_custkey as string)||'"' cms_certification_number_ccn,
  case o_custkey%3 when 0 then {_iso('min(o_orderdate)')} when 1 then {_us('min(o_orderdate)')}
    else 'pending' end vax_data_last_update,
  cast(o_custkey%100 as string)||'.5' pct_residents_up_to_date_vaxes
from {{orders}} group by o_custkey""",
    "covid_state": f"""
select ' "'||lower(n_name)||'" ' state_raw, '"'||cast(count(*)%100 as string)||'.5"' pct_residents_up_to_date_raw,
  case when count(*)%9=0 then 'n/a' else '"'||cast(max(o_custkey)%50 as string)||'.25"' end pct_staff_up_to_date_raw,
  '"'||{_us('max(o_orderdate)')}||'"' vax_data_last_updated_raw
from {{orders}} join {{customer}} on o_custkey=c_custkey join {{nation}} on c_nationkey=n_nationkey
group by n_name, substr({_iso('o_orderdate')},1,7)""",
    "survey_dates": f"""
select cast(o_custkey as string) cms_certification_number_ccn,
  case when o_orderkey%20=0 then '' else {_iso('o_orderdate')} end survey_date, o_orderpriority type_of_survey,
  case when o_orderkey%9=0 then 'x' else cast(o_orderkey%4 as string) end survey_cycle
from {{orders}}""",
    "penalties": f"""
select cast(o_custkey as string) `cms certification number (ccn)`,
  case o_orderkey%2 when 0 then {_us('o_orderdate')} else {_iso('o_orderdate')} end `penalty date`,
  o_orderstatus `penalty type`,
  case when o_orderkey%6=0 then '' else '"'||cast(o_totalprice as string)||'"' end `fine amount`,
  case when o_orderkey%4=0 then '' else '"'||{_us('o_orderdate')}||'"' end `payment denial start date`,
  cast(o_orderkey%90 as string) `payment denial length in days`
from {{orders}}""",
    "fire_citations": f"""
select cast(l_suppkey as string) cms_certification_number_ccn, {_iso('l_shipdate')} survey_date,
  cast(l_partkey%50 as string) deficiency_tag_number, l_linestatus survey_type,
  l_returnflag scope_severity_code, cast(l_linenumber as string) inspection_cycle,
  case when l_partkey%3=0 then '2/30/2024' else {_iso('l_shipdate')} end correction_date
from {{lineitem}} where l_linenumber%2=1""",
    "health_citations": f"""
select cast(l_suppkey as string) cms_certification_number_ccn, {_iso('l_shipdate')} survey_date,
  cast(l_partkey%50 as string) deficiency_tag_number, l_linestatus survey_type,
  l_returnflag scope_severity_code, cast(l_linenumber as string) inspection_cycle,
  case when l_tax>0.04 then 'Y' else 'N' end citation_under_idr
from {{lineitem}} where l_linenumber%2=0""",
    "staffing": f"""
select '"'||cast(l_suppkey as string)||'"' provnum,
  case when l_suppkey%50=0 then {_iso('l_shipdate')} else {_compact('l_shipdate')} end workdate,
  cast(l_suppkey%99 as string) county_fips,
  cast(count(*) as string) mdscensus, cast(sum(l_quantity) as string) hrs_rn,
  cast(max(l_quantity) as string) hrs_lpn, cast(min(l_quantity) as string) hrs_cna,
  case when count(*)%4=0 then 'n/a' else cast(max(l_linenumber) as string) end hrs_medaide_ctr
from {{lineitem}} group by l_suppkey, l_shipdate""",
    "survey_summary": f"""
select '"'||cast(o_custkey as string)||'"' cms_certification_number_ccn,
  '"'||cast(o_orderkey%3+1 as string)||'"' inspection_cycle, {_iso('max(o_orderdate)')} health_survey_date,
  '"'||{_iso('min(o_orderdate)')}||'"' fire_safety_survey_date,
  '"'||cast(count(*) as string)||'"' total_number_of_health_deficiencies,
  cast(max(o_orderkey%5) as string) count_of_egress_deficiencies,
  ' "'||cast(min(o_orderkey%7) as string)||'"' count_of_electrical_deficiencies,
  'none' count_of_miscellaneous_deficiencies
from {{orders}} group by o_custkey, o_orderkey%3+1""",
    "dirty_lines": f"""
select l_orderkey, l_partkey, l_linenumber, l_quantity,
  case l_partkey%5 when 0 then '"'||cast(l_partkey as string)||'"' when 1 then '  '||cast(l_partkey as string)||' '
    when 2 then cast(l_partkey as string)||'0000000' when 3 then '' else cast(l_partkey as string) end key_text,
  case l_suppkey%3 when 0 then ' "'||cast(l_suppkey as string)||'"' else cast(l_suppkey*1000 as string) end zip_text,
  case l_linenumber%4 when 0 then 'N/A' when 1 then ' '||cast(l_linenumber as string)||' '
    else cast(l_partkey as string) end int_text,
  case l_linenumber%3 when 0 then '' when 1 then cast(l_quantity as string)
    else cast(l_extendedprice as string)||'%' end double_text,
  case when l_partkey%6=0 then '"?"' else ' "'||cast(l_linenumber as string)||'" ' end quoted_int,
  case l_linenumber%5 when 0 then {_iso('l_shipdate')} when 1 then ' '||{_iso('l_shipdate')}||' '
    when 2 then {_us('l_shipdate')} when 3 then '2024-02-30' else 'pending' end date_text,
  case when l_partkey%4=0 then 'no date' else 'owned since '||{_us('l_shipdate')}||'; was 01/02/1990' end free_text,
  case l_linenumber%3 when 0 then {_compact('l_shipdate')}||'-'||{_compact('l_shipdate')}
    when 1 then {_compact('l_shipdate')}||'-20249999' else substr({_iso('l_shipdate')},1,4)||'Q1' end period_text,
  case l_partkey%7 when 0 then 'Y' when 1 then ' yes' when 2 then 'True ' when 3 then 'n' when 4 then '0'
    when 5 then 'maybe' else null end flag_text,
  case l_linenumber%2 when 0 then {_compact('l_shipdate')} else {_iso('l_shipdate')} end work_text
from {{lineitem}}""",
    "file_names": """
select doc_id, case doc_id%4 when 0 then 'NH '||upper(lang)||'  '||cast(doc_id as string)||'.CSV'
    when 1 then lang||'__part_'||cast(doc_id as string)||'.json' when 2 then lang||'.'||cast(doc_id as string)||'.csv.json'
    else lang||'_'||cast(doc_id as string)||'.json.csv' end filename,
  case when doc_id%6=0 then 'loose/'||cast(doc_id as string)||'.csv'
    else 'raw/'||lang||'/ingest_dt=2024-01-'||lpad(cast(1+doc_id%28 as string),2,'0')||'/'||cast(doc_id as string)||'.csv'
    end s3_key, n_chars size_bytes
from {documents}""",
    # Every document is a file of this run and of the one before; some go by another name in one of them,
    # which makes them new, or carried along.
    "files_now": """
select lang||'_'||cast(doc_id as string)||case when doc_id%13=0 then '.new.csv' else '.csv' end filename,
  n_chars size_bytes, $sha(text) sha256
from {documents}""",
    "files_prior": """
select filename, replace(filename,'.csv','') dataset_key, sha256, size_bytes,
  'raw/'||replace(filename,'.csv','')||'/ingest_dt='||landed||'/'||filename s3_key,
  case when doc_id%4=0 then '' else landed end data_ingest_dt, '2024-01-15' last_seen_run_ingest_dt,
  '2024-01-15T00:00:00+00:00' last_seen_run_ts_utc, doc_id%11<>0 object_exists
from (select doc_id, lang||'_'||cast(doc_id as string)||case when doc_id%5=0 then '.old.csv' else '.csv' end filename,
    case when doc_id%7=0 then $sha(text||'x') else $sha(text) end sha256, n_chars size_bytes,
    '2024-01-0'||cast(1+doc_id%9 as string) landed
  from {documents}) d""",
}


def _sha(text: str, pattern: str) -> str:
    return re.sub(r"\$sha\(([^)]*)\)", pattern, text)


def spark_sql(spark: SparkSession, sf_dir: str, sql: str, read: Callable[[str], DataFrame] | None = None) -> DataFrame:
    """Run portable text whose ``{table}`` places name given tables; ``read`` may share their frames."""
    read = read or partial(table, spark, sf_dir)
    frames = {n: read(n) for n in set(re.findall(r"\{(\w+)\}", sql))}
    return spark.sql(_sha(sql, r"sha2(\1,256)"), **frames)


def check_sql(sql: str) -> str:
    """The same text for the checking engine, which knows the tables by name."""
    return _sha(re.sub(r"\{(\w+)\}", r"\1", sql), r"sha256(\1)").replace("`", '"')


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def derived(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """An input as its statement gives it."""
    return spark_sql(spark, sf_dir, INPUT_SQL[name])


def raw(spark: SparkSession, sf_dir: str, dataset: str, ingest_dt: str = LANDED) -> DataFrame:
    """An input with the full raw schema of its dataset and a landing date."""
    return _with_raw_schema(derived(spark, sf_dir, dataset), dataset, ingest_dt)


def shared_raw(spark: SparkSession, sf_dir: str) -> Callable[[str], DataFrame]:
    """``raw`` for a query over many datasets, looking up each table and input once."""
    read = cache(partial(table, spark, sf_dir))
    return cache(
        lambda dataset: _with_raw_schema(spark_sql(spark, sf_dir, INPUT_SQL[dataset], read), dataset, LANDED)
    )


def _with_raw_schema(df: DataFrame, dataset: str, ingest_dt: str) -> DataFrame:
    return with_missing_columns(df.withColumn(INGEST_DT, F.lit(ingest_dt)), raw_schema(dataset))


def ctes(*names: str) -> str:
    """``with`` clause that defines the named inputs for the checking engine."""
    return "with " + ",\n".join(f"{name} as ({check_sql(INPUT_SQL[name])})" for name in names)
