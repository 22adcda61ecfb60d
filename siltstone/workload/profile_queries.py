"""Profiling: missing and distinct values, composite key search, reports."""

from __future__ import annotations

from itertools import combinations

from pyspark.sql import functions as F

from siltstone.operators import profile
from siltstone.workload.inputs import ctes, derived, table
from siltstone.workload.registry import query

DIRTY_COLUMNS = (
    "l_orderkey", "l_partkey", "l_linenumber", "l_quantity", "key_text", "zip_text", "int_text", "double_text",
    "quoted_int", "date_text", "free_text", "period_text", "flag_text", "work_text",
)
# The dirty lines with blanks as NULL, so that columns have something missing.
_BLANKED = f"""{ctes('dirty_lines')},
b as (select * replace (nullif(key_text, '') as key_text, nullif(double_text, '') as double_text) from dirty_lines),
stats as ({' union all '.join(
    f"select {i} as position, '{c}' column_name, (count(*) - count({c})) * 100.0 / count(*) null_pct,"
    f" count(distinct {c}) distinct_cnt from b" for i, c in enumerate(DIRTY_COLUMNS))})"""


def _blanked(spark, sf_dir):
    lines = derived(spark, sf_dir, "dirty_lines").select(*DIRTY_COLUMNS)
    return lines.withColumns({c: F.nullif(c, F.lit("")) for c in ("key_text", "double_text")})


def _rounded(df):
    return df.withColumn("null_pct", F.round("null_pct", 4))


@query("null_pct", f"{_BLANKED} select position, column_name, round(null_pct, 4) null_pct from stats")
def _null_pct(spark, sf_dir):
    return _rounded(profile.null_pct(_blanked(spark, sf_dir)))


@query("distinct_per_column", f"{_BLANKED} select column_name, distinct_cnt from stats")
def _distinct(spark, sf_dir):
    return profile.column_stats(_blanked(spark, sf_dir)).select("column_name", "distinct_cnt")


@query(
    "uniqueness_ratio",
    f"""{_BLANKED}, d as (select count(*) n from (select distinct key_text, flag_text, l_linenumber from b))
select (select count(*) from b) row_cnt, n distinct_rows, (select count(*) from b) - n duplicate_rows,
  round(n / (select count(*) from b), 6) uniqueness_ratio from d""",
)
def _uniqueness(spark, sf_dir):
    return profile.uniqueness(_blanked(spark, sf_dir), ["key_text", "flag_text", "l_linenumber"])


@query(
    "duplicate_rows",
    "select count(*) - (select count(*) from (select distinct l_orderkey, l_linenumber from lineitem)) duplicate_rows from lineitem",
)
def _duplicate_rows(spark, sf_dir):
    lines = table(spark, sf_dir, "lineitem")
    return profile.uniqueness(lines, ["l_orderkey", "l_linenumber"]).select("duplicate_rows")


@query(
    "topk_null_columns",
    f"{_BLANKED} select column_name, round(null_pct, 4) null_pct from stats order by null_pct desc, position limit 10",
)
def _topk_null(spark, sf_dir):
    top = profile.top_columns(profile.null_pct(_blanked(spark, sf_dir)), "null_pct")
    return _rounded(top).select("column_name", "null_pct")


@query(
    "topk_cardinality_columns",
    f"{_BLANKED} select column_name, distinct_cnt from stats order by distinct_cnt desc, position limit 10",
)
def _topk_distinct(spark, sf_dir):
    top = profile.top_columns(profile.column_stats(_blanked(spark, sf_dir)), "distinct_cnt")
    return top.select("column_name", "distinct_cnt")


@query(
    "profile_columns",
    f"{_BLANKED} select position, column_name, round(null_pct, 4) null_pct, distinct_cnt from stats",
)
def _profile_columns(spark, sf_dir):
    stats = _rounded(profile.column_stats(_blanked(spark, sf_dir)))
    return stats.select("position", "column_name", "null_pct", "distinct_cnt")


# --- key search ---------------------------------------------------------------------------------------

# Candidates of lineitem in the order the search looks at them.
_LINE_KEYS = ("l_shipdate", "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_extendedprice")


def _greedy_ctes() -> str:
    """The search in SQL: distinct rows of every column set, then the best addition, step by step."""
    sets = []
    for size in range(1, len(_LINE_KEYS) + 1):
        for chosen in combinations(range(len(_LINE_KEYS)), size):
            mask = sum(1 << i for i in chosen)
            columns = ", ".join(_LINE_KEYS[i] for i in chosen)
            sets.append(f"select {mask} mask, count(*) n from (select distinct {columns} from lineitem)")
    names = " union all ".join(f"select {1 << i} bit, {i} pos, '{c}' name" for i, c in enumerate(_LINE_KEYS))
    steps = [
        f"sets as ({' union all '.join(sets)})",
        f"names as ({names})",
        "step1 as (select mask, n, name keys from sets join names on mask = bit order by n desc, pos limit 1)",
    ]
    for i in range(2, len(_LINE_KEYS) + 1):
        steps.append(
            f"step{i} as (select s.mask, s.n, p.keys || '|' || name keys from step{i - 1} p, names, sets s"
            f" where p.mask & bit = 0 and s.mask = p.mask | bit and s.n > p.n order by s.n desc, pos limit 1)"
        )
    every = " union all ".join(f"select {i} step, keys, n from step{i}" for i in range(1, len(_LINE_KEYS) + 1))
    return ",\n".join([*steps, f"found as ({every})"])


GREEDY = _greedy_ctes()


@query(
    "key_search_greedy",
    f"""with {GREEDY} select step, keys key_columns, n distinct_rows, (select count(*) from lineitem) row_cnt,
  round(n / (select count(*) from lineitem), 6) uniqueness_ratio from found""",
)
def _key_search(spark, sf_dir):
    return profile.key_steps(spark, profile.search_key(table(spark, sf_dir, "lineitem")))


_REPORTED = {
    "customer": ("c_custkey", "c_name", "c_nationkey", "c_acctbal", "c_mktsegment"),
    "orders": ("o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderdate", "o_orderpriority"),
    "lineitem": (
        "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity", "l_extendedprice", "l_discount",
        "l_tax", "l_returnflag", "l_linestatus", "l_shipdate",
    ),
}
_UNIQUE_KEY = {"customer": "c_custkey", "orders": "o_orderkey"}


def _report_part(name: str) -> str:
    columns = _REPORTED[name]
    stats = " union all ".join(
        f"select {i} pos, '{c}' c, (count(*) - count({c})) * 100.0 / count(*) p, count(distinct {c}) d from {name}"
        for i, c in enumerate(columns)
    )
    if name in _UNIQUE_KEY:
        found = f"select '{_UNIQUE_KEY[name]}' keys, count(distinct {_UNIQUE_KEY[name]}) n from {name}"
    else:
        found = "select keys, n from found order by step desc limit 1"
    return f"""select '{name}' file, (select count(*) from {name}) as rows, cast({len(columns)} as bigint) cols,
  (select string_agg(c || '=' || printf('%.2f%%', p), '; ' order by p desc, pos)
    from (select * from ({stats}) order by p desc, pos limit 5)) top_null_cols,
  (select string_agg(c || '=' || d, '; ' order by d desc, pos)
    from (select * from ({stats}) order by d desc, pos limit 5)) top_cardinality_cols,
  keys best_key_guess, (select count(*) from {name}) - n best_key_dupes,
  round(n / (select count(*) from {name}), 6) best_key_uniqueness_ratio, cast(null as varchar) error
from ({found})"""


REPORT_SQL = f"with {GREEDY} {' union all '.join(_report_part(n) for n in _REPORTED)}"


def _report(spark, sf_dir):
    return profile.profile_report(spark, {n: table(spark, sf_dir, n) for n in _REPORTED})


@query("profile_report", REPORT_SQL)
def _profile_report(spark, sf_dir):
    return _report(spark, sf_dir)


_DATE_PARTS = "regexp_matches(coalesce(parts[{0}], ''), 'date|dt|time|timestamp|from|through|start|end')"
_DATE_KEY = " ".join(f"when {_DATE_PARTS.format(i)} then parts[{i}]" for i in range(1, 7))
_KEY_COLUMNS = ", ".join(f"coalesce(parts[{i}], '') key_col_{i}" for i in range(1, 7))


@query(
    "join_key_report",
    f"""with r as ({REPORT_SQL}), k as (select *, string_split(best_key_guess, '|')[1:6] parts from r)
select k.* exclude (parts), {_KEY_COLUMNS}, parts[1] hub_key, case {_DATE_KEY} else '' end date_key from k""",
)
def _join_key_report(spark, sf_dir):
    return profile.join_key_report(_report(spark, sf_dir))
