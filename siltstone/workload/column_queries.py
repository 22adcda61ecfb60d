"""Cleaning, typing and path expressions over the given tables."""

from __future__ import annotations

from collections.abc import Callable
from datetime import date

from pyspark.sql import Column
from pyspark.sql import functions as F

from siltstone.functions import cleaning as c
from siltstone.functions import paths
from siltstone.workload.inputs import ctes, derived, table
from siltstone.workload.registry import COMPACT, ISO, US, clean, day, key, query, text

IDS = ("l_orderkey", "l_partkey", "l_linenumber", "l_quantity")
_IDS = ", ".join(IDS)
DIRTY = ctes("dirty_lines")


def _lines(name: str, sql_columns: str, columns: Callable[[], dict[str, Column]]):
    """Register a projection of the dirty lines."""

    @query(name, f"{DIRTY} select {_IDS}, {sql_columns} from dirty_lines")
    def run(spark, sf_dir):
        projected = [column.alias(n) for n, column in columns().items()]
        return derived(spark, sf_dir, "dirty_lines").select(*IDS, *projected)

    return run


_IN_TEXT = "regexp_extract(free_text, '([0-9]{1,2}/[0-9]{1,2}/[0-9]{4})', 1)"
_IS_PERIOD = "regexp_full_match(period_text, '[0-9]{8}-[0-9]{8}')"

_lines(
    "key_normalize",
    f"{key('key_text')} facility_key",
    lambda: {"facility_key": c.padded_key("key_text")},
)
_lines("zip_normalize", f"{key('zip_text', 5)} zip", lambda: {"zip": c.zip_code("zip_text")})
_lines(
    "safe_cast",
    "try_cast(int_text as integer) as_int, try_cast(double_text as double) as_double",
    lambda: {
        "as_int": c.to_number("int_text", "int"),
        "as_double": c.to_number("double_text", "double"),
    },
)
_lines(
    "safe_cast_unquoted",
    f"try_cast({clean('quoted_int')} as integer) as_int, try_cast({clean('quoted_int')} as double) as_double",
    lambda: {
        "as_int": c.unquoted_number("quoted_int", "int"),
        "as_double": c.unquoted_number("quoted_int", "double"),
    },
)
_lines(
    "parse_date_single",
    f"{text(day('trim(date_text)', ISO))} parsed",
    lambda: {"parsed": c.parse_date(c.trimmed("date_text"), c.ISO_DATE)},
)
_lines(
    "parse_date_multi",
    f"{text(day('trim(date_text)', ISO, US))} iso_first, {text(day('trim(date_text)', US, ISO))} us_first",
    lambda: {
        "iso_first": c.parse_date(c.trimmed("date_text"), c.ISO_DATE, c.US_DATE),
        "us_first": c.parse_date(c.trimmed("date_text"), c.US_DATE, c.ISO_DATE),
    },
)
_lines(
    "extract_date_from_text",
    f"nullif({_IN_TEXT}, '') found, {text(day(_IN_TEXT, US))} parsed",
    lambda: {"found": c.us_date_text("free_text"), "parsed": c.date_in_text("free_text")},
)
_lines(
    "period_split",
    f"case when {_IS_PERIOD} then {text(day('substr(period_text, 1, 8)', COMPACT))} end period_start, "
    f"case when {_IS_PERIOD} then {text(day('substr(period_text, 10, 8)', COMPACT))} end period_end",
    lambda: dict(zip(("period_start", "period_end"), c.period_bounds("period_text"))),
)
_lines(
    "flag_to_boolean",
    "case when upper(trim(flag_text)) in ('Y','YES','TRUE','T','1') then true"
    " when upper(trim(flag_text)) in ('N','NO','FALSE','F','0') then false end flag",
    lambda: {"flag": c.flag("flag_text")},
)
_lines(
    "blank_to_null",
    f"nullif({clean('key_text')}, '') key_or_null",
    lambda: {"key_or_null": c.blank_to_null(c.unquoted("key_text"))},
)


@query(
    "pad_missing_columns",
    "select c_custkey, c_name, cast(null as varchar) c_phone, cast(null as double) c_score, 'customer' kind"
    " from customer union all select s_suppkey, s_name, null, s_acctbal, 'supplier' from supplier",
)
def _pad_missing(spark, sf_dir):
    suppliers = table(spark, sf_dir, "supplier").selectExpr(
        "s_suppkey c_custkey", "s_name c_name", "cast(null as string) c_phone", "s_acctbal c_score", "'supplier' kind"
    )
    customers = table(spark, sf_dir, "customer").select("c_custkey", "c_name", F.lit("customer").alias("kind"))
    return c.with_missing_columns(customers, suppliers.schema).unionByName(suppliers)


@query(
    "filter_required",
    f"{DIRTY} select {_IDS}, flag_text, key_text from dirty_lines"
    " where flag_text is not null and key_text is not null and trim(key_text) <> ''",
)
def _filter_required(spark, sf_dir):
    lines = derived(spark, sf_dir, "dirty_lines").select(*IDS, "flag_text", "key_text")
    return c.keep_required(lines, ["flag_text", "key_text"], not_blank=["key_text"])


@query(
    "filter_format",
    f"{DIRTY} select {_IDS}, work_text from dirty_lines where regexp_full_match(trim(work_text), '[0-9]{{8}}')",
)
def _filter_format(spark, sf_dir):
    return derived(spark, sf_dir, "dirty_lines").where(c.is_compact_date("work_text")).select(*IDS, "work_text")


@query(
    "filter_year_and_set",
    "select o_orderkey, o_orderpriority, cast(cast(o_orderdate as date) as varchar) order_day from orders"
    " where cast(o_orderdate as varchar)[1:4] = '1997' and o_orderpriority in ('1-URGENT', '5-LOW')",
)
def _filter_year(spark, sf_dir):
    orders = table(spark, sf_dir, "orders").select(
        "o_orderkey", "o_orderpriority", F.col("o_orderdate").cast("date").cast("string").alias("order_day")
    )
    return c.keep_year_and_members(orders, "order_day", "1997", "o_orderpriority", ["1-URGENT", "5-LOW"])


@query(
    "filter_date_range",
    "select o_orderkey, o_totalprice from orders where o_orderdate >= date '1997-03-01' and o_orderdate < date '1998-03-01'",
)
def _filter_range(spark, sf_dir):
    orders = table(spark, sf_dir, "orders")
    return c.keep_date_range(orders, "o_orderdate", date(1997, 3, 1), date(1998, 3, 1)).select(
        "o_orderkey", "o_totalprice"
    )


@query("add_literal", "select o_orderkey, true as Processed, '2024-02-01' ingest_dt from orders")
def _add_literal(spark, sf_dir):
    return table(spark, sf_dir, "orders").select(
        "o_orderkey", F.lit(True).alias("Processed"), F.lit("2024-02-01").alias("ingest_dt")
    )


@query("reverse_text_if_present", "select c_custkey, reverse(c_name) c_name from customer")
def _reverse(spark, sf_dir):
    customers = table(spark, sf_dir, "customer").select("c_custkey", "c_name")
    return c.with_reversed_text(c.with_reversed_text(customers, "c_name"), "FirstName")


@query(
    "ratio_and_band",
    """with m as (select p_partkey, (40 + p_partkey % 90) / (((140 + p_size) / 100.0) * ((140 + p_size) / 100.0)) bmi
  from part)
select p_partkey, round(bmi, 6) bmi, case when bmi < 18.5 then 'Underweight' when bmi < 25 then 'Normal weight'
  when bmi < 30 then 'Overweight' else 'Obese' end band from m""",
)
def _ratio_band(spark, sf_dir):
    index = c.body_mass(F.col("p_size") + 140, F.col("p_partkey") % 90 + 40)
    parts = table(spark, sf_dir, "part").select("p_partkey", index.alias("bmi"))
    return parts.withColumn("band", c.body_mass_band("bmi")).withColumn("bmi", F.round("bmi", 6))


@query(
    "guarded_ratio",
    "select l_orderkey, l_linenumber, l_partkey, case when coalesce(l_discount, 0) > 0"
    " then round(l_quantity / l_discount, 4) end ratio from lineitem",
)
def _guarded(spark, sf_dir):
    return table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_partkey",
        F.round(c.guarded_ratio("l_quantity", "l_discount"), 4).alias("ratio"),
    )


@query(
    "null_as_zero_product",
    f"{DIRTY} select {_IDS}, round(coalesce(try_cast(double_text as double), 0)"
    " * coalesce(try_cast(int_text as double), 0), 4) product from dirty_lines",
)
def _null_product(spark, sf_dir):
    return derived(spark, sf_dir, "dirty_lines").select(
        *IDS,
        F.round(
            c.product_or_zero(c.to_number("double_text", "double"), c.to_number("int_text", "double")), 4
        ).alias("product"),
    )


@query(
    "struct_counts",
    """with n as (select l_suppkey, count(*) filter (l_returnflag = 'A') a, count(*) filter (l_returnflag = 'N') b,
  count(*) filter (l_returnflag = 'R' and l_tax > 0.06) e from lineitem group by 1)
select l_suppkey, a counts_uploaded, b counts_skipped_unchanged, e counts_errors,
  a + b + e counts_total_files_seen from n""",
)
def _struct_counts(spark, sf_dir):
    per = _supplier_counts(spark, sf_dir)
    return per.select(
        "l_suppkey",
        c.counts_struct(uploaded=F.col("a"), skipped_unchanged=F.col("b"), errors=F.col("e")).alias("counts"),
    )


def _supplier_counts(spark, sf_dir):
    flag = F.col("l_returnflag")
    return table(spark, sf_dir, "lineitem").groupBy("l_suppkey").agg(
        F.count(F.when(flag == "A", 1)).alias("a"),
        F.count(F.when(flag == "N", 1)).alias("b"),
        F.count(F.when((flag == "R") & (F.col("l_tax") > 0.06), 1)).alias("e"),
    )


@query(
    "status_from_errors",
    """select l_suppkey, case when count(*) filter (l_returnflag = 'R' and l_tax > 0.06) = 0 then 'ok'
  else 'partial_failure' end status from lineitem group by 1""",
)
def _status(spark, sf_dir):
    return _supplier_counts(spark, sf_dir).select("l_suppkey", c.run_status("e").alias("status"))


FILES = ctes("file_names")
_dataset_key_sql = (
    "replace(replace(regexp_replace(regexp_replace(lower(filename), '\\.csv$', ''), '\\.json$', ''), ' ', '_'), '__', '_')"
)


@query("dataset_key_from_name", f"{FILES} select doc_id, filename, {_dataset_key_sql} dataset_key from file_names")
def _dataset_key(spark, sf_dir):
    files = derived(spark, sf_dir, "file_names")
    return files.select("doc_id", "filename", paths.dataset_key("filename").alias("dataset_key"))


_date_in_path_sql = "nullif(regexp_extract(s3_key, '/ingest_dt=([0-9]{4}-[0-9]{2}-[0-9]{2})/', 1), '')"


@query("date_from_path", f"{FILES} select doc_id, {_date_in_path_sql} ingest_dt from file_names")
def _date_from_path(spark, sf_dir):
    files = derived(spark, sf_dir, "file_names")
    return files.select("doc_id", paths.date_in_path("s3_key").alias("ingest_dt"))


@query(
    "path_to_partition_location",
    f"""{FILES} select doc_id,
  case when doc_id % 6 <> 0 then 'lake/' || regexp_replace(s3_key, '[^/]*$', '') end partition_folder,
  case when doc_id % 6 <> 0 then 'lake/' || regexp_replace(s3_key, '/ingest_dt=.*$', '/') end table_folder,
  doc_id % 6 = 0 malformed from file_names""",
)
def _path_locations(spark, sf_dir):
    files = derived(spark, sf_dir, "file_names").withColumn("partition_folder", paths.partition_folder("s3_key", "lake"))
    return files.select(
        "doc_id",
        "partition_folder",
        paths.table_folder("partition_folder").alias("table_folder"),
        F.col("partition_folder").isNull().alias("malformed"),
    )


# --- built-in scalar functions, grouped --------------------------------------------------------


@query(
    "scalar_text",
    f"""with t as (select o_orderkey, '  ' || o_orderpriority || ' ' padded,
    o_orderpriority || '|' || o_orderstatus joined, cast(o_totalprice as varchar) price,
    case when o_orderkey % 3 = 0 then '' else o_orderstatus end maybe_blank,
    case when o_orderkey % 7 = 0 then null else o_orderstatus end maybe_null from orders)
select o_orderkey, trim(padded) trimmed, regexp_replace(padded, '[ -]', '', 'g') replaced,
  lpad(cast(o_orderkey as varchar), 4, '0') padded_key, regexp_extract(padded, '([0-9])-', 1) extracted,
  regexp_matches(price, '^[0-9]+[.][0-9]$') one_decimal, substr(padded, 3, 4) part, upper(lower(padded)) uppered,
  cast(length(padded) as integer) len, nullif(maybe_blank, '') not_blank, padded || maybe_null concatenated,
  price[1:4] head, reverse(padded) reversed, sha256(padded) digest,
  split_part(joined, '|', 1) first_part, split_part(joined, '|', 2) second_part
from t""",
)
def _scalar_text(spark, sf_dir):
    orders = table(spark, sf_dir, "orders")
    status, number = F.col("o_orderstatus"), F.col("o_orderkey")
    padded = F.concat(F.lit("  "), "o_orderpriority", F.lit(" "))
    price = F.col("o_totalprice").cast("string")
    parts = F.split(F.concat_ws("|", "o_orderpriority", "o_orderstatus"), r"\|")
    return orders.select(
        "o_orderkey",
        c.trimmed(padded).alias("trimmed"),
        F.regexp_replace(padded, "[ -]", "").alias("replaced"),
        F.lpad(number.cast("string"), 4, "0").alias("padded_key"),
        F.regexp_extract(padded, "([0-9])-", 1).alias("extracted"),
        price.rlike("^[0-9]+[.][0-9]$").alias("one_decimal"),
        F.substring(padded, 3, 4).alias("part"),
        F.upper(F.lower(padded)).alias("uppered"),
        F.length(padded).alias("len"),
        F.nullif(F.when(number % 3 == 0, "").otherwise(status), F.lit("")).alias("not_blank"),
        F.concat(padded, F.when(number % 7 != 0, status)).alias("concatenated"),
        c.prefix(price, 4).alias("head"),
        F.reverse(padded).alias("reversed"),
        F.sha2(padded, 256).alias("digest"),
        F.get(parts, F.lit(0)).alias("first_part"),
        F.get(parts, F.lit(1)).alias("second_part"),
    )


@query(
    "scalar_cast",
    f"""{DIRTY} select {_IDS}, try_cast(int_text as integer) safe_int, cast(l_orderkey as varchar) as_text,
  cast(l_quantity as varchar) double_text, coalesce(try_cast(int_text as integer), -1) int_or_default,
  {text(day('trim(date_text)', US))} us_day,
  case when l_linenumber in (1, 2) then 'low' when l_linenumber in (3, 4) then 'mid' end band from dirty_lines""",
)
def _scalar_cast(spark, sf_dir):
    as_int = c.to_number("int_text", "int")
    line = F.col("l_linenumber")
    return derived(spark, sf_dir, "dirty_lines").select(
        *IDS,
        as_int.alias("safe_int"),
        F.col("l_orderkey").cast("string").alias("as_text"),
        F.col("l_quantity").cast("string").alias("double_text"),
        F.coalesce(as_int, F.lit(-1)).alias("int_or_default"),
        c.parse_date(c.trimmed("date_text"), c.US_DATE).alias("us_day"),
        F.when(line.isin(1, 2), "low").when(line.isin(3, 4), "mid").alias("band"),
    )


@query(
    "scalar_date",
    """with t as (select o_orderkey, cast(o_orderdate as date) d from orders)
select o_orderkey, cast(date_diff('day', date '1995-01-01', d) as integer) days_in,
  cast(cast(d + 30 as date) as varchar) next_day, strftime(d, '%Y%m%d') compact, strftime(d, '%d') dd,
  strftime(d, '%m') mm, strftime(d, '%Y') yyyy, cast(quarter(d) as integer) q,
  cast(len(generate_series(date '1995-01-01', d, interval 30 day)) as integer) steps,
  cast(d as varchar) || ' 05:34:29.935139' wall_time from t""",
)
def _scalar_date(spark, sf_dir):
    day_ = F.col("o_orderdate").cast("date")
    start = F.lit(date(1995, 1, 1))
    return table(spark, sf_dir, "orders").select(
        "o_orderkey",
        F.datediff(day_, start).alias("days_in"),
        F.date_add(day_, 30).alias("next_day"),
        F.date_format(day_, "yyyyMMdd").alias("compact"),
        F.date_format(day_, "dd").alias("dd"),
        F.date_format(day_, "MM").alias("mm"),
        F.date_format(day_, "yyyy").alias("yyyy"),
        F.quarter(day_).alias("q"),
        F.size(F.sequence(start, day_, F.expr("interval 30 days"))).alias("steps"),
        c.iso_wall_time(F.concat(day_.cast("string"), F.lit("T05:34:29.935139+02:00"))).alias("wall_time"),
    )


@query(
    "scalar_nested",
    """select p_partkey, cast(len(string_split(p_name, ' ')) as integer) words, p_name pair_name,
  cast(p_size as bigint) pair_size from part""",
)
def _scalar_nested(spark, sf_dir):
    pair = F.struct(F.col("p_name").alias("name"), F.col("p_size").alias("size")).cast("struct<name:string,size:bigint>")
    return table(spark, sf_dir, "part").select(
        "p_partkey", F.size(F.split("p_name", " ")).alias("words"), pair.alias("pair")
    )
