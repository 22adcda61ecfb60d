"""Sources and sinks: write an input to a fresh folder of the shared storage, read it back."""

from __future__ import annotations

from pyspark.sql import functions as F

from siltstone.operators.incremental import Run, detect_changes, inventory, merge_state
from siltstone.plans import models
from siltstone.plans.ingest import ingest_folder
from siltstone.session import fresh_path
from siltstone.sinks import writers
from siltstone.sources import readers, tasks
from siltstone.sources.files import hash_files
from siltstone.sources.schemas import INGEST_DT, RAW_COLUMNS
from siltstone.workload.inputs import LANDED, RUN_DATE, RUN_TS, ctes, derived, raw, table
from siltstone.workload.model_queries import CHANGES_SQL, FILES_PER_RUN, run_manifests
from siltstone.workload.registry import query

RUN = Run(RUN_DATE, RUN_TS, source="folder", bucket="lake", raw_prefix="raw")
SECOND = "2024-01-08"


def _csv(df, path, **options):
    """CSV as the raw tables hold it: header, quotes escaped by a backslash, blanks kept."""
    (
        df.write.option("header", True)
        .option("escape", "\\")
        .option("ignoreLeadingWhiteSpace", False)
        .option("ignoreTrailingWhiteSpace", False)
        .options(**options)
        .partitionBy(*[c for c in (INGEST_DT,) if c in df.columns])
        .csv(path)
    )
    return path


def _all_columns(dataset: str, given: tuple[str, ...]) -> str:
    missing = [f'"{c}"' for c in RAW_COLUMNS[dataset] if c not in given]
    return ", ".join([*(f'"{c}"' for c in given), *(f"cast(null as varchar) {m}" for m in missing)])


_CLAIMS = (
    "cms_certification_number_ccn", "measure_code", "measure_description", "measure_period", "adjusted_score",
    "observed_score", "footnote_for_score", "resident_type", "used_in_quality_measure_five_star_rating",
)


@query(
    "src_csv_fixed",
    f"{ctes('claims_measures')} select {_all_columns('claims_measures', _CLAIMS)}, '{LANDED}' ingest_dt from claims_measures",
)
def _csv_fixed(spark, sf_dir):
    path = _csv(raw(spark, sf_dir, "claims_measures"), fresh_path(spark, "csv-fixed"))
    return readers.read_fixed_csv(spark, path, "claims_measures")


@query("src_csv_header", f"{ctes('penalties')} select *, '{LANDED}' ingest_dt from penalties")
def _csv_header(spark, sf_dir):
    df = raw(spark, sf_dir, "penalties")
    shown = df.toDF(*(c if c == INGEST_DT else c.title() for c in df.columns))
    return readers.read_headed_csv(spark, _csv(shown, fresh_path(spark, "csv-header")))


_run_number = "cast(regexp_extract(filename, '_([0-9]+)[.]', 1) as bigint) // %d" % FILES_PER_RUN


@query(
    "src_manifest_json",
    f"""{CHANGES_SQL}
select filename, sha256, size_bytes,
  case when size_bytes > 15000 then null when status = 'unchanged' then 'skipped_unchanged' else 'files' end list_name,
  case when size_bytes > 15000 then null when status = 'unchanged' then cast(1 as integer)
    else cast(0 as integer) end list_rank
from changes where size_bytes <= 15000 and {_run_number} % 7 <> 3""",
)
def _manifest_json(spark, sf_dir):
    """Documents one per line, every seventh run's line broken; its files do not appear."""
    documents = run_manifests(spark, sf_dir)
    line = F.to_json(F.struct(*documents.columns))
    broken = F.col("source").cast("bigint") % 7 == 3
    path = fresh_path(spark, "manifest")
    documents.select(F.when(broken, F.concat(F.lit("broken "), line)).otherwise(line).alias("value")).write.text(path)
    entries = readers.manifest_entries(readers.read_manifest(spark, path, one_document=False))
    return entries.select("filename", "sha256", "size_bytes", "list_name", "list_rank")


STATE_SQL = f"""{CHANGES_SQL},
state as (
  select coalesce(c.filename, p.filename) filename, coalesce(c.status, 'carried') status,
    case when c.status <> 'unchanged' then replace(c.filename, '.csv', '') else p.dataset_key end dataset_key,
    case when c.status <> 'unchanged'
      then 'raw/' || replace(c.filename, '.csv', '') || '/ingest_dt={RUN_DATE}/' || c.filename
      else p.s3_key end s3_key,
    coalesce(c.size_bytes, p.size_bytes) size_bytes, coalesce(c.sha256, p.sha256) sha256,
    case when c.status is null then p.data_ingest_dt when c.status <> 'unchanged' then '{RUN_DATE}'
      else coalesce(nullif(p.data_ingest_dt, ''),
        nullif(regexp_extract(p.s3_key, '/ingest_dt=([0-9]{{4}}-[0-9]{{2}}-[0-9]{{2}})/', 1), '')) end data_ingest_dt,
    case when c.status is null then p.last_seen_run_ingest_dt else '{RUN_DATE}' end last_seen_run_ingest_dt,
    case when c.status is null then p.last_seen_run_ts_utc else '{RUN_TS}' end last_seen_run_ts_utc
  from changes c full join files_prior p on c.filename = p.filename)"""
# Objects in the store after the run: those there before, and the landed ones.
INVENTORY_SQL = f"""{STATE_SQL},
stored as (select s3_key from files_prior where object_exists
  union select s3_key from state where status in ('new', 'changed', 'heal')),
inv as (select coalesce(nullif(data_ingest_dt, ''),
    nullif(regexp_extract(s3_key, '/ingest_dt=([0-9]{{4}}-[0-9]{{2}}-[0-9]{{2}})/', 1), '')) ingest_dt,
  '{RUN_DATE}' manifest_run_ingest_dt, '{RUN_TS}' run_ts_utc, 'folder' source, 'lake' bucket, 'raw' raw_prefix,
  filename, dataset_key, s3_key, size_bytes, sha256, last_seen_run_ingest_dt, last_seen_run_ts_utc
  from state where s3_key in (select s3_key from stored))"""


def next_state(spark, sf_dir):
    prior = derived(spark, sf_dir, "files_prior")
    return merge_state(prior, detect_changes(derived(spark, sf_dir, "files_now"), prior), RUN)


def stored_after(spark, sf_dir, state):
    before = derived(spark, sf_dir, "files_prior").where("object_exists").select(F.col("s3_key").alias("path"))
    landed = state.where(F.col("status").isin("new", "changed", "heal")).select(F.col("s3_key").alias("path"))
    return before.unionByName(landed)


def next_inventory(spark, sf_dir):
    state = next_state(spark, sf_dir)
    return inventory(state, stored_after(spark, sf_dir, state), RUN)


@query("src_inventory_jsonl", f"{INVENTORY_SQL} select * from inv")
def _inventory_jsonl(spark, sf_dir):
    path = fresh_path(spark, "inventory")
    writers.write_inventory(next_inventory(spark, sf_dir), path)
    return readers.read_inventory(spark, path)


DOCS_PER_FILE = 50


@query(
    "src_files_hashed",
    f"""with b as (select doc_id // {DOCS_PER_FILE} n, cast(sum(strlen(text) + 1) as bigint) size_bytes,
    sha256(string_agg(text || chr(10), '' order by doc_id)) sha256 from documents group by 1)
select cast(n as varchar) bucket, size_bytes, sha256 from b
union all select 'all', cast(sum(strlen(text) + 1) as bigint), sha256(string_agg(text || chr(10), '' order by doc_id)) from documents
union all select 'empty', cast(0 as bigint), sha256('') from (select 1) one""",
)
def _files_hashed(spark, sf_dir):
    """Documents as text files of at most ``DOCS_PER_FILE`` each, one file of all of them, and an empty one."""
    path = fresh_path(spark, "files")
    documents = table(spark, sf_dir, "documents").select(
        "doc_id", "text", F.floor(F.col("doc_id") / DOCS_PER_FILE).cast("string").alias("bucket")
    )
    placed = documents.repartition("bucket").sortWithinPartitions("bucket", "doc_id").drop("doc_id")
    placed.write.partitionBy("bucket").text(path)
    parts = fresh_path(spark, "parts")
    documents.repartitionByRange("doc_id").sortWithinPartitions("doc_id").select("text").write.text(parts)
    _join_parts(spark, parts, f"{path}/bucket=all/part-0.txt")
    _put(spark, [(f"{path}/bucket=empty/part-0.txt", b"")])
    hashed = hash_files(spark, path, ("txt",))
    return hashed.select(F.regexp_extract("path", "bucket=([a-z0-9]+)", 1).alias("bucket"), "size_bytes", "sha256")


def _join_parts(spark, folder, target):
    """The part files of ``folder`` as one file. One task writes it, for a file is one stream, but holds no more than a block."""
    joined = spark.createDataFrame([(folder, target)], "folder string, target string")
    joined.mapInPandas(tasks.join_parts, joined.schema).write.format("noop").mode("overwrite").save()


def _put(spark, files):
    """Write a few small files below the shared folder."""
    for target, data in files:
        system, inner = tasks.open_path(target)
        system.create_dir(inner.rsplit("/", 1)[0], recursive=True)
        with system.open_output_stream(inner, compression=None) as out:
            out.write(data)


def _text_files(lines, path, ending, encoding="utf-8", head="", between="\n", tail="\n"):
    """The rows of ``lines`` (one text column) as files, one per task, with what stands around and between them."""

    def write(batches):
        from pyspark import TaskContext

        system, inner = tasks.open_path(path)
        system.create_dir(inner, recursive=True)
        with system.open_output_stream(f"{inner}/{TaskContext.get().partitionId()}.{ending}", compression=None) as out:
            out.write(head.encode(encoding))
            mark = ""
            for batch in batches:
                for line in batch.iloc[:, 0]:
                    out.write((mark + line).encode(encoding))
                    mark = between
                yield batch
            out.write(tail.encode(encoding))

    lines.mapInPandas(write, lines.schema).write.format("noop").mode("overwrite").save()


def _quoted_csv(df, path, columns, encoding="utf-8"):
    """CSV files with every set cell quoted and quotes doubled, and a header in each."""
    cells = [F.concat(F.lit('"'), F.replace(c, F.lit('"'), F.lit('""')), F.lit('"')) for c in columns]
    line = F.concat_ws(",", *(F.coalesce(c, F.lit("")) for c in cells))
    _text_files(df.select(line.alias("line")), path, "csv", encoding, head=",".join(f'"{c}"' for c in columns) + "\n")


# What windows-1252 files can hold, among others; the rest is replaced.
_NOT_HELD = r"[^\x00-\x7F\x{A0}-\x{FF}€“”–]"


@query(
    "src_csv_encoding_fallback",
    f"""select cast(doc_id as varchar) doc_id, lang || ' "' || lang || '",' || chr(10) quoted,
  case when doc_id % 2 = 0 then text else regexp_replace(text, '{_NOT_HELD}', '?', 'g') end body,
  '2024-01-' || lpad(cast(1 + doc_id % 28 as varchar), 2, '0') "WorkDate" from documents""",
)
def _encoding_fallback(spark, sf_dir):
    """Whole texts with their line breaks, and quotes; half of them in windows-1252 files of another column order.

    The second half has what its encoding cannot hold replaced; nothing else is changed.
    """
    work = F.concat(F.lit("202401"), F.lpad((F.col("doc_id") % 28 + 1).cast("string"), 2, "0"))
    held = F.regexp_replace("text", _NOT_HELD, "?")
    documents = table(spark, sf_dir, "documents").select(
        F.col("doc_id").cast("string").alias("doc_id"), F.concat("lang", F.lit(' "'), "lang", F.lit('",\n')).alias("quoted"),
        F.when(F.col("doc_id") % 2 == 0, F.col("text")).otherwise(held).alias("body"), work.alias("WorkDate"),
    )
    root = fresh_path(spark, "encodings")
    _quoted_csv(documents.where("doc_id % 2 = 0"), f"{root}/a", ("doc_id", "quoted", "body", "WorkDate"))
    _quoted_csv(documents.where("doc_id % 2 = 1"), f"{root}/b", ("WorkDate", "body", "doc_id", "quoted"), "cp1252")
    return readers.read_csv_any_encoding(spark, root)


@query(
    "src_by_extension",
    """select cast(o_orderkey as varchar) o_orderkey, o_orderstatus,
  case when o_orderkey % 4 <> 1 then o_orderpriority end o_orderpriority,
  case when o_orderkey % 4 = 3 then cast(o_custkey as varchar) end o_custkey from orders""",
)
def _by_extension(spark, sf_dir):
    """Even orders as CSV under two headers, odd ones as JSON: objects one after the other, and pretty-printed arrays."""
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_orderstatus", "o_orderpriority", "o_custkey")
    root = fresh_path(spark, "mixed")
    csv = orders.drop("o_custkey").withColumn("o_orderkey", F.col("o_orderkey").cast("string"))
    _quoted_csv(csv.where("o_orderkey % 4 = 0"), f"{root}/a", csv.columns)
    _quoted_csv(csv.where("o_orderkey % 4 = 2"), f"{root}/b", csv.columns[::-1])
    orders.where("o_orderkey % 4 = 1").drop("o_orderpriority", "o_custkey").write.json(f"{root}/c")
    last = orders.where("o_orderkey % 4 = 3").select(F.to_json(F.struct(*orders.columns), {"pretty": "true"}).alias("value"))
    _text_files(last, f"{root}/d", "json", head="[\n", between=",\n", tail="\n]\n")
    return readers.read_by_extension(spark, root).drop("source_file")


@query(
    "src_json_series",
    """select l_suppkey, strftime(l_shipdate, '%Y-%m') as date, count(*) cases,
  count(*) filter (l_returnflag = 'R') deaths, cast(sum(l_quantity) as bigint) recovered
from lineitem group by 1, 2""",
)
def _json_series(spark, sf_dir):
    """A document per supplier with three month-to-number objects, and back to rows."""
    month = F.date_format("l_shipdate", "yyyy-MM")
    monthly = table(spark, sf_dir, "lineitem").groupBy("l_suppkey", month.alias("date")).agg(
        F.count("*").alias("cases"),
        F.count(F.when(F.col("l_returnflag") == "R", 1)).alias("deaths"),
        F.sum("l_quantity").cast("bigint").alias("recovered"),
    )
    # One entry per calendar month, so a supplier's list is short however many rows it has.
    names = ("cases", "deaths", "recovered")
    documents = monthly.groupBy("l_suppkey").agg(
        F.array_sort(F.collect_list(F.struct("date", *names))).alias("months")
    )
    maps = [
        F.map_from_arrays("months.date", f"months.{n}").alias(n) for n in names
    ]
    path = fresh_path(spark, "series")
    documents.select(F.to_json(F.struct("l_suppkey", *maps)).alias("value")).write.text(path)
    text = spark.read.text(path).withColumn("l_suppkey", F.get_json_object("value", "$.l_suppkey").cast("bigint"))
    return readers.series_rows(text, "value", names).drop("value")


FILES_PER_FOLDER = 1_000
_NAMED = """case when doc_id % 50 = 0 then 'clash ' || cast(doc_id % 100 as varchar) || '.csv'
    when doc_id % 7 = 0 then 'a#' || cast(doc_id as varchar) || '?.CSV' when doc_id % 7 = 1 then cast(doc_id as varchar) || '%20é+.json'
    else cast(doc_id as varchar) || '.csv' end"""


@query(
    "ingest_runs",
    f"""with d as (select doc_id, {_NAMED} filename, case when doc_id % 11 = 0 then '' else text end body from documents),
one as (select filename, sha256(body) sha256, min(strlen(body)) size_bytes from d group by 1, 2),
n as (select *, count(*) over (partition by filename) contents from one),
r as (select 1 run union all select 2)
select run, filename, sha256, cast(size_bytes as bigint) size_bytes,
  case when contents > 1 then 'errors' when run = 1 then 'files' else 'skipped_unchanged' end list_name,
  case when contents > 1 then cast(contents as varchar) || ' files of this name differ' end error from n, r""",
)
def _ingest_runs(spark, sf_dir):
    """Documents as files with odd names, empty ones among them, some of one name; ingested twice, the second run twice."""
    documents = table(spark, sf_dir, "documents").select(
        "doc_id", F.expr(_NAMED.replace("varchar", "string")).alias("filename"),
        F.when(F.col("doc_id") % 11 == 0, "").otherwise(F.col("text")).alias("body"),
    )
    source, lake = fresh_path(spark, "drop"), fresh_path(spark, "lake")
    # A folder takes a block of the disk, as much as most texts: only files whose name others may have get one each.
    shared = F.pmod(F.xxhash64("doc_id"), F.lit(max(1, -(-documents.count() // FILES_PER_FOLDER))))
    own = F.when(F.col("doc_id") % 50 == 0, F.col("doc_id").cast("string"))
    documents = documents.withColumn("folder", F.concat_ws("/", (shared % 5).cast("string"), shared.cast("string"), own))

    def put(batches):
        for batch in batches:
            for folder, name, body in zip(batch["folder"], batch["filename"], batch["body"]):
                system, inner = tasks.open_path(f"{source}/{folder}")
                system.create_dir(inner, recursive=True)
                with system.open_output_stream(f"{inner}/{name}", compression=None) as out:
                    out.write(body.encode())
            yield batch

    documents.mapInPandas(put, documents.schema).write.format("noop").mode("overwrite").save()
    for day in ("2024-02-01", "2024-02-08", "2024-02-08"):
        ingest_folder(spark, source, lake, Run(day, f"{day}T05:00:00+00:00"))
    entries = spark.read.schema(
        f"filename string, sha256 string, size_bytes long, list_name string, error string, {INGEST_DT} string"
    ).json(f"{lake}/control/runs")
    run = F.when(F.col(INGEST_DT) == "2024-02-01", 1).otherwise(2).alias("run")
    return entries.select(run, "filename", "sha256", "size_bytes", "list_name", "error")


@query("src_table", "select * from part")
def _table(spark, sf_dir):
    return table(spark, sf_dir, "part")


@query("src_partition_prune", f"{ctes('survey_dates')} select *, cast(null as varchar) processing_date, '{SECOND}' ingest_dt from survey_dates")
def _prune(spark, sf_dir):
    path = fresh_path(spark, "dates")
    for landed in (LANDED, SECOND):
        raw(spark, sf_dir, "survey_dates", landed).write.mode("append").partitionBy(INGEST_DT).parquet(path)
    stored = spark.read.schema(raw(spark, sf_dir, "survey_dates").schema).parquet(path)
    return readers.at_date(stored, SECOND)


# --- sinks --------------------------------------------------------------------------------------


@query("sink_replace_partitioned", f"{ctes('survey_dates')} select *, cast(null as varchar) processing_date, '{SECOND}' ingest_dt from survey_dates")
def _replace_partitioned(spark, sf_dir):
    """The second build replaces the first one's table with all its partitions."""
    path = fresh_path(spark, "replaced")
    for landed in (LANDED, SECOND):
        writers.replace_table(raw(spark, sf_dir, "survey_dates", landed), path, sources=[sf_dir])
    return spark.read.schema(raw(spark, sf_dir, "survey_dates").schema).parquet(path)


@query("sink_replace_plain", "select c_custkey, c_name from customer")
def _replace_plain(spark, sf_dir):
    path = fresh_path(spark, "plain")
    customers = table(spark, sf_dir, "customer")
    for df in (customers, customers.select("c_custkey", "c_name")):
        writers.replace_table(df, path, partition=None, sources=[sf_dir])
    return spark.read.parquet(path)


_KEYED_SQL = f"""select o_orderkey, o_totalprice,
  case when o_orderkey % 3 = 0 then 'urgent' else lower(replace(o_orderpriority, ' ', '_')) end dataset_key,
  '{LANDED}' ingest_dt from orders"""


def _keyed(spark, sf_dir):
    """Orders as rows of datasets; one dataset holds more than a third of them."""
    name = F.lower(F.replace("o_orderpriority", F.lit(" "), F.lit("_")))
    return table(spark, sf_dir, "orders").select(
        "o_orderkey", "o_totalprice",
        F.when(F.col("o_orderkey") % 3 == 0, "urgent").otherwise(name).alias("dataset_key"),
        F.lit(LANDED).alias(INGEST_DT),
    )


@query("sink_land_raw", _KEYED_SQL)
def _land_raw(spark, sf_dir):
    path = fresh_path(spark, "raw")
    rows = _keyed(spark, sf_dir)
    for part in (0, 1):
        writers.land_raw(rows.where(F.col("o_orderkey") % 2 == part), path)
    return spark.read.schema(rows.schema).parquet(path)


@query(
    "sink_manifest_archive_latest",
    f"""{STATE_SQL} select filename, dataset_key, s3_key, size_bytes, sha256, data_ingest_dt,
  last_seen_run_ingest_dt, last_seen_run_ts_utc, 'latest' place from state
union all select filename, dataset_key, s3_key, size_bytes, sha256, data_ingest_dt,
  last_seen_run_ingest_dt, last_seen_run_ts_utc, 'archive' from files_prior""",
)
def _manifest_sink(spark, sf_dir):
    """Two runs: the first one's state stays in its archive, latest holds the second one's."""
    root = fresh_path(spark, "manifests")
    columns = [c for c in next_state(spark, sf_dir).columns if c != "status"]
    prior = derived(spark, sf_dir, "files_prior").select(columns)
    archive, _ = writers.write_manifest(prior, root, ingest_dt="2024-01-15", run_id="1")
    _, latest = writers.write_manifest(
        next_state(spark, sf_dir).select(columns), root, ingest_dt=RUN_DATE, run_id="2"
    )
    reader = spark.read.schema(prior.schema)
    return reader.json(latest).withColumn("place", F.lit("latest")).unionByName(
        reader.json(archive).withColumn("place", F.lit("archive"))
    )


@query("sink_inventory_jsonl", f"{INVENTORY_SQL} select dataset_key, ingest_dt, filename, sha256 from inv")
def _inventory_sink(spark, sf_dir):
    path = fresh_path(spark, "inventory")
    writers.write_inventory(next_inventory(spark, sf_dir), path)
    return spark.read.schema("dataset_key string, ingest_dt string, filename string, sha256 string").json(path)


@query(
    "sink_quarantine",
    f"""with k as ({_KEYED_SQL})
select *, case when o_totalprice > 400000 then 'price above limit' end error,
  case when o_totalprice > 400000 then 'quarantine' else 'kept' end place from k""",
)
def _quarantine(spark, sf_dir):
    path = fresh_path(spark, "quarantine")
    judged = _keyed(spark, sf_dir).withColumn("error", F.when(F.col("o_totalprice") > 400000, "price above limit"))
    kept = writers.quarantine(judged, path)
    bad = spark.read.schema(judged.schema).json(path)
    return kept.withColumn("error", F.lit(None).cast("string")).withColumn("place", F.lit("kept")).unionByName(
        bad.withColumn("place", F.lit("quarantine"))
    )


@query(
    "sink_csv_report",
    "select cast(c_custkey as varchar) c_custkey, ' \"' || c_name || '\", ' c_name, cast(c_nationkey as varchar) c_nationkey from customer",
)
def _csv_report(spark, sf_dir):
    path = fresh_path(spark, "report")
    name = F.concat(F.lit(' "'), "c_name", F.lit('", '))
    writers.write_csv_report(
        table(spark, sf_dir, "customer").select("c_custkey", name.alias("c_name"), "c_nationkey"), path
    )
    return spark.read.option("header", True).option("escape", '"').csv(path)


@query(
    "sink_append_row",
    """with o as (select o_orderkey % 2 half, o_totalprice as value, o_orderkey from orders),
n as (select count(*) c from o where half = 0)
select cast(row_number() over (partition by half order by o_orderkey) + case when half = 1 then c else 0 end as bigint) id,
  value, o_orderkey, true has_time from o, n""",
)
def _append_row(spark, sf_dir):
    """Two appends; ids of the second go on where the first ended."""
    path = fresh_path(spark, "appended")
    rows = table(spark, sf_dir, "orders").select("o_orderkey", F.col("o_totalprice").alias("value"))
    for half in (0, 1):
        writers.append_rows(rows.where(F.col("o_orderkey") % 2 == half), path, ["o_orderkey"])
    stored = spark.read.parquet(path)
    return stored.select("id", "value", "o_orderkey", F.col("timestamp").isNotNull().alias("has_time"))


@query(
    "sink_layers",
    """with f as (select c_custkey, c_name, c_mktsegment from customer)
select cast(c_custkey as varchar) c_custkey, c_name "FirstName", c_mktsegment source_file, null "Processed", 'raw' layer from f
union all select cast(c_custkey as varchar), c_name, c_mktsegment, 'true', 'refined' from f
union all select cast(c_custkey as varchar), reverse(c_name), c_mktsegment, 'true', 'curated' from f""",
)
def _layers(spark, sf_dir):
    root = fresh_path(spark, "layers")
    customers = table(spark, sf_dir, "customer").select(
        "c_custkey", F.col("c_name").alias("FirstName"), F.col("c_mktsegment").alias("source_file")
    )
    writers.write_layers(customers, root)
    layers = None
    for layer in ("raw", "refined", "curated"):
        df = spark.read.option("header", True).csv(f"{root}/{layer}").withColumn("layer", F.lit(layer))
        layers = df if layers is None else layers.unionByName(df, allowMissingColumns=True)
    return layers


@query(
    "run_ledger",
    f"""{CHANGES_SQL},
m as (select {_run_number} run, count(*) filter (status <> 'unchanged' and size_bytes <= 15000) u,
  count(*) filter (status = 'unchanged' and size_bytes <= 15000) s, count(*) filter (size_bytes > 15000) e
  from changes group by 1)
select run_ts_utc, case when e = 0 then 'ok' else 'partial_failure' end status,
  'control/' || cast(run as varchar) || '/manifest.json' manifest_s3_key, u counts_uploaded,
  s counts_skipped_unchanged, e counts_errors, u + s + e counts_total_files_seen, ingest_dt
from m, (values ('{RUN_TS}', '{RUN_DATE}'), ('2024-02-08T05:00:00+00:00', '2024-02-08')) r(run_ts_utc, ingest_dt)""",
)
def _run_ledger(spark, sf_dir):
    """The ledger after two runs over the same manifests."""
    path = fresh_path(spark, "ledger")
    key = F.concat(F.lit("control/"), "source", F.lit("/manifest.json"))
    for stamp, day in ((RUN_TS, RUN_DATE), ("2024-02-08T05:00:00+00:00", "2024-02-08")):
        manifests = run_manifests(spark, sf_dir).withColumns({"run_ts_utc": F.lit(stamp), "ingest_dt": F.lit(day)})
        ledger = models.control_watermark(manifests, key)
        writers.append_ledger(ledger, path)
    return spark.read.schema(ledger.schema).parquet(path).drop("run_ts")


@query("sink_view", "select o_orderstatus, count(*) order_cnt from orders group by 1")
def _view(spark, sf_dir):
    writers.publish_view(table(spark, sf_dir, "orders").select("o_orderstatus"), "siltstone_orders")
    return spark.sql("select o_orderstatus, count(*) order_cnt from siltstone_orders group by 1")
