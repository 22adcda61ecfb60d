"""Readers for the raw, control and example inputs. All of them stay lazy and splittable."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from siltstone.functions.cleaning import COMPACT_DATE, parse_date
from siltstone.session import written
from siltstone.sources import tasks
from siltstone.sources.files import ending_of, list_files
from siltstone.sources.schemas import INGEST_DT, INVENTORY, MANIFEST, RAW_COLUMNS, text_schema

# Manifest lists in order of precedence.
MANIFEST_LISTS = ("files", "skipped_unchanged", "files_uploaded", "all_files")

# No cell holds this text, so that a quoted empty cell stays '' instead of becoming NULL.
_NO_NULL_TEXT = "\x00"


def _csv(spark: SparkSession):
    return (
        spark.read.option("header", True)
        .option("quote", '"')
        .option("escape", "\\")
        .option("nullValue", _NO_NULL_TEXT)
        .option("emptyValue", "")
    )


def read_fixed_csv(
    spark: SparkSession, path: str, dataset: str, *, partitioned: bool = True, empties: str = "null"
) -> DataFrame:
    """Raw table with a fixed all-text schema; the header line is skipped, columns go by position.

    A quoted empty cell is ``''``, an unquoted one NULL. ``empties="blank"`` makes both ``''``; cells a
    short row lacks then become ``''`` too, since they look the same to the reader.
    """
    schema = text_schema(RAW_COLUMNS[dataset], INGEST_DT if partitioned else None)
    df = _csv(spark).schema(schema).csv(path)
    return df.fillna("", subset=list(RAW_COLUMNS[dataset])) if empties == "blank" else df


def read_headed_csv(spark: SparkSession, path: str) -> DataFrame:
    """CSV whose column names come from the header (lower-cased, spaces kept); every column is text.

    The header line of every file is checked against the first one's.
    """
    names = _csv(spark).csv(path).columns
    df = _csv(spark).schema(text_schema(tuple(names), None)).option("enforceSchema", False).csv(path)
    return df.toDF(*(name.lower() for name in names))


def at_date(df: DataFrame, ingest_dt: str) -> DataFrame:
    """One landing date; a literal on the partition column, so only that folder is read."""
    return df.where(F.col(INGEST_DT) == ingest_dt)


def read_manifest(spark: SparkSession, path: str, *, one_document: bool = True) -> DataFrame:
    """Manifest documents with their arrays of structs; what cannot be parsed reads as NULL."""
    return spark.read.schema(MANIFEST).option("mode", "PERMISSIVE").option("multiLine", one_document).json(path)


def manifest_entries(manifest: DataFrame) -> DataFrame:
    """One row per listed file: the list, its precedence, the place in it, and the file's fields.

    The lists are put end to end and unfolded once, so the documents are parsed once.
    """
    entries = {name: manifest.schema[name].dataType.elementType for name in MANIFEST_LISTS}
    fields = {f.name: f.dataType for entry in entries.values() for f in entry.fields}

    def unfolded(rank: int, name: str) -> Column:
        own = set(entries[name].names)

        def entry(e: Column, place: Column) -> Column:
            return F.struct(
                F.lit(name).alias("list_name"),
                F.lit(rank).alias("list_rank"),
                place.alias("list_position"),
                *((e[f] if f in own else F.lit(None).cast(t)).alias(f) for f, t in fields.items()),
            )

        return F.transform(name, entry)

    lists = F.flatten(F.array_compact(F.array(*(unfolded(i, name) for i, name in enumerate(MANIFEST_LISTS)))))
    return manifest.select(F.inline(lists))


def read_inventory(spark: SparkSession, path: str) -> DataFrame:
    """Flat file inventory, one JSON object per line; malformed lines read as NULL rows."""
    return spark.read.schema(INVENTORY).option("mode", "PERMISSIVE").json(path)


#: Bytes of a file that one task reads records from.
BLOCK_BYTES = 16 << 20


def _file_blocks(files: DataFrame, block_bytes: int) -> DataFrame:
    """One row per block of each file, dealt out one block a task; files without a byte have none."""
    size = F.col("size_bytes")
    first = F.explode(F.sequence(F.lit(0).cast("long"), size - 1, F.lit(block_bytes).cast("long"))).alias("lo")
    blocks = files.where(size > 0).select("path", "size_bytes", first)
    blocks = written(blocks.withColumn("hi", F.least(F.col("lo") + block_bytes, size)), "file-blocks")
    return blocks.repartition(max(1, blocks.count()), "path", "lo")


def _csv_records(spark: SparkSession, files: DataFrame, block_bytes: int) -> tuple[DataFrame, list[list[str]]]:
    """(path, header_id, cells) of every record of the files, and the distinct headers."""
    blocks = _file_blocks(files, block_bytes)
    facts = blocks.mapInPandas(
        tasks.csv_facts, "path string, lo long, utf8 boolean, header binary, from_outside boolean, from_inside boolean"
    )
    states = written(
        facts.groupBy("path").applyInPandas(
            tasks.csv_states, "path string, lo long, inside boolean, utf8 boolean, header binary"
        ),
        "csv-states",
    )
    # One row per distinct header, not per file.
    found = states.where("lo = 0").groupBy("header", "utf8").agg(F.min("path").alias("path")).orderBy("path").collect()
    headers = [tasks.header_cells(bytes(row["header"]), row["utf8"]) for row in found]
    known = spark.createDataFrame(
        [(i, bytes(row["header"]), row["utf8"]) for i, row in enumerate(found)], "header_id int, header binary, utf8 boolean"
    )
    placed = blocks.join(states.join(known, ["header", "utf8"]).drop("header"), ["path", "lo"])
    dealt = placed.repartition(max(1, states.count()), "path", "lo")
    return dealt.mapInPandas(tasks.csv_rows, "path string, header_id int, cells array<string>"), headers


def _by_header(records: DataFrame, headers: list[list[str]], kept: dict[str, str]) -> DataFrame:
    """A column for each name of any header, filled from where the record's own header has it.

    The first of two columns of one name counts. ``kept`` renames columns of ``records`` to carry along.
    """
    places: dict[str, dict[int, int]] = {}
    for i, header in enumerate(headers):
        for place, name in enumerate(header):
            places.setdefault(name, {}).setdefault(i, place)

    def cell(name: str) -> Column:
        by_place: dict[int, list[int]] = {}
        for header, place in places[name].items():
            by_place.setdefault(place, []).append(header)
        value = F.lit(None).cast("string")
        for place, owners in by_place.items():
            value = F.when(F.col("header_id").isin(owners), F.get("cells", F.lit(place))).otherwise(value)
        return value.alias(name)

    carried = [F.col(c).alias(name) for c, name in kept.items()]
    return records.select(*(cell(name) for name in places), *carried)


def read_csv_any_encoding(
    spark: SparkSession,
    path: str,
    *,
    date_columns: Mapping[str, str] | None = None,
    block_bytes: int = BLOCK_BYTES,
) -> DataFrame:
    """CSV files below ``path`` that are UTF-8, or windows-1252 where a file is not valid UTF-8.

    Quotes are doubled inside of quotes, and cells may hold line breaks. Each file has its own header, and columns
    meet by name; a file without a column gives NULL. Files are cut into blocks: a first pass finds how each
    block turns the state inside or outside of quotes, the states are combined block after block, and then each task
    reads the records that begin in its block. A file's encoding is the verdict over all its blocks.

    Columns stay text, but for those in ``date_columns`` (name to pattern). An unquoted empty cell is NULL, a quoted
    one ``''``; cells a short record lacks are NULL, and cells beyond the header are left out. Blank lines are no records.
    """
    date_columns = {"WorkDate": COMPACT_DATE} if date_columns is None else date_columns
    records, headers = _csv_records(spark, list_files(spark, path, ("csv",)), block_bytes)
    df = _by_header(records, headers, {})
    return df.select(
        *(parse_date(F.col(f"`{c}`"), date_columns[c]).alias(c) if c in date_columns else F.col(f"`{c}`") for c in df.columns)
    )


def _json_objects(files: DataFrame, block_bytes: int) -> DataFrame:
    """(path, fields) of every object of the files, fields as (name, text) in their order."""
    blocks = _file_blocks(files, block_bytes)
    facts = blocks.mapInPandas(
        tasks.json_facts,
        "path string, lo long, utf8 boolean, first string, from_outside boolean, from_inside boolean, "
        "deeper_outside long, deeper_inside long",
    )
    states = written(
        facts.groupBy("path").applyInPandas(
            tasks.json_states, "path string, lo long, inside boolean, depth long, utf8 boolean, first string"
        ),
        "json-states",
    )
    dealt = blocks.join(states, ["path", "lo"]).repartition(max(1, states.count()), "path", "lo")
    return dealt.mapInPandas(tasks.json_rows, "path string, fields map<string, string>")


def read_by_extension(spark: SparkSession, root: str, *, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """All CSV and JSON files below ``root`` as one text frame with the file they came from (``source_file``).

    CSV is read as by ``read_csv_any_encoding``. A JSON file is one array of objects, or objects one after the other;
    it is cut into blocks as well, by string state and depth, so an array is never one row. Numbers keep their
    spelling, nested values are JSON text. Columns meet by name. Any other file ending is refused, as is an empty folder.
    Files whose names begin with ``_`` or ``.``, as Spark's own markers do, are not looked at.
    """
    files = written(list_files(spark, root).where(~F.col("path").rlike(r"/[._][^/]*$")), "files")
    endings = files.select(ending_of("path").alias("ending")).groupBy("ending").count()
    known = F.col("ending").isin("csv", "json")
    row = endings.agg(F.collect_set(F.when(known, F.col("ending"))), F.min(F.when(~known, F.col("ending")))).first()
    found = set(row[0])  # at most the two known ones
    if row[1] is not None or not found:
        raise ValueError(f"Unsupported file format: {'no files' if row[1] is None else repr(row[1])}")
    frames = []
    if "csv" in found:
        records, headers = _csv_records(spark, files.where(ending_of("path") == "csv"), block_bytes)
        frames.append(_by_header(records, headers, {"path": "source_file"}))
    if "json" in found:
        objects = written(_json_objects(files.where(ending_of("path") == "json"), block_bytes), "json-objects")
        names = objects.select(F.posexplode(F.map_keys("fields"))).groupBy("col").agg(F.min("pos").alias("pos"))
        columns = [r["col"] for r in names.orderBy("pos", "col").collect()]  # one row per column
        frames.append(
            objects.select(*(F.try_element_at("fields", F.lit(c)).alias(c) for c in columns), F.col("path").alias("source_file"))
        )
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)


def series_rows(df: DataFrame, document: str, series: Sequence[str], key: str = "date") -> DataFrame:
    """JSON text holding one key-to-number object per series, as one row per key.

    Where all series list the same keys in the same order (the usual case) they are zipped by
    position in one pass; otherwise each value is looked up by every key that any series lists, and is
    NULL where its series lacks the key.
    """
    schema = T.StructType([T.StructField(s, T.MapType(T.StringType(), T.LongType())) for s in series])
    parsed = df.withColumn("_doc", F.from_json(document, schema))
    keys = F.map_keys(f"_doc.{series[0]}")
    aligned = F.lit(True)
    for s in series[1:]:
        aligned = aligned & (F.map_keys(f"_doc.{s}") == keys)
    zipped = F.transform(
        F.arrays_zip(keys.alias("k"), *(F.map_values(f"_doc.{s}").alias(s) for s in series)),
        lambda e: F.struct(e["k"].alias(key), *(e[s].alias(s) for s in series)),
    )
    every = reduce(
        F.array_union, (F.coalesce(F.map_keys(f"_doc.{s}"), F.array().cast("array<string>")) for s in series)
    )
    looked_up = F.transform(
        every, lambda k: F.struct(k.alias(key), *(F.try_element_at(f"_doc.{s}", k).alias(s) for s in series))
    )
    rows = parsed.withColumn("_row", F.explode(F.when(F.coalesce(aligned, F.lit(False)), zipped).otherwise(looked_up)))
    return rows.select(*df.columns, F.col(f"_row.{key}"), *(F.col(f"_row.{s}") for s in series))
