from __future__ import annotations

import hashlib
import subprocess
import sys

import pytest
from pyspark import cloudpickle

from siltstone.sources import readers
from siltstone.sources import tasks
from siltstone.sources.files import copy_files, hash_files, list_files, with_stored_objects
from siltstone.sources.schemas import RAW_COLUMNS


def put(folder, name, data):
    path = folder / name
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_bytes(data if isinstance(data, bytes) else data.encode())
    return str(folder)


@pytest.mark.parametrize("dataset", sorted(RAW_COLUMNS))
def test_fixed_csv_reads_every_dataset_by_position(spark, tmp_path, dataset):
    columns = RAW_COLUMNS[dataset]
    line = ",".join(f'"v{i}, ""x"""'.replace('""', '\\"') for i in range(len(columns)))
    put(tmp_path, "ingest_dt=2024-01-02/a.csv", f"{'h,' * (len(columns) - 1)}h\n{line}\n")
    df = readers.read_fixed_csv(spark, str(tmp_path), dataset)
    assert df.columns == [*columns, "ingest_dt"]
    row = df.first()
    assert row[0] == 'v0, "x"' and row[len(columns) - 1] == f'v{len(columns) - 1}, "x"'
    assert row["ingest_dt"] == "2024-01-02"


def test_empty_cells(spark, tmp_path):
    path = put(tmp_path, "a.csv", 'a,b,c,d,e\n1,"",,x\n')
    read = lambda **kw: readers.read_fixed_csv(spark, path, "survey_dates", partitioned=False, **kw).first()
    assert tuple(read()) == ("1", "", None, "x", None)
    assert tuple(read(empties="blank")) == ("1", "", "", "x", "")


def test_partition_date_stays_text_and_prunes(spark, tmp_path):
    for day in ("2024-01-01", "2024-01-08"):
        put(tmp_path, f"ingest_dt={day}/a.csv", f"a,b,c,d,e\n{day},,,,\n")
    df = readers.at_date(readers.read_fixed_csv(spark, str(tmp_path), "survey_dates"), "2024-01-08")
    assert [r[0] for r in df.collect()] == ["2024-01-08"]
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(ingest_dt" in plan


def test_headed_csv(spark, tmp_path):
    path = put(tmp_path, "a.csv", "Penalty Date,Fine Amount\n1/2/2024,\"1,000\"\n")
    df = readers.read_headed_csv(spark, path)
    assert df.columns == ["penalty date", "fine amount"]
    assert df.select("`fine amount`").first()[0] == "1,000"


def test_manifest_document_and_malformed_one(spark, tmp_path):
    good = '{"ingest_dt":"2024-01-01","files":[{"filename":"a.csv","sha256":"1"}],\n "errors":[],"skipped_unchanged":[{"filename":"b.csv","sha256":"2","size_bytes":5}]}'
    put(tmp_path, "good.json", good)
    put(tmp_path, "bad.json", "{broken")
    entries = readers.manifest_entries(readers.read_manifest(spark, str(tmp_path)))
    found = {(r.list_name, r.list_rank, r.filename, r.sha256, r.size_bytes) for r in entries.collect()}
    assert found == {("files", 0, "a.csv", "1", None), ("skipped_unchanged", 1, "b.csv", "2", 5)}


def test_inventory_tolerates_bad_lines(spark, tmp_path):
    path = put(tmp_path, "files.jsonl", '{"filename":"a.csv","size_bytes":7}\nnot json\n')
    assert {(r.filename, r.size_bytes) for r in readers.read_inventory(spark, path).collect()} == {
        ("a.csv", 7), (None, None),
    }


def test_hashes_of_whole_files(spark, tmp_path):
    contents = {"a.csv": b"x" * 3_000_000, "sub/b c+d.JSON": b"{}", "e.CSV": b"1", "sub/deep/er/empty.csv": b"", "h#?%20é.csv": b"2"}
    for name, data in contents.items():
        put(tmp_path, name, data)
    put(tmp_path, "ignored.pdf", b"%PDF")
    (tmp_path / "no files").mkdir()
    found = {r.filename: (r.size_bytes, r.sha256) for r in hash_files(spark, str(tmp_path)).collect()}
    expected = {n.rsplit("/")[-1]: (len(d), hashlib.sha256(d).hexdigest()) for n, d in contents.items()}
    assert found == expected
    assert list_files(spark, str(tmp_path)).count() == len(contents) + 1
    assert [r.size_bytes for r in list_files(spark, f"file://{tmp_path}/e.CSV").collect()] == [1]
    with pytest.raises(Exception, match="FileNotFoundError"):
        list_files(spark, str(tmp_path / "nowhere")).collect()


def test_objects_are_asked_for_by_key(spark, tmp_path):
    put(tmp_path, "raw/a#1.csv", b"1")
    rows = spark.createDataFrame([("raw/a#1.csv",), ("raw/b.csv",), ("raw",), ("",), (None,)], "s3_key string")
    found = {r.s3_key: r.object_exists for r in with_stored_objects(rows, str(tmp_path)).collect()}
    assert found == {"raw/a#1.csv": True, "raw/b.csv": False, "raw": False, "": False, None: False}


def test_copy_reports_failures(spark, tmp_path):
    put(tmp_path, "in/a.csv", b"1\r\n2")
    files = spark.createDataFrame(
        [(f"file://{tmp_path}/in/a.csv", f"{tmp_path}/out/x/a.csv", 4), (f"file://{tmp_path}/in/no.csv", f"{tmp_path}/out/no.csv", 1)],
        "path string, target string, size_bytes long",
    )
    errors = {r.path.rsplit("/")[-1]: r.error for r in copy_files(files).collect()}
    assert errors["a.csv"] is None and "FileNotFoundError" in errors["no.csv"]
    assert (tmp_path / "out/x/a.csv").read_bytes() == b"1\r\n2"
    assert [p.name for p in (tmp_path / "out/x").iterdir()] == ["a.csv"]


def test_encoding_is_chosen_per_file(spark, tmp_path):
    put(tmp_path, "utf.csv", "name,WorkDate\nJosé – “ok”,20240115\n".encode("utf-8"))
    put(tmp_path, "win.csv", "name,WorkDate\nJosé – “ok”,20240115\n€ plain,bad\n".encode("cp1252"))
    df = readers.read_csv_any_encoding(spark, str(tmp_path))
    found = sorted((r.name, str(r.WorkDate)) for r in df.collect())
    assert found == [("José – “ok”", "2024-01-15"), ("José – “ok”", "2024-01-15"), ("€ plain", "None")]


def test_by_extension(spark, tmp_path):
    put(tmp_path, "a.CSV", "x,y\n1,2\n")
    put(tmp_path, "b.json", '{"x":3,"z":"q"}\n')
    df = readers.read_by_extension(spark, str(tmp_path))
    assert {(r.x, r.y, r.z) for r in df.collect()} == {("1", "2", None), ("3", None, "q")}
    put(tmp_path, "c.txt", "no")
    with pytest.raises(ValueError, match="txt"):
        readers.read_by_extension(spark, str(tmp_path))


@pytest.mark.parametrize("block_bytes", [1 << 20, 40, 7])
def test_csv_records_over_blocks(spark, tmp_path, block_bytes):
    put(tmp_path, "a.csv", 'x,"y ""z"""\n"1\n,""2""","é"\n\n"",\n3\n'.encode())
    put(tmp_path, "deep/b.csv", b'y "z",x,x\r\n5" pipe,"a"b,c,over\r\n' + 'naïve – €,"\n\n"\r\n'.encode("cp1252"))
    put(tmp_path, "bom.csv", "\ufeff\"x\"\n\"only\"".encode())
    put(tmp_path, "empty.csv", b"")
    put(tmp_path, "header.csv", b"w,x\n")
    df = readers.read_csv_any_encoding(spark, str(tmp_path), block_bytes=block_bytes)
    assert set(df.columns) == {"x", 'y "z"', "w"}
    found = {(r.x, r['y "z"'], r.w) for r in df.collect()}
    assert found == {
        ('1\n,"2"', "é", None), ("", None, None), ("3", None, None), ("ab", '5" pipe', None), ("\n\n", "naïve – €", None),
        ("only", None, None),
    }


def test_a_cell_longer_than_many_blocks(spark, tmp_path):
    cell = 'line, ""quoted""\n' * 20_000
    put(tmp_path, "a.csv", f'k,v\n1,"{cell}"\n2,"b"\n')
    rows = readers.read_csv_any_encoding(spark, str(tmp_path), block_bytes=10_000).collect()
    assert {(r.k, r.v) for r in rows} == {("1", cell.replace('""', '"')), ("2", "b")}


@pytest.mark.parametrize("block_bytes", [1 << 20, 16])
def test_json_arrays_and_csv_headers(spark, tmp_path, block_bytes):
    put(tmp_path, "a.json", '[\n  {"x": "a\\"]},{\\\\", "n": 1.50},\n  {\n    "deep": {"k": [1, {"t": "}"}]},\n    "b": true\n  }\n]\n')
    put(tmp_path, "b.json", '{"x":null}\n{"x":"é"}')
    put(tmp_path, "c.csv", "x,n\n1,2\n")
    put(tmp_path, "d.csv", 'n,x\n3,"4\n5"\n')
    put(tmp_path, "none.json", "[ ]")
    rows = readers.read_by_extension(spark, str(tmp_path), block_bytes=block_bytes).collect()
    found = {(r.source_file.rsplit("/")[-1], r.x, r.n, r.deep, r.b) for r in rows}
    assert found == {
        ("a.json", 'a"]},{\\', "1.50", None, None), ("a.json", None, None, '{"k": ["1", {"t": "}"}]}', "true"),
        ("b.json", None, None, None, None), ("b.json", "é", None, None, None), ("c.csv", "1", "2", None, None),
        ("d.csv", "4\n5", "3", None, None),
    }
    put(tmp_path, "bad.json", "[1, 2]")
    with pytest.raises(Exception, match="not an object"):
        readers.read_by_extension(spark, str(tmp_path), block_bytes=block_bytes).collect()


def test_series_with_other_key_order(spark):
    text = '{"cases":{"d1":1,"d2":2},"deaths":{"d2":20,"d1":10}}'
    short = '{"cases":{"d1":1,"d2":2},"deaths":{"d1":5}}'
    df = spark.createDataFrame([(1, text), (2, short)], "id int, doc string")
    rows = readers.series_rows(df, "doc", ["cases", "deaths"]).drop("doc")
    assert {tuple(r) for r in rows.collect()} == {
        (1, "d1", 1, 10), (1, "d2", 2, 20), (2, "d1", 1, 5), (2, "d2", 2, None),
    }


def test_task_functions_need_no_package_on_the_executors(tmp_path):
    shipped = (tasks.list_folders, tasks.hash_batches, tasks.copy_batches, tasks.csv_rows, tasks.json_rows, tasks.probing("/x", "k"))
    blob = cloudpickle.dumps(shipped)
    code = f"import pickle, sys; pickle.loads({blob!r}); assert 'siltstone' not in sys.modules; print('ok')"
    done = subprocess.run([sys.executable, "-c", code], capture_output=True, text=True, cwd=tmp_path)
    assert done.stdout.strip() == "ok", done.stderr
