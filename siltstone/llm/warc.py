"""WARC archives: a deterministic sharded writer, and a reader.

Records are put in the order of their page. Exact running sizes over that order cut them into shards of
about equal size, whatever the layout of the input; a task sorts a shard and writes it as one or more files,
starting a new one when the compressed size passes a limit. Every record is a gzip member of its own, with
headers and digests made anew from the payload and no time of day in it, so the same pages give the same
bytes. Files are published as ``storage`` describes.

Of records with equal payloads the one of the largest page is stored whole and the others are revisits that
refer to it. Which ones these are is worked out on (page, digest) alone; the few revisits join the stream
of pages as marker rows that sort right before their page, so payloads are shuffled once.
"""

from __future__ import annotations

import base64
import hashlib
import re
import uuid
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from siltstone.llm.order import with_total_before
from siltstone.llm.storage import Draft, manifest, open_folder, publish
from siltstone.session import written

#: Payloads below this many bytes are always stored whole.
LEAST_SHARED = 1_000
SHARD_BYTES = 64 << 20
FILE_BYTES = 128 << 20
DATE = "2024-01-01T00:00:00Z"
_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
_DRAFTS = "draft string, name string, file_bytes long, records long, first_page long, last_page long, sha256 string"
_RECORDS = (
    "page_id long, url string, payload_bytes long, payload_digest string, record_type string, refers_to long, "
    "payload binary"
)


def _headers(lines: list[tuple[str, str]]) -> bytes:
    return ("WARC/1.1\r\n" + "".join(f"{k}: {v}\r\n" for k, v in lines) + "\r\n").encode("utf-8")


def _sha1(data: bytes) -> str:
    return "sha1:" + base64.b32encode(hashlib.sha1(data).digest()).decode()


def _record_id(page, digest: str) -> str:
    return f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, f'{page}/{digest}')}>"


def record(page: int | None, url: str | None, payload: bytes, refers_to: int | None, date: str) -> bytes:
    """One record, uncompressed: a response, or a revisit if ``refers_to`` is set."""
    digest = hashlib.sha1(payload).hexdigest()
    http = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: %d\r\n\r\n" % len(payload)
    block = http if refers_to is not None else http + payload
    # A line break or blank in a URL would end the header.
    target = re.sub(r"[\x00-\x20\x7f]", lambda m: f"%{ord(m[0]):02X}", url) if url else f"urn:page:{page}"
    lines = [
        ("WARC-Type", "response" if refers_to is None else "revisit"),
        ("WARC-Record-ID", _record_id(page, digest)),
        ("WARC-Date", date),
        ("WARC-Target-URI", target),
        ("Content-Type", "application/http;msgtype=response"),
        ("WARC-Payload-Digest", _sha1(payload)),
        ("WARC-Block-Digest", _sha1(block)),
    ]
    if page is not None:
        lines.append(("Page-ID", str(page)))
    if refers_to is not None:
        lines += [
            ("WARC-Profile", _PROFILE),
            ("WARC-Refers-To", _record_id(refers_to, digest)),
            ("Refers-To-Page-ID", str(refers_to)),
        ]
    return _headers([*lines, ("Content-Length", str(len(block)))]) + block + b"\r\n\r\n"


def _member(data: bytes) -> bytes:
    squeeze = zlib.compressobj(6, zlib.DEFLATED, 31)  # a gzip member; zlib writes no time into it
    return squeeze.compress(data) + squeeze.flush()


def _writer(folder: str, file_bytes: int, date: str):
    class Roll:
        """The file being written."""

        def __init__(self, shard: int, number: int):
            self.draft, self.hash = Draft(folder), hashlib.sha256()
            self.name = f"shard-{shard:06d}/{number:05d}.warc.gz"
            self.pages, self.records = [], 0
            info = b"software: siltstone\r\nformat: WARC File Format 1.1\r\n"
            lines = [("WARC-Type", "warcinfo"), ("WARC-Record-ID", _record_id("info", self.name)), ("WARC-Date", date)]
            lines += [("Content-Type", "application/warc-fields"), ("Content-Length", str(len(info)))]
            self.add(_member(_headers(lines) + info + b"\r\n\r\n"))

        def add(self, data: bytes) -> None:
            self.draft.write(data)
            self.hash.update(data)

        def row(self) -> dict:
            self.draft.close()
            return {
                "draft": self.draft.name, "name": self.name, "file_bytes": self.draft.size, "records": self.records,
                "first_page": self.pages[0], "last_page": self.pages[-1], "sha256": self.hash.hexdigest(),
            }

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        roll, shard, number, mark = None, None, 0, None
        for batch in batches:
            ids = [None if pd.isna(p) else int(p) for p in batch["page_id"]]
            for own, page, digest, first, url, html in zip(
                batch["shard"], ids, batch["digest"], batch["refers_to"], batch["url"], batch["html"]
            ):
                if not pd.isna(first):
                    mark = (page, digest, int(first))  # stands right before the page it belongs to
                    continue
                if own != shard or roll.draft.size >= file_bytes:
                    if roll:
                        yield pd.DataFrame([roll.row()])
                    number = number + 1 if own == shard else 0
                    shard, roll = own, Roll(own, number)
                refers_to = mark[2] if mark and mark[:2] == (page, digest) else None
                roll.add(_member(record(page, url, html.encode("utf-8", "replace"), refers_to, date)))
                roll.records += 1
                # Only the ends of the range are kept.
                roll.pages[1:] = [page] if roll.pages else []
                roll.pages = roll.pages or [page]
        if roll:
            yield pd.DataFrame([roll.row()])

    return run


def write_warc(
    pages: DataFrame,
    folder: str,
    least_shared: int = LEAST_SHARED,
    shard_bytes: int = SHARD_BYTES,
    file_bytes: int = FILE_BYTES,
    date: str = DATE,
) -> DataFrame:
    """Write ``pages`` (page_id, url, html) to WARC files below ``folder``; returns the manifest.

    NULL html is an empty payload, a NULL url is named after the page, a page without id sorts first and has
    no id in its record. Rows that repeat the largest page_id of a payload are all stored whole. Other
    columns are ignored. No pages give an empty manifest.
    """
    rows = pages.select(
        F.col("page_id").cast("long").alias("page_id"),
        F.col("url").cast("string").alias("url"),
        F.coalesce(F.col("html").cast("string"), F.lit("")).alias("html"),
    )
    digest = F.sha1(F.encode("html", "UTF-8"))
    narrow = written(
        rows.select("page_id", digest.alias("digest"), F.octet_length("html").cast("long").alias("size")), "warc-sizes"
    )
    shared = (
        narrow.where(F.col("size") >= least_shared)
        .groupBy("digest", "size")
        .agg(F.max("page_id").alias("refers_to"), F.count("*").alias("copies"))
        .where("copies > 1 and refers_to is not null")
        .drop("copies")
    )
    marks = narrow.join(shared, ["digest", "size"]).where(~F.col("page_id").eqNullSafe(F.col("refers_to")))
    marks = marks.select("page_id", "digest", "refers_to").distinct()

    # Exact cuts at equal shares of the bytes: one page number per shard reaches the driver.
    running = with_total_before(
        narrow.withColumn("held", F.col("size") + 600), ["page_id", "digest"], "held", "before"
    )
    starts = (
        running.where("page_id is not null")
        .groupBy(F.expr(f"before div {int(shard_bytes)}").alias("shard"))
        .agg(F.min("page_id").alias("first"))
        .orderBy("shard")
        .collect()
    )
    cuts = np.array([r["first"] for r in starts[1:]], dtype=np.int64)

    @F.pandas_udf(T.IntegerType())
    def shard_of(page: pd.Series) -> pd.Series:
        place = np.searchsorted(cuts, page.fillna(np.iinfo(np.int64).min).to_numpy(dtype=np.int64), side="right")
        return pd.Series(place.astype(np.int32))

    stream = rows.select("page_id", digest.alias("digest"), F.lit(None).cast("long").alias("refers_to"), "url", "html")
    stream = stream.unionByName(marks, allowMissingColumns=True)
    stream = stream.withColumn("shard", shard_of("page_id")).repartitionById(len(cuts) + 1, "shard")
    stream = stream.sortWithinPartitions("shard", "page_id", "digest", F.col("refers_to").desc_nulls_last(), "url")
    return publish(stream.mapInPandas(_writer(folder, file_bytes, date), _DRAFTS), folder)


def records_of(stream) -> Iterator[tuple[dict[str, str], bytes]]:
    """Header fields (names in lower case) and block of each record of an open file, one at a time."""
    left = b""
    while True:
        left = left or stream.read(1 << 20)
        if not left:
            return
        inflate, parts = zlib.decompressobj(31), []
        while not inflate.eof:
            if not left:
                left = stream.read(1 << 20)
                if not left:
                    raise ValueError("the file ends inside a record")
            parts.append(inflate.decompress(left))
            left = inflate.unused_data
        data = b"".join(parts)
        head, _, rest = data.partition(b"\r\n\r\n")
        fields = dict(line.split(": ", 1) for line in head.decode("utf-8").split("\r\n")[1:])
        fields = {k.lower(): v for k, v in fields.items()}
        block = rest[: int(fields["content-length"])]
        if "warc-block-digest" in fields and fields["warc-block-digest"] != _sha1(block):
            raise ValueError(f"damaged record {fields.get('warc-record-id')}")
        yield fields, block


def _reader(folder: str, payloads: bool):
    def rows(name: str) -> Iterator[dict]:
        system, root = open_folder(folder)
        with system.open_input_stream(f"{root}/{name}", compression=None) as stream:
            for fields, block in records_of(stream):
                kind = fields["warc-type"]
                if kind == "warcinfo":
                    continue
                http, _, payload = block.partition(b"\r\n\r\n")
                size = int(re.search(rb"(?i)\r\ncontent-length: *([0-9]+)", http)[1])
                digest = base64.b32decode(fields["warc-payload-digest"].removeprefix("sha1:")).hex()
                if kind == "response" and (len(payload) != size or hashlib.sha1(payload).hexdigest() != digest):
                    raise ValueError(f"damaged payload in {name}")
                yield {
                    "page_id": fields.get("page-id"), "url": fields["warc-target-uri"], "payload_bytes": size,
                    "payload_digest": digest, "record_type": kind, "refers_to": fields.get("refers-to-page-id"),
                    "payload": payload if payloads and kind == "response" else None,
                }

    def frame(held: list[dict]) -> pd.DataFrame:
        out = pd.DataFrame(held)
        return out.assign(**{c: pd.array([None if v is None else int(v) for v in out[c]], dtype="Int64")
                             for c in ("page_id", "refers_to")})

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for name in batch["name"]:
                held = []
                for row in rows(name):
                    held.append(row)
                    if len(held) == (64 if payloads else 4096):
                        yield frame(held)
                        held = []
                if held:
                    yield frame(held)

    return run


def read_warc(spark: SparkSession, folder: str, payloads: bool = True) -> DataFrame:
    """Records of the files named by the folder's manifest; every digest is checked, damage raises an error.

    A revisit has no payload; its size and digest are those of the payload it refers to.
    """
    files = manifest(spark, folder).select("name")
    count = max(1, min(files.count(), 10_000))
    return files.repartition(count, "name").mapInPandas(_reader(folder, payloads), _RECORDS)
