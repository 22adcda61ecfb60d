"""Files that tasks write to and read from the shared folder, and how they become visible.

A task writes to a private name below ``_temporary``. Its rows name the file and what it should be called;
Spark keeps one attempt's rows per task. Only those files are moved to their final names, and the manifest,
a table below ``_manifest``, is written after the last move: a folder without one is not complete. Moves
can be repeated, so a lost executor does no harm.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from urllib.parse import urlparse

import pandas as pd
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession

from siltstone.session import written


def open_folder(uri: str) -> tuple[fs.FileSystem, str]:
    """File system and path of a folder, for use in tasks."""
    parsed = urlparse(uri)
    if parsed.scheme in ("", "file"):
        return fs.LocalFileSystem(), parsed.path
    scheme = "s3" if parsed.scheme in ("s3a", "s3n") else parsed.scheme
    return fs.FileSystem.from_uri(f"{scheme}://{parsed.netloc}{parsed.path}")


class Draft:
    """A file under its private name."""

    def __init__(self, folder: str):
        self.system, root = open_folder(folder)
        self.name = f"_temporary/{uuid.uuid4().hex}"
        self.system.create_dir(f"{root}/_temporary", recursive=True)
        self.stream = self.system.open_output_stream(f"{root}/{self.name}", compression=None)
        self.size = 0

    def write(self, data: bytes) -> None:
        self.stream.write(data)
        self.size += len(data)

    def close(self) -> None:
        self.stream.close()


def _moves(folder: str):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        system, root = open_folder(folder)
        for batch in batches:
            for draft, name, size in zip(batch["draft"], batch["name"], batch["file_bytes"]):
                target = f"{root}/{name}"
                if system.get_file_info(f"{root}/{draft}").type == fs.FileType.File:
                    system.create_dir(target.rsplit("/", 1)[0], recursive=True)
                    system.move(f"{root}/{draft}", target)
                if system.get_file_info(target).size != size:
                    raise OSError(f"{name} is not what its task wrote")
            yield batch

    return run


def publish(drafts: DataFrame, folder: str) -> DataFrame:
    """Move the drafts (draft, name, file_bytes, ...) to their names, write the manifest and return it."""
    kept = written(drafts, "drafts")
    moved = kept.mapInPandas(_moves(folder), kept.schema)
    moved.drop("draft").write.parquet(f"{folder}/_manifest")
    return manifest(drafts.sparkSession, folder)


def manifest(spark: SparkSession, folder: str) -> DataFrame:
    """The files of a complete folder; fails on one that is not."""
    return spark.read.parquet(f"{folder}/_manifest")
