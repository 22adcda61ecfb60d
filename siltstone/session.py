"""Session for local runs, and the shared folder for tables written between stages."""

from __future__ import annotations

import os
import tempfile
import uuid
import warnings
from collections.abc import Callable, Iterator
from contextlib import contextmanager
from contextvars import ContextVar

from py4j.protocol import Py4JError
from pyspark.sql import DataFrame, SparkSession

#: Paths of the tables written within the innermost ``passing_tables``, by name.
_passing: ContextVar[dict[str, list[str]] | None] = ContextVar("_passing", default=None)


def local_session(app: str = "siltstone", cpus: int | None = None) -> SparkSession:
    """Local session for tests and the bench; a cluster brings its own settings."""
    cpus = cpus or os.cpu_count() or 8
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", str(cpus))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "8g")
        .config("spark.ui.enabled", "false")
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def shared_folder(spark: SparkSession) -> str:
    """Folder every executor can reach, as the cluster names it in ``spark.checkpoint.dir``.

    Only a session that names none and runs in one process (a local test) gets a temporary one; on a
    cluster each machine would write to a folder of its own, so there it is an error.
    """
    context = spark.sparkContext
    folder = spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir()
    if not folder:
        if not context.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that every executor can reach")
        folder = tempfile.mkdtemp(prefix="siltstone-")
        context.setCheckpointDir(folder)
    return folder


def fresh_path(spark: SparkSession, name: str) -> str:
    """A path below the shared folder that no other run uses."""
    return f"{shared_folder(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"


def written(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to the shared folder and read it back.

    Cuts the lineage, fixes non-deterministic columns (partition and position ids) for good, and
    leaves a columnar table whose readers prune columns. Survives the loss of any executor.
    """
    path = fresh_path(df.sparkSession, name)
    made = _passing.get()
    if made is not None:
        made.setdefault(name, []).append(path)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


@contextmanager
def passing_tables(spark: SparkSession) -> Iterator[Callable[..., None]]:
    """Within it, tables that ``written`` makes are deleted: those of some names by a call of what it yields, the rest
    at its end. Frames that read them must have been used up by then."""
    made: dict[str, list[str]] = {}

    def drop(*names: str) -> None:
        for name in names:
            for path in made.pop(name, ()):
                _delete(spark, path)

    mark = _passing.set(made)
    try:
        yield drop
    finally:
        _passing.reset(mark)
        drop(*made)


def _delete(spark: SparkSession, path: str) -> None:
    """A folder that cannot be deleted stays; it does no harm but to the disk."""
    try:
        folder = spark._jvm.org.apache.hadoop.fs.Path(path)
        folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)
    except Py4JError as error:
        warnings.warn(f"{path} is left: {error}", stacklevel=2)
