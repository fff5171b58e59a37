"""Shared scratch folder and lineage cuts.

A table written here can be read again by any executor, so a job that loses
executors does not have to recompute (and possibly recompute differently) the
rows that an earlier stage already based a decision on.
"""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator, Mapping
from contextlib import contextmanager
from contextvars import ContextVar

from pyspark.sql import DataFrame, SparkSession

_local_dirs: dict[str, str] = {}
_run_dirs: set[str] = set()
_named: ContextVar[list[str] | None] = ContextVar("named", default=None)  # by new_path, inside the innermost scratch block

SMALL_BATCHES = {"spark.sql.execution.arrow.maxBytesPerBatch": str(2 << 20),  # a single longer text still goes whole
                 "spark.sql.parquet.columnarReaderBatchSize": "1024"}
SHUFFLES_GO = {"spark.sql.classic.shuffleDependency.fileCleanup.enabled": "true"}
GZIP_RATIO = 8  # bytes of text in a gzipped byte


def shared_dir(spark: SparkSession) -> str:
    """Folder named by ``spark.checkpoint.dir``; a temporary one in local mode only."""
    named = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if named:
        return named.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors can reach")
    app = spark.sparkContext.applicationId
    if app not in _local_dirs:
        _local_dirs[app] = tempfile.mkdtemp(prefix="panelspark-")
    return _local_dirs[app]


def run_dir(spark: SparkSession) -> str:
    """Folder of this application inside the shared one; it goes when the application ends, others are not touched."""
    app = spark.sparkContext.applicationId
    folder = f"{shared_dir(spark)}/panelspark/{app}"
    if app not in _run_dirs:
        path = spark._jvm.org.apache.hadoop.fs.Path(folder)
        files = path.getFileSystem(spark._jsc.hadoopConfiguration())
        files.mkdirs(path)
        files.deleteOnExit(path)
        _run_dirs.add(app)
    return folder


def new_path(spark: SparkSession, label: str) -> str:
    path = f"{run_dir(spark)}/{label}-{uuid.uuid4().hex}"
    if (named := _named.get()) is not None:
        named.append(path)
    return path


@contextmanager
def scratch(spark: SparkSession) -> Iterator[None]:
    """Folders that ``new_path`` names inside the block, tables of ``materialize`` too, are deleted at its end.

    Of nested blocks each deletes its own. Nothing that is used after the block may still read them.
    """
    paths: list[str] = []
    token = _named.set(paths)
    try:
        yield
    finally:
        _named.reset(token)
        for name in paths:
            path = spark._jvm.org.apache.hadoop.fs.Path(name)
            path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


@contextmanager
def _settings(spark: SparkSession, values: Mapping[str, str]) -> Iterator[None]:
    before = {name: spark.conf.get(name, None) for name in values}
    try:
        for name, value in values.items():
            spark.conf.set(name, value)
        yield
    finally:
        for name, value in before.items():
            spark.conf.unset(name) if value is None else spark.conf.set(name, value)


@contextmanager
def small_batches(spark: SparkSession) -> Iterator[None]:
    """Actions inside read, and hand to Python, texts in small portions; settings of the session are put back after.

    By default a portion is 4,096 and 10,000 rows whatever their length, and each task holds several copies of it,
    outside the heap too.
    """
    with _settings(spark, SMALL_BATCHES):
        yield


@contextmanager
def shuffles_go(spark: SparkSession) -> Iterator[None]:
    """Shuffle files of each action inside are deleted when it ends, not when the driver happens to collect its garbage.

    For actions that write and are not run again.
    """
    with _settings(spark, SHUFFLES_GO):
        yield


@contextmanager
def sized_as_text(spark: SparkSession) -> Iterator[None]:
    """Files are planned by the size of their text: a gzipped one of 10 MB is not broadcast unread as if it were small.

    What turns out to be small in a shuffle is still broadcast, by its measured size.
    """
    with _settings(spark, {"spark.sql.sources.fileCompressionFactor": str(GZIP_RATIO)}):
        yield


def materialize(df: DataFrame, label: str = "table") -> DataFrame:
    """Write ``df`` as Parquet in the shared folder and read it back.

    Unlike an RDD checkpoint the result keeps column pruning, filter pushdown
    and real size statistics, which the join planner uses.
    """
    return stored(df, new_path(df.sparkSession, label))


def stored(df: DataFrame, path: str) -> DataFrame:
    """``materialize`` in a folder that the caller names."""
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
