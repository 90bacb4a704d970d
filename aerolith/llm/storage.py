"""Intermediate tables in the folder that driver and executors share."""

from __future__ import annotations

import tempfile
import threading
import uuid
from collections.abc import Iterable, Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def shared_folder(spark: SparkSession) -> str:
    """A folder of this application under the session's ``spark.checkpoint.dir``.

    Only a single-machine session (``local[...]``) may leave that setting out; it gets
    a temporary folder.  On a cluster each executor would write to its own disk."""
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if not folder:
        master = spark.sparkContext.master
        if master != "local" and not master.startswith("local["):
            raise ValueError("spark.checkpoint.dir must name a folder that driver and executors share")
        folder = tempfile.mkdtemp(prefix="aerolith-")
        spark.conf.set("spark.checkpoint.dir", folder)
    return f"{folder.rstrip('/')}/aerolith-{spark.sparkContext.applicationId}"


#: Spark's setting that removes the shuffle files of an execution when it ends.
RELEASE = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
#: Rows that go to a Python worker together, BATCH at most: whole texts are long, and
#: both the JVM and the worker hold a batch of every running task.
ARROW, BATCH = "spark.sql.execution.arrow.maxRecordsPerBatch", 1_000

_lock = threading.Lock()
_writing: dict[SparkSession, tuple[list[int], dict[str, str | None]]] = {}


@contextmanager
def write_settings(spark: SparkSession) -> Iterator[None]:
    """Both settings for as long as any thread writes from this session; the last one
    puts back what the session had before the first."""
    with _lock:
        if spark not in _writing:
            before = {k: spark.conf.get(k, None) for k in (RELEASE, ARROW)}
            _writing[spark] = ([0], before)
            rows = int(before[ARROW] or 0)
            spark.conf.set(RELEASE, "true")
            spark.conf.set(ARROW, str(min(rows, BATCH) if rows > 0 else BATCH))
        count, before = _writing[spark]
        count[0] += 1
    try:
        yield
    finally:
        with _lock:
            count[0] -= 1
            if not count[0]:
                del _writing[spark]
                for k, v in before.items():
                    spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def _delete(spark: SparkSession, path: str) -> None:
    where = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(where, True)


def _written(df: DataFrame, compression: str) -> str:
    spark = df.sparkSession
    path = f"{shared_folder(spark)}/{uuid.uuid4().hex}"
    with write_settings(spark):
        df.write.option("compression", compression).parquet(path)
    return path


def materialise(df: DataFrame, compression: str = "snappy") -> DataFrame:
    """Write ``df`` once to the shared folder and read it back.

    Cuts the lineage: a lost executor costs a re-read, not a recomputation, and
    several consumers scan (with column pruning) instead of recomputing.  Its shuffle
    files are removed with the end of the write, not when the driver next collects
    garbage, so the disk holds the tables and the shuffles of one step."""
    return df.sparkSession.read.schema(df.schema).parquet(_written(df, compression))


def part(df: DataFrame, key: str, k: int, parts: int) -> DataFrame:
    """The ``k``-th of so many ``parts`` of ``df``, dealt by a hash of ``key``."""
    return df if parts == 1 else df.where(F.pmod(F.xxhash64(key), F.lit(parts)) == k)


def joined(parts: Iterable[DataFrame], compression: str = "snappy") -> DataFrame:
    """``materialise`` of tables with the same columns, as one: they are written one after
    the other, so the disk holds the shuffle of one at a time."""
    parts = list(parts)
    paths = [_written(df, compression) for df in parts]
    return parts[0].sparkSession.read.schema(parts[0].schema).parquet(*paths)


@contextmanager
def passing(*parts: DataFrame, compression: str = "snappy") -> Iterator[DataFrame]:
    """``joined`` for a table that goes at the end of the block: what is made of it
    has to be written inside."""
    paths: list[str] = []
    spark = parts[0].sparkSession
    try:
        for df in parts:
            paths.append(_written(df, compression))
        yield spark.read.schema(parts[0].schema).parquet(*paths)
    finally:
        for path in paths:
            _delete(spark, path)


def clean(spark: SparkSession) -> None:
    """Deletes what this application has written there: call it once the results that
    read those tables have been written themselves."""
    _delete(spark, shared_folder(spark))
