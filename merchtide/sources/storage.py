"""Paths on the shared file system and staged intermediate tables."""

from __future__ import annotations

import tempfile
import threading
from collections.abc import Iterator, Sequence
from contextlib import contextmanager
from uuid import uuid4

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# Bytes in files of a lot. Lots are shuffled one after the other, each several times as large as its
# packed files, so what is on disk besides the tables does not grow with them.
LOT_BYTES = 1 << 30
# What each thread has staged, so that builds side by side remove only their own.
_own = threading.local()


def _staged() -> list[str]:
    if not hasattr(_own, "paths"):
        _own.paths = []
    return _own.paths


def scratch_root(spark: SparkSession) -> str:
    """The shared folder for intermediate tables, named by ``spark.checkpoint.dir``.

    A folder of our own is made only for a local master; a cluster that names
    none is refused, as its executors could not read a driver-local folder.
    """
    root = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if root:
        return root.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder all executors can reach")
    root = tempfile.mkdtemp(prefix="merchtide-")
    spark.sparkContext.setCheckpointDir(root)
    return root


def scratch_path(spark: SparkSession, label: str) -> str:
    path = f"{scratch_root(spark)}/merchtide/{label}-{uuid4().hex}"
    _staged().append(path)
    return path


# Spark's setting: shuffle files go when the query that wrote them ends, not when the driver collects garbage.
SHUFFLES_GO = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
# Of each session how many writes run, and what the setting was before the first.
_writes: dict[int, tuple[int, str]] = {}
_lock = threading.Lock()


@contextmanager
def last_use(spark: SparkSession) -> Iterator[None]:
    """Around one write: what it shuffles is needed no longer than the write.

    Writes of several threads of a session share the setting; the last to end puts it back.
    What another thread runs meanwhile loses its shuffles at its own end, as here.
    """
    with _lock:
        number, before = _writes.get(id(spark), (0, spark.conf.get(SHUFFLES_GO)))
        _writes[id(spark)] = number + 1, before
        spark.conf.set(SHUFFLES_GO, "true")
    try:
        yield
    finally:
        with _lock:
            number, before = _writes.pop(id(spark))
            if number > 1:
                _writes[id(spark)] = number - 1, before
            else:
                spark.conf.set(SHUFFLES_GO, before)


def lots_of(size: int) -> int:
    """How many lots a table of that many bytes is worked on in."""
    return max(1, -(-size // LOT_BYTES))


def lots(df: DataFrame, by: Sequence[str], number: int) -> list[DataFrame]:
    """The rows in lots, those with the same values of ``by`` in one."""
    if number == 1:
        return [df]
    lot = F.pmod(F.xxhash64(*by), F.lit(number))
    return [df.where(lot == n) for n in range(number)]


def stage(df: DataFrame, label: str, *more: DataFrame) -> DataFrame:
    """Write a frame once and read it back; ``more`` frames of its columns go behind it in turn.

    Cuts the lineage in a way that survives the loss of executors, and gives
    the planner the true size of the data.
    """
    path = scratch_path(df.sparkSession, label)
    for part in (df, *more):
        with last_use(df.sparkSession):
            part.write.mode("append").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def drop_staged(spark: SparkSession, keep: int = 0) -> None:
    """Delete what this thread has staged, but for the first ``keep`` tables.

    Call it when the results are written.
    """
    while len(_staged()) > keep:
        remove(spark, _staged().pop())


@contextmanager
def staging(spark: SparkSession) -> Iterator[None]:
    """Delete at the end what was staged inside; the results must be written by then."""
    before = len(_staged())
    try:
        yield
    finally:
        drop_staged(spark, before)


def file_system(spark: SparkSession, path: str):
    hadoop_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    return hadoop_path.getFileSystem(spark._jsc.hadoopConfiguration()), hadoop_path


def exists(spark: SparkSession, path: str) -> bool:
    fs, target = file_system(spark, path)
    return fs.exists(target)


def remove(spark: SparkSession, path: str) -> None:
    fs, target = file_system(spark, path)
    fs.delete(target, True)


def child_names(spark: SparkSession, path: str) -> list[str]:
    fs, target = file_system(spark, path)
    return sorted(s.getPath().getName() for s in fs.listStatus(target)) if fs.exists(target) else []


def staged_bytes(df: DataFrame) -> int:
    """Bytes of the files of a staged table, as its listing has them."""
    return int(df._jdf.queryExecution().analyzed().stats().sizeInBytes())


def total_bytes(spark: SparkSession, path: str) -> int:
    fs, target = file_system(spark, path)
    return fs.getContentSummary(target).getLength()
