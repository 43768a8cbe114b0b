"""Sinks: full refresh (SNK1), monthly partition refresh (SNK3), working tables.

Every path lives under a shared folder: the output location a caller passes,
or the cluster's ``spark.checkpoint.dir`` for working tables.  A folder of
our own is set only when the session names none (local runs and tests).
"""

from __future__ import annotations

import contextlib
import datetime as dt
import tempfile
import threading
import uuid
from collections.abc import Iterable, Iterator

from pyspark.sql import DataFrame, SparkSession


def shared_dir(spark: SparkSession) -> str:
    """The cluster's shared checkpoint folder.

    Read from the session (``spark.checkpoint.dir``, or a folder set by
    ``setCheckpointDir``); only when neither exists -- a local session, as in
    tests -- is a folder of our own set, through ``setCheckpointDir``
    (``spark.checkpoint.dir`` cannot be changed on a running session).
    """
    d = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not d:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("spark.checkpoint.dir names no folder that all executors share")
        spark.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="pathwise-checkpoints-"))
        d = spark.sparkContext.getCheckpointDir()
    return d.rstrip("/")


def new_run_dir(spark: SparkSession, label: str = "run") -> str:
    return f"{shared_dir(spark)}/pathwise/{label}-{uuid.uuid4().hex[:12]}"


#: Drops an execution's shuffle files when it ends (they stay until the driver collects garbage otherwise).
SHUFFLE_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
#: Working tables are packed tighter than Spark's own snappy does: several lie on disk at once.
WORKING_CODEC = "zstd"
_CLEANING: dict[int, list] = {}        # per session: writes under way, the session's own setting
_CLEANING_LOCK = threading.Lock()


@contextlib.contextmanager
def shuffles_dropped(spark: SparkSession) -> Iterator[None]:
    """Writes begun in here drop their shuffle files when they end: nothing
    reads these again, as later readers take what was written.  Several threads
    of one session may be in here."""
    key = id(spark._jsparkSession)
    with _CLEANING_LOCK:
        now = _CLEANING.setdefault(key, [0, spark.conf.get(SHUFFLE_CLEANUP, None)])
        now[0] += 1
        spark.conf.set(SHUFFLE_CLEANUP, "true")
    try:
        yield
    finally:
        with _CLEANING_LOCK:
            now[0] -= 1
            if not now[0]:
                del _CLEANING[key]
                if now[1] is None:
                    spark.conf.unset(SHUFFLE_CLEANUP)
                else:
                    spark.conf.set(SHUFFLE_CLEANUP, now[1])


def materialize(df: DataFrame, path: str) -> DataFrame:
    """Write a working table and read it back: cuts the lineage, so a lost
    executor re-reads files instead of recomputing the upstream joins, and
    later readers get column pruning and filter pushdown on it.  The write's
    shuffle files go when it ends."""
    with shuffles_dropped(df.sparkSession):
        df.write.mode("overwrite").option("compression", WORKING_CODEC).parquet(path)
    return df.sparkSession.read.parquet(path)


def materialize_bucketed(df: DataFrame, path: str, key: str, buckets: int) -> DataFrame:
    """A working table whose files lie by a hash of ``key``: tables with the
    same number of buckets are joined and grouped by ``key`` without a shuffle.

    One shuffle when it is written, none by any reader.  A bucket is read by
    one task and AQE cannot split it, so this is for tables with a bounded
    number of rows per key.  The table is known to this session only; the
    files stay in ``path``.
    """
    name = f"pathwise_{uuid.uuid4().hex}"
    (df.repartition(buckets, key).write.format("parquet").option("path", path)
     .bucketBy(buckets, key).sortBy(key).saveAsTable(name))
    return df.sparkSession.table(name)


def publish_full(df: DataFrame, path: str) -> None:
    """SNK1: replace the whole published table."""
    df.write.mode("overwrite").parquet(path)


def _folder(spark: SparkSession, path: str):
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p, p.getFileSystem(spark._jsc.hadoopConfiguration())


def stored_bytes(spark: SparkSession, path: str) -> int:
    """Bytes of a file, or of all files in a folder."""
    p, fs = _folder(spark, path)
    return fs.getContentSummary(p).getLength()


def _files(spark: SparkSession, path: str) -> set[str]:
    p, fs = _folder(spark, path)
    return {s.getPath().getName() for s in fs.listStatus(p)} if fs.exists(p) else set()


def remove(spark: SparkSession, path: str) -> None:
    """Remove a folder with all it holds: a run's working tables, a month."""
    p, fs = _folder(spark, path)
    fs.delete(p, True)


def publish_month(df: DataFrame, path: str, month_col: str = "month",
                  months: Iterable[dt.date] = ()) -> None:
    """SNK3: replace the month partitions present in ``df``, and remove those of
    ``months`` (the run's month range) that it has no rows for.

    Re-running a month rewrites that month and leaves the others, so a
    repeated refresh does not double rows (the reference's plain INSERT
    does, K9).  ``mode='append'`` reproduces the reference exactly.
    """
    folders = [f"{path}/{month_col}={m.isoformat()}" for m in months]
    before = {f: files for f in folders if (files := _files(df.sparkSession, f))}
    (df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
     .partitionBy(month_col).parquet(path))
    for folder, files in before.items():  # a month written anew has other files
        if _files(df.sparkSession, folder) == files:
            remove(df.sparkSession, folder)


def append_month(df: DataFrame, path: str, month_col: str = "month") -> None:
    """SNK3 as the reference does it: plain append of the computed month(s)."""
    df.write.mode("append").partitionBy(month_col).parquet(path)


def read_published(spark: SparkSession, path: str, columns: list[str]) -> DataFrame:
    """Read a published table back in its column order (partition column included)."""
    return spark.read.parquet(path).select(*columns)
