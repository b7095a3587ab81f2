"""Intermediate tables in the folder that driver and executors share.

`spark.checkpoint.dir` is read from the session; only where it is unset and the
master is local (tests, a laptop) is a local folder made and set. A written table cuts lineage, survives
a lost executor, and gives the planner true sizes for later joins.
"""

from __future__ import annotations

import atexit
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

#: A side is broadcast only if its written size is known and at most this.
BROADCAST_BYTES = 8 << 20

_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"

_written: list[tuple[SparkSession, str]] = []


def shared_dir(spark: SparkSession) -> str:
    base = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that driver and executors share")
        base = tempfile.mkdtemp(prefix="tidemark-")
        spark.sparkContext.setCheckpointDir(base)
    return base.rstrip("/")


def _fs(spark: SparkSession, path: str):
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p, p.getFileSystem(spark._jsc.hadoopConfiguration())


class Table:
    """A written intermediate table: `df`, its size in bytes, and `drop()`."""

    def __init__(self, df: DataFrame, name: str):
        self.spark = df.sparkSession
        self.path = f"{shared_dir(self.spark)}/tidemark-{name}-{uuid.uuid4().hex}"
        # the written table is what later jobs read: the shuffle files of this one go with it
        before = self.spark.conf.get(_CLEANUP, None)
        self.spark.conf.set(_CLEANUP, "true")
        try:
            df.write.parquet(self.path)
        finally:
            self.spark.conf.set(_CLEANUP, before) if before is not None else self.spark.conf.unset(_CLEANUP)
        _written.append((self.spark, self.path))
        self.df = self.spark.read.schema(df.schema).parquet(self.path)

    @property
    def bytes(self) -> int:
        p, fs = _fs(self.spark, self.path)
        return fs.getContentSummary(p).getLength()

    def small(self) -> bool:
        return self.bytes <= BROADCAST_BYTES

    def drop(self) -> None:
        p, fs = _fs(self.spark, self.path)
        fs.delete(p, True)


def release(spark: SparkSession) -> None:
    """Let Spark's cleaner remove shuffle files of finished jobs now rather than at its next periodic run."""
    import gc

    gc.collect()
    spark._jvm.System.gc()


@atexit.register
def _clean() -> None:
    for spark, path in _written:
        try:
            p, fs = _fs(spark, path)
            fs.delete(p, True)
        except Exception:  # noqa: BLE001  the JVM may be gone by now
            return
