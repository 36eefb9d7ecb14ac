"""Shared pieces: tables, the shared scratch folder and written intermediate results."""

from __future__ import annotations

import tempfile
import uuid
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from gleanery.shipping import ship

#: A word is a run of anything but ASCII white space.
WORD = r"[^\x20\x09-\x0D]+"
#: Rows and bytes that go to Python at once; texts can be long, so fewer than Spark's defaults.
ROWS_PER_BATCH = 1000
BYTES_PER_BATCH = 4 << 20
#: A side of a join is broadcast up to so many rows of a few dozen bytes (some MB), and shuffled beyond.
BROADCAST_ROWS = 100_000


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def prepare(spark: SparkSession) -> None:
    """Sends the package to the workers, and bounds what one Arrow batch holds, in rows and in bytes, however long the texts are. Lower bounds that the session has already stay; higher ones are lowered for good, as plans read them when they run."""
    ship(spark)
    for key, most in (("spark.sql.execution.arrow.maxRecordsPerBatch", ROWS_PER_BATCH), ("spark.sql.execution.arrow.maxBytesPerBatch", BYTES_PER_BATCH)):
        now = spark.conf.get(key).rstrip("b")
        if not now.isdigit() or not 0 < int(now) <= most:  # 0 and less: no bound; another unit is replaced
            spark.conf.set(key, str(most))


#: What a Python worker remembers between tasks, by the name of the operator.
CACHES: dict[str, dict] = {}


def tidy(run, keep: str | None = None):
    """run for mapInArrow, in a worker that forgets what other operators remembered and gives freed memory back after each task: a worker outlives the operators that it serves."""

    def tidied(batches):
        import ctypes

        import pyarrow as pa

        for name, cache in CACHES.items():
            if name != keep:
                cache.clear()
        yield from run(batches)
        pa.default_memory_pool().release_unused()
        try:
            ctypes.CDLL("libc.so.6").malloc_trim(0)
        except (OSError, AttributeError):  # another C library
            pass

    return tidied


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share: spark.checkpoint.dir, or the one that setCheckpointDir() was given. Only where neither is set and all runs on this machine, a temporary folder; on a cluster that is an error."""
    context = spark.sparkContext
    base = spark.conf.get("spark.checkpoint.dir", None) or context.getConf().get("spark.checkpoint.dir", None) or context.getCheckpointDir()
    if not base:
        if not context.master.startswith("local") or context.master.startswith("local-cluster"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that driver and executors share")
        base = getattr(context, "_gleanery_dir", None)
        if not base:
            base = context._gleanery_dir = "file://" + tempfile.mkdtemp(prefix="gleanery-")
    return f"{base.rstrip('/')}/gleanery"


_SWEPT: list[list[str]] = []


def scratch_path(spark: SparkSession, name: str) -> str:
    path = f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"
    if _SWEPT:
        _SWEPT[-1].append(path)
    return path


@contextmanager
def swept(spark: SparkSession):
    """Deletes at its end what was written to the shared folder meanwhile; for jobs that write their result elsewhere."""
    _SWEPT.append([])
    try:
        yield
    finally:
        for path in _SWEPT.pop():
            drop_path(spark, path)


def drop_path(spark: SparkSession, path: str) -> None:
    jvm = spark._jvm
    where = jvm.org.apache.hadoop.fs.Path(path)
    where.getFileSystem(spark._jsc.hadoopConfiguration()).delete(where, True)


class Scratch:
    """Writes results to the shared folder, which cuts lineage and survives lost executors, and deletes those that are no longer needed."""

    def __init__(self, spark: SparkSession):
        self.spark, self.paths = spark, {}

    def keep(self, df: DataFrame, name: str) -> DataFrame:
        path = scratch_path(self.spark, name)
        df.write.parquet(path)
        out = self.spark.read.schema(df.schema).parquet(path)
        self.paths[id(out)] = (path, out)
        return out

    def drop(self, *frames: DataFrame | None) -> None:
        for df in frames:
            if df is not None and id(df) in self.paths:
                drop_path(self.spark, self.paths.pop(id(df))[0])


def bounded(df: DataFrame, rows: int, limit: int = BROADCAST_ROWS) -> DataFrame:
    """df with a broadcast hint if its counted rows are few; otherwise the join shuffles."""
    return F.broadcast(df) if rows <= limit else df


def word_count(text: Column | str) -> Column:
    text = F.col(text) if isinstance(text, str) else text
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")

