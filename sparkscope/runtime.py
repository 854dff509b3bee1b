"""Shared-folder materialisation and size-checked summary joins.

Two rules of the library live here:

* A table that several later passes read is written once, as parquet, under the
  folder the cluster names in ``spark.checkpoint.dir``. That cuts the lineage,
  survives the loss of executors, and (unlike cached rows) keeps column pruning
  for the passes that follow.
* A summary table is broadcast only after its size has been measured. Beyond the
  limit it is an ordinary shuffled join of a written table, whose hot keys adaptive
  execution splits.
"""

from __future__ import annotations

import atexit
import shutil
import tempfile
import uuid
from collections.abc import Callable, Sequence
from contextlib import contextmanager
from functools import reduce
from multiprocessing.pool import ThreadPool

from pyspark import StorageLevel, inheritable_thread_target
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

BROADCAST_MAX_BYTES = 32 * 1024 * 1024

_local_dirs: dict[str, str] = {}
_written: dict[str, list[str]] = {}


def shared_dir(spark: SparkSession) -> str:
    """Folder for intermediate tables, visible to every executor."""
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured.rstrip("/")
    context = spark.sparkContext
    if not context.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
    if context.applicationId not in _local_dirs:
        path = tempfile.mkdtemp(prefix="sparkscope-")
        atexit.register(shutil.rmtree, path, ignore_errors=True)
        _local_dirs[context.applicationId] = path
    return _local_dirs[context.applicationId]


def new_path(spark: SparkSession, label: str) -> str:
    """A fresh path in the shared folder; nothing is ever overwritten."""
    path = f"{shared_dir(spark)}/sparkscope/{label}-{uuid.uuid4().hex}"
    _written.setdefault(spark.sparkContext.applicationId, []).append(path)
    return path


def discard_written(spark: SparkSession, since: int = 0) -> int:
    """Delete the intermediate tables this session wrote; returns how many.

    Call it when no frame built on them is needed any more. Only paths handed out
    by ``new_path`` are touched, from the number ``since`` on. Deleting needs a
    session with a Spark context.
    """
    hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs.Path
    configuration = spark.sparkContext._jsc.hadoopConfiguration()
    written = _written.get(spark.sparkContext.applicationId, [])
    paths, written[since:] = written[since:], []
    for path in map(hadoop, paths):
        path.getFileSystem(configuration).delete(path, True)
    return len(paths)


@contextmanager
def scratch(spark: SparkSession):
    """Delete on leaving what was written to the shared folder inside the block.

    Results must be saved, or have been read, before the block ends.
    """
    before = len(_written.get(spark.sparkContext.applicationId, []))
    try:
        yield
    finally:
        discard_written(spark, before)


def materialize(df: DataFrame, label: str = "table", partition_by: Sequence[str] = ()) -> DataFrame:
    """Write ``df`` once to the shared folder and return a scan of that copy."""
    spark = df.sparkSession
    path = new_path(spark, label)
    df.write.partitionBy(*partition_by).parquet(path)
    return spark.read.schema(df.schema).parquet(path)


@contextmanager
def persisted(*frames: DataFrame):
    """Hold frames in memory and disk for the block, then always let them go."""
    held = [frame.persist(StorageLevel.MEMORY_AND_DISK) for frame in frames]
    try:
        yield held[0] if len(held) == 1 else tuple(held)
    finally:
        for frame in held:
            frame.unpersist()


def all_of(conditions: Sequence[Column]) -> Column:
    return reduce(lambda a, b: a & b, conditions)


def equal_keys(left: DataFrame, right: DataFrame, on: Sequence[str], how: str = "inner",
               extra: Column | None = None) -> DataFrame:
    """Equi-join that treats null as an ordinary key value, keeping the left keys."""
    renamed = right.withColumnsRenamed({key: f"__right_{key}" for key in on})
    condition = all_of([F.col(key).eqNullSafe(F.col(f"__right_{key}")) for key in on])
    if extra is not None:
        condition = condition & extra
    joined = left.join(renamed, condition, how)
    return joined if how == "left_semi" else joined.drop(*[f"__right_{key}" for key in on])


def total_bytes(df: DataFrame) -> Column:
    """Aggregate that measures a summary table: its texts plus 16 bytes per value."""
    texts = [F.coalesce(F.octet_length(name), F.lit(0)) for name, kind in df.dtypes if kind == "string"]
    row = reduce(lambda a, b: a + b, texts, F.lit(16 * len(df.columns)))
    return F.coalesce(F.sum(row.cast("bigint")), F.lit(0))


def join_summary(detail: DataFrame, summary: DataFrame, on: Sequence[str], how: str = "inner",
                 extra: Column | None = None, max_bytes: int = BROADCAST_MAX_BYTES) -> DataFrame:
    """Join a large table to per-group statistics of it, writing and measuring those first."""
    table = materialize(summary, "summary")
    return join_measured(detail, table, table.agg(total_bytes(table)).first()[0], on, how, extra, max_bytes)


def join_measured(detail: DataFrame, summary: DataFrame, size: int, on: Sequence[str], how: str = "inner",
                  extra: Column | None = None, max_bytes: int = BROADCAST_MAX_BYTES) -> DataFrame:
    """Join to a summary of known size in bytes.

    Up to ``max_bytes`` it is broadcast, so the detail side is not shuffled at
    all. Beyond that both sides are shuffled once; ``summary`` should be a written
    table, so that adaptive execution may split a hot key's rows over many tasks.
    """
    if size <= max_bytes:
        return equal_keys(detail, F.broadcast(summary), on, how, extra)
    return equal_keys(detail, summary.hint("merge"), on, how, extra)


def in_parallel(spark: SparkSession, function: Callable, jobs: Sequence, width: int = 4) -> list:
    """Run independent Spark actions a few at a time, so small stages overlap.

    Every job gets its own copy of the caller's local properties: Spark keeps a query's
    execution id there, and jobs that share one object clear it under each other. Each job
    also names a scheduler pool of its own, which counts where the cluster schedules fairly
    (``spark.scheduler.mode=FAIR``): a long fit then leaves tasks to a short one.
    """
    def alone(numbered: tuple):
        place, job, run = numbered
        return run(place, job)

    def pooled(place: int, job):
        spark.sparkContext.setLocalProperty("spark.scheduler.pool", f"parallel-{place}")
        return function(job)

    # The properties are copied when a function is wrapped, here once for every job.
    wrapped = [(i, job, inheritable_thread_target(spark)(pooled)) for i, job in enumerate(jobs)]
    with ThreadPool(width) as pool:
        return pool.map(alone, wrapped)
