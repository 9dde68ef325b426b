"""Table scan and sink (IO07-IO09).

A target is either a catalog table name (``db.table``) or a folder path (any
value containing '/'); a layer is just a naming rule.
"""

from __future__ import annotations

import gc
import time
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from contextvars import ContextVar

from pyspark.errors import PySparkException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import ensure_checkpoint_dir

_PASSING: ContextVar[list[str] | None] = ContextVar("passing", default=None)


def _is_path(target: str) -> bool:
    return "/" in target


def ensure_namespace(spark: SparkSession, database: str) -> None:
    """IO09: create the database when absent."""
    spark.sql(f"CREATE SCHEMA IF NOT EXISTS `{database}`")


def load(spark: SparkSession, target: str) -> DataFrame:
    """IO07: read a saved layer table."""
    return spark.read.parquet(target) if _is_path(target) else spark.table(target)


def save(df: DataFrame, target: str, partition_by: list[str] | None = None) -> None:
    """IO08: overwrite, replacing the schema (overwrite rewrites data and schema)."""
    w = df.write.mode("overwrite")
    if partition_by:
        w = w.partitionBy(*partition_by)
    if _is_path(target):
        w.parquet(target)
    else:
        w.format("parquet").saveAsTable(target)


def written(df: DataFrame) -> tuple[DataFrame, str]:
    """The rows as a new Parquet table in the session's shared checkpoint folder, and its path.

    Cuts the lineage as ``checkpoint()`` does, and the optimizer's knowledge of the plan with it: in a loop of many steps
    the constraints that a checkpoint carries on would grow from step to step.
    """
    spark = df.sparkSession
    path = f"{ensure_checkpoint_dir(spark).rstrip('/')}/table-{uuid.uuid4().hex}"
    noted = _PASSING.get()
    if noted is not None:
        noted.append(path)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path), path


def drop_written(spark: SparkSession, paths: list[str]) -> None:
    """Delete tables that ``written`` made, in whatever store they are."""
    sc = spark.sparkContext
    for path in paths:
        p = sc._jvm.org.apache.hadoop.fs.Path(path)
        p.getFileSystem(sc._jsc.hadoopConfiguration()).delete(p, True)


@contextmanager
def passing(spark: SparkSession) -> Iterator[None]:
    """Tables that ``written`` makes within are deleted at the end: for a step that saves what it made of them."""
    paths: list[str] = []
    token = _PASSING.set(paths)
    try:
        yield
    finally:
        _PASSING.reset(token)
        drop_written(spark, paths)


def release(spark: SparkSession) -> None:
    """Let Spark's cleaner delete the shuffle files and checkpoints that nothing refers to any more.

    It acts on what the driver's garbage collector finds; a driver with room seldom collects, and a run of many
    steps would keep the files of all. Two rounds: the first one frees the last job's plan.
    """
    try:
        jvm = spark.sparkContext._jvm
    except PySparkException as e:             # a Connect session: its server's driver collects by itself
        if "NOT_SUPPORTED" not in (e.getCondition() or "") and "NOT_IMPLEMENTED" not in (e.getCondition() or ""):
            raise
        return
    for _ in range(2):
        gc.collect()
        jvm.System.gc()
        time.sleep(0.3)


def preview(df: DataFrame, n: int = 5) -> DataFrame:
    """IO15: the first n rows (a preview is the feature; plans as a local limit)."""
    return df.limit(n)


def spread(df: DataFrame, min_partitions: int | None = None, parallel_filters: bool = False) -> DataFrame:
    """Give a CPU-heavy stage at least one task per core.

    A scan yields one task per file split; a single-row-group file or a
    multi-line JSON document is one task, and every fused narrow step after it
    (text parsing, the spatial test) would run on one core. When the scan has
    fewer partitions than ``min_partitions`` (default: the cluster's default
    parallelism) the rows are spread; on large inputs,
    which already have many more splits than that, this is a no-op and no
    shuffle is added.

    Default: round-robin. It names no column, so column pruning and literal
    filters still reach the scan, and Spark sorts before dealing so a retried
    task gets the same rows. ``parallel_filters=True`` hashes on the row id
    instead: Catalyst then keeps filters above the spread, so filters on parsed
    text (which cannot reach the scan anyway) run on every core rather than in
    the single scan task; a lost shuffle output reruns the whole spread stage.
    Column pruning is unaffected either way.
    """
    try:
        want = min_partitions or df.sparkSession.sparkContext.defaultParallelism
        have = df.rdd.getNumPartitions()      # planning only; no job runs
    except PySparkException as e:             # a Connect session has no RDDs
        if "NOT_SUPPORTED" not in (e.getCondition() or "") and "NOT_IMPLEMENTED" not in (e.getCondition() or ""):
            raise
        return df
    if have >= want:
        return df
    if parallel_filters:
        return df.repartition(want, F.monotonically_increasing_id())
    return df.repartition(want)
