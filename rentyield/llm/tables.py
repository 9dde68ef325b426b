"""Small helpers shared by the operators: reading a driver table, durable intermediate tables."""

from __future__ import annotations

import gc
import time
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rentyield.session import ensure_checkpoint_dir


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def durable(df: DataFrame) -> DataFrame:
    """Cut the lineage by a reliable checkpoint in the session's shared folder."""
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def stored(df: DataFrame) -> DataFrame:
    """The rows as a Parquet table in the session's shared folder, packed smaller than a checkpoint would be."""
    spark = df.sparkSession
    path = f"{ensure_checkpoint_dir(spark).rstrip('/')}/stored-{uuid.uuid4().hex}"
    df.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def numbered(df: DataFrame, name: str = "_row") -> DataFrame:
    """The rows with a number each, stored: however the input is planned or read again, a row keeps its number."""
    return stored(df.withColumn(name, F.monotonically_increasing_id()))


def fewer_tasks(df: DataFrame, max_bytes: int = 32 << 20) -> DataFrame:
    """The rows in tasks of up to ``max_bytes`` (as stored), where they come in more and smaller ones.

    For jobs whose output grows with the number of tasks, such as counts of distinct things per task. No shuffle; an input of
    large files, or one with no more tasks than cores, is left as it is.
    """
    size = int(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes())
    want = max(df.sparkSession.sparkContext.defaultParallelism, -(-size // max_bytes))
    return df.coalesce(want) if df.rdd.getNumPartitions() > want else df


def release(spark: SparkSession) -> None:
    """Let Spark's cleaner delete the shuffle files and checkpoints that nothing refers to any more.

    It acts on what the driver's garbage collector finds; where there is room the driver seldom
    collects, and a job of many steps would keep the files of all. Two rounds: the first one frees
    the last job's plan.
    """
    for _ in range(2):
        gc.collect()
        spark.sparkContext._jvm.System.gc()
        time.sleep(0.3)
