"""Session helpers: one place for the configs every job relies on."""

from __future__ import annotations

import os
import tempfile

from pyspark.errors import PySparkException
from pyspark.sql import SparkSession

# Settings the jobs depend on for correctness (UTC timestamps, ANSI casts)
# and for scale (AQE coalescing and skew splitting).
_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.ui.enabled": "false",
    # checkpoint files of DataFrames that are gone are deleted by the context cleaner
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
}


def build_session(master: str = "local[*]", shuffle_partitions: int = 8, app: str = "rentyield",
                  extra: dict[str, str] | None = None) -> SparkSession:
    """Create (or reuse) a session with the configs above; used by tests and bench."""
    builder = SparkSession.builder.master(master).appName(app)
    conf = dict(_CONF)
    conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the cluster's shared checkpoint folder.

    On a cluster ``spark.checkpoint.dir`` names a shared folder and is used as is;
    if it is unset there, this raises rather than fall back to a machine-local
    folder executors cannot share. Only a local-mode session (tests) with no
    setting gets a fresh local scratch folder.
    """
    current = spark.conf.get("spark.checkpoint.dir", None)
    try:
        sc = spark.sparkContext
    except PySparkException as e:   # a Connect session has no context: the server applies its own setting
        if "NOT_SUPPORTED" not in (e.getCondition() or "") and "NOT_IMPLEMENTED" not in (e.getCondition() or ""):
            raise
        if current:
            return current
        raise RuntimeError("spark.checkpoint.dir is unset: set it to a folder shared by the cluster")
    if current:
        if sc.getCheckpointDir() is None:       # set once: each call makes a new sub-folder
            sc.setCheckpointDir(current)
        return current
    if not sc.master.startswith("local"):
        raise RuntimeError("spark.checkpoint.dir is unset: set it to a folder shared by the cluster")
    folder = tempfile.mkdtemp(prefix="rentyield-ckpt-", dir=os.environ.get("TMPDIR", "/tmp"))
    spark.conf.set("spark.checkpoint.dir", folder)
    sc.setCheckpointDir(folder)
    return folder
