"""Session settings the engine expects, and the shared folder for written intermediate tables."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession

SETTINGS = {
    # Event times are UTC; hour-of-day rules and daily marts depend on it.
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Call sites recorded for error messages: one stack inspection per column expression, which
    # takes longer than planning a query does.
    "spark.python.sql.dataFrameDebugging.enabled": "false",
    "spark.sql.streaming.stateStore.providerClass":
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
}


def session(app: str = "kwarta", master: str | None = None, **extra: str) -> SparkSession:
    """A session with the engine's settings. The master comes from spark-submit unless given."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in {**SETTINGS, **extra}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


#: Splits of files per core. With barely more than one each, a second round for the few left over doubles the time.
SPLITS_PER_CORE = 3
_SPLITS = "spark.sql.files.minPartitionNum"


def even_splits(spark: SparkSession) -> None:
    """Have files read in splits that even out over the cores, unless the session has a number of its own. Small files
    are not split for it. It stays set: a stream of files is planned by this session for as long as it runs."""
    if spark.conf.get(_SPLITS, None) is None:
        spark.conf.set(_SPLITS, str(SPLITS_PER_CORE * spark.sparkContext.defaultParallelism))


def work_folder(spark: SparkSession, label: str) -> str:
    """A new folder for one run, below the shared folder the cluster names.

    Only a local session (a laptop, a test) may do without one: on a cluster the executors would each
    write to a disk of their own.
    """
    shared = spark.conf.get("spark.checkpoint.dir", None)
    if shared:
        return f"{shared.rstrip('/')}/kwarta-{label}-{uuid.uuid4().hex}"
    if not spark.conf.get("spark.master", "local").startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder all executors share")
    return tempfile.mkdtemp(prefix=f"kwarta-{label}-")
