"""Session settings and the shared folder that jobs may write to."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession

CHECKPOINT_KEY = "spark.checkpoint.dir"

# Settings every job wants, whatever the cluster. Sizes (executors, memory, shuffle partitions)
# belong to the deployment and are left to spark-submit.
SETTINGS = {
    # Remove a checkpoint's files once nothing refers to it.
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
    # Event times are UTC wall clock; pinning the zone keeps window edges the same everywhere.
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Streaming state (window, key) can outgrow the heap: keep it in RocksDB and upload only the
    # change log at each commit.
    "spark.sql.streaming.stateStore.providerClass":
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
}


def build_session(app: str = "riverglass", master: str | None = None, **conf: str) -> SparkSession:
    """A session with the settings above; `conf` keys use `__` for dots and win over them."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in SETTINGS.items():
        builder = builder.config(key, value)
    for key, value in conf.items():
        builder = builder.config(key.replace("__", "."), value)
    return builder.getOrCreate()


def shared_dir(spark: SparkSession) -> str:
    """The folder all executors can reach, read from `spark.checkpoint.dir`.

    Unset is accepted only on a local master, where one machine is the whole cluster.
    """
    configured = spark.conf.get(CHECKPOINT_KEY, None)
    if configured:
        return configured.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError(f"set {CHECKPOINT_KEY} to a folder that every executor can reach")
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="riverglass-"))
    return spark.sparkContext.getCheckpointDir()


def work_dir(spark: SparkSession, purpose: str) -> str:
    """A new folder name under the shared folder."""
    return f"{shared_dir(spark)}/riverglass/{purpose}-{uuid.uuid4().hex}"


def reliable(df):
    """Cut the lineage of `df` with a checkpoint in the shared folder.

    Used where one result feeds many jobs, so that a lost executor costs one re-read and not a
    recomputation whose row order may differ.
    """
    spark = df.sparkSession
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(shared_dir(spark))
    return df.checkpoint(eager=True)


def stored(df, purpose: str):
    """`df` written to the shared folder and read back: for tables that a checkpoint would hold less tightly."""
    path = work_dir(df.sparkSession, purpose)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
