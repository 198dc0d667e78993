"""Sinks for one micro-batch: functions of (batch, batch_id), as `foreachBatch` calls them.

A batch may be delivered again after a failure, with the same id. Each sink below therefore
either replaces what an earlier delivery wrote or stores the id so that readers drop the copy.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark import StorageLevel
from pyspark.sql import DataFrame, functions as F

BatchSink = Callable[[DataFrame, int], None]


def fan_out(*sinks: BatchSink) -> BatchSink:
    """Several sinks for each batch, which is computed once."""
    def write(batch: DataFrame, batch_id: int) -> None:
        batch.persist(StorageLevel.MEMORY_AND_DISK)
        try:
            for sink in sinks:
                sink(batch, batch_id)
        finally:
            batch.unpersist()
    return write


def show(rows: int = 20) -> BatchSink:
    """Print the first rows of each batch."""
    def write(batch: DataFrame, batch_id: int) -> None:
        print(f"batch {batch_id}")
        batch.show(rows, truncate=False)
    return write


def files(path: str, fmt: str = "parquet") -> BatchSink:
    """One folder for each batch; a second delivery replaces the first."""
    def write(batch: DataFrame, batch_id: int) -> None:
        batch.hint("rebalance").write.mode("overwrite").format(fmt).save(f"{path}/batch_id={batch_id}")
    return write


def jdbc(url: str, name: str, connections: int = 16, rows_per_insert: int = 5000,
         **options: str) -> BatchSink:
    """Append to a database table together with the batch id.

    Spark's JDBC writer has no upsert; readers take the row with the largest id for each key
    (`sources.latest`). `connections` bounds what the database has to serve at a time.
    """
    def write(batch: DataFrame, batch_id: int) -> None:
        (batch.withColumn("batch_id", F.lit(batch_id).cast("long"))
         .write.format("jdbc").mode("append").options(**options)
         .option("url", url).option("dbtable", name)
         .option("numPartitions", connections).option("batchsize", rows_per_insert)
         .save())
    return write


def connector(fmt: str, mode: str = "append", **options: str) -> BatchSink:
    """Any store with a Spark connector (key-value and wide-column stores among them).

    Stores that overwrite by key need no more than this; the batch id is passed along for
    those that keep every version.
    """
    def write(batch: DataFrame, batch_id: int) -> None:
        (batch.withColumn("batch_id", F.lit(batch_id).cast("long"))
         .write.format(fmt).mode(mode)
         .options(**{k.replace("__", "."): v for k, v in options.items()})
         .save())
    return write
