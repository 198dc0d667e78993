"""Late rows: counted and kept apart, where a watermark alone would drop them without a trace."""

from __future__ import annotations

from collections.abc import Callable

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import DataStreamWriter

from riverglass.sinks.keyed import MergedTable
from riverglass.streaming.run import batches_to

BatchSink = Callable[[DataFrame, int], None]


def marks_table(spark: SparkSession, path: str, **options) -> MergedTable:
    """One row: the newest event time seen, the rows and the late rows among them."""
    return MergedTable(spark, path, "stream string, newest timestamp, rows bigint, late bigint", ["stream"],
                       {"newest": "max", "rows": "sum", "late": "sum"}, **options)


def watermark(marks: MergedTable, batch_id: int, delay: str):
    """The time before which rows of a batch are late: `delay` before the newest of all earlier batches.

    Only batches before this one count, so a batch that is delivered again is judged as it was.
    """
    earlier = marks.history().where(F.col("batch_id") < batch_id)
    return earlier.agg((F.max("newest") - F.expr(f"interval {delay}")).alias("at")).first()["at"]


def apart(stream: DataFrame, delay: str, on_time: BatchSink, late_path: str, marks: MergedTable,
          ts: str = "ts") -> DataStreamWriter:
    """Give each batch's rows to `on_time`, but its late ones to `late_path`/batch_id=N with the limit they missed.

    Rows without a time are on time. The batch is kept while it is split and counted; its rows, late rows and newest
    time are stored in `marks` last, as the batch's own share. The query has no state.
    """
    def step(batch: DataFrame, batch_id: int) -> None:
        limit = F.lit(watermark(marks, batch_id, delay)).cast("timestamp")
        late = F.coalesce(F.col(ts) < limit, F.lit(False))
        batch.persist(StorageLevel.MEMORY_AND_DISK)
        try:
            (batch.where(late).withColumn("watermark", limit)
             .write.mode("overwrite").parquet(f"{late_path}/batch_id={batch_id}"))
            on_time(batch.where(~late), batch_id)
            marks.write(batch.agg(F.lit("").alias("stream"), F.max(ts).cast("timestamp").alias("newest"),
                                  F.count(F.lit(1)).alias("rows"), F.count(F.when(late, 1)).alias("late")), batch_id)
        finally:
            batch.unpersist()

    return batches_to(stream, step)


def late_rows(spark: SparkSession, late_path: str, schema: str) -> DataFrame:
    """The rows kept apart so far, with their batch and the limit they missed."""
    return spark.read.schema(f"{schema}, watermark timestamp, batch_id bigint").parquet(late_path)
