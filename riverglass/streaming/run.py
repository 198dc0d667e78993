"""Starting and finishing streaming queries."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql.streaming import DataStreamWriter, StreamingQuery


def start(writer: DataStreamWriter, checkpoint: str, every: str = "10 seconds") -> StreamingQuery:
    """Run until stopped, one micro-batch per interval."""
    return (writer.option("checkpointLocation", checkpoint)
            .trigger(processingTime=every).start())


def drain(writer: DataStreamWriter, checkpoint: str) -> StreamingQuery:
    """Process what the source holds now, in as many batches as the source is split into, and
    return the finished query. A failure is raised here."""
    query = (writer.option("checkpointLocation", checkpoint)
             .trigger(availableNow=True).start())
    query.awaitTermination()
    return query


def batches_to(stream: DataFrame, sink: Callable[[DataFrame, int], None],
               mode: str = "append") -> DataStreamWriter:
    """Any relational step and any sink on each micro-batch."""
    return stream.writeStream.outputMode(mode).foreachBatch(adaptively(sink))


def adaptively(sink: Callable[[DataFrame, int], None]) -> Callable[[DataFrame, int], None]:
    """`sink` with adaptive execution.

    Spark plans a stateful stream without it, as its state is tied to fixed partitions, and the
    micro-batch's session inherits that. What the sink does with the finished batch is ordinary
    batch work, whose joins and writes gain from skew handling and from merging small partitions.
    """
    key = "spark.sql.adaptive.enabled"

    def run(batch: DataFrame, batch_id: int) -> None:
        conf = batch.sparkSession.conf
        before = conf.get(key)
        conf.set(key, "true")
        try:
            sink(batch, batch_id)
        finally:
            conf.set(key, before)

    return run


def files_to(stream: DataFrame, path: str, fmt: str = "parquet") -> DataStreamWriter:
    """Append to files; the folder's commit log makes each batch visible once."""
    return stream.writeStream.outputMode("append").format(fmt).option("path", path)


def console(stream: DataFrame, mode: str = "append", rows: int = 20) -> DataStreamWriter:
    """Print each micro-batch."""
    return (stream.writeStream.outputMode(mode).format("console")
            .option("numRows", rows).option("truncate", "false"))
