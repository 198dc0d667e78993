"""Topics: Kafka in production, folders of files with the same columns for replay."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F
from pyspark.sql.streaming import DataStreamWriter

from riverglass.functions.messages import json_text
from riverglass.sources.streams import message_columns


def messages(df: DataFrame, key: str, fields: list[str] | None = None) -> DataFrame:
    """Rows as `key` and JSON `value` bytes."""
    names = fields or df.columns
    return df.select(F.col(key).cast("string").cast("binary").alias("key"),
                     json_text(*names).cast("binary").alias("value"))


def kafka_writer(df: DataFrame, servers: str, topic: str, **options: str) -> DataStreamWriter:
    """A stream of `key` and `value` into a Kafka topic."""
    writer = (df.writeStream.format("kafka").outputMode("append")
              .option("kafka.bootstrap.servers", servers).option("topic", topic))
    for name, value in options.items():
        writer = writer.option(name.replace("__", "."), value)
    return writer


def topic_writer(df: DataFrame, path: str, topic: str) -> DataStreamWriter:
    """A stream of `key` and `value` into a folder that `topic_replay` can read.

    The folder's commit log makes the files of each batch visible once.
    """
    return (message_columns(df, topic).writeStream.format("parquet").outputMode("append")
            .option("path", path))


def append_to_topic(df: DataFrame, path: str, topic: str) -> None:
    """The batch counterpart of `topic_writer`."""
    message_columns(df, topic).write.mode("append").parquet(path)
