"""From one topic, cleaned, into another."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql.streaming import DataStreamWriter

from riverglass.operators.stations import clean, station_rows
from riverglass.sinks.topics import kafka_writer, messages, topic_writer
from riverglass.sources.streams import kafka_stream, topic_replay


def cleaned_messages(stream: DataFrame, rule: Column | None = None) -> DataFrame:
    """Station messages that meet the rule, keyed by station. Stateless: no shuffle."""
    return messages(clean(station_rows(stream), rule), "station_id")


def kafka_to_kafka(spark: SparkSession, servers: str, rule: Column | None = None,
                   source: str = "stationTopic", target: str = "etlTopic", start: str = "latest",
                   per_batch: int | None = None) -> DataStreamWriter:
    stream = kafka_stream(spark, servers, source, start, per_batch)
    return kafka_writer(cleaned_messages(stream, rule), servers, target)


def files_to_files(spark: SparkSession, source: str, target: str, rule: Column | None = None,
                   files_per_batch: int | None = None) -> DataStreamWriter:
    """The same job between topics kept as files."""
    stream = topic_replay(spark, source, "stationTopic", files_per_batch)
    return topic_writer(cleaned_messages(stream, rule), target, "etlTopic")
