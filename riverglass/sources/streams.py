"""Unbounded inputs."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

# The columns of a Kafka record as Spark reads it.
MESSAGE = ("key binary, value binary, topic string, partition int, offset bigint, "
           "timestamp timestamp, timestampType int")


def file_stream(spark: SparkSession, path: str, schema: str, fmt: str = "parquet",
                glob: str | None = None, files_per_batch: int | None = None) -> DataFrame:
    """Files of a folder as a stream, in the order of their modification times."""
    reader = spark.readStream.schema(schema).format(fmt)
    if glob:
        reader = reader.option("pathGlobFilter", glob)
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return reader.load(path)


def kafka_stream(spark: SparkSession, servers: str, topic: str, start: str = "latest",
                 per_batch: int | None = None, min_partitions: int | None = None,
                 **options: str) -> DataFrame:
    """A Kafka topic as a stream. The connector package comes with the deployment.

    `per_batch` bounds the records of one micro-batch; `min_partitions` splits a topic partition
    that holds far more records than the others over several tasks.
    """
    reader = (spark.readStream.format("kafka")
              .option("kafka.bootstrap.servers", servers)
              .option("subscribe", topic)
              .option("startingOffsets", start))
    if per_batch:
        reader = reader.option("maxOffsetsPerTrigger", per_batch)
    if min_partitions:
        reader = reader.option("minPartitions", min_partitions)
    for key, value in options.items():
        reader = reader.option(key.replace("__", "."), value)
    return reader.load()


def topic_replay(spark: SparkSession, path: str, topic: str | None = None,
                 files_per_batch: int | None = None) -> DataFrame:
    """A topic kept as Parquet files with Kafka's columns, replayed as a stream."""
    stream = file_stream(spark, path, MESSAGE, files_per_batch=files_per_batch)
    return stream.where(F.col("topic") == topic) if topic else stream


def message_columns(df: DataFrame, topic: str) -> DataFrame:
    """`key` and `value` columns completed to Kafka's columns, for a topic kept as files.

    No broker hands out positions here: the partition is the writing task's, and the offset is
    the row's place in it, or null on a stream, where Spark offers no row numbers.
    """
    if df.isStreaming:
        offset = F.lit(None).cast("long")
    else:
        offset = F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1))
    return df.select(
        F.col("key").cast("binary").alias("key"),
        F.col("value").cast("binary").alias("value"),
        F.lit(topic).alias("topic"),
        F.spark_partition_id().alias("partition"),
        offset.alias("offset"),
        F.current_timestamp().alias("timestamp"),
        F.lit(0).alias("timestampType"),
    )
