"""The given tables seen as ratings, searches, messages and answers."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from riverglass.functions.messages import json_rows, json_text, parse_json
from riverglass.operators.als import rating_matrix
from riverglass.sinks.topics import append_to_topic
from riverglass.sources.batch import spread, table
from riverglass.sources.streams import file_stream, topic_replay

# Reading the stored wall clock as `timestamp` takes it for UTC, whatever the session zone is.
EVENTS = ("event_id bigint, ts timestamp, user_id bigint, event_type string, value double, "
          "props string")


def given(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return table(spark, f"{sf_dir}/{name}.parquet")


def events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, f"{sf_dir}/events.parquet", EVENTS)


def events_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    return file_stream(spark, sf_dir, EVENTS, glob="events.parquet")


ARRIVALS, LATER, DELAY = 8, 2, "7 days"
FILES = 2


def arrivals(rows: DataFrame) -> DataFrame:
    """Events with the `batch` they arrive in: equal parts of the time, but every 97th event comes two parts later."""
    edge = rows.agg(F.unix_micros(F.min("ts")).alias("low"), F.unix_micros(F.max("ts")).alias("high")).first()
    parts = ARRIVALS - LATER
    low, width = edge.low or 0, (edge.high or 0) - (edge.low or 0) + 1
    part = F.floor((F.unix_micros("ts") - low) * parts / F.lit(width)).cast("int")
    return rows.withColumn("batch", part + F.when(F.col("event_id") % 97 == 5, LATER).otherwise(0))


def delayed_stream(spark: SparkSession, sf_dir: str, path: str) -> DataFrame:
    """Events as files in the order of their arrival, one batch for each part."""
    rows = arrivals(events(spark, sf_dir))
    for number in range(ARRIVALS):
        (rows.where(F.col("batch") == number).drop("batch").repartition(FILES)
         .write.parquet(f"{path}/part={number}"))
    return file_stream(spark, f"{path}/part=*", EVENTS, files_per_batch=FILES)


def item_ratings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each line item rates its supplier by its quantity."""
    return given(spark, sf_dir, "lineitem").select(
        F.col("l_suppkey").alias("movie_id"), F.col("l_quantity").alias("rating"))


def named_ratings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Discounted line items only, about 200 per supplier, and suppliers by name."""
    lines = given(spark, sf_dir, "lineitem").where(F.col("l_discount") <= 0.03)
    return lines.select(F.concat(F.lit("film "), "l_suppkey").alias("movie_id"), F.col("l_quantity").alias("rating"))


def part_matrix(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers rate the parts they ordered by the mean quantity."""
    lines = given(spark, sf_dir, "lineitem").select("l_orderkey", "l_partkey", "l_quantity")
    orders = given(spark, sf_dir, "orders").select("o_orderkey", "o_custkey")
    joined = lines.join(orders, lines.l_orderkey == orders.o_orderkey)
    return rating_matrix(joined, "o_custkey", "l_partkey", "l_quantity")


def planted_ratings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(user, item, rating): of the pairs of customer and part that were ordered, those whose keys agree by threes are liked."""
    pairs = part_matrix(spark, sf_dir).select("user", "item")
    liked = (F.col("user") + F.col("item")) % 3 == 0
    return pairs.withColumn("rating", F.when(liked, 5.0).otherwise(1.0) + (F.col("item") % 4) / 8)


def document_searches(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spread(given(spark, sf_dir, "documents").select(F.col("text").alias("query")))


def user_searches(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What the user side of each conversation wrote."""
    turns = given(spark, sf_dir, "conversations").where(F.col("role") == "user")
    return spread(turns.select(F.col("conv_id").alias("user_id"), F.col("text").alias("query")))


def number() -> Column:
    """The number in `props`."""
    return parse_json(F.col("props"), "k int")["k"]


def search_log_files(spark: SparkSession, sf_dir: str, path: str) -> None:
    """Events as a raw click log: time, user, query in brackets, rank and click in one field, address."""
    rows = events(spark, sf_dir)
    line = F.concat_ws("\t", F.date_format("ts", "yyyy-MM-dd HH:mm:ss"), F.col("user_id").cast("string"),
                       F.concat(F.lit("["), "event_type", F.lit("]")),
                       F.concat_ws(" ", number().cast("string"), (F.col("event_id") % 10).cast("string")),
                       F.concat(F.lit("example/"), F.col("event_id").cast("string")))
    rows.select(line.alias("value")).write.text(path)


def devices(rows: DataFrame) -> DataFrame:
    """Events as devices: the user is the device, the event type its type."""
    return rows.select("event_id", F.col("user_id").alias("device"),
                       F.col("event_type").alias("device_type"))


def device_signals(rows: DataFrame) -> DataFrame:
    """Events as device rows with the number in `props` as the signal."""
    keep = ["event_id", F.col("user_id").alias("device"), F.col("event_type").alias("device_type")]
    return json_rows(rows, F.col("props"), "k double", keep).withColumnRenamed("k", "signal")


def answers(rows: DataFrame) -> DataFrame:
    """Events as answers: a value above 50 is a wrong answer."""
    return rows.select(
        F.col("user_id").cast("string").alias("student_id"),
        F.concat_ws("-", "event_type", number().cast("string")).alias("question_id"),
        F.col("event_type").alias("subject"),
        (F.col("user_id") % 6 + 1).cast("string").alias("grade"),
        F.col("value").alias("score"),
        F.when(F.col("value") > 50, 0).otherwise(1).alias("correct"),
        "ts")


def write_topic(rows: DataFrame, path: str, topic: str, key: str, *fields) -> int:
    """Rows as JSON messages of a topic kept as files; returns the number of files.

    Rows are dealt out evenly, so a key with many rows makes no long file.
    """
    spark = rows.sparkSession
    files = max(spark.sparkContext.defaultParallelism,
                int(spark.conf.get("spark.sql.shuffle.partitions")))
    keyed = rows.select(F.col(key).cast("string").alias("key"), json_text(*fields).alias("value"))
    append_to_topic(keyed.repartition(files), path, topic)
    return files


def station_topic(spark: SparkSession, sf_dir: str, path: str) -> int:
    return write_topic(events(spark, sf_dir), path, "stationTopic", "user_id",
                F.col("user_id").cast("string").alias("station_id"),
                F.concat(F.lit("out-"), "event_id").alias("call_out"),
                F.concat(F.lit("in-"), "event_id").alias("call_in"),
                F.col("event_type").alias("status"),
                F.col("ts").alias("call_time"),
                number().alias("duration"))


def device_topic(spark: SparkSession, sf_dir: str, path: str) -> int:
    return write_topic(events(spark, sf_dir), path, "iotTopic", "user_id",
                F.col("user_id").cast("string").alias("device"),
                F.col("event_type").alias("device_type"),
                number().alias("signal"),
                F.unix_millis("ts").alias("time"))


def answer_topic(spark: SparkSession, sf_dir: str, path: str) -> int:
    rows = answers(events(spark, sf_dir))
    return write_topic(rows, path, "answerTopic", "student_id", *rows.columns)


def replay(spark: SparkSession, path: str, topic: str, files: int) -> DataFrame:
    """The topic as a stream of two micro-batches, so that state is carried over."""
    return topic_replay(spark, path, topic, files_per_batch=half(files))


def half(files: int) -> int:
    return -(-files // 2)
