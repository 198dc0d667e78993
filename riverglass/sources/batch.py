"""Batch scans. Every reader takes a fixed schema; none infers one from the data."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from riverglass.functions.messages import number
from riverglass.functions.text import term_costs
from riverglass.functions.times import day_time, epoch_seconds

RAW_SEARCH_LOG = "time string, user_id string, query string, result_rank string, click_seq string, url string"
SEARCH_LOG = "ts timestamp, user_id string, query string, result_rank int, click_seq int, url string"
RATINGS = ("user_id", "movie_id", "rating", "ts")


def table(spark: SparkSession, path: str, schema: str | None = None) -> DataFrame:
    """A Parquet table; its footer carries the schema unless one is given."""
    reader = spark.read.schema(schema) if schema else spark.read
    return reader.parquet(path)


def spread(scan: DataFrame) -> DataFrame:
    """Deal out the rows of a scan that has fewer tasks than there are cores.

    For work that costs far more than moving the row, such as splitting text. A scan with enough
    tasks is left alone, so what is moved is at most one split per core, whatever the table's
    size. `scan` must be free of shuffles, as its tasks are counted here without running it.
    """
    cores = scan.sparkSession.sparkContext.defaultParallelism
    return scan.repartition(cores) if scan.rdd.getNumPartitions() < cores else scan


# What Spark reads without being told that the Java runtime's other character sets are wanted too.
CHARSETS = ("iso-8859-1", "us-ascii", "utf-8", "utf-16", "utf-16be", "utf-16le", "utf-32")


def search_log(spark: SparkSession, path: str, sep: str = "\t", day: str | None = None,
               charset: str = "UTF-8") -> DataFrame:
    """A delimited search-engine click log as typed rows.

    `day` completes logs that carry only the time of day. Quotes are ordinary characters in a
    search query, so quoting is off. For a `charset` beyond Spark's short list, such as GBK, the session is
    set to take all that Java has.
    """
    if charset.lower() not in CHARSETS:
        spark.conf.set("spark.sql.legacy.javaCharsets", "true")
    raw = (spark.read.schema(RAW_SEARCH_LOG)
           .option("sep", sep).option("quote", "").option("encoding", charset)
           .csv(path))
    return wrap_search_log(raw, day)


def wrap_search_log(raw: DataFrame, day: str | None = None) -> DataFrame:
    """Raw text fields to typed fields; a field that cannot be read becomes null.

    Some logs put the query in square brackets and the rank and click number into one field
    separated by a space; both are undone here.
    """
    ts = day_time(day, F.col("time")) if day else F.try_to_timestamp("time")
    one_field = F.col("result_rank").contains(" ")
    parts = F.split("result_rank", " ")
    return raw.select(
        ts.alias("ts"),
        "user_id",
        F.regexp_replace("query", r"^\[(.*)\]$", "$1").alias("query"),
        F.when(one_field, parts[0]).otherwise(F.col("result_rank")).try_cast("int").alias("result_rank"),
        F.when(one_field, parts[1]).otherwise(F.col("click_seq")).try_cast("int").alias("click_seq"),
        F.when(one_field, F.col("click_seq")).otherwise(F.col("url")).alias("url"),
    )


def dictionary(spark: SparkSession, path: str, sep: str = "\t", charset: str = "UTF-8") -> DataFrame:
    """(term, cost): a dictionary from text lines of a term and, optionally, how often it was seen.

    A term without a number counts as seen once.
    """
    raw = (spark.read.schema("term string, seen string").option("sep", sep).option("quote", "")
           .option("encoding", charset).csv(path))
    seen = F.greatest(F.coalesce(F.col("seen").try_cast("long"), F.lit(1)), F.lit(1))
    return term_costs(raw.select(F.trim("term").alias("term"), seen.alias("searches")))


def ratings(spark: SparkSession, path: str, sep: str | None = None, ids: str = "string") -> DataFrame:
    """Ratings from Parquet, or from delimited text with epoch seconds as the fourth field.

    Ids are keys of any type: those of Parquet stay what they are, those of text are text, or of the
    type `ids`, where one that cannot be read ends the job instead of becoming null.
    """
    if sep is None:
        stored = spark.read.parquet(path)
        return stored.select("user_id", "movie_id", F.col("rating").cast("double").alias("rating"),
                             F.col("ts").cast("timestamp").alias("ts"))
    raw = (spark.read.schema("user_id string, movie_id string, rating string, seconds string")
           .option("sep", sep).csv(path))
    return raw.select(
        F.trim("user_id").cast(ids).alias("user_id"),
        F.trim("movie_id").cast(ids).alias("movie_id"),
        number(F.col("rating")).alias("rating"),
        epoch_seconds(F.col("seconds")).alias("ts"),
    )
