"""Stored results, read back for offline work."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, functions as F


def jdbc_by_range(spark: SparkSession, url: str, name: str, column: str, lower: str, upper: str,
                  partitions: int, **options: str) -> DataFrame:
    """A database table read by ranges of a numeric, date or timestamp column."""
    return (spark.read.format("jdbc").options(**options)
            .option("url", url).option("dbtable", name)
            .option("partitionColumn", column)
            .option("lowerBound", lower).option("upperBound", upper)
            .option("numPartitions", partitions)
            .load())


def jdbc_by_predicates(spark: SparkSession, url: str, name: str, predicates: Sequence[str],
                       **options: str) -> DataFrame:
    """A database table read with one task for each predicate; together they must cover it."""
    return spark.read.jdbc(url=url, table=name, predicates=list(predicates), properties=options)


def latest(df: DataFrame, keys: Sequence[str], version: str = "batch_id") -> DataFrame:
    """The row with the largest version for each key; copies of one version count once.

    `max_by` combines before the shuffle, so a key that was written in every batch sends one row
    per task.
    """
    values = [c for c in df.columns if c not in keys and c != version]
    kept = F.max_by(F.struct(*values, version), F.col(version)).alias("row")
    return df.groupBy(*keys).agg(kept).select(*keys, "row.*")


def newest(df: DataFrame, keys: Sequence[str], version: str = "batch_id") -> DataFrame:
    """`latest` for rows of which a key has one at most per version.

    The largest version per key comes from a hash aggregate, and the rows are picked by a hash join
    with it, so nothing is sorted; null keys count as equal.
    """
    marks = df.groupBy(*(F.col(k).alias(f"__{k}") for k in keys)).agg(F.max(version).alias("__version"))
    met = F.col(version) == F.col("__version")
    for k in keys:
        met = met & F.col(k).eqNullSafe(F.col(f"__{k}"))
    return df.join(marks.hint("shuffle_hash"), met).select(*df.columns)
