"""Published versions: which path is the current one."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, Row, SparkSession, functions as F

SCHEMA = "version bigint, path string, published_at timestamp"


def stored_table(spark: SparkSession, path: str, schema, base: str | None = None) -> DataFrame | None:
    """The Parquet files under a path, or None where there is no such path."""
    reader = spark.read.schema(schema)
    try:
        return (reader.option("basePath", base) if base else reader).parquet(path)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return None


class Registry:
    """An append-only table of versions and paths.

    A version is published after everything under its path is written, so a reader sees either
    the old version or the new one whole. The table holds one row per version. Readers write nothing.
    """

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path

    def publish(self, version: int, path: str) -> None:
        row = self.spark.createDataFrame([Row(version=version, path=path)], "version bigint, path string")
        (row.withColumn("published_at", F.current_timestamp())
         .coalesce(1).write.mode("append").parquet(self.path))

    def versions(self) -> DataFrame:
        found = stored_table(self.spark, self.path, SCHEMA)
        return self.spark.createDataFrame([], SCHEMA) if found is None else found

    def current(self) -> Row | None:
        """The row of the largest version, or None before the first one."""
        if stored_table(self.spark, self.path, SCHEMA) is None:
            return None
        newest = self.versions().agg(
            F.max("version").alias("version"), F.max_by("path", "version").alias("path")).first()
        return newest if newest.version is not None else None
