"""Dense integer ids for keys of any type, as ALS needs them."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

SLOT_BITS = 33
MAX_IDS = 2**31 - 1  # what Spark's ALS can number


def number_in_order(rows: DataFrame, order: Sequence[Column], path: str, name: str, most: int = 2**62) -> DataFrame:
    """`rows` with a number from 0 in the given order, stored under `path`.

    Rows are range-sorted, each task numbers its own, and only the number of rows per task is added up.
    Rows and places are written, so that a task run again later sees the same. More than `most`
    rows are refused.
    """
    spark = rows.sparkSession
    rows.write.mode("overwrite").parquet(f"{path}/keys")
    (spark.read.schema(rows.schema).parquet(f"{path}/keys")
     .repartitionByRange(*order).sortWithinPartitions(*order)
     .withColumn("slot", F.monotonically_increasing_id())
     .write.mode("overwrite").parquet(f"{path}/slots"))

    slots = (spark.read.parquet(f"{path}/slots")
             .withColumn("task", F.shiftright("slot", SLOT_BITS))
             .withColumn("place", F.col("slot").bitwiseAND(F.lit((1 << SLOT_BITS) - 1))))
    per_task = slots.groupBy("task").agg(F.count(F.lit(1)).alias("keys"))
    size = per_task.agg(F.sum("keys")).first()[0] or 0
    if size > most:
        raise ValueError(f"{size} keys are more than {most}")

    # One row per task is sorted in one place; what is sent out is left to Spark's size limit.
    before = Window.orderBy("task").rowsBetween(Window.unboundedPreceding, -1)
    offsets = per_task.select("task", F.coalesce(F.sum("keys").over(before), F.lit(0)).alias("offset"))
    kind = "int" if most <= MAX_IDS else "long"
    (slots.join(offsets, "task")
     .select(*rows.columns, (F.col("offset") + F.col("place")).cast(kind).alias(name))
     .write.mode("overwrite").parquet(f"{path}/ids"))
    return spark.read.parquet(f"{path}/ids")


def dense_ids(df: DataFrame, column: str, path: str, name: str) -> DataFrame:
    """Number the distinct keys 0, 1, 2, ... in their order and store the numbering under `path`.

    `StringIndexer` would gather all keys on the driver. As the order of the keys decides, equal keys get equal
    numbers on any cluster. Nulls get no number. More keys than an integer can number are refused.
    """
    keys = df.select(column).where(F.col(column).isNotNull()).distinct()
    return number_in_order(keys, [F.col(column)], path, name, MAX_IDS)


def frequency_ids(df: DataFrame, column: str, path: str, name: str) -> DataFrame:
    """(column, name): distinct keys numbered by how often they come, the most frequent first, ties by key."""
    counts = df.where(F.col(column).isNotNull()).groupBy(column).agg(F.count(F.lit(1)).alias("__seen"))
    return number_in_order(counts, [F.desc("__seen"), F.col(column)], path, name).drop("__seen")
