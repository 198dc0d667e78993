"""Counts and top lists.

Counts combine before the shuffle, so a key that holds a third of all rows sends one partial
count per task. A top list is planned as a bounded per-task heap (`TakeOrderedAndProject`), a top
list per group as a limit per task and group ahead of the shuffle (`WindowGroupLimit`): neither
sorts or moves whole groups.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

GROUP_LIMIT = "spark.sql.optimizer.windowGroupLimitThreshold"


def counts(df: DataFrame, *keys: Column | str, name: str = "n") -> DataFrame:
    """Rows per key."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias(name))


def descending(by: str, ties: Sequence[str]) -> list[Column]:
    """Largest first; equal values in the order of `ties`, so that results are repeatable."""
    return [F.desc(by), *(F.asc(c) for c in ties)]


def top(df: DataFrame, n: int, by: str, ties: Sequence[str]) -> DataFrame:
    """The first `n` rows of the whole table."""
    return df.orderBy(*descending(by, ties)).limit(n)


def top_per_group(df: DataFrame, n: int, group: Sequence[str], by: str, ties: Sequence[str],
                  rank: str = "place", shares: int = 64) -> DataFrame:
    """The first `n` rows of every group, with their places from 1.

    Spark limits each group ahead of the shuffle only up to the `n` that the session sets. Beyond it the rows of
    a group are dealt to `shares` tasks first, each keeps its first `n`, and those are ranked. Both
    ways give the same rows.
    """
    order = descending(by, ties)
    place = F.row_number().over(Window.partitionBy(*group).orderBy(*order))
    if n >= int(df.sparkSession.conf.get(GROUP_LIMIT, "1000")):
        share = F.pmod(F.xxhash64(*ties), F.lit(shares))
        within = Window.partitionBy(*group, "share").orderBy(*order)
        df = (df.withColumn("share", share)
              .withColumn(rank, F.row_number().over(within))
              .where(F.col(rank) <= n).drop("share", rank))
    return df.withColumn(rank, place).where(F.col(rank) <= n)
