"""How good rankings and predictions are, on rows that were held out."""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from riverglass.operators.toplists import top_per_group


def held_out(*ids: str, parts: int = 5, part: int = 0) -> Column:
    """Whether a row is kept for testing: by arithmetic on integer ids, so that any engine finds the same rows."""
    mixed = F.lit(0).cast("long")
    for column in ids:
        mixed = mixed * 31 + F.pmod(F.col(column), F.lit(1_000_003))
    return F.pmod(mixed, F.lit(parts)) == part


def ranking_by_user(scored: DataFrame, k: int, user: str = "user", item: str = "item", score: str = "score",
                    relevant: str = "relevant") -> DataFrame:
    """(user, hits, relevant, precision, recall, ndcg) of each user's first `k` by score, ties by item.

    `relevant` is true for items the user likes. Users without any have no ranking to judge and are left
    out; a row without a score comes last. Each user's rows are cut to `k` per task before they meet.
    """
    liked = F.coalesce(F.col(relevant).cast("boolean"), F.lit(False))
    rows = scored.select(user, item, F.col(score).alias("__score"), liked.alias("__liked"))
    wanted = rows.where("__liked").groupBy(user).agg(F.count(F.lit(1)).alias("relevant"))
    first = top_per_group(rows.withColumn("__score", F.coalesce("__score", F.lit(-math.inf))), k, [user], "__score", [item])
    gain = F.when(F.col("__liked"), 1 / F.log2(F.col("place") + 1.0)).otherwise(0.0)
    seen = first.groupBy(user).agg(F.count(F.when(F.col("__liked"), 1)).alias("hits"), F.sum(gain).alias("__gain"))
    # The best possible gain for 1 to k relevant items.
    best = [sum(1 / math.log2(i + 2) for i in range(n)) for n in range(1, k + 1)]
    ideal = F.element_at(F.array(*map(F.lit, best)), F.least("relevant", F.lit(k)).cast("int"))
    return wanted.join(seen, user).select(
        user, "hits", "relevant", (F.col("hits") / F.lit(k)).alias("precision"),
        (F.col("hits") / F.col("relevant")).alias("recall"), (F.col("__gain") / ideal).alias("ndcg"))


def ranking_summary(by_user: DataFrame) -> DataFrame:
    """One row: the users and the means of their measures."""
    return by_user.agg(F.count(F.lit(1)).alias("users"), *(F.avg(c).alias(c) for c in ("precision", "recall", "ndcg")))


def errors(predicted: DataFrame, label: str = "rating", guesses: Sequence[str] = ("prediction",)) -> DataFrame:
    """One row: the rows with a label and the root mean squared error of each guess."""
    known = predicted.where(F.col(label).isNotNull())
    return known.agg(F.count(F.lit(1)).alias("rows"), *(
        F.sqrt(F.avg(F.pow(F.col(label) - F.col(g), F.lit(2)))).alias(f"rmse_of_{g}") for g in guesses))


def hits(predicted: DataFrame, label: str = "label", guess: str = "prediction") -> DataFrame:
    """(label, rows, right, share): how often each label was guessed right."""
    right = F.coalesce(F.col(label) == F.col(guess), F.lit(False))
    return predicted.groupBy(label).agg(
        F.count(F.lit(1)).alias("rows"), F.count(F.when(right, 1)).alias("right")).withColumn(
        "share", F.col("right") / F.col("rows"))


def item_means(ratings: DataFrame, item: str = "item", rating: str = "rating") -> DataFrame:
    """(item, score, popular): the mean rating of each item, a baseline that knows no user."""
    return ratings.groupBy(item).agg(F.avg(rating).alias("score"), F.count(rating).alias("popular"))
