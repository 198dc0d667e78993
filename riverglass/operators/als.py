"""Matrix-factorization recommendations.

A rating matrix has the columns user, item and rating; `rating_matrix` makes it. Spark's ALS takes
integers only, so `train` numbers users and items of any type and the lists are given back in
their own ids. `fit` is for ids that are small integers already.
"""

from __future__ import annotations

import math
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass

from pyspark.ml.evaluation import RegressionEvaluator
from pyspark.ml.recommendation import ALS, ALSModel
from pyspark.sql import DataFrame, functions as F

from riverglass.operators.ids import dense_ids
from riverglass.operators.products import best_products
from riverglass.session import stored, work_dir

LEAST_BLOCKS = 10
CELL_RATINGS = 100_000  # ratings that one pair of a user and an item block holds
BLOCK_RATINGS = 20_000_000  # ratings that one block holds in memory, at some tens of bytes each


@dataclass(frozen=True)
class AlsSettings:
    rank: int = 10
    iterations: int = 10
    reg: float = 0.1
    seed: int = 42
    blocks: int | None = None


def rating_matrix(ratings: DataFrame, user: str, item: str, rating: str) -> DataFrame:
    """One mean rating per user and item, whose ids may be of any type; rows without one are left out.

    Adding up repeated ratings first bounds what the most active user brings to its block by the
    number of items.
    """
    known = F.col(user).isNotNull() & F.col(item).isNotNull() & F.col(rating).isNotNull()
    return ratings.where(known).groupBy(
        F.col(user).alias("user"), F.col(item).alias("item"),
    ).agg(F.avg(rating).cast("float").alias("rating"))


def blocks_for(ratings: int) -> int:
    """Blocks per side: pairs of them are shuffled as partitions, so their number is a square root."""
    return max(LEAST_BLOCKS, math.ceil(math.sqrt(ratings / CELL_RATINGS)))


def fewest_blocks(ratings: int) -> int:
    """As few blocks as hold the ratings, within `blocks_for`.

    In each round a user's factors go to every block with one of the user's items, and an item's likewise, so a round
    shuffles more for each row the more blocks there are.
    """
    return min(blocks_for(ratings), max(LEAST_BLOCKS, math.ceil(ratings / BLOCK_RATINGS)))


def fit(matrix: DataFrame, settings: AlsSettings = AlsSettings()) -> ALSModel:
    """Train on integer ids. Runs jobs.

    The matrix is stored first: ALS reads it in several stages and needs the same rows in
    each, also after an executor is lost. The number of blocks, on which the first factors hang, comes
    from the ratings alone, so equal data give equal lists on any cluster.
    """
    matrix = stored(matrix, "ratings")
    blocks = settings.blocks or fewest_blocks(matrix.count())
    als = ALS(userCol="user", itemCol="item", ratingCol="rating", rank=settings.rank,
              maxIter=settings.iterations, regParam=settings.reg, seed=settings.seed,
              numUserBlocks=blocks, numItemBlocks=blocks, coldStartStrategy="drop",
              checkpointInterval=5)
    return als.fit(matrix)


@dataclass(frozen=True)
class Trained:
    """A factor model and the numbers of its users and items: (key, user) and (key, item)."""

    model: ALSModel
    users: DataFrame
    items: DataFrame


def numbered(matrix: DataFrame, folder: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    """`matrix` with integer ids, and the two numberings, stored under `folder`. Runs jobs."""
    matrix = stored(matrix, "matrix")
    with ThreadPoolExecutor(2) as both:  # neither numbering needs the other
        users, items = both.map(lambda side: dense_ids(
            matrix.select(F.col(side).alias("key")), "key", f"{folder}/{side}s", side), ("user", "item"))
    left, right = users.withColumnRenamed("user", "u"), items.withColumnRenamed("item", "i")
    rows = matrix.join(left, matrix["user"] == left["key"]).drop("key").join(right, matrix["item"] == right["key"]).select(
        F.col("u").alias("user"), F.col("i").alias("item"), "rating")
    return rows, users, items


def train(matrix: DataFrame, settings: AlsSettings = AlsSettings(), folder: str | None = None) -> Trained:
    """Number the ids of a rating matrix, fit, and save everything under `folder`. Runs jobs."""
    folder = folder or work_dir(matrix.sparkSession, "als")
    rows, users, items = numbered(matrix, folder)
    return Trained(settled(fit(rows, settings), f"{folder}/model"), users, items)


def save(model: ALSModel, path: str) -> None:
    model.write().overwrite().save(path)


def load(path: str) -> ALSModel:
    return ALSModel.load(path)


def settled(model: ALSModel, path: str | None = None) -> ALSModel:
    """The model saved and read back. Runs jobs.

    The factors no longer hang on the training jobs, and they are split by size.
    """
    path = path or work_dir(model.userFactors.sparkSession, "factors")
    save(model, path)
    return load(path)


def _best(queries: DataFrame, rows: DataFrame, n: int, who: str, what: str) -> DataFrame:
    return best_products(queries, rows, n).withColumnsRenamed({"query": who, "row": what})


def for_all_users(model: ALSModel, n: int) -> DataFrame:
    """(user, place, item, score): the `n` items with the largest products of factors for every user, exactly. Runs jobs.

    Spark's `recommendForAllUsers` multiplies every user with every item; `best_products` gives the same lists by
    multiplying the pairs that bounds leave.
    """
    return _best(model.userFactors, model.itemFactors, n, "user", "item")


def for_all_items(model: ALSModel, n: int) -> DataFrame:
    """Users for every item. Runs jobs."""
    return _best(model.itemFactors, model.userFactors, n, "item", "user")


def for_users(model: ALSModel, users: DataFrame, n: int) -> DataFrame:
    """Items for the given users; a user the model has not seen gets none. Runs jobs."""
    chosen = model.userFactors.join(users.select(F.col("user").alias("id")), "id", "left_semi")
    return _best(chosen, model.itemFactors, n, "user", "item")


def for_items(model: ALSModel, items: DataFrame, n: int) -> DataFrame:
    """Users for the given items. Runs jobs."""
    chosen = model.itemFactors.join(items.select(F.col("item").alias("id")), "id", "left_semi")
    return _best(chosen, model.userFactors, n, "item", "user")


def _named(rows: DataFrame, trained: Trained, who: str, what: str) -> DataFrame:
    """Lists of numbers as lists of keys. Each entry meets the two numberings once, by equality."""
    keys = {"user": trained.users, "item": trained.items}
    for side in (who, what):
        rows = rows.join(keys[side], side).drop(side).withColumnRenamed("key", f"{side}_key")
    return rows.select(F.col(f"{who}_key").alias(who), "place", F.col(f"{what}_key").alias(what), "score")


def lists_for_users(trained: Trained, n: int, users: DataFrame | None = None) -> DataFrame:
    """(user, place, item, score): `n` items for every user, or for the given ones (a column of keys).

    A given user the model has not seen gets none.
    """
    if users is None:
        return _named(for_all_users(trained.model, n), trained, "user", "item")
    known = trained.users.join(users.toDF("key").distinct(), "key", "left_semi")
    return _named(for_users(trained.model, known, n), trained, "user", "item")


def lists_for_items(trained: Trained, n: int, items: DataFrame | None = None) -> DataFrame:
    """(item, place, user, score): `n` users for every item, or for the given ones."""
    if items is None:
        return _named(for_all_items(trained.model, n), trained, "item", "user")
    known = trained.items.join(items.toDF("key").distinct(), "key", "left_semi")
    return _named(for_items(trained.model, known, n), trained, "item", "user")


def split(matrix: DataFrame, test_share: float = 0.2, seed: int = 42) -> tuple[DataFrame, DataFrame]:
    """Training and test rows, chosen by a hash of user and item, so that a row falls on the same
    side each time it is computed."""
    draw = F.pmod(F.xxhash64("user", "item", F.lit(seed)), F.lit(1_000_000)) / F.lit(1_000_000)
    return matrix.where(draw >= test_share), matrix.where(draw < test_share)


def evaluate(model: ALSModel, train: DataFrame, test: DataFrame) -> DataFrame:
    """One row: the root mean squared error on the test rows, and that of always answering the
    mean training rating, over the same rows. Runs a job for the mean."""
    mean = train.agg(F.avg("rating")).first()[0]

    def error(guess):
        return F.sqrt(F.avg(F.pow(F.col("rating") - guess, F.lit(2))))

    return model.transform(test).agg(
        F.count(F.lit(1)).alias("test_rows"), error(F.col("prediction")).alias("rmse"),
        error(F.lit(mean)).alias("rmse_of_mean"))


def rmse(model: ALSModel, test: DataFrame) -> float:
    """The root mean squared error on the test rows. Runs a job."""
    return RegressionEvaluator(metricName="rmse", labelCol="rating",
                               predictionCol="prediction").evaluate(model.transform(test))
