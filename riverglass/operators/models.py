"""Model versions: train, save, publish, and look up the current one.

A version is published with its lists: each student's questions, best first. Who recommends live looks
a student up; factors are not multiplied in a micro-batch.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession, functions as F

from riverglass.operators import als
from riverglass.sinks.registry import Registry

LISTS = "student_id string, questions array<struct<place: int, question_id: string, score: float>>"


@dataclass(frozen=True)
class Recommender:
    """The lists of one version: (student_id, questions), one row per student."""

    version: int
    lists: DataFrame


def question_lists(trained: als.Trained, top: int) -> DataFrame:
    """The `top` questions of every student as one row each."""
    rows = als.lists_for_users(trained, top).withColumnsRenamed({"user": "student_id", "item": "question_id"})
    # At most `top` rows per student.
    return rows.groupBy("student_id").agg(
        F.array_sort(F.collect_list(F.struct("place", "question_id", "score"))).alias("questions"))


def retrain(ratings: DataFrame, registry: Registry, folder: str,
            settings: als.AlsSettings = als.AlsSettings(), top: int = 10) -> int:
    """Train on (student_id, question_id, rating) rows, save the model, the numberings and the lists of `top`
    questions under a new path, then publish it.

    Runs jobs. Only one trainer may run at a time; readers may go on with the old version.
    """
    newest = registry.current()
    version = newest.version + 1 if newest else 1
    path = f"{folder}/version={version}"
    trained = als.train(als.rating_matrix(ratings, "student_id", "question_id", "rating"), settings, path)
    question_lists(trained, top).write.mode("overwrite").parquet(f"{path}/lists")
    registry.publish(version, path)
    return version


def load(spark: SparkSession, version: int, path: str) -> Recommender:
    return Recommender(version, spark.read.schema(LISTS).parquet(f"{path}/lists"))


class CurrentModel:
    """The published lists, read again only when a newer version appears.

    They are kept on the executors, so that a micro-batch does not read them again; a lost executor's
    share is read from the version's files.
    """

    def __init__(self, registry: Registry):
        self.registry = registry
        self.loaded: Recommender | None = None

    def get(self) -> Recommender | None:
        newest = self.registry.current()
        if newest and (self.loaded is None or self.loaded.version != newest.version):
            self.release()
            self.loaded = load(self.registry.spark, newest.version, newest.path)
            self.loaded.lists.persist(StorageLevel.MEMORY_AND_DISK)
        return self.loaded

    def release(self) -> None:
        if self.loaded is not None:
            self.loaded.lists.unpersist()
            self.loaded = None
