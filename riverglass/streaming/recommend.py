"""Live recommendation of error-prone questions."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, functions as F
from pyspark.sql.streaming import DataStreamWriter

from riverglass.operators.models import CurrentModel, Recommender
from riverglass.streaming.run import batches_to

BatchSink = Callable[[DataFrame, int], None]
QUESTIONS = "array<struct<place: int, question_id: string, score: float>>"
RECOMMENDATIONS = f"student_id string, model_version bigint, questions {QUESTIONS}"


def recommend(students: DataFrame, current: Recommender | None, n: int) -> DataFrame:
    """The first `n` published questions of each student: those they most likely get wrong.

    One join by student with the published lists. A student they don't have keeps a row with an empty
    list, and so does every student before the first model, with no version.
    """
    distinct = students.select("student_id").where(F.col("student_id").isNotNull()).distinct()
    nothing = F.array().cast(QUESTIONS)
    if current is None:
        return distinct.select("student_id", F.lit(None).cast("long").alias("model_version"), nothing.alias("questions"))
    return distinct.join(current.lists, "student_id", "left").select(
        "student_id", F.lit(current.version).cast("long").alias("model_version"),
        F.coalesce(F.slice("questions", 1, n), nothing).alias("questions"))


def live_recommendations(answers: DataFrame, models: CurrentModel, n: int,
                         sink: BatchSink) -> DataStreamWriter:
    """For each micro-batch, recommend to its students with the lists published at that time.

    Lists are as long as they were published; an `n` beyond that gives those.
    """
    return batches_to(answers.select("student_id"),
                      lambda batch, batch_id: sink(recommend(batch, models.get(), n), batch_id))


def with_stored(answers: DataFrame, recommendations: DataFrame) -> DataFrame:
    """Answers, live or stored, beside recommendations computed earlier, null where there are
    none. Spark broadcasts the lists only if they are below its size limit."""
    return answers.join(recommendations, "student_id", "left")
