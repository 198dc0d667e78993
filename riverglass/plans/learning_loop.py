"""Learning analysis: live statistics, stored results, offline reports, live recommendations."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import DataStreamWriter

from riverglass.operators.als import AlsSettings
from riverglass.operators.learning import (answer_sums, difficulty_ratings, learning_report,
                                           progress)
from riverglass.operators.models import CurrentModel, retrain
from riverglass.sinks.keyed import KeyedTable, MergedTable
from riverglass.sinks.batches import BatchSink, fan_out
from riverglass.sinks.registry import Registry
from riverglass.streaming.recommend import live_recommendations
from riverglass.streaming.run import batches_to

PROGRESS = ("student_id string, subject string, question_id string, answers bigint, wrong bigint, "
            "first_answer timestamp, last_answer timestamp")


def stats_table(spark: SparkSession, path: str, by: Sequence[str] = ("question_id",), **options) -> MergedTable:
    """For `live_stats`; `operators.learning.stats_of_sums` gives the statistics."""
    schema = ", ".join([*(f"{c} string" for c in by), "answers bigint", "wrong bigint"])
    return MergedTable(spark, path, schema, by, {"answers": "sum", "wrong": "sum"}, **options)


def progress_table(spark: SparkSession, path: str, **options) -> MergedTable:
    """For `live_progress`."""
    return MergedTable(spark, path, PROGRESS, ["student_id", "subject", "question_id"],
                       {"answers": "sum", "wrong": "sum", "first_answer": "min", "last_answer": "max"}, **options)


def live_stats(answers: DataFrame, store: MergedTable) -> DataStreamWriter:
    """Answer statistics per key of the store. No state: a batch stores the sums of its own answers."""
    return batches_to(answers, lambda batch, batch_id: store.write(answer_sums(batch, store.keys), batch_id))


def live_progress(answers: DataFrame, store: MergedTable) -> DataStreamWriter:
    """Sums per student, subject and question, for offline reports."""
    return batches_to(answers, lambda batch, batch_id: store.write(progress(batch), batch_id))


def live_answers(answers: DataFrame, stats: MergedTable, progress_: MergedTable, *more: BatchSink) -> DataStreamWriter:
    """`live_stats` and `live_progress` in one query, which reads the topic once; `more` sinks get the statistics' sums."""
    def step(batch: DataFrame, batch_id: int) -> None:
        sums = answer_sums(batch, stats.keys)
        fan_out(stats.write, *more)(sums, batch_id) if more else stats.write(sums, batch_id)
        progress_.write(progress(batch), batch_id)

    return batches_to(answers, fan_out(step))


def offline_report(store: MergedTable) -> DataFrame:
    return learning_report(store.current())


def retrain_from(answers: DataFrame, registry: Registry, folder: str,
                 settings: AlsSettings = AlsSettings(), top: int = 10) -> int:
    """Train on all stored answers and publish the model with lists of `top` questions."""
    return retrain(difficulty_ratings(answers), registry, folder, settings, top)


def recommend_live(answers: DataFrame, models: CurrentModel, n: int,
                   store: KeyedTable) -> DataStreamWriter:
    """Recommendations for the students of each batch. The caller releases `models` when the
    query has ended."""
    return live_recommendations(answers, models, n, store.write)
