"""Answer statistics and learning reports.

Answers have the columns student_id, question_id, subject, grade, score, correct (0 or 1), ts.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from riverglass.functions.messages import json_rows, number, string_payload
from riverglass.operators.toplists import top

ANSWER = ("student_id string, question_id string, subject string, grade string, "
          "score string, correct string, ts string")


def wrong_answers() -> Column:
    return F.sum(F.lit(1) - F.col("correct"))


def answer_rows(messages: DataFrame) -> DataFrame:
    """Typed rows from answer messages; those without student, question or a result of 0 or 1 are left out."""
    parsed = json_rows(messages, string_payload(F.col("value")), ANSWER)
    typed = parsed.select(
        "student_id", "question_id", "subject", "grade",
        number(F.col("score")).alias("score"),
        F.col("correct").try_cast("int").alias("correct"),
        F.try_to_timestamp("ts").alias("ts"),
    )
    return typed.where(F.col("student_id").isNotNull() & F.col("question_id").isNotNull()
                       & F.col("correct").isin(0, 1))


def answer_stats(answers: DataFrame, by: Sequence[str] = ("question_id",)) -> DataFrame:
    """Answers, wrong answers and wrong rate per question, subject, grade or any of them."""
    return stats_of_sums(answer_sums(answers, by))


def answer_sums(answers: DataFrame, by: Sequence[str] = ("question_id",)) -> DataFrame:
    """The part of `answer_stats` that can be added up."""
    return answers.groupBy(*by).agg(
        F.count(F.lit(1)).alias("answers"), wrong_answers().cast("long").alias("wrong"))


def stats_of_sums(sums: DataFrame) -> DataFrame:
    return sums.withColumn("wrong_rate", F.col("wrong") / F.col("answers"))


def error_prone(answers: DataFrame, n: int = 10, min_answers: int = 10) -> DataFrame:
    """The questions answered wrong most often, among those with enough answers."""
    stats = answer_stats(answers).where(F.col("answers") >= min_answers)
    return top(stats, n, "wrong_rate", ["question_id"])


def progress(answers: DataFrame) -> DataFrame:
    """Sums per student, subject and question: what a live job stores for offline reports."""
    return answers.groupBy("student_id", "subject", "question_id").agg(
        F.count(F.lit(1)).alias("answers"), wrong_answers().cast("long").alias("wrong"),
        F.min("ts").alias("first_answer"), F.max("ts").alias("last_answer"))


def learning_report(stored: DataFrame) -> DataFrame:
    """Per student and subject, from `progress` rows: answers, wrong rate, distinct questions,
    first and last activity."""
    sums = stored.groupBy("student_id", "subject").agg(
        F.sum("answers").alias("answers"), F.sum("wrong").alias("wrong"),
        F.count(F.lit(1)).alias("questions"),
        F.min("first_answer").alias("first_answer"), F.max("last_answer").alias("last_answer"))
    return sums.withColumn("wrong_rate", F.col("wrong") / F.col("answers"))


def learning_report_sql(stored: DataFrame) -> DataFrame:
    """`learning_report` as SQL over the stored results."""
    return stored.sparkSession.sql("""
        SELECT student_id, subject, sum(answers) AS answers, sum(wrong) AS wrong,
               count(1) AS questions, min(first_answer) AS first_answer,
               max(last_answer) AS last_answer, sum(wrong) / sum(answers) AS wrong_rate
        FROM {stored}
        GROUP BY student_id, subject""", stored=stored)


def ratings_of_progress(stored: DataFrame) -> DataFrame:
    """`difficulty_ratings` from `progress` rows."""
    return stored.groupBy("student_id", "question_id").agg(
        (F.sum("wrong") / F.sum("answers")).cast("float").alias("rating"))


def difficulty_ratings(answers: DataFrame) -> DataFrame:
    """One rating per student and question: the share of wrong answers."""
    return answers.groupBy("student_id", "question_id").agg(
        (wrong_answers() / F.count(F.lit(1))).cast("float").alias("rating"))
