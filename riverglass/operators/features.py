"""Cleaning for machine learning, and a classifier, as Spark ML pipelines."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import SQLTransformer
from pyspark.ml.functions import array_to_vector
from pyspark.sql import DataFrame, functions as F

from riverglass.operators.ids import frequency_ids
from riverglass.session import work_dir


@dataclass(frozen=True)
class Cleaning:
    """What was learned from a table: the filling of missing numbers, and the categories' numbers."""

    filling: PipelineModel
    indexes: dict[str, DataFrame]  # per column (value, index)
    sizes: dict[str, int]

    def apply(self, df: DataFrame) -> DataFrame:
        """`df` cleaned: rows that meet the rule, numbers as `*_filled`, categories as `*_index`.

        A missing category and one that was not learned get the number after the last. Each category column
        is one join by its values, so a table of any size will do.
        """
        rows = self.filling.transform(df)
        for column, index in self.indexes.items():
            known = index.select(F.col(column).alias("__value"), F.col("index").alias("__index"))
            rows = rows.join(known, rows[column] == F.col("__value"), "left").withColumn(
                f"{column}_index", F.coalesce("__index", F.lit(self.sizes[column])).cast("double")).drop("__value", "__index")
        return rows


def fit_cleaning(df: DataFrame, numbers: Sequence[str], categories: Sequence[str], rule: str = "true",
                 folder: str | None = None) -> Cleaning:
    """Learn a cleaning from `df`. Runs jobs.

    Rows must meet the SQL `rule`; missing numbers (null or NaN) are filled with the mean, all in one pass, and stay
    null where no row has one; categories are numbered by frequency, ties by value. The numbering is made on the executors, so a column may have
    any number of values (a StringIndexer keeps them all on the driver).
    """
    folder = folder or work_dir(df.sparkSession, "categories")
    kept = df.where(rule)
    known = {c: f"nullif(CAST({c} AS DOUBLE), DOUBLE('NaN'))" for c in numbers}
    means = kept.agg(F.lit(0), *(F.avg(F.expr(known[c])).alias(c) for c in numbers)).first()
    mean = lambda c: "CAST(NULL AS DOUBLE)" if means[c] is None else f"DOUBLE('{means[c]!r}')"
    filled = "".join(f", coalesce({known[c]}, {mean(c)}) AS {c}_filled" for c in numbers)
    filling = Pipeline(stages=[SQLTransformer(statement=f"SELECT *{filled} FROM __THIS__ WHERE {rule}")]).fit(df)
    indexes = {c: frequency_ids(kept, c, f"{folder}/{c}", "index") for c in categories}
    return Cleaning(filling, indexes, {c: index.count() for c, index in indexes.items()})


def clean(df: DataFrame, numbers: Sequence[str], categories: Sequence[str],
          rule: str = "true") -> DataFrame:
    """Fit the cleaning on `df` and apply it. Runs jobs."""
    return fit_cleaning(df, numbers, categories, rule).apply(df)


def classifier(iterations: int = 50, reg: float = 0.01) -> Pipeline:
    return Pipeline(stages=[LogisticRegression(
        featuresCol="features", labelCol="label", maxIter=iterations, regParam=reg)])


def with_features(df: DataFrame, array: str) -> DataFrame:
    return df.withColumn("features", array_to_vector(F.col(array).cast("array<double>")))


def train_classifier(df: DataFrame, array: str, label: str, **settings) -> PipelineModel:
    """Fit a classifier on an array column. Runs jobs."""
    data = with_features(df, array).withColumn("label", F.col(label).cast("double"))
    return classifier(**settings).fit(data)


def classify(model: PipelineModel, df: DataFrame, array: str) -> DataFrame:
    """The rows of `df` with a `prediction` column."""
    return model.transform(with_features(df, array)).drop("features", "rawPrediction", "probability")
