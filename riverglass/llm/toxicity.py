"""Severity of toxic text by cumulative-link ordinal regression on sparse text features."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

SAMPLE = 20_000  # labelled documents that the model is fitted on, chosen by a hash of their ids
VOCABULARY = 4096  # features with the strongest association
LEAST_ROWS = 3  # toxic documents that a feature must occur in
PREFIX = 5
ROUNDS, RATE, RIDGE = 400, 0.1, 1e-5
EDGES = ".,;:!?\"'()[]*#|"


def text_features(text: str) -> set[str]:
    """A document's words, and the beginnings of its longer words ("abcde-")."""
    words = {w.strip(EDGES) for w in set(text.lower().split())}
    return words | {w[:PREFIX] + "-" for w in words if len(w) > PREFIX}


@dataclass
class Severity:
    """One weight per feature, shared by all thresholds; thresholds rise."""
    place: dict[str, int]
    weights: np.ndarray
    thresholds: np.ndarray

    def above(self, features: set[str]) -> np.ndarray:
        """The probabilities that the grade is above 0, above 1, and so on."""
        at = [self.place[f] for f in features if f in self.place]
        return _sigmoid(self.weights[at].sum() - self.thresholds)


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -500, 500)))


def fit_severity(rows: list[tuple[list[int], int]], size: int, grades: int) -> tuple[np.ndarray, np.ndarray]:
    """Weights and thresholds of P(grade <= k) = sigmoid(threshold_k - weights . features)."""
    y = np.array([g for _, g in rows])
    lengths = np.array([len(f) for f, _ in rows])
    at = np.fromiter((i for f, _ in rows for i in f), np.int64, lengths.sum())
    row = np.repeat(np.arange(len(rows)), lengths)
    # thresholds are a start and the logarithms of the steps after it, so they stay in order
    theta = np.concatenate((np.zeros(size), [1.0], np.zeros(grades - 2)))
    mean, spread = np.zeros_like(theta), np.zeros_like(theta)
    share = 1 / len(rows)
    for step in range(1, ROUNDS + 1):
        gaps = np.exp(theta[size + 1:])
        cuts = theta[size] + np.concatenate(([0.0], np.cumsum(gaps)))
        score = np.bincount(row, theta[:size][at], len(rows))
        upper = np.where(y == grades - 1, 1.0, _sigmoid(cuts[np.minimum(y, grades - 2)] - score))
        lower = np.where(y == 0, 0.0, _sigmoid(cuts[np.maximum(y - 1, 0)] - score))
        mass = np.maximum(upper - lower, 1e-12)
        up, down = upper * (1 - upper) / mass, lower * (1 - lower) / mass
        d_score = up - down  # of the negative log likelihood
        d_cut = np.bincount(np.minimum(y, grades - 2), -up * (y < grades - 1), grades - 1) + np.bincount(
            np.maximum(y - 1, 0), down * (y > 0), grades - 1)
        grad = np.concatenate((np.bincount(at, d_score[row], size), [d_cut.sum()],
                               [d_cut[k + 1:].sum() * gaps[k] for k in range(grades - 2)])) * share
        grad[:size] += RIDGE * theta[:size]
        mean = 0.9 * mean + 0.1 * grad
        spread = 0.999 * spread + 0.001 * grad**2
        theta -= RATE * (mean / (1 - 0.9**step)) / (np.sqrt(spread / (1 - 0.999**step)) + 1e-8)
    return theta[:size], theta[size] + np.concatenate(([0.0], np.cumsum(np.exp(theta[size + 1:]))))


def learn(docs: DataFrame, labels: DataFrame, grade: str = "toxic", sample: int = SAMPLE) -> Severity | None:
    """A model fitted on up to `sample` labelled documents.

    If the labels only tell toxic (1) from not toxic (0), toxic documents are graded 1, 2 or 3 by
    thirds of the number of telling features in them. Of labels that differ for one id the
    largest counts. None if the labels hold fewer than two grades.
    """
    known = labels.where(F.col(grade).isNotNull() & F.col("doc_id").isNotNull()).groupBy("doc_id").agg(
        F.max(grade).cast("int").alias("grade")).orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample)

    def split(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for ident, value, text in zip(batch.column("doc_id"), batch.column("grade"), batch.column("text")):
                found = pa.array(sorted(text_features(text.as_py())), pa.string())
                yield pa.RecordBatch.from_arrays(
                    [pa.array([ident.as_py()] * len(found), pa.int64()), pa.array([value.as_py()] * len(found), pa.int32()),
                     found], names=["doc_id", "grade", "feature"])

    given = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).where(
        "text is not null").join(F.broadcast(known), "doc_id")
    pairs = given.mapInArrow(split, "doc_id long, grade int, feature string").distinct()
    marked = given.agg(F.count_distinct("doc_id"), F.count_distinct(F.when(F.col("grade") > 0, F.col("doc_id")))).first()
    if not marked[1] or marked[0] == marked[1]:
        return None
    rest = marked[0] - marked[1]
    counts = pairs.groupBy("feature").agg(F.sum((F.col("grade") > 0).cast("long")).alias("with"),
                                          F.sum((F.col("grade") <= 0).cast("long")).alias("without"))
    odds = F.log((F.col("with") + 0.5) / (marked[1] - F.col("with") + 0.5)) - F.log(
        (F.col("without") + 0.5) / (rest - F.col("without") + 0.5))
    strength = odds * F.sqrt(F.col("with"))
    chosen = counts.where(F.col("with") >= LEAST_ROWS).withColumn("odds", odds).where("odds > 0.5").orderBy(
        strength.desc(), "feature").limit(VOCABULARY).select("feature", "odds").collect()
    place = {r.feature: i for i, r in enumerate(chosen)}
    strong = {r.feature for r in chosen if r.odds > 3}
    if not place:
        return None
    words = {r.doc_id: (r.grade, r.features) for r in pairs.join(
        F.broadcast(docs.sparkSession.createDataFrame([(f,) for f in place], "feature string")), "feature").groupBy(
        "doc_id", "grade").agg(F.sort_array(F.collect_set("feature")).alias("features")).collect()}
    everyone = sorted((r.doc_id, r.grade) for r in given.select("doc_id", "grade").distinct().collect())
    rows = [([place[f] for f in words.get(i, (g, []))[1]], g, sum(f in strong for f in words.get(i, (g, []))[1]))
            for i, g in everyone]
    top = max(g for _, g, _ in rows)
    if top == 1:
        thirds = np.quantile([s for _, g, s in rows if g == 1], [1 / 3, 2 / 3])
        rows = [(f, g and 1 + int(np.searchsorted(thirds, s, side="left")), s) for f, g, s in rows]
        top = 3
    weights, thresholds = fit_severity([(f, max(g, 0)) for f, g, _ in rows], len(place), top + 1)
    return Severity(place, weights, thresholds)


def severity(docs: DataFrame, labels: DataFrame, grade: str = "toxic", sample: int = SAMPLE) -> DataFrame:
    """Per row of `docs`: doc_id, severity (the expected grade), grade (the likeliest), probability, toxic.

    `probability` is that of any grade above 0, `toxic` is 1 from a half on. Null and empty texts
    have no features. Without labels of two grades nothing is known and all are 0.
    """
    model = learn(docs, labels, grade, sample)

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for text in batch.column("text"):
                above = model.above(text_features(text.as_py() or "")) if model else np.zeros(1)
                mass = -np.diff(np.concatenate(([1.0], above, [0.0])))
                rows.append((float(above.sum()), int(mass.argmax()), float(above[0]), int(above[0] >= 0.5)))
            kinds = (pa.float64(), pa.int32(), pa.float64(), pa.int32())
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), *(pa.array([r[i] for r in rows], k) for i, k in enumerate(kinds))],
                names=["doc_id", "severity", "grade", "probability", "toxic"])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).mapInArrow(
        score, "doc_id long, severity double, grade int, probability double, toxic int")
