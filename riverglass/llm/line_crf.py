"""Document quality from a linear-chain conditional random field over lines."""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame, functions as F

from riverglass.llm.common import word_blocks

SAMPLE = 8000  # labelled documents that the field is fitted on, chosen by a hash of their ids
CHAIN = 64  # longer documents are cut into chains of so many lines for fitting, not for scoring
PER_TEXT = 8  # at most so many chains of one document are used for fitting
CHAINS = 16000  # at most so many chains are used in all, so a million lines
BLOCK = 1 << 18  # bytes of lines whose features are found at once
ROUNDS, RATE, RIDGE = 200, 0.1, 1e-3

LETTER, UPPER, DIGIT, MARK, SYMBOL, HIGH, OTHER = range(7)
KINDS = np.full(256, OTHER, np.uint8)
KINDS[128:] = HIGH
for _kind, _bytes in ((LETTER, b"abcdefghijklmnopqrstuvwxyz"), (UPPER, b"ABCDEFGHIJKLMNOPQRSTUVWXYZ"),
                      (DIGIT, b"0123456789"), (MARK, b".,;:?-'\"()"), (SYMBOL, b"!#$%&*+/<=>@[\\]^_`{|}~")):
    KINDS[list(_bytes)] = _kind
SHARES = np.array([0.005, 0.02, 0.05, 0.1, 0.2, 0.35, 0.5, 0.7, 0.9])
COUNTS = np.array([1, 2, 4, 8, 16, 32, 64, 128, 256], float)
LENGTHS = np.array([1, 2, 3, 4, 5, 6, 7, 9, 12], float)
FEATURES, BINS = 11, 10


def _line_blocks(data: bytes) -> Iterator[bytes]:
    """A text in blocks of whole lines, each of about BLOCK bytes or one longer line."""
    start = 0
    while start <= len(data):
        end = data.find(b"\n", start + BLOCK)
        if end < 0:
            end = len(data)
        yield data[start:end]
        start = end + 1


def _word_figures(line: bytes) -> tuple[int, int, int]:
    """A line's words, different words, and words equal to the one before."""
    if len(line) <= BLOCK:
        words = line.split()
        return len(words), len(set(words)), sum(a == b for a, b in zip(words, words[1:]))
    count = again = 0
    seen, last = np.zeros(0, np.uint64), None
    for words in word_blocks(line, BLOCK):
        count += len(words)
        again += (words[0] == last) + sum(a == b for a, b in zip(words, words[1:]))
        last = words[-1]
        seen = np.union1d(seen, np.array([xxhash.xxh64_intdigest(w) for w in set(words)], np.uint64))
    return count, len(seen), again


def _block_features(data: bytes) -> tuple[np.ndarray, np.ndarray]:
    lines = data.split(b"\n")
    sizes = np.array([len(x) for x in lines])
    ends = np.cumsum(sizes + 1) - 1
    starts = ends - sizes
    kinds = KINDS[np.frombuffer(data, np.uint8)]
    raw = np.zeros((len(lines), 8))
    n = np.maximum(sizes, 1)
    totals = {}
    for kind in (LETTER, UPPER, DIGIT, MARK, SYMBOL, HIGH):
        sums = np.concatenate(([0], np.cumsum(kinds == kind, dtype=np.int32)))
        totals[kind] = sums[ends] - sums[starts]
    count, different, again = np.array([_word_figures(x) for x in lines]).T
    some = np.maximum(count, 1)
    raw[:, 0] = totals[UPPER] / np.maximum(totals[UPPER] + totals[LETTER], 1)
    raw[:, 1] = totals[DIGIT] / n
    raw[:, 2] = totals[SYMBOL] / n
    raw[:, 3] = totals[HIGH] / n
    raw[:, 4] = totals[MARK] / n
    raw[:, 5] = different / some
    raw[:, 6] = again / some
    raw[:, 7] = np.minimum(totals[SYMBOL] / some, 1)
    bins = np.empty((len(lines), FEATURES), np.uint8)
    bins[:, :8] = np.searchsorted(SHARES, raw, side="right")
    bins[:, 8] = np.searchsorted(COUNTS, count, side="right")
    bins[:, 9] = np.searchsorted(LENGTHS, sizes / some, side="right")
    bins[:, 10] = np.searchsorted(COUNTS, sizes / 8, side="right")
    return bins, n


def line_features(text: str) -> tuple[np.ndarray, np.ndarray]:
    """Binned features (lines x FEATURES) and the weight (length, at least 1) of every line."""
    blocks = [_block_features(x) for x in _line_blocks(text.encode("utf-8", "replace"))]
    if len(blocks) == 1:
        return blocks[0]
    return np.concatenate([b for b, _ in blocks]), np.concatenate([n for _, n in blocks])


@dataclass
class Field:
    """Weights of a line's own, previous and next line's features; `turn[a, b]` scores label a before b."""
    weights: np.ndarray
    turn: np.ndarray
    edge: np.ndarray
    bias: float

    @staticmethod
    def empty() -> Field:
        return Field(np.zeros((3, FEATURES * BINS)), np.zeros((2, 2)), np.zeros(2), 0.0)

    def unary(self, bins: np.ndarray) -> np.ndarray:
        """The score of `good` against `bad` for each line."""
        own, before, after = (_weighed(w, bins) for w in self.weights)
        score = own + self.bias
        score[1:] += before[:-1]
        score[:-1] += after[1:]
        score[0] += self.edge[0]
        score[-1] += self.edge[1]
        return score

    def marginals(self, bins: np.ndarray) -> np.ndarray:
        """The probability of `good` for each line, by the forward-backward algorithm.

        Works on odds, one line after the other: most documents have a few lines only.
        """
        (bad_bad, bad_good), (good_bad, good_good) = np.exp(self.turn).tolist()
        own = np.exp(np.clip(self.unary(bins), -30, 30))
        odds = np.empty(len(own))
        now = None
        for start in range(0, len(own), BLOCK):
            part = []
            for x in own[start:start + BLOCK].tolist():
                now = x if now is None else x * (bad_good + now * good_good) / (bad_bad + now * good_bad)
                part.append(now)
            odds[start:start + BLOCK] = part
        back = None
        for start in reversed(range(0, len(own), BLOCK)):
            part = []
            for x in reversed(own[start:start + BLOCK].tolist()):
                back = 1.0 if back is None else (good_bad + right * good_good) / (bad_bad + right * bad_good)
                right = back * x
                part.append(back)
            odds[start:start + BLOCK] *= part[::-1]
        return odds / (1 + odds)


def _weighed(weights: np.ndarray, bins: np.ndarray) -> np.ndarray:
    """The sum of each line's weights."""
    if len(bins) <= 512:
        return weights[bins + np.arange(FEATURES) * BINS].sum(1)
    total = np.zeros(len(bins))
    for feature, table in enumerate(weights.reshape(FEATURES, BINS)):
        total += table[bins[:, feature]]
    return total


def _counted(bins: np.ndarray, error: np.ndarray) -> np.ndarray:
    """The sum of the lines' errors for each weight."""
    return np.concatenate([np.bincount(bins[:, f], error, BINS) for f in range(FEATURES)])


def _chain(unary: np.ndarray, real: np.ndarray, turn: np.ndarray):
    """Log odds of `good` per line (chains x lines), and per line pair the labels' joint probability."""
    chains, length = unary.shape
    ahead = np.zeros((chains, length))  # log odds of good, given the lines so far
    back = np.zeros((chains, length))   # log odds that the lines after give

    def through(odds, table):
        good = np.logaddexp(table[0, 1], odds + table[1, 1])
        return good - np.logaddexp(table[0, 0], odds + table[1, 0])

    ahead[:, 0] = unary[:, 0]
    for t in range(1, length):
        ahead[:, t] = unary[:, t] + through(ahead[:, t - 1], turn)
    for t in range(length - 2, -1, -1):
        odds = through(back[:, t + 1] + unary[:, t + 1], turn.T)
        back[:, t] = np.where(real[:, t + 1], odds, 0)
    joint = None
    if length > 1:
        left, right = ahead[:, :-1], back[:, 1:] + unary[:, 1:]
        joint = np.empty((chains, length - 1, 2, 2))
        for a in (0, 1):
            for b in (0, 1):
                joint[:, :, a, b] = a * left + b * right + turn[a, b]
        joint -= joint.max((2, 3), keepdims=True)
        joint = np.exp(joint)
        joint /= joint.sum((2, 3), keepdims=True)
    return ahead + back, joint


def fit_field(chains: list[tuple[np.ndarray, int]]) -> Field:
    """A field fitted by gradient steps to chains of line features with the label of all their lines."""
    field = Field.empty()
    if not chains:
        return field
    sizes = np.array([len(b) for b, _ in chains])
    length = int(sizes.max())
    bins = np.asfortranarray(np.concatenate([b for b, _ in chains]))  # of all lines, chain after chain
    real = np.arange(length) < sizes[:, None]
    label = np.array([float(good) for _, good in chains])
    of_line = np.repeat(label, sizes)
    ends = np.cumsum(sizes)
    first, last = ends - sizes, ends - 1
    inner, outer = np.ones(len(bins), bool), np.ones(len(bins), bool)  # lines with one before, with one after
    inner[first], outer[last] = False, False
    pairs = real[:, 1:]
    longer = sizes - 1
    seen = np.diag([longer[label == 0].sum(), longer[label == 1].sum()])
    theta = np.zeros(3 * FEATURES * BINS + 7)
    mean, spread = np.zeros_like(theta), np.zeros_like(theta)
    unary = np.zeros((len(chains), length))
    for step in range(1, ROUNDS + 1):
        w = theta[:-7].reshape(3, -1)
        bias, edge, turn = theta[-7], theta[-6:-4], theta[-4:].reshape(2, 2)
        own, before, after = (_weighed(x, bins) for x in w)
        score = own + bias
        score[inner] += before[outer]
        score[outer] += after[inner]
        score[first] += edge[0]
        score[last] += edge[1]
        unary[real] = score
        odds, joint = _chain(unary, real, turn)
        error = 1 / (1 + np.exp(-np.clip(odds[real], -500, 500))) - of_line
        grad = np.zeros_like(theta)
        g = grad[:-7].reshape(3, -1)
        g[0] = _counted(bins, error)
        g[1] = _counted(bins, np.append(np.where(inner, error, 0)[1:], 0))
        g[2] = _counted(bins, np.append(0, np.where(outer, error, 0)[:-1]))
        grad[-7] = error.sum()
        grad[-6], grad[-5] = error[first].sum(), error[last].sum()
        if joint is not None:
            grad[-4:] = ((joint * pairs[:, :, None, None]).sum((0, 1)) - seen).ravel()
        grad = grad / len(bins) + RIDGE * theta
        mean = 0.9 * mean + 0.1 * grad
        spread = 0.999 * spread + 0.001 * grad**2
        theta -= RATE * (mean / (1 - 0.9**step)) / (np.sqrt(spread / (1 - 0.999**step)) + 1e-8)
    return Field(theta[:-7].reshape(3, -1).copy(), theta[-4:].reshape(2, 2).copy(), theta[-6:-4].copy(), float(theta[-7]))


def held_out(doc_id: Column) -> Column:
    """Rows that labels are never learned from: a fifth of the ids; rows without id are among them."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 5 == 0, F.lit(True))


def _some_chains(text: str) -> list[bytes]:
    """The features of a text's chains, or of PER_TEXT of them that a hash of the features picks."""
    bins = line_features(text)[0]
    starts = np.arange(0, len(bins), CHAIN)
    if len(starts) > PER_TEXT:
        starts = np.sort(np.random.default_rng(zlib.crc32(bins.tobytes())).choice(starts, PER_TEXT, replace=False))
    return [bins[i:i + CHAIN].tobytes() for i in starts]


def learn(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE, chains: int = CHAINS) -> Field:
    """A field fitted on up to `sample` labelled documents, and `chains` chains of them, that are not held out.

    Of labels that differ for one id the larger share wins (good on a tie), of texts that differ the one with
    the least hash; null labels and ids without text do not count. Without any label every score is 0.5.
    """
    known = labels.where("quality is not null").where(~held_out(F.col("doc_id"))).groupBy("doc_id").agg(
        (F.avg("quality") >= 0.5).cast("int").alias("good"))
    chosen = known.orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample)

    @F.pandas_udf("array<binary>")
    def features(texts: pd.Series) -> pd.Series:
        return texts.map(_some_chains)

    # A repeated id sends one text's chains per task; they are found where the text is read.
    rows = docs.select("doc_id", F.col("text").cast("string").alias("text")).where("text is not null").join(
        F.broadcast(chosen), "doc_id").select(
        "doc_id", "good", F.struct(F.xxhash64("text").alias("mark"), features("text").alias("bins")).alias("found"))
    one = rows.groupBy("doc_id", "good").agg(F.min("found").alias("found"))
    cut = one.select("doc_id", "good", F.posexplode("found.bins").alias("place", "bins"))
    taken = cut.orderBy(F.xxhash64("doc_id", "place"), "doc_id", "place").limit(chains).collect()
    return fit_field([(np.frombuffer(r.bins, np.uint8).reshape(-1, FEATURES), r.good) for r in taken])


def scored(text: Column, field: Field) -> Column:
    """The document's quality: the mean probability of its lines to be good, weighted by their lengths."""
    @F.pandas_udf("double")
    def score(texts: pd.Series) -> pd.Series:
        def of(value):
            bins, weight = line_features(value or "")
            return float(np.average(field.marginals(bins), weights=weight))
        return texts.map(of)

    return score(F.coalesce(text.cast("string"), F.lit("")))


def quality(docs: DataFrame, labels: DataFrame, least: float = 0.3, sample: int = SAMPLE) -> DataFrame:
    """Per row of `docs`: doc_id, held_out, score (0 to 1), predicted (1 from `least` on).

    Null texts score like empty ones, which are one empty line; rows that repeat score alike, and no
    documents give no rows. Texts of any length count whole, in blocks of lines. Other columns are not read.
    """
    field = learn(docs, labels, sample)
    return docs.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), scored(F.col("text"), field).alias("score")).withColumn(
        "predicted", (F.col("score") >= least).cast("int"))


def keep_good(docs: DataFrame, labels: DataFrame, least: float = 0.3, sample: int = SAMPLE) -> DataFrame:
    """`docs` without those whose score is below `least`."""
    return docs.where(scored(F.col("text"), learn(docs, labels, sample)) >= least)
