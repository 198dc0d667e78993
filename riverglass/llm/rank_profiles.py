"""Language identification by rank-order profiles of character n-grams.

A language's profile is the list of its most frequent n-grams, most frequent first. A document's own
list is compared with each: an n-gram is out of place by the difference of its two ranks, or by the
profile's whole length where the language doesn't have it. The language with the smallest sum wins.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

PER_LANGUAGE = 4000  # about so many documents of each language are learned from, chosen by a hash
PROFILE = 400  # n-grams of a language's profile
DOCUMENT = 300  # n-grams of a document's list
PIECE = 1 << 18  # characters of a text that are cut into n-grams at once
MAX_PROFILE_ROWS = 4_000_000  # languages times PROFILE; this much travels to every executor
NO_LANGUAGE = "und"

_NOT_LETTERS = re.compile(r"[\W\d_]+")
_BITS = np.int64(21)  # of a character; three fit into one number
_BLANK = 32


def pieces(text: str) -> Iterator[str]:
    """The text in parts that end between words where they can."""
    at = 0
    while at < len(text):
        end = at + PIECE
        if end < len(text):
            found = _NOT_LETTERS.search(text, end, end + PIECE)
            end = found.end() if found else end + PIECE
        yield text[at:end]
        at = end


def gram_codes(text: str) -> np.ndarray:
    """The n-grams of one, two and three characters of the words of a text, as numbers.

    Words are runs of letters, in lower case, with a blank on each side; no n-gram reaches over a
    blank. A shorter n-gram is a smaller number than any longer one, so lengths don't mix.
    """
    words = _NOT_LETTERS.sub(" ", text.lower()).strip()
    if not words:
        return np.zeros(0, np.int64)
    c = np.frombuffer(f" {words} ".encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.int64)
    two = c[:-1] << _BITS | c[1:]
    three = (two[:-1] << _BITS | c[2:])[c[1:-1] != _BLANK]
    return np.concatenate((c[c != _BLANK], two, three))


def gram_counts(text: str) -> tuple[np.ndarray, np.ndarray]:
    """The different n-grams of a whole text, ascending, and how often each occurs."""
    grams, n = np.zeros(0, np.int64), np.zeros(0, np.int64)
    for piece in pieces(text):
        g, k = np.unique(gram_codes(piece), return_counts=True)
        if len(grams):
            g, place = np.unique(np.concatenate((grams, g)), return_inverse=True)
            k = np.bincount(place, np.concatenate((n, k)), len(g)).astype(np.int64)
        grams, n = g, k
    return grams, n


def ranked(grams: np.ndarray, n: np.ndarray, most: int) -> np.ndarray:
    """The most frequent n-grams, most frequent first, the smaller number on a tie."""
    if len(n) > 4 * most:  # what is below the count of place `most` can't be among them
        least = np.partition(n, len(n) - most)[len(n) - most]
        grams, n = grams[n >= least], n[n >= least]
    return grams[np.lexsort((grams, -n))[:most]]


@dataclass
class Profiles:
    """Languages by code point, and all profiles' n-grams in ascending order with language and rank."""
    languages: list[str]
    grams: np.ndarray
    language: np.ndarray
    rank: np.ndarray
    length: int = PROFILE

    @staticmethod
    def of(rows: list[tuple[str, int, int]], length: int = PROFILE) -> Profiles:
        """From rows (language, n-gram, rank from 0)."""
        languages = sorted({r[0] for r in rows}, key=lambda x: x.encode("utf-32-be"))
        number = {x: k for k, x in enumerate(languages)}
        grams = np.array([r[1] for r in rows], np.int64)
        order = np.argsort(grams, kind="stable")
        return Profiles(languages, grams[order], np.array([number[r[0]] for r in rows], np.int64)[order],
                        np.array([r[2] for r in rows], np.int64)[order], length)

    def distances(self, mine: np.ndarray) -> np.ndarray:
        """The out-of-place distance of a document's ranked n-grams to every profile."""
        order = np.argsort(mine, kind="stable")
        place = np.searchsorted(mine, self.grams, sorter=order)
        place = order[np.minimum(place, len(mine) - 1)]
        met = mine[place] == self.grams
        gain = self.length - np.abs(place[met] - self.rank[met])
        missing = float(self.length * len(mine))
        return missing - np.bincount(self.language[met], np.maximum(gain, 0), len(self.languages))

    def predict(self, text: str | None) -> tuple[str, float]:
        """The nearest language and how near it is: 1 for equal lists, 0 for lists with nothing in common.

        Of equally near ones the smallest by code point. `und`, 0 if there is no letter, or nothing was learned.
        """
        grams, n = gram_counts(text or "")
        if not len(grams) or not self.languages:
            return NO_LANGUAGE, 0.0
        mine = ranked(grams, n, DOCUMENT)
        distance = self.distances(mine)
        best = int(np.argmin(distance))
        return self.languages[best], 1 - float(distance[best]) / (self.length * len(mine))


def held_out(doc_id: Column) -> Column:
    """Rows that are never learned from: a quarter of the ids; rows without id are among them."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 4 == 2, F.lit(True))


def gram_table(docs: DataFrame) -> DataFrame:
    """(lang, gram, n) of `docs` (lang, text), counted per batch before the shuffle."""
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found: dict[str, tuple[list, list]] = {}
            for lang, text in zip(batch.column("lang").to_pylist(), batch.column("text")):
                grams, n = gram_counts(text.as_py())
                of = found.setdefault(lang, ([], []))
                of[0].append(grams)
                of[1].append(n)
            for lang, (grams, n) in found.items():
                kinds, place = np.unique(np.concatenate(grams), return_inverse=True)
                sums = np.bincount(place, np.concatenate(n), len(kinds)).astype(np.int64)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([lang] * len(kinds), pa.string()), pa.array(kinds), pa.array(sums)], names=["lang", "gram", "n"])

    return docs.mapInArrow(count, "lang string, gram long, n long").groupBy("lang", "gram").agg(F.sum("n").alias("n"))


def learn(docs: DataFrame, per_language: int = PER_LANGUAGE) -> Profiles:
    """Profiles of the languages of `docs` (doc_id, text, lang), held-out rows left out.

    Languages with more than `per_language` documents are learned from about so many of them, those with the
    smallest hashes of id and text; the share is set per language, so that rare ones are learned whole.
    """
    known = docs.select("doc_id", F.col("text").cast("string").alias("text"), F.col("lang").cast("string").alias("lang")).where(
        F.col("text").isNotNull() & F.col("lang").isNotNull() & ~held_out(F.col("doc_id")))
    # One row per language, checked, so that no text is moved to meet its share.
    counts = known.groupBy("lang").agg(F.count("*").alias("n")).limit(MAX_PROFILE_ROWS // PROFILE + 1).collect()
    if len(counts) > MAX_PROFILE_ROWS // PROFILE:
        raise ValueError("too many languages for one table of profiles")
    share = F.broadcast(docs.sparkSession.createDataFrame(
        [(r.lang, per_language / r.n) for r in counts], "lang string, share double"))
    draw = F.pmod(F.xxhash64("doc_id", "text"), F.lit(1 << 30)) / float(1 << 30)
    some = known.join(share, "lang").where(draw < F.col("share")).select("lang", "text")
    place = F.row_number().over(Window.partitionBy("lang").orderBy(F.desc("n"), "gram"))
    top = gram_table(some).withColumn("place", place).where(F.col("place") <= PROFILE)
    return Profiles.of([tuple(r) for r in top.select("lang", "gram", F.col("place") - 1).collect()])


def languages(docs: DataFrame, per_language: int = PER_LANGUAGE) -> DataFrame:
    """Per row of `docs`: doc_id, held_out, lang_pred and score (0 to 1).

    Only the text enters a prediction. A null text, one without a letter and every text if nothing could
    be learned (no labelled row, an empty table) gives `und` with score 0. Texts of any length are counted
    whole, a piece at a time. Rows that repeat get the same result each. Rows without an id are
    predicted and never learned from. Other columns, whatever their names, are not read.
    """
    profiles = learn(docs, per_language)

    def predict(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [profiles.predict(t.as_py()) for t in batch.column("text")]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("held_out"), pa.array([f[0] for f in found], pa.string()),
                 pa.array([f[1] for f in found], pa.float64())], names=["doc_id", "held_out", "lang_pred", "score"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), F.col("text").cast("string").alias("text")).mapInArrow(
        predict, f"doc_id {kind}, held_out boolean, lang_pred string, score double")
