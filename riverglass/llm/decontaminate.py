"""Finding benchmark items in training text: BM25 over an index of the items, with bounds by blocks.

As in block-max WAND, an item is scored only if the bounds of its postings' blocks allow the threshold; terms are
tried in the order of their bounds, without cursors and pivots.
"""

from __future__ import annotations

import math
import re
from bisect import bisect_left
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from riverglass.llm.common import ID, keyed, real_id

TOKEN = re.compile(r"[^\W_]+")  # letters and digits of any script
ANSWER = re.compile(r"(?:\n|[.!?]\s)\s*(?=\S)")
K1, B = 1.2, 0.75
BLOCK = 32  # postings per block of a list
INDEX_BYTES = 4 << 20  # text of the items that one broadcast index holds


def tokens(text: str) -> list[str]:
    return TOKEN.findall(text.lower())


def question_and_answer(text: str) -> tuple[list[str], list[str]]:
    """An item's last sentence or line is its answer; without one, the last third of its words is."""
    cuts = [m.end() for m in ANSWER.finditer(text)]
    for cut in reversed(cuts):
        question, answer = tokens(text[:cut]), tokens(text[cut:])
        if question and answer:
            return question, answer
    words = tokens(text)
    at = len(words) - len(words) // 3
    return words[:at], words[at:]


def overlap(part: list[str], grams: set, n: int) -> float:
    """The share of the n-grams of `part` found among `grams` (sets of every length up to n)."""
    n = min(n, len(part))
    if not n:
        return 1.0
    own = [tuple(part[i:i + n]) for i in range(len(part) - n + 1)]
    return sum(g in grams for g in own) / len(own)


class Index:
    """An inverted index of items; weights are shares of the score that an item gives itself."""

    def __init__(self, items: list[tuple[int, str]], count: int, mean: float, frequency: dict[str, int],
                 share: float):
        self.share = share
        self.items = [i for i, _ in items]
        self.parts = [question_and_answer(t) for _, t in items]
        self.longest = 1
        lists: dict[str, list[tuple[int, float]]] = {}
        for at, (_, text) in enumerate(items):
            words = tokens(text)
            self.longest = max(self.longest, len(words))
            own = {}
            for term, tf in Counter(words).items():
                idf = math.log(1 + (count - frequency[term] + 0.5) / (frequency[term] + 0.5))
                own[term] = idf * tf * (K1 + 1) / (tf + K1 * (1 - B + B * len(words) / mean))
            total = sum(own.values())
            for term, weight in own.items():
                lists.setdefault(term, []).append((at, weight / total))
        self.postings = {t: ([p[0] for p in ps], [p[1] for p in ps]) for t, ps in lists.items()}
        # The largest weight of each block, and the last item in it.
        self.blocks = {t: ([max(ws[i:i + BLOCK]) for i in range(0, len(ids), BLOCK)],
                           [ids[min(i + BLOCK, len(ids)) - 1] for i in range(0, len(ids), BLOCK)])
                       for t, (ids, ws) in self.postings.items()}
        self.most = {t: max(ws) for t, (_, ws) in self.postings.items()}
        self.asks = self._asks(lists)
        self.needed = frozenset(self.asks)

    def _asks(self, lists) -> dict[str, list[int]]:
        """Items by their needed terms: without any of an item's, its others stay below the share."""
        by_item: dict[int, list[tuple[int, int, str, float]]] = {}
        for term, posts in lists.items():
            for at, weight in posts:
                by_item.setdefault(at, []).append((len(posts), -len(term), term, weight))
        asks: dict[str, list[int]] = {}
        for at, terms in by_item.items():
            left = 0.0
            for _, _, term, weight in sorted(terms, reverse=True):  # the commonest, then the shortest first
                left += weight
                if left >= self.share - 1e-9:
                    asks.setdefault(term, []).append(at)
        return asks

    def search(self, terms: set[str]) -> list[tuple[int, float]]:
        """All items that a passage with these terms gives `share` or more of their own score.

        Pivots are the items that have one of their needed terms here, in rising order. At each one the
        maxima of the blocks it would lie in bound its score; lists are read from the
        heaviest on, and the bound falls with each, until the item is scored or out of reach.
        """
        pivots = {item for t in terms if t in self.asks for item in self.asks[t]}
        if not pivots:
            return []
        lists = sorted(((self.most[t], *self.postings[t], *self.blocks[t]) for t in terms if t in self.postings),
                       key=lambda x: -x[0])
        found, least = [], self.share - 1e-9
        for item in sorted(pivots):
            here, bound = [], 0.0
            for _, ids, weights, most, ends in lists:
                block = bisect_left(ends, item)
                if block < len(ends):
                    bound += most[block]
                    here.append((ids, weights, block * BLOCK, most[block]))
            score = 0.0
            for ids, weights, start, most in here:
                if bound < least:
                    break
                at = bisect_left(ids, item, start, min(start + BLOCK, len(ids)))
                weight = weights[at] if at < len(ids) and ids[at] == item else 0.0
                score += weight
                bound += weight - most
            if bound >= least and score >= least:
                found.append((item, score))
        return found

    def passages(self, words: list[str]) -> Iterator[tuple[int, int]]:
        """Spans of twice the longest item, half overlapping, so that any item lies whole in one.

        Those without a needed term are left out, as no item can be found for them.
        """
        step, needed = self.longest, self.needed
        last = max(0, -(-(len(words) - step) // step) - 1)
        hits = {i // step for i, w in enumerate(words) if w in needed}
        for at in sorted({min(k, last) for h in hits for k in (h - 1, h) if k >= 0}):
            yield at * step, min(len(words), (at + 2) * step)

    def matches(self, text: str, n: int) -> Iterator[tuple[int, float, float, float]]:
        """(item, score, question overlap, answer overlap) of the best passage for each item found."""
        words = tokens(text)
        if self.needed.isdisjoint(words):
            return
        best: dict[int, tuple[float, float, float]] = {}
        for start, end in self.passages(words):
            for at, score in self.search(set(words[start:end])):
                question, answer = self.parts[at]
                around = words[max(0, start - self.longest):end + self.longest]
                sets = {k: {tuple(around[i:i + k]) for i in range(len(around) - k + 1)}
                        for k in {min(n, len(question)), min(n, len(answer))}}
                shares = [overlap(p, sets[min(n, len(p))], n) for p in (question, answer)]
                best[at] = max(best.get(at, (-1.0, 0.0, 0.0)), (min(shares), score, *shares))
        for at, (_, score, question, answer) in best.items():
            yield at, score, question, answer


def indexes(benchmark: DataFrame, share: float) -> Iterator[Index]:
    """Indexes over all items (item_id, text), each of at most about INDEX_BYTES of text.

    Items are dealt to indexes by a hash, so a larger benchmark makes more of them, not larger
    ones; term counts are those of the whole benchmark.
    """
    def split(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, numbers, terms, sizes = [], [], [], []
            for ident, group, text in zip(*(batch.column(c).to_pylist() for c in ("item_id", "part", "text"))):
                words = tokens(text or "")
                for term in set(words):
                    ids.append(ident)
                    numbers.append(group)
                    terms.append(term)
                    sizes.append(len(words))
            yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(numbers, pa.int64()),
                                              pa.array(terms, pa.string()), pa.array(sizes, pa.int64())],
                                             names=["item_id", "part", "term", "size"])

    size = benchmark.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    parts = max(1, -(-size // INDEX_BYTES))
    items = benchmark.where("item_id is not null and text is not null").select(
        F.col("item_id").cast("long").alias("item_id"), F.col("text").cast("string").alias("text"),
        F.pmod(F.xxhash64("item_id", "text"), F.lit(parts)).alias("part")).distinct()
    terms = items.mapInArrow(split, "item_id long, part long, term string, size long")
    lengths = terms.groupBy("item_id").agg(F.max("size").alias("size")).agg(F.count("*"), F.avg("size")).first()
    counts = terms.groupBy("term").agg(F.count("*").alias("n"))
    for part in range(parts):
        block = sorted((r[0], r[1]) for r in items.where(F.col("part") == part).select("item_id", "text").collect())
        block = [x for x in block if tokens(x[1])]
        if block:
            mine = terms.where(F.col("part") == part).select("term").distinct().join(counts, "term").collect()
            yield Index(block, lengths[0], lengths[1], {r[0]: r[1] for r in mine}, share)


def contamination(docs: DataFrame, benchmark: DataFrame, share: float = 0.6, n: int = 5,
                  least: float = 0.8) -> DataFrame:
    """(id, hash, item_id, score, question_overlap, answer_overlap, contaminated) per document and item found.

    Every document is cut into half-overlapping passages, and every passage is a query: an item
    is found if the passage gets at least `share` of the BM25 score of the item itself. It is
    confirmed if of the n-grams of its question and of its answer, each, at least `least` stand near
    the passage. Null and empty texts and items match nothing; repeated rows give
    repeated results.
    """
    spark, source = docs.sparkSession, keyed(docs).select(ID, "__rg_hash", F.col("text").cast("string").alias("text"))
    result = None
    schema = (f"{ID} long, __rg_hash long, item_id long, score double, question_overlap double, "
              "answer_overlap double, contaminated boolean")
    for index in indexes(benchmark, share):
        shared = spark.sparkContext.broadcast(index)

        def scan(batches: Iterator[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
            index, fields = shared.value, schema.replace(",", "").split()[::2]
            for batch in batches:
                rows = []
                for ident, mark, text in zip(batch.column(ID), batch.column("__rg_hash"), batch.column("text")):
                    for at, score, question, answer in index.matches(text.as_py() or "", n):
                        rows.append((ident.as_py(), mark.as_py(), index.items[at], score, question, answer,
                                     min(question, answer) >= least))
                kinds = (pa.int64(), pa.int64(), pa.int64(), pa.float64(), pa.float64(), pa.float64(), pa.bool_())
                yield pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], k) for i, k in enumerate(kinds)],
                                                 names=fields)

        found = source.mapInArrow(scan, schema)
        result = found if result is None else result.unionByName(found)
    return spark.createDataFrame([], schema) if result is None else result


def report(docs: DataFrame, benchmark: DataFrame, **options) -> DataFrame:
    """The matches of `contamination` by doc_id."""
    return contamination(docs, benchmark, **options).select(
        real_id().alias("doc_id"), "item_id", "score", "question_overlap", "answer_overlap", "contaminated")


def clean(docs: DataFrame, benchmark: DataFrame, **options) -> DataFrame:
    """`docs` without those in which an item is confirmed."""
    found = contamination(docs, benchmark, **options).where("contaminated").select(ID, "__rg_hash").distinct()
    return keyed(docs).join(found, [ID, "__rg_hash"], "left_anti").select(docs.columns)
