"""Nearest neighbours by cosine with an inverted multi-index."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from heapq import heappop, heappush

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from riverglass.llm.common import stored

SAMPLE = 20_000  # vectors that the centroids are fitted on, chosen by a hash of their ids
CENTROIDS = 32  # per half; the index has the square of it as entries
VISIT = 6000  # candidates that bound a query's k-th score; does not change the result
SLACK = 1e-9  # above the rounding of squared distances of unit vectors
BLOCK = 4096  # vectors of an entry that are scored together
ROUNDS = 12
QUERIES = 64  # query rows whose visits are in memory together


def usable(vectors: DataFrame) -> DataFrame:
    """(vec_id, v): vectors that take part, as doubles.

    Null and zero vectors and those with null or non-finite components do not; nor do those
    whose length is not the commonest one (the larger on a tie). A null id does not either.
    """
    v = F.transform("embedding", lambda x: x.cast("double"))
    whole = F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    rows = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), v.alias("v")).where(
        F.col("vec_id").isNotNull() & F.col("v").isNotNull() & F.coalesce(whole, F.lit(False))
        & F.exists("v", lambda x: x != 0))
    common = rows.groupBy(F.size("v").alias("n")).count().orderBy(F.desc("count"), F.desc("n")).first()
    return rows.where(F.size("v") == (common.n if common else 0))


def unit(rows: np.ndarray) -> np.ndarray:
    """Rows scaled to length one; the largest component is taken out first, so nothing overflows."""
    rows = rows / np.abs(rows).max(1, keepdims=True)
    return rows / np.sqrt((rows * rows).sum(1, keepdims=True))


def scaled(rows: np.ndarray) -> np.ndarray:
    """Rows times a power of two each, so that their squares neither overflow nor vanish; cosines stay what they are."""
    return np.ldexp(rows, -np.frexp(np.abs(rows).max(1, keepdims=True))[1])


def distances(rows: np.ndarray, centers: np.ndarray) -> np.ndarray:
    return np.maximum((rows * rows).sum(1)[:, None] - 2 * rows @ centers.T + (centers * centers).sum(1), 0)


def k_means(rows: np.ndarray, k: int) -> np.ndarray:
    """At most k centroids; the start is spread over the rows in their given order."""
    different = np.unique(rows, axis=0)
    if len(different) <= k:
        return different
    centers = different[np.linspace(0, len(different) - 1, k).astype(int)].copy()
    for _ in range(ROUNDS):
        near = distances(rows, centers).argmin(1)
        count = np.bincount(near, minlength=k)
        sums = np.stack([np.bincount(near, rows[:, j], k) for j in range(rows.shape[1])], 1)
        centers[count > 0] = sums[count > 0] / count[count > 0, None]
    return centers


@dataclass
class Codebooks:
    """Centroids of the first and of the second half of unit vectors."""
    halves: tuple[np.ndarray, np.ndarray]

    @property
    def width(self) -> int:
        return self.halves[0].shape[1]

    def split(self, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        rows = unit(rows)
        return rows[:, :self.width], rows[:, self.width:]

    def entries(self, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Each row's entry and how far the row's halves are from its two centroids."""
        one, two = (distances(h, c) for h, c in zip(self.split(rows), self.halves))
        return one.argmin(1) * len(self.halves[1]) + two.argmin(1), np.sqrt(one.min(1)), np.sqrt(two.min(1))

    def bounds(self, row: np.ndarray, radii: np.ndarray) -> np.ndarray:
        """Per entry, a squared distance that none of its vectors is nearer than; `radii`: (2, entries)."""
        one, two = (np.sqrt(distances(h, c)[0]) for h, c in zip(self.split(row[None]), self.halves))
        first = np.maximum(np.repeat(one, len(two)) - radii[0], 0)
        second = np.maximum(np.tile(two, len(one)) - radii[1], 0)
        return first * first + second * second

    def order(self, row: np.ndarray, sizes: np.ndarray, visit: int) -> list[int]:
        """Entries by rising sum of the two halves' distances, until they hold `visit` vectors."""
        one, two = (distances(h, c)[0] for h, c in zip(self.split(row[None]), self.halves))
        first, second = np.argsort(one, kind="stable"), np.argsort(two, kind="stable")
        heap, seen, found, held = [(one[first[0]] + two[second[0]], 0, 0)], {(0, 0)}, [], 0
        while heap and held < visit:
            _, i, j = heappop(heap)
            entry = int(first[i] * len(two) + second[j])
            if sizes[entry]:
                found.append(entry)
                held += sizes[entry]
            for a, b in ((i + 1, j), (i, j + 1)):
                if a < len(first) and b < len(second) and (a, b) not in seen:
                    seen.add((a, b))
                    heappush(heap, (one[first[a]] + two[second[b]], a, b))
        return found


def fit(rows: DataFrame, sample: int = SAMPLE, centroids: int = CENTROIDS) -> Codebooks | None:
    chosen = rows.orderBy(F.xxhash64("vec_id"), "vec_id", "v").limit(sample).collect()
    if not chosen:
        return None
    data = unit(np.array([r.v for r in chosen]))
    half = (data.shape[1] + 1) // 2
    return Codebooks((k_means(data[:, :half], centroids), k_means(data[:, half:], centroids)))


def _matrix(column: pa.Array) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), -1)


def neighbours(vectors: DataFrame, is_query: Column, k: int = 5, visit: int = VISIT, sample: int = SAMPLE,
               centroids: int = CENTROIDS) -> DataFrame:
    """(query_id, rank, vec_id, score): the k nearest of each query row.

    `vectors`: vec_id, embedding. A query first opens entries of the index until they hold `visit`
    vectors, then every other entry that can hold a vector as near as the k-th of those, by the
    distance of its centroids and the radius around them. So none of the k nearest is missed at
    any size. Scores are the exact cosine of the given vectors, and ties
    go to the smaller id. Candidates have another id than the query; rows that repeat an id and
    vector are one. The centroids are fitted on a bounded sample, every row is indexed. See `usable`
    for rows that take no part.
    """
    spark = vectors.sparkSession
    rows = usable(vectors).distinct()
    books = fit(rows, sample, centroids)
    if books is None:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    count = len(books.halves[0]) * len(books.halves[1])

    def enter(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if len(batch):
                entries, one, two = books.entries(_matrix(batch.column("v")))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(entries, pa.int64()), pa.array(one), pa.array(two), *batch.columns],
                    names=["entry", "one", "two", "vec_id", "v"])

    index = stored(rows.mapInArrow(enter, "entry long, one double, two double, vec_id long, v array<double>"), "multi-index")
    sizes, radii = np.zeros(count, np.int64), np.zeros((2, count))
    # At most one row per pair of centroids.
    for row in index.groupBy("entry").agg(F.count("*").alias("n"), F.max("one").alias("one"), F.max("two").alias("two")).collect():
        sizes[row.entry], radii[:, row.entry] = row.n, (row.one, row.two)
    blocks = np.maximum(1, -(-sizes // BLOCK))

    def visits(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not len(batch):
                continue
            for start in range(0, len(batch), QUERIES):  # the rows made of a query are many
                part = batch.slice(start, QUERIES)
                at, entry, block = [], [], []
                for i, (row, floor) in enumerate(zip(_matrix(part.column("v")), part.column("floor").to_pylist())):
                    opened = books.order(row, sizes, visit)
                    if floor is not None:
                        near = (sizes > 0) & (books.bounds(row, radii) <= 2 - 2 * floor + SLACK)
                        near[opened] = False
                        opened = np.flatnonzero(near)
                    for e in opened:
                        for b in range(blocks[e]):
                            at.append(i)
                            entry.append(e)
                            block.append(b)
                at = pa.array(at, pa.int64())
                yield pa.RecordBatch.from_arrays(
                    [pa.array(entry, pa.int64()), pa.array(block, pa.int64()), pa.array(np.ones(len(at), np.int32)),
                     part.column("vec_id").take(at), part.column("v").take(at), part.column("floor").take(at)],
                    names=["entry", "block", "kind", "vec_id", "v", "floor"])

    shape = "entry long, block long, kind int, vec_id long, v array<double>, floor double"
    queries = index.where(is_query).select("vec_id", "v")
    in_entry = F.element_at(F.array(*[F.lit(int(b)) for b in blocks]), (F.col("entry") + 1).cast("int"))
    listed = index.select("entry", F.pmod(F.xxhash64("vec_id"), in_entry).cast("long").alias("block"),
                          F.lit(0).alias("kind"), "vec_id", "v", F.lit(None).cast("double").alias("floor"))

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, ids, data = None, [], []
        own_ids = own = norms = None
        for batch in batches:
            if not len(batch):
                continue
            keys = np.stack([batch.column(c).to_numpy() for c in ("entry", "block")], 1)
            kinds, names, rows = batch.column("kind").to_numpy(), batch.column("vec_id").to_numpy(), _matrix(batch.column("v"))
            edges = np.flatnonzero(np.concatenate(([True], (keys[1:] != keys[:-1]).any(1) | (kinds[1:] != kinds[:-1]), [True])))
            floors, out = batch.column("floor").fill_null(-np.inf).to_numpy(), []
            for a, b in zip(edges, edges[1:]):
                key = tuple(keys[a])
                if key != now:
                    now, ids, data, own = key, [], [], None
                if kinds[a] == 0:
                    ids.append(names[a:b])
                    data.append(rows[a:b])
                    continue
                if own is None and data:
                    own_ids, own = np.concatenate(ids), scaled(np.concatenate(data))
                    norms = np.sqrt((own * own).sum(1))
                if own is None:
                    continue
                for query, row, floor in zip(names[a:b], scaled(rows[a:b]), floors[a:b]):
                    # Summed the same way for every row, so equal vectors get equal scores.
                    cosine = (own * row).sum(1) / (norms * np.sqrt((row * row).sum()))
                    cosine[own_ids == query] = -np.inf
                    some = np.flatnonzero(cosine >= np.partition(cosine, -k)[-k]) if len(cosine) > k else np.arange(len(cosine))
                    best = some[np.lexsort((own_ids[some], -cosine[some]))][:k]
                    best = best[(cosine[best] > -np.inf) & (cosine[best] >= floor)]
                    out.append((np.full(len(best), query), own_ids[best], cosine[best]))
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(x)) for x in zip(*out)],
                                                 names=["query_id", "vec_id", "score"])

    def scored(asked: DataFrame) -> DataFrame:
        met = listed.unionByName(asked.mapInArrow(visits, shape)).repartition("entry", "block").sortWithinPartitions(
            "entry", "block", "kind", "vec_id")
        return met.mapInArrow(score, "query_id long, vec_id long, score double").distinct()

    def best(found: DataFrame) -> DataFrame:
        rank = F.expr("row_number() over (partition by query_id order by score desc, vec_id)")
        return found.withColumn("rank", rank).where(F.col("rank") <= k)

    start = stored(best(scored(queries.withColumn("floor", F.lit(None).cast("double")))), "multi-index-start")
    # With fewer than k found, every entry can hold one of the k nearest.
    floor = F.when(F.count("*") == k, F.min("score")).otherwise(-2.0)
    floors = start.groupBy(F.col("query_id").alias("vec_id")).agg(floor.alias("floor"))
    rest = queries.join(floors, "vec_id", "left").select("vec_id", "v", F.coalesce("floor", F.lit(-2.0)).alias("floor"))
    found = start.drop("rank").unionByName(scored(rest))
    return best(found).select("query_id", "rank", "vec_id", "score")
