"""The largest inner products between two tables of vectors, exactly.

Every query vector meets every row, as the task is, but most pairs are settled by bounds and never multiplied. Rows are
dealt to blocks by their length, the longest first; each block is cut into shells of about equal length, and these into
cells of near rows. No product is above the two lengths multiplied, so a query is sent only to blocks whose longest row
reaches the worst of the `n` products that it has already. No product of a query with a row of a cell is above its product
with the cell's centre plus its length times the cell's radius; a cell is opened only for queries for which this reaches it.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F

from riverglass.operators.toplists import top_per_group
from riverglass.session import stored

CELL = 32  # rows of a cell, at most
SHELL = 8000  # rows of a shell, at most: cells stay as long as they are wide when blocks grow
SPREAD = 4  # shares of queries in the first block, for each share in the others
PARTS, LEAST, MOST = 24, 40_000, 400_000  # parts of a side, and the rows of one: more parts only beyond PARTS * MOST rows
AT_ONCE, CELLS_AT_ONCE = 8192, 512  # queries and cells whose bounds are in memory
ROUNDING = 1e-5  # of single precision, over the products of a vector, as a share of the vectors' lengths

HITS = "query int, row int, score float"


def parts_for(rows: int) -> int:
    """Parts of a side: each vector of one side is sent to as many tasks as the other has parts."""
    return max(1, min(PARTS, math.ceil(rows / LEAST)), math.ceil(rows / MOST))


def lengths(vectors: np.ndarray) -> np.ndarray:
    return np.sqrt(np.einsum("ij,ij->i", vectors, vectors, dtype=np.float64)).astype(np.float32)


def cells(vectors: np.ndarray) -> np.ndarray:
    """The rows in an order in which each run of `CELL` or fewer is a cell, one line per cell; -1 fills up.

    Each round halves all cells at the median of the coordinate in which they are widest.
    """
    rounds = max(0, math.ceil(math.log2(max(1, len(vectors)) / CELL)))
    size = math.ceil(len(vectors) / 2**rounds)
    order = np.concatenate((np.arange(len(vectors)), np.full(size * 2**rounds - len(vectors), -1)))[None, :]
    for _ in range(rounds):
        held = vectors[order]  # what fills up goes with the last row
        widest = held.var(axis=1).argmax(axis=1)
        along = np.take_along_axis(held, widest[:, None, None], axis=2)[:, :, 0]
        order = np.take_along_axis(order, along.argsort(axis=1, kind="stable"), axis=1)
        order = order.reshape(2 * len(order), -1)
    return order


def shells(vectors: np.ndarray) -> np.ndarray:
    """The `cells` of each run of at most `SHELL` rows, the longest rows first."""
    order = np.argsort(-lengths(vectors), kind="stable")
    cut = [(some, cells(vectors[some])) for some in np.array_split(order, max(1, math.ceil(len(order) / SHELL)))]
    width = max(c.shape[1] for _, c in cut)
    return np.vstack([np.pad(np.where(c < 0, -1, some[c]), ((0, 0), (0, width - c.shape[1])), constant_values=-1) for some, c in cut])


class Best:
    """The best `n` products of each query so far, all of which beat or equal the query's `floor`."""

    def __init__(self, floor: np.ndarray, n: int):
        self.floor, self.n = floor.copy(), n
        self.query, self.row, self.score = np.empty(0, np.int64), np.empty(0, np.int64), np.empty(0, np.float32)

    def add(self, query: np.ndarray, row: np.ndarray, score: np.ndarray) -> None:
        query, row, score = (np.concatenate(x) for x in ((self.query, query), (self.row, row), (self.score, score)))
        order = np.lexsort((row, np.where(np.isnan(score), -np.inf, -score), query))
        query, row, score = query[order], row[order], score[order]
        start = np.flatnonzero(np.diff(query, prepend=-1))
        place = np.arange(len(query)) - np.repeat(start, np.diff(start, append=len(query)))
        kept = place < self.n
        self.query, self.row, self.score = query[kept], row[kept], score[kept]
        last = place == self.n - 1
        self.floor[query[last]] = np.fmax(self.floor[query[last]], score[last])


def best_in_block(queries: np.ndarray, floor: np.ndarray, rows: np.ndarray, ids: np.ndarray, n: int) -> Best:
    """What `queries` find in a block: `rows` in the order of `cells`, with their ids, -1 for what fills up.

    A comparison with no number is not settled by a bound, so such rows are met too.
    """
    size, best = rows.shape[1], Best(floor, n)
    centre = rows.mean(axis=1, dtype=np.float64).astype(np.float32)
    away = rows - centre[:, None, :]
    radius = lengths(away.reshape(-1, rows.shape[2])).reshape(len(rows), size).max(axis=1)
    longest = lengths(rows.reshape(-1, rows.shape[2])).reshape(len(rows), size).max(axis=1)
    bounds = np.hstack((centre, (radius + ROUNDING * longest)[:, None]))
    long = lengths(queries)
    asks = np.hstack((queries, long[:, None]))
    # Cells with the longest rows first: they raise the floors for the others.
    sequence = np.argsort(-longest, kind="stable")
    if not np.isfinite(floor).all():  # each query begins with the cells that promise most
        few = np.argsort(-longest, kind="stable")[:max(1, math.ceil(4 * n / size))]
        found = queries @ rows[few].reshape(-1, rows.shape[2]).T
        found[:, ids[few].ravel() < 0] = -np.inf
        if found.shape[1] >= n:
            best.floor = np.fmax(best.floor, np.partition(found, -n, axis=1)[:, -n] - ROUNDING * long * longest[few].max())
    begun, step = 0, 8
    while begun < len(sequence):
        some = sequence[begun:begun + step]
        begun, step = begun + step, min(2 * step, CELLS_AT_ONCE)
        alive = np.flatnonzero(~(long * (longest[some].max() * (1 + ROUNDING)) < best.floor))
        if not len(alive):
            if np.isfinite(longest).all():
                break  # all that follow are shorter
            continue
        reach = ~(asks[alive] @ bounds[some].T < best.floor[alive, None])
        found: list[tuple] = []
        for k, cell in enumerate(some):
            who = alive[reach[:, k]]
            if not len(who):
                continue
            score = queries[who] @ rows[cell].T
            q, r = np.nonzero(~(score < best.floor[who, None]))
            found.append((who[q], ids[cell][r], score[q, r]))
        if found:
            query, row, score = (np.concatenate(x) for x in zip(*found))
            real = row >= 0
            best.add(query[real], row[real], score[real])
    return best


def read(batches: Iterator[pa.RecordBatch]) -> tuple[np.ndarray, np.ndarray, pa.Table] | None:
    """The ids and vectors of a task's rows, and its rows; None if it has none."""
    held = [b for b in batches if b.num_rows]
    if not held:
        return None
    table = pa.Table.from_batches(held)
    ids = table.column("id").to_numpy().astype(np.int32)
    return ids, table.column("features").combine_chunks().flatten().to_numpy().astype(np.float32).reshape(len(ids), -1), table


def packed(rows: DataFrame) -> DataFrame:
    """(block, size, longest, ids, vectors): each task's rows of (id, features) as one, in cells."""
    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        if (held := read(batches)) is None:
            return
        ids, matrix, _ = held
        order = shells(matrix)
        near = np.where(order < 0, order.max(axis=1, keepdims=True), order)  # what fills up repeats a row of its cell
        yield pa.RecordBatch.from_pylist([{
            "block": TaskContext.get().partitionId(), "size": order.shape[1], "longest": float(lengths(matrix).max()),
            "ids": np.where(order < 0, -1, ids[order]).astype(np.int32).tobytes(), "vectors": matrix[near].tobytes()}],
            schema=pa.schema([("block", pa.int32()), ("size", pa.int32()), ("longest", pa.float32()), ("ids", pa.binary()),
                              ("vectors", pa.binary())]))

    return rows.mapInArrow(pack, "block int, size int, longest float, ids binary, vectors binary")


def asking(queries: DataFrame, longest: dict[int, float]) -> DataFrame:
    """(share, block, ids, vectors, floors): each task's rows of (id, features, floor) as one for each block that they can need.

    `longest` has the length of each block's longest row. Queries that this does not bring to their floor stay out.
    """
    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        if (held := read(batches)) is None:
            return
        ids, matrix, table = held
        floors, long = table.column("floor").to_numpy().astype(np.float32), lengths(matrix)
        for block, most in longest.items():
            some = np.flatnonzero(~(long * (np.float32(most) * (1 + ROUNDING)) < floors))
            if len(some):
                yield pa.RecordBatch.from_pylist([{
                    "share": TaskContext.get().partitionId(), "block": block, "ids": ids[some].tobytes(),
                    "vectors": matrix[some].tobytes(), "floors": floors[some].tobytes()}], schema=pa.schema([
                        ("share", pa.int32()), ("block", pa.int32()), ("ids", pa.binary()), ("vectors", pa.binary()),
                        ("floors", pa.binary())]))

    return queries.mapInArrow(pack, "share int, block int, ids binary, vectors binary, floors binary")


def met(asks: DataFrame, blocks: DataFrame, n: int) -> DataFrame:
    """(query, row, score): what the packed queries find in the packed blocks that they ask. Runs jobs."""
    asks = stored(asks, "asks")
    # A block goes only to the shares that ask it; one row for each of them.
    right = blocks.join(asks.groupBy("block").agg(F.collect_list("share").alias("shares")), "block").withColumn(
        "share", F.explode("shares")).drop("shares")

    def search(asking: pd.DataFrame, held: pd.DataFrame) -> pd.DataFrame:
        out = []
        for q in asking.itertuples():
            ids, floors = np.frombuffer(q.ids, np.int32), np.frombuffer(q.floors, np.float32)
            vectors = np.frombuffer(q.vectors, np.float32).reshape(len(ids), -1)
            for b in held.itertuples():
                rows = np.frombuffer(b.vectors, np.float32).reshape(-1, b.size, vectors.shape[1])
                names = np.frombuffer(b.ids, np.int32).reshape(-1, b.size)
                for at in range(0, len(ids), AT_ONCE):
                    best = best_in_block(vectors[at:at + AT_ONCE], floors[at:at + AT_ONCE], rows, names, n)
                    out.append(pd.DataFrame({"query": ids[at:at + AT_ONCE][best.query], "row": best.row.astype(np.int32),
                                             "score": best.score}))
        return pd.concat(out) if out else pd.DataFrame(columns=["query", "row", "score"])

    tasks = max(1, 2 * asks.count())  # so that few pairs meet in a task
    key = ["share", "block"]
    return asks.repartition(tasks, *key).groupBy(*key).cogroup(right.repartition(tasks, *key).groupBy(*key)).applyInPandas(search, HITS)


def best_products(queries: DataFrame, rows: DataFrame, n: int) -> DataFrame:
    """(query, place, row, score): the `n` rows with the largest products for each query, ties to the smaller id.

    Both sides are (id int, features array<float>) with different ids. Runs jobs. The block of the longest rows is
    searched first; what a query finds there is its floor in the others.
    """
    queries = queries.select("id", "features", F.lit(-math.inf).cast("float").alias("floor"))
    shares = parts_for(queries.count())
    long = F.aggregate("features", F.lit(0.0), lambda total, x: total + x * x)
    blocks = stored(packed(rows.select("id", "features").repartitionByRange(parts_for(rows.count()), F.desc(long), "id")), "blocks")
    longest = {r.block: r.longest for r in blocks.select("block", "longest").collect()}
    head = {b: longest.pop(b) for b in sorted(longest)[:1]}
    spread = queries.repartition(SPREAD * shares if shares > 1 else 1, "id")
    first = stored(met(asking(spread, head), blocks, n), "first")
    if longest:
        # A floor is the worst of n that were found already: nothing below it is among the best n.
        floors = first.groupBy(F.col("query").alias("id")).agg(
            F.when(F.count("*") >= n, F.min("score")).otherwise(-math.inf).cast("float").alias("floor"))
        asks = queries.drop("floor").join(floors, "id", "left").select(
            "id", "features", F.coalesce("floor", F.lit(-math.inf).cast("float")).alias("floor"))
        first = first.unionByName(met(asking(asks.repartition(shares, "id"), longest), blocks, n))
    return top_per_group(first, n, ["query"], "score", ["row"]).select("query", "place", "row", "score")
