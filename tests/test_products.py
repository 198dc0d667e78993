import io
from contextlib import redirect_stdout

import numpy as np
import pandas as pd
import pytest

from riverglass.operators import als, products as P


def table(spark, vectors, first=0):
    return spark.createDataFrame(pd.DataFrame({"id": range(first, first + len(vectors)), "features": vectors.tolist()})).selectExpr(
        "cast(id as int) as id", "cast(features as array<float>) as features")


def brute(queries, rows, n):
    """(query, place) -> (row, score), ties to the smaller row, from the definition."""
    found = queries.astype(np.float32) @ rows.astype(np.float32).T
    order = np.lexsort((np.broadcast_to(np.arange(len(rows)), found.shape), -found))[:, :n]
    return {(q, k + 1): (int(r), float(found[q, r])) for q, line in enumerate(order) for k, r in enumerate(line)}


def vectors(rng, kind, n):
    if kind == "whole":  # exact products with many ties
        return rng.integers(-2, 3, (n, 3)).astype(np.float64)
    long = np.exp(rng.standard_normal((n, 1))) if kind == "uneven" else 1.0
    drawn = rng.standard_normal((n, 6))
    return drawn / np.linalg.norm(drawn, axis=1, keepdims=True) * long


@pytest.mark.parametrize("kind", ["even", "uneven", "whole"])
def test_lists_over_several_parts_are_the_best(spark, monkeypatch, kind):
    monkeypatch.setattr(P, "LEAST", 150)
    rng = np.random.default_rng(7)
    queries, rows = vectors(rng, kind, 400), vectors(rng, kind, 700)
    got = {(r.query, r.place): (r.row, r.score) for r in P.best_products(table(spark, queries), table(spark, rows), 4).collect()}
    want = brute(queries, rows, 4)
    assert got.keys() == want.keys()
    assert all(abs(got[k][1] - s) < 1e-4 for k, (_, s) in want.items())
    assert kind != "whole" or got == want


def test_fewer_rows_than_places(spark, monkeypatch):
    monkeypatch.setattr(P, "LEAST", 2)
    rng = np.random.default_rng(8)
    queries, rows = vectors(rng, "whole", 9), vectors(rng, "whole", 5)
    got = {(r.query, r.place): (r.row, r.score) for r in P.best_products(table(spark, queries), table(spark, rows), 8).collect()}
    assert got == brute(queries, rows, 8) and len(got) == 45
    assert P.best_products(table(spark, queries).limit(0), table(spark, rows), 3).count() == 0


def test_cells_hold_every_row_once():
    rng = np.random.default_rng(9)
    for n in (1, 31, 33, 1000, 4097):
        order = P.cells(rng.standard_normal((n, 4)).astype(np.float32))
        assert sorted(order[order >= 0].tolist()) == list(range(n)) and order.shape[1] <= P.CELL + 1


def test_far_cells_are_not_opened(monkeypatch):
    """Short rows behind long ones are settled by their bound: one comparison for the whole block."""
    rng = np.random.default_rng(10)
    queries = rng.standard_normal((50, 5)).astype(np.float32)
    rows = (0.001 * rng.standard_normal((3000, 5))).astype(np.float32)
    opened, add = [], P.Best.add
    monkeypatch.setattr(P.Best, "add", lambda self, *found: (opened.append(len(found[0])), add(self, *found)))
    order = P.cells(rows)
    best = P.best_in_block(queries, np.full(50, 1.0, np.float32), rows[order], order, 5)
    assert not opened and not len(best.query)


def test_no_all_pairs_join(spark):
    """Spark's own lists join all blocks of users with all blocks of items and score every pair."""
    rng = np.random.default_rng(11)
    u, i = np.nonzero(rng.random((40, 30)) < 0.5)
    ratings = spark.createDataFrame(pd.DataFrame({"user": u, "item": i, "rating": rng.random(len(u))}))
    model = als.fit(als.rating_matrix(ratings, "user", "item", "rating"), als.AlsSettings(rank=3, iterations=2, blocks=2))
    for lists in (als.for_all_users(model, 3), als.for_items(model, ratings.select("item"), 3)):
        with redirect_stdout(io.StringIO()) as plan:
            lists.explain()
        assert "CartesianProduct" not in plan.getvalue() and "NestedLoop" not in plan.getvalue()
        assert lists.count() in (120, 90)


def test_blocks_shuffle_no_faster_than_the_ratings():
    """More blocks send each user's factors more often: as few as hold the ratings."""
    assert [als.fewest_blocks(n) for n in (0, 100, 36_000_000, 216_000_000, 10**11)] == [10, 10, 10, 11, 1000]


def test_ratings_are_stored_tightly(spark, monkeypatch):
    """Matrices go to Parquet: checkpoints hold a row in several times the bytes."""
    seen = []
    monkeypatch.setattr(als, "stored", lambda df, purpose, put=als.stored: (seen.append(purpose), put(df, purpose))[1])
    ratings = spark.createDataFrame([(u, i, float(u * i % 5)) for u in range(8) for i in range(6)], "user int, item int, rating float")
    als.train(ratings, als.AlsSettings(rank=2, iterations=1))
    assert seen == ["matrix", "ratings"]


def test_cells_of_a_block_stay_in_shells(monkeypatch):
    """However large a block is, a cell has no long rows beside short ones."""
    monkeypatch.setattr(P, "SHELL", 200)
    rows = vectors(np.random.default_rng(12), "uneven", 2010).astype(np.float32)
    order = P.shells(rows)
    assert sorted(order[order >= 0].tolist()) == list(range(2010)) and order.shape[1] <= P.CELL + 1
    rank = np.argsort(np.argsort(-P.lengths(rows)))
    assert all(np.ptp(rank[cell[cell >= 0]]) < 200 for cell in order if (cell >= 0).any())


def test_queries_are_sent_only_where_they_can_find(spark, monkeypatch):
    """A query with its list full meets no block of shorter rows, and such a block is sent nowhere."""
    monkeypatch.setattr(P, "LEAST", 50)
    sent = []
    monkeypatch.setattr(P, "stored", lambda df, purpose, put=P.stored: (lambda kept: (purpose == "asks" and sent.append(kept), kept)[1])(put(df, purpose)))
    rng = np.random.default_rng(13)
    queries, rows = vectors(rng, "even", 200), vectors(rng, "even", 1000)
    rows[120:] *= 0.01
    got = {(r.query, r.place): r.row for r in P.best_products(table(spark, queries), table(spark, rows), 3).collect()}
    assert got == {k: r for k, (r, _) in brute(queries, rows, 3).items()}
    begun, others = (df.selectExpr("share", "block", "length(ids) div 4 as n").collect() for df in sent)
    assert sum(r.n for r in begun) == 200 and len({r.block for r in begun}) == 1
    # Rows 0 to 119 fill at most four of twenty blocks; before, every query met all twenty.
    assert len({r.block for r in others}) <= 4 and sum(r.n for r in others) <= 800
