import math

from hypothesis import HealthCheck, given, settings, strategies as st
from pyspark.sql import functions as F

from riverglass.operators import measures as M

SCORED = "user int, item int, score double, relevant boolean"


def judged(rows, k):
    """The measures from their definitions."""
    out = {}
    for user in {r[0] for r in rows}:
        mine = [r for r in rows if r[0] == user]
        liked = sum(bool(r[3]) for r in mine)
        if not liked:
            continue
        first = sorted(mine, key=lambda r: (-(r[2] if r[2] is not None else -math.inf), r[1]))[:k]
        gain = sum(1 / math.log2(i + 2) for i, r in enumerate(first) if r[3])
        best = sum(1 / math.log2(i + 2) for i in range(min(liked, k)))
        hits = sum(bool(r[3]) for r in first)
        out[user] = (hits, liked, hits / k, hits / liked, gain / best)
    return out


def test_ranking_of_planted_rows(spark):
    rows = [(1, 1, 0.9, True), (1, 2, 0.8, False), (1, 3, 0.7, True), (1, 4, 0.1, True),  # 2 of 3, not in the best order
            (2, 1, 0.5, True), (2, 2, 0.5, False),  # a tie: the smaller item first
            (3, 1, 0.9, False), (3, 2, None, True),  # without a score: last
            (4, 1, 0.9, False), (5, 9, 0.1, None)]  # nothing liked
    got = {r.user: tuple(r)[1:] for r in M.ranking_by_user(spark.createDataFrame(rows, SCORED), 2).collect()}
    assert set(got) == {1, 2, 3} and got[1][:2] == (1, 3) and got[2] == (1, 1, 0.5, 1.0, 1.0)
    assert got[3][:2] == (1, 1) and abs(got[3][4] - 1 / math.log2(3)) < 1e-12
    row = M.ranking_summary(M.ranking_by_user(spark.createDataFrame(rows, SCORED), 2)).first()
    assert row.users == 3 and row.precision == 0.5


@settings(max_examples=8, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.dictionaries(st.tuples(st.integers(1, 4), st.integers(1, 9)), st.tuples(st.sampled_from([0.1, 0.5, None]), st.booleans()), max_size=25),
       st.integers(1, 5))
def test_ranking_as_defined(spark, values, k):
    rows = [(u, i, s, r) for (u, i), (s, r) in values.items()]
    got = {r.user: tuple(r)[1:] for r in M.ranking_by_user(spark.createDataFrame(rows, SCORED), k).collect()}
    want = judged(rows, k)
    assert got.keys() == want.keys()
    assert all(abs(a - b) < 1e-12 for u in want for a, b in zip(got[u], want[u]))


def test_long_rankings_are_cut_per_task(spark):
    """Beyond the length at which Spark limits groups itself."""
    df = spark.range(5000).select(F.lit(1).alias("user"), F.col("id").cast("int").alias("item"), F.rand(3).alias("score"), (F.col("id") % 2 == 0).alias("relevant"))
    row = M.ranking_by_user(df, 2000).first()
    assert row.relevant == 2500 and 900 < row.hits < 1100


def test_held_out_is_arithmetic(spark):
    rows = spark.range(-1000, 1000).select(F.col("id").alias("a"), (F.col("id") * 7).alias("b"))
    got = {r.a: r.t for r in rows.select("a", M.held_out("a", "b").alias("t")).collect()}
    assert got == {a: ((a % 1000003) * 31 + (a * 7) % 1000003) % 5 == 0 for a in range(-1000, 1000)}
    assert 300 < sum(got.values()) < 500


def test_errors_and_hits(spark):
    df = spark.createDataFrame([(1.0, 1.0, 2.0), (3.0, 2.0, 2.0), (None, 9.0, 9.0)], "rating double, prediction double, mean double")
    row = M.errors(df, "rating", ("prediction", "mean")).first()
    assert tuple(row) == (2, math.sqrt(0.5), 1.0)
    found = spark.createDataFrame([(0, 0.0), (0, 1.0), (1, 1.0), (1, None)], "label int, prediction double")
    assert sorted(tuple(r) for r in M.hits(found).collect()) == [(0, 2, 1, 0.5), (1, 2, 1, 0.5)]
