import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from riverglass.functions import text as X

COSTS = {"ab": 900, "abc": 2500, "天": 1200, "天地": 1500, "地人": 1600, "𠀀b": 700, "é": 400, "z" * 12: 300}


def words(n):
    draw = random.Random(5)
    return sorted({"".join(draw.choice("abc天地人𠀀éz") for _ in range(draw.randint(1, 14))) for _ in range(n)})


@pytest.mark.parametrize("characters", [40, 10_000])
def test_groups_cut_as_the_whole_dictionary_does(spark, monkeypatch, characters):
    monkeypatch.setattr(X, "GROUP_CHARACTERS", characters)
    given = words(200) + ["z" * 30, ""]
    table = spark.createDataFrame(list(COSTS.items()), "term string, cost long")
    counted = spark.createDataFrame([(i, w, None if i % 3 else 2**60 + i) for i, w in enumerate([*given, None])], "i int, term string, n long")
    found = X.segment_words(counted, table)
    assert found.columns == ["term", "i", "n", "parts"]
    one = X.cutter(COSTS)
    got = {r.i: (r.term, r.n, r.parts) for r in found.collect()}
    assert got == {i: (w, None if i % 3 else 2**60 + i, None if w is None else one(w)) for i, w in enumerate([*given, None])}


def test_only_pieces_that_may_be_terms_are_moved(spark):
    """A word of 14 characters has 105 pieces; the join is for those whose bit the dictionary has set."""
    known = spark.createDataFrame([(t,) for t in COSTS], "piece string")
    sieve, given = X.sieve_of(known, len(COSTS)), words(2000)
    passed = X.passing(given, 12, sieve)
    pieces = {w[a:a + k] for w in given for a in range(len(w)) for k in range(1, min(12, len(w) - a) + 1)}
    assert passed <= pieces and pieces & COSTS.keys() <= passed
    assert len(passed) < len(pieces) / 100


def test_a_full_sieve_lets_all_pass(spark):
    given = words(50)
    passed = X.passing(given, 3, np.full(4096, 255, np.uint8))
    assert passed == {w[a:a + k] for w in given for a in range(len(w)) for k in range(1, min(3, len(w) - a) + 1)}


def test_sieve_grows_with_the_dictionary(spark):
    many = spark.range(20_000).select(F.col("id").cast("string").alias("piece"))
    assert len(X.sieve_of(many, 20_000)) * 8 >= 16 * 20_000
    assert X.passing([str(n) for n in range(20_000)], 5, X.sieve_of(many, 20_000)) >= {str(n) for n in range(20_000)}
