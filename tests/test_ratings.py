import pytest
from pyspark.sql import functions as F

from riverglass.operators import ratings as R
from riverglass.sources import ratings


def fixture(spark):
    """Films 1 to 13: 201 ratings each, except film 1 (200, the best mean) and film 2 (199)."""
    def film(movie, number, rating):
        return spark.range(number).select(
            F.col("id").cast("int").alias("user_id"), F.lit(movie).alias("movie_id"),
            F.lit(rating).cast("double").alias("rating"))

    parts = [film(1, 200, 5.0), film(2, 199, 5.0), film(3, 201, 4.5), film(4, 201, 4.5)]
    parts += [film(m, 201, 4.0 - m / 10) for m in range(5, 14)]
    parts += [film(1, 5, None)]
    table = parts[0]
    for part in parts[1:]:
        table = table.union(part)
    return table


def test_strictly_more_than_200(spark):
    got = R.rating_top(fixture(spark)).collect()
    assert [r.movie_id for r in got] == [3, 4, 5, 6, 7, 8, 9, 10, 11, 12]
    assert {r.ratings for r in got} == {201}


def test_sql_is_the_same_plan(spark):
    table = fixture(spark)
    dsl, sql = R.rating_top(table), R.rating_top_sql(table)
    assert dsl.collect() == sql.collect()


def test_delimited_ratings(spark, tmp_path, rows):
    path = tmp_path / "ratings.dat"
    path.write_text("1::10::4.5::978300760\n2::10::NaN::9999999999999999\n")
    got = ratings(spark, str(path), "::", ids="int")
    assert rows(got.select("user_id", "movie_id", "rating")) == [(1, 10, 4.5), (2, 10, None)]


def test_ids_that_are_no_integers_are_kept(spark, tmp_path):
    """Text ids and ids beyond 32 bits stay apart, and there is no film without an id."""
    lines = [f"u{u}::{film}::{r}::1" for film, r in (("tt0111161", 5), ("9999999999", 4), ("9999999998", 3)) for u in range(3)]
    (tmp_path / "ratings").write_text("\n".join(lines + ["u1::::5::1", "u2::7::x::1"]))
    got = [tuple(r) for r in R.rating_top(ratings(spark, str(tmp_path / "ratings"), "::"), more_than=2).collect()]
    assert got == [("tt0111161", 5.0, 3), ("9999999999", 4.0, 3), ("9999999998", 3.0, 3)]
    assert [tuple(r) for r in R.rating_top_sql(ratings(spark, str(tmp_path / "ratings"), "::"), more_than=2).collect()] == got
    with pytest.raises(Exception, match="CAST_INVALID_INPUT"):
        ratings(spark, str(tmp_path / "ratings"), "::", ids="bigint").collect()
    (tmp_path / "ids").write_text("1::9999999999::4::1")
    assert ratings(spark, str(tmp_path / "ids"), "::", ids="bigint").first().movie_id == 9999999999
