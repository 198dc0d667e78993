"""Mean-rating lists, in DataFrame form and in SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from riverglass.operators.toplists import top


def mean_ratings(ratings: DataFrame, item: str = "movie_id", rating: str = "rating") -> DataFrame:
    """Mean and number of ratings per item; a missing rating counts in neither, and rows without an
    item are of no item."""
    return ratings.where(F.col(item).isNotNull()).groupBy(item).agg(
        F.avg(rating).alias("mean_rating"), F.count(rating).alias("ratings"))


def rating_top(ratings: DataFrame, n: int = 10, more_than: int = 200, item: str = "movie_id",
               rating: str = "rating") -> DataFrame:
    """The best means among items rated more than `more_than` times."""
    enough = mean_ratings(ratings, item, rating).where(F.col("ratings") > more_than)
    return top(enough, n, "mean_rating", [item])


def rating_top_sql(ratings: DataFrame, n: int = 10, more_than: int = 200, item: str = "movie_id",
                   rating: str = "rating") -> DataFrame:
    """`rating_top` as SQL over a view."""
    return ratings.sparkSession.sql(f"""
        SELECT {item}, avg({rating}) AS mean_rating, count({rating}) AS ratings
        FROM {{ratings}}
        WHERE {item} IS NOT NULL
        GROUP BY {item}
        HAVING count({rating}) > {int(more_than)}
        ORDER BY mean_rating DESC, {item}
        LIMIT {int(n)}""", ratings=ratings)
