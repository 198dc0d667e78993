"""Search-log statistics in one job."""

from __future__ import annotations

from contextlib import contextmanager

from pyspark import StorageLevel
from pyspark.sql import DataFrame

from riverglass.functions.text import words
from riverglass.operators import searches as S
from riverglass.operators.toplists import top, top_per_group


@contextmanager
def search_report(searches: DataFrame, n: int = 10, per_user: int = 3, user: str = "user_id",
                  text: str = "query", ts: str = "ts", unit: str = "hour_of_day",
                  tokenizer: S.Tokenizer = words, cut: S.Cut | None = None):
    """Hot keywords, hot (user, term) pairs, top terms per user and search heat.

    The text is read and split once; the (user, term) counts are kept while the block runs and
    feed three of the four lists.
    """
    pairs = S.user_term_counts(searches, user, text, tokenizer, cut).persist(StorageLevel.MEMORY_AND_DISK)
    try:
        yield {
            "hot_keywords": S.hot_keywords_from_pairs(pairs, n),
            "user_hot_terms": top(pairs, n, "searches", [user, "term"]),
            "user_top_terms": top_per_group(pairs, per_user, [user], "searches", ["term"]),
            "search_heat": S.search_heat(searches, ts, unit),
        }
    finally:
        pairs.unpersist()
