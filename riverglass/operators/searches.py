"""Search-log statistics.

Words are counted first. Where a script has no blanks, the different words are then cut into terms by a
dictionary (`cut`), each once however often it was searched, and the counts are added up per term.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Mapping

from pyspark.sql import Column, DataFrame, functions as F

from riverglass.functions.text import ALONE, parts, segment_words, words
from riverglass.functions.times import CYCLIC, period
from riverglass.operators.toplists import counts, top, top_per_group

Tokenizer = Callable[[Column], Column]
Cut = Callable[[DataFrame], DataFrame]  # rows with different `term`s -> the same rows with `parts`


def by_dictionary(dictionary: Mapping[str, int] | Iterable[str], alone: str = ALONE) -> Cut:
    """Cut with a dictionary that travels with the tasks.

    Different words are few bytes and much work, so they are dealt to as many tasks as a shuffle has: adaptive execution
    would merge them by size.
    """
    def cut(counted: DataFrame) -> DataFrame:
        tasks = int(counted.sparkSession.conf.get("spark.sql.shuffle.partitions"))
        return counted.repartition(tasks, "term").withColumn("parts", parts(F.col("term"), dictionary, alone))

    return cut


def by_table(dictionary: DataFrame, alone: str = ALONE) -> Cut:
    """Cut with a dictionary (term, cost) of any size."""
    return lambda counted: segment_words(counted, dictionary, "term", alone)


def terms(searches: DataFrame, text: str = "query", keep: tuple[str, ...] = (),
          tokenizer: Tokenizer = words) -> DataFrame:
    """One row for each term of each search, with the `keep` columns."""
    return searches.select(*keep, F.explode(tokenizer(F.col(text))).alias("term"))


def term_counts(searches: DataFrame, text: str = "query", tokenizer: Tokenizer = words,
                cut: Cut | None = None) -> DataFrame:
    counted = counts(terms(searches, text, (), tokenizer), "term", name="searches")
    if cut is None:
        return counted
    return cut(counted).select(F.explode("parts").alias("term"), "searches").groupBy("term").agg(
        F.sum("searches").alias("searches"))


def user_term_counts(searches: DataFrame, user: str = "user_id", text: str = "query",
                     tokenizer: Tokenizer = words, cut: Cut | None = None) -> DataFrame:
    pairs = counts(terms(searches, text, (user,), tokenizer), user, "term", name="searches")
    if cut is None:
        return pairs
    cut_up = cut(pairs.select("term").distinct()).select("term", F.explode("parts").alias("part"))
    return pairs.join(cut_up, "term").groupBy(user, F.col("part").alias("term")).agg(
        F.sum("searches").alias("searches"))


def hot_keywords(searches: DataFrame, n: int = 10, text: str = "query",
                 tokenizer: Tokenizer = words, cut: Cut | None = None) -> DataFrame:
    """The terms searched most."""
    return top(term_counts(searches, text, tokenizer, cut), n, "searches", ["term"])


def user_hot_terms(searches: DataFrame, n: int = 10, user: str = "user_id", text: str = "query",
                   tokenizer: Tokenizer = words, cut: Cut | None = None) -> DataFrame:
    """The (user, term) pairs searched most."""
    return top(user_term_counts(searches, user, text, tokenizer, cut), n, "searches", [user, "term"])


def user_top_terms(searches: DataFrame, n: int = 3, user: str = "user_id", text: str = "query",
                   tokenizer: Tokenizer = words, cut: Cut | None = None) -> DataFrame:
    """The terms each user searched most."""
    pairs = user_term_counts(searches, user, text, tokenizer, cut)
    return top_per_group(pairs, n, [user], "searches", ["term"])


def search_heat(searches: DataFrame, ts: str = "ts", unit: str = "hour_of_day") -> DataFrame:
    """Searches per time period; reads the time column only."""
    when = period(F.col(ts), unit)
    if unit not in CYCLIC:
        when = when.cast(searches.schema[ts].dataType)  # wall clock stays wall clock
    return counts(searches, when.alias("period"), name="searches")


def hot_keywords_from_pairs(pairs: DataFrame, n: int = 10) -> DataFrame:
    """Hot keywords from `user_term_counts`, so that one pass over the text serves both lists."""
    total = pairs.groupBy("term").agg(F.sum("searches").alias("searches"))
    return top(total, n, "searches", ["term"])
