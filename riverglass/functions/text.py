"""Splitting text into terms."""

from __future__ import annotations

import functools
import math
from collections.abc import Callable, Iterable, Mapping

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F, types as T

from riverglass.session import stored

# A word is a run of letters, marks and digits of any script.
WORD = r"[\p{L}\p{M}\p{N}]+"
# Scripts that put no blanks between words. Where the dictionary has no term, one such character (with its
# marks) stands alone; characters of other scripts go together up to the next one of these.
ALONE = r"\p{Han}\p{Hiragana}\p{Katakana}\p{Thai}\p{Lao}\p{Khmer}\p{Myanmar}"
# The cost of a loose character. A term costs 1000 times the negative logarithm of its share, so this
# is about that of a term seen once in e^20 = 485 million.
LOOSE_COST = 20_000
CACHED_WORDS = 200_000  # words whose segmentation a task keeps
GROUP_CHARACTERS = 300_000  # of the words that share a part of a dictionary table
HASH_BASE, HASH_SPREAD = 0x100000001B3, 0x9E3779B97F4A7C15


def words(text: Column) -> Column:
    """Lower-case words, digits and marks included."""
    return F.regexp_extract_all(F.lower(text), F.lit(WORD), F.lit(0))


def term_costs(counts: DataFrame, term: str = "term", count: str = "searches") -> DataFrame:
    """(term, cost) from how often each term was seen: rarer terms cost more, in whole thousandths.

    Runs a job for the number of all.
    """
    known = counts.where(F.col(term).isNotNull() & (F.length(term) > 0) & (F.col(count) > 0))
    lower = known.groupBy(F.lower(term).alias("term")).agg(F.sum(count).alias("n"))
    total = lower.agg(F.sum("n")).first()[0] or 1
    cost = F.round(-1000 * F.log(F.col("n") / F.lit(total))).cast("long")
    return lower.select("term", F.greatest(cost, F.lit(1)).cast("long").alias("cost"))


def as_costs(dictionary: Mapping[str, int] | Iterable[str]) -> dict[str, int]:
    """Lower-case terms with their costs; plain terms cost 1000 each, so that few long terms win."""
    pairs = dictionary.items() if isinstance(dictionary, Mapping) else ((t, 1000) for t in dictionary)
    costs: dict[str, int] = {}
    for term, cost in pairs:
        if term:
            costs[term.lower()] = min(int(cost), costs.get(term.lower(), int(cost)))
    return costs


Edges = Callable[[str, int], Iterable[tuple[int, int]]]


def loose_ends(word: str, alone: Callable[[str], bool], mark: Callable[[str], bool]) -> list[int]:
    """For each place of a word where a loose token that starts there ends."""
    n = len(word)
    ends, past_marks = [0] * n, n  # past_marks: the first place after `at` that is no mark
    for at in range(n - 1, -1, -1):
        if alone(word[at]):
            ends[at] = past_marks
        else:
            ends[at] = at + 1 if at + 1 == n or alone(word[at + 1]) else ends[at + 1]
        if not mark(word[at]):
            past_marks = at
    return ends


def best_path(word: str, terms_at: Edges, ends: list[int]) -> list[str]:
    """The cheapest way through the graph of a word's terms, as terms.

    `terms_at` gives (length, cost) of the terms that start at a place; the loose token that starts there
    is one more way on. Of equally cheap ways the one whose first different term is longer wins.
    """
    n = len(word)
    cost, step = [0] * (n + 1), [1] * n
    for at in range(n - 1, -1, -1):
        longest = ends[at] - at
        least = LOOSE_COST * longest + cost[ends[at]]
        for size, price in terms_at(word, at):
            total = price + cost[at + size]
            if total < least or total == least and size > longest:
                least, longest = total, size
        cost[at], step[at] = least, longest
    parts, at = [], 0
    while at < n:
        parts.append(word[at:at + step[at]])
        at += step[at]
    return parts


def terms_of(costs: Mapping[str, int]) -> Edges:
    """The terms of a dictionary that start at a place of a word."""
    sizes: dict[str, set[int]] = {}
    for term in costs:
        sizes.setdefault(term[0], set()).add(len(term))
    ordered = {c: sorted(s) for c, s in sizes.items()}

    def terms_at(word: str, at: int) -> Iterable[tuple[int, int]]:
        for size in ordered.get(word[at], ()):
            if at + size > len(word):
                break
            cost = costs.get(word[at:at + size])
            if cost is not None:
                yield size, cost

    return terms_at


def character_tests(alone: str) -> tuple[Callable[[str], bool], Callable[[str], bool]]:
    """Whether a character is in the class `alone`, and whether it is a mark."""
    import regex

    single, mark = regex.compile(f"[{alone}]"), regex.compile(r"\p{M}")
    return (functools.cache(lambda c: single.match(c) is not None),
            functools.cache(lambda c: mark.match(c) is not None))


def cutter(costs: Mapping[str, int], alone: str = ALONE) -> Callable[[str], list[str]]:
    """A function from a word to its terms, which remembers words."""
    terms_at, tests = terms_of(costs), character_tests(alone)

    @functools.lru_cache(CACHED_WORDS)
    def cut(word: str) -> list[str]:
        return best_path(word, terms_at, loose_ends(word, *tests))

    return cut


def segments(text: Column, dictionary: Mapping[str, int] | Iterable[str], alone: str = ALONE) -> Column:
    """Best-path segmentation: the words of a text, each cut into the terms of the cheapest path.

    For scripts without blanks, where longest match goes wrong on ambiguous text. The dictionary travels
    with the task to every executor; `segment_words` takes one of any size as a table. Null for null.
    """
    costs = as_costs(dictionary)

    @F.pandas_udf(T.ArrayType(T.StringType()))
    def cut(found: pd.Series) -> pd.Series:
        one = cutter(costs, alone)
        return found.map(lambda ws: [t for w in ws for t in one(w)], na_action="ignore")

    return cut(words(text))


def parts(word: Column, dictionary: Mapping[str, int] | Iterable[str], alone: str = ALONE) -> Column:
    """The terms of one word, as `segments` cuts it: for words that were counted first."""
    costs = as_costs(dictionary)

    @F.pandas_udf(T.ArrayType(T.StringType()))
    def cut(found: pd.Series) -> pd.Series:
        return found.map(cutter(costs, alone), na_action="ignore")

    # Else the optimizer would copy the cutting into a filter ahead of `explode`, and do it again there.
    return cut.asNondeterministic()(word)


def piece_hash(piece: str) -> int:
    """The hash of a piece, as `passing` computes it for all places of many words."""
    mixed = 0
    for c in piece:
        mixed = (mixed * HASH_BASE + ord(c)) % 2**64
    return mixed


def passing(some: Iterable[str], most: int, sieve: np.ndarray) -> set[str]:
    """The pieces of up to `most` characters of `some` words whose bit is set in the sieve."""
    text = "".join(some)
    points = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.uint64)
    sizes = np.fromiter(map(len, some), np.int64)
    left = np.repeat(np.cumsum(sizes), sizes) - np.arange(len(points))  # characters up to the word's end
    at, mixed, found = np.arange(len(points)), np.zeros(len(points), np.uint64), set()
    for size in range(1, most + 1):
        longer = left[at] >= size
        at, mixed = at[longer], mixed[longer]
        if not len(at):
            break
        mixed = mixed * np.uint64(HASH_BASE) + points[at + size - 1]
        bit = (mixed * np.uint64(HASH_SPREAD)) >> np.uint64(64 - sieve_bits(sieve))
        set_ = (sieve[bit >> np.uint64(3)] >> (bit & np.uint64(7)).astype(np.uint8)) & 1
        found.update(text[k:k + size] for k in at[set_ == 1].tolist())
    return found


def sieve_bits(sieve: np.ndarray) -> int:
    """Binary digits of the places of a sieve."""
    return (8 * len(sieve)).bit_length() - 1


def sieve_of(known: DataFrame, pieces: int) -> np.ndarray:
    """One bit for each hash of a `piece`: 16 places or more for each, up to 8 MB in all. Runs a job.

    It says which pieces cannot be in the dictionary. Of a dictionary too large for it more pieces pass, and the join
    drops them.
    """
    digits = min(26, max(15, (16 * pieces).bit_length()))

    def places(batches):
        for batch in batches:
            yield pd.DataFrame({"place": [((piece_hash(p) * HASH_SPREAD) % 2**64) >> (64 - digits) for p in batch["piece"]]})

    sieve = np.zeros((1 << digits) // 8, np.uint8)
    place = known.select("piece").mapInPandas(places, "place long")
    for row in place.groupBy(F.shiftright("place", 15).alias("run")).agg(
            F.bitmap_construct_agg(F.col("place").bitwiseAND(F.lit((1 << 15) - 1))).alias("bits")).toLocalIterator():
        sieve[row.run * 4096:(row.run + 1) * 4096] = np.frombuffer(row.bits, np.uint8)
    return sieve


def segment_words(counted: DataFrame, dictionary: DataFrame, word: str = "term", alone: str = ALONE) -> DataFrame:
    """`counted` (one row per `word`) with `parts`, from a dictionary of any size as a table (term, cost).

    Words are dealt to groups. The different pieces of a group's words that pass a sieve meet the dictionary in a
    join, and what is found goes back to the group as its own small dictionary: a piece is moved once for each group and not
    with each word and place. Only different words are looked at, and no side has to fit anywhere. Runs jobs for
    the length of the longest term, the sieve and the size of the words, which are stored.
    """
    known = stored(dictionary.where("length(term) > 0").groupBy(F.lower("term").alias("piece")).agg(F.min("cost").alias("cost")), "dictionary")
    size = known.agg(F.max(F.length("piece")).alias("most"), F.count(F.lit(1)).alias("pieces")).first()
    most, sieve = size.most or 0, sieve_of(known, size.pieces)
    counted = stored(counted.select(word, *(c for c in counted.columns if c != word)), "words")
    groups = math.ceil((counted.agg(F.sum(F.length(word))).first()[0] or 0) / GROUP_CHARACTERS) or 1
    sent = counted.sparkSession.sparkContext.broadcast(sieve)
    # Words are few bytes and much work: adaptive execution would merge tasks by size.
    tasks = int(counted.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    grouped = counted.withColumn("__group", F.pmod(F.xxhash64(word), F.lit(groups)).cast("int")).repartition(tasks, "__group")

    def look(key: tuple, held: pa.Table) -> pa.Table:
        found = sorted(passing([w for w in held.column(word).to_pylist() if w], most, sent.value))
        return pa.table({"__group": pa.array([key[0].as_py()] * len(found), pa.int32()), "piece": pa.array(found, pa.string())})

    def cut(held: pa.Table, found: pa.Table) -> pa.Table:
        one = cutter(dict(zip(found.column("piece").to_pylist(), found.column("cost").to_pylist())), alone)
        parts_ = [None if w is None else one(w) for w in held.column(word).to_pylist()]
        return held.drop_columns("__group").append_column("parts", pa.array(parts_, pa.list_(pa.string())))

    pieces = grouped.where(F.length(word) > 0).select("__group", word).groupBy("__group").applyInArrow(look, "__group int, piece string")
    found = pieces.join(known, "piece").select("__group", "piece", "cost")
    schema = T.StructType([*counted.schema.fields, T.StructField("parts", T.ArrayType(T.StringType()))])
    return grouped.groupBy("__group").cogroup(found.groupBy("__group")).applyInArrow(cut, schema)
