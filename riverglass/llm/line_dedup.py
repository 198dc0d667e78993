"""Removing lines that repeat an earlier line up to one edit, by a deletion-neighbourhood join.

Two lines are within one edit exactly if, after deleting at most one character from each, they are
equal. An edit touches one segment of a line, so the line's variants are keyed by the
segment the deletion falls into and by what lies left and right of it. Lines whose surroundings
of no segment recur cannot share a variant and emit none.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window as W, functions as F

from riverglass.llm.common import HASH, ID, WORD, keyed, real_id, stored

MIN_CHARS = 20  # shorter lines ("1.", "2.") differ in one character by nature: only exact repeats of them go
SEGMENTS = 16  # at least; lines of more than 4096 characters have more


def _segments(length: Column) -> Column:
    """The segments of a line: so many that neither hashing around each nor a segment's variants cost the square of its length."""
    return F.greatest(F.lit(SEGMENTS), F.ceil(F.sqrt(length) / 4).cast("int"))


def _around(parts: Callable[[Column], Column], text: Column, n: Column) -> Column:
    """The segments of a line as (own, left, middle, outside); `outside` hashes what is around one.

    A segment begins at a place counted from the left and ends at one counted from the right.
    A line gives the segments of its own length and, as the longer of a pair, those of a line one
    character shorter.
    """
    def of(length: Column, own: bool) -> Column:
        width = F.greatest(F.ceil(length / parts(length)).cast("int"), F.lit(1))
        return F.transform(F.sequence(F.lit(0), parts(length) - 1), lambda part: F.struct(
            F.lit(own).alias("own"), part.alias("part"), length.alias("length"),
            F.least(part * width, length).alias("left"),
            F.greatest(length - (part + 1) * width, F.lit(0)).alias("rest")))

    return F.transform(F.concat(of(n, True), of(n - 1, False)), lambda s: F.struct(
        s["own"].alias("own"), s["left"].alias("left"), F.substr(text, s["left"] + 1, n - s["left"] - s["rest"]).alias("middle"),
        F.xxhash64(s["part"], s["length"], F.substr(text, F.lit(1), s["left"]),
                   F.substr(text, n - s["rest"] + 1, s["rest"])).alias("outside")))


def _occurrences(docs: DataFrame, edits_from: int) -> DataFrame:
    """(id, hash, place, h1, h2, halves) of the lines that count; h1 and h2 identify a line.

    Blank lines under `edits_from` characters do not count; `halves` is empty for other lines that short.
    """
    split = keyed(docs).select(ID, HASH, F.posexplode(F.split("text", "\n", -1)).alias("place", "line"))
    long = F.col("n") >= edits_from
    lines = split.withColumn("n", F.char_length("line")).where(long | F.col("line").rlike(WORD))
    halves = F.transform(_around(lambda _: F.lit(2), F.col("line"), F.col("n")), lambda s: s["outside"])
    return lines.select(ID, HASH, "place", F.xxhash64("line").alias("h1"),
                       F.xxhash64(F.lit("line"), "line").alias("h2"),
                       F.when(long, F.array_distinct(halves)).otherwise(F.array().cast("array<bigint>")).alias("halves"))


def _repeated(rows: DataFrame) -> DataFrame:
    """The values of `outside` that two different lines share."""
    return rows.groupBy("outside").agg(F.min("h1").alias("low"), F.max("h1").alias("high")).where(
        "low <> high").select("outside")


def _texts(docs: DataFrame, wanted: DataFrame) -> DataFrame:
    """`wanted` (h1, h2, first) with `line`, cut from the documents in which the lines come first."""
    places = wanted.groupBy(F.col(f"first.{ID}").alias(ID), F.col(f"first.{HASH}").alias(HASH)).agg(
        F.collect_list(F.struct("h1", "h2", "first")).alias("places"))
    found = keyed(docs).select(ID, HASH, "text").join(places, [ID, HASH]).dropDuplicates([ID, HASH])
    return found.select(F.split("text", "\n", -1).alias("lines"), F.explode("places").alias("at")).select(
        "at.h1", "at.h2", "at.first", F.expr("lines[at.first.place]").alias("line"))


def _variants(lines: DataFrame) -> DataFrame:
    """(h1, h2, first, full, key, at): the keys of each line's variants, and the place (from 1) that is left out.

    `full` null: lines with the key are equal but for the character at one place. Else one line,
    `full` true, is the variant itself, and the others become it by one deletion.
    """
    n = F.char_length("line")
    segments = lines.select("h1", "h2", "first", F.inline(_around(_segments, F.col("line"), n)))
    alike = segments.join(_repeated(segments), "outside", "left_semi")
    long = F.char_length("middle")

    def variant(full: bool | None, i: Column, *parts: Column) -> Column:
        return F.struct(F.lit(full).cast("boolean").alias("full"), F.xxhash64(F.lit(full is None), *parts).alias("key"),
                        (F.col("left") + i).cast("int").alias("at"))

    def deletion(i: Column) -> Column:
        return F.concat(F.substr("middle", F.lit(1), i - 1), F.substr("middle", i + 1, long))

    none = F.array().cast("array<struct<full:boolean,key:bigint,at:int>>")
    places = F.sequence(F.lit(1), long)
    replaced = F.transform(places, lambda i: variant(None, i, F.col("outside"), i, deletion(i)))
    shorter = F.transform(places, lambda i: variant(False, i, F.col("outside"), deletion(i)))
    whole = F.array(variant(True, F.lit(0), F.col("outside"), F.col("middle")))
    own = F.concat(F.when(long > 0, replaced).otherwise(none), whole)
    return alike.select("h1", "h2", "first", F.inline(F.when(F.col("own"), own).when(long > 0, shorter).otherwise(none)))


def near_lines(docs: DataFrame, first: DataFrame) -> DataFrame:
    """(h1, h2) of the lines with an earlier line at one edit; `first`: (h1, h2, first, halves)."""
    halves = first.select("h1", "h2", F.explode("halves").alias("outside"))
    some = halves.join(_repeated(halves), "outside", "left_semi").select("h1", "h2").distinct()
    wanted = first.join(some, ["h1", "h2"], "left_semi").select("h1", "h2", "first")
    lines = stored(_texts(docs, wanted), "candidate-lines")
    # Lines of one key differ in one character, so their number is bounded by the alphabet.
    me = F.struct("first", "h1", "h2", "at")
    one = W.partitionBy("key")
    met = _variants(lines).select(
        "h1", "h2", "full", me.alias("me"), F.min(me).over(one).alias("least"),
        F.min(F.when(F.col("full"), me)).over(one).alias("whole"),
        F.min(F.when(~F.col("full"), me)).over(one).alias("longer"))
    # A key's earliest line is one replacement away from its others; the full line is one
    # insertion away from each of the longer ones.
    lead = F.when(F.col("full").isNull(), F.col("least")).when(F.col("full"), F.col("longer")).otherwise(F.col("whole"))
    places = F.collect_set(F.when(F.col("full"), F.col("lead.at")).otherwise(F.col("me.at")))
    found = met.withColumn("lead", lead).where("lead.first < me.first").groupBy(
        "h1", "h2", F.col("lead.h1").alias("g1"), F.col("lead.h2").alias("g2"), "full").agg(places.alias("places"))
    texts = lines.select("h1", "h2", "line")
    earlier = texts.select(F.col("h1").alias("g1"), F.col("h2").alias("g2"), F.col("line").alias("earlier"))
    both = found.join(texts, ["h1", "h2"]).join(earlier, ["g1", "g2"])
    return both.where(F.exists("places", _one_edit)).select("h1", "h2").distinct()


def _one_edit(at: Column) -> Column:
    """Whether `line` and `earlier` are equal without the character at a place: of both, or of the longer (`full`: `earlier`)."""
    def without(name: str) -> Column:
        return F.concat(F.substr(name, F.lit(1), at - 1), F.substr(name, at + 1, F.char_length(name)))

    return F.when(F.col("full").isNull(), without("line") == without("earlier")).when(
        F.col("full"), F.col("line") == without("earlier")).otherwise(without("line") == F.col("earlier"))


def removals(docs: DataFrame, edits_from: int = MIN_CHARS) -> DataFrame:
    """(id, hash, removed): the places of each document's removed lines, where there are any."""
    occurrences = stored(_occurrences(docs, edits_from), "lines")
    place = F.struct(ID, HASH, "place")
    first = stored(occurrences.groupBy("h1", "h2").agg(
        F.min(place).alias("first"), F.max(place).alias("last"), F.any_value("halves").alias("halves")), "first-lines")
    near = stored(near_lines(docs, first.select("h1", "h2", "first", "halves")), "near-lines")
    judged = first.select("h1", "h2", "first", "last").join(
        near.withColumn("near", F.lit(True)), ["h1", "h2"], "left").where("near or first <> last")
    gone = occurrences.join(judged, ["h1", "h2"]).where(F.col("near").isNotNull() | (F.col("first") != place))
    return gone.groupBy(ID, HASH).agg(F.collect_set("place").alias("removed"))


def _kept(docs: DataFrame, edits_from: int) -> DataFrame:
    """`docs` with their keys, `__rg_lines`, `__rg_removed` and `__rg_text` (what is left of the text)."""
    marked = keyed(docs).join(removals(docs, edits_from).withColumnRenamed("removed", "__rg_removed"), [ID, HASH], "left")
    lines = marked.withColumn("__rg_lines", F.split("text", "\n", -1))
    left = F.array_except(F.sequence(F.lit(0), F.size("__rg_lines") - 1), F.col("__rg_removed"))
    text = F.when(F.col("__rg_removed").isNull(), F.col("text")).otherwise(
        F.array_join(F.transform(left, lambda i: F.get("__rg_lines", i)), "\n"))
    return lines.withColumn("__rg_text", text)


def dedup_lines(docs: DataFrame, edits_from: int = MIN_CHARS) -> DataFrame:
    """`docs` without lines that repeat an earlier line; documents of which nothing is left go.

    Lines are parts between line feeds, order is by doc_id (null first), then place. A line
    that is not blank goes if an earlier line is equal, and one of at least `edits_from` characters also
    if an earlier line as long is within one edit, even if that line goes itself. Blank lines of fewer
    characters stay. Null and empty texts stay as they are; rows that repeat id and
    text are one document and get the same text; no documents give none. Lines of any length are
    compared whole. Other columns pass through.
    """
    rows = _kept(docs, edits_from).where("__rg_removed is null or size(__rg_removed) < size(__rg_lines)")
    return rows.select(*[F.col("__rg_text").alias("text") if c == "text" else c for c in docs.columns])


def line_report(docs: DataFrame, edits_from: int = MIN_CHARS) -> DataFrame:
    """Per row of `docs`: doc_id, n_lines, n_removed, kept_sha256 (of the remaining text; null counts as empty)."""
    return _kept(docs.select("doc_id", "text"), edits_from).select(
        real_id().alias("doc_id"), F.coalesce(F.size("__rg_lines"), F.lit(0)).cast("long").alias("n_lines"),
        F.when(F.col("__rg_removed").isNull(), 0).otherwise(F.size("__rg_removed")).cast("long").alias("n_removed"),
        F.sha2(F.coalesce("__rg_text", F.lit("")), 256).alias("kept_sha256"))
