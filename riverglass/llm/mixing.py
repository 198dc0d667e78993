"""Mixing sources to target weights with thresholds on a hash, found from histograms."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from riverglass.llm.common import WORD, stored
from riverglass.session import reliable

LEVEL_BITS, LEVELS = 10, 6
HASH_BITS = LEVEL_BITS * LEVELS


def text_size(text: Column) -> Column:
    """The number of words, 0 for null."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def document_hash(doc_id: Column, text: Column) -> Column:
    """60 bits of id and text that place a document between 0 and the end of its source."""
    digest = F.md5(F.concat(F.coalesce(doc_id.cast("string"), F.lit("")), F.lit(":"),
                            F.coalesce(F.md5(text.cast("binary")), F.lit(""))))
    return F.conv(F.substring(digest, 1, HASH_BITS // 4), 16, 10).cast("long")


def copy_hash() -> Column:
    """60 bits that tell rows with equal id and text apart: from the row's place in the table."""
    return F.shiftrightunsigned(F.xxhash64(F.monotonically_increasing_id()), 64 - HASH_BITS)


def numbered(sources: DataFrame, column: str) -> DataFrame:
    """`sources` with `place`, counted from 0 by code point, null last.

    Rows are range-sorted and counted per range; only the counts per range meet in one place.
    """
    part = reliable(sources.repartitionByRange(F.col(column).isNull(), F.col(column)).withColumn(
        "__rg_part", F.spark_partition_id()))
    sizes = part.groupBy("__rg_part").agg(F.count("*").alias("__rg_n"))
    earlier = sizes.alias("x").join(
        sizes.select(F.col("__rg_part").alias("__rg_before"), F.col("__rg_n").alias("__rg_m")),
        F.expr("__rg_before < __rg_part"), "left").groupBy("__rg_part").agg(
        F.coalesce(F.sum("__rg_m"), F.lit(0)).alias("__rg_base"))
    place = F.expr(f"row_number() over (partition by __rg_part order by {column} nulls last) - 1")
    return part.withColumn("__rg_at", place).join(earlier, "__rg_part").withColumn(
        "place", F.col("__rg_base") + F.col("__rg_at")).drop("__rg_part", "__rg_at", "__rg_base")


def targets(sizes: DataFrame, weights: Sequence[int], share: float, most: float) -> DataFrame:
    """`sizes` (source, source_size) with `target`.

    All sources share `share` times all sizes by weight; a target stops at `most` times its
    source's size, and what is over goes to the others by weight, until none is above.
    """
    weight = F.element_at(F.array(*map(F.lit, weights)),
                          (F.col("place") % len(weights) + 1).cast("int")).cast("double")
    rows = reliable(numbered(sizes, "source").withColumn("weight", weight))
    total = rows.agg(F.sum("source_size")).first()[0] or 0
    cap = F.col("source_size") * F.lit(float(most))
    level, before = None, -1
    while True:  # each round fixes the sources that reach their cap at this level
        full = F.lit(False) if level is None else F.col("weight") * F.lit(level) > cap
        at = rows.agg(F.count(F.when(full, 1)), F.sum(F.when(full, cap)),
                      F.sum(F.when(~full, F.col("weight")))).first()
        if at[0] == before or not at[2]:
            break
        before, level = at[0], (total * share - (at[1] or 0.0)) / at[2]
    goal = cap if level is None else F.least(F.col("weight") * F.lit(level), cap)
    return rows.select("source", "source_size", goal.alias("target"))


def refined(rows: DataFrame, state: DataFrame, h: str) -> DataFrame:
    """`state` (source, left, ...) with `left` (what remains below the last bucket's words), `low` and `over`.

    The words of `rows` (source, size, `h`) are summed per source and hash bucket; the bucket that `left` falls into is
    refined alone, six times ten bits, down to one hash value: `low`, with `over` words. Where all words fit, `over` is
    null and `low` is above every hash.
    """
    state = state.withColumns({"low": F.lit(0).cast("long"), "over": F.lit(None).cast("long")})
    kept = [c for c in state.columns if c not in ("left", "low", "over")]
    for level in range(LEVELS):
        shift = HASH_BITS - LEVEL_BITS * (level + 1)
        bucket = F.shiftright(F.col(h), shift)
        sums = rows.groupBy("source", bucket.alias("bucket")).agg(F.sum("size").alias("words"))
        # A bucket's words lie above those of lower buckets of the same source: at most 1024 rows each.
        running = sums.withColumn("until", F.expr("sum(words) over (partition by source order by bucket)"))
        joined = running.join(state.select(F.col("source").alias("s"), "left"), F.col("source").eqNullSafe(F.col("s")))
        first = joined.where("until > left").groupBy("source").agg(
            F.min(F.struct("bucket", (F.col("until") - F.col("words")).alias("under"), "words")).alias("edge"))
        state = stored(state.join(
            first.withColumnRenamed("source", "s"), F.col("source").eqNullSafe(F.col("s")), "left").select(
            *kept, F.expr("left - coalesce(edge.under, 0)").alias("left"),
            F.when(F.col("edge").isNull(), F.lit(1 << HASH_BITS) if level == 0 else F.col("low"))
            .otherwise(F.col("edge.bucket") * F.lit(1 << shift)).cast("long").alias("low"),
            F.col("edge.words").alias("over")), "mixing-state")
        if level + 1 < LEVELS:
            edge = state.where("over is not null").select(
                F.col("source").alias("s"), F.shiftright("low", shift).alias("at"))
            rows = stored(rows.join(edge, F.col("source").eqNullSafe(F.col("s")) & (bucket == F.col("at"))).select(*rows.columns), "mixing-rows")
    return state


def thresholds(marked: DataFrame, plan: DataFrame) -> DataFrame:
    """`plan` (source, source_size, target) with `whole`, `below`, `cell` and `cell_below`.

    Every document of the source is taken `whole` times, and once more if its hash is under `below`. Of the two
    thresholds around the budget the nearer one is taken, the lower on a tie. Where several rows share the hash value
    of the boundary (a row given more than once), that `cell` is refined by the hash of the rows' places, and those
    under `cell_below` are taken: whole copies, as many as come nearest to the budget.
    """
    whole = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(0)
    start = plan.withColumn("whole", whole.cast("long")).withColumn(
        "left", F.col("target") - F.col("whole") * F.col("source_size"))
    state = refined(marked, start, "h")
    own = F.col("source").eqNullSafe(F.col("s")) & (F.col("h") == F.col("edge"))
    edge = marked.join(state.where("over is not null").select(F.col("source").alias("s"), F.col("low").alias("edge")), own)
    shared = stored(edge.groupBy("source").agg(F.count("*").alias("n")).where("n > 1").select(F.col("source").alias("s")), "mixing-shared")
    nearer = F.col("over").isNotNull() & (F.col("over") - F.col("left") < F.col("left"))
    below = F.when(nearer, F.col("low") + 1).otherwise(F.col("low"))
    none = F.lit(None).cast("long")
    if shared.isEmpty():
        return state.select("source", "source_size", "target", "whole", below.alias("below"), none.alias("cell"), none.alias("cell_below"))
    same = F.col("source").eqNullSafe(F.col("s"))
    copies = edge.drop("s", "edge").join(shared, same).select("source", "size", "copy")
    cells = refined(stored(copies, "mixing-copies"), state.join(shared, same, "left_semi").select("source", "left"), "copy").select(
        F.col("source").alias("s"), F.when(nearer, F.col("low") + 1).otherwise(F.col("low")).alias("cell_below"))
    joined = state.join(cells, same, "left")
    apart = F.col("cell_below").isNotNull()
    return joined.select("source", "source_size", "target", "whole", F.when(apart, F.col("low")).otherwise(below).alias("below"),
                         F.when(apart, F.col("low")).alias("cell"), "cell_below")


def mixed(docs: DataFrame, weights: Sequence[int] = (3, 1, 2), share: float = 1.5,
          most: float = 2.0) -> DataFrame:
    """`docs` with __rg_size, __rg_source_size, __rg_target and __rg_times (how often it is taken).

    A null source is a source of its own; null and empty texts have size 0 and follow the hash like others. The hash
    is that of doc_id and text, so rows without an id, or with the same one, are spread by their texts. Rows that
    repeat both are told apart by their places where the boundary falls on them; as they are alike, reruns agree.
    Texts of any length are counted whole. An empty table gives no rows. `docs` should be a scan or a stored table, as
    it is read twice.
    """
    sized = docs.withColumns({"__rg_size": text_size(F.col("text")), "__rg_h": document_hash(F.col("doc_id"), F.col("text")),
                              "__rg_copy": copy_hash()})
    marked = reliable(sized.select("source", F.col("__rg_size").alias("size"), F.col("__rg_h").alias("h"),
                                   F.col("__rg_copy").alias("copy")))
    sizes = marked.groupBy("source").agg(F.sum("size").alias("source_size"))
    edges = thresholds(marked, targets(sizes, weights, share, most)).select(
        F.col("source").alias("__rg_source"), F.col("source_size").alias("__rg_source_size"),
        F.col("target").alias("__rg_target"), F.col("whole").alias("__rg_whole"), F.col("below").alias("__rg_below"),
        F.col("cell").alias("__rg_cell"), F.col("cell_below").alias("__rg_cell_below"))
    more = (F.col("__rg_h") < F.col("__rg_below")) | F.coalesce(
        (F.col("__rg_h") == F.col("__rg_cell")) & (F.col("__rg_copy") < F.col("__rg_cell_below")), F.lit(False))
    return sized.join(edges, F.col("source").eqNullSafe(F.col("__rg_source"))).withColumn(
        "__rg_times", F.col("__rg_whole") + more.cast("long")).drop(
        "__rg_source", "__rg_h", "__rg_copy", "__rg_whole", "__rg_below", "__rg_cell", "__rg_cell_below")


def mixing_plan(docs: DataFrame, **options) -> DataFrame:
    """One row per row of `docs` (doc_id, text, source): size, source_size, target and words taken."""
    rows = mixed(docs.select("doc_id", "text", "source"), **options)
    return rows.select("doc_id", F.col("__rg_size").alias("size"),
                       F.col("__rg_source_size").alias("source_size"),
                       F.col("__rg_target").alias("target"),
                       (F.col("__rg_times") * F.col("__rg_size")).alias("taken"))


def mix(docs: DataFrame, **options) -> DataFrame:
    """`docs` as the mix takes them: rows taken twice come twice, `copy` counts from 1 and takes the place of a column of that name."""
    columns = [c for c in docs.columns if c != "copy"]
    return mixed(docs, **options).where("__rg_times > 0").select(
        *columns, F.explode(F.sequence(F.lit(1), F.col("__rg_times").cast("int"))).alias("copy"))
