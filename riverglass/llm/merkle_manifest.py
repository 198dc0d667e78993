"""A dataset manifest as a Merkle tree, kept as content-addressed records, with a proof for every row.

Leaves are digests of rows. Per source they ascend by id, and 16 at a time become the digest of
their digests until one is left; the sources' digests become the root in the same way. Every
inner node is a record (digest, children) that is looked up by its digest alone. Requests for leaves
descend from the root: the digits of a leaf's rank, the highest first, choose a child of each
record, and the children not chosen are what its proof needs. Requests that share a prefix share the descent,
so the records near the root are looked up once and not once per leaf.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from riverglass.session import work_dir

FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
BITS = 4
FAN = 1 << BITS
UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
SLOT_BITS = 33
PATH = "array<struct<left: string, right: string>>"


def digest(text: Column) -> Column:
    return F.sha2(text, 256)


def field(value: Column) -> Column:
    """A value with its length in bytes, `-` for null."""
    text = value.cast("string")
    return F.when(text.isNull(), F.lit("-")).otherwise(
        F.concat(F.octet_length(text).cast("string"), F.lit(":"), text))


def leaf(text: Column | None = None) -> Column:
    """The digest of a row, with another text if one is given."""
    return digest(F.concat(*(field(text if text is not None and c == "text" else F.col(c)) for c in FIELDS)))


def tampered(doc_id: Column) -> Column:
    """Rows whose text is changed for the check of their proof: a fifth of the ids, none without id."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 5 == 0, F.lit(False))


@dataclass
class Manifest:
    """The stored tables of one tree.

    `leaves`: (tree, rank, width, doc_id, source, leaf, offered) with tree the source's place and width its leaves.
    `sources` and `root`: records (digest, children) by height. `tops`: (tree, depth, digest), the sources' subroots.
    The field `root` is None for an empty table.
    """
    spark: SparkSession
    folder: str
    root: str | None
    height: int  # of the tree over the sources
    depth: int  # of the deepest source

    def table(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.folder}/{name}")


def _saved(df: DataFrame, path: str) -> DataFrame:
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def _numbered(docs: DataFrame, folder: str) -> DataFrame:
    """(tree, rank, width, doc_id, source, leaf, offered): leaves numbered from 0 within their source, of `width`.

    Leaves are range-sorted over all tasks, so a large source is split, and rows that are alike too; only
    one row per task and source is added up to turn places in a task into ranks.
    """
    changed = F.when(tampered(F.col("doc_id")), F.translate("text", UPPER, UPPER.lower())).otherwise(F.col("text"))
    rows = docs.select(*(F.col(c) for c in FIELDS))
    rows = _saved(rows.select("doc_id", "source", leaf().alias("leaf"), leaf(changed).alias("offered")), f"{folder}/digests")
    order = [F.asc_nulls_first("source"), F.asc_nulls_first("doc_id"), F.asc("leaf"), F.asc("tie")]
    slots = _saved(rows.withColumn("tie", F.monotonically_increasing_id()).repartitionByRange(*order)
                   .sortWithinPartitions(*order).drop("tie").withColumn("slot", F.monotonically_increasing_id()),
                   f"{folder}/slots")
    slots = slots.withColumn("task", F.shiftright("slot", SLOT_BITS))
    held = slots.groupBy("task", "source").agg(F.min("slot").alias("low"), F.count("*").alias("n"))
    # One row per task that a source reaches into.
    held = held.withColumn("before", F.expr(
        "coalesce(sum(n) over (partition by source order by task rows between unbounded preceding and 1 preceding), 0)")
    ).withColumn("width", F.expr("sum(n) over (partition by source)"))
    # Sources in their order: by the task they begin in, then by their place in it.
    first = held.where("before = 0").select(F.col("source").alias("s"), F.col("task").alias("at"), "low")
    begun = first.groupBy("at").agg(F.count("*").alias("k")).withColumn("earlier", F.expr(
        "coalesce(sum(k) over (order by at rows between unbounded preceding and 1 preceding), 0)")).drop("k")
    trees = first.withColumn("place", F.expr("row_number() over (partition by at order by low) - 1")).join(begun, "at").select(
        "s", (F.col("earlier") + F.col("place")).cast("long").alias("tree"))
    bases = held.join(trees, F.col("source").eqNullSafe(F.col("s"))).select(
        "tree", F.col("task").alias("t"), F.col("source").alias("s"), (F.col("before") - F.col("low")).alias("shift"), "width")
    return _saved(slots.join(bases, (F.col("task") == F.col("t")) & F.col("source").eqNullSafe(F.col("s"))).select(
        "tree", (F.col("slot") + F.col("shift")).alias("rank"), "width", "doc_id", "source", "leaf", "offered"), f"{folder}/leaves")


def _parents(nodes: DataFrame) -> DataFrame:
    """Records one higher than `nodes` (tree, rank, digest, width), 16 children at most in each."""
    child = F.struct(F.col("rank").bitwiseAND(F.lit(FAN - 1)).alias("digit"), "digest")
    up = nodes.groupBy("tree", F.shiftright("rank", BITS).alias("rank")).agg(
        F.array_sort(F.collect_list(child)).alias("found"), F.first("width").alias("width"))
    children = F.transform("found", lambda x: x["digest"])
    return up.select("tree", "rank", digest(F.array_join(children, "")).alias("digest"),
                     F.floor((F.col("width") + FAN - 1) / FAN).alias("width"), children.alias("children"))


def _grow(nodes: DataFrame, folder: str, name: str) -> tuple[DataFrame, int]:
    """(tree, depth, digest) of the single nodes that trees of `nodes` end in, and the largest depth.

    Every level is stored: inner nodes under records/`name`=height.
    """
    tops, height = [], 0
    while True:
        tops.append(nodes.where("width = 1").select("tree", F.lit(height).alias("depth"), "digest"))
        nodes = nodes.where("width > 1")
        if nodes.isEmpty():
            break
        height += 1
        nodes = _saved(_parents(nodes), f"{folder}/{name}/height={height}").drop("children")
    found = tops[0]
    for more in tops[1:]:
        found = found.unionByName(more)
    return found, height


def build(docs: DataFrame) -> Manifest:
    """The tree over `docs` (doc_id, source, lang, n_chars, text), written to the shared folder."""
    spark, folder = docs.sparkSession, work_dir(docs.sparkSession, "manifest")
    leaves = _numbered(docs, folder)
    nodes = leaves.select("tree", "rank", F.col("leaf").alias("digest"), "width")
    tops, depth = _grow(nodes, folder, "sources")
    tops = _saved(tops, f"{folder}/tops")
    size = tops.count()
    if not size:
        return Manifest(spark, folder, None, 0, 0)
    root, height = _grow(tops.select(F.lit(0).cast("long").alias("tree"), F.col("tree").alias("rank"), "digest",
                                     F.lit(size).cast("long").alias("width")), folder, "root")
    return Manifest(spark, folder, root.first()["digest"], height, depth)


def _records(tree: Manifest, name: str, height: int) -> DataFrame:
    """The records of a height by digest, each once however often it is used, checked against its digest."""
    found = tree.spark.read.parquet(f"{tree.folder}/{name}/height={height}").select(
        F.col("digest").alias("address"), "children").dropDuplicates(["address"])
    good = digest(F.array_join("children", "")) == F.col("address")
    return found.withColumn("children", F.when(good, F.col("children")).otherwise(
        F.raise_error(F.concat(F.lit("damaged record "), F.col("address")))))


def _segment(digit: Column) -> Column:
    """The children on both sides of the chosen one, joined."""
    return F.struct(
        F.array_join(F.slice("children", F.lit(1), digit), "").alias("left"),
        F.array_join(F.slice("children", digit + 2, F.greatest(F.size("children") - digit - 1, F.lit(0))), "").alias("right"))


def _down(tree: Manifest, name: str, height: int, frontier: DataFrame, wanted: DataFrame) -> DataFrame:
    """From nodes (tree, rank, digest, path, ...) of a height to the `wanted` (tree, rank, ...) children below them."""
    carried = [c for c in frontier.columns if c not in ("tree", "rank", "digest", "path")]
    opened = frontier.join(_records(tree, name, height), F.col("digest") == F.col("address")).select(
        F.col("tree").alias("t"), F.col("rank").alias("r"), "children", "path", *carried)
    digit = F.col("rank").bitwiseAND(F.lit(FAN - 1)).cast("int")
    return wanted.join(opened, (F.col("tree") == F.col("t")) & (F.shiftright("rank", BITS) == F.col("r"))).select(
        *wanted.columns, *carried, F.element_at("children", digit + 1).alias("digest"),
        F.concat("path", F.array(_segment(digit))).alias("path"))


def _prefixes(wanted: DataFrame, heights: int) -> list[DataFrame]:
    """The distinct (tree, rank) of `wanted` and of their ancestors, from height 0 up."""
    levels = [wanted.select("tree", "rank").distinct()]
    for _ in range(heights):
        levels.append(levels[-1].select("tree", F.shiftright("rank", BITS).alias("rank")).distinct())
    return levels


def prove(tree: Manifest, requests: DataFrame) -> DataFrame:
    """`requests` (tree, rank, and any other columns) with `subroot`, `digest` and `path` from the leaf to the root.

    `digest` is the leaf found there. Each segment of the path holds the joined digests left and right of
    the node that was chosen. What the descent has at the sources is stored.
    """
    spark, folder = tree.spark, work_dir(tree.spark, "proofs")
    frontier = spark.createDataFrame([(0, 0, tree.root)], "tree long, rank long, digest string").withColumn(
        "path", F.array().cast(PATH))
    asked = requests.select(F.lit(0).cast("long").alias("tree"), F.col("tree").alias("rank")).distinct()
    wanted = _prefixes(asked, tree.height)
    for height in range(tree.height, 0, -1):
        frontier = _down(tree, "root", height, frontier, wanted[height - 1])
    found = _saved(frontier.select(F.col("rank").alias("tree"), "digest", "path").join(
        tree.table("tops").select("tree", "depth"), "tree"), f"{folder}/sources")
    # Sources have trees of different depths: each joins the descent at its own.
    begin = lambda depth: found.where(F.col("depth") == depth).select(
        "tree", F.lit(0).cast("long").alias("rank"), F.col("digest").alias("subroot"), "digest", "path")
    wanted, frontier = _prefixes(requests, tree.depth), None
    wanted[0] = requests
    for height in range(tree.depth, 0, -1):
        frontier = begin(height) if frontier is None else frontier.unionByName(begin(height))
        frontier = _down(tree, "sources", height, frontier, wanted[height - 1])
    alone = requests.join(begin(0).drop("rank"), "tree").select(*requests.columns, "subroot", "digest", "path")
    proofs = alone if frontier is None else frontier.unionByName(alone)
    return proofs.withColumn("path", F.reverse("path"))


def fold(start: Column, path: Column) -> Column:
    """The root that a leaf and the segments of its path give."""
    return F.aggregate(path, start, lambda now, x: digest(F.concat(x["left"], now, x["right"])))


def proof_report(docs: DataFrame) -> DataFrame:
    """Per row of `docs`: doc_id, leaf, subroot, root, proof_sha256, folded_root and verified.

    `proof_sha256` is the digest of the siblings' digests, from the leaf up, left to right. `folded_root` is
    computed from the siblings and the row as it is offered: with its text in lower case (A to Z only) where
    `tampered`, so `verified` is false there if the text has such letters.
    Nulls are `-` in a leaf; a null source is the first one; null ids come first and are never tampered with.
    Rows that repeat are leaves of their own, beside each other. Rows with equal ids stand in the order of their
    leaves. Empty and long texts are digested whole. An empty table gives no rows. Other columns are not read.
    """
    tree = build(docs)
    if tree.root is None:
        return docs.select("doc_id", *(F.lit("").alias(c) for c in ("leaf", "subroot", "root", "proof_sha256", "folded_root")),
                           F.lit(False).alias("verified")).limit(0)
    proofs = prove(tree, tree.table("leaves").select("tree", "rank", "doc_id", "offered"))
    root = F.lit(tree.root)
    siblings = F.array_join(F.transform("path", lambda x: F.concat(x["left"], x["right"])), "")
    return proofs.select(
        "doc_id", F.col("digest").alias("leaf"), "subroot", root.alias("root"), digest(siblings).alias("proof_sha256"),
        fold(F.col("offered"), F.col("path")).alias("folded_root")).withColumn("verified", F.col("folded_root") == root)
