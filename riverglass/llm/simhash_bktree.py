"""Near copies by SimHash fingerprints, found with sharded BK-trees."""

from __future__ import annotations

from collections.abc import Iterator
from functools import partial
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, functions as F

from riverglass.llm.common import HASH, ID, keyed, real_id, word_blocks
from riverglass.llm.components import components
from riverglass.session import reliable

MASK = (1 << 64) - 1
SHARD = 4096  # largest tree of a first-level shard; larger ones are keyed again


def fingerprint(data: bytes, shingle: int, seed: int) -> int:
    """The SimHash of a text's word shingles, 0 if it has no word."""
    digest = partial(xxhash.xxh64_intdigest, seed=seed)
    counts, total, tail = np.zeros(64, np.int64), 0, []
    for words in word_blocks(data.lower()):  # bytes.lower() changes A-Z only
        words = tail + words
        tail = words[max(0, len(words) - shingle + 1):]
        n = len(words) - shingle + 1
        if n <= 0:
            continue
        joined = b" ".join(words)
        ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
        starts = np.concatenate(([0], ends[:-1] + 1))
        pieces = zip(starts[:n].tolist(), ends[shingle - 1:].tolist())
        hashes = np.fromiter((digest(joined[a:b]) for a, b in pieces), np.uint64, n)
        for at in range(0, n, 65536):
            octets = hashes[at:at + 65536].view(np.uint8).reshape(-1, 8)
            counts += np.unpackbits(octets, axis=1, bitorder="little").sum(0, dtype=np.int64)
        total += n
    if not total and tail:
        octets = np.array([digest(b" ".join(tail))], np.uint64).view(np.uint8)
        counts, total = np.unpackbits(octets, bitorder="little").astype(np.int64), 1
    bits = np.packbits(2 * counts > total, bitorder="little") if total else np.zeros(8, np.uint8)
    return int(bits.view(np.int64)[0])


def fingerprints(docs: DataFrame, shingle: int = 3, seed: int = 42) -> DataFrame:
    """(id, hash, fp): the document's key and its fingerprint as a signed long."""
    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column("text").cast(pa.binary())
            marks = [fingerprint(t.as_py() or b"", shingle, seed) for t in texts]
            yield pa.RecordBatch.from_arrays(
                [batch.column(ID), batch.column(HASH), pa.array(marks, pa.int64())],
                names=[ID, HASH, "fp"])

    return keyed(docs).select(ID, HASH, F.col("text").cast("string").alias("text")).mapInArrow(
        score, f"{ID} long, {HASH} long, fp long")


class Tree:
    """A BK-tree: the children of a node are keyed by their distance to it."""

    def __init__(self):
        self.values: list[int] = []
        self.children: list[dict[int, int]] = []

    def near(self, value: int, radius: int) -> list[int]:
        """Places of the values within `radius`: only edges whose length can reach them are followed."""
        found, open_ = [], [0] if self.values else []
        while open_:
            at = open_.pop()
            distance = (self.values[at] ^ value).bit_count()
            if distance <= radius:
                found.append(at)
            below = self.children[at]
            if below:
                for length in range(distance - radius, distance + radius + 1):
                    if length in below:
                        open_.append(below[length])
        return found

    def add(self, value: int) -> None:
        at = len(self.values)
        self.values.append(value)
        self.children.append({})
        if at:
            node = 0
            while True:
                length = (self.values[node] ^ value).bit_count()
                if length not in self.children[node]:
                    self.children[node][length] = at
                    return
                node = self.children[node][length]


def tree_links(values: list[int], radius: int) -> list[tuple[int, int]]:
    """A forest over the values that joins exactly those linked within `radius`."""
    tree, parent, links = Tree(), [], []

    def root(x: int) -> int:
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    for at, value in enumerate(values):
        parent.append(at)
        for other in tree.near(value & MASK, radius):
            top = root(other)
            if top != (own := root(at)):
                parent[own] = top
                links.append((values[other], value))
        tree.add(value & MASK)
    return links


def _with_shards(fps: DataFrame, blocks: int, radius: int) -> DataFrame:
    """Each fingerprint with one shard per choice of blocks that must agree.

    `radius` differing bits touch at most `radius` of the blocks, so two linked fingerprints
    agree on some choice of the others.
    """
    bits = 64 // blocks
    choices = []
    for number, chosen in enumerate(combinations(range(blocks), blocks - radius)):
        key = F.lit(number).cast("long")
        for block in chosen:
            part = F.shiftrightunsigned("fp", block * bits).bitwiseAND((1 << bits) - 1)
            key = F.shiftleft(key, bits).bitwiseOR(part)
        choices.append(key)
    return fps.select("fp", F.explode(F.array(*choices)).alias("shard"))


def _search(rows: DataFrame, radius: int, limit: int) -> DataFrame:
    """Links inside each shard, or the shard's rows again (b null) if it has more than `limit`."""
    def packed(out) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array([r[k] for r in out], pa.int64()) for k in (0, 1)],
                                          names=["a", "b"])

    def walk(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out: list[tuple[int, int | None]] = []
        now, held, over = None, [], False
        for batch in batches:
            for shard, mark in zip(batch.column("shard").to_pylist(), batch.column("fp").to_pylist()):
                if shard != now:
                    out.extend(tree_links(held, radius))
                    now, held, over = shard, [], False
                if over:
                    out.append((mark, None))
                    continue
                held.append(mark)
                if len(held) > limit:
                    out.extend((m, None) for m in held)
                    held, over = [], True
            if len(out) > 10_000:
                yield packed(out)
                out.clear()
        out.extend(tree_links(held, radius))
        yield packed(out)

    return rows.repartition("shard").sortWithinPartitions("shard", "fp").mapInArrow(
        walk, "a long, b long")


def links(fps: DataFrame, radius: int = 2) -> DataFrame:
    """Links (a, b) that join all of the distinct fingerprints `fps` within `radius` (0 to 2) bits.

    Fingerprints are dealt to shards by two (at radius 2) of four blocks of 16 bits that must
    agree, and each shard has its BK-tree in the task that holds its rows. Trees are not sent to
    other tasks, as together they grow with the data. Rows of a shard above SHARD are
    dealt again by 14 of 16 blocks of 4 bits; what then shares a shard differs in 8 bits, so it
    has 256 fingerprints at most.
    """
    if not 0 <= radius <= 2:
        raise ValueError("radius must be 0, 1 or 2")
    first = reliable(_search(_with_shards(fps, 4, radius), radius, SHARD))
    over = first.where("b is null").select(F.col("a").alias("fp")).distinct()
    again = _search(_with_shards(over, 16, radius), radius, SHARD)
    return first.where("b is not null").unionByName(again)


def groups(marks: DataFrame, radius: int = 2) -> DataFrame:
    """(id, hash, fp, root): fingerprints linked within `radius`, by any number of steps, share a root."""
    distinct = marks.select("fp").distinct()
    found = components(links(distinct, radius))
    return marks.join(found, marks.fp == found.node, "left").select(
        ID, HASH, "fp", F.coalesce("root", "fp").alias("root"))


def near_duplicates(docs: DataFrame, shingle: int = 3, seed: int = 42, radius: int = 2) -> DataFrame:
    """One row per row of `docs` (doc_id, text): doc_id, fingerprint, component_id.

    Null and empty texts have fingerprint zero and link like any other. `component_id` is the
    smallest id reachable, null if no document there has one. Repeated rows get equal results;
    other columns are not read. An empty table gives an empty result.
    """
    found = groups(reliable(fingerprints(docs, shingle, seed)), radius)
    least = found.groupBy("root").agg(F.min(real_id()).alias("component_id"))
    return found.join(least, "root").select(
        real_id().alias("doc_id"), F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"),
        "component_id")


def keep_one(docs: DataFrame, shingle: int = 3, seed: int = 42, radius: int = 2) -> DataFrame:
    """`docs` with one document of each group: that with the smallest id (rows without id last)."""
    found = groups(reliable(fingerprints(docs, shingle, seed)), radius)
    order = F.struct((F.col(ID) == F.lit(-(1 << 63))).alias("none"), F.col(ID), F.col(HASH))
    kept = found.groupBy("root").agg(F.min(order).alias("kept")).select(f"kept.{ID}", f"kept.{HASH}")
    return keyed(docs).join(kept, [ID, HASH], "left_semi").dropDuplicates([ID, HASH]).select(docs.columns)
