"""What several operators share: words, document keys, streams of sorted rows."""

from __future__ import annotations

import re
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from riverglass.session import stored  # noqa: F401

# A word is a run of bytes other than these: blank, and tab to carriage return.
WORD = r"[^\x20\x09-\x0D]+"
SPACE = re.compile(rb"[\x20\x09-\x0d]")

ID, HASH = "__rg_id", "__rg_hash"
NO_ID = -(1 << 63)


def keyed(docs: DataFrame) -> DataFrame:
    """`docs` with a key per document: its id (the smallest long for null) and a hash of its text.

    Rows that repeat both are the same document given twice.
    """
    return docs.withColumns({ID: F.coalesce(F.col("doc_id").cast("long"), F.lit(NO_ID)),
                             HASH: F.xxhash64("text")})


def real_id(column: str = ID) -> Column:
    """The document's id again, null where there was none."""
    return F.when(F.col(column) != NO_ID, F.col(column))


class Once:
    """`docs` (doc_id, text) with every (id, text hash) once, and how often each came."""

    def __init__(self, docs: DataFrame):
        # Only keys that repeat are counted out; of other rows no text is moved.
        light = keyed(docs).select(ID, HASH).groupBy(ID, HASH).agg(F.count("*").alias("__rg_copies"))
        self.copies = stored(light.where("__rg_copies > 1"), "copies")
        self.docs = docs
        if not self.copies.isEmpty():
            marked = keyed(docs).join(self.copies, [ID, HASH], "left")
            several = marked.where("__rg_copies is not null")
            one = several.groupBy(ID, HASH).agg(F.first("doc_id").alias("doc_id"), F.first("text").alias("text"))
            self.docs = marked.where("__rg_copies is null").select("doc_id", "text").unionByName(one.select("doc_id", "text"))

    def restored(self, report: DataFrame) -> DataFrame:
        """`report`, one row per (id, text hash), with a row for every copy."""
        if self.copies.isEmpty():
            return report
        times = F.coalesce(F.col("__rg_copies"), F.lit(1)).cast("int")
        return report.join(self.copies, [ID, HASH], "left").withColumn(
            "__rg_copy", F.explode(F.sequence(F.lit(1), times))).drop("__rg_copies", "__rg_copy")


def word_blocks(data: bytes, size: int = 1 << 20) -> Iterator[list[bytes]]:
    """The words of a text in blocks of about `size` bytes, so that long texts stay small in memory."""
    start = 0
    while start < len(data):
        cut = len(data)
        if start + size < cut:
            found = SPACE.search(data, start + size)
            cut = found.start() if found else cut
        words = data[start:cut].split()
        if words:
            yield words
        start = cut


def runs(flags: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends (exclusive) of the runs of true flags."""
    edges = np.flatnonzero(np.diff(np.concatenate(([0], flags.view(np.int8), [0]))))
    return edges[::2], edges[1::2]


def covered(n: int, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Which of n places lie in one of the spans [start, end)."""
    change = np.zeros(n + 1, np.int32)
    np.add.at(change, starts, 1)
    np.add.at(change, ends, -1)
    return np.cumsum(change[:n]) > 0


def pack(**columns) -> bytes:
    """Columns of equal length as one compressed value; few large values shuffle better than many short rows."""
    batch = pa.RecordBatch.from_arrays([x if isinstance(x, pa.Array) else pa.array(x) for x in columns.values()],
                                       names=list(columns))
    sink = pa.BufferOutputStream()
    with pa.ipc.new_stream(sink, batch.schema, options=pa.ipc.IpcWriteOptions(compression="zstd")) as writer:
        writer.write_batch(batch)
    return sink.getvalue().to_pybytes()


def unpack(values: Iterable[bytes]) -> pa.Table | None:
    """The rows of packed values, None if there are none."""
    parts = [pa.ipc.open_stream(v).read_all() for v in values]
    return pa.concat_tables(parts).combine_chunks() if parts else None


def text_bytes(docs: DataFrame) -> int:
    return docs.agg(F.sum(F.octet_length(F.col("text").cast("string")))).first()[0] or 0


def deal(shard: np.ndarray) -> Iterator[tuple[int, np.ndarray]]:
    """The rows of each shard, in their order."""
    order = np.argsort(shard, kind="stable")
    edges = np.flatnonzero(np.concatenate(([True], np.diff(shard[order]) != 0, [True]))) if len(shard) else [0]
    for a, b in zip(edges, edges[1:]):
        yield int(shard[order[a]]), order[a:b]


def shard_of(ids: np.ndarray, marks: np.ndarray, shards: int) -> np.ndarray:
    """The shard of documents with these keys."""
    mixed = (ids * 31 + marks).view(np.uint64)
    mixed = (mixed ^ (mixed >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
    return ((mixed ^ (mixed >> np.uint64(32))) % np.uint64(shards)).astype(np.int64)


def sharded_texts(docs: DataFrame, shards: int) -> DataFrame:
    """(shard, packed): documents as packed columns id, hash and text (bytes), by shard."""
    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, marks = batch.column(ID).to_numpy(), batch.column(HASH).to_numpy()
            number, packed = [], []
            for shard, rows in deal(shard_of(ids, marks, shards)):
                number.append(shard)
                packed.append(pack(id=ids[rows], hash=marks[rows], text=batch.column("text").take(pa.array(rows))))
            yield pa.RecordBatch.from_arrays([pa.array(number, pa.int64()), pa.array(packed, pa.binary())],
                                             names=["shard", "packed"])

    return keyed(docs).select(ID, HASH, F.col("text").cast("string").cast("binary").alias("text")).mapInArrow(
        scan, "shard long, packed binary")
