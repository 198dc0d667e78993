"""Substring dedup: bytes covered by a long string that also starts earlier in the corpus.

Strings are told apart by bucket identifiers that are refined by those of later offsets, doubling the length
each time (`repeats.grams`), as in sorting suffixes by bucket pointers. Not all suffixes are put into buckets on the cluster,
and none are sorted there: only anchors are (see `repeats`), buckets with one of them are done at once, and where a bucket
splits the strings between its anchors are compared by their identifiers.
"""

from __future__ import annotations

import hashlib
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from riverglass.llm.common import HASH, ID, Once, covered, real_id, runs, unpack
from riverglass.llm.repeats import mixed, repeats

LENGTH, GRAM = 100, 32
_NONE = np.zeros(0, np.int64)
_BYTES = mixed(np.arange(1, 257, dtype=np.uint64))


def byte_hashes(data: bytes) -> np.ndarray:
    return _BYTES[np.frombuffer(data, np.uint8)]


def removal_report(docs: DataFrame, length: int = LENGTH, gram: int = GRAM) -> DataFrame:
    """Per row of `docs`: doc_id, n_bytes, n_removed, n_spans and kept_sha256 of the remaining bytes.

    A byte goes if a string of `length` bytes that covers it also starts under a smaller
    doc_id (null is the smallest), or earlier in its own text. Null texts are empty; rows that
    repeat id and text are one document; different texts of one id are ordered by their hash.
    """
    rows = Once(docs.select("doc_id", F.col("text").cast("string").alias("text")))
    texts, spans, _ = repeats(rows.docs, byte_hashes, length, gram, within=True)

    def cut(texts: pa.Table, spans: pa.Table) -> pa.Table:
        found = by_document(spans.column("packed").to_pylist())
        out = []
        for value in texts.column("packed"):
            given = unpack([value.as_py()])
            for ident, mark, text in zip(*(given.column(c).to_pylist() for c in ("id", "hash", "text"))):
                data = np.frombuffer(text or b"", np.uint8)
                first, more = found.get((ident, mark), (_NONE, _NONE))
                starts, ends = runs(covered(len(data), first, first + more + length))
                digest, at = hashlib.sha256(), 0
                for a, b in zip(starts, ends):
                    digest.update(data[at:a])
                    at = b
                digest.update(data[at:])
                out.append((ident, mark, len(data), int((ends - starts).sum()), len(starts), digest.hexdigest()))
        kinds = (*[pa.int64()] * 5, pa.string())
        return pa.Table.from_arrays([pa.array([r[i] for r in out], k) for i, k in enumerate(kinds)],
                                    names=[ID, HASH, "n_bytes", "n_removed", "n_spans", "kept_sha256"])

    report = texts.groupBy("shard").cogroup(spans.groupBy("shard")).applyInArrow(
        cut, f"{ID} long, {HASH} long, n_bytes long, n_removed long, n_spans long, kept_sha256 string")
    return rows.restored(report).select(real_id().alias("doc_id"), "n_bytes", "n_removed", "n_spans", "kept_sha256")


def by_document(packed: list[bytes]) -> dict[tuple[int, int], tuple[np.ndarray, np.ndarray]]:
    """(first, more) of the packed spans for each document's key."""
    table = unpack(packed)
    if table is None:
        return {}
    ident, mark, first, more = (table.column(c).to_numpy() for c in ("id", "hash", "first", "more"))
    order = np.lexsort((mark, ident))
    ident, mark = ident[order], mark[order]
    edges = np.flatnonzero(np.concatenate(([True], (np.diff(ident) != 0) | (np.diff(mark) != 0), [True])))
    return {(int(ident[a]), int(mark[a])): (first[order[a:b]], more[order[a:b]]) for a, b in zip(edges, edges[1:])}
