"""Windows of a sequence that occur again elsewhere, found from sampled places.

A sequence is an array of element hashes (of bytes or of words). Every window of W elements
chooses, among its grams of q elements, the one with the smallest hash, the leftmost on a tie: its
anchor. Equal windows choose equal anchors at equal offsets, so a repeated window is found by
comparing only the regions (unions of consecutive windows with one anchor) that have the same anchor gram.
About two of W - q + 2 places are anchors, so few rows are shuffled instead of one per place.

Regions with equal content form a class; all members but the first are repeats as a whole. Where
an anchor has several classes, the windows of their first members are compared one by one.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from riverglass.llm.common import (
    HASH, ID, covered, deal, keyed, pack, runs, shard_of, sharded_texts, stored, text_bytes, unpack)

PIECE = 1 << 20  # elements handled at once
SHARD_BYTES = 8 << 20  # text of the documents that are looked at together
BUCKET_BYTES = 16 << 20  # text whose regions, or windows, meet in one bucket
SAMPLE = 64  # one document in so many is read for anchors that are very common
COMMON = 2000  # at most so many anchors are kept as common
_A, _B, _C = (np.uint64(x) for x in (0x9E3779B97F4A7C15, 0xBF58476D1CE4E5B9, 0x94D049BB133111EB))


def mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * _B
    x = (x ^ (x >> np.uint64(27))) * _C
    return x ^ (x >> np.uint64(31))


def joined(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Identifiers of pairs: those of a gram and of the gram at a later offset give the longer gram's."""
    return mixed(a * _A + (b ^ (b >> np.uint64(32))))


def grams(values: np.ndarray, *lengths: int) -> list[np.ndarray]:
    """Identifiers of the grams of the given rising lengths at every place.

    A bucket's identifier is refined by that of the bucket half a gram later, and the refined
    identifiers are used again for the next doubling.
    """
    found, now, width = [], values, 1
    for length in lengths:
        while 2 * width <= length:
            now = joined(now[:-width], now[width:])
            width *= 2
        shift = length - width
        found.append(now if not shift else joined(now[:len(now) - shift], now[shift:]))
    return found


def anchors(order: np.ndarray, width: int) -> np.ndarray:
    """For each run of `width` places that of the smallest value, the leftmost on a tie."""
    place = np.arange(len(order), dtype=np.uint64)
    now, size = (order & ~np.uint64(0xFFFFFF)) | place, 1
    while 2 * size <= width:
        now = np.minimum(now[:-size], now[size:])
        size *= 2
    if size < width:
        now = np.minimum(now[:len(now) - (width - size)], now[width - size:])
    return (now & np.uint64(0xFFFFFF)).astype(np.int64)


def regions(values: np.ndarray, window: int, gram: int) -> Iterator[tuple[np.ndarray, ...]]:
    """(anchor, class, first, last): anchor gram and content of each region, and its first and last window."""
    for at in range(0, max(1, len(values) - window + 1), PIECE):
        piece = values[at:at + PIECE + window - 1]
        if len(piece) < window:
            return
        short, whole = grams(piece, gram, window)
        chosen = anchors(mixed(short ^ _A), window - gram + 1)
        edges = np.flatnonzero(np.diff(chosen)) + 1
        first = np.concatenate(([0], edges))
        last = np.concatenate((edges, [len(chosen)])) - 1
        anchor = chosen[first]
        # The first and the last window overlap, so together they are the region's content.
        shape = ((last - first) << 20 | (anchor - first)).astype(np.uint64)
        content = joined(joined(whole[first], whole[last]), shape)
        yield short[anchor], content, first + at, last + at


def _mine(docs: DataFrame, elements: Callable[[bytes], np.ndarray], window: int, gram: int,
          common: list[int], within: bool, buckets: int, places: bool) -> DataFrame:
    """(bucket, packed): regions by the bucket of their anchor.

    Of equal regions in one batch of rows only the first needs its anchor; the others repeat it,
    have its document as `witness` and may go to any bucket. Very common anchors are dealt by class too.
    """
    heavy = np.array(sorted(common), np.int64)

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            parts = []
            ids, marks = batch.column(ID).to_numpy(), batch.column(HASH).to_numpy()
            for row, text in enumerate(batch.column("text")):
                data = text.as_py()
                if data:
                    for found in regions(elements(data), window, gram):
                        parts.append((np.full(len(found[0]), row, np.int32), *found))
            if not parts:
                continue
            row, anchor, content, first, last = (np.concatenate(x) for x in zip(*parts))
            del parts
            # 48 bits of each: together 96 bits tell regions apart
            anchor, content = (anchor >> np.uint64(16)).view(np.int64), (content >> np.uint64(16)).view(np.int64)
            order = np.lexsort((first, marks[row], ids[row], content, anchor))
            row, anchor, content, first, last = (x[order] for x in (row, anchor, content, first, last))
            ident, mark = ids[row], marks[row]
            new = np.concatenate(([True], (anchor[1:] != anchor[:-1]) | (content[1:] != content[:-1])))
            lead = np.maximum.accumulate(np.where(new, np.arange(len(new)), 0))
            once = np.concatenate(([True], new[1:] | (ident[1:] != ident[:-1]) | (mark[1:] != mark[:-1])
                                   | (first[1:] != first[:-1])))  # else a row of the input given twice
            again = ~new if within else ident > ident[lead]
            common_one = np.isin(anchor, heavy)
            route = np.where(again, ident ^ first, np.where(common_one, anchor ^ content, anchor))
            bucket = np.where(once, (mixed(route.view(np.uint64)) % np.uint64(buckets)).astype(np.int64), -1)
            witness = pa.array(ident[lead], mask=~again)
            more_of = {"w_hash": mark[lead], "w_first": first[lead].astype(np.int32)} if places else {}
            number, packed = [], []
            for which, at in deal(bucket):
                if which >= 0:
                    at = at[np.lexsort((first[at], ident[at]))]  # neighbours pack well
                    number.append(which)
                    packed.append(pack(
                        anchor=anchor[at], content=content[at], id=ident[at], hash=mark[at],
                        first=first[at].astype(np.int32), more=(last - first)[at].astype(np.int32),
                        heavy=common_one[at], witness=witness.take(pa.array(at)),
                        **{c: v[at] for c, v in more_of.items()}))
            yield pa.RecordBatch.from_arrays([pa.array(number, pa.int64()), pa.array(packed, pa.binary())],
                                             names=["bucket", "packed"])

    return keyed(docs).select(ID, HASH, F.col("text").cast("string").cast("binary").alias("text")).mapInArrow(
        scan, "bucket long, packed binary")


def common_anchors(docs: DataFrame, elements, window: int, gram: int) -> list[int]:
    """Anchors that take a large part of the regions in a sample; the list only spreads work."""
    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [x[0] for text in batch.column("text") if text.is_valid
                     for x in regions(elements(text.as_py()), window, gram)]
            if found:
                anchor, n = np.unique(np.concatenate(found) >> np.uint64(16), return_counts=True)
                yield pa.RecordBatch.from_arrays([pa.array(anchor.view(np.int64)), pa.array(n)], names=["anchor", "n"])

    some = docs.where(F.pmod(F.xxhash64("text"), F.lit(SAMPLE)) == 0)
    counts = some.select(F.col("text").cast("string").cast("binary").alias("text")).mapInArrow(
        scan, "anchor long, n long").groupBy("anchor").agg(F.sum("n").alias("n"))
    return [r.anchor for r in counts.where("n >= 16").orderBy(F.desc("n"), "anchor").limit(COMMON).collect()]


def _column(table: pa.Table, name: str) -> np.ndarray:
    return table.column(name).to_numpy()


def _out(shards: int, known: bool, ident, mark, first, more, content, witness, **place) -> Iterator[tuple]:
    """Rows (known, shard, packed) of spans by the shard of their document; `place`: where the witness has the run."""
    for shard, at in deal(shard_of(ident, mark, shards)):
        yield known, shard, pack(id=ident[at], hash=mark[at], first=first[at], more=more[at], content=content[at],
                                 witness=witness[at], **{c: v[at] for c, v in place.items()})


def _place(mark: np.ndarray, first: np.ndarray, lead: np.ndarray, at: np.ndarray, places: bool) -> dict[str, np.ndarray]:
    return {"w_hash": mark[lead][at], "w_first": first[lead][at]} if places else {}


SPANS = "known boolean, shard long, packed binary"


def _spans(rows: list[tuple]) -> pa.Table:
    return pa.table({"known": pa.array([r[0] for r in rows], pa.bool_()),
                     "shard": pa.array([r[1] for r in rows], pa.int64()),
                     "packed": pa.array([r[2] for r in rows], pa.binary())})


def _compare(mined: DataFrame, within: bool, shards: int, places: bool) -> DataFrame:
    """Repeated regions (known) and regions whose windows must be compared."""
    def judge(table: pa.Table) -> pa.Table:
        rows = unpack(table.column("packed").to_pylist())
        anchor, content, ident, mark, first, more, heavy = (
            _column(rows, c) for c in ("anchor", "content", "id", "hash", "first", "more", "heavy"))
        witness = rows.column("witness")
        sure = np.asarray(witness.is_valid())
        out = list(_out(shards, True, ident[sure], mark[sure], first[sure], more[sure], content[sure],
                        witness.drop_null().to_numpy(),
                        **({c: _column(rows, c)[sure] for c in ("w_hash", "w_first")} if places else {})))
        at = np.flatnonzero(~sure)
        at = at[np.lexsort((first[at], mark[at], ident[at], content[at], anchor[at]))]
        anchor, content, ident, mark, first, more, heavy = (
            x[at] for x in (anchor, content, ident, mark, first, more, heavy))
        n = len(at)
        if n:
            group = np.concatenate(([True], anchor[1:] != anchor[:-1]))
            new = group | np.concatenate(([True], content[1:] != content[:-1]))
            lead = np.maximum.accumulate(np.where(new, np.arange(n), 0))
            twice = np.concatenate(([False], ~new[1:] & (ident[1:] == ident[:-1]) & (mark[1:] == mark[:-1])
                                    & (first[1:] == first[:-1])))
            again = (~new if within else ident > ident[lead]) & ~twice
            of = np.cumsum(group) - 1
            several = np.bincount(of, new)[of] > 1
            compare = ~again & ~twice & (heavy | several)
            out += _out(shards, True, *(x[again] for x in (ident, mark, first, more, content, ident[lead])),
                        **_place(mark, first, lead, again, places))
            out += _out(shards, False, *(x[compare] for x in (ident, mark, first, more, content, ident)))
        return _spans(out)

    return mined.groupBy("bucket").applyInArrow(judge, SPANS)


def _windows(texts: DataFrame, spans: DataFrame, elements, window: int, within: bool, shards: int,
             buckets: int, places: bool) -> DataFrame:
    """Windows of the given regions that occur earlier.

    Every shard names each window once, by its first place; a window's other places in the shard
    are later ones of it. The named ones meet by their content.
    """
    def cut(texts: pa.Table, spans: pa.Table) -> pa.Table:
        parts, found = [], unpack(spans.column("packed").to_pylist())
        if found is not None and len(texts):
            ident, mark, first, more = (_column(found, c) for c in ("id", "hash", "first", "more"))
            order = np.lexsort((mark, ident))
            ident, mark, first, more = ident[order], mark[order], first[order], more[order]
            edges = np.flatnonzero(np.concatenate(([True], (np.diff(ident) != 0) | (np.diff(mark) != 0), [True])))
            wanted = {(ident[a], mark[a]): (first[a:b], more[a:b]) for a, b in zip(edges, edges[1:])}
            for value in texts.column("packed"):
                rows = unpack([value.as_py()])
                for doc, sum_, text in zip(_column(rows, "id"), _column(rows, "hash"), rows.column("text")):
                    if (doc, sum_) not in wanted:
                        continue
                    values = elements(text.as_py())
                    begin, longer = wanted.pop((doc, sum_))  # a repeated row is looked at once
                    for a, b in zip(*runs(covered(len(values) - window + 1, begin, begin + longer + 1))):
                        for at in range(a, b, PIECE):
                            stop = min(b, at + PIECE)
                            whole = grams(values[at:stop + window - 1], window)[0]
                            parts.append((whole, np.full(len(whole), doc), np.full(len(whole), sum_),
                                          np.arange(at, stop, dtype=np.int32)))
        rows = []
        if parts:
            whole, ident, mark, place = (np.concatenate(x) for x in zip(*parts))
            order = np.lexsort((place, mark, ident, whole))
            whole, ident, mark, place = whole[order].view(np.int64), ident[order], mark[order], place[order]
            new = np.concatenate(([True], whole[1:] != whole[:-1]))
            lead = np.maximum.accumulate(np.where(new, np.arange(len(new)), 0))
            again = ~new if within else ident > ident[lead]
            rows += [(shard, None, packed) for _, shard, packed in _out(
                shards, True, *(x[again] for x in (ident, mark, place, np.zeros(len(place), np.int32), whole, ident[lead])),
                **_place(mark, place, lead, again, places))]
            whole, ident, mark, place = (x[~again] for x in (whole, ident, mark, place))
            for bucket, at in deal((mixed(whole.view(np.uint64)) % np.uint64(buckets)).astype(np.int64)):
                at = at[np.lexsort((place[at], mark[at], ident[at]))]
                rows.append((None, bucket, pack(whole=whole[at], id=ident[at], hash=mark[at], place=place[at])))
        return pa.table({"shard": pa.array([r[0] for r in rows], pa.int64()),
                         "bucket": pa.array([r[1] for r in rows], pa.int64()),
                         "packed": pa.array([r[2] for r in rows], pa.binary())})

    def judge(table: pa.Table) -> pa.Table:
        rows = unpack(table.column("packed").to_pylist())
        whole, ident, mark, place = (_column(rows, c) for c in ("whole", "id", "hash", "place"))
        order = np.lexsort((place, mark, ident, whole))
        whole, ident, mark, place = (x[order] for x in (whole, ident, mark, place))
        new = np.concatenate(([True], whole[1:] != whole[:-1]))
        lead = np.maximum.accumulate(np.where(new, np.arange(len(new)), 0))
        again = ~new if within else ident > ident[lead]
        return _spans(list(_out(shards, True, *(x[again] for x in (
            ident, mark, place, np.zeros(len(place), np.int32), whole, ident[lead])),
            **_place(mark, place, lead, again, places))))

    named = stored(texts.groupBy("shard").cogroup(spans.groupBy("shard")).applyInArrow(
        cut, "shard long, bucket long, packed binary"), "windows")
    met = named.where("bucket is not null").select("bucket", "packed").groupBy("bucket").applyInArrow(judge, SPANS)
    return met.select("shard", "packed").unionByName(named.where("bucket is null").select("shard", "packed"))


def repeats(docs: DataFrame, elements: Callable[[bytes], np.ndarray], window: int, gram: int,
            within: bool, places: bool = False) -> tuple[DataFrame, DataFrame, int]:
    """(texts, spans, shards): documents and their runs of windows that occur earlier, both (shard, packed).

    Packed spans have the columns id, hash, first, more (the run's windows after the first),
    content (equal for equal runs) and witness, a document with the run. Earlier means in a
    document with a smaller id, or with `within` before in the order of id, text hash and place.
    With `places` there are also w_hash and w_first: the witness's text hash and where it has the run.
    """
    size = text_bytes(docs)
    shards, buckets = max(1, -(-size // SHARD_BYTES)), max(1, -(-size // BUCKET_BYTES))
    texts = sharded_texts(docs, shards)
    common = common_anchors(docs, elements, window, gram)
    found = stored(_compare(_mine(docs, elements, window, gram, common, within, buckets, places), within, shards, places), "regions")
    open_ = found.where("not known").select("shard", "packed")
    later = _windows(texts, open_, elements, window, within, shards, buckets, places)
    return texts, found.where("known").select("shard", "packed").unionByName(later), shards
