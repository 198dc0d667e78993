"""Substring dedup: recurring passages located with sharded Aho-Corasick automata over words.

1. Passages that recur are confirmed on all documents (`repeats`), each with a document of a smaller id that has it.
2. The passage's words are read from that document and dealt to the shards of documents in which it is
   expected, each passage once per shard.
3. A shard compiles its passages into automata and streams its documents through them. What the automata
   find, and nothing else, decides which words go, so a passage whose words are not really there removes nothing.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import ahocorasick
import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, functions as F

from riverglass.llm.common import HASH, ID, Once, covered, deal, pack, real_id, shard_of, unpack, word_blocks
from riverglass.llm.repeats import repeats

WINDOW, GRAM = 50, 12
AUTOMATON_WORDS = 1_000_000  # words of the passages in one automaton, so no more different ones than characters


def word_hashes(data: bytes) -> np.ndarray:
    parts = []
    for words in word_blocks(data):
        of = {w: xxhash.xxh64_intdigest(w) for w in set(words)}
        parts.append(np.fromiter(map(of.__getitem__, words), np.uint64, len(words)))
    return np.concatenate(parts) if parts else np.zeros(0, np.uint64)


class Codes(dict):
    """Words as characters; words of no passage are all the same one."""

    def __missing__(self, word: bytes) -> str:
        return "\0"

    def number(self, words: list[bytes]) -> str:
        for w in words:
            if w not in self:
                self[w] = chr(0x10000 + len(self))
        return "".join([self[w] for w in words])

    def read(self, words: list[bytes]) -> str:
        return "".join([self[w] for w in words])


def automata(passages: dict[tuple[bytes, ...], int]) -> Iterator[tuple[Codes, ahocorasick.Automaton]]:
    """Automata of passages, as many as their words need, that give a passage's length and its smallest id."""
    codes, automaton, size = Codes(), ahocorasick.Automaton(), 0
    for words, witness in passages.items():
        if size and size + len(words) > AUTOMATON_WORDS:
            automaton.make_automaton()
            yield codes, automaton
            codes, automaton, size = Codes(), ahocorasick.Automaton(), 0
        automaton.add_word(codes.number(words), (len(words), witness))
        size += len(words)
    if size:
        automaton.make_automaton()
        yield codes, automaton


def located(documents: list[tuple[int, list[bytes]]], passages: dict[tuple[bytes, ...], int]) -> list[np.ndarray]:
    """For each (id, words) which words lie in a passage that a smaller id has."""
    found: list[tuple[list, list]] = [([], []) for _ in documents]
    for codes, automaton in automata(passages):
        for (ident, words), (starts, ends) in zip(documents, found):
            for end, (length, witness) in automaton.iter(codes.read(words)):
                if witness < ident:
                    starts.append(end + 1 - length)
                    ends.append(end + 1)
    return [covered(len(words), np.array(s, np.int64), np.array(e, np.int64)) for (_, words), (s, e) in zip(documents, found)]


def _joined(spans: pa.Table) -> dict[str, np.ndarray]:
    """Spans that go on in one another, in the document and in its witness alike, as one."""
    names = ("id", "hash", "witness", "w_hash", "first", "w_first", "more")
    ident, mark, wid, wmark, first, wfirst, more = (spans.column(c).to_numpy().astype(np.int64) for c in names)
    order = np.lexsort((first, first - wfirst, wmark, wid, mark, ident))
    ident, mark, wid, wmark, first, wfirst, more = (x[order] for x in (ident, mark, wid, wmark, first, wfirst, more))
    line = first - wfirst
    same = (ident[1:] == ident[:-1]) & (mark[1:] == mark[:-1]) & (wid[1:] == wid[:-1]) & (wmark[1:] == wmark[:-1]) & (line[1:] == line[:-1])
    new = np.concatenate(([True], ~same))
    group = np.cumsum(new) - 1
    # Within a group, a run ends where the next begins after all that came before it has ended.
    base = group * (int((first + more).max()) + 2)
    reach = np.maximum.accumulate(base + first + more)
    new[1:] |= (base + first)[1:] > reach[:-1] + 1
    lead = np.flatnonzero(new)
    last = np.maximum.reduceat(first + more, lead)
    return {"witness": wid[lead], "w_hash": wmark[lead], "w_first": wfirst[lead], "more": last - first[lead]}


def _requests(spans: DataFrame, shards: int) -> DataFrame:
    """(shard, packed): the passages that each shard wants, by the shard of the document to read them from."""
    def ask(table: pa.Table) -> pa.Table:
        wanted = _joined(unpack(table.column("packed").to_pylist()))
        target = table.column("shard")[0].as_py()
        one = np.unique(np.stack([wanted["witness"], wanted["w_hash"], wanted["w_first"], wanted["more"]]), axis=1)
        rows = [(shard, pack(id=one[0][at], hash=one[1][at], first=one[2][at], more=one[3][at],
                             target=np.full(len(at), target))) for shard, at in deal(shard_of(one[0], one[1], shards))]
        return pa.table({"shard": pa.array([r[0] for r in rows], pa.int64()), "packed": pa.array([r[1] for r in rows], pa.binary())})

    return spans.groupBy("shard").applyInArrow(ask, "shard long, packed binary")


def _passages(texts: DataFrame, requests: DataFrame, window: int) -> DataFrame:
    """(shard, packed): words of passages, joined by blanks, and the id that has them, by the shard that wants them."""
    def cut(texts: pa.Table, requests: pa.Table) -> pa.Table:
        asked = unpack(requests.column("packed").to_pylist())
        rows: list[tuple] = []
        if asked is not None:
            places: dict[tuple, list] = {}
            for ident, mark, *where in zip(*(asked.column(c).to_pylist() for c in ("id", "hash", "first", "more", "target"))):
                places.setdefault((ident, mark), []).append(where)
            for value in texts.column("packed"):
                given = unpack([value.as_py()])
                for ident, mark, text in zip(given.column("id").to_pylist(), given.column("hash").to_pylist(), given.column("text")):
                    for first, more, target in places.pop((ident, mark), ()):  # of rows that repeat, one is read
                        if not rows or rows[-1][:2] != (ident, mark):
                            words = [w for block in word_blocks(text.as_py()) for w in block]
                        rows.append((ident, mark, target, b" ".join(words[first:first + more + window])))
        target = np.array([r[2] for r in rows], np.int64)
        out = []
        for shard, at in deal(target):
            out.append((shard, pack(witness=np.array([rows[i][0] for i in at], np.int64),
                                    words=pa.array([rows[i][3] for i in at], pa.large_binary()))))
        return pa.table({"shard": pa.array([r[0] for r in out], pa.int64()), "packed": pa.array([r[1] for r in out], pa.binary())})

    return texts.groupBy("shard").cogroup(requests.groupBy("shard")).applyInArrow(cut, "shard long, packed binary")


REPORT = f"{ID} long, {HASH} long, n_words long, n_removed long, kept_sha256 string"


def _locate(texts: pa.Table, passages: pa.Table) -> pa.Table:
    """Stream a shard's documents through the automata of its passages, one packed part at a time."""
    wanted: dict[tuple[bytes, ...], int] = {}
    found = unpack(passages.column("packed").to_pylist())
    if found is not None:
        for witness, words in zip(found.column("witness").to_pylist(), found.column("words").to_pylist()):
            key = tuple(words.split(b" "))
            wanted[key] = min(witness, wanted.get(key, witness))
    given = unpack(texts.column("packed").to_pylist())
    ids, marks = (given.column(c).to_pylist() if given else [] for c in ("id", "hash"))
    documents = [[w for block in word_blocks(t or b"") for w in block] for t in given.column("text").to_pylist()] if given else []
    gone = located(list(zip(ids, documents)), wanted)
    kept = [hashlib.sha256(b" ".join(words) if not mask.any() else b" ".join([words[i] for i in np.flatnonzero(~mask)])).hexdigest()
            for words, mask in zip(documents, gone)]
    return pa.table({ID: pa.array(ids, pa.int64()), HASH: pa.array(marks, pa.int64()),
                     "n_words": pa.array([len(w) for w in documents], pa.int64()),
                     "n_removed": pa.array([int(g.sum()) for g in gone], pa.int64()), "kept_sha256": pa.array(kept, pa.string())})


def removal_report(docs: DataFrame, window: int = WINDOW, gram: int = GRAM) -> DataFrame:
    """Per row of `docs`: doc_id, n_words, n_removed and kept_sha256 of the kept words joined by blanks.

    A word goes if a sequence of `window` words that covers it also starts in a document with a smaller id
    (null is the smallest). Null and empty texts have no words. Rows that repeat id and text are looked at once and
    get the same result each; different texts of one id never remove each other's words. An empty table gives no
    rows. A text is in memory as a whole, with the other documents of its shard (some megabytes); where it is longer
    than a shard it makes up one. Other columns, whatever their names, are not read.
    """
    rows = Once(docs.select("doc_id", F.col("text").cast("string").alias("text")))
    texts, spans, shards = repeats(rows.docs, word_hashes, window, gram, within=False, places=True)
    passages = _passages(texts, _requests(spans, shards), window)
    report = texts.groupBy("shard").cogroup(passages.groupBy("shard")).applyInArrow(_locate, REPORT)
    return rows.restored(report).select(real_id().alias("doc_id"), "n_words", "n_removed", "kept_sha256")
