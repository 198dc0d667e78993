"""Repair of conversation structure by depth-first branch and bound over edits.

A repaired conversation's role initials are `(s?(ua)+)?`. Edits of a row are K (keep, 0), R (change
the role to user or assistant, 1) and D (delete, 2; blank and duplicate rows must go); I inserts an
empty user or assistant turn (5). A truncated row that stays costs 5 more. Wanted is the cheapest
list of edits, of equally cheap ones the first by character.

Conversations of up to LONG rows are searched whole. Longer ones are cut into blocks of BLOCK rows,
each searched from every state of the grammar to every other; chaining the blocks' results gives the
same answer, so no conversation has to fit into one search.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from riverglass.llm.common import stored

LONG = 2000  # rows of a conversation that are searched as one
LONG_BYTES = 32 << 20  # and their texts' bytes
BLOCK = 500

START, SYSTEM, USER, ASSISTANT = range(4)  # what the last turn was
STATES = (START, SYSTEM, USER, ASSISTANT)
ENDS = (START, ASSISTANT)
# The state after a turn with this initial; missing where the grammar allows none.
AFTER = {"s": {START: SYSTEM}, "u": {START: USER, SYSTEM: USER, ASSISTANT: USER}, "a": {USER: ASSISTANT}}
# The state after an inserted or re-roled turn: a user wherever one may come, else an assistant.
GIVEN = {START: USER, SYSTEM: USER, USER: ASSISTANT, ASSISTANT: USER}
ROLE = {USER: "user", ASSISTANT: "assistant"}
LEGAL = {"su", "ua", "au"}
REROLE, DELETE, INSERT, UNMENDED = 1, 2, 5, 5
NEVER = 1 << 60

SPACES = " \t\n\x0b\x0c\r"
GOOD, TRUNCATED, BLANK, DUPLICATE = range(4)


def damaged(rows: DataFrame) -> DataFrame:
    """`rows` (conv_id, turn, role, text) with planted faults, and `gone` for rows that were dropped.

    The remainder by 20 of the checksum of `conv_id:turn` decides: 0 drops the row, 1 empties its text, 2
    takes out its marks `.!?`, 3 repeats it, 4 makes it the user's. A null is taken as one blank, in the
    checksum too; ids and turns stay null beside it.
    """
    blank = F.lit(" ")
    part = F.crc32(F.concat_ws(":", F.coalesce(F.col("conv_id").cast("string"), blank),
                               F.coalesce(F.col("turn").cast("string"), blank)).cast("binary")) % 20
    given = rows.select("conv_id", "turn", F.coalesce(F.col("role").cast("string"), blank).alias("role"),
                        F.coalesce(F.col("text").cast("string"), blank).alias("text"), part.alias("__rg_part"))
    text = F.when(F.col("__rg_part") == 1, "").when(
        F.col("__rg_part") == 2, F.translate("text", ".!?", "")).otherwise(F.col("text"))
    times = F.when(F.col("__rg_part") == 3, F.array(F.lit(1), F.lit(2))).otherwise(F.array(F.lit(1)))
    return given.select(
        "conv_id", "turn", F.when(F.col("__rg_part") == 4, "user").otherwise(F.col("role")).alias("role"),
        text.alias("text"), (F.col("__rg_part") == 0).alias("gone"),
        F.explode(times).alias("__rg_time")).drop("__rg_time")


def fault(role: str, text: str, seen: set) -> int:
    """The row's first fault; `seen` holds the role and text of earlier rows."""
    mark = hashlib.blake2b(f"{role}\x00{text}".encode("utf-8", "surrogatepass"), digest_size=16).digest()
    again = mark in seen
    seen.add(mark)
    return plain_fault(text, again)


def plain_fault(text: str, again: bool) -> int:
    solid = text.rstrip(SPACES)
    if not solid:
        return BLANK
    if again:
        return DUPLICATE
    return GOOD if solid[-1] in ".!?" else TRUNCATED


def bounds(rows: Sequence[tuple[str, int]], ends: Sequence[int]) -> list[list[int]]:
    """For every place and state the least cost of the rows that are left: no completion is cheaper."""
    def insert(costs: list[int]) -> list[int]:
        for _ in STATES:
            costs = [min(c, INSERT + costs[GIVEN[q]]) for q, c in zip(STATES, costs)]
        return costs

    table = [insert([0 if q in ends else NEVER for q in STATES])]
    for initial, state in reversed(rows):
        after, costs = table[-1], []
        for q in STATES:
            least = DELETE + after[q]
            if state < BLANK:
                extra = UNMENDED if state == TRUNCATED else 0
                least = min(least, REROLE + extra + after[GIVEN[q]])
                if q in AFTER.get(initial, ()):
                    least = min(least, extra + after[AFTER[initial][q]])
            costs.append(least)
        table.append(insert(costs))
    return table[::-1]


def search(rows: Sequence[tuple[str, int]], begin: int = START,
           ends: Sequence[int] = ENDS) -> tuple[int, bytes] | None:
    """(cost, audit) of the best edits of `rows` (initial, fault) from state `begin` to one of `ends`.

    Depth first with an explicit stack. A prefix is cut if its cost and the bound of what is left
    exceed the incumbent's cost, if it could at best tie with it but is already behind by character, or
    if the same place and state were reached by a prefix at least as good (prefixes of equal cost at one
    place are never each other's beginning, as the longer one has more insertions). The incumbent is
    proved when the stack is empty.
    """
    least, n = bounds(rows, ends), len(rows)
    best = (DELETE * n, b"D" * n) if begin in ends else None
    reached: list[dict[int, tuple[int, bytes]]] = [{} for _ in range(n + 1)]
    path, stack = bytearray(), [(0, b"", 0, begin, 0)]
    while stack:
        depth, letter, at, state, cost = stack.pop()
        del path[depth:]
        path += letter
        if best is not None:
            ahead = cost + least[at][state] - best[0]
            if ahead > 0 or ahead == 0 and path > best[1][:len(path)]:
                continue
        prefix = bytes(path)
        known = reached[at].get(state)
        if known is not None and known <= (cost, prefix):
            continue
        reached[at][state] = cost, prefix
        if at == n and state in ends and (best is None or (cost, prefix) < best):
            best = cost, prefix
        branches = [(b"I", at, GIVEN[state], cost + INSERT)]
        if at < n:
            initial, what = rows[at]
            branches.append((b"D", at + 1, state, cost + DELETE))
            if what < BLANK:
                extra = UNMENDED if what == TRUNCATED else 0
                branches.append((b"R", at + 1, GIVEN[state], cost + REROLE + extra))
                if state in AFTER.get(initial, ()):
                    branches.append((b"K", at + 1, AFTER[initial][state], cost + extra))
        limit = NEVER if best is None else best[0]
        open_ = [b for b in branches if b[3] + least[b[1]][b[2]] <= min(limit, NEVER - 1)]
        # The most promising branch is taken first, of equal ones the smallest letter.
        open_.sort(key=lambda b: (b[3] + least[b[1]][b[2]], b[0]), reverse=True)
        stack += [(len(prefix), *b) for b in open_]
    return best


def mended(rows: Sequence[tuple[str, str]], audit: bytes, state: int = START) -> Iterator[tuple[str, str]]:
    """The turns that the edits leave of `rows` (role, text), from a state on."""
    left = iter(rows)
    for letter in audit.decode():
        if letter == "I":
            state = GIVEN[state]
            yield ROLE[state], ""
            continue
        role, text = next(left)
        if letter == "R":
            state = GIVEN[state]
            yield ROLE[state], text
        elif letter == "K":
            state = AFTER[role[:1]][state]
            yield role, text


COLUMNS = ("gaps long, blank long, duplicate long, truncated long, illegal long, cost long, audit string, "
           "repaired_sha256 string")
_FIELDS = [("gaps", pa.int64()), ("blank", pa.int64()), ("duplicate", pa.int64()), ("truncated", pa.int64()),
           ("illegal", pa.int64()), ("cost", pa.int64()), ("audit", pa.string()), ("repaired_sha256", pa.string())]


@dataclass
class Report:
    """What is known of one conversation while its rows come in, in order."""
    conv: int | None

    def __post_init__(self):
        self.rows, self.seen, self.turns, self.illegal, self.last = [], set(), set(), 0, None

    def add(self, turn: int | None, role: str, text: str) -> None:
        initial = role[:1]
        if self.last is not None and self.last + initial not in LEGAL:
            self.illegal += 1
        self.last = initial
        if turn is not None:
            self.turns.add(turn)
        self.rows.append((role, text, fault(role, text, self.seen)))

    def result(self) -> tuple:
        cost, audit = search([(r[:1], f) for r, _, f in self.rows])
        text = "\n".join(f"{r}:{t}" for r, t in mended([x[:2] for x in self.rows], audit))
        faults = [f for _, _, f in self.rows]
        gaps = max(self.turns) - min(self.turns) + 1 - len(self.turns) if self.turns else 0
        return (self.conv, gaps, faults.count(BLANK), faults.count(DUPLICATE), faults.count(TRUNCATED), self.illegal,
                cost, audit.decode(), hashlib.sha256(text.encode("utf-8", "surrogatepass")).hexdigest())


def _tuples(batch: pa.RecordBatch) -> Iterator[tuple]:
    return zip(*(batch.column(c).to_pylist() for c in batch.schema.names))


def _whole(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Conversations whose rows come one after the other."""
    now, out = None, []

    def flush() -> pa.RecordBatch:
        names = [("conv_id", pa.int64()), *_FIELDS]
        batch = pa.RecordBatch.from_arrays([pa.array([r[i] for r in out], k) for i, (_, k) in enumerate(names)],
                                           names=[n for n, _ in names])
        out.clear()
        return batch

    for batch in batches:
        for conv, turn, role, text, gone in _tuples(batch):
            if now is None or now.conv != conv:
                if now is not None:
                    out.append(now.result())
                now = Report(conv)
            if not gone:
                now.add(turn, role, text)
        if len(out) >= 1000:
            yield flush()
    if now is not None:
        out.append(now.result())
    yield flush()


def _ordered() -> list[Column]:
    """Rows of one turn come by role, then by a hash of their text, then by the text."""
    return [F.asc_nulls_first("conv_id"), F.asc_nulls_first("turn"), F.asc("role"), F.asc("__rg_mark")]


def _short(rows: DataFrame) -> DataFrame:
    return rows.repartition("conv_id").sortWithinPartitions(*_ordered(), "text").select(
        "conv_id", "turn", "role", "text", "gone").mapInArrow(_whole, f"conv_id long, {COLUMNS}")


BLOCK_RESULT = ("conv_id long, block long, first string, last string, illegal long, low long, high long, turns long, "
                "blank long, duplicate long, truncated long, ways array<struct<begin: int, end: int, cost: long, audit: string>>")


def _block(table: pa.Table) -> pa.Table:
    """One block of a long conversation: its counts, and the best edits between any two states."""
    rows = sorted(zip(*(table.column(c).to_pylist() for c in ("at", "turn", "role", "text", "again"))))
    faults = [plain_fault(text, again) for _, _, _, text, again in rows]
    initials = [role[:1] for _, _, role, _, _ in rows]
    turns = {turn for _, turn, _, _, _ in rows if turn is not None}
    ways = [{"begin": a, "end": b, "cost": w[0], "audit": w[1].decode()} for a in STATES for b in STATES
            if (w := search(list(zip(initials, faults)), a, (b,))) is not None]
    row = {"conv_id": table.column("conv_id")[0].as_py(), "block": table.column("block")[0].as_py(),
           "first": initials[0], "last": initials[-1],
           "illegal": sum(a + b not in LEGAL for a, b in zip(initials, initials[1:])),
           "low": min(turns, default=None), "high": max(turns, default=None), "turns": len(turns),
           "blank": faults.count(BLANK), "duplicate": faults.count(DUPLICATE), "truncated": faults.count(TRUNCATED),
           "ways": ways}
    way = pa.struct([("begin", pa.int32()), ("end", pa.int32()), ("cost", pa.int64()), ("audit", pa.string())])
    kinds = [("conv_id", pa.int64()), ("block", pa.int64()), ("first", pa.string()), ("last", pa.string()),
             *((c, pa.int64()) for c in ("illegal", "low", "high", "turns", "blank", "duplicate", "truncated")),
             ("ways", pa.list_(way))]
    return pa.Table.from_arrays([pa.array([row[n]], k) for n, k in kinds], names=[n for n, _ in kinds])


CHAINED = ("conv_id long, gaps long, blank long, duplicate long, truncated long, illegal long, cost long, audit string, "
           "parts array<struct<block: long, begin: int, audit: string>>")


def _chain(table: pa.Table) -> pa.Table:
    """The blocks of a conversation in order: the best way through all of them."""
    blocks = sorted(table.to_pylist(), key=lambda b: b["block"])
    ways = {START: (0, "", ())}  # state: cost, audit, (block, begin, audit) so far
    total = dict.fromkeys(("blank", "duplicate", "truncated", "illegal"), 0)
    turns, low, high, last = 0, None, None, None
    for b in blocks:
        new: dict[int, tuple] = {}
        for w in b["ways"]:
            if w["begin"] in ways:
                cost, audit, parts = ways[w["begin"]]
                way = (cost + w["cost"], audit + w["audit"])
                if w["end"] not in new or way < new[w["end"]][:2]:
                    new[w["end"]] = *way, (parts, (b["block"], w["begin"], w["audit"]))
        ways = new
        for c in total:
            total[c] += b[c]
        total["illegal"] += last is not None and last + b["first"] not in LEGAL
        last = b["last"]
        if b["turns"]:  # blocks are in the order of turns, so only the edge can be shared
            turns += b["turns"] - (high == b["low"])
            low, high = (b["low"] if low is None else low), b["high"]
    cost, audit, chain = min(ways[q] for q in ENDS if q in ways)
    parts = []
    while chain:
        chain, part = chain
        parts.append(dict(zip(("block", "begin", "audit"), part)))
    gaps = high - low + 1 - turns if turns else 0
    part = pa.struct([("block", pa.int64()), ("begin", pa.int32()), ("audit", pa.string())])
    values = [("conv_id", pa.int64(), blocks[0]["conv_id"]), ("gaps", pa.int64(), gaps),
              *((c, pa.int64(), total[c]) for c in total), ("cost", pa.int64(), cost), ("audit", pa.string(), audit),
              ("parts", pa.list_(part), parts[::-1])]
    return pa.Table.from_arrays([pa.array([v], k) for _, k, v in values], names=[n for n, _, _ in values])


def _apply(rows: pa.Table, part: pa.Table) -> pa.Table:
    """The repaired text of one block."""
    if not len(part) or not len(rows):
        return pa.table({"conv_id": pa.array([], pa.int64()), "block": pa.array([], pa.int64()), "piece": pa.array([], pa.binary())})
    ordered = sorted(zip(*(rows.column(c).to_pylist() for c in ("at", "role", "text"))))
    turns = mended([x[1:] for x in ordered], part.column("audit")[0].as_py().encode(), part.column("begin")[0].as_py())
    piece = "".join(f"\n{r}:{t}" for r, t in turns).encode("utf-8", "surrogatepass")
    return pa.table({"conv_id": part.column("conv_id"), "block": part.column("block"), "piece": pa.array([piece], pa.binary())})


def _digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Digests of conversations whose pieces come one after the other, a piece at a time in memory."""
    out, now, begun, digest = [], None, False, hashlib.sha256()
    for batch in batches:
        for conv, piece in _tuples(batch):
            if not begun or conv != now:
                if begun:
                    out.append((now, digest.hexdigest()))
                now, begun, digest, empty = conv, True, hashlib.sha256(), True
            digest.update(piece[1:] if empty else piece)  # no newline ahead of the first turn
            empty = empty and not piece
    if begun:
        out.append((now, digest.hexdigest()))
    yield pa.RecordBatch.from_arrays([pa.array([r[0] for r in out], pa.int64()), pa.array([r[1] for r in out], pa.string())],
                                     names=["conv_id", "repaired_sha256"])


def _long(rows: DataFrame) -> DataFrame:
    """Conversations of any length, by blocks."""
    same = lambda a, b: F.col(f"{a}.conv_id").eqNullSafe(F.col(f"{b}.conv_id"))
    placed = stored(rows.withColumn("__rg_tie", F.monotonically_increasing_id()).repartitionByRange(
        *_ordered(), "__rg_tie").sortWithinPartitions(*_ordered(), "text", "__rg_tie").select(
        "conv_id", F.monotonically_increasing_id().alias("at"), F.col("turn").cast("long").alias("turn"), "role", "text",
        F.sha2(F.concat_ws("\0", "role", "text"), 256).alias("mark")), "conversation-rows")
    first = placed.groupBy("conv_id", "mark").agg(F.min("at").alias("first"))
    marked = placed.alias("x").join(first.alias("y"), same("x", "y") & (F.col("x.mark") == F.col("y.mark"))).select(
        "x.conv_id", "at", "turn", "role", "text", (F.col("at") > F.col("first")).alias("again"),
        (F.shiftright("at", 33) * F.lit(1 << 33) + F.floor(F.col("at").bitwiseAND(F.lit((1 << 33) - 1)) / BLOCK)).alias("block"))
    blocks = stored(marked.groupBy("conv_id", "block").applyInArrow(_block, BLOCK_RESULT), "conversation-blocks")
    chains = stored(blocks.groupBy("conv_id").applyInArrow(_chain, CHAINED), "conversation-chains")
    parts = chains.select("conv_id", F.inline("parts"))
    pieces = marked.groupBy("conv_id", "block").cogroup(parts.groupBy("conv_id", "block")).applyInArrow(
        _apply, "conv_id long, block long, piece binary")
    digests = pieces.repartition("conv_id").sortWithinPartitions("conv_id", "block").select("conv_id", "piece").mapInArrow(
        _digest, "conv_id long, repaired_sha256 string")
    names = [c.split()[0] for c in COLUMNS.split(", ")]
    return chains.alias("x").join(digests.alias("y"), same("x", "y")).select("x.conv_id", *names)


def repair(rows: DataFrame) -> DataFrame:
    """One row per conv_id of `rows` (conv_id, turn, role, text, gone): its faults and its cheapest repair.

    Rows count in the order of turn (nulls first), those of one turn by role and then by a hash of the text, so
    repeated rows stand beside each other. Rows marked `gone` only say that the conversation is there: one
    with no others has zeros, an empty audit and the digest of an empty string. A null conv_id is a
    conversation of its own. An empty role, or one that begins with another letter than s, u or a, fits
    nowhere and has to be changed or deleted. Null texts count as one blank. An empty table gives no rows.
    Texts of any length are looked at whole; the text of a conversation is never in one task's memory
    beyond LONG_BYTES, only its digest is taken in order, as a digest must be. `rows` should be a scan or
    a stored table, so that a repeated task sees them in the same order. Other columns are not read.
    """
    rows = rows.select(F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"),
                       F.coalesce("role", F.lit(" ")).alias("role"), F.coalesce("text", F.lit(" ")).alias("text"),
                       "gone").withColumn("__rg_mark", F.xxhash64("text"))
    long_ones = stored(rows.where(~F.col("gone")).groupBy("conv_id").agg(
        F.count("*").alias("n"), F.sum(F.octet_length("text")).alias("size")).where(
        (F.col("n") > LONG) | (F.col("size") > LONG_BYTES)).select("conv_id"), "long-conversations")
    if long_ones.isEmpty():
        return _short(rows)
    same = F.col("x.conv_id").eqNullSafe(F.col("y.conv_id"))
    split = lambda how: rows.alias("x").join(long_ones.alias("y"), same, how)
    return _short(split("left_anti")).unionByName(_long(split("left_semi").where("not gone").drop("gone")))


def repair_report(conversations: DataFrame) -> DataFrame:
    """`conversations` damaged by rule, then repaired: one row per conversation, see `damaged` and `repair`."""
    return repair(damaged(conversations))
