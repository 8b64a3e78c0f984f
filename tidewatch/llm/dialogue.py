"""Conversation structure repair by divide and conquer over four-state cost vectors (Hirschberg).

A conversation should have the role initials ``(s?(ua)+)?``.  Read from left to right that is a machine
of four states: nothing yet, behind the system turn, behind a user turn, behind an assistant turn; the
first and the last may end it.  Each row is Kept (cost 0, if its initial fits), Reroled to user or
assistant (2) or Deleted (3; required for blank and repeated rows), and empty turns may be Inserted
anywhere (2 each).  A truncated row that isn't deleted adds 1.  The repair is the cheapest sequence of
edits, and among these the one whose initials (K, R, D, I, in order) are least in ASCII.

A forward vector holds, for each state behind a row, the least cost and the rank of the least audit
that gets there; a backward vector holds the least cost from there to the end.  Both meet at the
middle row, the state with the least sum and, of these, the least audit is the crossing, and either
half is solved the same way.  No table over all rows is kept, only the two vectors.  Audits of one row
count that end with a row's edit are never prefixes of each other, so ranks decide as whole strings do.

On Spark, rows are sorted once by range over all executors (conversation, turn with nulls first, role,
text) and written, each with its place ``at``.  Rows of 65,536 consecutive places are a chunk.  Only
conversations that cross a chunk's end need more than their own chunk: their parts give 4 x 4 matrices of costs
and ranks, and a conversation's matrices, one for each of its chunks, are multiplied to find the states at
the ends.  Then every chunk is repaired by itself.  So a conversation with a third of all rows is
spread, and only ``digests`` streams it through one task in constant memory, since SHA-256 is sequential.

Nulls in role and text are one space (no role fits it, the text is blank); a null conversation is a
conversation; null turns come first and are left out of gaps.  An empty role fits nowhere and its
initial is empty.  Rows of one turn are in order of role and text (code points).  Equal rows are a
row and its duplicates.  Other columns are ignored; an empty table has no conversations.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from .common import written

NONE, SYSTEM, USER, ASSISTANT = range(4)
KEEP, REROLE, DELETE, INSERT = 0, 2, 3, 2
TRUNCATED = 1
INF = 1 << 60
#: What an inserted turn, or a reroled one, becomes behind each state, and the state behind it.
NEXT = (USER, USER, ASSISTANT, USER)
ROLE = {USER: "user", ASSISTANT: "assistant"}
#: Turns to insert at the end.
CLOSING = {NONE: "", SYSTEM: "II", USER: "I", ASSISTANT: ""}
#: Places of one chunk (a power of two).
CHUNK_BITS = 16
SPACES = " \t\n\x0b\x0c\r"
FAULTS = ("", "blank", "duplicate", "truncated")


def _moves(code: int) -> list[tuple[int, int, int, str]]:
    """(state before, state behind, cost, edits) that a row allows, edits in ASCII order for each state before.

    The code is 4 x initial (s, u, a, other) + fault.  One insertion before a kept or reroled row is
    all that can pay, and one before a deleted row is never least, as it may as well follow it."""
    initial, fault = (SYSTEM, USER, ASSISTANT, NONE)[code >> 2], FAULTS[code & 3]
    out = []
    for q in range(4):
        out.append((q, q, DELETE, "D"))
        if fault in ("blank", "duplicate"):
            continue
        worse = TRUNCATED if fault == "truncated" else 0
        between = NEXT[q]
        if initial == NEXT[between]:
            out.append((q, initial, INSERT + KEEP + worse, "IK"))
        out.append((q, NEXT[between], INSERT + REROLE + worse, "IR"))
        if initial == NEXT[q] or (q == NONE and initial == SYSTEM):
            out.append((q, initial, KEEP + worse, "K"))
        out.append((q, NEXT[q], REROLE + worse, "R"))
    return out


MOVES = [_moves(code) for code in range(16)]


def forward(codes: bytes, lo: int, hi: int, start: int) -> tuple[list[int], list[int]]:
    """Least costs from ``start`` over rows lo to hi, and the order of the least audits, by state."""
    cost, rank = [INF] * 4, [0] * 4
    cost[start] = 0
    for k in range(lo, hi):
        best: list = [None] * 4
        for q, s, c, edits in MOVES[codes[k]]:
            if cost[q] < INF:
                way = (cost[q] + c, rank[q], edits)
                if best[s] is None or way < best[s]:
                    best[s] = way
        order = sorted((way[1:], s) for s, way in enumerate(best) if way)
        cost = [way[0] if way else INF for way in best]
        rank = [0] * 4
        for r, (_, s) in enumerate(order):
            rank[s] = r
    return cost, rank


def backward(codes: bytes, lo: int, hi: int, end: int) -> list[int]:
    """Least costs from each state over rows lo to hi to ``end``."""
    cost = [INF] * 4
    cost[end] = 0
    for k in range(hi - 1, lo - 1, -1):
        before = [INF] * 4
        for q, s, c, _ in MOVES[codes[k]]:
            if cost[s] + c < before[q]:
                before[q] = cost[s] + c
        cost = before
    return cost


def crossing(codes: bytes, lo: int, hi: int, start: int, end: int, out: list[str]) -> None:
    """Appends the least edits of each row from lo to hi on the way from ``start`` to ``end``."""
    if hi - lo == 1:
        out.append(min((c, edits) for q, s, c, edits in MOVES[codes[lo]] if (q, s) == (start, end))[1])
        return
    mid = (lo + hi) // 2
    cost, rank = forward(codes, lo, mid, start)
    rest = backward(codes, mid, hi, end)
    _, _, state = min((cost[s] + rest[s], rank[s], s) for s in range(4) if cost[s] < INF and rest[s] < INF)
    crossing(codes, lo, mid, start, state, out)
    crossing(codes, mid, hi, state, end, out)


def last_state(cost: list[int], rank: list[int]) -> int:
    """The state behind the last row on the least way to a right end."""
    return min((cost[s] + INSERT * len(CLOSING[s]), rank[s], s) for s in range(4) if cost[s] < INF)[2]


def solve(codes: bytes, start: int = NONE, end: int | None = None) -> tuple[list[str], int]:
    """The edits of each row and the state behind the last one; without ``end`` the conversation ends here."""
    if not codes:
        return [], start if end is None else end
    if end is None:
        end = last_state(*forward(codes, 0, len(codes), start))
    out: list[str] = []
    crossing(codes, 0, len(codes), start, end, out)
    return out, end


_short = lru_cache(1 << 16)(solve)  # conversations of a few rows look alike


def _solved(codes: bytes, start: int, end: int | None) -> tuple[list[str], int]:
    return (_short if len(codes) <= 32 else solve)(codes, start, end)


def damaged(conversations: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """(conv, turn, role, text) behind the damage that the key ``conv:turn`` decides."""
    space = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    rows = conversations.select(F.col(conv).alias("conv"), F.col(turn).alias("turn"), space(role).alias("role"), space(text).alias("text"),
                                (F.crc32(F.concat(space(conv), F.lit(":"), space(turn)).cast("binary")) % 20).alias("fate"))
    rows = rows.where("fate != 0").select(
        "conv", "turn", F.when(F.col("fate") == 4, "user").otherwise(F.col("role")).alias("role"),
        F.when(F.col("fate") == 1, "").when(F.col("fate") == 2, F.translate("text", ".!?", "")).otherwise(F.col("text")).alias("text"),
        F.explode(F.when(F.col("fate") == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))).alias("copy"))
    return rows.drop("copy")


def ordered(rows: DataFrame) -> DataFrame:
    """``rows`` (conv, turn, role, text) written in order, with their place ``at``, the number of the
    role's initial, blank and truncated marks, and a digest of role and text.  Equal rows are dealt out
    by a number of their own, so any number of them is spread."""
    trimmed = F.rtrim(F.col("text"), F.lit(SPACES))
    rows = rows.withColumn("own", F.monotonically_increasing_id())
    by = ["conv", F.col("turn").asc_nulls_first(), "role", "text", "own"]
    rows = rows.repartitionByRange(*by).sortWithinPartitions(*by)
    initial = F.substring("role", 1, 1)
    return written(rows.select(
        "conv", "turn", "role", "text", F.monotonically_increasing_id().alias("at"),
        F.when(initial == "s", 0).when(initial == "u", 1).when(initial == "a", 2).otherwise(3).alias("initial"),
        (trimmed == "").alias("blank"), (~F.right(trimmed, F.lit(1)).isin(".", "!", "?")).alias("truncated"),
        F.md5(F.concat(F.length("role").cast("string"), F.lit(":"), "role", "text").cast("binary")).alias("digest")), "dialogue")


def faults(rows: DataFrame) -> DataFrame:
    """(conv, at, code) of each row of ``ordered``: a row whose role and text stand earlier in its conversation is a duplicate."""
    light = rows.select("conv", "at", "initial", "blank", "truncated", "digest")
    # the key is handed out as a new expression, so that both sides of the join are plain exchanges and a hot key is split
    once = (light.where("not blank").groupBy("conv", "digest").agg(F.min("at").alias("first"), F.count("*").alias("n")).where("n > 1")
            .select(F.struct(F.col("conv"), F.col("digest")).alias("same"), "first"))
    light = light.withColumn("same", F.struct("conv", "digest"))
    fault = F.when(F.col("blank"), 1).when(F.col("at") > F.col("first"), 2).when(F.col("truncated"), 3).otherwise(0)
    return written(light.join(once, "same", "left").select("conv", "at", (F.col("initial") * 4 + fault).alias("code")), "dialogue_codes")


def _parts(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[int, list, np.ndarray, np.ndarray]]:
    """(chunk, conversations of its parts, where they begin and end, places, codes) of a sorted partition."""
    held: list[pa.RecordBatch] = []
    open_chunk = None

    def flush():
        table = pa.Table.from_batches(held)
        at, code = table["at"].to_numpy(), table["code"].to_numpy().astype(np.uint8)
        name = table["conv"].combine_chunks()
        number = name.dictionary_encode("encode").indices.to_numpy(zero_copy_only=False)
        begin = np.flatnonzero(np.r_[True, number[1:] != number[:-1]])
        return open_chunk, name.take(pa.array(begin)).to_pylist(), np.r_[begin, len(number)], at, code

    for batch in batches:
        chunk = batch.column(1).to_numpy() >> CHUNK_BITS
        cuts = np.r_[0, np.flatnonzero(chunk[1:] != chunk[:-1]) + 1, len(chunk)]
        for a, b in zip(cuts[:-1].tolist(), cuts[1:].tolist(), strict=True):
            if a == b:
                continue
            if open_chunk is not None and chunk[a] != open_chunk:
                yield flush()
                held = []
            open_chunk = int(chunk[a])
            held.append(batch.slice(a, b - a))
    if held:
        yield flush()


def _types(rows: DataFrame) -> tuple[str, pa.DataType]:
    """The type of conversations' ids for Spark and for Arrow."""
    kind = rows.schema["conv"].dataType
    return kind.simpleString(), to_arrow_type(kind)


def _in_chunks(codes: DataFrame) -> DataFrame:
    return codes.select("conv", "at", "code").repartition(F.shiftright("at", CHUNK_BITS)).sortWithinPartitions("at")


def _ends(codes: DataFrame) -> DataFrame:
    """(chunk, conv, final, start, end): the states in which conversations cross the ends of chunks.

    The first and the last part of a chunk give their matrices of costs and ranks; those of one conversation are
    multiplied, forward for the costs and audits, and back for the states."""
    kind, conv_type = _types(codes)

    def matrices(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for chunk, names, begin, _, code in _parts(batches):
            which = sorted({0, len(names) - 1})
            found = [[forward(code[begin[k]:begin[k + 1]].tobytes(), 0, int(begin[k + 1] - begin[k]), q) for q in range(4)] for k in which]
            yield pa.RecordBatch.from_arrays([
                pa.array([chunk] * len(which), pa.int64()), pa.array([names[k] for k in which], conv_type),
                pa.array([[c for cost, _ in m for c in cost] for m in found], pa.list_(pa.int64())),
                pa.array([[r for _, rank in m for r in rank] for m in found], pa.list_(pa.int64()))], ["chunk", "conv", "costs", "ranks"])

    parts = _in_chunks(codes).mapInArrow(matrices, f"chunk bigint, conv {kind}, costs array<bigint>, ranks array<bigint>")

    def multiply(table: pa.Table) -> pa.Table:
        table = table.sort_by("chunk")
        n = len(table)
        costs, ranks = table["costs"].to_pylist(), table["ranks"].to_pylist()
        cost, rank, came = [0, INF, INF, INF], [0] * 4, []
        for m, r in zip(costs, ranks, strict=True):
            best: list = [None] * 4
            for q in range(4):
                for s in range(4):
                    if cost[q] < INF and m[4 * q + s] < INF:
                        way = (cost[q] + m[4 * q + s], rank[q], r[4 * q + s], q)
                        if best[s] is None or way < best[s]:
                            best[s] = way
            came.append([w and w[3] for w in best])
            order = sorted((w[1:3], s) for s, w in enumerate(best) if w)
            cost = [w[0] if w else INF for w in best]
            for k, (_, s) in enumerate(order):
                rank[s] = k
        state, start, end = last_state(cost, rank), [0] * n, [0] * n
        for k in range(n - 1, -1, -1):
            end[k] = state
            state = start[k] = came[k][state]
        return pa.table({"chunk": table["chunk"], "conv": table["conv"], "final": pa.array([False] * (n - 1) + [True] if n else [], pa.bool_()),
                         "start": pa.array(start, pa.int64()), "end": pa.array(end, pa.int64())})

    return parts.groupBy("conv").applyInArrow(multiply, f"chunk bigint, conv {kind}, final boolean, start bigint, end bigint")


def edits(codes: DataFrame) -> DataFrame:
    """(conv, at, code, edits, state, closing): what happens to each row, the state behind it, and what is inserted behind a conversation's last row."""
    kind, conv_type = _types(codes)
    ends = _ends(codes)
    # the few ends stand before their chunk's rows: at is the chunk's first place, and they have no code
    marks = ends.select("conv", F.shiftleft("chunk", CHUNK_BITS).alias("at"), F.lit(None).cast("int").alias("code"),
                        "final", "start", "end")
    none = [F.lit(None).cast(t).alias(c) for c, t in (("final", "boolean"), ("start", "bigint"), ("end", "bigint"))]
    both = codes.select("conv", "at", F.col("code").cast("int"), *none).unionByName(marks)
    both = both.repartition(F.shiftright("at", CHUNK_BITS)).sortWithinPartitions("at", F.col("code").asc_nulls_first())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known: dict[tuple[int, object], tuple[int, int | None]] = {}

        def rows() -> Iterator[pa.RecordBatch]:
            for batch in batches:
                mark = batch.column(2).is_null()
                if mark.true_count:
                    m = batch.filter(mark)
                    for conv, at, final, start, end in zip(m.column(0).to_pylist(), m.column(1).to_pylist(), *(m.column(k).to_pylist() for k in (3, 4, 5)), strict=True):
                        known[at >> CHUNK_BITS, conv] = (start, None if final else end)
                    batch = batch.filter(pa.compute.invert(mark))
                if len(batch):
                    yield pa.RecordBatch.from_arrays([batch.column(k) for k in range(3)], ["conv", "at", "code"])

        for chunk, names, begin, at, code in _parts(rows()):
            done: list[str] = []
            states: list[int] = []
            closing: list[str] = []
            for k, name in enumerate(names):
                part = code[begin[k]:begin[k + 1]].tobytes()
                start, end = known.pop((chunk, name), (NONE, None))
                final = end is None
                made, end = _solved(part, start, end)
                done += made
                state = start
                for e in made:
                    for one in e:
                        if one == "K" and state == NONE and part[len(states) - begin[k]] >> 2 == 0:
                            state = SYSTEM
                        elif one != "D":
                            state = NEXT[state]
                    states.append(state)
                closing += [""] * (len(made) - 1) + [CLOSING[end] if final else ""]
            names_of = pa.array(np.repeat(np.arange(len(names)), np.diff(begin)))
            yield pa.RecordBatch.from_arrays(
                [pa.array(names, conv_type).take(names_of), pa.array(at), pa.array(code.astype(np.int32)), pa.array(done, pa.string()),
                 pa.array(states, pa.int32()), pa.array(closing, pa.string())], ["conv", "at", "code", "edits", "state", "closing"])

    return written(both.mapInArrow(run, f"conv {kind}, at bigint, code int, edits string, state int, closing string"), "dialogue_edits")


def plan(conversations: DataFrame, **columns: str) -> tuple[DataFrame, DataFrame]:
    """The damaged rows in order and their edits, both as written tables with the place ``at``."""
    rows = ordered(damaged(conversations, **columns))
    return rows, edits(faults(rows))


def repaired(rows: DataFrame, made: DataFrame) -> DataFrame:
    """(conv, at, step, turn, role, text, edit, fault): the repaired conversations' rows, in order of (at, step);
    inserted turns have the turn of the row that they stand at, and deleted rows stay with edit D."""
    one = rows.select("at", "turn", "role", "text").join(made, "at")
    steps = F.posexplode(F.split(F.concat("edits", "closing"), ""))
    one = one.select("*", steps.alias("step", "edit")).where("edit != ''")
    # the state behind the row's own edit is known; one insertion before it or behind it alternates
    behind = F.col("step") - F.length("edits") + 1
    role_of = lambda user: F.when(user, F.lit("user")).otherwise(F.lit("assistant"))
    first_behind = F.col("state") != USER
    inserted = F.when(behind > 0, role_of(first_behind == (behind % 2 == 1))).otherwise(role_of(F.col("state") == ASSISTANT))
    return one.select(
        "conv", "at", "step", "turn", F.when(F.col("edit") == "I", inserted).when(F.col("edit") == "R", role_of(F.col("state") == USER)).otherwise(F.col("role")).alias("role"),
        F.when(F.col("edit") == "I", "").otherwise(F.col("text")).alias("text"), "edit",
        F.when(F.col("edit") != "I", F.element_at(F.array(*map(F.lit, FAULTS)), F.col("code") % 4 + 1)).alias("fault"))


class _Digest:
    """One conversation's figures, row by row."""

    def __init__(self, conv):
        self.conv, self.hash, self.first, self.audit = conv, hashlib.sha256(), True, []
        self.counts, self.illegal, self.cost, self.before = [0, 0, 0, 0], 0, 0, None
        self.low = self.high = self.turn = None
        self.distinct, self.state = 0, NONE

    def say(self, role: str, text: str) -> None:
        self.hash.update(f"{'' if self.first else chr(10)}{role}:{text}".encode())
        self.first = False

    def insert(self) -> None:
        self.state = NEXT[self.state]
        self.cost += INSERT
        self.say(ROLE[self.state], "")

    def add(self, turn, role: str, text: str, code: int, edits: str, closing: str) -> None:
        fault = code & 3
        self.counts[fault] += 1
        if self.before is not None and self.before + role[:1] not in ("su", "ua", "au"):
            self.illegal += 1
        self.before = role[:1]
        if turn is not None and turn != self.turn:
            self.turn, self.high = turn, turn
            self.low = turn if self.low is None else self.low
            self.distinct += 1
        self.audit.append(edits + closing)
        for edit in edits:
            if edit == "D":
                self.cost += DELETE
                continue
            if edit == "I":
                self.insert()
                continue
            self.cost += TRUNCATED if FAULTS[fault] == "truncated" else 0
            if edit == "K":
                self.state = SYSTEM if code >> 2 == 0 else NEXT[self.state]
                self.say(role, text)
            else:
                self.state = NEXT[self.state]
                self.cost += REROLE
                self.say(ROLE[self.state], text)
        for _ in closing:
            self.insert()

    def row(self) -> tuple:
        gaps = 0 if self.low is None else self.high - self.low + 1 - self.distinct
        return (self.conv, gaps, *self.counts[1:], self.illegal, self.cost, "".join(self.audit), self.hash.hexdigest())


_LONGS = ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")


def digests(conversations: DataFrame, rows: DataFrame, made: DataFrame, conv: str = "conv_id") -> DataFrame:
    """One row for each conversation: gaps, faults, illegal neighbours, cost, audit and the digest of the repaired text.
    Rows and edits meet in order of place; only one row's text is held at a time."""
    kind, conv_type = _types(rows)
    one = (rows.select("conv", "at", "turn", "role", "text", *(F.lit(None).cast(t).alias(c) for c, t in (("code", "int"), ("edits", "string"), ("closing", "string"))))
           .unionByName(made.select("conv", "at", F.lit(None).cast(rows.schema["turn"].dataType).alias("turn"), *(F.lit(None).cast("string").alias(c) for c in ("role", "text")),
                                    "code", "edits", "closing")))
    one = one.repartition("conv").sortWithinPartitions("conv", "at", F.col("code").asc_nulls_first())
    schema = f"conv {kind}, {', '.join(f'{c} bigint' for c in _LONGS)}, audit string, repaired_sha256 string"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own, waiting, out = None, None, []

        def packed() -> pa.RecordBatch:
            columns = list(zip(*out, strict=True))
            types = [conv_type, *[pa.int64()] * 6, pa.string(), pa.string()]
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types, strict=True)], ["conv", *_LONGS, "audit", "repaired_sha256"])

        for batch in batches:
            for name, _, turn, role, text, code, edit, closing in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if code is None:
                    waiting = (turn, role, text)
                    continue
                if own is None or own.conv != name:
                    if own is not None:
                        out.append(own.row())
                    own = _Digest(name)
                own.add(*waiting, code, edit, closing)
            if len(out) > 1000:
                yield packed()
                out.clear()
        if own is not None:
            out.append(own.row())
        if out:
            yield packed()

    found = one.mapInArrow(run, schema)
    every = conversations.select(F.col(conv).alias("every")).distinct()
    found = every.join(found, every["every"].eqNullSafe(found["conv"]), "left")
    return found.select(F.col("every").alias(conv), *(F.coalesce(c, F.lit(0)).cast("bigint").alias(c) for c in _LONGS), F.coalesce("audit", F.lit("")).alias("audit"),
                        F.coalesce("repaired_sha256", F.lit(hashlib.sha256().hexdigest())).alias("repaired_sha256"))


def repair(conversations: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """The digests of the damaged and repaired conversations."""
    rows, made = plan(conversations, conv=conv, turn=turn, role=role, text=text)
    return digests(conversations, rows, made, conv)
