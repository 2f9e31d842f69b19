"""Conversation structure repair by a checkpointed dynamic programme.

Rows of a conversation are edited, at least cost, until the initials of their roles
read `(s?(ua)+)?`. Keep costs 0, Rerole to user or assistant 2, Delete 3 (and is
the only edit of a blank or duplicate row), Insert an empty user or assistant row 2;
a truncated row that stays costs 1 more. What may follow depends on one of four
states only: nothing yet, after s, after u, after a.

All rows are ranked once and cut into segments of SEGMENT rows, so a conversation
of any length is worked on in pieces. A segment gives the least costs from each
state before it to each after it; from the last segment back these give the
state-cost vector at the end of each segment, which are the outer checkpoints.
Inside a segment of n rows only every sqrt(n)-th vector is stored; its blocks are
computed again on the walk forward, which takes the ASCII-least letter among the
edits that keep to the least cost.
"""

from __future__ import annotations

import functools
import hashlib
import math
from collections import deque
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loomline.llm.common import BLANK_CHARS, written
from loomline.operators.ordering import rank_rows

SEGMENT = 1 << 12
#: Costs of the edits.
DELETE, INSERT, REROLE, TRUNCATED = 3, 2, 2, 1
FAR = 1 << 40
#: States: 0 nothing yet, 1 after s, 2 after u, 3 after a. What a new row makes of each.
NEXT = (2, 2, 3, 2)
#: Kept rows by initial (s, u, a, other): the state after each state, or None.
KEEP = ((1, None, None, None), (2, 2, None, 2), (None, None, 3, None), (None,) * 4)
#: Least cost of ending well from each state.
END = (0, 4, 2, 0)
SOUND, CUT_SHORT, GONE = 0, 1, 2
_NUMBERS = bytes(max(0, c - ord("A")) for c in range(256))

Vector = tuple[int, int, int, int]


def before(code: int, after: Vector) -> Vector:
    """Least costs from each state before a row, given those after it.

    A code is three times the initial's number plus the fault.
    """
    initial, fault = divmod(code, 3)
    costs = [c + DELETE for c in after]
    if fault != GONE:
        extra = TRUNCATED if fault == CUT_SHORT else 0
        for state in range(4):
            kept = KEEP[initial][state]
            if kept is not None:
                costs[state] = min(costs[state], after[kept] + extra)
            costs[state] = min(costs[state], after[NEXT[state]] + REROLE + extra)
    u, a = min(costs[2], costs[3] + INSERT), min(costs[3], costs[2] + INSERT)
    return min(costs[0], u + INSERT), min(costs[1], u + INSERT), u, a


@functools.lru_cache(maxsize=1 << 14)
def transfer(codes: bytes) -> tuple[int, ...]:
    """Least costs of a segment from each state before it to each state after it."""
    columns = []
    for goal in range(4):
        vector: Vector = tuple(0 if s == goal else FAR for s in range(4))
        for code in reversed(codes):
            vector = before(code, vector)
        columns.append(vector)
    return tuple(min(columns[t][s], FAR) for s in range(4) for t in range(4))


def _letter(code: int, state: int, now: Vector, after: Vector) -> str:
    """The ASCII-least edit that keeps to the least cost."""
    initial, fault = divmod(code, 3)
    cost = now[state]
    if after[state] + DELETE == cost:
        return "D"
    if now[NEXT[state]] + INSERT == cost:
        return "I"
    extra = TRUNCATED if fault == CUT_SHORT else 0
    kept = KEEP[initial][state]
    return "K" if kept is not None and after[kept] + extra == cost else "R"


@functools.lru_cache(maxsize=1 << 14)
def walks(codes: bytes, end: Vector, last: bool, states: tuple[int, ...]) -> tuple[tuple[int, str], ...]:
    """The state after a segment and its edits, for each state before it.

    end has the least costs after the segment. Only every step-th vector is kept.
    """
    n = len(codes)
    step = max(1, math.isqrt(n))
    marks, vector = {n: end}, end
    for k in range(n - 1, -1, -1):
        vector = before(codes[k], vector)
        if k % step == 0:
            marks[k] = vector
    now = list(states)
    edits: list[list[str]] = [[] for _ in states]
    for start in range(0, n, step):
        stop = min(n, start + step)
        block = [marks[stop]]
        for k in range(stop - 1, start, -1):
            block.append(before(codes[k], block[-1]))
        block.append(marks[start])
        block.reverse()
        for w in range(len(now)):
            state, out = now[w], edits[w]
            for k in range(start, stop):
                while (letter := _letter(codes[k], state, block[k - start], block[k - start + 1])) == "I":
                    out.append("I")
                    state = NEXT[state]
                out.append(letter)
                if letter == "K":
                    state = KEEP[codes[k] // 3][state]
                elif letter == "R":
                    state = NEXT[state]
            now[w] = state
    if last:
        for w in range(len(now)):
            while END[now[w]]:
                edits[w].append("I")
                now[w] = NEXT[now[w]]
    return tuple((s, "".join(e)) for s, e in zip(now, edits))


def illegal(codes: bytes) -> int:
    """Neighbours whose initials are not su, ua or au."""
    initials = [c // 3 for c in codes]
    return sum((a, b) not in ((0, 1), (1, 2), (2, 1)) for a, b in zip(initials, initials[1:]))


SEGMENTS = "none boolean, conv bigint, seg bigint, codes binary"
OWNER = ["none", "conv"]


def _columns(batch: pa.RecordBatch, *names: str) -> list[list]:
    return [batch.column(c).to_pylist() for c in names]


def _out(rows: list[tuple], names: tuple[str, ...], kinds: tuple[pa.DataType, ...]) -> pa.RecordBatch:
    columns = list(zip(*rows)) if rows else [[]] * len(names)
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names=list(names))


_KEY_KINDS = (pa.bool_(), pa.int64(), pa.int64())


def _transfers(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        keys = _columns(batch, "none", "conv", "seg", "codes")
        rows = [(*row, transfer(row[3].translate(_NUMBERS))) for row in zip(*keys)]
        kinds = (*_KEY_KINDS, pa.binary(), pa.list_(pa.int64()))
        yield _out(rows, ("none", "conv", "seg", "codes", "costs"), kinds)


def _backward(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Segments of a conversation from its last on: the vector at each one's end."""
    owner, vector = None, END
    for batch in batches:
        rows = []
        for none, conv, seg, codes, costs in zip(*_columns(batch, "none", "conv", "seg", "codes", "costs")):
            last = (none, conv) != owner
            if last:
                owner, vector = (none, conv), END
            end = vector
            vector = tuple(min(costs[4 * s + t] + end[t] for t in range(4)) for s in range(4))
            rows.append((none, conv, seg, codes, list(end), last, vector[0]))
        kinds = (*_KEY_KINDS, pa.binary(), pa.list_(pa.int64()), pa.bool_(), pa.int64())
        yield _out(rows, ("none", "conv", "seg", "codes", "end", "last", "cost"), kinds)


def _walked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        rows = []
        names = ("none", "conv", "seg", "codes", "end", "last", "first", "cost")
        for none, conv, seg, codes, end, last, first, cost in zip(*_columns(batch, *names)):
            codes = codes.translate(_NUMBERS)
            found = walks(codes, tuple(end), last, (0,) if first else (0, 1, 2, 3))
            after, edits = [s for s, _ in found], [e for _, e in found]
            rows.append((none, conv, seg, first, cost, after, edits, illegal(codes), codes[0] // 3, codes[-1] // 3))
        longs = pa.list_(pa.int64())
        kinds = (*_KEY_KINDS, pa.bool_(), pa.int64(), longs, pa.list_(pa.string()), *[pa.int64()] * 3)
        names = ("none", "conv", "seg", "first", "cost", "after", "edits", "illegal", "head", "tail")
        yield _out(rows, names, kinds)


def _forward(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Segments of a conversation from its first on: the edits from the state they meet."""
    state = tail = 0
    names = ("none", "conv", "seg", "first", "cost", "after", "edits", "illegal", "head", "tail")
    for batch in batches:
        rows = []
        for none, conv, seg, first, cost, after, edits, wrong, head, end in zip(*_columns(batch, *names)):
            if first:
                state = 0
            else:
                wrong += (tail, head) not in ((0, 1), (1, 2), (2, 1))
            rows.append((none, conv, seg, edits[state], cost if first else 0, wrong))
            state, tail = after[state], end
        kinds = (*_KEY_KINDS, pa.string(), pa.int64(), pa.int64())
        yield _out(rows, ("none", "conv", "seg", "edits", "cost", "illegal"), kinds)


def repaired_rows(rows: Iterator[tuple], roles: tuple[str, str] = ("user", "assistant")) -> Iterator[tuple]:
    """(owner, role, text) of repaired conversations, from rows in order.

    A row is (owner, edits, None) for a segment, which comes before the rows it is
    about, or (owner, role, text); owner tells conversations apart.
    """
    owner, state, letters = None, 0, deque()

    def inserted() -> Iterator[tuple]:
        nonlocal state
        while letters and letters[0] == "I":
            letters.popleft()
            state = NEXT[state]
            yield owner, roles[state - 2].encode(), b""

    for own, said, text in rows:
        if own != owner:
            yield from inserted()
            owner, state, letters = own, 0, deque()
        if text is None:
            letters.extend(said)
            continue
        yield from inserted()
        letter = letters.popleft()
        if letter == "R":
            state = NEXT[state]
            yield owner, roles[state - 2].encode(), text
        elif letter == "K":
            state = KEEP[b"sua".index(said[:1])][state]
            yield owner, said, text
    yield from inserted()


def _digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """SHA-256 of the repaired rows of each conversation, text after text."""

    def rows() -> Iterator[tuple]:
        for batch in batches:
            for none, conv, edits, role, text in zip(*_columns(batch, "none", "conv", "edits", "role", "text")):
                yield ((none, conv), edits, None) if text is None else ((none, conv), role, text)

    owner, digest, done = None, None, []
    kinds = (pa.bool_(), pa.int64(), pa.string())
    names = ("none", "conv", "repaired_sha256")
    for own, role, text in repaired_rows(rows()):
        if own != owner:
            if owner is not None:
                done.append((*owner, digest.hexdigest()))
            owner, digest = own, hashlib.sha256()
        else:
            digest.update(b"\n")
        digest.update(role + b":" + text)
        if len(done) >= 4096:
            yield _out(done, names, kinds)
            done = []
    if owner is not None:
        done.append((*owner, digest.hexdigest()))
    yield _out(done, names, kinds)


def _repaired(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    def rows() -> Iterator[tuple]:
        for batch in batches:
            for none, conv, edits, role, text in zip(*_columns(batch, "none", "conv", "edits", "role", "text")):
                yield ((none, conv), edits, None) if text is None else ((none, conv), role, text)

    owner, n, size, out = None, 0, 0, []
    kinds = (pa.bool_(), pa.int64(), pa.int64(), pa.binary(), pa.binary())
    names = ("none", "conv", "place", "role", "text")
    for own, role, text in repaired_rows(rows()):
        owner, n = own, n + 1 if own == owner else 0
        out.append((*own, n, role, text))
        size += len(text)
        if len(out) >= 4096 or size >= 1 << 24:
            yield _out(out, names, kinds)
            out, size = [], 0
    yield _out(out, names, kinds)


def _keyed(conversations: DataFrame) -> DataFrame:
    """none, conv (the id, 0 for a null one), turn, role, text; nulls are one space."""
    conv, turn = F.col("conv_id").cast("bigint"), F.col("turn").cast("bigint")
    return conversations.select(
        conv.isNull().alias("none"),
        F.coalesce(conv, F.lit(0)).alias("conv"),
        turn.alias("turn"),
        F.coalesce(F.col("role").cast("string"), F.lit(" ")).alias("role"),
        F.coalesce(F.col("text").cast("string"), F.lit(" ")).alias("text"),
    )


def damaged(keyed: DataFrame) -> DataFrame:
    """The rows after damage by crc32 of `conv_id:turn` modulo 20.

    0 drops the row, 1 empties its text, 2 takes its .!? away, 3 repeats it, 4 makes
    its role user.
    """
    space = F.lit(" ")
    name = F.concat(
        F.when(F.col("none"), space).otherwise(F.col("conv").cast("string")),
        F.lit(":"),
        F.coalesce(F.col("turn").cast("string"), space),
    )
    hit = F.col("hit")
    text = F.when(hit == 1, "").when(hit == 2, F.translate("text", ".!?", "")).otherwise(F.col("text"))
    copies = F.when(hit == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))
    return (
        keyed.withColumn("hit", F.crc32(name.cast("binary")) % 20)
        .filter("hit <> 0")
        .select(
            *OWNER, "turn", F.when(hit == 4, "user").otherwise(F.col("role")).alias("role"), text.alias("text"),
            F.explode(copies).alias("copy"),
        )
        .drop("copy")
    )


def _hashes() -> tuple[Column, Column]:
    return F.xxhash64("role", "text").alias("k1"), F.xxhash64("text", "role", F.lit(1)).alias("k2")


_ORDER = ["none", "conv", "turn", "k1", "k2"]


def _order() -> list[Column]:
    return [F.col(c).asc_nulls_first() for c in _ORDER]


def _segments(rows: DataFrame, segment: int) -> tuple[DataFrame, DataFrame]:
    """Segments with a code for each row, and what each conversation counts."""
    start = F.substring("role", 1, 1)
    initial = F.when(start == "s", 0).when(start == "u", 1).when(start == "a", 2).otherwise(3)
    ink = F.rtrim(F.col("text"), F.lit(BLANK_CHARS))
    narrow = rows.select(
        *OWNER, "turn", *_hashes(), initial.alias("initial"), (ink == "").alias("blank"),
        (~F.right(ink, F.lit(1)).isin(".", "!", "?")).alias("cut"),
    )
    ranked = rank_rows(narrow, _order(), "place")
    # the first of equal rows, found again by its place alone, which is no hot key
    firsts = ranked.groupBy(*OWNER, "k1", "k2").agg(F.min("place").alias("place"))
    marked = ranked.join(firsts.select("place", F.lit(True).alias("fresh")), "place", "left")
    blank = F.col("blank")
    again = ~blank & F.col("fresh").isNull()
    short = ~blank & F.col("fresh").isNotNull() & F.col("cut")
    fault = F.when(blank | again, GONE).when(short, CUT_SHORT).otherwise(SOUND)
    coded = marked.select(
        *OWNER, "place", "turn", "k1", "k2", F.expr(f"place div {segment}").alias("seg"),
        blank.cast("bigint").alias("blank"), again.cast("bigint").alias("duplicate"),
        short.cast("bigint").alias("truncated"),
        F.char(F.lit(ord("A")) + F.col("initial") * 3 + fault).alias("code"),
    )
    listed = F.array_sort(F.collect_list(F.struct("place", "code")))
    segments = written(
        coded.groupBy(*OWNER, "seg").agg(
            F.array_join(F.transform(listed, lambda x: x["code"]), "").alias("codes"),
            F.min_by(F.struct("turn", "k1", "k2"), "place").alias("at"),
            F.min("turn").alias("low"), F.max("turn").alias("high"),
            *[F.sum(c).alias(c) for c in ("blank", "duplicate", "truncated")],
        ),
        "repair-segments",
    )
    distinct = ranked.groupBy(*OWNER).agg(F.count_distinct("turn").alias("turns"))
    counts = (
        segments.groupBy(*OWNER)
        .agg(
            F.min("low").alias("low"), F.max("high").alias("high"),
            *[F.sum(c).alias(c) for c in ("blank", "duplicate", "truncated")],
        )
        .join(distinct, OWNER)
        .withColumn("gaps", F.coalesce(F.col("high") - F.col("low") + 1 - F.col("turns"), F.lit(0)))
    )
    return segments, counts


def edits(segments: DataFrame) -> DataFrame:
    """none, conv, seg, edits, cost (at a conversation's first segment), illegal."""
    own = segments.select(*OWNER, "seg", F.col("codes").cast("binary").alias("codes"))
    first = own.groupBy(*OWNER).agg(F.min("seg").alias("first_seg"))
    back = (
        own.mapInArrow(_transfers, SEGMENTS + ", costs array<bigint>")
        .repartition(*OWNER)
        .sortWithinPartitions(*OWNER, F.desc("seg"))
        .mapInArrow(_backward, SEGMENTS + ", end array<bigint>, last boolean, cost bigint")
    )
    ends = back.join(first, OWNER).withColumn("first", F.col("seg") == F.col("first_seg"))
    walked = ends.repartition(*OWNER, "seg").mapInArrow(
        _walked,
        "none boolean, conv bigint, seg bigint, first boolean, cost bigint, after array<bigint>, "
        "edits array<string>, illegal bigint, head bigint, tail bigint",
    )
    found = (
        walked.repartition(*OWNER)
        .sortWithinPartitions(*OWNER, "seg")
        .mapInArrow(_forward, "none boolean, conv bigint, seg bigint, edits string, cost bigint, illegal bigint")
    )
    return written(found, "repair-edits")


class Repair:
    """A table of conversations, its damage and its least repair."""

    def __init__(self, conversations: DataFrame, segment: int = SEGMENT) -> None:
        self.keyed = _keyed(conversations)
        self.rows = damaged(self.keyed)
        self.segments, self.counts = _segments(self.rows, segment)
        self.edits = edits(self.segments)

    def _in_turn(self) -> DataFrame:
        """Texts in order, each segment's edits before its rows."""
        at = self.edits.join(self.segments.select(*OWNER, "seg", "at"), [*OWNER, "seg"])
        nothing = F.lit(None).cast("binary")
        orders = at.select(
            *OWNER, "at.*", F.lit(0).alias("kind"), "seg", "edits", nothing.alias("role"), nothing.alias("text")
        )
        said = self.rows.select(
            *OWNER, "turn", *_hashes(), F.lit(1).alias("kind"), F.lit(0).cast("bigint").alias("seg"),
            F.lit(None).cast("string").alias("edits"),
            F.col("role").cast("binary").alias("role"), F.col("text").cast("binary").alias("text"),
        )
        return (
            orders.unionByName(said)
            .repartition(*OWNER)
            .sortWithinPartitions(*_order(), "kind", "seg")
            .select(*OWNER, "edits", "role", "text")
        )

    def repaired(self) -> DataFrame:
        """conv_id, place, role, text of the repaired conversations."""
        rows = self._in_turn().mapInArrow(
            _repaired, "none boolean, conv bigint, place bigint, role binary, text binary"
        )
        conv = F.when(~F.col("none"), F.col("conv"))
        return rows.select(
            conv.alias("conv_id"), "place", F.col("role").cast("string"), F.col("text").cast("string")
        )

    def report(self) -> DataFrame:
        """conv_id, gaps, blank, duplicate, truncated, illegal, cost, audit: one row each."""
        parts = F.array_sort(F.collect_list(F.struct("seg", "edits")))
        audit = self.edits.groupBy(*OWNER).agg(
            F.sum("cost").alias("cost"), F.sum("illegal").alias("illegal"),
            F.array_join(F.transform(parts, lambda x: x["edits"]), "").alias("audit"),
        )
        every = self.keyed.select(*OWNER).distinct()
        numbers = ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")
        joined = every.join(self.counts, OWNER, "left").join(audit, OWNER, "left")
        return joined.select(
            *OWNER, *[F.coalesce(c, F.lit(0)).alias(c) for c in numbers], F.coalesce("audit", F.lit("")).alias("audit")
        )

    def digests(self) -> DataFrame:
        return self._in_turn().mapInArrow(_digests, "none boolean, conv bigint, repaired_sha256 string")


def repair_report(conversations: DataFrame, segment: int = SEGMENT) -> DataFrame:
    """One row for each conv_id: what its rows after damage lack, and its least repair.

    conv_id, gaps, blank, duplicate, truncated, illegal, cost, audit, repaired_sha256.

    conversations has conv_id, turn, role and text; other columns are not read. A null
    conv_id is a conversation of its own, whose rows are one. Nulls elsewhere are read
    as one space; null turns come first and count in no gap. Rows of one turn are in
    order of the hash of role and text, so the result does not depend on how rows
    come; repeated rows are rows of their own. Texts of any length are read whole.
    Role initials other than s, u and a, or none, are never kept. A conversation
    without rows after damage has zeros, an empty audit and the digest of nothing. An
    empty table gives no rows.
    """
    work = Repair(conversations, segment)
    joined = work.report().join(work.digests(), OWNER, "left")
    nothing = hashlib.sha256(b"").hexdigest()
    return joined.select(
        F.when(~F.col("none"), F.col("conv")).alias("conv_id"),
        "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit",
        F.coalesce("repaired_sha256", F.lit(nothing)).alias("repaired_sha256"),
    )
