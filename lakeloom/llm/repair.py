"""Repair of conversation structure by least-cost edits, in linear space.

A conversation should be nothing, or an optional system turn and then pairs of user and assistant turns: by
role initials ``(s?(ua)+)?``. Edits of its rows are Keep (0), Rerole to user or assistant (1),
Delete (2, the only choice for blank and repeated rows) and Insert of an empty user or assistant turn
(5); a truncated row that is not deleted costs 5 more. Of the cheapest edit sequences the one whose
initials are least in ASCII is taken.

The language has four states (nothing yet, after system, after user, after assistant), so the costs of
all ways through some rows are a vector of four for each state they begin in. Hirschberg's method finds
the edits without a table over all rows: a forward vector and a backward vector meet in the middle,
the crossing with least total (of several the one whose edits so far are least) splits the rows, and both
halves are solved alike. The forward vector also carries the rank of its four edit sequences; they are
taken up to the last row's own edit, so none of them is the beginning of another.

The same meeting of vectors spreads one long conversation over tasks:

1. Rows are put in order once (conversation, turn with NULL first, role, text) and cut into cells of
   ``CELL`` consecutive rows, whatever conversations these belong to.
2. Each stretch of a conversation within a cell gives its four forward vectors and one byte per row.
3. Per conversation the vectors of its stretches, 1/``CELL`` of its rows, are combined backward for the
   costs still to come, then forward for the state in which each stretch begins and ends.
4. Each stretch, with both ends fixed, is solved on its own.

Whether role and text came earlier is found by the smallest place of each (conversation, role, digest of
the text). Texts are joined to their edits by the unique place, so no conversation is held together.

Cases: NULL roles and texts read as one space; a NULL turn comes first and counts for no gap; a NULL
conversation id is a conversation of its own. Rows with equal turns are ordered by role and text.
Roles count by their first character. Rows that repeat an id, a turn, a role and a text are repeated
rows of that conversation. An empty table gives no rows. Columns beyond the four named ones are left aside.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator, Sequence
from functools import lru_cache
from itertools import groupby

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..operators.ordering import ordered_slices
from ..session import shared_dir

CELL = 4096  # rows of a cell
REROLE, DELETE, INSERT, TRUNCATED = 1, 2, 5, 5
NOTHING, SYSTEM, USER, ASSISTANT = range(4)  # states: what the repaired conversation ends with
CLASSES = "sua"  # first characters of roles; all others are class 3
OK, BLANK, DUPLICATE, CUT = range(4)  # faults of a row
SPACE = " \t\n\x0b\x0c\r"
_BITS = 33  # as in ordered_slices

_NEVER = 1 << 60
#: Role initial to the next state, by state.
_NEXT = [{"s": SYSTEM, "u": USER}, {"u": USER}, {"a": ASSISTANT}, {"u": USER}]
_FITTING = ["u", "u", "a", "u"]  # the one role among user and assistant that may follow each state
_NAMES = {"u": "user", "a": "assistant"}


# --- one stretch of rows --------------------------------------------------------------------


def _inserts(state: int) -> Iterator[tuple[int, str]]:
    """States after no, one or two inserted turns, and the roles of these."""
    roles = ""
    for _ in range(3):
        yield state, roles
        roles += _FITTING[state]
        state = _NEXT[state][_FITTING[state]]


@lru_cache(maxsize=None)
def ways(kind: int) -> tuple[tuple[tuple[int, int, str, str, str], ...], ...]:
    """For each state after a row of this kind: (state before, cost, edits, roles inserted, new role)."""
    initial, fault = (CLASSES + "?")[kind // 4], kind % 4
    best: dict[tuple[int, int], tuple[int, str, str, str]] = {}

    def offer(s: int, t: int, *way) -> None:
        best[s, t] = min(best.get((s, t), (_NEVER, "")), way)

    for s in range(4):
        for x, roles in _inserts(s):
            before, cost = "I" * len(roles), INSERT * len(roles)
            offer(s, x, cost + DELETE, before + "D", roles, "")
            if fault in (OK, CUT):
                cost += TRUNCATED * (fault == CUT)
                if initial in _NEXT[x]:
                    offer(s, _NEXT[x][initial], cost, before + "K", roles, initial)
                role = _FITTING[x]
                offer(s, _NEXT[x][role], cost + REROLE, before + "R", roles, role)
    return tuple(tuple((s, *best[s, t]) for s in range(4) if (s, t) in best) for t in range(4))


def closing(state: int) -> str:
    """Roles to insert at the end of a conversation."""
    return {NOTHING: "", SYSTEM: "ua", USER: "a", ASSISTANT: ""}[state]


LAST = [INSERT * len(closing(s)) for s in range(4)]  # cost to come behind the last row


def forward(kinds: Sequence[int], start: int) -> tuple[list[int], list[int]]:
    """Cost, and rank of the least edits, of reaching each state behind the rows from ``start``."""
    cost, rank = [_NEVER] * 4, [4] * 4
    cost[start], rank[start] = 0, 0
    for kind in kinds:
        found = []
        for to in ways(kind):
            found.append(min(((cost[s] + c, rank[s], edits) for s, c, edits, _, _ in to if cost[s] < _NEVER), default=(_NEVER, 4, "")))
        order = sorted(range(4), key=lambda t: found[t][1:] if found[t][0] < _NEVER else (5, ""))
        cost, rank = [f[0] for f in found], [order.index(t) if found[t][0] < _NEVER else 4 for t in range(4)]
    return cost, rank


def backward(kinds: Sequence[int], stop: int) -> list[int]:
    """Cost of reaching ``stop`` behind the rows from each state before them."""
    cost = [_NEVER] * 4
    cost[stop] = 0
    for kind in reversed(kinds):
        now = [_NEVER] * 4
        for t, to in enumerate(ways(kind)):
            if cost[t] < _NEVER:
                for s, c, *_ in to:
                    now[s] = min(now[s], c + cost[t])
        cost = now
    return cost


def crossing(ahead: list[int], rank: list[int], behind: list[int]) -> int:
    """The state at which the cheapest and then least way crosses."""
    return min(range(4), key=lambda s: (min(_NEVER, ahead[s] + behind[s]), rank[s]))


def solve(kinds: Sequence[int], start: int, stop: int) -> list[tuple[str, str, str]]:
    """Per row its edits, the roles inserted before it and its own new role ('' where it is deleted)."""
    out: list[tuple[str, str, str]] = []

    def part(lo: int, hi: int, p: int, q: int) -> None:
        if hi - lo == 1:
            out.append(min((c, *way) for s, c, *way in ways(kinds[lo])[q] if s == p)[1:])
        elif hi > lo:
            mid = (lo + hi) // 2
            at = crossing(*forward(kinds[lo:mid], p), backward(kinds[mid:hi], q))
            part(lo, mid, p, at)
            part(mid, hi, at, q)

    part(0, len(kinds), start, stop)
    return out


# --- Spark: faults, stretches, edits ----------------------------------------------------------


def damage(rows: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """Rows dropped, emptied, truncated, repeated or given the role user, by a checksum of id and turn."""
    blank = F.lit(" ")
    mark = F.concat(F.coalesce(F.col(conv).cast("string"), blank), F.lit(":"), F.coalesce(F.col(turn).cast("string"), blank))
    k = F.crc32(mark.cast("binary")) % 20
    told = F.coalesce(F.col(text), blank)
    new_text = F.when(k == 1, "").when(k == 2, F.translate(told, ".!?", "")).otherwise(told)
    new_role = F.when(k == 4, "user").otherwise(F.coalesce(F.col(role), blank))
    named = rows.filter(k != 0).select(F.col(conv).alias(conv), F.col(turn).alias(turn), new_role.alias(role), new_text.alias(text), k.alias("_k"))
    return named.withColumn("_k", F.explode(F.array_repeat("_k", F.when(F.col("_k") == 3, 2).otherwise(1)))).drop("_k")


def _key(conv: str) -> Column:
    """The conversation as a key that is never NULL."""
    return F.coalesce(F.concat(F.lit("c"), F.col(conv).cast("string")), F.lit("-"))


def _stretches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows (cell, key, place, kind) in order to one row per stretch."""
    names = ["key", "place", "kinds", "costs", "ranks"]
    rows = (r for b in batches for r in zip(*(c.to_pylist() for c in b.columns)))
    out: list[tuple] = []

    def made() -> pa.RecordBatch:
        kinds = [pa.string(), pa.int64(), pa.binary(), pa.list_(pa.int64()), pa.list_(pa.int32())]
        return pa.RecordBatch.from_arrays([pa.array([r[i] for r in out], t) for i, t in enumerate(kinds)], names)

    for (_, key), group in groupby(rows, key=lambda r: r[:2]):
        group = list(group)  # at most a cell
        kinds = bytes(r[3] for r in group)
        sides = [forward(kinds, s) for s in range(4)]
        out.append((key, group[0][2], kinds, [c for side in sides for c in side[0]], [r for side in sides for r in side[1]]))
        if len(out) >= 2000:
            yield made()
            out.clear()
    if out:
        yield made()


def _illegal(kinds: bytes) -> int:
    fine = {(0, 1), (1, 2), (2, 1)}
    return sum((a // 4, b // 4) not in fine for a, b in zip(kinds, kinds[1:]))


def _meet(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Stretches (key, place, first, last, costs, ranks) in order to the states at their ends and the conversation's cost."""
    rows = (r for b in batches for r in zip(*(c.to_pylist() for c in b.columns)))
    for key, group in groupby(rows, key=lambda r: r[0]):
        group = list(group)
        behind = [LAST]
        for r in reversed(group[1:]):
            costs = r[4]
            behind.append([min(min(_NEVER, costs[4 * s + t] + behind[-1][t]) for t in range(4)) for s in range(4)])
        behind.reverse()
        state, spent, out = NOTHING, 0, []
        for r, after in zip(group, behind):
            costs, ranks = r[4][4 * state : 4 * state + 4], r[5][4 * state : 4 * state + 4]
            stop = crossing(costs, ranks, after)
            spent += costs[stop]
            out.append((key, r[1], state, stop))
            state = stop
        # Role classes of rows that meet across two stretches.
        across = sum(_illegal(bytes([a[3], b[2]])) for a, b in zip(group, group[1:]))
        n = len(out)
        columns = [pa.array([o[i] for o in out], t) for i, t in enumerate((pa.string(), pa.int64(), pa.int32(), pa.int32()))]
        last = [False] * (n - 1) + [True]
        columns += [pa.array(last), pa.array([spent + LAST[state] if x else None for x in last], pa.int64()), pa.array([across if x else None for x in last], pa.int64())]
        yield pa.RecordBatch.from_arrays(columns, ["key", "place", "start", "stop", "last", "cost", "across"])


def _solved(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Stretches (key, place, kinds, start, stop, last, cost, across) to edits, with counts of their faults."""
    for batch in batches:
        out = []
        for key, place, kinds, start, stop, last, cost, across in zip(*(c.to_pylist() for c in batch.columns)):
            found = solve(kinds, start, stop)
            end = closing(stop) if last else ""
            faults = [sum(k % 4 == f for k in kinds) for f in (BLANK, DUPLICATE, CUT)]
            out.append((key, place, "".join(f[0] for f in found) + "I" * len(end), [f[1] for f in found], [f[2] for f in found], end, *faults, _illegal(kinds) + (across or 0), cost or 0))
        kinds = [pa.string(), pa.int64(), pa.string(), pa.list_(pa.string()), pa.list_(pa.string()), pa.string(), *[pa.int64()] * 5]
        names = ["key", "place", "audit", "before", "role", "end", "blank", "duplicate", "truncated", "illegal", "cost"]
        yield pa.RecordBatch.from_arrays([pa.array([r[i] for r in out], t) for i, t in enumerate(kinds)], names)


def repair(
    rows: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text", cell: int = CELL
) -> tuple[DataFrame, DataFrame]:
    """``(audits, messages)`` of the conversations in ``rows``.

    ``audits``: one row per conversation with ``conv``, gaps, blank, duplicate, truncated, illegal, cost, audit.
    ``messages``: the repaired turns with ``conv``, ``place`` and ``part`` (their order), role and text.
    """
    shared_dir(rows.sparkSession)
    named = rows.select(
        _key(conv).alias("key"), F.col(turn).alias("turn"), F.coalesce(F.col(role), F.lit(" ")).alias("role"),
        F.coalesce(F.col(text), F.lit(" ")).alias("text"), F.col(conv).alias("conv"),
    )
    placed = ordered_slices(named, ["key", "turn", "role", "text"])
    placed = placed.withColumn("place", F.shiftleft(F.col("_slice").cast("bigint"), _BITS) + F.col("_pos"))
    end = F.rtrim(F.col("text"), F.lit(SPACE))
    fault = F.when(end == "", BLANK).when(~F.right(end, F.lit(1)).isin(".", "!", "?"), CUT).otherwise(OK)
    initial = F.substring("role", 1, 1)
    kind = F.when(initial == "s", 0).when(initial == "u", 1).when(initial == "a", 2).otherwise(3) * 4
    digest = F.sha2(F.col("text").cast("binary"), 256)
    firsts = placed.filter(end != "").groupBy("key", "role", digest).agg(F.min("place").alias("place"))
    marked = placed.select("key", "place", "_slice", "_pos", kind.alias("kind"), fault.alias("fault"))
    marked = marked.join(firsts.select("place", F.lit(True).alias("fresh")), "place", "left")
    again = F.col("fresh").isNull() & (F.col("fault") != BLANK)
    cells = F.struct("_slice", F.call_function("div", F.col("_pos"), F.lit(cell).cast("bigint")).alias("cell"))
    compact = marked.select(cells.alias("cell"), "key", "place", (F.col("kind") + F.when(again, DUPLICATE).otherwise(F.col("fault"))).cast("int").alias("kind"))
    compact = compact.repartition("cell").sortWithinPartitions("place").select(F.col("cell._slice").alias("s"), "cell.cell", "key", "place", "kind")
    compact = compact.select(F.xxhash64("s", "cell").alias("cell"), "key", "place", "kind")
    # Places of other cells may lie between two parts of a partition, never within a cell.
    stretches = compact.mapInArrow(_stretches, "key string, place bigint, kinds binary, costs array<bigint>, ranks array<int>").checkpoint()

    edge = lambda at: F.conv(F.hex(F.substring("kinds", at, 1)), 16, 10).cast("int")
    ends = stretches.select("key", "place", edge(1).alias("first"), edge(-1).alias("last"), "costs", "ranks")
    states = ends.repartition("key").sortWithinPartitions("key", "place").mapInArrow(
        _meet, "key string, place bigint, start int, stop int, last boolean, cost bigint, across bigint"
    )
    edits = stretches.select("key", "place", "kinds").join(states, ["key", "place"])
    edits = edits.select("key", "place", "kinds", "start", "stop", "last", "cost", "across").mapInArrow(
        _solved,
        "key string, place bigint, audit string, before array<string>, role array<string>, end string, "
        "blank bigint, duplicate bigint, truncated bigint, illegal bigint, cost bigint",
    ).checkpoint()

    turns = placed.groupBy("key").agg(
        F.first("conv").alias("conv"),
        F.coalesce(F.max("turn") - F.min("turn") + 1 - F.count_distinct("turn"), F.lit(0)).cast("bigint").alias("gaps"),
    )
    sums = ("blank", "duplicate", "truncated", "illegal", "cost")
    audits = edits.groupBy("key").agg(
        *[F.sum(c).alias(c) for c in sums], F.array_sort(F.collect_list(F.struct("place", "audit"))).alias("parts")
    )
    audits = turns.join(audits, "key").select(
        F.col("conv").alias(conv), "gaps", *sums, F.array_join(F.transform("parts", lambda p: p["audit"]), "").alias("audit")
    )

    # One row per original row again: its place is that of the stretch's first row and its index.
    steps = edits.select("place", F.size("role").alias("n"), "end", F.posexplode(F.arrays_zip("before", "role")).alias("i", "step"))
    steps = steps.select(
        (F.col("place") + F.col("i")).alias("place"), "step.before", F.col("step.role").alias("new"),
        F.when(F.col("i") == F.col("n") - 1, F.col("end")).otherwise("").alias("end"),
    )
    joined = placed.select("place", "conv", "role", "text").join(steps, "place")

    def empty_turns(roles: Column) -> Column:
        named = F.transform(F.filter(F.split(roles, ""), lambda c: c != ""), lambda c: F.when(c == "u", "user").otherwise("assistant"))
        return F.transform(named, lambda r: F.struct(r.alias("role"), F.lit("").alias("text")))

    kept_role = F.when(F.substring("role", 1, 1) == F.col("new"), F.col("role")).when(F.col("new") == "u", "user").otherwise("assistant")
    own = F.when(F.col("new") != "", F.array(F.struct(kept_role.alias("role"), F.col("text").alias("text"))))
    turns_of = F.concat(empty_turns(F.col("before")), F.coalesce(own, F.array().cast("array<struct<role:string,text:string>>")), empty_turns(F.col("end")))
    messages = joined.select(F.col("conv").alias(conv), "place", F.posexplode(turns_of).alias("part", "turn"))
    return audits, messages.select(conv, "place", "part", F.col("turn.role").alias("role"), F.col("turn.text").alias("text"))


def _digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Turns (key, role, text) in order to one digest per conversation; one turn is held at a time."""
    key, digest = None, None

    def made() -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array([key]), pa.array([digest.hexdigest()])], ["key", "sha256"])

    for batch in batches:
        for k, role, text in zip(*batch.columns):
            message = f"{role.as_py()}:{text.as_py()}".encode("utf-8", "surrogatepass")
            if digest is not None and k.as_py() == key:
                digest.update(b"\n")
            else:
                if digest is not None:
                    yield made()
                key, digest = k.as_py(), hashlib.sha256()
            digest.update(message)
    if digest is not None:
        yield made()


def digests(messages: DataFrame, conv: str = "conv_id") -> DataFrame:
    """``key`` and ``sha256`` of each conversation's ``role:text`` lines.

    A digest needs its bytes in order, so the turns of one conversation stream through one task.
    """
    named = messages.select(_key(conv).alias("key"), "place", "part", "role", "text")
    ordered = named.repartition("key").sortWithinPartitions("key", "place", "part")
    return ordered.select("key", "role", "text").mapInArrow(_digests, "key string, sha256 string")


def audited(rows: DataFrame, original: DataFrame, conv: str = "conv_id", **columns: str) -> DataFrame:
    """The audit and the digest of the repaired turns for every conversation of ``original``."""
    audits, messages = repair(rows, conv, **columns)
    numbers = ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")
    every = original.select(F.col(conv)).distinct().withColumn("key", _key(conv))
    found = every.join(audits.withColumn("key", _key(conv)).drop(conv), "key", "left").join(digests(messages, conv), "key", "left")
    return found.select(
        conv,
        *[F.coalesce(c, F.lit(0)).cast("bigint").alias(c) for c in numbers],
        F.coalesce("audit", F.lit("")).alias("audit"),
        F.coalesce("sha256", F.lit(hashlib.sha256(b"").hexdigest())).alias("repaired_sha256"),
    )
