"""Conversation structure repair: the cheapest edits that make the turns alternate, and of
those the ones whose audit, the initials of the edits in order, comes first.

Rows are kept (K), get another role (R), are deleted (D), or turns are inserted (I), so that
the role initials match ``(s?(ua)+)?``. A node is a row of a conversation together with what
came before it: nothing, a system, a user or an assistant turn.

1. *Cost.* Backwards over the rows, a node's cost is that of the cheapest way to the end.
2. *Ranks.* Nodes get ranks by their least audit of 1, 2, 4, … edits over arcs that keep to
   the cost: the rank of twice the length is that of the pair (own rank, rank of the node
   that many edits on), and that node is found by doubling the pointers.
3. *Path.* Of a node's arcs the one with the least (initial, rank of its end) is taken. The
   j-th edit of a path is found by the pointers of the binary digits of j.

All of this runs over the arrays of many conversations at once. Rows come in the order of
conversation and turn by a range shuffle, so a conversation that holds a third of the table
lies in many tasks, and there in pieces of ``PIECE`` rows. A piece is summed up as a 4 × 4
table of costs between its first and last nodes. These small tables, not the rows, meet in
one place, where costs go backwards over the pieces and the entered nodes forwards; then
each piece is repaired by itself.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerloom.llm.common import BLANKS, importable, staged

# Costs of the edits, and their initials in ASCII order.
KEEP, REROLE, DELETE, INSERT, CUT = 0, 1, 2, 5, 5
LETTERS = " DIKR"
D, I, K, R = 1, 2, 3, 4
PIECE = 4096  # rows
FLUSH_ROWS, FLUSH_CHARS = 8192, 4 << 20
FAR = 1 << 50  # no way

# What came before: nothing, system, user, assistant; and where a turn leads from there.
START, SYSTEM, USER, ASSISTANT = range(4)
NEXT = np.array([USER, USER, ASSISTANT, USER])  # the state after the user or assistant turn that fits
NAMES = [None, None, "user", "assistant"]
CLOSE = np.array([0, 2 * INSERT, INSERT, 0], np.int64)  # cost of what is missing at the end
OK, BLANK, DUPLICATE, TRUNCATED = range(4)

TURN = "struct<role:string,text:string>"
REPORT = [("gaps", "long"), ("blank", "long"), ("duplicate", "long"), ("truncated", "long"), ("illegal", "long"), ("cost", "long")]
PARTS = f"conv_id long, piece long, pieces long, {', '.join(f'{n} {t}' for n, t in REPORT)}, audit string, turns array<{TURN}>"
LEGAL = {"su", "ua", "au"}


def fault(role: str, text: str, seen: bool) -> int:
    """A row's first fault; ``seen``: the conversation had this role and text before."""
    own = text.rstrip(BLANKS)
    return BLANK if not own else DUPLICATE if seen else OK if own[-1] in ".!?" else TRUNCATED


def kept_state(role: str) -> np.ndarray:
    """Where keeping a row leads from each state; -1 where it doesn't fit."""
    first = role[:1]
    if first == "s":
        return np.array([SYSTEM, -1, -1, -1])
    if first == "u":
        return np.array([USER, USER, -1, USER])
    return np.array([-1, -1, ASSISTANT if first == "a" else -1, -1])


STATES = np.array([kept_state(x) for x in ("s", "u", "a", "")])
KINDS = {"s": 0, "u": 1, "a": 2}


class Rows:
    """Pieces of conversations, laid end to end: role kinds, faults, where pieces begin, and
    the cost of going on from each state after a piece."""

    def __init__(self, kinds: list[int], faults: list[int], sizes: list[int], after: np.ndarray, last: np.ndarray):
        self.kinds, self.faults = np.array(kinds, np.int64), np.array(faults, np.int64)
        self.sizes, self.after, self.last = np.array(sizes, np.int64), after, last
        self.begins = np.cumsum(self.sizes) - self.sizes
        must = (self.faults == BLANK) | (self.faults == DUPLICATE)
        cut = np.where(self.faults == TRUNCATED, CUT, 0)
        self.keep = np.where(must[:, None] | (STATES[self.kinds] < 0), FAR, KEEP + cut[:, None])
        self.rerole = np.where(must, FAR, REROLE + cut)
        self.to = np.maximum(STATES[self.kinds], 0)

    def arcs(self, rows: np.ndarray, then: np.ndarray) -> np.ndarray:
        """Costs by state of going on from these rows by D, K and R, where ``then`` is the
        cost by state after them."""
        kept = np.take_along_axis(then, self.to[rows], 1) + self.keep[rows]
        return np.stack([then + DELETE, kept, then[:, NEXT] + self.rerole[rows][:, None]])


def inserted(cost: np.ndarray) -> np.ndarray:
    """Costs by state when turns may be inserted as well."""
    cost = cost.copy()
    user, assistant = cost[:, USER].copy(), cost[:, ASSISTANT].copy()
    cost[:, USER] = np.minimum(user, assistant + INSERT)
    cost[:, ASSISTANT] = np.minimum(assistant, user + INSERT)
    cost[:, :USER] = np.minimum(cost[:, :USER], cost[:, [USER]] + INSERT)
    return cost


def costs(rows: Rows) -> np.ndarray:
    """The cost of every node (row, state), backwards through all pieces at once."""
    cost = np.zeros((len(rows.kinds), 4), np.int64)
    order = np.argsort(-rows.sizes, kind="stable")
    then, sizes = rows.after[order], rows.sizes[order]
    begins = rows.begins[order]
    for back in range(1, int(sizes.max(initial=0)) + 1):
        live = int(np.searchsorted(-sizes, -back, side="right"))  # pieces of at least that many rows
        at = begins[:live] + sizes[:live] - back
        now = inserted(rows.arcs(at, then[:live]).min(0))
        cost[at] = now
        then[:live] = now
    return cost


class Paths:
    """Least optimal paths from every node. Nodes are (row, state), then (end of a piece,
    state); at the end of a conversation what is missing is inserted."""

    def __init__(self, rows: Rows, cost: np.ndarray):
        n, pieces = len(cost), len(rows.sizes)
        final = np.where(rows.last[:, None], CLOSE, rows.after)
        all_costs = np.concatenate([cost, final])
        following = np.arange(1, n + 1)
        full = rows.sizes > 0
        following[(rows.begins + rows.sizes)[full] - 1] = n + np.flatnonzero(full)
        states = np.arange(4)
        ends = np.full((4, n + pieces, 4), -1)  # by edit: the node it leads to, if that keeps to the cost
        then = all_costs[following]
        for edit, way, state in zip((D, K, R), rows.arcs(np.arange(n), then), (states[None], rows.to, NEXT[None])):
            ends[edit - 1, :n] = np.where(way == cost, following[:, None] * 4 + state, -1)
        own = np.arange(n + pieces)[:, None] * 4
        may = all_costs == all_costs[:, NEXT] + INSERT
        may[n:] &= rows.last[:, None]
        ends[I - 1] = np.where(may, own + NEXT, -1)
        self.ends = ends.reshape(4, -1)
        self.first_end = 4 * n
        self._rank()

    def _least(self, rank: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """By node the arc with the least (initial, rank of its end): initial and end. A
        node without arcs leads to itself and has the initial 0."""
        size = len(rank) + 1
        keys = np.where(self.ends >= 0, np.arange(1, 5)[:, None] * size + rank[self.ends], 5 * size)
        best = keys.argmin(0)
        stops = keys.min(0) == 5 * size
        own = np.arange(len(rank))
        return np.where(stops, 0, best + 1), np.where(stops, own, self.ends[best, own])

    def _rank(self) -> None:
        rank = np.zeros(self.ends.shape[1], np.int64)
        self.initial, pointer = self._least(rank)
        rank, self.pointers = self.initial, [pointer]
        while self.initial[pointer].any():  # some path goes on behind that many edits
            _, rank = np.unique(rank * (int(rank.max()) + 1) + rank[pointer], return_inverse=True)
            pointer = pointer[pointer]
            self.pointers.append(pointer)
        # arcs of a node have different initials, so this is the arc whose pointer was doubled
        self.initial, self.pointers[0] = self._least(rank)

    def walk(self, starts: np.ndarray) -> tuple[list[str], np.ndarray]:
        """The audits of the paths from some nodes, and the nodes they end at."""
        length = np.zeros(len(starts), np.int64)
        last = starts.copy()
        for bit in reversed(range(len(self.pointers))):
            step = self.pointers[bit][last]
            moves = self.initial[step] > 0  # that many edits on, the path still goes on
            length, last = length + (moves << bit), np.where(moves, step, last)
        goes = self.initial[last] > 0
        length, last = length + goes, self.pointers[0][last]
        which = np.repeat(np.arange(len(starts)), length)
        number = np.arange(len(which)) - np.repeat(np.cumsum(length) - length, length)
        nodes = starts[which]
        for bit, pointer in enumerate(self.pointers):
            nodes = np.where(number >> bit & 1, pointer[nodes], nodes)
        letters = np.frombuffer(LETTERS.encode(), np.uint8)[self.initial[nodes]].tobytes().decode()
        cuts = np.concatenate([[0], np.cumsum(length)]).tolist()
        return [letters[a:b] for a, b in zip(cuts, cuts[1:])], last


def replay(roles: list[str], texts: list[str], audit: str, state: int) -> list[tuple[str, str]]:
    """The turns that an audit makes of some rows, from a state on."""
    turns, at = [], 0
    for edit in audit:
        if edit == "I":
            state = int(NEXT[state])
            turns.append((NAMES[state], ""))
            continue
        if edit == "K":
            turns.append((roles[at], texts[at]))
            state = int(STATES[KINDS[roles[at][:1]]][state])
        elif edit == "R":
            state = int(NEXT[state])
            turns.append((NAMES[state], texts[at]))
        at += 1
    return turns


class Piece:
    """Rows of one conversation, in order."""

    def __init__(self, conv_id: int | None, turns=(), roles=(), texts=(), seen=None):
        self.conv_id, self.turns, self.roles, self.texts = conv_id, list(turns), list(roles), list(texts)
        self.seen = seen or set()  # places of rows that an earlier piece holds
        self.chars = 0

    def add(self, turn: int | None, role: str, text: str) -> None:
        self.turns.append(turn), self.roles.append(role), self.texts.append(text)
        self.chars += len(text)

    def faults(self) -> list[int]:
        known: set = set()
        found = []
        for place, row in enumerate(zip(self.roles, self.texts)):
            found.append(fault(*row, row in known or place in self.seen))
            known.add(row)
        return found

    def kinds(self) -> list[int]:
        return [KINDS.get(r[:1], 3) for r in self.roles]

    def summary(self, faults: list[int]) -> dict:
        turns = [t for t in self.turns if t is not None]
        initials = [r[:1] for r in self.roles]
        return {
            "rows": len(self.roles), "low": min(turns, default=None), "high": max(turns, default=None), "distinct": len(set(turns)),
            "blank": faults.count(BLANK), "duplicate": faults.count(DUPLICATE), "truncated": faults.count(TRUNCATED),
            "illegal": sum(a + b not in LEGAL for a, b in zip(initials, initials[1:])),
            "first": initials[0] if initials else None, "last": initials[-1] if initials else None,
        }


def _gaps(low: int | None, high: int | None, distinct: int) -> int:
    return 0 if low is None else high - low + 1 - distinct


def _turn_lists(lists: list[list[tuple[str, str]]]) -> pa.Array:
    flat = [t for own in lists for t in own]
    offsets = np.concatenate([[0], np.cumsum([len(own) for own in lists])]).astype(np.int32)
    rows = pa.StructArray.from_arrays([pa.array([t[i] for t in flat], pa.string()) for i in (0, 1)], ["role", "text"])
    return pa.ListArray.from_arrays(pa.array(offsets), rows)


def _solved(pieces: list[Piece]) -> pa.RecordBatch:
    """Conversations of one piece each, repaired: rows of ``PARTS``."""
    faults = [p.faults() for p in pieces]
    rows = Rows(
        [k for p in pieces for k in p.kinds()], [f for own in faults for f in own], [len(p.roles) for p in pieces],
        np.tile(CLOSE, (len(pieces), 1)), np.ones(len(pieces), bool),
    )
    cost = costs(rows)
    paths = Paths(rows, cost)
    starts = np.where(rows.sizes > 0, rows.begins * 4, paths.first_end + np.arange(len(pieces)) * 4) + START
    audits, _ = paths.walk(starts)
    facts = [p.summary(f) for p, f in zip(pieces, faults)]
    total = np.zeros(len(pieces), np.int64)
    total[rows.sizes > 0] = cost[rows.begins[rows.sizes > 0], START]
    columns = [
        pa.array([p.conv_id for p in pieces], pa.int64()), pa.array([0] * len(pieces), pa.int64()), pa.array([1] * len(pieces), pa.int64()),
        pa.array([_gaps(f["low"], f["high"], f["distinct"]) for f in facts], pa.int64()),
        *[pa.array([f[n] for f in facts], pa.int64()) for n in ("blank", "duplicate", "truncated", "illegal")],
        pa.array(total), pa.array(audits, pa.string()),
        _turn_lists([replay(p.roles, p.texts, a, START) for p, a in zip(pieces, audits)]),
    ]
    return pa.RecordBatch.from_arrays(columns, names=[c.split()[0] for c in PARTS.split(", ")[: len(columns)]])


# First pass: finished conversations as they will be returned, or the rows of a piece.
_FIRST = PARTS + f", place long, numbers array<bigint>, rows array<{TURN}>"
_NAMES = [c.split()[0] for c in _FIRST.split(", ")]
_SOLVED = len(_NAMES) - 3


def _first_pass(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Conversations that begin and end within the task are repaired at once. The task's
    first and last may go on elsewhere, and those of more than a piece do not end within
    one: their pieces are passed on, numbered in order of task and place."""
    from pyspark import TaskContext

    place = TaskContext.get().partitionId() << 32
    kinds = [pa.int64()] * 9 + [pa.string(), _turn_lists([]).type]
    done: list[Piece] = []
    piece, opened, cut = None, 0, False  # conversations begun so far; the current one has had a piece

    def finished() -> pa.RecordBatch:
        solved = _solved(done)
        empty = [pa.nulls(len(done), t) for t in (pa.int64(), pa.list_(pa.int64()), _turn_lists([]).type)]
        done.clear()
        return pa.RecordBatch.from_arrays([*solved.columns, *empty], _NAMES)

    def passed_on(p: Piece) -> pa.RecordBatch:
        nonlocal place
        place += 1
        columns = [pa.nulls(1, t) for t in kinds]
        columns[0] = pa.array([p.conv_id], pa.int64())
        rows = [pa.array([place], pa.int64()), pa.array([p.turns], pa.list_(pa.int64())), _turn_lists([list(zip(p.roles, p.texts))])]
        return pa.RecordBatch.from_arrays([*columns, *rows], _NAMES)

    held = 0
    for batch in batches:
        for conv_id, turn, role, text, there in zip(*(batch.column(i).to_pylist() for i in range(5))):
            if piece is None or conv_id != piece.conv_id:
                if piece is not None:
                    if cut or opened == 1:
                        yield passed_on(piece)
                    else:
                        done.append(piece)
                        held += piece.chars
                        if len(done) * 8 >= FLUSH_ROWS or held >= FLUSH_CHARS:
                            yield finished()
                            held = 0
                piece, cut, opened = Piece(conv_id), False, opened + 1
            if len(piece.roles) == PIECE or piece.chars >= FLUSH_CHARS:
                yield passed_on(piece)
                piece, cut = Piece(conv_id), True
            if there:
                piece.add(turn, role, text)
    if done:
        yield finished()
    if piece is not None:
        yield passed_on(piece)


def ordered(rows: DataFrame) -> DataFrame:
    """Rows by conversation and turn, over ranges of equal size: a long conversation is
    split. Rows of one turn go by role and text."""
    begins = F.left(F.concat("role", F.lit(" "), "text"), F.lit(64))
    return rows.repartitionByRange("conv_id", "turn", begins).sortWithinPartitions("conv_id", "turn", begins, "role", "text")


def repair(conversations: DataFrame, there: Column | None = None) -> DataFrame:
    """Repair every conversation: conv_id, piece (from 0), pieces, gaps, blank, duplicate,
    truncated, illegal, cost, audit, turns (role and text).

    A conversation is one row, unless it is longer than a piece: then audit and turns are
    those of the piece, and all else is that of the conversation. ``whole`` joins them.

    Null roles and texts are one space. Rows without a turn number come first, rows with
    the same one in order of role and text. Repeated rows are duplicates. A null conv_id is
    a conversation. Rows for which ``there`` is not true are no turns, but their
    conversation is returned. A role whose initial is none of s, u, a, also an empty one,
    can't be kept. An empty table gives no rows; other columns don't matter.
    """
    importable(conversations.sparkSession)
    shown = F.lit(True) if there is None else F.coalesce(there, F.lit(False))
    text = lambda name: F.coalesce(F.col(f"`{name}`").cast("string"), F.lit(" ")).alias(name)
    own = conversations.select(F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"), text("role"), text("text"), shown.alias("there"))
    found = staged(ordered(own).mapInArrow(_first_pass, _FIRST), "repair", compression="zstd")
    solved = found.filter(F.col("place").isNull()).select(*_NAMES[:_SOLVED])
    return solved.unionByName(_joined_pieces(found.filter(F.col("place").isNotNull()).select("conv_id", "place", "numbers", "rows")))


def _seen(pieces: DataFrame) -> DataFrame:
    """Per piece the places of rows whose role and text stand in an earlier piece. Only
    digests are grouped, so a text that a conversation repeats is one row per task."""
    each = pieces.select("conv_id", "place", F.posexplode("rows").alias("at", "row"))
    digest = F.sha2(F.concat(F.octet_length("row.role").cast("string"), F.lit(":"), F.col("row.role"), F.col("row.text")), 256)
    local = each.groupBy("conv_id", "place", digest.alias("digest")).agg(F.collect_list("at").alias("ats"))
    firsts = local.groupBy("conv_id", "digest").agg(F.min("place").alias("first"), F.count("*").alias("n")).filter("n > 1")
    firsts = firsts.select(F.col("conv_id").alias("own_id"), F.col("digest").alias("own_digest"), "first")
    again = local.join(firsts, F.col("conv_id").eqNullSafe(F.col("own_id")) & (F.col("digest") == F.col("own_digest")) & (F.col("place") > F.col("first")))
    return again.groupBy("place").agg(F.flatten(F.collect_list("ats")).alias("seen"))


_FACTS = "rows long, low long, high long, distinct long, blank long, duplicate long, truncated long, illegal long, first string, last string"


def _summed_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Per piece: its counts, and the costs from each state before to each state after it."""
    names = [c.split()[0] for c in _FACTS.split(", ")]
    for batch in batches:
        for p, place, _ in _pieces(batch):
            faults = p.faults()
            table = []
            for state in range(4):  # costs to end in this state, by the state before
                after = np.full((1, 4), FAR)
                after[0, state] = 0
                rows = Rows(p.kinds(), faults, [len(p.roles)], after, np.zeros(1, bool))
                table.append(costs(rows)[0] if len(p.roles) else after[0])
            facts = p.summary(faults)
            columns = [pa.array([p.conv_id], pa.int64()), pa.array([place], pa.int64())]
            columns += [pa.array([facts[n]], pa.string() if n in ("first", "last") else pa.int64()) for n in names]
            columns.append(pa.array([np.minimum(np.array(table), FAR).T.ravel().tolist()], pa.list_(pa.int64())))
            yield pa.RecordBatch.from_arrays(columns, ["conv_id", "place", *names, "steps"])


def _pieces(batch: pa.RecordBatch) -> Iterator[tuple[Piece, int, dict]]:
    for row in batch.to_pylist():
        roles, texts = [r["role"] for r in row["rows"]], [r["text"] for r in row["rows"]]
        yield Piece(row["conv_id"], row["numbers"], roles, texts, set(row["seen"] or ())), row["place"], row


_PLAN = f"conv_id long, place long, piece long, pieces long, {', '.join(f'{n} {t}' for n, t in REPORT)}, after array<bigint>"


def _planned(table: pa.Table) -> pa.Table:
    """The pieces of a conversation in order, their counts added up and the costs after each
    piece: a few numbers a piece, not its rows."""
    pieces = sorted(table.to_pylist(), key=lambda p: p["place"])
    after, then = [], CLOSE
    for piece in reversed(pieces):
        after.append(then.tolist())
        then = np.minimum((np.array(piece["steps"], np.int64).reshape(4, 4) + then[None, :]).min(1), FAR)
    real = [p for p in pieces if p["rows"]]
    named = [p for p in real if p["low"] is not None]
    shared = sum(a["high"] == b["low"] for a, b in zip(named, named[1:]))
    low, high = (named[0]["low"], named[-1]["high"]) if named else (None, None)
    facts = {n: sum(p[n] for p in pieces) for n in ("blank", "duplicate", "truncated", "illegal")}
    facts["illegal"] += sum(a["last"] + b["first"] not in LEGAL for a, b in zip(real, real[1:]))
    facts |= {"gaps": _gaps(low, high, sum(p["distinct"] for p in named) - shared), "cost": int(then[START])}
    count = len(pieces)
    columns = [[p["conv_id"] for p in pieces], [p["place"] for p in pieces], list(range(count)), [count] * count]
    columns += [[facts[n]] * count for n, _ in REPORT]
    arrays = [pa.array(c, pa.int64()) for c in columns] + [pa.array(after[::-1], pa.list_(pa.int64()))]
    return pa.Table.from_arrays(arrays, [c.split()[0] for c in _PLAN.split(", ")])


def _walked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Per piece, for each state before it: the least audit and the state after."""
    for batch in batches:
        for p, place, row in _pieces(batch):
            after = np.array([row["after"]], np.int64)
            rows = Rows(p.kinds(), p.faults(), [len(p.roles)], after, np.array([row["piece"] == row["pieces"] - 1]))
            paths = Paths(rows, costs(rows))
            first = 0 if len(p.roles) else paths.first_end
            audits, last = paths.walk(first + np.arange(4))
            exits = ((last - paths.first_end) % 4).tolist()
            yield pa.RecordBatch.from_arrays(
                [pa.array([p.conv_id], pa.int64()), pa.array([place], pa.int64()), pa.array([audits]), pa.array([exits], pa.list_(pa.int64()))],
                ["conv_id", "place", "audits", "exits"],
            )


def _entered(table: pa.Table) -> pa.Table:
    """The state before each piece of a conversation."""
    pieces = sorted(table.to_pylist(), key=lambda p: p["place"])
    states, state = [], START
    for piece in pieces:
        states.append(state)
        state = piece["exits"][state]
    return pa.table({"place": pa.array([p["place"] for p in pieces], pa.int64()), "state": pa.array(states, pa.int32())})


def _replayed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    names = [c.split()[0] for c in PARTS.split(", ")][: 3 + len(REPORT)]
    for batch in batches:
        for row in batch.to_pylist():
            roles, texts = [r["role"] for r in row["rows"]], [r["text"] for r in row["rows"]]
            turns = replay(roles, texts, row["audit"], row["state"])
            columns = [pa.array([row[n]], pa.int64()) for n in names] + [pa.array([row["audit"]], pa.string()), _turn_lists([turns])]
            yield pa.RecordBatch.from_arrays(columns, _NAMES[:_SOLVED])


def _joined_pieces(pieces: DataFrame) -> DataFrame:
    """Repair conversations that lie in more than one piece or task."""
    marked = staged(pieces.join(_seen(pieces), "place", "left"), "repair-pieces", compression="zstd")
    summed = marked.select("conv_id", "place", "numbers", "rows", "seen").mapInArrow(_summed_up, f"conv_id long, place long, {_FACTS}, steps array<bigint>")
    plan = staged(summed.groupBy("conv_id").applyInArrow(_planned, _PLAN), "repair-plan")
    ready = marked.join(plan.drop("conv_id"), "place")
    walked = staged(ready.mapInArrow(_walked, "conv_id long, place long, audits array<string>, exits array<bigint>"), "repair-walks")
    entered = walked.select("conv_id", "place", "exits").groupBy("conv_id").applyInArrow(_entered, "place long, state int")
    audits = walked.join(entered, "place").select("place", "state", F.col("audits")[F.col("state")].alias("audit"))
    return ready.join(audits, "place").mapInArrow(_replayed, PARTS)


def whole(parts: DataFrame) -> DataFrame:
    """Rows of ``repair`` with the pieces of a conversation put together; here a conversation
    has to fit into a row."""
    report = [n for n, _ in REPORT]
    alone = parts.filter("pieces = 1").select("conv_id", *report, "audit", "turns")
    pieces = parts.filter("pieces > 1").groupBy("conv_id", *report).agg(F.sort_array(F.collect_list(F.struct("piece", "audit", "turns"))).alias("all"))
    return alone.unionByName(pieces.select("conv_id", *report, F.array_join("all.audit", "").alias("audit"), F.flatten("all.turns").alias("turns")))


def damaged(conversations: DataFrame) -> DataFrame:
    """The damage that the query repairs, by the checksum of conversation and turn: rows
    that are dropped, emptied, cut, repeated or put into the user's mouth. Dropped rows stay
    as rows that are not ``there``."""
    rows = conversations.select(*[F.coalesce(F.col(c).cast("string"), F.lit(" ")).alias(f"{c}_text") for c in ("conv_id", "turn", "role", "text")], "conv_id", "turn")
    kind = F.crc32(F.concat("conv_id_text", F.lit(":"), "turn_text").cast("binary")) % 20
    text = F.when(kind == 1, F.lit("")).when(kind == 2, F.regexp_replace("text_text", "[.!?]", "")).otherwise(F.col("text_text"))
    role = F.when(kind == 4, F.lit("user")).otherwise(F.col("role_text"))
    copies = F.explode(F.when(kind == 3, F.array(F.lit(1), F.lit(2))).otherwise(F.array(F.lit(1))))
    return rows.select("conv_id", "turn", role.alias("role"), text.alias("text"), (kind != 0).alias("there"), copies.alias("copy")).drop("copy")


def digests(conversations: DataFrame) -> DataFrame:
    """Damage the conversations, repair them, and give the figures of each."""
    rows = damaged(conversations)
    fixed = whole(repair(rows, F.col("there")))
    lines = F.transform("turns", lambda t: F.concat(t["role"], F.lit(":"), t["text"]))
    return fixed.select("conv_id", *[n for n, _ in REPORT], "audit", F.sha2(F.array_join(lines, "\n"), 256).alias("repaired_sha256"))
