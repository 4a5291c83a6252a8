"""Repair of conversations: the cheapest edits after which the roles read ``(system? (user assistant)+)?``.

The edits of a conversation come from a Viterbi search over the last role put out. Its survivors are leaves of a tree of
backpointers with reference counts; whatever all survivors have in common is put out at once and forgotten, so that only the
part they still disagree on is held, as letters without texts. Equal costs are decided by the whole strings of edits.

A conversation of any length is spread over the tasks that its rows fall into by range. Every such piece is searched from
each role it may begin in; the costs and the order of the outcomes, a few numbers a piece, decide which way the whole
conversation takes, and the pieces are then edited at the same time.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import DataType, StructField, StructType

from paperloom.session import shared_dir

KEEP, REROLE, DELETE, INSERT = "K", "R", "D", "I"
COSTS = {KEEP: 0, REROLE: 3, DELETE: 4, INSERT: 3}
TRUNCATED_COST = 3
ORDERLY = ("su", "ua", "au")

# What has been put out so far: nothing, a system turn, a user turn last, an assistant turn last.
_START, _SYSTEM, _USER, _ASSISTANT = range(4)
_STATES = 4
_NAMES = {_USER: "user", _ASSISTANT: "assistant"}
#: Inserts before the end, by the last role; after a lone system turn a whole pair.
_CLOSING = {_START: "", _SYSTEM: INSERT * 2, _USER: INSERT, _ASSISTANT: ""}
# From any state the rest of any other state's way costs at most this much more: two inserts, or a deleted system turn and an insert.
_DETOUR = 7
_BLANKS = "\t\n\x0b\f\r "
_ROWS = 512


def _inserted(state: int) -> int:
    return _ASSISTANT if state == _USER else _USER


def _kept(state: int, initial: str) -> int | None:
    """The state after a turn with this initial, if the turn may stand there."""
    if initial == "s":
        return _SYSTEM if state == _START else None
    if initial == "u":
        return None if state == _USER else _USER
    return _ASSISTANT if initial == "a" and state == _USER else None


@lru_cache(None)
def _edges(initial: str, fault: str | None) -> tuple[tuple[tuple[int, str] | None, ...], ...]:
    """For each state before and after a row, the cheapest edits of the row and the inserts in front of it, ties the least letters."""
    gone = fault in ("blank", "duplicate")
    kept_cost = TRUNCATED_COST if fault == "truncated" else 0
    found: list[list[tuple[int, str] | None]] = [[None] * _STATES for _ in range(_STATES)]
    for first in range(_STATES):
        state, letters, cost = first, "", 0
        for _ in range(3):
            ways = [(state, DELETE, COSTS[DELETE])]
            if not gone:
                ways.append((_inserted(state), REROLE, COSTS[REROLE] + kept_cost))
                after = _kept(state, initial)
                if after is not None:
                    ways.append((after, KEEP, COSTS[KEEP] + kept_cost))
            for after, letter, more in ways:
                way = (cost + more, letters + letter)
                if found[first][after] is None or way < found[first][after]:
                    found[first][after] = way
            state, letters, cost = _inserted(state), letters + INSERT, cost + COSTS[INSERT]
    return tuple(tuple(x) for x in found)


@lru_cache(100_000)
def _step(survivors: tuple, initial: str, fault: str | None) -> tuple:
    """One row for survivors (cost above the least, rank, or None by state).

    Returns the survivors after it, the rise of the least cost, and for each state (state before, letters). Ranks order the complete
    strings of edits. Strings of two survivors end in an edit of the same row, so that none begins the other, and an
    edit more or less never turns their order: comparing (rank before, letters) compares them whole.
    """
    edges = _edges(initial, fault)
    best: list[tuple | None] = [None] * _STATES
    for before, known in enumerate(survivors):
        if known is None:
            continue
        for after in range(_STATES):
            if edges[before][after] is not None:
                cost, letters = edges[before][after]
                way = (known[0] + cost, known[1], letters, before)
                if best[after] is None or way < best[after]:
                    best[after] = way
    least = min(w[0] for w in best if w)
    best = [w if w and w[0] <= least + _DETOUR else None for w in best]
    order = sorted((w[1], w[2], s) for s, w in enumerate(best) if w)
    rank = {s: i for i, (_, _, s) in enumerate(order)}
    return tuple((w[0] - least, rank[s]) if w else None for s, w in enumerate(best)), least, tuple((w[3], w[2]) if w else None for w in best)


def _begin(state: int) -> tuple:
    return tuple((0, 0) if s == state else None for s in range(_STATES))


def _last_state(survivors: tuple) -> int:
    """The survivor that ends best, its closing inserts included."""
    ends = [(known[0] + len(_CLOSING[s]) * COSTS[INSERT], known[1], s) for s, known in enumerate(survivors) if known]
    return min(ends)[2]


class _Node:
    """A row's edits on the way of some survivors. ``count`` says how many nodes or survivors build on it."""

    __slots__ = ("parent", "kids", "count", "at", "state", "letters")

    def __init__(self, parent: _Node | None, at: int, state: int, letters: str):
        self.parent, self.kids, self.count, self.at, self.state, self.letters = parent, [], 0, at, state, letters
        if parent is not None:
            parent.kids.append(self)
            parent.count += 1


class Survivors:
    """The search through one piece of a conversation, from a given state.

    ``feed`` takes a row and returns the edits that have become certain, ``finish`` the rest: (row number, state before, letters).
    """

    def __init__(self, state: int = _START):
        self.root = _Node(None, -1, state, "")
        self.known = _begin(state)
        self.leaves: list[_Node | None] = [self.root if s == state else None for s in range(_STATES)]
        self.root.count = 1

    def _drop(self, node: _Node | None) -> None:
        while node is not None:
            node.count -= 1
            if node.count or node.parent is None:
                return
            node.parent.kids.remove(node)
            node = node.parent

    def _certain(self) -> list[tuple[int, int, str]]:
        """Edits below the root that all survivors share."""
        found = []
        while self.root.count == 1 and self.root.kids:
            child = self.root.kids[0]
            found.append((child.at, child.state, child.letters))
            child.parent = None
            self.root = child
        return found

    def feed(self, at: int, initial: str, fault: str | None) -> list[tuple[int, int, str]]:
        self.known, _, ways = _step(self.known, initial, fault)
        old = self.leaves
        self.leaves = [_Node(old[way[0]], at, way[0], way[1]) if way else None for way in ways]
        for leaf in self.leaves:
            if leaf is not None:
                leaf.count += 1
        for leaf in old:
            if leaf is not None:
                self._drop(leaf)
        return self._certain()

    def finish(self, state: int | None = None) -> list[tuple[int, int, str]]:
        """The way that ends in ``state``, or else the best one."""
        chosen = _last_state(self.known) if state is None else state
        for s, leaf in enumerate(self.leaves):
            if leaf is not None and s != chosen:
                self._drop(leaf)
        self.leaves = [leaf if s == chosen else None for s, leaf in enumerate(self.leaves)]
        return self._certain()


def fault_of(text: Column) -> Column:
    """``blank``, ``truncated`` or null. Duplicates are found beside other rows."""
    end = F.substring(F.rtrim(text, F.lit(_BLANKS)), -1, 1)
    return F.when(F.rtrim(text, F.lit(_BLANKS)) == "", "blank").when(~end.isin(".", "!", "?"), "truncated")


def _ordered(turns: DataFrame) -> DataFrame:
    """Turns by conversation and turn, dealt by range, with marks in front of those whose role and text came in an earlier turn.

    Marks come from lean rows without texts, so that texts move once. Equal rows of one turn lie side by side and need none.
    """
    turns = turns.withColumn("digest", F.unhex(F.md5("text")))
    lean = turns.select("conv", "role", "digest", F.struct(F.col("turn").isNotNull().alias("given"), "turn").alias("moment"))
    said = lean.groupBy("conv", "role", "digest").agg(F.min("moment").alias("first"), F.max("moment").alias("last"))
    again = said.where("first <> last")
    marks = lean.alias("x").join(again.alias("y"), F.col("x.conv").eqNullSafe(F.col("y.conv")) & (F.col("x.role") == F.col("y.role")) & (F.col("x.digest") == F.col("y.digest")))
    marks = marks.where("moment > first").select("x.conv", F.col("moment.turn").alias("turn"), "x.role", "x.digest").distinct()
    rows = turns.withColumn("mark", F.lit(0)).unionByName(marks.withColumn("mark", F.lit(1)), allowMissingColumns=True)
    order = [F.col("conv").asc_nulls_first(), F.col("turn").asc_nulls_first(), "role", "digest"]
    dealt = rows.repartitionByRange(*order).sortWithinPartitions(*order, F.col("mark").desc())
    return dealt.withColumn("part", F.spark_partition_id())


def _turns(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
    """(part, conversation, is it new, turn, role, text, fault) in order; marks become the fault ``duplicate``."""
    current, marked, before, begun = None, None, None, False
    for batch in batches:
        names = ("part", "conv", "turn", "role", "text", "fault", "digest", "mark")
        for part, conv, turn, role, text, fault, digest, mark in zip(*(batch.column(n).to_pylist() for n in names)):
            new = not begun or conv != current
            same = (turn, role, digest)
            if mark:
                marked = (conv, *same)
                continue
            if fault != "blank" and (marked == (conv, *same) or not new and before == same):
                fault = "duplicate"
            current, before, begun = conv, same, True
            yield part, conv, new, turn, role, text, fault


def _batches(rows: list[tuple], schema: StructType) -> Iterator[pa.RecordBatch]:
    """The rows, which are then taken out of the list."""
    types = to_arrow_schema(schema)
    while rows:
        part, rows[:_ROWS] = rows[:_ROWS], []
        yield pa.RecordBatch.from_arrays([pa.array(list(c), t.type) for c, t in zip(zip(*part), types)], types.names)


def _typed(name: str, kind: DataType, ddl: str) -> StructType:
    return StructType([StructField(name, kind), *StructType.fromDDL(ddl)])


def _summaries(schema: StructType):
    """Of every piece, from each state: cost and rank of every state it can end in. And the initial of its last role."""

    def task(batches):
        found, held = [], None

        def row(part, conv, runs, last):
            return conv, part, [x for known, rise in runs for k in known for x in ((rise + k[0], k[1]) if k else (-1, -1))], last

        for part, conv, new, _, role, _, fault in _turns(batches):
            if new:
                if held is not None:
                    found.append(row(*held))
                held = (part, conv, [(_begin(s), 0) for s in range(_STATES)], "")
            runs = []
            for known, rise in held[2]:
                known, more, _ = _step(known, role[:1], fault)
                runs.append((known, rise + more))
            held = (part, conv, runs, role[:1])
        if held is not None:
            found.append(row(*held))
        yield from _batches(found, schema)

    return task


def _route(pieces: list) -> list[tuple[int, int | None, str]]:
    """For the pieces of one conversation, in order: the state each begins in, the one it ends in (None: the best), the initial before it."""
    known, backs = _begin(_START), []
    for piece in pieces:
        best: list[tuple | None] = [None] * _STATES
        for before, have in enumerate(known):
            for after in range(_STATES):
                cost, rank = piece["ends"][8 * before + 2 * after : 8 * before + 2 * after + 2]
                if have is not None and cost >= 0:
                    way = (have[0] + cost, have[1], rank, before)
                    if best[after] is None or way < best[after]:
                        best[after] = way
        order = sorted((w[1], w[2], s) for s, w in enumerate(best) if w)
        ranks = {s: i for i, (_, _, s) in enumerate(order)}
        known = tuple((w[0], ranks[s]) if w else None for s, w in enumerate(best))
        backs.append([w[3] if w else None for w in best])
    state, after, found = _last_state(known), None, []
    for number in range(len(pieces) - 1, -1, -1):
        before = backs[number][state]
        found.append((before, after, pieces[number - 1]["last"] if number else ""))
        state = after = before
    return found[::-1]


def _routes(rows: DataFrame) -> dict:
    """By (part, conversation), how the pieces of conversations that go over several partitions begin and end.

    A partition has two such pieces at most, at its ends, so that the driver sees a few numbers a partition.
    """
    kind = rows.schema["conv"].dataType
    spot = F.struct(F.col("conv").isNotNull().alias("given"), "conv")
    edges = rows.groupBy("part").agg(F.min(spot).alias("low"), F.max(spot).alias("high")).orderBy("part").collect()
    split = {(e["part"], e["high"]["conv"]) for e, f in zip(edges, edges[1:]) if e["high"] == f["low"]}
    split |= {(f["part"], f["low"]["conv"]) for e, f in zip(edges, edges[1:]) if e["high"] == f["low"]}
    if not split:
        return {}
    asked = rows.sparkSession.createDataFrame([(conv, part) for part, conv in split], _typed("conv", kind, "part int")).alias("y")
    same = (F.col("x.part") == F.col("y.part")) & F.col("x.conv").eqNullSafe(F.col("y.conv"))
    held = rows.alias("x").join(F.broadcast(asked), same, "left_semi")
    schema = _typed("conv", kind, "part int, ends array<long>, last string")
    pieces: dict = {}
    for piece in held.mapInArrow(_summaries(schema), schema).orderBy("part").collect():
        pieces.setdefault(piece["conv"], []).append(piece)
    return {(p["part"], conv): way for conv, own in pieces.items() for p, way in zip(own, _route(own))}


_ROW, _EDIT, _END = 1, 0, 2


def _searched(routes: dict, schema: StructType):
    """Rows as they come, and their edits as they become certain; sorted by (at, kind) an edit stands before its row."""

    def task(batches):
        found: list[tuple] = []
        at, search, way, last = -1, None, None, ""
        nothing = (None,) * 5

        def finish(conv):
            found.extend((conv, p, _EDIT, state, letters, *nothing) for p, state, letters in search.finish(way[1]))
            if way[1] is None:
                state = _last_state(search.known)
                if _CLOSING[state]:
                    found.append((conv, at, _END, state, _CLOSING[state], *nothing))

        held = None
        for part, conv, new, turn, role, text, fault in _turns(batches):
            if new:
                if search is not None:
                    finish(held)
                way = routes.get((part, conv), (_START, None, ""))
                search, last, held = Survivors(way[0]), way[2], conv
            at += 1
            pair = last + role[:1]
            loose = pair not in ORDERLY and not (new and last == "" and way[0] == _START and way[2] == "")
            found.append((conv, at, _ROW, None, None, turn, role, text, fault, loose))
            found.extend((conv, p, _EDIT, state, letters, *nothing) for p, state, letters in search.feed(at, role[:1], fault))
            last = role[:1]
            if len(found) >= _ROWS:
                yield from _batches(found, schema)
        if search is not None:
            finish(held)
        yield from _batches(found, schema)

    return task


def _applied(schema: StructType):
    """Rows with their edits, inserted turns between them."""

    def task(batches):
        found: list[tuple] = []
        held = None
        for batch in batches:
            for conv, part, at, kind, state, letters, turn, role, text, fault, loose in zip(*(c.to_pylist() for c in batch.columns)):
                place = (part << 43) + 8 * at
                if kind == _EDIT:
                    held = (state, letters)
                    continue
                if kind == _END:
                    held, place = (state, letters), place + 4
                for letter in held[1]:
                    state = held[0]
                    if letter == INSERT:
                        state = _inserted(state)
                        found.append((conv, place, INSERT, None, _NAMES[state], "", None, None))
                    elif letter == REROLE:
                        found.append((conv, place, REROLE, turn, _NAMES[_inserted(state)], text, fault, loose))
                    else:
                        found.append((conv, place, letter, turn, role, text, fault, loose))
                    held, place = (state, letters), place + 1
            yield from _batches(found, schema)

    return task


def repair(conversations: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """The edits of every conversation in order: (conv, place, edit, turn, role, text, fault, loose), a row for each.

    ``place`` orders the rows of a conversation. ``edit`` is K (kept), R (other role, which is given), D (deleted; role and text as they
    were) or I (inserted, text empty, no turn). ``fault`` is the first that holds of blank, duplicate (role and text stood before) and
    truncated; ``loose`` says that the roles of the row and the one before do not follow each other. Blank and duplicate turns are
    deleted. Edits are the cheapest ones (``COSTS``, and ``TRUNCATED_COST`` for a truncated turn that stays), ties the least string of letters.

    Null roles and texts count as one space. Turns go by number, null first; several rows of one number by role and digest of the text,
    equal ones side by side. Conversations with a null id are one conversation. Roles count by their first letter; an empty role stands
    nowhere. Other columns are left out; an empty table gives no rows.

    Rows move once, by range, and are stored; a conversation may go over any number of partitions. A task holds letters of the edits that
    are not yet certain, and no texts beside a batch. Equal rows of one turn number of one conversation stay in one partition.
    """
    shared_dir(conversations.sparkSession)
    space = F.lit(" ")
    turns = conversations.select(F.col(conv).alias("conv"), F.col(turn).alias("turn"), F.coalesce(role, space).alias("role"), F.coalesce(text, space).alias("text"))
    rows = _ordered(turns.withColumn("fault", fault_of(F.col("text")))).checkpoint()
    kinds = {f.name: f.dataType for f in rows.schema}
    own = StructType([StructField("turn", kinds["turn"]), *StructType.fromDDL("role string, text string, fault string, loose boolean")])
    searched = StructType([*_typed("conv", kinds["conv"], "at long, kind int, state int, letters string"), *own])
    found = rows.mapInArrow(_searched(_routes(rows), searched), searched)
    # No exchange since the rows were stored: their partition is this one.
    found = found.withColumn("part", F.spark_partition_id().cast("long")).sortWithinPartitions("at", "kind")
    final = StructType([*_typed("conv", kinds["conv"], "place long, edit string"), *own])
    found = found.select("conv", "part", "at", "kind", "state", "letters", "turn", "role", "text", "fault", "loose")
    return found.mapInArrow(_applied(final), final)


def repair_digests(repaired: DataFrame) -> DataFrame:
    """(conv, gaps, blank, duplicate, truncated, illegal, cost, audit, repaired_sha256) of the edits of conversations.

    The digest of a conversation needs its turns in one order, so each is one stream of one task, a batch at a time.
    """
    kind = repaired.schema["conv"].dataType
    schema = _typed("conv", kind, "gaps long, blank long, duplicate long, truncated long, illegal long, cost long, audit string, repaired_sha256 string")

    def task(batches):
        found: list[tuple] = []
        state = None

        def finish():
            turns, counts, letters, digest = state["turns"], state["faults"], state["letters"], state["digest"]
            gaps = turns[1] - turns[0] + 1 - turns[2] if turns else 0
            cost = sum(COSTS[x] * letters.count(x.encode()) for x in COSTS) + TRUNCATED_COST * state["stayed"]
            named = (counts[f] for f in ("blank", "duplicate", "truncated"))
            found.append((state["conv"], gaps, *named, state["loose"], cost, letters.decode(), digest.hexdigest()))

        for batch in batches:
            names = ("conv", "edit", "turn", "role", "text", "fault", "loose")
            for conv, edit, turn, role, text, fault, loose in zip(*(batch.column(n).to_pylist() for n in names)):
                if state is None or state["conv"] != conv:
                    if state is not None:
                        finish()
                    faults = {"blank": 0, "duplicate": 0, "truncated": 0}
                    state = {"conv": conv, "turns": None, "faults": faults, "letters": bytearray(), "digest": hashlib.sha256(), "stayed": 0, "loose": 0, "first": True}
                state["letters"] += edit.encode()
                if turn is not None:
                    low, high, count = state["turns"] or (turn, None, 0)
                    state["turns"] = (low, turn, count + (turn != high))
                if fault is not None:
                    state["faults"][fault] += 1
                state["loose"] += bool(loose)
                if edit != DELETE:
                    state["stayed"] += fault == "truncated"
                    state["digest"].update(f"{'' if state['first'] else chr(10)}{role}:{text}".encode())
                    state["first"] = False
            yield from _batches(found, schema)
        if state is not None:
            finish()
            yield from _batches(found, schema)

    ordered = repaired.repartition("conv").sortWithinPartitions("conv", "place")
    return ordered.mapInArrow(task, schema)


def damage(conversations: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """Faults for a test of the repair, by crc32 of ``conv:turn`` modulo 20; of nulls one space is taken.

    0 drops a row, 1 empties its text, 2 removes its full stops and exclamation and question marks, 3 repeats it, 4 makes it a user's.
    """
    space = F.lit(" ")
    rows = conversations.select(conv, turn, F.coalesce(role, space).alias(role), F.coalesce(text, space).alias(text))
    name = F.concat_ws(":", F.coalesce(F.col(conv).cast("string"), space), F.coalesce(F.col(turn).cast("string"), space))
    rows = rows.withColumn("_kind", F.crc32(name.cast("binary")) % 20).where("_kind <> 0")
    kind = F.col("_kind")
    changed = F.when(kind == 1, "").when(kind == 2, F.translate(text, ".!?", "")).otherwise(F.col(text))
    copies = F.when(kind == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))
    return rows.select(conv, turn, F.when(kind == 4, "user").otherwise(F.col(role)).alias(role), changed.alias(text), F.explode(copies).alias("_copy")).drop("_copy")
