"""Conversation structure repair: the cheapest edits that make roles alternate.

A repaired conversation has the roles ``(s?(ua)+)?`` (initials of system, user, assistant). Edits
are Keep, Rerole to user or assistant, Delete (the only one for blank and duplicate turns) and
Insert of an empty user or assistant turn; turns left in though they are cut off cost extra. Of
equally cheap repairs the one whose edit initials are smallest as ASCII text holds.

Turns are ordered by one range shuffle, so that a conversation of any length is dealt over as
many tasks as its turns need. Each task reads its turns in order, as one symbol each, and runs a
Viterbi search over the four states of the role pattern. Survivors are leaves of a tree of
backpointers with reference counts. A step that only one survivor's path leads through is
settled: it is emitted and dropped, so a task holds the steps after the last common ancestor and
nothing more. Of two equally cheap paths into one state both unresolved ends are compared whole.

Where a conversation goes on in the next task, its part is searched from every state that it
may start in, and a second, small step chooses the cheapest chain of parts: at most two parts
for each task, whatever the number of turns. The parts' ends are compared by their rank.

Equal paths of equal cost can't be prefixes of each other (a longer one has a paid insertion
more), so choosing at every step, and part by part, gives the smallest whole text.

Defined cases: turns are ordered by (turn, role, text), nulls first; a null role or text is one
space, which no pattern holds; null conversation ids are one conversation; equal rows are one
row with a count, of which all but the first are duplicates; an empty table gives an empty
result; other columns are ignored, whatever their names. Very long texts are read by built-in
expressions alone. A conversation's repaired turns are rows; only ``digest``, whose contract
asks for one string and one hash over all of them, streams them through one task.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lodgemart.llm.components import written
from lodgemart.operators.skew import left_lookup

# What edits cost, and the extra cost of a turn that stays cut off.
REROLE, DELETE, INSERT, TRUNCATED = 3, 4, 3, 3
# Pairs of adjacent role initials that are legal.
LEGAL = ("su", "ua", "au")

# States of the role pattern: nothing yet, after system, after user, after assistant.
EMPTY, SYSTEM, USER, ASSISTANT = range(4)
# Start of a conversation: like EMPTY, but turns may be inserted before the first one.
BEGIN = 4
# Edits as letters: K and D as they are, U and A insert, u and a change the role.
INITIALS = str.maketrans("UAua", "IIRR")
INSERTED = {"U": "user", "A": "assistant"}
REROLED = {"u": "user", "a": "assistant"}
# Turns that may be inserted behind a state: what they lead to.
_BEHIND = {
    EMPTY: (("", EMPTY), ("U", USER), ("UA", ASSISTANT)),
    SYSTEM: (("", SYSTEM), ("U", USER), ("UA", ASSISTANT)),
    USER: (("", USER), ("A", ASSISTANT)),
    ASSISTANT: (("", ASSISTANT), ("U", USER)),
}
_KEEPS = {(EMPTY, "s"): SYSTEM, (EMPTY, "u"): USER, (SYSTEM, "u"): USER, (USER, "a"): ASSISTANT, (ASSISTANT, "u"): USER}
_REROLES = {EMPTY: ("u", USER), SYSTEM: ("u", USER), USER: ("a", ASSISTANT), ASSISTANT: ("u", USER)}

#: Steps between two looks for settled ones.
LOOK_EVERY = 64
#: Turns whose edits travel in one row.
BLOCK_TURNS = 4_096


def steps_of(initial: str, doomed: bool, truncated: bool) -> list[tuple[int, int, int, str]]:
    """All ways through one turn: from a state, to a state, cost, edit letters."""
    out = []
    for state in range(4):
        ways = [(state, DELETE, "D")]
        if not doomed:
            extra = TRUNCATED if truncated else 0
            if (state, initial) in _KEEPS:
                ways.append((_KEEPS[state, initial], extra, "K"))
            letter, to = _REROLES[state]
            ways.append((to, REROLE + extra, letter))
        for middle, cost, letter in ways:
            for inserted, to in _BEHIND[middle]:
                out.append((state, to, cost + INSERT * len(inserted), letter + inserted))
    return out


class Step:
    """A node of the tree of backpointers: the edits of one turn, and how many nodes or survivors need it."""

    __slots__ = ("before", "edits", "uses")

    def __init__(self, before: Step | None, edits: str) -> None:
        self.before, self.edits, self.uses = before, edits, 0
        if before is not None:
            before.uses += 1


def _release(step: Step | None) -> None:
    """Takes one use away; steps that nothing needs any more go, and so on towards the root."""
    while step is not None:
        step.uses -= 1
        if step.uses:
            return
        step = step.before


def path_to(step: Step, root: Step | None = None) -> list[str]:
    """Edits from behind ``root`` to a step."""
    out = []
    while step is not root and step is not None:
        out.append(step.edits)
        step = step.before
    return out[::-1]


def _ends(x: Step, y: Step) -> tuple[str, str]:
    """Edit initials of two paths of equal length behind their common ancestor."""
    left, right = [], []
    while x is not y:
        left.append(x.edits)
        right.append(y.edits)
        x, y = x.before, y.before
    return tuple("".join(reversed(ends)).translate(INITIALS) for ends in (left, right))


class Survivors:
    """The cheapest path into each state so far; what all of them share is settled."""

    def __init__(self, start: int) -> None:
        self.root = Step(None, "")
        self.cost: dict[int, int] = {}
        self.last: dict[int, Step] = {}
        # Turns inserted before the first one are a step of their own, joined to it when settled.
        for inserted, state in _BEHIND[EMPTY] if start == BEGIN else (("", start),):
            self._survive({state: (INSERT * len(inserted), Step(self.root, inserted))})
        self.settled: list[str] = []
        self.head: str | None = None
        self.opens = ""
        self.sent = 0
        self.unlooked = 0

    def _survive(self, found: dict[int, tuple[int, Step]]) -> None:
        for state, (cost, step) in found.items():
            step.uses += 1
            self.cost[state], self.last[state] = cost, step

    def read(self, ways: list[tuple[int, int, int, str]], more: int) -> None:
        """One turn; ``more`` is the cost of its further copies, which are deleted."""
        best: dict[int, tuple[int, Step, str]] = {}
        for state, to, cost, edits in ways:
            if state not in self.cost:
                continue
            cost += self.cost[state] + more
            rival = best.get(to)
            if rival is None or cost < rival[0]:
                best[to] = cost, self.last[state], edits
            elif cost == rival[0] and self._smaller(self.last[state], edits, rival[1], rival[2]):
                best[to] = cost, self.last[state], edits
        # Whatever follows costs after ASSISTANT at most a deleted system turn more than after
        # EMPTY, and no more than after SYSTEM: paths that are dearer than that are not survivors.
        if ASSISTANT in best:
            limit = best[ASSISTANT][0]
            if EMPTY in best and best[EMPTY][0] > limit + DELETE:
                del best[EMPTY]
            if SYSTEM in best and best[SYSTEM][0] > limit:
                del best[SYSTEM]
        before = list(self.last.values())
        self.cost, self.last = {}, {}
        self._survive({to: (cost, Step(step, edits)) for to, (cost, step, edits) in best.items()})
        for step in before:
            _release(step)
        self.unlooked += 1
        if self.unlooked == LOOK_EVERY:
            self.look()

    @staticmethod
    def _smaller(x: Step, x_edits: str, y: Step, y_edits: str) -> bool:
        x_edits, y_edits = x_edits.translate(INITIALS), y_edits.translate(INITIALS)
        if x is y:
            return x_edits < y_edits
        left, right = _ends(x, y)
        return left + x_edits < right + y_edits

    def look(self) -> None:
        """Moves the root to the last step that all survivors share; the steps up to it are settled."""
        self.unlooked = 0
        path, step = [], next(iter(self.last.values()))
        while step is not self.root:
            path.append(step)
            step = step.before
        # A step is shared if it is the only one that needs the step before.
        while path and self.root.uses == 1:
            step = path.pop()
            self._settle(step.edits)
            self.root, step.before = step, None

    def _settle(self, edits: str) -> None:
        if self.head is None:
            self.head = edits
        else:
            self.settled.append(self.head + edits)
            self.opens = self.opens or self.settled[0].translate(INITIALS)[0]
            self.head = ""

    def take(self) -> list[str]:
        out, self.settled = self.settled, []
        return out

    def ends(self) -> dict[int, tuple[int, list[str]]]:
        """Cost and unsettled edits, one text for each turn, of the path into each state."""
        out = {}
        for state, step in self.last.items():
            path = path_to(step, self.root)
            # The head belongs to the turn after it, wherever that is.
            path = path if self.head is None else [self.head, *path]
            out[state] = self.cost[state], ([path[0] + path[1], *path[2:]] if len(path) > 1 else [])
        return out


@dataclass
class Part:
    """The turns of one conversation in one task, searched from each start they may have."""

    conv: object
    first: int
    starts: dict[int, Survivors]
    initial: str = ""
    last: str = ""
    illegal: int = 0
    turns: int = 0

    def read(self, initial: str, copies: int, ways: list) -> None:
        if not self.turns:
            self.initial = initial
        elif self.last + initial not in LEGAL:
            self.illegal += 1
        if initial + initial not in LEGAL:
            self.illegal += copies - 1
        self.last = initial
        self.turns += 1
        for survivors in self.starts.values():
            survivors.read(ways, DELETE * (copies - 1))

    def settled(self) -> Iterator[dict]:
        """Rows of the edits that every path from a start has."""
        for start, survivors in self.starts.items():
            if edits := survivors.take():
                yield {"start": start, "end": None, "at": survivors.sent, "edits": edits}
                survivors.sent += len(edits)

    def ends(self, whole: bool) -> Iterator[dict]:
        """Rows of the ends of all paths; of a whole conversation the cheapest legal one alone.

        ``place`` ranks the ends of one start by their edits; ``longer`` names those whose edits go
        on with insertions behind these.
        """
        yield from self.settled()
        for start, survivors in self.starts.items():
            ends = survivors.ends()
            texts = {end: "".join(path).translate(INITIALS) for end, (_, path) in ends.items()}
            places = sorted(texts.values())
            if whole:
                goal = min((e for e in (EMPTY, ASSISTANT) if e in ends), key=lambda e: (ends[e][0], texts[e]))
                ends = {goal: ends[goal]}
            for end, (cost, path) in ends.items():
                yield {
                    "start": start,
                    "end": end,
                    "at": survivors.sent,
                    "edits": path,
                    "cost": cost,
                    "place": places.index(texts[end]),
                    "longer": [e for e, t in texts.items() if e != end and t.startswith(texts[end])],
                    "opens": survivors.opens or texts[end][:1],
                    "initial": self.initial,
                    "last": self.last,
                    "illegal": self.illegal,
                    "whole": whole,
                }


# Columns of a row of a part; the id of its first turn is its name.
_PART = {
    "first": pa.int64(), "start": pa.int32(), "end": pa.int32(), "at": pa.int64(), "edits": pa.list_(pa.string()),
    "cost": pa.int64(), "place": pa.int32(), "longer": pa.list_(pa.int32()), "opens": pa.string(),
    "initial": pa.string(), "last": pa.string(), "illegal": pa.int64(), "whole": pa.bool_(),
}
_PART_DDL = (
    "first long, start int, end int, at long, edits array<string>, cost long, place int, longer array<int>,"
    " opens string, initial string, last string, illegal long, whole boolean"
)
# Row numbers of one task differ in their last bits only, as monotonically_increasing_id gives them.
_TASK_BITS = 33


def _search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows of all parts from the turns of some tasks, in the order of their numbers."""
    ways: dict[tuple, list] = {}
    part, kind, out = None, None, []

    def batch(rows: list[tuple]) -> pa.RecordBatch:
        columns = [pa.array([conv for conv, _, _ in rows], kind), pa.array([f for _, f, _ in rows], pa.int64())]
        columns += [pa.array([r.get(n) for _, _, r in rows], t) for n, t in list(_PART.items())[1:]]
        return pa.RecordBatch.from_arrays(columns, ["conv", *_PART])

    def close(whole: bool) -> None:
        out.extend((part.conv, part.first, row) for row in part.ends(whole))

    for found in batches:
        kind = found.column("conv").type
        for conv, at, initial, copies, doomed, truncated in zip(*(c.to_pylist() for c in found.columns)):
            new_task = part is None or at >> _TASK_BITS != task
            if new_task or conv != part.conv:
                if part is not None:
                    close(not new_task and BEGIN in part.starts and len(part.starts) == 1)
                # The first turns of a task may go on with a conversation of the task before.
                starts = range(5) if new_task else (BEGIN,)
                part = Part(conv, at, {s: Survivors(s) for s in starts})
                task = at >> _TASK_BITS
            key = initial, doomed, truncated
            if key not in ways:
                ways[key] = steps_of(*key)
            part.read(initial, copies, ways[key])
            if part.turns % BLOCK_TURNS == 0:
                out.extend((part.conv, part.first, row) for row in part.settled())
            if len(out) >= BLOCK_TURNS:
                yield batch(out)
                out.clear()
    if part is not None:
        close(False)
        yield batch(out)


class _Link:
    """A part on a chain, and the chain before it."""

    __slots__ = ("before", "row")

    def __init__(self, before: _Link | None, row: dict) -> None:
        self.before, self.row = before, row


def _chain_smaller(x: _Link, y: _Link) -> bool:
    """Whether the edits of one chain are smaller than those of another of as many parts."""
    after_x = after_y = None
    while x.before is not y.before:
        after_x, after_y, x, y = x, y, x.before, y.before
    if y.row["end"] in x.row["longer"]:  # y goes on with an insertion, x with its next part
        return after_x is None or after_x.row["opens"] < "I"
    if x.row["end"] in y.row["longer"]:
        return not (after_y is None or after_y.row["opens"] < "I")
    return x.row["place"] < y.row["place"]


def cheapest_chain(rows: list[dict]) -> list[dict]:
    """The rows of a conversation's parts that make the cheapest legal whole, in order."""
    parts: dict[int, list[dict]] = {}
    for row in rows:
        parts.setdefault(row["first"], []).append(row)
    best: dict[int, tuple[int, _Link | None]] = {BEGIN: (0, None)}
    for first in sorted(parts):
        found: dict[int, tuple[int, _Link]] = {}
        for row in parts[first]:
            if row["start"] not in best:
                continue
            cost, before = best[row["start"]]
            cost, link, rival = cost + row["cost"], _Link(before, row), found.get(row["end"])
            if rival is None or cost < rival[0] or (cost == rival[0] and _chain_smaller(link, rival[1])):
                found[row["end"]] = cost, link
        best = found
    ends = [best[e] for e in (EMPTY, ASSISTANT) if e in best]
    cost, link = ends[0]
    if len(ends) == 2 and (ends[1][0] < cost or (ends[1][0] == cost and _chain_smaller(ends[1][1], link))):
        link = ends[1][1]
    out = []
    while link is not None:
        out.append(link.row)
        link = link.before
    return out[::-1]


def _chain(table: pa.Table) -> pa.Table:
    """The chosen rows of one conversation: at most two parts for each task, however many turns."""
    chosen, last = cheapest_chain(table.to_pylist()), None
    for row in chosen:
        row["illegal"] += int(last is not None and last + row["initial"] not in LEGAL)
        last = row["last"]
    return pa.Table.from_pylist(chosen, table.schema)


def as_logged(turns: DataFrame, conv: str, turn: str, role: str, text: str) -> DataFrame:
    """The turns with equal ones as one row: conv, turn, role, text, copies."""
    space = F.lit(" ")
    return turns.select(
        F.col(conv).alias("conv"),
        F.col(turn).alias("turn"),
        F.coalesce(F.col(role).cast("string"), space).alias("role"),
        F.coalesce(F.col(text).cast("string"), space).alias("text"),
        (F.col("copies") if "copies" in turns.columns else F.lit(1)).cast("long").alias("copies"),
    )


def placed_turns(turns: DataFrame) -> DataFrame:
    """Turns (conv, turn, role, text, copies) with a number ``at`` that orders them, written.

    A range shuffle deals a long conversation over many tasks; its sample of the order holds
    beginnings of texts only.
    """
    one = turns.groupBy("conv", "turn", "role", "text").agg(F.sum("copies").alias("copies"))
    first = [F.asc_nulls_first("conv"), F.asc_nulls_first("turn")]
    dealt = one.repartitionByRange(*first, F.left("role", F.lit(64)), F.left("text", F.lit(64)))
    return written(
        dealt.sortWithinPartitions(*first, "role", "text").withColumn("at", F.monotonically_increasing_id()), "turns"
    )


def flagged_turns(placed: DataFrame) -> DataFrame:
    """Of each placed turn, without its text: conv, turn, at, initial, copies, blank, repeated, cut."""
    initial = F.left("role", F.lit(1))
    rest = F.rtrim(F.translate("text", "\t\n\x0b\x0c\r", "     "))
    light = placed.select(
        "conv",
        "turn",
        "at",
        "copies",
        F.when(initial.isin("s", "u", "a"), initial).otherwise("?").alias("initial"),
        (rest == "").alias("blank"),
        (~F.right(rest, F.lit(1)).isin(".", "!", "?")).alias("open"),
        F.xxhash64("conv", F.col("conv").isNull(), "role", "text").alias("k1"),
        F.xxhash64("text", F.lit(23), "role", F.col("conv").isNull(), "conv").alias("k2"),
    )
    # The first turn of each conversation with this role and text; numbers are in order.
    first = light.groupBy("k1", "k2").agg(F.min("at").alias("at")).select("at", F.lit(True).alias("original"))
    repeated = F.col("original").isNull()
    return light.join(first, "at", "left").select(
        "conv", "turn", "at", "initial", "copies", "blank",
        (~F.col("blank") & repeated).alias("repeated"),
        (~F.col("blank") & ~repeated & F.col("open")).alias("cut"),
    )


def chosen_edits(flagged: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The edits (at, edit) of all turns, and (conv, cost, illegal) of all parts of conversations.

    An edit is a text of letters: turns inserted before the first one (U, A), what happens to the
    turn (K, D, u, a), turns inserted behind it and its further copies (U, A).
    """
    symbols = flagged.select("conv", "at", "initial", "copies", (F.col("blank") | F.col("repeated")).alias("doomed"), "cut")
    task = F.shiftright("at", _TASK_BITS)
    kind = flagged.schema["conv"].dataType.simpleString()
    parts = written(
        symbols.repartition(task).sortWithinPartitions("at").mapInArrow(_search, f"conv {kind}, {_PART_DDL}"), "parts"
    )
    ends = parts.where("end is not null")
    chained = ends.where("not whole").groupBy("conv").applyInArrow(_chain, parts.schema)
    sure = written(ends.where("whole").unionByName(chained).select("conv", "first", "start", "end", "cost", "illegal"), "ends")
    known = sure.select("first", F.col("start").alias("from"), F.col("end").alias("to"))
    here = (F.col("start") == F.col("from")) & F.coalesce(F.col("end") == F.col("to"), F.lit(True))
    edits = (
        parts.select("first", "start", "end", "at", "edits")
        .join(known, "first")
        .where(here)
        .select((F.col("first") + F.col("at")).alias("base"), F.posexplode("edits").alias("k", "edit"))
        .select((F.col("base") + F.col("k")).alias("at"), "edit")
    )
    return edits, sure.select("conv", "cost", "illegal")


@dataclass(frozen=True)
class Repair:
    """Results by row: edited turns, faults of each turn, costs of parts of conversations."""

    edited: DataFrame
    flagged: DataFrame
    costs: DataFrame

    def repaired(self) -> DataFrame:
        """The repaired conversations: conv, at, sub (order within ``at``), role, text, edit."""
        letters = self.edited.select(
            "conv", "at", "role", "text", F.posexplode(F.split("edit", "")).alias("sub", "edit")
        ).where("edit not in ('D', '')")
        kept = F.col("edit") == "K"
        role = F.when(F.col("edit").isin("U", "u"), "user").otherwise("assistant")
        inserted = F.col("edit").isin("U", "A")
        return letters.select(
            "conv", "at", "sub", F.when(kept, F.col("role")).otherwise(role).alias("role"),
            F.when(inserted, "").otherwise(F.col("text")).alias("text"),
            F.translate("edit", "UAua", "IIRR").alias("edit"),
        )


def repair(
    turns: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text"
) -> Repair:
    """The cheapest repair of every conversation."""
    return repair_logged(as_logged(turns.drop("copies"), conv, turn, role, text))


def repair_logged(logged: DataFrame) -> Repair:
    """``repair`` of rows that carry their copies."""
    placed = placed_turns(logged)
    flagged = written(flagged_turns(placed), "flags")
    edits, costs = chosen_edits(flagged)
    edited = left_lookup(placed, edits.withColumnRenamed("at", "edit_at"), "at", "edit_at").drop("edit_at")
    return Repair(edited, flagged, costs)


def damaged(
    turns: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text"
) -> DataFrame:
    """The turns after damage by a checksum of conversation and turn, as rows with copies."""
    space = F.lit(" ")
    key = F.concat(F.coalesce(F.col("conv").cast("string"), space), F.lit(":"), F.coalesce(F.col("turn").cast("string"), space))
    fate = F.col("fate")
    return (
        as_logged(turns.drop("copies"), conv, turn, role, text)
        .withColumn("fate", F.crc32(key.cast("binary")) % 20)
        .where(fate != 0)
        .select(
            "conv",
            "turn",
            F.when(fate == 4, "user").otherwise(F.col("role")).alias("role"),
            F.when(fate == 1, "").when(fate == 2, F.translate("text", ".!?", "")).otherwise(F.col("text")).alias("text"),
            F.when(fate == 3, 2).otherwise(1).cast("long").alias("copies"),
        )
    )


def _streamed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(conv, audit, sha256) from edited turns in order; holds one conversation's initials and hash."""
    now, kind, out, audit, sha, any_turn = None, None, [], [], None, False

    def batch() -> pa.RecordBatch:
        conv, edits, hashes = zip(*out)
        return pa.RecordBatch.from_arrays(
            [pa.array(conv, kind), pa.array(edits, pa.string()), pa.array(hashes, pa.string())], ["conv", "audit", "sha"]
        )

    for found in batches:
        kind = found.column("conv").type
        rows = zip(*(c.to_pylist() for c in found.columns))
        for conv, copies, role, text, edit in rows:
            if now != (conv,):
                if now is not None:
                    out.append((*now, "".join(audit), sha.hexdigest()))
                    if len(out) >= BLOCK_TURNS:
                        yield batch()
                        out.clear()
                now, audit, sha, any_turn = (conv,), [], hashlib.sha256(), False
            own = next(k for k, letter in enumerate(edit) if letter in "KDua")
            audit.append(edit[: own + 1].translate(INITIALS) + "D" * (copies - 1) + edit[own + 1 :].translate(INITIALS))
            for letter in edit:
                if letter == "D":
                    continue
                line = f"{INSERTED[letter]}:" if letter in INSERTED else f"{REROLED.get(letter, role)}:{text}"
                sha.update((("\n" if any_turn else "") + line).encode())
                any_turn = True
    if now is not None:
        out.append((*now, "".join(audit), sha.hexdigest()))
        yield batch()


def digest(
    turns: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text"
) -> DataFrame:
    """One row per conversation of the undamaged table: faults, cost, edits and hash of its repair."""
    done = repair_logged(damaged(turns, conv, turn, role, text))
    flag = lambda name, n: F.sum(F.when(F.col(name), n).otherwise(0))
    copies = F.col("copies")
    stats = done.flagged.groupBy("conv").agg(
        (F.max("turn") - F.min("turn") + 1 - F.count_distinct("turn")).alias("gaps"),
        flag("blank", copies).alias("blank"),
        (flag("repeated", copies) + F.sum(F.when(F.col("blank") | F.col("repeated"), 0).otherwise(copies - 1))).alias("duplicate"),
        flag("cut", F.lit(1)).alias("truncated"),
    )
    costs = done.costs.groupBy("conv").agg(F.sum("illegal").alias("illegal"), F.sum("cost").alias("cost"))
    kind = turns.schema[conv].dataType.simpleString()
    texts = (
        done.edited.select("conv", "at", "copies", "role", F.when(~F.col("edit").contains("D"), F.col("text")).alias("text"), "edit")
        .repartition("conv")
        .sortWithinPartitions(F.asc_nulls_first("conv"), "at")
        .select("conv", "copies", "role", "text", "edit")
        .mapInArrow(_streamed, f"conv {kind}, audit string, sha string")
    )
    out = turns.select(F.col(conv).alias("id")).distinct()
    for found in (stats, costs, texts):
        out = out.join(found, F.col("id").eqNullSafe(F.col("conv")), "left").drop("conv")
    numbers = ["gaps", "blank", "duplicate", "truncated", "illegal", "cost"]
    return out.select(
        F.col("id").alias(conv),
        *[F.coalesce(F.col(n), F.lit(0)).cast("long").alias(n) for n in numbers],
        F.coalesce("audit", F.lit("")).alias("audit"),
        F.coalesce("sha", F.sha2(F.lit(""), 256)).alias("repaired_sha256"),
    )


def _sql() -> str:
    """The digest in DuckDB SQL: the checksum bit by bit, the search as a recursive query with whole texts."""

    def after(state: str, cost: str, initial: str, line: str = "") -> str:
        lines = f"list_append({state}.t, {line})" if line else f"{state}.t"
        return f"{{'c': {state}.c + {cost}, 'x': {state}.x || '{initial}', 't': {lines}}}"

    def least(*ways: str) -> str:
        return f"list_sort([{', '.join(ways)}])[1]"

    def allowed(initial: str, way: str) -> str:
        return f"CASE WHEN NOT doomed AND f = '{initial}' THEN {way} ELSE nil END"

    def reroled(state: str, role: str) -> str:
        return f"CASE WHEN doomed THEN nil ELSE {after(state, f'{REROLE} + extra', 'R', f"'{role}:' || text")} END"

    kept = {s: after(s, "extra", "K", "role || ':' || text") for s in "esua"}
    deleted = {s: after(s, str(DELETE), "D") for s in "esua"}
    user, assistant = "'user:'", "'assistant:'"
    insert = {s: after(s, str(INSERT), "I", user if s != "u" else assistant) for s in "esua"}
    empty = "{'c': %d, 'x': '', 't': []::VARCHAR[]}"
    return f"""
WITH RECURSIVE
bit(i, k, c) AS (
  SELECT i::UBIGINT, 0, i::UBIGINT FROM range(256) g(i)
  UNION ALL
  SELECT i, k + 1, CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384::UBIGINT) ELSE c >> 1 END FROM bit WHERE k < 8),
tab AS (SELECT list(c ORDER BY i) AS tab FROM bit WHERE k = 8),
fate AS (
  SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
         xor(list_reduce(list_prepend(4294967295::UBIGINT, list_transform(string_split(
               coalesce(conv_id::VARCHAR, ' ') || ':' || coalesce(turn::VARCHAR, ' '), ''), lambda x: ascii(x)::UBIGINT)),
             lambda c, b: xor(c >> 8, tab[(xor(c & 255, b))::INTEGER + 1])), 4294967295::UBIGINT) % 20 AS fate
  FROM conversations, tab),
damaged AS (
  SELECT conv_id, turn, CASE WHEN fate = 4 THEN 'user' ELSE role END AS role,
         CASE WHEN fate = 1 THEN '' WHEN fate = 2 THEN translate(text, '.!?', '') ELSE text END AS text,
         unnest(range(CASE WHEN fate = 3 THEN 2 ELSE 1 END)) AS copy
  FROM fate WHERE fate <> 0),
seen AS (
  SELECT *, row_number() OVER w AS i, left(role, 1) AS f, lag(left(role, 1)) OVER w || left(role, 1) AS pair,
         rtrim(translate(text, chr(9) || chr(10) || chr(11) || chr(12) || chr(13), '     ')) AS body
  FROM damaged WINDOW w AS (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text)),
rows AS (
  SELECT *, body = '' AS blank, body <> '' AND nth > 1 AS dup,
         body <> '' AND nth = 1 AND right(body, 1) NOT IN ('.', '!', '?') AS cut
  FROM (SELECT *, row_number() OVER (PARTITION BY conv_id, role, text ORDER BY i) AS nth FROM seen)),
stats AS (
  SELECT conv_id, count(*) AS n, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps,
         sum(blank::INT) AS blank, sum(dup::INT) AS duplicate, sum(cut::INT) AS truncated,
         sum((coalesce(pair, 'su') NOT IN {LEGAL!r})::INT) AS illegal
  FROM rows GROUP BY conv_id),
search(conv_id, i, e, s, u, a) AS (
  SELECT conv_id, 0::BIGINT, {empty % 0}, {empty % 10**9},
         {{'c': {INSERT}, 'x': 'I', 't': [{user}]}}, {{'c': {2 * INSERT}, 'x': 'II', 't': [{user}, {assistant}]}}
  FROM stats
  UNION ALL
  SELECT conv_id, i, e, s, u, {least("a", insert["u"])}
  FROM (
    SELECT conv_id, i, e, s, a, {least("u", insert["e"], insert["s"], insert["a"])} AS u
    FROM (
      SELECT conv_id, i + 1 AS i, {deleted["e"]} AS e,
             {least(deleted["s"], allowed("s", kept["e"]))} AS s,
             {least(deleted["u"], *[allowed("u", kept[x]) for x in "esa"], *[reroled(x, "user") for x in "esa"])} AS u,
             {least(deleted["a"], allowed("a", kept["u"]), reroled("u", "assistant"))} AS a
      FROM (
        SELECT v.*, r.role, r.text, r.f, r.blank OR r.dup AS doomed, r.cut::INT * {TRUNCATED} AS extra, {empty % 10**9} AS nil
        FROM search v JOIN rows r ON r.conv_id IS NOT DISTINCT FROM v.conv_id AND r.i = v.i + 1))) ),
done AS (
  SELECT v.conv_id, {least("e", "a")} AS best
  FROM search v JOIN stats t ON t.conv_id IS NOT DISTINCT FROM v.conv_id AND t.n = v.i)
SELECT c.conv_id, coalesce(gaps, 0)::BIGINT AS gaps, coalesce(blank, 0)::BIGINT AS blank,
       coalesce(duplicate, 0)::BIGINT AS duplicate, coalesce(truncated, 0)::BIGINT AS truncated,
       coalesce(illegal, 0)::BIGINT AS illegal, coalesce(best.c, 0)::BIGINT AS cost, coalesce(best.x, '') AS audit,
       sha256(coalesce(array_to_string(best.t, chr(10)), '')) AS repaired_sha256
FROM (SELECT DISTINCT conv_id FROM conversations) c
LEFT JOIN stats t ON t.conv_id IS NOT DISTINCT FROM c.conv_id
LEFT JOIN done d ON d.conv_id IS NOT DISTINCT FROM c.conv_id
"""


REPAIR_SQL = _sql()
