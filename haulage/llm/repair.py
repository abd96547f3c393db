"""Repair the turn structure of conversations with the cheapest edits, by Viterbi search.

The roles of a sound conversation begin with ``s?(ua)+`` or there are none. Rows are kept
(0), given the role user or assistant (1) or deleted (2), and turns with empty text are
inserted (5). Blank rows and repetitions have to go; a truncated row that stays costs 5 more. Of
equally cheap repairs the one whose edits ``D I K R`` come first as a string is taken.

A state is what the roles so far call for: nothing yet, after the system turn, after
a user turn, after an assistant turn. Each state has one survivor, the
cheapest way there, least as a string among equals. Survivors are leaves of a tree
of back pointers whose nodes count their references: a node that no survivor needs is freed, and
as soon as all survivors share an ancestor, the edits up to it are settled, written to the digest
and freed. Equal costs are compared over the whole edits that the two do not share: survivors
have done the same rows, so none is the beginning of another, and their order, once found where
they part, holds for all that follows. It is carried along instead of walking back each time.
A survivor that costs more than another one plus the edits with which that one can copy
whatever it does next is dropped, so that unequal beginnings don't keep the tree from settling.
A run of deleted rows is one node and holds no text.

Rows of a conversation stream through one task in order, as the digest of its text
is a chain. The task holds the unsettled part, the string of edits, and one batch. (Where ways
stay equally cheap to the end, as in a conversation of user turns alone, that part is long.) Faults are found
before that, in Spark: the first place of each text by a grouped minimum, later places as
marks that travel beside the rows.

Defined results: null role and null text are one space; null turns come first; rows of
one turn are ordered by the MD5 of role and text, so repeated rows lie together and all but one are
repetitions; null conv_id is a conversation of its own; an empty table gives no rows; a
conversation whose rows are all gone has zeros, no edits and the digest of the empty string.
Columns other than these four are not read.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from hashlib import sha256

import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from haulage.llm.storing import stored

KEEP, REROLE, DELETE, INSERT, TRUNCATED = 0, 1, 2, 5, 5
START, SYSTEM, USER, ASSISTANT = range(4)
ENDS = (START, ASSISTANT)
#: The state that a turn of this role leads to, from the states where it may stand.
STEPS = {
    "s": (SYSTEM, (START,)),
    "u": (USER, (START, SYSTEM, ASSISTANT)),
    "a": (ASSISTANT, (USER,)),
}
#: What it costs a state to copy whatever another state does next.
COPIES = {
    START: {SYSTEM: 0, ASSISTANT: 0, USER: INSERT},
    SYSTEM: {USER: INSERT},
    USER: {START: INSERT + DELETE, SYSTEM: INSERT, ASSISTANT: INSERT},
    ASSISTANT: {START: DELETE, SYSTEM: 0, USER: INSERT},
}
LEGAL = ("su", "ua", "au")
SPACE = " \t\n\v\f\r"
SOLID = re.compile(r"[^\x20\x09-\x0D]")
RESULT = (
    "conv_id long, gaps long, blank long, duplicate long, truncated long, illegal long, cost long, "
    "audit string, repaired_sha256 string"
)


def fault(text: str, seen: bool) -> str | None:
    """The first fault of a row."""
    if not SOLID.search(text):
        return "blank"
    if seen:
        return "duplicate"
    return "truncated" if text.rstrip(SPACE)[-1] not in ".!?" else None


class _Node:
    """An edit, or a run of deletions; ``refs`` counts children and survivors."""

    __slots__ = ("parent", "kids", "edit", "count", "turn", "refs", "serial")

    def __init__(self, parent, edit: str, turn: str | None, serial: int):
        self.parent, self.edit, self.turn, self.serial = parent, edit, turn, serial
        self.count, self.refs, self.kids = 1, 0, set()
        if parent is not None:
            parent.refs += 1
            parent.kids.add(self)


class Repair:
    """The search over the rows of one conversation, in order."""

    def __init__(self):
        self.serial = self.cost = self.unsettled = self.most_unsettled = 0
        self.root = _Node(None, "", None, 0)
        self.root.refs = 1
        #: Per state the cost, the leaf, and the place among the survivors' edits as strings.
        self.alive: dict[int, tuple[int, _Node, int]] = {START: (0, self.root, 0)}
        self.audit: list[str] = []
        self.digest, self.any = sha256(), False

    def _node(self, parent: _Node, edit: str, turn: str | None) -> _Node:
        self.serial += 1
        self.unsettled += 1
        self.most_unsettled = max(self.most_unsettled, self.unsettled)
        return _Node(parent, edit, turn, self.serial)

    def _offer(self, ways: dict, state: int, way) -> None:
        if state not in ways or _better(way, ways[state]):
            ways[state] = way

    def _with_inserts(self) -> dict[int, tuple]:
        ways = {state: (cost, node, place, []) for state, (cost, node, place) in self.alive.items()}
        for role, state in (("user", USER), ("assistant", ASSISTANT), ("user", USER)):
            for origin in STEPS[role[0]][1]:
                if origin in ways:
                    cost, node, place, edits = ways[origin]
                    self._offer(ways, state, (cost + INSERT, node, place, [*edits, ("I", (role, ""))]))
        return ways

    def row(self, role: str, text: str, what: str | None) -> None:
        # to insert before a deletion is never the first string: the turn can follow it
        ways = {state: (cost + DELETE, node, place, [("D", None)]) for state, (cost, node, place) in self.alive.items()}
        if what not in ("blank", "duplicate"):
            more = TRUNCATED if what == "truncated" else 0
            choices = [("R", REROLE, "user"), ("R", REROLE, "assistant")]
            if role[:1] in STEPS:
                choices.append(("K", KEEP, role))
            before = self._with_inserts()
            for edit, price, name in choices:
                state, origins = STEPS[name[0]]
                for origin in origins:
                    if origin in before:
                        cost, node, place, edits = before[origin]
                        self._offer(ways, state, (cost + price + more, node, place, [*edits, (edit, (name, text))]))
        self._survive(ways)

    def _survive(self, ways: dict[int, tuple]) -> None:
        ways = {
            state: way
            for state, way in ways.items()
            if not any(state in COPIES[x] and ways[x][0] + COPIES[x][state] < way[0] for x in ways)
        }
        users = [way[1] for way in ways.values()]
        old, self.alive = self.alive, {}
        order = sorted(ways, key=lambda state: (ways[state][2], _letters(ways[state])))
        for state, (cost, node, _, edits) in ways.items():
            if edits == [("D", None)] and node.edit == "D" and node.refs == 1 and sum(x is node for x in users) == 1:
                node.count += 1  # the run of deletions is this survivor's alone
            else:
                for edit, turn in edits:
                    node = self._node(node, edit, turn)
            node.refs += 1
            self.alive[state] = (cost, node, order.index(state))
        for _, node, _ in old.values():
            self._release(node)
        self._settle()

    def _release(self, node: _Node) -> None:
        node.refs -= 1
        while node.refs == 0 and node.parent is not None:
            parent = node.parent
            parent.kids.discard(node)
            parent.refs -= 1
            self.unsettled -= 1
            node = parent

    def _settle(self) -> None:
        """Write the edits that all survivors share."""
        while self.root.refs == 1 and self.root.kids:
            (self.root,) = self.root.kids
            self.root.parent = None
            self.unsettled -= 1
            self._write(self.root)

    def _write(self, node: _Node) -> None:
        self.audit.append(node.edit * node.count)
        if node.turn is not None:
            self.digest.update(f"{'\n' if self.any else ''}{':'.join(node.turn)}".encode())
            self.any = True
        node.turn, node.edit, node.count = None, "", 0

    def finish(self) -> tuple[int, str, str]:
        """(cost, edits, SHA-256 of the repaired turns)."""
        ways = self._with_inserts()
        cost, node, _, edits = min((ways[state] for state in ENDS if state in ways), key=lambda way: (way[0], way[2], _letters(way)))
        for edit, turn in edits:
            node = self._node(node, edit, turn)
        node.refs += 1
        for _, other, _ in self.alive.values():
            self._release(other)
        self._settle()
        return cost, "".join(self.audit), self.digest.hexdigest()


def _letters(way) -> str:
    return "".join(edit for edit, _ in way[3])


def _better(one, other) -> bool:
    """Whether a way (cost, leaf, the leaf's place, edits after it) is the better of two."""
    return (one[0], one[2], _letters(one)) < (other[0], other[2], _letters(other))


def edits_of(leaf: _Node) -> str:
    """The unsettled edits that lead to a leaf."""
    parts = []
    while leaf is not None:
        parts.append(leaf.edit * leaf.count)
        leaf = leaf.parent
    return "".join(reversed(parts))


class _Conversation:
    """What is counted of a conversation besides the search."""

    def __init__(self, conv_id):
        self.conv_id, self.search = conv_id, Repair()
        self.faults = dict.fromkeys(("blank", "duplicate", "truncated"), 0)
        self.illegal = self.turns = 0
        self.least = self.last = self.initial = None

    def row(self, turn: int | None, role: str, text: str, seen: bool) -> None:
        what = fault(text, seen)
        if what:
            self.faults[what] += 1
        if self.initial is not None and self.initial + role[:1] not in LEGAL:
            self.illegal += 1
        self.initial = role[:1]
        if turn is not None:
            self.least = turn if self.least is None else self.least
            self.turns += turn != self.last
            self.last = turn
        self.search.row(role, text, what)

    def result(self) -> tuple:
        gaps = self.last - self.least + 1 - self.turns if self.turns else 0
        return (self.conv_id, gaps, *self.faults.values(), self.illegal, *self.search.finish())


def _repaired(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Conversations from rows in order; a mark comes before the rows it says were seen."""
    now, marked, before = None, None, None

    def out(done):
        kinds = [pa.int64()] * 7 + [pa.string()] * 2
        columns = list(zip(*done, strict=True)) or [[]] * 9
        names = [x.split()[0] for x in RESULT.split(", ")]
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names=names)

    for batch in batches:
        done = []
        for conv_id, turn, key, is_row, role, text, times in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            if now is None or now.conv_id != conv_id:
                if now is not None:
                    done.append(now.result())
                now, marked, before = _Conversation(conv_id), None, None
            if not is_row:
                marked = (turn, key)
                continue
            for _ in range(times):
                seen = (turn, key) in (marked, before)
                now.row(turn, role, text, seen)
                before = (turn, key)
        yield out(done)
    if now is not None:
        yield out([now.result()])


def repair(rows: DataFrame) -> DataFrame:
    """A result row per conv_id of rows (conv_id, turn, role, text, times).

    A row stands ``times`` times; 0 only says that the conversation exists.
    """
    given = rows.select(
        F.col("conv_id").cast("long").alias("conv_id"),
        F.col("turn").cast("long").alias("turn"),
        F.coalesce(F.col("role").cast("string"), F.lit(" ")).alias("role"),
        F.coalesce(F.col("text").cast("string"), F.lit(" ")).alias("text"),
        F.col("times").cast("int").alias("times"),
    )
    key = F.unhex(F.md5(F.concat(F.length("role"), F.lit(":"), F.col("role"), F.col("text")).cast("binary"))).alias("key")
    keyed = given.select("conv_id", "turn", key, F.lit(True).alias("is_row"), "role", "text", "times")
    # a text of several turns: all but its first turn are marked
    turn = F.struct(F.col("turn").isNotNull().alias("given"), F.col("turn").alias("turn"))
    firsts = (
        keyed.filter("times > 0")
        .groupBy("conv_id", "key")
        .agg(F.min(turn).alias("first"), F.max(turn).alias("last"))
        .filter("NOT first <=> last")
        .select(F.col("conv_id").alias("of"), F.col("key").alias("of_key"), "first.turn")
        .withColumnRenamed("turn", "first_turn")
    )
    firsts = stored(firsts, "first-turns")
    # the marks need no text; only rows of such texts are more than their first turn
    same = F.col("conv_id").eqNullSafe(F.col("of")) & (F.col("key") == F.col("of_key"))
    later = keyed.filter("times > 0").select("conv_id", "turn", "key").join(firsts, same).filter("NOT turn <=> first_turn")
    none = F.lit(None).cast("string")
    marks = later.select("conv_id", "turn", "key", F.lit(False).alias("is_row"), none.alias("role"), none.alias("text"), F.lit(0).alias("times")).distinct()
    order = ["conv_id", F.asc_nulls_first("turn"), "key", "is_row"]
    streamed = keyed.unionAll(marks).repartition("conv_id").sortWithinPartitions(*order)
    return streamed.mapInArrow(_repaired, RESULT)


def damaged(conversations: DataFrame) -> DataFrame:
    """Rows of conversations with planted faults, chosen by the checksum of ``conv_id:turn``.

    Of 20 remainders, 0 drops the row, 1 empties its text, 2 removes the signs ``.!?`` from
    it, 3 repeats it and 4 sets its role to user.
    """
    text = lambda name: F.coalesce(F.col(name).cast("string"), F.lit(" "))
    fate: Column = F.crc32(F.concat(text("conv_id"), F.lit(":"), text("turn")).cast("binary")) % 20
    bare = F.regexp_replace(text("text"), "[.!?]", "")
    return conversations.select(
        "conv_id",
        "turn",
        F.when(fate == 4, "user").otherwise(text("role")).alias("role"),
        F.when(fate == 1, "").when(fate == 2, bare).otherwise(text("text")).alias("text"),
        F.when(fate == 0, 0).when(fate == 3, 2).otherwise(1).alias("times"),
    )
