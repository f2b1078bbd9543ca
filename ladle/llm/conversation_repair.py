"""Operator 11: repair of conversation structure by the cheapest edits, with survivor-coalescence Viterbi.

Each conversation's rows are read in turn order (nulls first; ties by role, text, copy).  A row's
first fault counts: blank (nothing but ASCII white space), duplicate (role and text stood earlier),
truncated (its last printing character is none of ``.!?``).  Edits: Keep (0), Rerole to user or assistant
(2), Delete (3; the only edit of blank and duplicate rows) and Insert an empty user or assistant row
anywhere (2); a truncated row that is not deleted adds 1.  The result's role initials are
``(s?(ua)+)?``; of the cheapest edit strings the least by ASCII is taken.

* Four states: nothing yet, after a system row, after a user row, after an assistant row.  The
  survivors (best edits into each state) are leaves of a tree of back pointers with reference counts.
  Once a root has a single child and no survivor, all survivors share that edit: it is emitted, its row
  is let go, and the tree is cut there.  So memory holds the edits still in question, not the conversation.
* Survivors of equal cost are told apart by their whole unresolved edit strings.  Two of them never are
  beginnings of each other (one would have more inserts, so more cost), so the order of two survivors is
  settled at the first difference; only what follows their common beginning up to that place is carried.
* A survivor that can no longer win or tie is dropped: nothing yet, beyond the cost after an assistant
  row plus one Delete; after a system row, from the cost after an assistant row on.

Spark shuffles the rows once, by conversation; a window over (conversation, role, text) marks repeats and
a sort brings the order, both spilling; each task streams over its rows.  The digest is a SHA-256 over
all of a conversation's repaired text, so by its definition one task reads a conversation from
beginning to end; it never holds it.

Null ids, turns, roles and texts are read as one space (null ids form one conversation, null turns
come first and do not count as turns).  An empty role has no legal initial.  Empty and very long texts and
repeated rows are ordinary rows; a conversation without rows gives zeros, an empty audit and the digest of
the empty string; extra columns are ignored; an empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
from collections import deque
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ladle.llm.texts import small_batches

WHITE = " \t\n\v\f\r"
STOPS = ".!?"
KEEP, REROLE, DELETE, INSERT = 0, 2, 3, 2
EMPTY, SYSTEM, USER, ASSISTANT = range(4)
_ROLE = {USER: "user", ASSISTANT: "assistant"}
_LEGAL = {"su", "ua", "au"}


class Node:
    """An edit in the back-pointer tree: ``kids`` counts the edits that follow it, ``held`` the survivors that end in it."""

    __slots__ = ("parent", "letter", "state", "kids", "held")

    def __init__(self, parent: Node | None, letter: str, state: int):
        self.parent, self.letter, self.state, self.held = parent, letter, state, 0
        self.kids: list[Node] = []
        if parent is not None:
            parent.kids.append(self)


class Survivor:
    __slots__ = ("cost", "node")

    def __init__(self, cost: int, node: Node):
        self.cost, self.node = cost, node


class Viterbi:
    """Cheapest edits of a stream of rows; ``step`` and ``finish`` return the edits settled so far.

    An edit is (letter, state after it).
    """

    def __init__(self) -> None:
        self.root = Node(None, "", EMPTY)
        self.alive: dict[int, Survivor] = {EMPTY: Survivor(0, self.root)}
        self.root.held = 1
        # for two survivors: what follows their common beginning, up to the first difference
        self.rest: dict[tuple[int, int], tuple[str, str]] = {}
        self.open = 1  # edits in question, for tests of the memory held

    def _better(self, x: tuple, y: tuple | None) -> bool:
        """Whether path x = (cost, survivor, letters, state...) is to be taken over y."""
        if y is None or x[0] != y[0]:
            return y is None or x[0] < y[0]
        mine, other = self.rest.get((x[1], y[1]), ("", ""))
        return mine + x[2] < other + y[2]

    def _inserts(self, best: dict[int, tuple]) -> None:
        """Paths (cost, survivor, letters, states) into user and assistant by inserted rows."""
        for target, sources in ((USER, (EMPTY, SYSTEM, ASSISTANT)), (ASSISTANT, (USER,))):
            for s in sources:
                if s in best:
                    cost, origin, letters, states = best[s]
                    path = (cost + INSERT, origin, letters + "I", (*states, target))
                    if self._better(path, best.get(target)):
                        best[target] = path

    def _now(self) -> dict[int, tuple]:
        return {s: (v.cost, s, "", ()) for s, v in self.alive.items()}

    def _commit(self, best: dict[int, tuple]) -> list[tuple[str, int]]:
        rest = {}
        for s, x in best.items():
            for t, y in best.items():
                if s < t:
                    mine, other = self.rest.get((x[1], y[1]), ("", ""))
                    mine, other = mine + x[2], other + y[2]
                    same = next((k for k, (c, d) in enumerate(zip(mine, other)) if c != d), None)
                    if same is None:
                        same = min(len(mine), len(other))
                        rest[s, t] = mine[same:], other[same:]
                    else:
                        rest[s, t] = mine[same], other[same]
                    rest[t, s] = rest[s, t][::-1]
        alive = {}
        made: dict[tuple, Node] = {}  # paths of one survivor share their first edits
        for s, (cost, origin, letters, states) in best.items():
            node = self.alive[origin].node
            for k in range(len(letters)):
                key = (origin, letters[:k + 1], states[:k + 1])
                if key not in made:
                    made[key] = Node(node, letters[k], states[k])
                    self.open += 1
                node = made[key]
            node.held += 1
            alive[s] = Survivor(cost, node)
        for old in self.alive.values():
            old.node.held -= 1
            self._release(old.node)
        self.alive, self.rest = alive, rest
        settled = []
        while not self.root.held and len(self.root.kids) == 1:
            self.root = self.root.kids[0]
            self.root.parent = None
            self.open -= 1
            settled.append((self.root.letter, self.root.state))
        return settled

    def _release(self, node: Node) -> None:
        while not node.held and not node.kids and node.parent is not None:
            node.parent.kids.remove(node)
            self.open -= 1
            node = node.parent

    def step(self, initial: str, must_go: bool, truncated: bool) -> list[tuple[str, int]]:
        """Take the next row."""
        before = self._now()
        self._inserts(before)
        best: dict[int, tuple] = {}

        def offer(source: int, target: int, cost: int, letter: str) -> None:
            if source in before:
                at, origin, letters, states = before[source]
                path = (at + cost, origin, letters + letter, (*states, target))
                if self._better(path, best.get(target)):
                    best[target] = path
        for s in range(4):
            offer(s, s, DELETE, "D")
        if not must_go:
            if initial == "s":
                offer(EMPTY, SYSTEM, KEEP + truncated, "K")
            for source in (EMPTY, SYSTEM, ASSISTANT):
                offer(source, USER, (KEEP if initial == "u" else REROLE) + truncated, "K" if initial == "u" else "R")
            offer(USER, ASSISTANT, (KEEP if initial == "a" else REROLE) + truncated, "K" if initial == "a" else "R")
        least = best.get(ASSISTANT)
        if least is not None:
            if EMPTY in best and least[0] + DELETE < best[EMPTY][0]:
                del best[EMPTY]
            if SYSTEM in best and self._better(least, best[SYSTEM]):
                del best[SYSTEM]
        return self._commit(best)

    def finish(self) -> tuple[int, list[tuple[str, int]]]:
        """The whole cost and the edits not yet returned."""
        best = self._now()
        self._inserts(best)
        end = None
        for s in (EMPTY, ASSISTANT):
            if s in best and self._better(best[s], end):
                end = best[s]
        settled = self._commit({end[3][-1] if end[3] else end[1]: end})
        return end[0], settled


class Conversation:
    """One conversation's counts, audit and digest, fed row by row; ``emit`` gets each repaired row."""

    def __init__(self, emit=None):
        self.turns = [None, None, 0]  # lowest, highest, distinct
        self.faults = {"blank": 0, "duplicate": 0, "truncated": 0}
        self.illegal, self.initial = 0, None
        self.viterbi, self.rows = Viterbi(), deque()
        self.audit, self.digest, self.first, self.emit = [], hashlib.sha256(), True, emit

    def add(self, turn: int | None, role: str, text: str, seen: bool) -> None:
        if turn is not None:
            low, high, n = self.turns
            self.turns = [turn if low is None else low, turn, n + (turn != high)]
        printed = text.strip(WHITE)
        fault = "blank" if not printed else "duplicate" if seen else "truncated" if printed[-1] not in STOPS else None
        if fault:
            self.faults[fault] += 1
        if self.initial is not None:
            self.illegal += self.initial + role[:1] not in _LEGAL
        self.initial = role[:1]
        self.rows.append((role, text))
        self._apply(self.viterbi.step(self.initial, fault in ("blank", "duplicate"), fault == "truncated"))

    def _apply(self, edits: list[tuple[str, int]]) -> None:
        for letter, state in edits:
            role, text = self.rows.popleft() if letter != "I" else ("", "")
            self.audit.append(letter)
            if letter == "D":
                continue
            role = role if letter == "K" else _ROLE[state]
            self.digest.update((("" if self.first else "\n") + role + ":").encode())
            self.digest.update(text.encode())
            self.first = False
            if self.emit is not None:
                self.emit(letter, role, text)

    def close(self) -> tuple:
        cost, edits = self.viterbi.finish()
        self._apply(edits)
        low, high, n = self.turns
        gaps = 0 if low is None else (high - low + 1 - n + (1 << 63)) % (1 << 64) - (1 << 63)
        return gaps, *self.faults.values(), self.illegal, cost, "".join(self.audit), self.digest.hexdigest()


def damage(conversations: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role",
           text_col: str = "text") -> DataFrame:
    """The registered query's damage by crc32 of ``conv_id:turn`` modulo 20: 0 drops a row, 1 empties its text, 2 takes its
    stops out, 3 repeats it, 4 makes it a user's.  Dropped rows stay as ``live`` = false, so that
    their conversations do."""
    conv, turn, role, text = (F.col(f"`{c}`") for c in (conv_col, turn_col, role_col, text_col))
    blank = lambda c: F.coalesce(c.cast("string"), F.lit(" "))
    kind = F.crc32(F.concat(blank(conv), F.lit(":"), blank(turn)).cast("binary")) % 20
    d = conversations.select(conv.alias("conv_id"), turn.cast("bigint").alias("turn"), blank(role).alias("role"), blank(text).alias("text"), kind.alias("kind"))
    broken = F.when(F.col("kind") == 1, "").when(F.col("kind") == 2, F.translate("text", STOPS, "")).otherwise(F.col("text"))
    role = F.when(F.col("kind") == 4, "user").otherwise(F.col("role"))
    live = F.col("kind") != 0
    return d.select("conv_id", "turn", F.when(live, role).alias("role"), F.when(live, broken).alias("text"), live.alias("live"),
                    F.explode(F.sequence(F.lit(1), F.when(F.col("kind") == 3, 2).otherwise(1))).alias("copy")).drop("copy")


def in_order(rows: DataFrame) -> DataFrame:
    """conv_id, turn, role, text, live, seen: partitions hold whole conversations, sorted; ``rows`` has the first five."""
    small_batches(rows.sparkSession)
    # one exchange: the window's keys begin with the key that the rows are dealt by
    dealt = rows.repartition("conv_id")
    nth = F.row_number().over(Window.partitionBy("conv_id", "live", "role", "text").orderBy(F.col("turn").asc_nulls_first()))
    return (dealt.select("*", nth.alias("nth"))
                 .sortWithinPartitions(F.col("conv_id").asc_nulls_first(), F.col("turn").asc_nulls_first(), "role", "text", "nth")
                 .select("conv_id", "turn", "role", "text", "live", (F.col("nth") > 1).alias("seen")))


def _conversations(batches: Iterator[pa.RecordBatch], make) -> Iterator[tuple]:
    """(conv_id, closed conversation) in the order of a task's rows."""
    now, key = None, None
    for batch in batches:
        for conv, turn, role, text, live, seen in zip(*(c.to_pylist() for c in batch.columns)):
            if now is None or conv != key:
                if now is not None:
                    yield key, now
                now, key = make(conv), conv
            if live:
                now.add(turn, role, text, seen)
    if now is not None:
        yield key, now


_REPORT = ["gaps", "blank", "duplicate", "truncated", "illegal", "cost"]


def audit(rows: DataFrame) -> DataFrame:
    """One row a conversation: its faults, the cheapest repair's cost and edits, and the digest of the repaired text."""
    kind = rows.schema["conv_id"].dataType.simpleString()

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names, held, arrow = ["conv_id", *_REPORT, "audit", "repaired_sha256"], [], None

        def batch_of() -> pa.RecordBatch:
            columns = list(zip(*held))
            types = [arrow, *[pa.int64()] * len(_REPORT), pa.string(), pa.string()]
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types)], names=names)

        def watched() -> Iterator[pa.RecordBatch]:
            nonlocal arrow
            for b in batches:
                arrow = b.schema.field(0).type
                yield b
        for key, conversation in _conversations(watched(), lambda _: Conversation()):
            held.append((key, *conversation.close()))
            if len(held) == 1024:
                yield batch_of()
                held.clear()
        if held:
            yield batch_of()
    columns = ", ".join(f"{c} bigint" for c in _REPORT)
    return in_order(rows).mapInArrow(task, f"conv_id {kind}, {columns}, audit string, repaired_sha256 string")


def repair(conversations: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role",
           text_col: str = "text") -> DataFrame:
    """The repaired rows themselves: conv_id, position, role, text and the edit (K, R or I) that made them."""
    conv, turn = F.col(f"`{conv_col}`"), F.col(f"`{turn_col}`")
    rows = conversations.select(conv.alias("conv_id"), turn.cast("bigint").alias("turn"), F.coalesce(F.col(f"`{role_col}`"), F.lit(" ")).alias("role"),
                                F.coalesce(F.col(f"`{text_col}`"), F.lit(" ")).alias("text"), F.lit(True).alias("live"))
    kind = rows.schema["conv_id"].dataType.simpleString()

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names, out = ["conv_id", "position", "role", "text", "edit"], []

        def make(conv) -> Conversation:
            position = iter(range(1 << 62))
            return Conversation(lambda letter, role, text: out.append((conv, next(position), role, text, letter)))

        def made(arrow: pa.DataType) -> pa.RecordBatch:
            types = [arrow, pa.int64(), pa.string(), pa.string(), pa.string()]
            batch = pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), types)], names=names)
            out.clear()
            return batch
        now, key, arrow = None, None, None
        for batch in batches:
            arrow = batch.schema.field(0).type
            for conv, turn, role, text, _, seen in zip(*(c.to_pylist() for c in batch.columns)):
                if now is None or conv != key:
                    if now is not None:
                        now.close()
                    now, key = make(conv), conv
                now.add(turn, role, text, seen)
            if out:
                yield made(arrow)
        if now is not None:
            now.close()
            if out:
                yield made(arrow)
    return in_order(rows).mapInArrow(task, f"conv_id {kind}, position bigint, role string, text string, edit string")
