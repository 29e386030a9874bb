"""Repairing the structure of conversations with the cheapest audit.

An audit is one letter per edit: ``K`` keeps a turn, ``R`` changes its role to user or
assistant, ``D`` deletes it, ``I`` inserts a turn without text. A conversation is
well formed when the initials of its roles read ``(s?(ua)+)?``. A dynamic program
goes through the turns and holds the cheapest audit per state of that expression;
among equal costs the least text counts.

Audits share their prefixes: each is a node of a tree, linked to the audit without
its last letter. A node has a rolling hash and its ancestors at distances 1, 2, 4 …,
so two audits are compared by a search for their longest common prefix. Equal texts
are one node, which verifies equal hashes.

Conversations stream through a task in order of their turns. What all audits of a
conversation agree on is settled and written, so a task holds the turns since the
last agreement and not the conversation; a state that is beaten by more than the
price of catching up is dropped, which makes them agree soon. Earlier equal turns
are found by aggregates over digests, not by a memory of all turns. Only the hash
of the repaired text and the audit itself have to be made one turn after the other.
"""

from __future__ import annotations

import hashlib
from collections import deque
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

KEEP, REROLE, DELETE, INSERT = "K", "R", "D", "I"
_RECAST, _DROPPED, _ADDED, _CUT = 1, 2, 5, 5
_BLANKS = " \t\n\x0b\x0c\r"
_ENDS = ".!?"
_FOLLOWS = frozenset(("su", "ua", "au"))
#: States of the expression: nothing yet, after the system turn, after a user turn, after an assistant turn.
_START, _SYSTEM, _USER, _ASSISTANT = range(4)
_SPOKEN = {_START: _USER, _SYSTEM: _USER, _USER: _ASSISTANT, _ASSISTANT: _USER}
_ROLES = {_USER: "user", _ASSISTANT: "assistant"}
#: Turns between two looks for what all audits agree on.
_SETTLE = 64
_MODULUS, _BASE = (1 << 61) - 1, 0x5DEECE66D


class Audits:
    """Texts as linked nodes; node 0 is the empty text."""

    def __init__(self):
        self.letter, self.depth, self.hash = [""], [0], [0]
        self.above: list[list[int]] = [[]]  # ancestors at distances 1, 2, 4 ...
        self.known: dict[tuple[int, str], int] = {}

    def add(self, node: int, letter: str) -> int:
        """The node of ``node``'s text and one more letter."""
        found = self.known.get((node, letter))
        if found is not None:
            return found
        above, k = [node], 0
        while k < len(self.above[above[k]]):
            above.append(self.above[above[k]][k])
            k += 1
        new = len(self.letter)
        self.letter.append(letter)
        self.depth.append(self.depth[node] + 1)
        self.hash.append((self.hash[node] * _BASE + ord(letter)) % _MODULUS)
        self.above.append(above)
        self.known[node, letter] = new
        return new

    def prefix(self, node: int, length: int) -> int:
        """The node of the first ``length`` letters."""
        excess = self.depth[node] - length
        while excess > 0:
            k = excess.bit_length() - 1
            node = self.above[node][k]
            excess -= 1 << k
        return node

    def _same(self, a: int, b: int) -> bool:
        return self.hash[a] == self.hash[b] and a == b  # one node per text: a collision of hashes is no equality

    def fork(self, a: int, b: int) -> tuple[int, int, int]:
        """The node of the longest common prefix, and the next node of either text (the common one where it ends)."""
        length = min(self.depth[a], self.depth[b])
        x, y = self.prefix(a, length), self.prefix(b, length)
        if self._same(x, y):
            return x, (self.prefix(a, length + 1) if self.depth[a] > length else x), (self.prefix(b, length + 1) if self.depth[b] > length else x)
        for k in range(len(self.above[x]) - 1, -1, -1):
            if k < len(self.above[x]) and not self._same(self.above[x][k], self.above[y][k]):
                x, y = self.above[x][k], self.above[y][k]
        return self.above[x][0], x, y

    def less(self, a: int, b: int) -> bool:
        if a == b:
            return False
        common, x, y = self.fork(a, b)
        if x == common or y == common:
            return x == common
        return self.letter[x] < self.letter[y]

    def text(self, node: int, start: int = 0) -> str:
        """The letters of ``node`` after those of its prefix ``start``."""
        letters = []
        while node != start:
            letters.append(self.letter[node])
            node = self.above[node][0]
        return "".join(reversed(letters))


class Repair:
    """The audit of one conversation, turn by turn; ``write(role, text)`` gets the repaired turns in order."""

    def __init__(self, write: Callable[[str, str], None]):
        self.write = write
        self.tree = Audits()
        self.heads: list[tuple[int, int] | None] = [(0, 0), None, None, None]
        self.pending: deque[tuple[str, str]] = deque()
        self.settled: list[str] = []
        self.state = _START

    def _offer(self, heads: list, state: int, cost: int, node: int, letter: str) -> None:
        held = heads[state]
        if held is None or cost < held[0]:
            heads[state] = (cost, self.tree.add(node, letter))
        elif cost == held[0]:
            new = self.tree.add(node, letter)
            if self.tree.less(new, held[1]):
                heads[state] = (cost, new)

    def _insert(self) -> None:
        """Turns that are inserted here: any state to user, then user to assistant; a longer run only costs more."""
        heads = self.heads
        for state in (_START, _SYSTEM, _ASSISTANT):
            if heads[state]:
                self._offer(heads, _USER, heads[state][0] + _ADDED, heads[state][1], INSERT)
        if heads[_USER]:
            self._offer(heads, _ASSISTANT, heads[_USER][0] + _ADDED, heads[_USER][1], INSERT)

    def turn(self, role: str, text: str, unusable: bool, truncated: bool) -> None:
        """The next turn; an unusable one (blank or repeated) can only be deleted."""
        self._insert()
        heads: list[tuple[int, int] | None] = [None] * 4
        initial, extra = role[:1], _CUT if truncated else 0
        for state, head in enumerate(self.heads):
            if head is None:
                continue
            cost, node = head
            self._offer(heads, state, cost + _DROPPED, node, DELETE)
            if unusable:
                continue
            spoken = _SPOKEN[state]
            if initial == "s" and state == _START:
                self._offer(heads, _SYSTEM, cost + extra, node, KEEP)
            if initial and initial == _ROLES[spoken][0]:
                self._offer(heads, spoken, cost + extra, node, KEEP)
            else:
                self._offer(heads, spoken, cost + extra + _RECAST, node, REROLE)
        self.heads = heads
        self.pending.append((role, text))
        self._drop_beaten()
        if len(self.pending) >= _SETTLE and len(self.pending) % _SETTLE == 0:
            self._settle()

    def _drop_beaten(self) -> None:
        """Without states that another one could follow up to the same end for less.

        Whatever the start or the system state goes on to do, the assistant state
        can do too, but for keeping a system turn, which it deletes; one inserted
        turn leads from user to assistant and back.
        """
        heads = self.heads
        cost = [head[0] if head else 1 << 62 for head in heads]
        after = min(cost[_ASSISTANT], cost[_USER] + _ADDED)
        if after + _DROPPED < cost[_START]:
            heads[_START] = None
        if after < cost[_SYSTEM]:
            heads[_SYSTEM] = None
        if cost[_USER] + _ADDED < cost[_ASSISTANT]:
            heads[_ASSISTANT] = None
        if cost[_ASSISTANT] + _ADDED < cost[_USER]:
            heads[_USER] = None

    def _settle(self) -> None:
        """Write what all audits agree on and keep the rest of each in a new tree."""
        nodes = [head[1] for head in self.heads if head]
        common = nodes[0]
        for node in nodes[1:]:
            common = self.tree.fork(common, node)[0]
        if not common:
            return
        self._apply(self.tree.text(common))
        old, self.tree = self.tree, Audits()
        for state, head in enumerate(self.heads):
            if head:
                node = 0
                for letter in old.text(head[1], common):
                    node = self.tree.add(node, letter)
                self.heads[state] = (head[0], node)

    def _apply(self, letters: str) -> None:
        self.settled.append(letters)
        for letter in letters:
            if letter == INSERT:
                role, text = None, ""
            else:
                role, text = self.pending.popleft()
                if letter == DELETE:
                    continue
            if letter == KEEP:
                self.state = {"s": _SYSTEM, "u": _USER, "a": _ASSISTANT}[role[0]]
            else:
                self.state = _SPOKEN[self.state]
                role = _ROLES[self.state]
            self.write(role, text)

    def finish(self) -> tuple[int, str]:
        """Cost and audit of the whole conversation."""
        self._insert()
        ends = [head for state, head in enumerate(self.heads) if head and state in (_START, _ASSISTANT)]
        best = ends[0]
        for head in ends[1:]:
            if head[0] < best[0] or head[0] == best[0] and self.tree.less(head[1], best[1]):
                best = head
        self._apply(self.tree.text(best[1]))
        return best[0], "".join(self.settled)


class _Conversation:
    """Counts, repair and hash of one conversation while its turns go by."""

    def __init__(self, name, on_turn: Callable[[object, int, str, str], None] | None):
        self.name, self.on_turn = name, on_turn
        self.gaps = [None, None, 0]  # first, last, different turns
        self.counts = {"blank": 0, "duplicate": 0, "truncated": 0, "illegal": 0}
        self.before: str | None = None
        self.sha, self.written = hashlib.sha256(), 0
        self.repair = Repair(self._write)

    def _write(self, role: str, text: str) -> None:
        if self.on_turn:
            self.on_turn(self.name, self.written, role, text)
        self.sha.update((("\n" if self.written else "") + f"{role}:{text}").encode("utf-8", "surrogatepass"))
        self.written += 1

    def add(self, turn, role: str, text: str, repeated: bool) -> None:
        gaps = self.gaps
        if turn is not None:
            if gaps[0] is None:
                gaps[0] = turn
            if gaps[1] != turn:
                gaps[1] = turn
                gaps[2] += 1
        last = text.rstrip(_BLANKS)[-1:]
        blank = not last
        truncated = not blank and not repeated and last not in _ENDS
        counts = self.counts
        counts["blank"] += blank
        counts["duplicate"] += repeated and not blank
        counts["truncated"] += truncated
        if self.before is not None and self.before + role[:1] not in _FOLLOWS:
            counts["illegal"] += 1
        self.before = role[:1]
        self.repair.turn(role, text, blank or repeated, truncated)

    def row(self) -> tuple:
        cost, audit = self.repair.finish()
        first, last, different = self.gaps
        gaps = 0 if first is None else last - first + 1 - different
        return (self.name, gaps, *self.counts.values(), cost, audit, self.sha.hexdigest())


#: Result columns behind the conversation: name, Spark type, Arrow type.
_FAULTS = [
    *((name, "long", pa.int64()) for name in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")),
    ("audit", "string", pa.string()),
    ("repaired_sha256", "string", pa.string()),
]
_TURNS = [("position", "long", pa.int64()), ("role", "string", pa.string()), ("text", "string", pa.string())]


def _stream(rows: DataFrame, conv_id: str, turn: str, role: str, text: str, present: Column | None) -> DataFrame:
    """Turns of each conversation in order, with marks of those that occur more than once before them.

    ``kind``: 0 only names the conversation, 1 marks that turns like the next ones
    occur in an earlier turn number, 2 that they occur again, 3 is a turn.
    """
    there = F.lit(True) if present is None else F.coalesce(present, F.lit(False))
    base = rows.select(
        F.col(conv_id).alias("conv"),
        F.col(turn).cast("long").alias("turn"),
        F.coalesce(F.col(role).cast("string"), F.lit(" ")).alias("role"),
        F.coalesce(F.col(text).cast("string"), F.lit(" ")).alias("text"),
        there.alias("there"),
    )
    turns = base.where("there").withColumn("digest", F.unhex(F.sha2(F.concat(F.length("role").cast("string"), F.lit(":"), "role", "text"), 256)))
    equal = turns.groupBy("conv", "turn", "digest").agg(F.count("*").alias("n"))
    order = F.struct(F.col("turn").isNotNull().alias("numbered"), F.col("turn"))
    first = equal.groupBy("conv", "digest").agg(F.min(order).alias("first"), F.sum("n").alias("times")).where("times > 1").alias("f")
    marked = equal.alias("e").join(first, F.col("e.conv").eqNullSafe(F.col("f.conv")) & (F.col("e.digest") == F.col("f.digest")))
    marks = marked.select(
        "e.conv", "e.turn", F.lit(None).cast("string").alias("role"), F.lit(None).cast("string").alias("text"), "e.digest",
        F.when(F.col("e.turn").eqNullSafe(F.col("f.first.turn")), 2).otherwise(1).alias("kind"),
    )
    empty = F.lit(None).cast("string")
    names = base.where(~F.col("there")).select(
        "conv", F.lit(None).cast("long").alias("turn"), empty.alias("role"), empty.alias("text"), F.lit(b"").alias("digest"), F.lit(0).alias("kind")
    )
    shown = turns.select("conv", "turn", "role", "text", "digest", F.lit(3).alias("kind"))
    in_order = ["conv", F.asc_nulls_first("turn"), "digest", "kind"]
    return shown.unionByName(marks).unionByName(names).repartition("conv").sortWithinPartitions(*in_order)


def _conversations(batches: Iterator[pa.RecordBatch], done: Callable, on_turn: Callable | None, flush: Callable) -> Iterator[pa.RecordBatch]:
    now: _Conversation | None = None
    mark, earlier = None, False
    for batch in batches:
        for name, turn, role, text, digest, kind in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            if now is None or name != now.name:
                if now is not None:
                    done(now.row())
                now, mark = _Conversation(name, on_turn), None
            if kind in (1, 2):
                mark, earlier = (turn, digest), kind == 1
            elif kind == 3:
                same = mark == (turn, digest)
                now.add(turn, role, text, same and earlier)
                earlier = earlier or same
        yield from flush()
    if now is not None:
        done(now.row())
        yield from flush()


def _run(stream: DataFrame, name: str, columns: list[tuple], as_turns: bool) -> DataFrame:
    kind = dict(stream.dtypes)["conv"]
    spark_schema = ", ".join([f"conv {kind}", *(f"{c} {t}" for c, t, _ in columns)])

    def work(batches):
        rows: list[tuple] = []
        arrow: list[pa.DataType] = []

        def remembered():
            for batch in batches:
                arrow[:] = [batch.schema.field("conv").type, *(t for *_, t in columns)]
                yield batch

        def flush():
            if rows:
                arrays = [pa.array(c, t) for c, t in zip(zip(*rows, strict=True), arrow, strict=True)]
                yield pa.RecordBatch.from_arrays(arrays, ["conv", *(c for c, *_ in columns)])
                rows.clear()

        if as_turns:
            yield from _conversations(remembered(), lambda row: None, lambda *turn: rows.append(turn), flush)
        else:
            yield from _conversations(remembered(), rows.append, None, flush)

    return stream.mapInArrow(work, spark_schema).withColumnRenamed("conv", name)


def repair_conversations(
    rows: DataFrame, conv_id: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text", present: Column | None = None
) -> DataFrame:
    """One row per conversation: its faults, the cheapest audit, its cost and the hash of the repaired turns.

    Turns are taken in order of ``turn``, nulls first, equal numbers in an order
    that depends on their contents alone, equal turns side by side. A null role or
    text counts as one blank; rows without a conversation form one of their own.
    Where ``present`` is false a row only names its conversation, so that one
    without turns is returned with zeros, an empty audit and the hash of nothing.
    Other columns are ignored; an empty table gives an empty result.

    The first fault of a turn counts: ``blank``, ``duplicate`` (role and text
    occur earlier), ``truncated`` (does not end in ``.``, ``!`` or ``?``).
    """
    return _run(_stream(rows, conv_id, turn, role, text, present), conv_id, _FAULTS, False)


def repaired_turns(
    rows: DataFrame, conv_id: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text", present: Column | None = None
) -> DataFrame:
    """The repaired turns themselves, ``(conv_id, position, role, text)``, read as in repair_conversations."""
    return _run(_stream(rows, conv_id, turn, role, text, present), conv_id, _TURNS, True)


def damage(conversations: DataFrame) -> DataFrame:
    """``conversations`` with faults chosen by the CRC of conversation and turn; ``present`` is false for dropped turns."""
    blank = F.lit(" ")
    key = F.concat(F.coalesce(F.col("conv_id").cast("string"), blank), F.lit(":"), F.coalesce(F.col("turn").cast("string"), blank))
    fault = F.crc32(key.cast("binary")) % 20
    text = F.coalesce("text", blank)
    damaged = conversations.select(
        "conv_id",
        "turn",
        F.when(fault == 4, "user").otherwise(F.coalesce("role", blank)).alias("role"),
        F.when(fault == 1, "").when(fault == 2, F.translate(text, _ENDS, "")).otherwise(text).alias("text"),
        (fault != 0).alias("present"),
        F.when(fault == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0))).alias("copies"),
    )
    return damaged.withColumn("copies", F.explode("copies")).drop("copies")
