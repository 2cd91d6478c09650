"""Conversation structure repair by a persistent audit DP.

Rows are edited until the roles' initials read ``(s?(ua)+)?``: Keep (0), Rerole to user or assistant (2), Delete (3,
required of blank and repeated rows), Insert an empty user or assistant row (2); a truncated row that stays adds 1. Of
the cheapest audits (the edits' initials in order) the ASCII-least is taken. What has been emitted so far is one of four
states, and an audit determines it; so one cheapest audit for each state is all that a row hands to the next.

Audits are linked nodes that share their prefixes. Each node knows its ancestors at the powers of two and a rolling
hash of all its letters: a tie is settled at the letters after the longest common prefix, which the ancestors' hashes
find and the nodes themselves confirm. Where all live audits share a prefix, it is final and its nodes are dropped.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from itertools import chain

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from presslake.llm.common import SPACES, read, slices

KEEP, REROLE, DELETE, INSERT = "K", "R", "D", "I"
COST = {KEEP: 0, REROLE: 2, DELETE: 3, INSERT: 2}
TRUNCATED = 1
# What has been emitted: nothing, a system row, a user row last, an assistant row last.
NOTHING, SYSTEM, USER, ASSISTANT = range(4)
#: Cost and audit that complete the pattern from each state.
CLOSING = {NOTHING: "", SYSTEM: INSERT * 2, USER: INSERT, ASSISTANT: ""}
LEGAL = {"su", "ua", "au"}
#: A state that costs more than another plus this cannot be on a cheapest audit: whatever follows can follow the other one for that.
EXCESS = {(NOTHING, ASSISTANT): 3, (NOTHING, USER): 5, (NOTHING, SYSTEM): 4, (SYSTEM, ASSISTANT): 0, (SYSTEM, USER): 2,
          (USER, ASSISTANT): 2, (ASSISTANT, USER): 2}
#: Nodes that are made before shared prefixes are looked for again.
NODES = 4_096


def made(state: int) -> tuple[str, int]:
    """The role that Rerole or Insert emits in a state, and the state after it."""
    return ("assistant", ASSISTANT) if state == USER else ("user", USER)


def kept(state: int, initial: str) -> int | None:
    """The state after a kept row; None where the pattern does not allow it."""
    if initial == "s":
        return SYSTEM if state == NOTHING else None
    if initial == "a":
        return ASSISTANT if state == USER else None
    return USER if initial == "u" and state != USER else None


def _moves(initial: str, must_delete: bool, truncated: bool) -> list[list[tuple[int, int, str]]]:
    """From each state: (state after, cost, letters) of the best way past one row, inserts before it first."""
    out = []
    for start in range(4):
        best, state, letters, cost, been = {}, start, "", 0, set()
        while state not in been:
            been.add(state)
            ways = [(state, DELETE, 0)]
            if not must_delete:
                ways.append((made(state)[1], REROLE, truncated))
                if kept(state, initial) is not None:
                    ways.append((kept(state, initial), KEEP, truncated))
            for to, letter, more in ways:
                best[to] = min(best.get(to, (99, "")), (cost + COST[letter] + more * TRUNCATED, letters + letter))
            state, letters, cost = made(state)[1], letters + INSERT, cost + COST[INSERT]
        out.append([(to, c, s) for to, (c, s) in best.items()])
    return out


MOVES = {(i, d, t): _moves(i, d, t) for i in ("s", "u", "a", "") for d in (False, True) for t in (False, True)}


class Prefixes:
    """Strings that share prefixes, as linked nodes; node 0 is the empty string."""

    def __init__(self, base: int = 1_000_003, modulus: int = (1 << 61) - 1):
        self.base, self.modulus = base, modulus
        self.label, self.up, self.depth, self.hash = [""], [()], [0], [0]
        self.collisions = 0

    def add(self, node: int, letter: str) -> int:
        up, k = [node], 0
        while k < len(self.up[up[k]]):
            up.append(self.up[up[k]][k])
            k += 1
        self.label.append(letter)
        self.up.append(up)
        self.depth.append(self.depth[node] + 1)
        self.hash.append((self.hash[node] * self.base + ord(letter)) % self.modulus)
        return len(self.label) - 1

    def extend(self, node: int, letters: str) -> int:
        for x in letters:
            node = self.add(node, x)
        return node

    def ancestor(self, node: int, depth: int) -> int:
        while (gap := self.depth[node] - depth) > 0:
            node = self.up[node][gap.bit_length() - 1]
        return node

    def letters(self, node: int, above: int = 0) -> str:
        """The string from the ancestor ``above`` (not included) down to the node."""
        out = []
        while node != above:
            out.append(self.label[node])
            node = self.up[node][0]
        return "".join(reversed(out))

    def _first_difference(self, a: int, b: int) -> tuple[int, int] | None:
        """Of two nodes of one depth, the ancestors nearest the root whose letters differ: walked, not hashed."""
        found = None
        while a != b:
            if self.label[a] != self.label[b]:
                found = a, b
            a, b = self.up[a][0], self.up[b][0]
        return found

    def less(self, a: int, b: int) -> bool:
        """Whether string ``a`` sorts before ``b``; a prefix sorts first."""
        depth = min(self.depth[a], self.depth[b])
        x, y = self.ancestor(a, depth), self.ancestor(b, depth)
        if self.hash[x] == self.hash[y]:
            low = x, y  # by the hashes, one is a prefix of the other
            x = y = None
        else:
            for k in range(len(self.up[x]) - 1, -1, -1):
                if k < len(self.up[x]) and self.hash[self.up[x][k]] != self.hash[self.up[y][k]]:
                    x, y = self.up[x][k], self.up[y][k]
            low = self.up[x][0], self.up[y][0]
        if low[0] != low[1] and (differ := self._first_difference(*low)):  # equal hashes of unequal strings
            self.collisions += 1
            x, y = differ
        return self.depth[a] < self.depth[b] if x is None else self.label[x] < self.label[y]


class Repair:
    """The cheapest audits of a conversation whose rows are given one by one, and the hash of each one's repaired text."""

    def __init__(self):
        self.tree, self.final, self.limit = Prefixes(), [], NODES
        self.live = {NOTHING: (0, 0)}
        self.text = {NOTHING: hashlib.sha256()}

    def row(self, role: str, text: str, must_delete: bool, truncated: bool) -> None:
        initial = role[:1]
        moves = MOVES[initial if initial in ("s", "u", "a") else "", must_delete, truncated]
        best: dict[int, tuple] = {}
        for state, (cost, node) in self.live.items():
            for to, more, letters in moves[state]:
                total, old = cost + more, best.get(to)
                if old is None or total < old[0] or total == old[0] and self._less(node, letters, old[1], old[2]):
                    best[to] = total, node, letters, state
        for (worse, other), excess in EXCESS.items():
            if worse in best and other in best and best[worse][0] > best[other][0] + excess:
                del best[worse]
        line = None
        live, hashed = {}, {}
        for to, (cost, node, letters, state) in best.items():
            live[to] = cost, self.tree.extend(node, letters)
            if letters == DELETE:
                hashed[to] = self.text[state].copy()
                continue
            line = f":{text}".encode() if line is None else line
            hashed[to] = self._emitted(self.text[state].copy(), state, letters, role, line)
        self.live, self.text = live, hashed
        if len(self.tree.label) > self.limit:
            self._settle()

    @staticmethod
    def _emitted(out, state: int, letters: str, role: str, line: bytes):
        for letter in letters:
            if letter == DELETE:
                continue
            if state != NOTHING:
                out.update(b"\n")
            if letter == KEEP:
                out.update(role.encode())
                state = kept(state, role[:1])
            else:
                new, state = made(state)
                out.update(new.encode())
            out.update(b":" if letter == INSERT else line)
        return out

    def _less(self, a: int, letters: str, b: int, others: str) -> bool:
        if a == b:
            return letters < others
        return self.tree.less(self.tree.extend(a, letters), self.tree.extend(b, others))

    def _settle(self) -> None:
        """Drop the nodes that no live audit holds, and take the prefix that all share out of the tree."""
        old, ends = self.tree, [n for _, n in self.live.values()]
        shared = ends[0]
        for n in ends[1:]:
            depth = min(old.depth[shared], old.depth[n])
            a, b = old.ancestor(shared, depth), old.ancestor(n, depth)
            for k in range(len(old.up[a]) - 1, -1, -1):
                if k < len(old.up[a]) and old.up[a][k] != old.up[b][k]:
                    a, b = old.up[a][k], old.up[b][k]
            shared = a if a == b else old.up[a][0]
        self.final.append(old.letters(shared))
        self.tree, new = Prefixes(), {shared: 0}
        for n in ends:
            path = []
            while n not in new:
                path.append(n)
                n = old.up[n][0]
            for x in reversed(path):
                new[x] = self.tree.add(new[old.up[x][0]], old.label[x])
        self.live = {s: (c, new[n]) for s, (c, n) in self.live.items()}
        self.limit = NODES + 2 * len(self.tree.label)

    def close(self) -> tuple[int, str, str]:
        """(cost, audit, sha256 of the repaired ``role:text`` lines)."""
        best = None
        for state, (cost, node) in self.live.items():
            letters = CLOSING[state]
            total = cost + sum(COST[x] for x in letters)
            if best is None or total < best[0] or total == best[0] and self._less(node, letters, best[1], best[2]):
                best = total, node, letters, state
        cost, node, letters, state = best
        out = self._emitted(self.text[state].copy(), state, letters, "", b"")
        return cost, "".join(self.final) + self.tree.letters(node) + letters, out.hexdigest()


_AUDIT = "gaps long, blank long, duplicate long, truncated long, illegal long, cost long, audit string, repaired_sha256 string"
_ENDS = (".", "!", "?")


class _Conversation:
    """Counts and repair of one conversation, row by row in order."""

    def __init__(self, name):
        self.name, self.repair = name, Repair()
        self.low = self.high = self.last = None
        self.turns = self.blank = self.duplicate = self.truncated = self.illegal = 0

    def row(self, turn: int | None, role: str, text: str, copy: bool) -> None:
        if turn is not None and turn != self.high:  # turns ascend
            self.low = turn if self.low is None else self.low
            self.high, self.turns = turn, self.turns + 1
        rest = text.rstrip(SPACES)
        blank = not rest
        duplicate = not blank and copy
        truncated = not blank and not duplicate and not rest.endswith(_ENDS)
        self.blank += blank
        self.duplicate += duplicate
        self.truncated += truncated
        if self.last is not None and self.last + role[:1] not in LEGAL:
            self.illegal += 1
        self.last = role[:1]
        self.repair.row(role, text, blank or duplicate, truncated)

    def result(self) -> tuple:
        gaps = 0 if self.low is None else self.high - self.low + 1 - self.turns
        return (self.name, gaps, self.blank, self.duplicate, self.truncated, self.illegal, *self.repair.close())


def _ordered(rows: DataFrame, id_col: str, turn_col: str, role_col: str, text_col: str, present_col: str | None) -> DataFrame:
    """``(id, turn, role, text, present, copy)``: a conversation's rows in one task, in order; ``copy``: the role and
    text stand earlier. The window's sort and the last one lie in the same exchange, and both spill."""
    def written(c):
        return F.coalesce(F.col(c).cast("string"), F.lit(" "))
    present = F.col(present_col) if present_col else F.lit(True)
    rows = rows.select(F.col(id_col).alias("id"), F.col(turn_col).cast("long").alias("turn"), written(role_col).alias("role"),
                       written(text_col).alias("text"), present.alias("present"))
    order = [F.col("turn").asc_nulls_first(), F.col("role"), F.col("text")]
    same = Window.partitionBy("id", "present", F.sha2(F.concat_ws(":", F.length("role").cast("string"), "role", "text"), 256)).orderBy("turn")
    return (rows.repartition("id").withColumn("copy", F.row_number().over(same) > 1)
            .sortWithinPartitions(F.col("id").asc_nulls_first(), *order))


def audit_conversations(rows: DataFrame, id_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role",
                        text_col: str = "text", present_col: str | None = None) -> DataFrame:
    """One row a conversation: ``id`` and its faults, cost, audit and the repaired text's hash.

    Rows are taken by turn (NULL first), ties by role, then text. A NULL role or text is one space; a NULL id is a conversation
    of its own; empty texts are blank; repeated rows are duplicates; no rows give none; other columns are not read. A row whose
    ``present_col`` is false only names its conversation: one of such rows alone has zeros, an empty audit and
    the hash of the empty string.

    A conversation is one stream in one task, since a hash of all its text is: its rows come from Spark's sort, which spills;
    what is held is the audit (which the result holds too) and, between settled prefixes, some nodes a row.
    """
    def run(batches: Iterator[pa.RecordBatch]):
        now, done = None, []

        def flushed():
            batch = pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*done), types)], names)
            done.clear()
            return batch
        for batch in chain.from_iterable(map(slices, batches)):
            for name, turn, role, text, present, copy in zip(*(c.to_pylist() for c in batch.columns)):
                if now is None or now.name != name:
                    if now is not None:
                        done.append(now.result())
                    now = _Conversation(name)
                if present:
                    now.row(turn, role, text, copy)
            if done:
                yield flushed()
        if now is not None:
            done.append(now.result())
            yield flushed()

    ordered = _ordered(rows, id_col, turn_col, role_col, text_col, present_col)
    kind = ordered.schema["id"].dataType
    names = ["id", *[c.split()[0] for c in _AUDIT.split(", ")]]
    types = [_arrow(kind), *[pa.int64()] * 6, pa.string(), pa.string()]
    return ordered.mapInArrow(run, f"id {kind.simpleString()}, {_AUDIT}")


def _arrow(kind) -> pa.DataType:
    from pyspark.sql.pandas.types import to_arrow_type
    return to_arrow_type(kind)


def repaired_rows(rows: DataFrame, id_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role",
                  text_col: str = "text") -> DataFrame:
    """The repaired conversations: ``(id, n, turn, role, text, edit)``, ``n`` from 0 in each; an inserted row has a NULL
    turn and an empty text. Order, NULLs, ties and repeats are those of :func:`audit_conversations`; a conversation that is
    deleted whole has no rows; no rows give none.

    The audits are cut into one piece a row and follow the rows in the same order: two passes, so no text waits for its edit.
    """
    ordered = _ordered(rows, id_col, turn_col, role_col, text_col, None)
    place = Window.partitionBy("id").orderBy(F.col("turn").asc_nulls_first(), "role", "text")
    ordered = ordered.withColumn("at", F.row_number().over(place) - 1)
    audits = audit_conversations(rows, id_col, turn_col, role_col, text_col).select(
        F.col("id").alias("_id"), F.posexplode(F.expr("regexp_extract_all(audit, '(I*[KRD](?:I+$)?)', 1)")).alias("_at", "edits"))
    joined = ordered.join(audits, ordered["id"].eqNullSafe(audits["_id"]) & (ordered["at"] == audits["_at"]))
    joined = (joined.select("id", "at", "turn", "role", "text", "edits").repartition("id")
              .sortWithinPartitions(F.col("id").asc_nulls_first(), "at"))

    def run(batches: Iterator[pa.RecordBatch]):
        name, state, n = None, NOTHING, 0
        for batch in chain.from_iterable(map(slices, batches)):
            out = []
            for i, at, turn, role, text, edits in zip(*(c.to_pylist() for c in batch.columns)):
                if at == 0 or i != name:
                    name, state, n = i, NOTHING, 0
                for edit in edits:
                    if edit == DELETE:
                        continue
                    if edit == KEEP:
                        new, state = role, kept(state, role[:1])
                    else:
                        new, state = made(state)
                    out.append((i, n, None, new, "", edit) if edit == INSERT else (i, n, turn, new, text, edit))
                    n += 1
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), types)],
                                                 ["id", "n", "turn", "role", "text", "edit"])

    kind = ordered.schema["id"].dataType
    types = [_arrow(kind), pa.int64(), pa.int64(), pa.string(), pa.string(), pa.string()]
    return joined.mapInArrow(run, f"id {kind.simpleString()}, n long, turn long, role string, text string, edit string")


def damaged(conversations: DataFrame) -> DataFrame:
    """The contract's damage. NULLs are written as one space (a turn keeps its NULL for the order); a dropped row stays with
    ``present`` false, to name its conversation."""
    text = F.coalesce(F.col("text"), F.lit(" "))
    key = F.concat(F.coalesce(F.col("conv_id").cast("string"), F.lit(" ")), F.lit(":"),
                   F.coalesce(F.col("turn").cast("string"), F.lit(" ")))
    rows = conversations.select("conv_id", "turn", F.coalesce(F.col("role"), F.lit(" ")).alias("role"), text.alias("text"),
                                (F.crc32(key) % 20).alias("way"))
    rows = rows.select(
        "conv_id", "turn", F.when(F.col("way") == 4, F.lit("user")).otherwise(F.col("role")).alias("role"),
        F.when(F.col("way") <= 1, F.lit("")).when(F.col("way") == 2, F.regexp_replace("text", "[.!?]", "")).otherwise(F.col("text")).alias("text"),
        (F.col("way") != 0).alias("present"), F.array_repeat(F.lit(0), F.when(F.col("way") == 3, 2).otherwise(1)).alias("times"))
    return rows.select("*", F.explode("times")).drop("times", "col")


def op11_conversations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Contract: the damaged conversations' faults, cheapest audit and repaired hash; every original conversation."""
    out = audit_conversations(damaged(read(spark, sf_dir, "conversations")), present_col="present")
    return out.withColumnRenamed("id", "conv_id")
