"""Conversation repair: the audit DP against all edit sequences and a plain DP; the query against plain Python."""

import hashlib
import itertools
import random
import re
import zlib

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from presslake.llm import conversations as c
from presslake.llm.conversations import Prefixes, Repair, audit_conversations, op11_conversations, repaired_rows

PATTERN = re.compile(r"(s?(ua)+)?")
ROLES = {"s": "system", "u": "user", "a": "assistant", "x": "tool"}


def _apply(rows, audit):
    """(cost, repaired lines) of an audit, or None if it is not allowed: by the contract's words alone."""
    out, cost, left = [], 0, list(rows)
    for e in audit:
        if e == "I":
            out.append(("?", ""))
            cost += 2
            continue
        if not left:
            return None
        role, text, must, truncated = left.pop(0)
        if e == "D":
            cost += 3
            continue
        if must:
            return None
        cost += (2 if e == "R" else 0) + truncated
        out.append((role if e == "K" else "?", text))
    if left:
        return None
    for roles in itertools.product(*[[r] if r != "?" else ["user", "assistant"] for r, _ in out]):
        if PATTERN.fullmatch("".join(r[0] for r in roles)):
            return cost, [f"{r}:{t}" for r, (_, t) in zip(roles, out)]
    return None


def _all(rows):
    """The cheapest, then least audit among all of up to two inserts at each place."""
    best = None
    for edits in itertools.product("DKR", repeat=len(rows)):
        for gaps in itertools.product(range(3), repeat=len(rows) + 1):
            audit = "I" * gaps[0] + "".join(e + "I" * g for e, g in zip(edits, gaps[1:]))
            got = _apply(rows, audit)
            if got and (best is None or (got[0], audit) < best[:2]):
                best = got[0], audit, got[1]
    return best


def _plain(rows):
    """Cheapest, then least audit by a plain DP that keeps whole strings."""
    after = {(0, "u"): 2, (0, "s"): 1, (1, "u"): 2, (2, "a"): 3, (3, "u"): 2}
    make = {0: 2, 1: 2, 2: 3, 3: 2}

    def inserts(cells):
        for _ in range(4):
            for s, (cost, audit) in list(cells.items()):
                new = (cost + 2, audit + "I")
                if make[s] not in cells or new < cells[make[s]]:
                    cells[make[s]] = new
        return cells
    cells = inserts({0: (0, "")})
    for role, _, must, truncated in rows:
        new = {}
        for s, (cost, audit) in cells.items():
            ways = [(s, 3, "D")]
            if not must:
                ways.append((make[s], 2 + truncated, "R"))
                if (s, role[:1]) in after:
                    ways.append((after[s, role[:1]], truncated, "K"))
            for to, more, letter in ways:
                x = (cost + more, audit + letter)
                new[to] = min(new.get(to, x), x)
        cells = inserts(new)
    return min(cells[s] for s in (0, 3) if s in cells)


def _repair(rows):
    r = Repair()
    for row in rows:
        r.row(*row)
    return r.close()


ROW = st.tuples(st.sampled_from("suaax").map(ROLES.get), st.sampled_from(["t.", "q"]), st.booleans(), st.booleans())


@settings(max_examples=60, deadline=None)
@given(st.lists(ROW, max_size=3))
def test_against_all_edit_sequences(rows):
    cost, audit, lines = _all(rows)
    assert _repair(rows) == (cost, audit, hashlib.sha256("\n".join(lines).encode()).hexdigest())


@settings(max_examples=400, deadline=None)
@given(st.lists(ROW, max_size=25))
def test_against_a_plain_dp(rows):
    assert _repair(rows)[:2] == _plain(rows)


@pytest.mark.parametrize("roles, n", [("sua", 3_000), ("x", 3_000), ("ux", 2_000), ("a", 1_500), ("suaax", 2_000)])
def test_long_conversations_with_ties_and_settled_prefixes(monkeypatch, roles, n):
    monkeypatch.setattr(c, "NODES", 64)
    rng = random.Random(n)
    rows = [(ROLES[rng.choice(roles)], "t.", rng.random() < 0.1, rng.random() < 0.2) for _ in range(n)]
    got = _repair(rows)
    assert got[:2] == _plain(rows)
    assert got[2] == hashlib.sha256("\n".join(_lines(rows, got[1])).encode()).hexdigest()


def _lines(rows, audit):
    out, state, left = [], 0, iter(rows)
    for e in audit:
        row = None if e == "I" else next(left)
        if e == "D":
            continue
        if e == "K":
            role, state = row[0], {"s": 1, "u": 2, "a": 3}[row[0][0]]
        else:
            role, state = ("assistant", 3) if state == 2 else ("user", 2)
        out.append(f"{role}:{row[1] if row else ''}")
    return out


def test_prefixes_stay_few_in_a_long_conversation():
    r = Repair()
    for k in range(40_000):
        r.row("user" if k % 2 else "assistant", "t.", k % 11 == 0, False)
    assert len(r.tree.label) < 3 * c.NODES and len(r.close()[1]) >= 40_000


@settings(max_examples=300, deadline=None)
@given(st.lists(st.text(alphabet="DIK", max_size=12), min_size=2, max_size=6), st.sampled_from([3, 7, (1 << 61) - 1]))
def test_order_of_nodes_is_that_of_strings_even_when_hashes_collide(words, modulus):
    tree, nodes = Prefixes(modulus=modulus), {"": 0}
    for w in words:
        for k in range(len(w)):
            if w[:k + 1] not in nodes:
                nodes[w[:k + 1]] = tree.add(nodes[w[:k]], w[k])
    for a in words:
        for b in words:
            assert tree.less(nodes[a], nodes[b]) == (a < b)


def test_collisions_are_found():
    tree = Prefixes(modulus=1)  # every hash is 0
    a, b = tree.extend(0, "KDKD"), tree.extend(0, "KDDD")
    assert not tree.less(a, b) and tree.less(b, a) and tree.collisions == 2


def _brute(table):
    """The contract in plain Python: (conv_id, turn, role, text) rows."""
    convs = {}
    for conv, turn, role, text in table:
        rows = convs.setdefault(conv, [])
        way = zlib.crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20
        role, text = " " if role is None else role, " " if text is None else text
        if way == 0:
            continue
        text = "" if way == 1 else re.sub("[.!?]", "", text) if way == 2 else text
        rows += [(turn, "user" if way == 4 else role, text)] * (2 if way == 3 else 1)
    out = []
    for conv, rows in convs.items():
        rows.sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1], r[2]))
        seen, faults, edits = set(), [0, 0, 0], []
        for _, role, text in rows:
            rest = re.sub(r"[\x20\x09-\x0D]+$", "", text)
            fault = 0 if not rest else 1 if (role, text) in seen else 2 if rest[-1] not in ".!?" else None
            seen.add((role, text))
            if fault is not None:
                faults[fault] += 1
            edits.append((role, text, fault in (0, 1), fault == 2))
        turns = {t for t, *_ in rows if t is not None}
        gaps = max(turns) - min(turns) + 1 - len(turns) if turns else 0
        illegal = sum(a[1][:1] + b[1][:1] not in ("su", "ua", "au") for a, b in zip(rows, rows[1:]))
        cost, audit = _plain(edits)
        sha = hashlib.sha256("\n".join(_lines(edits, audit)).encode()).hexdigest()
        out.append((-1 if conv is None else conv, gaps, *faults, illegal, cost, audit, sha))
    return sorted(out)


def _rows(df):
    return sorted((-1 if r[0] is None else r[0], *r[1:]) for r in df.collect())


def test_query_against_brute_force(spark, sf):
    for folder in (sf, "/root/testdata/sf0.01"):
        table = [tuple(r) for r in spark.read.parquet(f"{folder}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
        assert _rows(op11_conversations(spark, folder)) == _brute(table)


SCHEMA = "conv_id long, turn long, role string, text string, id string, present string, copy string"


def _table(spark, scratch, rows):
    spark.createDataFrame([(*r, "x", "y", "z") for r in rows], SCHEMA).write.parquet(f"{scratch}/conversations.parquet")
    return scratch


def test_edges(spark, scratch):
    rng = random.Random(3)
    rows = [(None, None, None, None), (None, 3, "user", "x."), (None, None, "assistant", None), (1, None, "user", "a."), (1, None, "user", "a.")]
    rows += [(2, t, rng.choice(["user", "assistant", "system", "", "tool", None]), rng.choice(["a.", "b", "", None, " \n", "é😀!"]))
             for t in range(60)]
    rows += [(n, 0, "user", "word " * 50_000 + "end.") for n in range(3, 25)]      # among them dropped ones
    rows += [(40, 5, r, t) for r, t in (("user", "b."), ("user", "a."), ("assistant", "a."))] * 2          # ties and repeats
    got = _rows(op11_conversations(spark, _table(spark, scratch, rows)))
    assert got == _brute(rows)
    empty = [r for r in got if r[7] == ""]
    assert empty and all(r[1:7] == (0,) * 6 and r[8] == hashlib.sha256(b"").hexdigest() for r in empty)


def test_no_rows(spark, scratch):
    assert _rows(op11_conversations(spark, _table(spark, scratch, []))) == []


def test_a_hot_conversation_is_streamed(spark):
    from pyspark.sql import functions as F
    n = 60_000
    rows = spark.range(n).select(F.lit(7).cast("long").alias("conv_id"), F.col("id").alias("turn"),
                                 F.when(F.col("id") % 3 == 0, "user").otherwise("assistant").alias("role"),
                                 F.concat(F.lit("t"), F.col("id") % 50_000, F.lit(".")).alias("text"))
    r = audit_conversations(rows).first()
    edits = [("user" if k % 3 == 0 else "assistant", f"t{k % 50_000}.", k >= 50_000 and k % 3 == (k - 50_000) % 3, False) for k in range(n)]
    seen = set()
    edits = [(a, t, (a, t) in seen or seen.add((a, t)) is not None, False) for a, t, *_ in edits]
    assert r.duplicate == sum(e[2] for e in edits) and r.gaps == 0
    assert len(r.audit.replace("I", "")) == n


def test_repaired_rows_are_the_audited_text(spark):
    rng = random.Random(9)
    rows = [(n, t, rng.choice(["user", "assistant", "system"]), rng.choice(["a.", "b.", "c", ""])) for n in (1, 2, 3, None) for t in range(12)]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    want = {r.id: r.repaired_sha256 for r in audit_conversations(df).collect()}
    lines = {}
    for r in sorted(repaired_rows(df).collect(), key=lambda r: r.n):
        lines.setdefault(r.id, []).append(f"{r.role}:{r.text}")
    assert {i: hashlib.sha256("\n".join(x).encode()).hexdigest() for i, x in lines.items()} == {i: h for i, h in want.items() if i in lines}
    assert all(h == hashlib.sha256(b"").hexdigest() for i, h in want.items() if i not in lines)
    assert repaired_rows(df.limit(0)).count() == 0
