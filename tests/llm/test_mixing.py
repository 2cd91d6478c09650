import re

import numpy as np
import pytest

import presslake.llm.mixing as mixing
from presslake.llm.common import written
from presslake.llm.mixing import mix, mixed, pivot, targets
from presslake.llm.queries import QUERIES

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def brute_targets(sizes, weights=(1, 2, 3), most=3):
    names = sorted([s for s in sizes if s is not None], key=lambda s: s.encode("utf-8")) + [None] * (None in sizes)
    weight = {s: weights[k % len(weights)] for k, s in enumerate(names)}
    capped, total = {}, sum(sizes.values())
    while True:
        left = [s for s in names if s not in capped]
        rest = total - sum(capped.values())
        share = {s: rest * weight[s] / sum(weight[x] for x in left) for s in left}
        over = [s for s in left if share[s] > most * sizes[s]]
        if not over:
            return {**capped, **share}
        capped.update({s: most * sizes[s] for s in over})


@pytest.mark.parametrize("sizes", [
    {"a": 100, "b": 10, "c": 1, None: 50}, {"é": 10, "z": 1000, "Z": 3, "aa": 1}, {"x": 7}, {None: 3, "b": 0, "c": 9},
    {"a": 1, "b": 1, "c": 1, "d": 1, "e": 1, "f": 10_000}])
def test_targets(spark, sizes):
    rows = [(s, n) for s, n in sizes.items()]
    got = {x.source: x.target for x in targets(spark.createDataFrame(rows, "source string, size long")).collect()}
    assert got == pytest.approx(brute_targets(sizes))


@pytest.mark.parametrize("last", [False, True])
def test_rounding_keeps_words_and_expectations(last):
    size = np.array([900, 500, 400, 300, 200, 100, 100, 50, 40, 30, 20, 10, 5.0])
    p = np.full(len(size), 0.37)
    p[3], p[5] = 0.0, 1.0
    mean, n = np.zeros(len(size)), 4000
    for t in range(n):
        out = pivot(size, p, np.random.default_rng(t), last)
        fractional = ((out > 0) & (out < 1)).sum()
        assert fractional <= (0 if last else 1)
        if not last:
            assert (out * size).sum() == pytest.approx((p * size).sum())
        mean += out
    assert np.abs(mean / n - p).max() < 0.035


def test_one_document_dominates():
    size, errors = np.array([10_000.0, *([50.0] * 300)]), []
    for t in range(200):
        out = pivot(size, np.full(len(size), 0.49), np.random.default_rng(t), True)
        errors.append(abs((out * size).sum() - 0.49 * size.sum()))
    assert max(errors) <= 50


def test_edge_rows(spark, edge, empty):
    rows = mix(edge).collect()
    assert len(rows) == 11 and mix(empty).count() == 0
    sizes = {}
    for x in edge.collect():
        sizes[x.source] = sizes.get(x.source, 0) + len(WORD.findall(x.text or ""))
    goal = brute_targets(sizes)
    for x in rows:
        assert x.source_size == sizes[x.source] and x.target == pytest.approx(goal[x.source])
        assert 0 <= x.copies <= 3
    again = sorted(map(str, mix(edge).collect()))
    assert again == sorted(map(str, rows))


def test_tree_over_many_buckets(spark, monkeypatch):
    monkeypatch.setattr(mixing, "BUCKET_DOCS", 10)
    monkeypatch.setattr(mixing, "FAN_IN", 4)
    text = ["w " * (1 + i * i % 97) for i in range(1000)]
    docs = spark.createDataFrame([(i, t, "en", "ab"[i % 5 > 0], 0) for i, t in enumerate(text)],
                                 "doc_id long, text string, lang string, source string, n_chars long")
    rows = mix(docs).collect()
    assert len(rows) == 1000
    for s in "ab":
        mine = [x for x in rows if x.source == s]
        taken = sum(x.copies * x.size for x in mine)
        assert abs(taken - mine[0].target) <= 97


def test_long_document_beside_a_larger_source(spark, monkeypatch):
    monkeypatch.setattr(mixing, "BUCKET_DOCS", 60)
    # a0-a3: one document of about half the source's words, in one bucket; b: several buckets
    rows = [(100 * a + i, "w " * (100 if i else 5_000), "en", f"a{a}", 0) for a in range(4) for i in range(50)]
    rows += [(1_000 + i, "w " * (10 + i % 50), "en", "b", 0) for i in range(300)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    got = mix(docs, weights=(1, 1, 1, 1, 30_150 / 4_950)).collect()
    assert len(got) == 500
    for a in range(4):
        mine = [x for x in got if x.source == f"a{a}"]
        assert mine[0].target == pytest.approx(4_950)
        # the 49 others make up for 2,450 of the 2,500 words that the long one gains or loses
        assert abs(sum(x.copies * x.size for x in mine) - 4_950) <= 150


@pytest.mark.parametrize("n", [2_000, 2_001, 6_000])
def test_long_document_in_a_source_of_several_buckets(spark, n):
    # one document as long as 30 % of all others
    rows = [(i, 40) for i in range(n - 1)] + [(n, 12 * (n - 1))]
    docs = spark.createDataFrame([(i, "w " * k, "en", "a", 0) for i, k in rows] + [(-1, "w " * 40 * n, "en", "b", 0)],
                                 "doc_id long, text string, lang string, source string, n_chars long")
    got = mix(docs, weights=(1, 2)).where("source = 'a'").collect()
    assert len(got) == n
    target = got[0].target
    assert abs(sum(x.copies * x.size for x in got) - target) <= 0.001 * target


def test_long_documents_keep_their_expectations(spark, monkeypatch):
    monkeypatch.setattr(mixing, "BUCKET_DOCS", 20)
    # 400 sources alike in all but their draws: two long documents and 40 short ones of one third each
    rows = [(1_000 * s + i, "w " * (90 if i < 2 else 3), "en", f"{s:03}", 0) for s in range(400) for i in range(42)]
    docs = spark.createDataFrame(rows + [(-1, "w " * 400 * 300, "en", "z", 0)],
                                 "doc_id long, text string, lang string, source string, n_chars long")
    got = mix(docs, weights=(1,) * 400 + (800,)).where("source <> 'z'").collect()
    rate = got[0].target / got[0].source_size
    long, short = [x.copies for x in got if x.size == 90], [x.copies for x in got if x.size == 3]
    assert np.mean(long) == pytest.approx(rate, abs=0.07)
    assert np.mean(short) == pytest.approx(rate, abs=0.05)
    for s in {x.source for x in got}:
        assert abs(sum(x.copies * x.size for x in got if x.source == s) - got[0].target) <= 90


def test_mixed_rows_are_the_copies(spark, edge, empty):
    out = mixed(edge)
    assert out.dtypes == edge.dtypes and mixed(empty).count() == 0
    want = {}
    for x in mix(edge).collect():
        want[x.id, x.source, x.size] = want.get((x.id, x.source, x.size), 0) + x.copies
    got = {}
    for x in out.collect():
        key = x.doc_id, x.source, len(WORD.findall(x.text or ""))
        got[key] = got.get(key, 0) + 1
    assert got == {k: n for k, n in want.items() if n}


def test_query(spark, sf):
    rows = QUERIES["op9_mixing"](spark, sf).collect()
    docs = {d.doc_id: d for d in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    assert sorted(x.doc_id for x in rows) == sorted(docs)
    sizes = {}
    for d in docs.values():
        sizes[d.source] = sizes.get(d.source, 0) + len(WORD.findall(d.text or ""))
    goal = brute_targets(sizes)
    for x in rows:
        d = docs[x.doc_id]
        assert (x.size, x.source_size) == (len(WORD.findall(d.text)), sizes[d.source])
        assert x.target == pytest.approx(goal[d.source]) and x.taken <= 3 * x.size
    for s, words in goal.items():  # some twenty documents a source: the last drawn is one of them
        longest = max(x.size for x in rows if x.source == s)
        assert abs(sum(x.taken for x in rows if x.source == s) - words) <= longest
    again = sorted((x.doc_id, x.taken) for x in QUERIES["op9_mixing"](spark, sf).collect())
    assert again == sorted((x.doc_id, x.taken) for x in rows)


def test_taken_words_come_near_the_targets(spark):
    rows = QUERIES["op9_mixing"](spark, "/root/testdata/sf0.1").collect()
    goal = {x.source: x.target for x in rows}
    for s, words in goal.items():
        assert sum(x.taken for x in rows if x.source == s) == pytest.approx(words, rel=0.002)


def _broadcast(plan):
    """The nodes below broadcasts of a plan's text, which draws a tree by its indentation."""
    depth, out = None, []
    for line in plan.split("\n"):
        at = len(line) - len(line.lstrip(" :+-"))
        depth = None if depth is not None and at <= depth else depth
        if depth is not None:
            out.append(line)
        elif "BroadcastExchange" in line:
            depth = at
    return out


def test_neither_repeated_rows_nor_copies_are_broadcast(spark, scratch, monkeypatch):
    # 3,000 equal rows of one source are one row of sizes until they are dealt apart
    rows = [(1, "a", "w x")] * 3000 + [(i, f"s{i}", "w") for i in range(2, 9)]
    spark.createDataFrame(rows, "doc_id long, source string, text string").coalesce(1).write.parquet(f"{scratch}/docs")
    docs, plans = spark.read.parquet(f"{scratch}/docs"), []

    def seen(df, name):
        plans.append(df._jdf.queryExecution().executedPlan().toString())
        return written(df.coalesce(1) if name == "sizes" else df, name)
    monkeypatch.setattr(mixing, "written", seen)
    out = mixed(docs)
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" in plan and "Broadcast" not in plan
    below = [x for p in plans for x in _broadcast(p)]
    assert below and not [x for x in below if "Generate" in x]
    copies = mix(docs).groupBy("source").agg({"copies": "sum", "*": "count"})
    found = {x.source: (x["count(1)"], x["sum(copies)"]) for x in copies.collect()}
    assert found["a"][0] == 3000 and [found[f"s{i}"][0] for i in range(2, 9)] == [1] * 7
    kept = {x.source: x["count"] for x in out.groupBy("source").count().collect()}
    assert kept == {s: n for s, (_, n) in found.items() if n}
