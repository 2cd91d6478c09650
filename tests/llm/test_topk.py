import math

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

import presslake.llm.topk as topk
from presslake.llm.queries import ORACLE_SQL, QUERIES


def brute(rows, k):
    rows = sorted({(i, tuple(math.floor(64 * x) for x in v)) for i, v in rows
                   if i is not None and v is not None and all(x is not None and math.isfinite(x) for x in v)})
    out = []
    for qi, q in rows:
        if qi % 20:
            continue
        scores = sorted((-sum(a * b for a, b in zip(q, c)), ci) for ci, c in rows if ci != qi)
        out += [(qi, r + 1, ci, -s) for r, (s, ci) in enumerate(scores[:k])]
    return sorted(out)


def run(spark, rows, k, dtype="float"):
    df = spark.createDataFrame(rows, f"vec_id long, embedding array<{dtype}>, id string, n string, x string")
    got = topk.top_k(df, F.col("id") % 20 == 0, k)
    return sorted((x.query_id, x["rank"], x.id, x.score) for x in got.collect())


def test_nulls_ties_repeats_and_short_vectors(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(0, [1.0, 2.0]), (1, [1.0, 2.0]), (2, [1.0, 2.0]), (2, [1.0, 2.0]), (3, None), (4, [nan, 1.0]),
            (5, [inf, 0.0]), (6, [None, 1.0]), (None, [1.0, 1.0]), (20, [-1.0, 0.5]), (20, [0.25, 0.25]), (7, [0.5]),
            (8, []), (40, [0.0, 0.0])]
    got = run(spark, [(i, v, "a", "b", "c") for i, v in rows], 3, "double")
    assert got == brute(rows, 3)


def test_empty_and_lone(spark):
    assert run(spark, [], 3) == []
    assert run(spark, [(20, [1.0], "", "", "")], 3) == []


@pytest.mark.parametrize("depths", [(1.0,), (0.3, 0.6, 0.9, 1.0), topk.DEPTHS])
def test_blocks_agree_with_brute_force(spark, monkeypatch, depths):
    monkeypatch.setattr(topk, "DEPTHS", depths)
    monkeypatch.setattr(topk, "BLOCK_ROWS", 50)
    monkeypatch.setattr(topk, "QUERY_ROWS", 7)
    r = np.random.default_rng(3)
    vectors = np.round(r.normal(size=(400, 8)), 1)
    vectors[200:300] = vectors[0]  # many ties
    rows = [(i, v) for i, v in enumerate(vectors.tolist())]
    assert run(spark, [(*x, "", "", "") for x in rows], 20, "double") == brute(rows, 20)


def test_bounds_hold_at_every_depth():
    r = np.random.default_rng(4)
    x = r.integers(-9, 10, size=(60, 5)).astype(float)
    lists = topk.Lists(x)
    for depth in (0.01, 0.2, 0.5, 0.9, 1.0):
        top_most, top_least, bottom_least, bottom_most = lists.bounds(depth)
        assert (top_least <= x).all() and (x <= top_most).all() and (bottom_least <= x).all() and (x <= bottom_most).all()
        if depth == 1.0:
            assert (top_least == x).all() and (top_most == x).all()


def test_reading_stops_early_on_clear_winners():
    x = np.zeros((1000, 4))
    x[:5] = 100
    x[5:] = np.arange(995)[:, None] / 100
    seen = []
    real = topk.Lists.bounds
    lists = topk.Lists(x)
    lists.bounds = lambda depth: (seen.append(depth), real(lists, depth))[1]
    out = topk.search_block(lists, np.arange(1000), np.ones((1, 4)), np.array([-1]), 5, np.full(1, -np.inf))
    assert seen == [topk.DEPTHS[0]] and set(out[0][0][np.argsort(-out[0][1])[:5]]) == set(range(5))


def test_query_against_sql(spark, sf):
    got = sorted((x.query_id, x["rank"], x.vec_id, x.score) for x in QUERIES["op2_top_k"](spark, sf).collect())
    con = duckdb.connect()
    con.execute(f"CREATE VIEW embeddings AS SELECT * FROM '{sf}/embeddings.parquet'")
    assert got == sorted(con.execute(ORACLE_SQL["op2_top_k"]).fetchall())
