"""Centroid clustering: the walk against all distances, the rounds against plain Python."""

import hashlib

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from presslake.llm.centroids import LIMIT, Lists, assigned, cluster, moved, op12_centroids, quantized


def _all(x, c):
    d = ((x[:, None, :] - c[None, :, :]) ** 2).sum(axis=2)
    return d.argmin(axis=1), d.min(axis=1)


@settings(max_examples=120, deadline=None)
@given(st.integers(1, 9), st.integers(1, 6), st.integers(1, 40), st.integers(1, 6), st.integers(0, 10**6))
def test_walk_finds_the_nearest_with_ties(k, dims, n, spread, seed):
    rng = np.random.default_rng(seed)
    c, x = rng.integers(-spread, spread + 1, (k, dims)), rng.integers(-spread, spread + 1, (n, dims))
    got = Lists(c).nearest(x)
    want = _all(x, c)
    assert (got[0] == want[0]).all() and (got[1] == want[1]).all()


def test_walk_stops_before_the_lists_end():
    rng = np.random.default_rng(1)
    c = rng.integers(-10**5, 10**5, (400, 4))
    x = c[rng.integers(0, 400, 2_000)] + rng.integers(-50, 50, (2_000, 4))
    lists = Lists(c)
    got = lists.nearest(x)
    assert (got[0] == _all(x, c)[0]).all()
    assert lists.read < 0.1 * 2_000 * 400 * 4 and lists.scored < 0.1 * 2_000 * 400


def test_extreme_components():
    c = np.array([[-LIMIT] * 64, [LIMIT] * 64, [0] * 64])
    x = np.array([[LIMIT] * 64, [-LIMIT] * 64, [1] * 64])
    assert Lists(c).nearest(x)[0].tolist() == [1, 0, 2]
    far = Lists(c[:1]).nearest(x[:1])
    assert far[1][0] == 64 * (2 * LIMIT) ** 2


def _brute(rows, k=16, rounds=3):
    """The contract in plain Python integers."""
    rows = [(i, [int(np.floor(64 * float(np.float32(e)))) for e in v]) for i, v in rows]
    start = sorted((hashlib.sha256(f"1:{'' if i is None else i}".encode()).hexdigest(), x) for i, x in rows)
    cs = [x for _, x in start[:k]]

    def near(x):
        return min((sum((a - b) ** 2 for a, b in zip(x, c)), n) for n, c in enumerate(cs))
    for _ in range(rounds):
        members = {}
        for _, x in rows:
            members.setdefault(near(x)[1], []).append(x)
        cs = [[sum(col) // len(members[n]) for col in zip(*members[n])] if n in members else c for n, c in enumerate(cs)]
    out = [(i, near(x)) for i, x in rows]
    inertia = {}
    for _, (d, n) in out:
        inertia[n] = inertia.get(n, 0) + d
    return sorted((-1 if i is None else i, n, d, inertia[n], sum(inertia.values()),
                   hashlib.sha256(",".join(map(str, cs[n])).encode()).hexdigest()) for i, (d, n) in out)


def _rows(df):
    return sorted((-1 if r.vec_id is None else r.vec_id, r.cluster, r.distance, r.cluster_inertia, r.inertia, r.centroid_sha256)
                  for r in df.collect())


def test_query_against_brute_force(spark, sf):
    rows = [(r.vec_id, r.embedding) for r in spark.read.parquet(f"{sf}/embeddings.parquet").collect()]
    assert _rows(op12_centroids(spark, sf)) == _brute(rows)


SCHEMA = "vec_id long, embedding array<float>, id string, x string, cluster string, distance string"


def _table(spark, scratch, rows):
    spark.createDataFrame([(*r, "a", "b", "c", "d") for r in rows], SCHEMA).write.parquet(f"{scratch}/embeddings.parquet")
    return scratch


def test_rows_that_take_no_part_repeats_and_null_ids(spark, scratch):
    rng = np.random.default_rng(5)
    good = [(i, rng.normal(size=64).astype(np.float32).tolist()) for i in range(40)]
    good += [good[0], good[0], (None, good[1][1]), (None, good[2][1])]
    bad = [(90, None), (91, []), (92, [0.5] * 63), (93, [0.5] * 63 + [None]), (94, [0.5] * 63 + [float("nan")]),
           (95, [0.5] * 63 + [float("-inf")]), (None, None)]
    assert _rows(op12_centroids(spark, _table(spark, scratch, good + bad))) == _brute(good)


def test_fewer_vectors_than_centroids_and_none(spark, scratch):
    few = [(7, [0.25] * 64), (8, [-3.0] * 64)]
    assert _rows(op12_centroids(spark, _table(spark, f"{scratch}/few", few))) == _brute(few)
    assert _rows(op12_centroids(spark, _table(spark, f"{scratch}/none", [(1, None)]))) == []


def test_an_empty_cluster_keeps_its_centroid(spark):
    df = spark.createDataFrame([(i, [0.0] * 4) for i in range(3)], "vec_id long, embedding array<double>")
    rows = quantized(df, "vec_id", "embedding", 4)
    start = np.array([[0] * 4, [9] * 4])
    assert moved(rows, start).tolist() == start.tolist()
    assert {r.cluster for r in assigned(rows, start).collect()} == {0}


def test_means_are_floored_and_one_vector_may_hold_all_rows(spark):
    df = spark.range(100_000).select(F.col("id").alias("vec_id"), F.array(F.lit(-0.01), F.when(F.col("id") == 5, 1.0).otherwise(0.0)).alias("embedding"))
    out, cs = cluster(df, k=1, rounds=1, dims=2)
    assert cs.tolist() == [[-1, 0]] and out.count() == 100_000
    with pytest.raises(ValueError):
        cluster(df, k=1 << 22, dims=2)
