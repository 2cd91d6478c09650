"""Centroid clustering; the nearest centroid is found by the threshold algorithm.

Each dimension has the centroids sorted by their component. From a vector's own value
the list is walked outward, the nearer neighbour first; a centroid met for the first time
is scored in whole. What no list has shown yet is at least as far in every dimension as that
list's last entry, so the walk ends when the squared last distances add up to strictly more than the
best whole distance: an equal sum could still hide a tie, which goes to the smaller number.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from presslake.llm.common import read, written

#: Components beyond +-2^27 are taken as that: 64 squared differences of them still fit a long.
LIMIT = 1 << 27
#: Components of all centroids, which every task holds and the driver gathers (8 bytes each, and their sorted lists).
MAX_COMPONENTS = 1 << 22
#: Vectors walked side by side (fewer beside many centroids).
BATCH = 4_096
SEEN = 1 << 24


class Lists:
    """Centroids sorted by every dimension, for walks outward."""

    def __init__(self, centroids: np.ndarray):
        self.centroids = np.asarray(centroids, dtype=np.int64)
        self.k, self.dims = self.centroids.shape
        self.order = np.argsort(self.centroids, axis=0, kind="stable")
        self.values = np.take_along_axis(self.centroids, self.order, axis=0)
        self.read = 0  # list entries read so far
        self.scored = 0  # whole distances so far

    def nearest(self, vectors: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(number of the nearest centroid, squared distance) of every vector; ties to the smaller number."""
        cluster = np.empty(len(vectors), dtype=np.int32)
        distance = np.empty(len(vectors), dtype=np.int64)
        size = max(1, min(BATCH, SEEN // self.k))
        for at in range(0, len(vectors), size):
            part = slice(at, at + size)
            cluster[part], distance[part] = self._walk(vectors[part])
        return cluster, distance

    def _walk(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        n, dims = x.shape
        best = np.full(n, np.iinfo(np.int64).max)
        chosen = np.full(n, self.k, dtype=np.int64)
        seen = np.zeros((n, self.k), dtype=bool)
        # the entries below and at or above a vector's own value
        right = np.stack([np.searchsorted(self.values[:, d], x[:, d]) for d in range(dims)], axis=1)
        left = right - 1
        live, axis = np.arange(n), np.arange(dims)
        while len(live):
            v, lo, hi = x[live], left[live], right[live]
            below = np.where(lo >= 0, v - self.values[np.maximum(lo, 0), axis], LIMIT << 2)
            above = np.where(hi < self.k, self.values[np.minimum(hi, self.k - 1), axis] - v, LIMIT << 2)
            down = below <= above
            frontier = np.minimum(below, above)
            entry = self.order[np.where(down, lo, hi), axis]
            left[live], right[live] = lo - down, hi + ~down
            self.read += entry.size
            # each centroid a vector meets for the first time is scored in whole, once
            met = np.zeros((len(live), self.k), dtype=bool)
            met[np.arange(len(live))[:, None], entry] = True
            met &= ~seen[live]
            seen[live] |= met
            row, number = np.nonzero(met)
            self.scored += len(row)
            self._score(v, row, number, live, best, chosen)
            done = (frontier * frontier).sum(axis=1) > best[live]
            live = live[~done & ~seen[live].all(axis=1)]
        return chosen, best

    def _score(self, v, row, number, live, best, chosen) -> None:
        for at in range(0, len(row), BATCH * 4):
            r, c = row[at:at + BATCH * 4], number[at:at + BATCH * 4]
            gap = v[r] - self.centroids[c]
            d = np.einsum("ij,ij->i", gap, gap)
            # the least distance of each vector, then the least number with it
            order = np.lexsort((c, d, r))
            first = order[np.concatenate(([True], r[order][1:] != r[order][:-1]))]
            who, d, c = live[r[first]], d[first], c[first]
            better = (d < best[who]) | ((d == best[who]) & (c < chosen[who]))
            best[who[better]], chosen[who[better]] = d[better], c[better]


def quantized(vectors: DataFrame, id_col: str, vector_col: str, dims: int, scale: int = 64) -> DataFrame:
    """``(id, x)``: vectors of exactly ``dims`` components, none NULL, NaN or infinite, each as floor(scale * component)."""
    v = F.col(vector_col).cast("array<double>")
    usable = (F.size(v) == dims) & F.forall(v, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < float("inf")))
    x = F.transform(v, lambda c: F.greatest(F.least(F.floor(c * F.lit(float(scale))), F.lit(LIMIT)), F.lit(-LIMIT)).cast("long"))
    return vectors.where(F.coalesce(usable, F.lit(False))).select(F.col(id_col).alias("id"), x.alias("x"))


def first_centroids(rows: DataFrame, k: int, seed: int = 1) -> np.ndarray:
    """The ``k`` vectors with the smallest sha256 of ``seed:id`` (a NULL id is written as nothing), equal ones by their
    components; all of them if fewer."""
    key = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("id").cast("string"), F.lit(""))), 256)
    picked = rows.select(key.alias("key"), "x").orderBy("key", "x").limit(k).collect()
    return np.array([r.x for r in picked], dtype=np.int64)


def _matrix(batch: pa.RecordBatch, dims: int) -> np.ndarray:
    x = batch.column(batch.schema.get_field_index("x"))
    return np.asarray(x.flatten(), dtype=np.int64).reshape(len(batch), dims)


def assigned(rows: DataFrame, centroids: np.ndarray) -> DataFrame:
    """``(id, cluster, distance)`` of every row ``(id, x)``."""
    def run(batches: Iterator[pa.RecordBatch]):
        lists = Lists(centroids)
        for b in batches:
            cluster, distance = lists.nearest(_matrix(b, lists.dims))
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(cluster, pa.int32()), pa.array(distance, pa.int64())],
                                             ["id", "cluster", "distance"])
    return rows.mapInArrow(run, f"id {rows.schema['id'].dataType.simpleString()}, cluster int, distance long")


def moved(rows: DataFrame, centroids: np.ndarray) -> np.ndarray:
    """Centroids after one round: the exact floor of each one's mean; one without vectors stays.

    Each task adds up its own rows, so at most ``k`` rows a task are shuffled and ``k`` reach the driver.
    """
    k, dims = centroids.shape

    def run(batches: Iterator[pa.RecordBatch]):
        lists = Lists(centroids)
        sums, counts, rows_in = np.zeros((k, dims), dtype=object), np.zeros(k, dtype=np.int64), 0
        part = np.zeros((k, dims), dtype=np.int64)
        for b in batches:
            for at in range(0, len(b), BATCH):
                x = _matrix(b.slice(at, BATCH), dims)
                cluster, _ = lists.nearest(x)
                np.add.at(part, cluster, x)
                counts += np.bincount(cluster, minlength=k)
                rows_in += len(x)
                if rows_in > 1 << 30:  # before a long of 2^27 components could overflow
                    sums, part, rows_in = sums + part, np.zeros_like(part), 0
        sums = sums + part
        some = np.flatnonzero(counts)
        yield pa.RecordBatch.from_arrays([
            pa.array(some, pa.int32()), pa.array(counts[some], pa.int64()),
            pa.array([[str(v) for v in sums[c]] for c in some], pa.list_(pa.string()))], ["cluster", "n", "sums"])
    parts = rows.select("x").mapInArrow(run, "cluster int, n long, sums array<string>")
    total = parts.select("cluster", "n", F.posexplode("sums").alias("d", "s")).groupBy("cluster", "d").agg(
        F.sum("n").alias("n"), F.sum(F.col("s").cast("decimal(38,0)")).alias("s")).collect()
    out = centroids.copy()
    for r in total:
        out[r.cluster, r.d] = int(r.s) // r.n
    return out


def cluster(vectors: DataFrame, k: int = 16, rounds: int = 3, dims: int = 64, id_col: str = "vec_id",
            vector_col: str = "embedding", seed: int = 1) -> tuple[DataFrame, np.ndarray]:
    """``(id, cluster, distance)`` of every usable vector, and the centroids.

    Vectors that are NULL, of another length, or hold NULL, NaN or infinite components take no part; components
    beyond 2^21 before scaling are taken as that. Ties go to the smaller number; repeated rows and NULL ids stay rows of their
    own; fewer vectors than ``k`` give as many centroids; no rows give none. Other columns are not read. ``k * dims`` is at
    most ``MAX_COMPONENTS``: the centroids are the only thing that the driver gathers and tasks are sent.
    """
    if k * dims > MAX_COMPONENTS:
        raise ValueError(f"{k} centroids of {dims} components pass the bound of {MAX_COMPONENTS}")
    rows = quantized(vectors, id_col, vector_col, dims)
    centroids = first_centroids(rows, k, seed)
    if not len(centroids):
        return rows.select("id", F.lit(0).alias("cluster"), F.lit(0).cast("long").alias("distance")).limit(0), centroids
    for _ in range(rounds):
        centroids = moved(rows, centroids)
    return assigned(rows, centroids), centroids


def op12_centroids(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Contract: 16 centroids, three rounds, one more assignment; each cluster's and the whole inertia, centroid digests."""
    out, centroids = cluster(read(spark, sf_dir, "embeddings"))
    # written once, narrow: read for the sums and for the result
    out = written(out.select(F.col("id").cast("long").alias("vec_id"), F.col("cluster").cast("int"), "distance"), "clusters")
    digests = [(c, hashlib.sha256(",".join(map(str, x.tolist())).encode()).hexdigest()) for c, x in enumerate(centroids)]
    sums = out.groupBy("cluster").agg(F.sum("distance").alias("cluster_inertia"))
    # one row a centroid: their number is the bound of both small tables
    sums = sums.crossJoin(F.broadcast(sums.agg(F.sum("cluster_inertia").alias("inertia"))))
    sums = sums.join(F.broadcast(spark.createDataFrame(digests, "cluster int, centroid_sha256 string")), "cluster")
    return out.join(F.broadcast(sums), "cluster").select(
        "vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256")


_NEAREST = """a{r} AS (
  SELECT row_id, vec_id, x, best.num AS num, best.dist AS dist FROM (
    SELECT v.row_id, v.vec_id, v.x, min({{'dist': list_sum(list_transform(list_zip(v.x, c.x), lambda z: (z[1] - z[2]) * (z[1] - z[2])))::BIGINT,
                                      'num': c.num}}) AS best
    FROM v CROSS JOIN c{r} c GROUP BY v.row_id, v.vec_id, v.x))"""
_MOVE = """c{n} AS (
  SELECT c.num, coalesce(m.x, c.x) AS x FROM c{r} c LEFT JOIN (
    SELECT num, list(floor_div ORDER BY d) AS x FROM (
      SELECT num, d, CASE WHEN s < 0 AND s % n <> 0 THEN s // n - 1 ELSE s // n END AS floor_div FROM (
        SELECT num, d, sum(e)::HUGEINT AS s, count(*)::HUGEINT AS n FROM (
          SELECT num, unnest(x) AS e, generate_subscripts(x, 1) AS d FROM a{r}) GROUP BY num, d)) GROUP BY num) m USING (num))"""
OP12_SQL = """
WITH v AS (
  SELECT row_number() OVER () AS row_id, vec_id, list_transform(embedding, lambda e: floor(64 * e::DOUBLE)::BIGINT) AS x FROM embeddings
  WHERE len(embedding) = 64 AND len(list_filter(embedding, lambda e: e IS NOT NULL AND isfinite(e))) = 64),
c0 AS (
  SELECT row_number() OVER (ORDER BY key, x) - 1 AS num, x FROM (
    SELECT sha256('1:' || coalesce(vec_id::VARCHAR, '')) AS key, x FROM v ORDER BY key, x LIMIT 16)),
""" + ",\n".join(_NEAREST.format(r=r) + ",\n" + _MOVE.format(r=r, n=r + 1) for r in range(3)) + ",\n" + _NEAREST.format(r=3) + """
SELECT a.vec_id, a.num::INTEGER AS cluster, a.dist AS distance,
       (sum(a.dist) OVER (PARTITION BY a.num))::BIGINT AS cluster_inertia, (sum(a.dist) OVER ())::BIGINT AS inertia,
       sha256(array_to_string(c.x, ',')) AS centroid_sha256
FROM a3 a JOIN c3 c USING (num)
"""
