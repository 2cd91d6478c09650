"""Exact top-k inner products by no-random-access aggregation of sorted lists."""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from presslake.llm.common import numbered, read, written

#: Rows of a candidate block (one set of sorted lists) and of a query block.
BLOCK_ROWS = 4096
QUERY_ROWS = 512
#: Shares of each list that have been read when bounds are taken; at 1 the scores are whole.
DEPTHS = (0.75, 0.875, 0.9375, 1.0)
#: Candidates, as a multiple of k, that may be left when reading stops and final scores are resolved.
BUFFER = 16
SCALE = 64


class Lists:
    """A block's components as one sorted list for each dimension.

    Down to a depth, a list read from its top has shown the values above
    ``high`` (read from its bottom, those below ``low``); of an unseen
    candidate it is known that its value lies between that frontier and the list's end.
    """

    def __init__(self, vectors: np.ndarray):
        self.vectors = vectors
        self.sorted = np.sort(vectors, axis=0)

    def bounds(self, depth: float) -> tuple[np.ndarray, ...]:
        """For each candidate and dimension what is known after reading ``depth`` of
        the list: (most, least) read from the top, (least, most) read from the bottom."""
        n = len(self.vectors)
        read = max(1, math.ceil(depth * n))
        first, last = self.sorted[0], self.sorted[-1]
        high, low = self.sorted[n - read], self.sorted[read - 1]
        x = self.vectors
        return (np.maximum(x, high), np.where(x >= high, x, first), np.minimum(x, low), np.where(x <= low, x, last))


def search_block(lists: Lists, ids: np.ndarray, queries: np.ndarray, query_ids: np.ndarray, k: int,
                 floor: np.ndarray) -> list[tuple[np.ndarray, np.ndarray]]:
    """The block's candidates that may be among each query's best k, with whole scores.

    ``floor`` holds, for each query, the k-th best score met so far (or minus
    infinity). All lists are read in step, a query's list of a dimension from the end its sign
    favours; its upper bound takes the frontier for what is unseen, its lower bound the list's
    other end. Reading stops for a query when few candidates' upper bounds reach
    the k-th lower bound: no outsider can qualify, and the rest are resolved.
    """
    n, out = len(ids), [None] * len(queries)
    up, down = np.maximum(queries, 0), np.minimum(queries, 0)
    active = np.arange(len(queries))
    for depth in DEPTHS:
        if not len(active):
            break
        q, qd = up[active], down[active]
        top_most, top_least, bottom_least, bottom_most = lists.bounds(depth)
        own = query_ids[active, None] == ids[None, :]
        upper = q @ top_most.T + qd @ bottom_least.T
        upper[own] = -np.inf
        if depth < 1:
            lower = q @ top_least.T + qd @ bottom_most.T
            lower[own] = -np.inf
        else:
            lower = upper
        kth = np.partition(lower, n - k, axis=1)[:, n - k] if n > k else np.full(len(active), -np.inf)
        bar = np.maximum(kth, floor[active])
        can = (upper >= bar[:, None]) & (upper > -np.inf)
        stop = (can.sum(axis=1) <= BUFFER * k) | (depth >= 1)
        for i in np.flatnonzero(stop).tolist():
            left = np.flatnonzero(can[i])
            out[active[i]] = (left, lists.vectors[left] @ queries[active[i]])
        active = active[~stop]
    return out


def _matrix(batch: pa.RecordBatch, i: int, prefix: str) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(row numbers, ids, vectors) of a block."""
    row = [batch.column(f"{prefix}_{c}")[i].as_buffer() for c in ("rows", "ids", "vectors")]
    rows, ids = np.frombuffer(row[0], "<i8"), np.frombuffer(row[1], "<i8")
    return rows, ids, np.frombuffer(row[2], "<f8").reshape(len(ids), -1)


def _blocks(vectors: DataFrame, rows: int, prefix: str, dims: int) -> DataFrame:
    """Blocks of at most ``rows`` vectors, padded with zeros to ``dims`` components."""
    def run(key: tuple, table: pa.Table) -> pa.Table:
        table = table.sort_by("n").combine_chunks()
        lists = table.column("x").combine_chunks()
        sizes = pc.list_value_length(lists).to_numpy().astype(np.int64)
        flat = np.zeros((table.num_rows, dims))
        flat[np.arange(dims)[None, :] < sizes[:, None]] = pc.list_flatten(lists).to_numpy()
        cols = [pa.array([key[0].as_py()], pa.int64())]
        cols += [pa.array([table.column(c).to_numpy().astype("<i8").tobytes()], pa.binary()) for c in ("n", "id")]
        return pa.Table.from_arrays([*cols, pa.array([flat.tobytes()], pa.binary())],
                                    [f"{prefix}_block", f"{prefix}_rows", f"{prefix}_ids", f"{prefix}_vectors"])
    schema = f"{prefix}_block long, {prefix}_rows binary, {prefix}_ids binary, {prefix}_vectors binary"
    return vectors.withColumn("block", F.floor(F.col("n") / rows)).groupBy("block").applyInArrow(run, schema)


def usable(vectors: DataFrame, id_col: str, vector_col: str) -> DataFrame:
    """``(id, x)``: whole-number components ``floor(64 x)``; rows with a NULL id or vector, or a
    NULL or non-finite component, are left out, and equal rows count once."""
    x = F.transform(F.col(vector_col), lambda v: v.cast("double"))
    rows = vectors.select(F.col(id_col).cast("long").alias("id"), x.alias("x"))
    finite = F.forall("x", lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < float("inf")))
    rows = rows.where(F.col("id").isNotNull() & F.col("x").isNotNull()).where(finite)
    return rows.select("id", F.transform("x", lambda v: F.floor(v * SCALE).cast("double")).alias("x")).distinct()


def top_k(vectors: DataFrame, is_query: Column, k: int = 20, id_col: str = "vec_id",
          vector_col: str = "embedding") -> DataFrame:
    """``(query_row, query_id, rank, id, score)``: for each row with ``is_query`` (over
    ``id``) the k highest integer inner products with rows of other ids.

    Ties go to the smaller id. Rows with a NULL id or vector, or a NULL or
    non-finite component, take no part; equal rows count once, and different
    vectors under one id are each a query and a candidate, never for their own id;
    shorter vectors count as padded with zeros; no rows give none. Scores are
    whole below 2^53. Candidates and queries are cut to blocks of fixed size, so
    the work is spread as it grows; each block of candidates has its own sorted
    lists, a task carries each query's k-th best score from block to block, and a
    query's few survivors of each task are ranked together.
    """
    rows = numbered(usable(vectors, id_col, vector_col), [F.col("id"), F.xxhash64("x"), F.col("x")], "vectors")
    dims, total = rows.agg(F.max(F.size("x")), F.count("*")).first()
    if not total or not dims:
        dims = 1
    candidates = written(_blocks(rows, BLOCK_ROWS, "c", dims), "candidate-blocks")
    asked = rows.where(is_query).select("id", "x", "n")
    asked = numbered(asked.withColumnRenamed("n", "row"), [F.col("row")], "queries")
    queries = written(_blocks(asked, QUERY_ROWS, "q", dims), "query-blocks")

    def run(batches: Iterator[pa.RecordBatch]):
        best: dict[int, dict] = {}  # by query block: its kept (ids, scores) and floors
        for batch in batches:
            for i in range(len(batch)):
                block = batch.column("q_block")[i].as_py()
                q_rows, q_ids, q = _matrix(batch, i, "q")
                _, ids, x = _matrix(batch, i, "c")
                if block not in best:
                    yield from flush(best)
                    best = {block: {"rows": q_rows, "ids": q_ids, "floor": np.full(len(q_ids), -np.inf),
                                    "kept": [(np.zeros(0, np.int64), np.zeros(0))] * len(q_ids)}}
                state = best[block]
                found = search_block(Lists(x), ids, q, q_ids, k, state["floor"])
                for j, (left, scores) in enumerate(found):
                    all_ids = np.concatenate([state["kept"][j][0], ids[left]])
                    all_scores = np.concatenate([state["kept"][j][1], scores])
                    order = np.lexsort((all_ids, -all_scores))[:k]
                    state["kept"][j] = all_ids[order], all_scores[order]
                    if len(order) == k:
                        state["floor"][j] = all_scores[order[-1]]
        yield from flush(best)

    def flush(best: dict):
        for state in best.values():
            sizes = [len(a) for a, _ in state["kept"]]
            yield pa.RecordBatch.from_arrays([
                pa.array(np.repeat(state["rows"], sizes)), pa.array(np.repeat(state["ids"], sizes)),
                pa.array(np.concatenate([a for a, _ in state["kept"]])),
                pa.array(np.concatenate([s for _, s in state["kept"]]).astype(np.int64))],
                ["query_row", "query_id", "id", "score"])

    # every query block meets every candidate block once: the stated query set against all rows
    n_candidates = max(1, -(-total // BLOCK_ROWS))
    grid = queries.withColumn("c_block", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(n_candidates - 1).cast("long"))))
    # the exploded side's files look small to the planner; blocks are dealt out, not broadcast
    met = grid.hint("merge").join(candidates, "c_block").sortWithinPartitions("q_block", "c_block")
    found = met.mapInArrow(run, "query_row long, query_id long, id long, score long")
    order = Window.partitionBy("query_row").orderBy(F.col("score").desc(), "id")
    return (found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
            .select("query_row", "query_id", F.col("rank").cast("int").alias("rank"), "id", "score"))


def op2_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Contract: rows of ``embeddings`` whose id is divisible by 20 against all others, 20 best."""
    found = top_k(read(spark, sf_dir, "embeddings"), F.col("id") % 20 == 0)
    return found.select("query_id", "rank", F.col("id").alias("vec_id"), "score")


OP2_SQL = """
WITH v AS (
  SELECT DISTINCT vec_id, list_transform(embedding, lambda x: floor(64 * x::DOUBLE)) AS x FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x::DOUBLE))) = 0
), s AS (
  SELECT q.vec_id AS query_id, c.vec_id AS vec_id, list_dot_product(q.x, c.x)::BIGINT AS score
  FROM v q JOIN v c ON q.vec_id <> c.vec_id WHERE q.vec_id % 20 = 0
), r AS (
  SELECT query_id, vec_id, score,
         row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id)::INTEGER AS rank FROM s
)
SELECT query_id, rank, vec_id, score FROM r WHERE rank <= 20
"""
