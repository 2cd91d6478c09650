"""Mixing sources to target weights by pivotal dependent rounding."""

from __future__ import annotations

import hashlib

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from presslake.llm.common import numbered, read, word_count, written

WEIGHTS = (1, 2, 3)
MAX_COPIES = 3
SEED = 20
#: Documents of a source that one task rounds, on average, and residuals that one node of the tree combines.
BUCKET_DOCS = 2_000
FAN_IN = 64
#: A document with more than a LONG_PARTS-th of a bucket's mean words is dealt to no bucket of the others.
LONG_PARTS = 64
_EPS = 1e-9


def targets(sizes: DataFrame, weights: tuple[float, ...] = WEIGHTS, most: float = MAX_COPIES) -> DataFrame:
    """``(source, source_size, docs, target)`` from ``sizes(source, size)``.

    Sources by code point, NULL last, weigh as ``weights`` repeat and share all
    words; a target stops at ``most`` times its source's size and the excess is
    shared again by weight. The share of one weight only rises from round to
    round, so it alone is the state; a round is one sum over the sources.
    """
    by = sizes.groupBy("source").agg(F.sum("size").alias("source_size"), F.count("*").alias("docs"))
    by = numbered(by, [F.col("source").asc_nulls_last()], "sources")
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), (F.col("n") % len(weights) + 1).cast("int"))
    by = by.withColumn("weight", weight).withColumn("cap", most * F.col("source_size"))
    share = -1.0
    while True:
        capped = F.col("cap") < F.lit(share) * F.col("weight")
        total, stopped, open_ = by.agg(F.sum("source_size"), F.sum(F.when(capped, F.col("cap")).otherwise(0.0)),
                                       F.sum(F.when(capped, 0.0).otherwise(F.col("weight")))).first()
        new = (total - stopped) / open_ if open_ else share
        if new <= share:
            break
        share = new
    if share < 0:
        share = 0.0
    return by.select("source", "source_size", "docs", F.least(F.lit(share) * F.col("weight"), F.col("cap")).alias("target"))


def _pairs(size: np.ndarray, p: np.ndarray, first: int, draw: np.random.Generator) -> None:
    """Round ``p`` from ``first`` on, in place, two documents at a time: words move
    between the running fractional document and the next until one is integral."""
    a = -1
    for b in range(first, len(p)):
        if p[b] in (0.0, 1.0):
            continue
        if a < 0:
            a = b
            continue
        to_a = min(size[a] * (1 - p[a]), size[b] * p[b])
        to_b = min(size[a] * p[a], size[b] * (1 - p[b]))
        words = to_a if draw.random() * (to_a + to_b) < to_b else -to_b
        p[a] = _snap(p[a] + words / size[a])
        p[b] = _snap(p[b] - words / size[b])
        if p[a] in (0.0, 1.0):
            a = b if p[b] not in (0.0, 1.0) else -1


def _snap(p: float) -> float:
    return 0.0 if p <= _EPS else 1.0 if p >= 1 - _EPS else p


def pivot(size: np.ndarray, p: np.ndarray, draw: np.random.Generator, last: bool = False) -> np.ndarray:
    """Probabilities after pivotal rounding of documents sorted by size, largest first.

    The next fractional document becomes 1 or 0 by its own odds, and the words
    it gains or loses go from or to the documents after it, each of which gives
    and takes in the proportion that keeps its own expectation. A smaller partner
    is emptied or filled, and further ones follow until all words are placed; so
    the sum of ``size * p`` stays, a long document does not stay over, and what
    stays fractional at the end is small. Where the rest cannot place all words,
    plain pairs are rounded instead, which leave one fractional document; the
    ``last`` rounding of a source draws it and lets the rest place what it can.
    """
    p = np.array([_snap(x) for x in p])
    n = len(p)
    after = list(range(n + 1))  # the next fractional place, found by halving paths
    for i in np.flatnonzero((p == 0) | (p == 1)).tolist():
        after[i] = i + 1

    def live(i: int) -> int:
        while after[i] != i:
            after[i] = after[after[i]]
            i = after[i]
        return i

    a = live(0)
    while a < n:
        odds, words, partners, b = p[a], size[a], [], live(a + 1)
        while words > _EPS and b < n:
            part = min(words, size[b] * min(p[b] / (1 - odds), (1 - p[b]) / odds))
            partners.append((b, part))
            words -= part
            b = live(b + 1)
        if words > _EPS * size[a] and not last:
            _pairs(size, p, a, draw)
            return p
        up = draw.random() < odds
        p[a] = float(up)
        after[a] = a + 1
        for b, part in partners:
            p[b] = _snap(p[b] + (-part * (1 - odds) if up else part * odds) / size[b])
            if p[b] in (0.0, 1.0):
                after[b] = b + 1
        a = live(a)
    return p


def _rounded(items: DataFrame, level: str, last: bool) -> DataFrame:
    """Round each (source, bucket); ``p`` of its one residual stays fractional unless this is
    the ``last`` pass and the source is down to one bucket, whatever other sources have."""
    def run(key: tuple, pdf: pd.DataFrame) -> pd.DataFrame:
        # largest first: the residual ends up among the small documents
        pdf = pdf.sort_values(["size", "id", "rep"], ascending=[False, True, True], na_position="last", kind="stable")
        name = "\0".join(map(str, (SEED, level, key[0], key[1])))
        draw = np.random.default_rng(int.from_bytes(hashlib.sha256(name.encode()).digest()[:8], "big"))
        ends = last and bool(pdf["buckets"].iloc[0] <= 1)
        return pdf.assign(p=pivot(pdf["size"].to_numpy(np.float64), pdf["p"].to_numpy(np.float64), draw, ends))
    return items.groupBy("source", "bucket").applyInPandas(run, items.schema)


def _tree(items: DataFrame, most_buckets: int, name: str = "", last: bool = True) -> DataFrame:
    """``items`` with ``p`` rounded up the tree of buckets; not ``last``, one document of a source may stay fractional."""
    fractional = F.col("p").between(_EPS, 1 - _EPS)
    level, out = 0, None
    while True:
        rounded = written(_rounded(items, f"{name}{level}", last), "rounded")
        done = rounded if most_buckets <= 1 else rounded.where(~fractional)
        out = done if out is None else out.unionByName(done)
        if most_buckets <= 1:
            return out
        items = rounded.where(fractional).withColumns({"bucket": F.floor(F.col("bucket") / FAN_IN),
                                                       "buckets": F.ceil(F.col("buckets") / FAN_IN)})
        most_buckets, level = -(-most_buckets // FAN_IN), level + 1


def _long_first(items: DataFrame, most_buckets: int) -> tuple[DataFrame, DataFrame]:
    """(long documents decided, the others with ``p`` shifted for them).

    Long documents of a source are rounded among themselves up a tree of their own. The
    one that stays fractional is drawn by its odds, and the words it gains or loses go
    from or to all other documents of the source alike, as far as these can give and
    take in the proportion that keeps their own expectation: one number a source.
    """
    is_long = (F.col("p") > 0) & (F.col("buckets") > 1) & (
        F.col("size") * F.col("buckets") * LONG_PARTS > F.col("source_size"))
    long, rest = items.where(is_long), items.where(~is_long)
    decided = _tree(long, most_buckets, "long", last=False)
    odds = F.pmod(F.xxhash64("id", "rep", "source", F.lit(SEED + 1)), F.lit(1 << 52)) / F.lit(float(1 << 52))
    up = odds < F.col("p")
    fractional = F.col("p").between(_EPS, 1 - _EPS)
    drawn = decided.withColumn("p", F.when(fractional, up.cast("double")).otherwise(F.col("p")))
    # the other documents of a source share one fraction, the source's
    held = long.groupBy("source").agg(F.sum("size").alias("_held"))
    mass = F.col("source_size") - F.col("_held")
    f, o = F.col("rate") - F.col("whole"), F.col("p")
    part = F.least(F.col("size").cast("double"), mass * F.least(f / (1 - o), (1 - f) / o))
    moved = F.when(up, -part * (1 - o)).otherwise(part * o)
    single = decided.where(fractional).withColumnRenamed("source", "_source")
    single = single.join(held, F.col("_source").eqNullSafe(F.col("source"))).where(mass > 0)
    shift = written(single.select("_source", (moved / mass).alias("_shift")), "shifts")
    rest = rest.join(shift, rest["source"].eqNullSafe(shift["_source"]), "left")
    moved_p = F.least(F.lit(1.0), F.greatest(F.lit(0.0), F.col("p") + F.coalesce("_shift", F.lit(0.0))))
    return drawn, rest.withColumn("p", F.when(F.col("p") > 0, moved_p).otherwise(0.0)).drop("_source", "_shift")


def mix(docs: DataFrame, weights: tuple[float, ...] = WEIGHTS, most: int = MAX_COPIES, id_col: str = "doc_id",
        source_col: str = "source", text_col: str = "text") -> DataFrame:
    """``(id, rep, source, size, source_size, target, copies)`` for every row of ``docs``.

    ``size`` is the number of words. Every document of a source expects
    ``target / source_size`` copies; whole copies are given at once and the
    fraction is rounded so that the source's words stay those of its target, but
    for one document. Documents of a source are dealt to buckets by a hash of id
    and repetition; each bucket leaves one fractional document, and these meet
    in a tree until the source is down to one bucket, whose rounding draws it; the size of
    other sources changes nothing for it. Documents that a bucket could not make up
    for are decided before, among themselves, and the whole source makes up for the
    last of them. Draws depend on the rows alone, so reruns
    agree. Rows of equal id, source and size are told apart by ``rep``; NULL
    sources are one source, NULL ids ids like others, NULL and empty texts have
    size 0 and take part with their whole copies only; no rows give none; other
    columns are not read.
    """
    sizes = docs.select(F.col(id_col).cast("long").alias("id"), F.col(source_col).cast("string").alias("source"),
                        word_count(F.col(text_col)).alias("size"))
    # equal rows are counted before the shuffle and dealt apart after it
    counted = written(sizes.groupBy("id", "source", "size").count(), "sizes")
    reps = F.explode(F.sequence(F.lit(1).cast("long"), "count"))
    goals = written(targets(counted.select("source", "size", reps.alias("rep")), weights, most), "targets")
    buckets = F.ceil(F.col("docs") / BUCKET_DOCS)
    rate = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(0.0)
    goal = goals.select(F.col("source").alias("_source"), "source_size", "target", rate.alias("rate"), buckets.alias("buckets"))
    # joined before equal rows are dealt apart: Spark sizes what ``explode`` makes as one row of each, and might broadcast it
    items = counted.join(goal, counted["source"].eqNullSafe(goal["_source"])).withColumn("rep", reps)
    items = items.withColumn("whole", F.floor("rate"))
    items = items.withColumn("p", F.when(F.col("size") > 0, F.col("rate") - F.col("whole")).otherwise(0.0))
    items = items.withColumn("bucket", F.pmod(F.xxhash64("id", "rep", F.lit(SEED)), F.col("buckets")))
    items = items.select("id", "rep", "source", "size", "source_size", "target", "rate", "whole", "p", "bucket", "buckets")
    most_buckets = goals.agg(F.max(buckets)).first()[0] or 1
    if most_buckets > 1:  # a single bucket decides its own long documents first
        long, items = _long_first(items, most_buckets)
        out = long.unionByName(_tree(items, most_buckets))
    else:
        out = _tree(items, most_buckets)
    copies = F.col("whole") + F.round("p").cast("long")
    return out.select("id", "rep", "source", "size", "source_size", "target", copies.alias("copies"))


def _keys(id_col: Column, source: Column) -> dict[str, Column]:
    return {"_id": F.coalesce(id_col, F.lit(0)), "_no_id": id_col.isNull(),
            "_source": F.coalesce(source, F.lit("")), "_no_source": source.isNull()}


def mixed(docs: DataFrame, weights: tuple[float, ...] = WEIGHTS, most: int = MAX_COPIES) -> DataFrame:
    """``docs`` with each row as many times as the mix takes it. Of rows with equal id, source and size
    those that sort first by text hash get the copy more."""
    from pyspark.sql import Window
    plan = mix(docs, weights, most)
    keys = [*_keys(F.lit(0), F.lit("")), "_size"]
    plan = plan.withColumns(_keys(F.col("id"), F.col("source"))).withColumnRenamed("size", "_size")
    per = written(plan.groupBy(*keys).agg(F.min("copies").alias("_least"), F.sum("copies").alias("_all"),
                                          F.count("*").alias("_rows")), "copies")
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("_row"))
    rows = rows.withColumns(_keys(F.col("_row.doc_id").cast("long"), F.col("_row.source").cast("string")))
    rows = rows.withColumn("_size", word_count(F.col("_row.text")))
    place = F.row_number().over(Window.partitionBy(*keys).orderBy(F.xxhash64("_row")))
    copies = F.col("_least") + (F.col("_place") <= F.col("_all") - F.col("_least") * F.col("_rows")).cast("long")
    # a sort-merge join: a row of ``per`` takes many times its size in the file, by which Spark would broadcast it
    return (rows.withColumn("_place", place).join(per.hint("merge"), keys)
            .withColumn("_copy", F.explode(F.array_repeat(F.lit(0), copies.cast("int")))).select("_row.*"))


def op9_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Contract: all of ``documents`` mixed; words taken from each."""
    out = mix(read(spark, sf_dir, "documents"))
    return out.select(F.col("id").alias("doc_id"), "size", "source_size", "target",
                      (F.col("copies") * F.col("size")).alias("taken"), "source", "copies")
