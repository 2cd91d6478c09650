"""SimHash near-duplicates by multi-index hashing."""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce
from itertools import combinations, repeat

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from presslake.llm.common import byte_words, map_rows, read, slices, written
from presslake.llm.components import components

BITS = 64
SEED = 42


def _lanes() -> np.ndarray:
    """For each byte, its bits as eight one-byte counters in a word."""
    bits = (np.arange(256)[:, None] >> np.arange(8)) & 1
    return (bits.astype(np.uint64) << (8 * np.arange(8, dtype=np.uint64))).sum(axis=1, dtype=np.uint64)


_LANES = _lanes()


def _bit_counts(hashes: np.ndarray) -> np.ndarray:
    """How many of the hashes have each bit (255 additions fit a one-byte counter)."""
    lanes = _LANES[hashes.view(np.uint8).reshape(-1, 8)]
    part = np.add.reduceat(lanes, np.arange(0, len(hashes), 255), axis=0)
    return part.view(np.uint8).reshape(len(part), BITS).sum(axis=0, dtype=np.int64)


def _shingles(text: bytes, size: int) -> Iterator[list[bytes]]:
    """All ``size``-word shingles in lists of bounded length; the whole sequence if
    the text is shorter, nothing if it has no word."""
    tail: list[bytes] = []
    any_made = False
    for words in byte_words(text):
        words = tail + words
        made = list(map(b" ".join, zip(*(words[k:] for k in range(size)))))
        if made:
            any_made = True
            yield made
        tail = words[max(0, len(words) - size + 1):] if size > 1 else []
        if not any_made:
            tail = words
    if not any_made and tail:
        yield [b" ".join(tail)]


def fingerprint(text: str | None, size: int) -> int:
    """64 bits: 1 where over half of the shingles' XXH64 values have 1; 0 without words."""
    counts, n = np.zeros(BITS, dtype=np.int64), 0
    for made in _shingles((text or "").encode().lower(), size):
        h = np.fromiter(map(xxhash.xxh64_intdigest, made, repeat(SEED)), dtype="<u8", count=len(made))
        counts += _bit_counts(h)
        n += len(h)
    return int(np.packbits(2 * counts > n, bitorder="little").view("<i8")[0]) if n else 0


def fingerprints(docs: DataFrame, size: int = 3, id_col: str = "doc_id", text_col: str = "text",
                 mark: Column | None = None) -> DataFrame:
    """``(id, fp, mark)`` of every row: ``fp`` is the fingerprint as a signed long,
    ``mark`` a long of the caller's. A NULL text is an empty one."""
    def run(batch: pa.RecordBatch):
        for part in slices(batch):
            fps = [fingerprint(t, size) for t in part.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([part.column(0), pa.array(fps, pa.int64()), part.column(2)],
                                             ["id", "fp", "mark"])
    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text"),
                       (F.lit(0) if mark is None else mark).cast("long").alias("mark"))
    return map_rows(rows, run, "id long, fp long, mark long")


def _segments(max_bits: int, segments: int) -> list[tuple[int, int, int]]:
    """(shift, width, radius) of each segment that must be searched.

    Were every one of the first ``max_bits % segments + 1`` segments to differ by
    more than ``max_bits // segments`` bits and every other by at least that many,
    the sum would pass ``max_bits``; so two fingerprints within the distance agree
    up to the radius in one of these segments.
    """
    radius, wider = divmod(max_bits, segments)
    widths = [BITS // segments + (k < BITS % segments) for k in range(segments)]
    shifts = [sum(widths[:k]) for k in range(segments)]
    out = [(s, w, radius if k <= wider else radius - 1) for k, (s, w) in enumerate(zip(shifts, widths))]
    return [x for x in out if x[2] >= 0]


def _ball(width: int, radius: int) -> list[int]:
    return [sum(1 << b for b in bits) for n in range(radius + 1) for bits in combinations(range(width), n)]


def links(fps: DataFrame, max_bits: int = 3, segments: int = 2) -> DataFrame:
    """Pairs ``(a, b)`` of different fingerprints (``fps.fp``, one row each) that differ in at most
    ``max_bits`` bits.

    Every fingerprint stands in one table row for each segment. It probes the
    tables with every value of a segment's Hamming ball, but of two values that
    differ only the one with 0 at the lowest differing bit probes, so each pair is
    met once in a segment. Matches are kept by their whole distance. Segments of
    32 bits keep a table's rows a value few until some 10^10 fingerprints, and a
    value shared by many different ones is a skewed join key, which Spark splits.
    """
    if segments < 2:
        raise ValueError("segments of at most 32 bits are needed")
    tables, probes = [], []
    for k, (shift, width, radius) in enumerate(_segments(max_bits, segments)):
        value = F.shiftrightunsigned("fp", shift).bitwiseAND(F.lit((1 << width) - 1))
        mask = F.explode(F.array(*[F.lit(m).cast("long") for m in _ball(width, radius)]))
        tables.append(fps.select(F.col("fp").alias("other"), value.bitwiseOR(F.lit(k << 32)).alias("key")))
        probes.append(fps.select("fp", value.alias("value"), mask.alias("mask"))
                      .where("value & mask & -mask = 0")
                      .select("fp", F.expr("mask = 0").alias("equal"),
                              F.col("value").bitwiseXOR(F.col("mask")).bitwiseOR(F.lit(k << 32)).alias("key")))
    # a sort-merge join: Spark sizes the probes as if ``explode`` made one row of each, and would broadcast them
    met = reduce(DataFrame.union, probes).hint("merge").join(reduce(DataFrame.union, tables), "key")
    near = met.where(F.bit_count(F.col("fp").bitwiseXOR(F.col("other"))) <= max_bits).where("NOT equal OR fp < other")
    return near.select(F.least("fp", "other").alias("a"), F.greatest("fp", "other").alias("b")).distinct()


def _components(docs: DataFrame, size: int, max_bits: int, segments: int, id_col: str, text_col: str,
                mark: Column) -> DataFrame:
    """``(id, fp, mark, root, component)``; ``root`` names the component where no id does."""
    rows = written(fingerprints(docs, size, id_col, text_col, mark), "fingerprints")
    groups = written(rows.groupBy("fp").agg(F.min("id").alias("first")), "distinct-fingerprints")
    roots = components(links(groups.select("fp"), max_bits, segments))
    # sort-merge joins from here on: Spark sizes a table by its compressed files, which may be a small part of what it would broadcast
    groups = written(groups.join(roots.hint("merge"), groups["fp"] == roots["node"], "left")
                     .select("fp", "first", F.coalesce("root", "fp").alias("root")), "groups")
    least = groups.groupBy("root").agg(F.min("first").alias("component"))
    named = written(groups.join(least.hint("merge"), "root").select("fp", "root", "component"), "components")
    return rows.join(named.hint("merge"), "fp")


def simhash_components(docs: DataFrame, size: int = 3, max_bits: int = 3, segments: int = 2,
                       id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(id, fp, component)`` for every row of ``docs``.

    ``component`` is the smallest id among the rows reachable over links of at
    most ``max_bits`` differing bits (equal fingerprints included). Rows with a
    NULL id take part and get their component's smallest other id (NULL if there
    is none); repeated rows each give a row; no rows give none; other columns are
    not read. Exact copies meet as one fingerprint before any link is sought.
    """
    return _components(docs, size, max_bits, segments, id_col, text_col, F.lit(0)).select("id", "fp", "component")


def keep_one(docs: DataFrame, size: int = 3, max_bits: int = 3, segments: int = 2,
             id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` with one row of each component: the one with the smallest id (a row
    without id only if its component has no id), of several the one with the
    smallest row hash, of wholly equal rows one."""
    mark = F.xxhash64(*[F.col(f"`{c}`") for c in docs.columns])
    found = _components(docs, size, max_bits, segments, id_col, text_col, mark)
    best = found.groupBy("root").agg(F.min(F.struct(F.col("id").isNull().alias("none"), "id", "mark")).alias("best"))
    best = best.select(F.col("best.mark").alias("_mark"), F.coalesce("best.id", F.lit(0)).alias("_key"))
    # equal rows collapse before the shuffle, so that a row repeated very often is no hot key
    keyed = docs.select(mark.alias("_mark"), F.coalesce(F.col(id_col).cast("long"), F.lit(0)).alias("_key"),
                        F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("_row"))
    return (keyed.groupBy("_mark", "_key").agg(F.first("_row").alias("_row"))
            .join(best, ["_mark", "_key"], "left_semi").select("_row.*"))


def op1_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Contract: 3-word shingles, 3 bits, over all of ``documents``."""
    found = simhash_components(read(spark, sf_dir, "documents"))
    return found.select(F.col("id").alias("doc_id"), F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"),
                        F.col("component").alias("component_id"))
