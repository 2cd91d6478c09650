"""Hashed word and character features, samples of labelled rows, and scoring by words."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from presslake.llm.common import give_back, slices

#: Odd multipliers of the polynomial hash and of its final mix.
_STEP, _MIX = np.uint64(0x100000001B3), np.uint64(0x9E3779B97F4A7C15)


#: Bytes of text that become bucket entries, and that are scored, at once (an entry takes
#: some tens of bytes on its way, and a word has tens of them).
SAMPLE_BYTES = 1 << 18
SCORE_BYTES = 1 << 20


@dataclass
class Words:
    """The words of a batch of texts: ``code`` points into ``vocabulary``, ``text`` says whose each is."""
    code: np.ndarray
    text: np.ndarray
    n_texts: int
    vocabulary: pa.Array


def words(texts: pa.Array, lower: bool = False, trim: str = "") -> Words:
    """Words between ASCII white space; with ``trim``, without those characters at either end."""
    texts = pc.fill_null(texts.cast(pa.string()), "")
    split = pc.ascii_split_whitespace(pc.utf8_lower(texts) if lower else texts)
    sizes = pc.list_value_length(split).to_numpy().astype(np.int64)
    coded = split.flatten().dictionary_encode()
    vocabulary = coded.dictionary
    if trim:
        again = pc.utf8_trim(vocabulary, trim).dictionary_encode()
        vocabulary, code = again.dictionary, np.asarray(again.indices)[np.asarray(coded.indices)]
    else:
        code = np.asarray(coded.indices)
    text = np.repeat(np.arange(len(texts)), sizes)
    empty = pc.index(vocabulary, pa.scalar("", vocabulary.type)).as_py()
    if empty >= 0:
        keep = code != empty
        code, text = code[keep], text[keep]
    return Words(code, text, len(texts), vocabulary)


def buckets(vocabulary: pa.Array, sizes: tuple[int, ...], n_buckets: int) -> tuple[np.ndarray, np.ndarray]:
    """(where each word's buckets begin and the last end, buckets): one of the word,
    and one of each of its character n-grams, the word's borders marked."""
    n = len(vocabulary)
    chars = pc.utf8_length(vocabulary).to_numpy().astype(np.int64) if n else np.zeros(0, np.int64)
    length = chars + 2
    ends = np.cumsum(length)
    starts = ends - length
    flat = np.empty(int(ends[-1]) if n else 0, dtype=np.uint64)
    inner = np.ones(len(flat), dtype=bool)
    inner[starts], inner[ends - 1] = False, False
    flat[starts], flat[ends - 1] = ord("<"), ord(">")
    flat[inner] = np.frombuffer("".join(vocabulary.to_pylist()).encode("utf-32-le"), "<u4")
    owner = np.repeat(np.arange(n), length)
    with np.errstate(over="ignore"):
        power = np.cumprod(np.full(int(length.max(initial=1)), _STEP))
        whole = np.add.reduceat((flat + np.uint64(1)) * power[np.arange(len(flat)) - starts[owner]], starts) if n else flat
        rows, found = [np.arange(n)], [_bucket(whole, 0, n_buckets)]
        place = np.arange(len(flat)) - starts[owner]
        for size in sizes:
            h = np.zeros(max(0, len(flat) - size + 1), dtype=np.uint64)
            for k in range(size):
                h = h * _STEP + flat[k:k + len(h)] + np.uint64(1)
            fits = place[:len(h)] + size <= length[owner[:len(h)]]
            rows.append(owner[:len(h)][fits])
            found.append(_bucket(h[fits], size, n_buckets))
    row, all_found = np.concatenate(rows), np.concatenate(found)
    order = np.argsort(row, kind="stable")
    return np.concatenate(([0], np.cumsum(np.bincount(row, minlength=n)))).astype(np.int64), all_found[order]


def _bucket(h: np.ndarray, salt: int, n: int) -> np.ndarray:
    mixed = (h ^ (h >> np.uint64(29)) ^ np.uint64(salt)) * _MIX
    return ((mixed >> np.uint64(33)) % np.uint64(n)).astype(np.int64)


def word_sums(vocabulary: pa.Array, sizes: tuple[int, ...], weights: np.ndarray, mean: bool = False) -> np.ndarray:
    """For each word the sum (or the mean) of its buckets' weights."""
    if not len(vocabulary):
        return np.zeros(0)
    ends, found = buckets(vocabulary, sizes, len(weights))
    total = np.add.reduceat(weights[found].astype(np.float64), ends[:-1])
    return total / np.diff(ends) if mean else total


def spread(row: np.ndarray, code: np.ndarray, weight: np.ndarray, vocabulary: pa.Array, sizes: tuple[int, ...],
           n_buckets: int, mean: bool = False) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Words (of row ``row``) as bucket entries (row, bucket, weight), equal ones summed, sorted."""
    # a word that a text repeats is spread once
    key, at = np.unique(row * max(1, len(vocabulary)) + code, return_inverse=True)
    row, code, weight = key // max(1, len(vocabulary)), key % max(1, len(vocabulary)), np.bincount(at, weight, len(key))
    ends, found = buckets(vocabulary, sizes, n_buckets)
    many = np.diff(ends)[code]
    at = np.repeat(ends[:-1][code] - (np.cumsum(many) - many), many) + np.arange(many.sum())
    key = np.repeat(row, many) * n_buckets + found[at]
    w = np.repeat(weight / (many if mean else 1), many)
    order = np.argsort(key, kind="stable")
    key, w = key[order], w[order]
    first = np.flatnonzero(np.concatenate(([True], key[1:] != key[:-1]))) if len(key) else np.zeros(0, np.int64)
    total = np.add.reduceat(w, first) if len(key) else w
    return key[first] // n_buckets, key[first] % n_buckets, total


def fold_of(id_col: Column, folds: int) -> Column:
    """crc32 of the id as text, modulo ``folds``; NULL for a NULL id."""
    return F.crc32(id_col.cast("string").cast("binary")) % folds


def labelled_ids(labels: DataFrame, label: str, allowed: Column, id_col: str = "doc_id") -> DataFrame:
    """``(id, y)``, one row for each labelled id on which its labels agree."""
    rows = labels.where(F.col(id_col).isNotNull() & F.col(label).isin(0, 1) & allowed)
    by = rows.groupBy(F.col(id_col).cast("long").alias("id")).agg(F.min(label).alias("y"), F.max(label).alias("_y"))
    return by.where("y = _y").select("id", F.col("y").cast("int").alias("y"))


def bounded(ids: DataFrame, most: int, seed: int) -> DataFrame:
    """At most ``most`` rows of ``(id, ...)``: those whose ids hash lowest."""
    return ids.orderBy(F.xxhash64("id", F.lit(seed)), "id").limit(most)


def sampled_texts(docs: DataFrame, ids: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """``(id, text, ...)`` for a bounded ``ids``: one text (the least) of each."""
    rows = docs.select(F.col(id_col).cast("long").alias("id"),
                       F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"))
    held = rows.join(F.broadcast(ids.select("id").distinct()), "id", "left_semi")  # ids are few by their bound
    return held.groupBy("id").agg(F.min("text").alias("text")).join(F.broadcast(ids), "id")


Entries = tuple[np.ndarray, np.ndarray, np.ndarray]


def trained(samples: DataFrame, featurise: Callable[[pa.Array], Entries], fit: Callable[..., bytes]) -> bytes:
    """The model that ``fit(y, entries)`` makes of a bounded sample ``(id, y, text)``.

    Texts become bucket entries where they are read; one task gets these, sorted
    by id so that reruns agree, and returns the model.
    """
    def features(batches: Iterator[pa.RecordBatch]):
        for batch in batches:
            for part in slices(batch, limit=SAMPLE_BYTES):
                row, bucket, weight = featurise(part.column(2))
                ends = np.concatenate(([0], np.cumsum(np.bincount(row, minlength=len(part))))).astype(np.int32)
                lists = [pa.ListArray.from_arrays(pa.array(ends), pa.array(x)) for x in
                         (bucket.astype(np.int32), weight.astype(np.float32))]
                yield pa.RecordBatch.from_arrays([part.column(0), part.column(1), *lists], ["id", "y", "ids", "weights"])

    def fitted(batches: Iterator[pa.RecordBatch]):
        # ids, labels, sizes, buckets, weights of the sample, in the order they come
        parts = [(b.column(0).to_numpy(), b.column(1).to_numpy(), pc.list_value_length(b.column(2)).to_numpy(),
                  b.column(2).flatten().to_numpy(), b.column(3).flatten().to_numpy()) for b in batches if len(b)]
        if not parts:
            yield pa.RecordBatch.from_arrays([pa.array([fit(np.zeros(0, np.int64), None)], pa.binary())], ["model"])
            return
        name, y, size, bucket, weight = (np.concatenate(x) for x in zip(*parts))
        parts.clear()
        # documents are numbered by id and label, and their entries put in that order
        order = np.lexsort((y, name))
        starts = np.cumsum(size) - size
        ends = np.cumsum(size[order])
        at = np.repeat((starts[order] - ends + size[order]).astype(np.int32), size[order]) + np.arange(ends[-1], dtype=np.int32)
        row = np.repeat(np.arange(len(y), dtype=np.int32), size[order])
        bucket, weight = bucket[at], weight[at]
        del at
        model = fit(y[order], (row, bucket, weight))
        del row, bucket, weight
        give_back()
        yield pa.RecordBatch.from_arrays([pa.array([model], pa.binary())], ["model"])
    rows = samples.select("id", F.col("y").cast("int").alias("y"), "text")
    rows = rows.mapInArrow(features, "id long, y int, ids array<int>, weights array<float>")
    return bytes(rows.repartition(1).mapInArrow(fitted, "model binary").first()[0])


def scored(docs: DataFrame, score: Callable[[], Callable[[pa.Array], np.ndarray]], id_col: str, text_col: str) -> DataFrame:
    """``(id, score)`` of every row; ``score()`` makes a task's scoring function of a batch of texts."""
    def run(batches: Iterator[pa.RecordBatch]):
        fn = score()
        for batch in batches:
            for part in slices(batch, limit=SCORE_BYTES):
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array(fn(part.column(1)), pa.float64())], ["id", "score"])
            give_back()
    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text"))
    return rows.mapInArrow(run, "id long, score double")
