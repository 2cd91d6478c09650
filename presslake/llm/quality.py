"""Quality classifier: supervised embeddings of words and character n-grams."""

from __future__ import annotations

import pickle
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from presslake.llm.common import give_back, read, slices
from presslake.llm.features import (SCORE_BYTES, Entries, bounded, fold_of, labelled_ids, sampled_texts, scored, spread, trained,
                                    word_sums, words)

BUCKETS = 1 << 18
GRAMS = (3, 4)
DIMENSIONS = 8
#: The fit's sample: at most so many labelled documents.
MAX_LABELLED = 3000
EPOCHS = 6
BATCH = 32
#: First rates of the vectors (whose gradients carry a bucket's share of a document) and of the output layer.
RATE = 50.0
RATE_OUT = 0.5
#: A bucket needs so many documents of the sample to get a vector.
MIN_DOCS = 3
#: Stands for a word that repeats the one before it.
REPEAT = "\x02repeat"


def _tokens(texts: pa.Array) -> tuple[np.ndarray, np.ndarray, pa.Array]:
    """(row, code) of all words and of a mark for each repeat, and the vocabulary."""
    found = words(texts)
    again = (found.code[1:] == found.code[:-1]) & (found.text[1:] == found.text[:-1])
    row = np.concatenate([found.text, found.text[1:][again]])
    code = np.concatenate([found.code, np.full(again.sum(), len(found.vocabulary))])
    return row, code.astype(np.int64), pa.concat_arrays([found.vocabulary, pa.array([REPEAT], found.vocabulary.type)])


def featurise(texts: pa.Array) -> Entries:
    """A text's buckets, weighted so that its average is theirs: each word counts alike, and so does each bucket of it."""
    row, code, vocabulary = _tokens(texts)
    n = np.maximum(1, np.bincount(row, minlength=len(texts)))
    return spread(row, code, (1 / n)[row], vocabulary, GRAMS, BUCKETS, mean=True)


def fit_embeddings(y: np.ndarray, entries: Entries, seed: int = 7) -> tuple[np.ndarray, float]:
    """For each bucket, the difference of the two classes' outputs of its vector, and the outputs' bias.

    A document's vector is the average of its buckets' vectors; softmax over two
    outputs; plain stochastic gradient descent with a falling rate. As the outputs are
    linear in the average, the one number a bucket is all that scoring needs.
    """
    row, col, value = entries
    docs = np.bincount(col, minlength=BUCKETS)
    used = np.flatnonzero(docs >= MIN_DOCS)
    place = np.full(BUCKETS, -1, dtype=np.int32)
    place[used] = np.arange(len(used), dtype=np.int32)
    keep = place[col] >= 0
    row, col, value = row[keep], place[col[keep]], value[keep]
    ends = np.concatenate(([0], np.cumsum(np.bincount(row, minlength=len(y)))))
    draw = np.random.default_rng(seed)
    vectors = draw.uniform(-1, 1, (len(used), DIMENSIONS)) / DIMENSIONS
    out, bias = draw.uniform(-1, 1, (DIMENSIONS, 2)) / DIMENSIONS, np.zeros(2)
    steps, step = EPOCHS * -(-len(y) // BATCH), 0
    for _ in range(EPOCHS):
        order = draw.permutation(len(y))
        for lo in range(0, len(y), BATCH):
            rate = RATE * (1 - step / steps)
            step += 1
            pick = order[lo:lo + BATCH]
            many = ends[pick + 1] - ends[pick]
            at = np.repeat(np.arange(len(pick)), many)
            entry = np.repeat(ends[pick] - (np.cumsum(many) - many), many) + np.arange(many.sum())
            c, x = col[entry], value[entry]
            picked = vectors[c] * x[:, None]
            doc = np.stack([np.bincount(at, picked[:, d], len(pick)) for d in range(DIMENSIONS)], axis=1)
            z = doc @ out + bias
            p = np.exp(z - z.max(axis=1, keepdims=True))
            p /= p.sum(axis=1, keepdims=True)
            p[np.arange(len(pick)), y[pick]] -= 1
            back = p @ out.T
            out -= RATE_OUT * (1 - step / steps) * doc.T @ p / len(pick)
            bias -= RATE_OUT * (1 - step / steps) * p.mean(axis=0)
            np.add.at(vectors, c, -rate * x[:, None] * back[at])
    numbers = np.zeros(BUCKETS)
    numbers[used] = vectors @ (out[:, 1] - out[:, 0])
    return numbers, float(bias[1] - bias[0])



def fit(docs: DataFrame, labels: DataFrame, allowed: Column, id_col: str = "doc_id", text_col: str = "text",
        label: str = "quality") -> bytes | None:
    """The model from at most ``MAX_LABELLED`` labelled documents, whole texts; None
    if there is no label. Only labels for which ``allowed`` holds (over the labels' columns) are read."""
    known = bounded(labelled_ids(labels, label, allowed), MAX_LABELLED, 3)
    if known.isEmpty():
        return None

    def make(y: np.ndarray, entries: Entries | None) -> bytes:
        if len(np.unique(y)) < 2:  # one class or no text: its share, by add-one counts
            return pickle.dumps((np.zeros(BUCKETS, np.float32), float(np.log((y.sum() + 1) / (len(y) - y.sum() + 1)))))
        numbers, bias = fit_embeddings(y, entries)
        return pickle.dumps((numbers.astype(np.float32), bias))
    return trained(sampled_texts(docs, known, id_col, text_col), featurise, make)


def scorer(model: bytes):
    numbers, bias = pickle.loads(model)

    def score(texts: pa.Array) -> np.ndarray:
        row, code, vocabulary = _tokens(texts)
        n = np.maximum(1, np.bincount(row, minlength=len(texts)))
        z = np.bincount(row, word_sums(vocabulary, GRAMS, numbers, mean=True)[code], len(texts)) / n + bias
        return 1 / (1 + np.exp(-np.clip(z, -40, 40)))
    return score


def quality(docs: DataFrame, model: bytes | None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(id, score)`` of every row: the chance of label 1.

    NULL and empty texts get the score of the outputs' bias; without a model (no
    labels) every score is 1, so that nothing is rejected unlearned. Rows with NULL
    ids and repeated rows are scored like others; no rows give none; other columns are not read.
    """
    if model is None:
        return docs.select(F.col(id_col).cast("long").alias("id"), F.lit(1.0).alias("score"))
    shared = docs.sparkSession.sparkContext.broadcast(model)  # one float a bucket
    return scored(docs, lambda: scorer(shared.value), id_col, text_col)


def keep_good(docs: DataFrame, model: bytes | None, text_col: str = "text") -> DataFrame:
    """``docs`` without the rows that the model gives less than a half."""
    if model is None:
        return docs
    shared, at = docs.sparkSession.sparkContext.broadcast(model), docs.columns.index(text_col)

    def run(batches: Iterator[pa.RecordBatch]):
        fn = scorer(shared.value)
        for batch in batches:
            for part in slices(batch, text_col, SCORE_BYTES):
                yield part.filter(pa.array(fn(part.column(at)) >= 0.5))
            give_back()
    return docs.mapInArrow(run, docs.schema)


def op7_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Contract: labels learned outside fold 1 of 3; all of ``documents`` scored."""
    docs = read(spark, sf_dir, "documents")
    model = fit(docs, read(spark, sf_dir, "labels"), allowed_rows())
    held = F.coalesce(fold_of(F.col("id"), 3) == 1, F.lit(False))
    return quality(docs, model).select(F.col("id").alias("doc_id"), held.alias("held_out"), "score",
                                       (F.col("score") >= 0.5).cast("int").alias("predicted"))


def allowed_rows() -> Column:
    return fold_of(F.col("doc_id"), 3) != 1
