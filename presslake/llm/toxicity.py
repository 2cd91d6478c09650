"""Toxicity by non-negative positive-unlabelled learning."""

from __future__ import annotations

import pickle

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from presslake.llm.common import read
from presslake.llm.features import (Entries, bounded, fold_of, labelled_ids, sampled_texts, scored, spread, trained,
                                    word_sums, words)

BUCKETS = 1 << 18
GRAMS = (4, 5)
TRIM = ".,;:!?\"'()[]{}<>#*$%&|-_/"
#: The fit's sample: at most so many confirmed toxic and so many unlabelled documents.
MAX_POSITIVE = 2000
MAX_UNLABELLED = 3000
STEPS = 400
RATE = 0.05
DECAY = 1e-4
#: A bucket gets a weight if its share among the confirmed passes that among the
#: unlabelled by so many standard errors, and if so many documents have it.
MIN_Z = 5.0
MIN_DOCS = 3


def _distinct(texts: pa.Array) -> tuple[np.ndarray, np.ndarray, pa.Array]:
    """Distinct words of each text (its row, the word's code), and their vocabulary."""
    found = words(texts, lower=True, trim=TRIM)
    size = max(1, len(found.vocabulary))
    key = np.unique(found.text * size + found.code)
    return key // size, key % size, found.vocabulary


def featurise(texts: pa.Array) -> Entries:
    """How many of a text's distinct words have each bucket."""
    row, code, vocabulary = _distinct(texts)
    return spread(row, code, np.ones(len(row)), vocabulary, GRAMS, BUCKETS)


def _telling(y: np.ndarray, row: np.ndarray, col: np.ndarray) -> np.ndarray:
    """Buckets that confirmed documents surely have more often than unlabelled ones."""
    n_pos, n_unl = max(1, (y == 1).sum()), max(1, (y == 0).sum())
    pos = np.bincount(col[y[row] == 1], minlength=BUCKETS)
    unl = np.bincount(col[y[row] == 0], minlength=BUCKETS)
    both = (pos + unl) / (n_pos + n_unl)
    error = np.sqrt(np.maximum(both * (1 - both), 1e-12) * (1 / n_pos + 1 / n_unl))
    return np.flatnonzero((pos / n_pos - unl / n_unl >= MIN_Z * error) & (pos + unl >= MIN_DOCS))


def nnpu(y: np.ndarray, entries: Entries, prior: float) -> tuple[np.ndarray, float]:
    """Weights and bias of a linear model from positives (y 1) and unlabelled rows (y 0).

    The risk is ``prior * R+(positives) + max(0, R-(unlabelled) - prior *
    R-(positives))`` with the sigmoid loss: what confirmed documents would cost as
    negatives is taken off what unlabelled text costs, but never below what a
    negative class could cost. Descent over the whole sample with Adam's steps;
    only buckets that confirmed documents have more often get a weight.
    """
    row, col, value = entries
    used = _telling(y, row, col)
    place = np.full(BUCKETS, -1, dtype=np.int32)
    place[used] = np.arange(len(used), dtype=np.int32)
    keep = place[col] >= 0
    row, col, value, n = row[keep], place[col[keep]], value[keep], len(used)
    positive = y == 1
    share = np.where(positive, prior / positive.sum(), 1 / (~positive).sum())
    w, b = np.zeros(n), float(np.log(prior / (1 - prior)))
    m, v, mb, vb = np.zeros(n), np.zeros(n), 0.0, 0.0
    for step in range(1, STEPS + 1):
        z = np.bincount(row, w[col] * value, len(y)) + b
        s = 1 / (1 + np.exp(-np.clip(z, -40, 40)))
        cost = s * share  # of a row as a negative
        slope = s * (1 - s) * share
        minus = cost[~positive].sum() - cost[positive].sum()
        grad = np.where(positive, -slope, 0.0)
        if minus > 0:
            grad += np.where(positive, -slope, slope)
        g, gb = np.bincount(col, grad[row] * value, n) + DECAY * w, grad.sum()
        m, v = 0.9 * m + 0.1 * g, 0.999 * v + 0.001 * g * g
        mb, vb = 0.9 * mb + 0.1 * gb, 0.999 * vb + 0.001 * gb * gb
        rate = RATE * np.sqrt(1 - 0.999 ** step) / (1 - 0.9 ** step)
        w = np.maximum(w - rate * m / (np.sqrt(v) + 1e-8), 0.0)
        b -= rate * mb / (np.sqrt(vb) + 1e-8)
    out = np.zeros(BUCKETS)
    out[used] = w
    return out, b


def fit(docs: DataFrame, labels: DataFrame, allowed: Column, id_col: str = "doc_id", text_col: str = "text",
        label: str = "toxic") -> bytes | None:
    """The model from at most ``MAX_POSITIVE`` confirmed and ``MAX_UNLABELLED`` of all
    documents; None if none is confirmed. Only labels for which ``allowed`` holds
    (over the labels' columns) are read: the confirmed ones, and the share of label 1 as the class prior."""
    known = labelled_ids(labels, label, allowed)
    n, ones = known.agg(F.count("*"), F.sum("y")).first()
    if not ones:
        return None
    prior = min(0.9, max(1e-4, ones / n))
    positive = bounded(known.where("y = 1"), MAX_POSITIVE, 1)
    ids = docs.select(F.col(id_col).cast("long").alias("id")).where("id IS NOT NULL").distinct()
    # unlabelled text is a sample of the whole corpus, the confirmed ones among it
    unlabelled = bounded(ids, MAX_UNLABELLED, 2)
    sample = sampled_texts(docs, positive.union(unlabelled.select("id", F.lit(0).alias("y"))), id_col, text_col)

    def make(y: np.ndarray, entries: Entries | None) -> bytes:
        if not (y == 1).any() or not (y == 0).any():
            return pickle.dumps((np.zeros(BUCKETS, np.float32), float(np.log(prior / (1 - prior)))))
        w, b = nnpu(y, entries, prior)
        return pickle.dumps((w.astype(np.float32), b))
    return trained(sample, featurise, make)


def scorer(model: bytes):
    w, b = pickle.loads(model)

    def score(texts: pa.Array) -> np.ndarray:
        row, code, vocabulary = _distinct(texts)
        z = np.bincount(row, word_sums(vocabulary, GRAMS, w)[code], len(texts)) + b
        return 1 / (1 + np.exp(-np.clip(z, -40, 40)))
    return score


def toxicity(docs: DataFrame, model: bytes | None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(id, score)`` of every row: the chance that a text is toxic.

    A NULL or empty text gets the model's score of no words; without a model
    (nothing confirmed) every score is 0. Rows with NULL ids and repeated rows are
    scored like others; no rows give none; other columns are not read.
    """
    if model is None:
        return docs.select(F.col(id_col).cast("long").alias("id"), F.lit(0.0).alias("score"))
    shared = docs.sparkSession.sparkContext.broadcast(model)  # one float a bucket
    return scored(docs, lambda: scorer(shared.value), id_col, text_col)


def op5_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Contract: labels learned outside fold 0 of 5; all of ``documents`` scored."""
    docs = read(spark, sf_dir, "documents")
    model = fit(docs, read(spark, sf_dir, "labels"), fold_of(F.col("doc_id"), 5) != 0)
    held = F.coalesce(fold_of(F.col("id"), 5) == 0, F.lit(False))
    return toxicity(docs, model).select(F.col("id").alias("doc_id"), held.alias("held_out"), "score",
                                        (F.col("score") >= 0.5).cast("int").alias("predicted"))
