import zlib

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

import presslake.llm.quality as quality
import presslake.llm.toxicity as toxicity
from presslake.llm.features import buckets, fold_of, labelled_ids, spread, word_sums, words
from presslake.llm.queries import QUERIES


def test_words_of_a_batch():
    found = words(pa.array(["b a, b", None, " \n", "A!"]), lower=True, trim=",!")
    voc = found.vocabulary.to_pylist()
    assert [(int(t), voc[c]) for t, c in zip(found.text, found.code)] == [(0, "b"), (0, "a"), (0, "b"), (3, "a")]
    assert len(words(pa.array([], pa.string())).code) == 0
    assert [words(pa.array(["... ,"]), trim=".,").code.tolist()] == [[]]


def brute_buckets(word, sizes, n):
    step, mix, mask = 0x100000001B3, 0x9E3779B97F4A7C15, (1 << 64) - 1
    chars = [ord(c) for c in f"<{word}>"]

    def place(h, salt):
        return ((((h ^ (h >> 29) ^ salt) * mix) & mask) >> 33) % n
    out = [place(sum((c + 1) * pow(step, k + 1, 1 << 64) for k, c in enumerate(chars)) & mask, 0)]
    for size in sizes:
        for i in range(len(chars) - size + 1):
            h = 0
            for c in chars[i:i + size]:
                h = (h * step + c + 1) & mask
            out.append(place(h, size))
    return out


def test_buckets_are_those_of_each_word_alone():
    vocabulary = ["a", "", "été", "日本語", "word", "x" * 300, "😀😀"]
    ends, found = buckets(pa.array(vocabulary), (3, 4), 1009)
    for k, w in enumerate(vocabulary):
        assert sorted(found[ends[k]:ends[k + 1]].tolist()) == sorted(brute_buckets(w, (3, 4), 1009))
    weights = np.random.default_rng(0).random(1009)
    sums = word_sums(pa.array(vocabulary), (3, 4), weights)
    assert sums == pytest.approx([sum(weights[b] for b in brute_buckets(w, (3, 4), 1009)) for w in vocabulary])
    row, bucket, weight = spread(np.array([0, 0, 1]), np.array([0, 4, 0]), np.ones(3), pa.array(vocabulary), (3, 4), 1009)
    got = {(int(r), int(b)): w for r, b, w in zip(row, bucket, weight)}
    for r, ws in ((0, ["a", "word"]), (1, ["a"])):
        for w in ws:
            assert all((r, b) in got for b in brute_buckets(w, (3, 4), 1009))
    assert sum(weight) == 2 * len(brute_buckets("a", (3, 4), 1009)) + len(brute_buckets("word", (3, 4), 1009))


def test_folds_and_labels(spark):
    ids = [0, 1, 2, 17, -5, 10 ** 12]
    df = spark.createDataFrame([(i,) for i in ids] + [(None,)], "doc_id long")
    got = {x.doc_id: x.f for x in df.select("doc_id", fold_of(F.col("doc_id"), 5).alias("f")).collect()}
    assert got == {**{i: zlib.crc32(str(i).encode()) % 5 for i in ids}, None: None}
    labels = spark.createDataFrame([(1, 1), (1, 1), (2, 1), (2, 0), (3, None), (None, 1), (4, 7), (5, 0)], "doc_id long, toxic int")
    assert sorted(map(tuple, labelled_ids(labels, "toxic", F.lit(True)).collect())) == [(1, 1), (5, 0)]


def scores(y, held, predicted):
    pairs = [(a, b) for a, h, b in zip(y, held, predicted) if h]
    return (sum(a == b for a, b in pairs) / len(pairs), sum(a == 1 and b == 1 for a, b in pairs) / max(1, sum(a for a, _ in pairs)),
            sum(a == 0 and b == 1 for a, b in pairs) / max(1, sum(a == 0 for a, _ in pairs)))


@pytest.mark.parametrize("name,label,folds,fold", [("op5_toxicity", "toxic", 5, 0), ("op7_quality", "quality", 3, 1)])
def test_held_out_accuracy(spark, name, label, folds, fold):
    sf = "/root/testdata/sf0.1"
    rows = QUERIES[name](spark, sf).collect()
    assert len(rows) == 10_000 and all(0 <= x.score <= 1 and x.predicted == (x.score >= 0.5) for x in rows)
    assert all(x.held_out == (zlib.crc32(str(x.doc_id).encode()) % folds == fold) for x in rows)
    y = {x.doc_id: x[label] for x in spark.read.parquet(f"{sf}/labels.parquet").collect()}
    mine = [x for x in rows if x.doc_id in y]
    accuracy, recall, false = scores([y[x.doc_id] for x in mine], [x.held_out for x in mine], [x.predicted for x in mine])
    print(name, accuracy, recall, false)
    assert accuracy > 0.97 and recall > 0.85
    assert false < (0.01 if label == "toxic" else 0.02)


@pytest.mark.parametrize("module,fn,label", [(toxicity, "toxicity", "toxic"), (quality, "quality", "quality")])
def test_edge_rows(spark, edge, empty, module, fn, label):
    score = getattr(module, fn)
    labels = spark.createDataFrame([(1, 1), (2, 0), (6, 1), (7, 0), (8, 1), (None, 1), (3, 0)], f"doc_id long, {label} int")
    model = module.fit(edge, labels, F.lit(True))
    out = score(edge, model).collect()
    assert len(out) == 11 and all(0 <= x.score <= 1 for x in out)
    none = module.fit(edge, labels.limit(0), F.lit(True))
    assert none is None and score(edge, none).count() == 11
    for docs, lab in ((empty, labels), (edge, labels.where("doc_id = 2")), (edge, labels.where("doc_id = 1"))):
        assert score(docs, module.fit(docs, lab, F.lit(True))).count() == docs.count()


def test_reruns_agree(spark):
    sf = "/root/testdata/sf0.01"
    a, b = (sorted((x.doc_id, x.score) for x in QUERIES["op7_quality"](spark, sf).collect()) for _ in range(2))
    assert a == b


def test_nnpu_learns_without_negatives():
    r = np.random.default_rng(2)
    n, words_ = 3000, 200
    toxic = r.random(n) < 0.2
    texts = [" ".join(r.choice([f"w{i}" for i in range(words_)], 30)) + (f" vile{r.integers(40)}" if t else "") for t in toxic]
    known = np.flatnonzero(toxic[:1500])[:150]
    entries = toxicity.featurise(pa.array([texts[i] for i in known] + texts))
    y = np.array([1] * len(known) + [0] * n)
    import pickle
    w, b = toxicity.nnpu(y, entries, 0.2)
    got = toxicity.scorer(pickle.dumps((w.astype(np.float32), b)))(pa.array(texts)) >= 0.5
    assert (got == toxic).mean() > 0.98


def test_rejecting_stage_keeps_good_rows(spark, edge, empty):
    sf = "/root/testdata/sf0.01"
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    model = quality.fit(docs, spark.read.parquet(f"{sf}/labels.parquet"), quality.allowed_rows())
    kept = quality.keep_good(docs, model)
    y = {x.doc_id: x.quality for x in spark.read.parquet(f"{sf}/labels.parquet").collect()}
    ids = {x.doc_id for x in kept.collect()}
    assert kept.dtypes == docs.dtypes
    good, bad = [i for i in y if y[i] == 1], [i for i in y if y[i] == 0]
    assert sum(i in ids for i in good) >= 0.99 * len(good) and sum(i in ids for i in bad) <= 0.1 * len(bad)
    assert quality.keep_good(edge, model).columns == edge.columns and quality.keep_good(empty, model).count() == 0
    assert quality.keep_good(edge, None).count() == 11
