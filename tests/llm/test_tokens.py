import random
import zlib

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

import presslake.llm.tokens as tokens
from presslake.llm.packing import CapacityTree, best_fit_decreasing, pack, sequences
from presslake.llm.queries import QUERIES
from presslake.llm.simple8b import BLOCK_IDS, SELECTORS, decode, encode, read_digests, read_ids, write_ids


@pytest.fixture(scope="module")
def enc(vocabulary):
    return tokens.Encoder(vocabulary)


def library(enc, texts):
    return [e.ids for e in enc.tok.encode_batch([t or "" for t in texts], add_special_tokens=False)]


def ours(enc, texts):
    ids, bounds = enc.encode(pa.array(texts, pa.string()))
    return [ids[a:b].tolist() for a, b in zip(bounds, bounds[1:])]


@pytest.mark.parametrize("alphabet", ["  \t\n\r\x0b\x0c\x85\xa0\x1c\x1eab1é'.s 'tl<| 日😀​﻿　",
                                      "   \n\n,.!abc1é'.s日😀", "ab \n"])
def test_ids_are_the_librarys(enc, alphabet):
    r = random.Random(len(alphabet))
    texts = ["".join(r.choice(alphabet) for _ in range(r.randint(0, 14))) for _ in range(8000)]
    texts += [None, "", "a <|endoftext|>b", "x" * 500 + " " + "y" * 200 + "."]
    assert ours(enc, texts) == library(enc, texts)


def test_real_texts_and_the_cache(enc, monkeypatch, spark, sf):
    monkeypatch.setattr(tokens, "CACHE_PIECES", 50)
    texts = [x.text for x in spark.read.parquet(f"{sf}/documents.parquet").limit(60).collect()]
    expected = library(enc, texts)
    for lo in range(0, 60, 10):
        assert ours(enc, texts[lo:lo + 10]) == expected[lo:lo + 10]


def test_long_texts_go_in_parts(enc, monkeypatch):
    monkeypatch.setattr(tokens, "LONG_CHARS", 10)
    for t in ["ab cd" * 40, "a b c d e f jj\nk l m n.\no p q " * 3, "x" * 100, " a" * 50, "q  w" * 20]:
        assert ours(enc, [t]) == library(enc, [t])


ids64 = st.one_of(st.integers(0, 3), st.integers(0, 50_000), st.integers(0, 2 ** 64 - 1),
                  st.sampled_from([2 ** 60 - 2, 2 ** 60 - 1, 2 ** 60, 2 ** 64 - 1]))


@settings(max_examples=150, deadline=None)
@given(st.lists(ids64, max_size=700))
def test_simple8b_round_trip(values):
    v = np.array(values, dtype=np.uint64)
    shard = encode(v)
    assert np.array_equal(decode(shard), v)
    blocks = -(-len(v) // BLOCK_IDS)
    for b in range(blocks):
        assert np.array_equal(decode(shard, b, b + 1), v[b * BLOCK_IDS:(b + 1) * BLOCK_IDS])


@pytest.mark.parametrize("s", range(16))
def test_each_selector_fills_its_words(s):
    count, bits = SELECTORS[s]
    v = np.full(count * 3, (1 << bits) - 1 if bits < 60 else (1 << 60) - 2, dtype=np.uint64)
    assert np.array_equal(decode(encode(v)), v)
    head = 20 + 8 * (2 + (len(v) - 1) // BLOCK_IDS)
    blocks = [v[i:i + BLOCK_IDS] for i in range(0, len(v), BLOCK_IDS)]
    # runs of zeros may take the wider of the two zero selectors
    words = sum(-(-len(b) // (240 if not bits else count)) for b in blocks)
    assert len(encode(v)) == head + 8 * words


def test_not_a_shard():
    with pytest.raises(ValueError):
        decode(b"x" * 40)


def test_files_hold_the_documents_in_order(spark, edge, empty, vocabulary, enc, scratch):
    write_ids(edge, f"{scratch}/e", vocabulary, shard_ids=20)
    got = sorted(read_ids(spark, f"{scratch}/e").collect(), key=lambda x: x.start)
    expected = sorted(((x.doc_id is not None, x.doc_id or 0), x.text) for x in edge.collect() if x.text is not None)
    assert [x.id for x in got] == sorted([x.doc_id for x in edge.collect()], key=lambda i: (i is not None, i or 0))
    at = 0
    for x in got:
        assert x.start == at and x.ids[-1] == 0
        at += len(x.ids)
    assert sorted(map(tuple, (x.ids for x in got))) == sorted(
        tuple(i + [0]) for i in library(enc, [x.text for x in edge.collect()]))
    assert len(expected) == 9
    write_ids(empty, f"{scratch}/n", vocabulary)
    assert read_digests(spark, f"{scratch}/n").count() == 0


def test_token_query_against_brute_force(spark, sf, enc):
    docs = sorted((d.doc_id, d.text) for d in spark.read.parquet(f"{sf}/documents.parquet").collect())
    at, expected = 0, []
    for (i, _), ids in zip(docs, library(enc, [t for _, t in docs])):
        raw = np.array(ids + [0], dtype="<u4").tobytes()
        expected.append((i, at, len(raw) // 4, zlib.crc32(raw)))
        at += len(raw) // 4
    assert sorted(map(tuple, QUERIES["op3_token_ids"](spark, sf).collect())) == expected


def brute_fit(lengths, window):
    rooms = []
    for n in sorted(lengths, reverse=True):
        fits = [(r, k) for k, r in enumerate(rooms) if r >= n]
        if fits:
            rooms[min(fits)[1]] -= n
        else:
            rooms.append(window - n)
    return sorted(rooms)


@settings(max_examples=80, deadline=None)
@given(st.integers(1, 40).flatmap(lambda w: st.tuples(st.just(w), st.lists(st.integers(1, w), min_size=1, max_size=60))))
def test_best_fit_decreasing_is_the_plain_algorithm(case):
    window, lengths = case
    where, offset = best_fit_decreasing(np.array(lengths), window)
    used = np.bincount(where, weights=lengths).astype(int)
    assert sorted((window - used).tolist()) == brute_fit(lengths, window)
    for w in set(where.tolist()):
        mine = sorted((offset[i], lengths[i]) for i in np.flatnonzero(where == w))
        assert [o for o, _ in mine] == np.cumsum([0, *[n for _, n in mine]])[:-1].tolist()


def test_tree_finds_the_smallest_room():
    tree = CapacityTree(10)
    for room in (3, 7, 7, 9):
        tree.add(room, room)
    assert [tree.tightest(n) for n in (1, 3, 4, 8, 9, 10)] == [3, 3, 7, 9, 9, None]
    tree.take(7), tree.take(7)
    assert tree.tightest(4) == 9


def check_pieces(rows, docs, enc, window):
    """Each document's ids lie in its pieces once, each sequence is gapless and fits."""
    ids = {}
    for i, got in zip([d[0] for d in docs], library(enc, [d[1] for d in docs])):
        ids.setdefault(i, []).append(got + [0])
    by_doc, by_sequence = {}, {}
    for x in rows:
        by_doc.setdefault(x.doc_id, []).append(x)
        by_sequence.setdefault(x.sequence_id, []).append(x)
    assert by_doc.keys() == ids.keys()
    for i, pieces in by_doc.items():
        if len(ids[i]) == 1:
            whole, at = ids[i][0], 0
            for x in sorted(pieces, key=lambda x: x.start):
                raw = np.array(whole[x.start:x.start + x.length], dtype="<u4").tobytes()
                assert (x.start, x.doc_tokens, x.ids_crc32) == (at, len(whole), zlib.crc32(raw))
                at += x.length
            assert at == len(whole)
        else:
            assert sum(x.length for x in pieces) == sum(map(len, ids[i]))
    for pieces in by_sequence.values():
        at = 0
        for x in sorted(pieces, key=lambda x: x.offset):
            assert x.offset == at
            at += x.length
        assert at <= window


def test_packing_edge_rows(spark, edge, empty, vocabulary, enc):
    rows = pack(edge, vocabulary, window=16, with_ids=True).withColumnRenamed("id", "doc_id")
    check_pieces(rows.collect(), [(x.doc_id, x.text) for x in edge.collect()], enc, 16)
    joined = {x.sequence_id: len(x.ids) // 4 for x in sequences(rows).collect()}
    assert max(joined.values()) <= 16 and sum(joined.values()) == sum(x.length for x in rows.collect())
    assert pack(empty, vocabulary).count() == 0


def test_packing_query(spark, sf, enc):
    rows = QUERIES["op4_packing"](spark, sf).collect()
    docs = [(d.doc_id, d.text) for d in spark.read.parquet(f"{sf}/documents.parquet").collect()]
    check_pieces(rows, docs, enc, 1024)
    total = sum(x.length for x in rows)
    assert len({x.sequence_id for x in rows}) <= total / 1024 * 1.03 + 2


def test_padding_does_not_grow_with_the_number_of_tasks(spark, vocabulary, enc):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "text")
    plain = [(x.doc_id, x.text) for x in docs.collect()]
    for tasks in (1, 200):
        rows = pack(docs.repartition(tasks), vocabulary, with_ids=True).withColumnRenamed("id", "doc_id")
        found = rows.collect()
        check_pieces(found, plain, enc, 1024)
        total, n = sum(x.length for x in found), len({x.sequence_id for x in found})
        assert 1024 * n - total <= 0.005 * total + 1024, (tasks, n, total)


def test_second_round_in_several_groups(spark, vocabulary, enc, monkeypatch):
    import presslake.llm.packing as packing
    monkeypatch.setattr(packing, "GATHERED", 16)
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "text").repartition(40)
    rows = pack(docs, vocabulary).withColumnRenamed("id", "doc_id")
    check_pieces(rows.collect(), [(x.doc_id, x.text) for x in docs.collect()], enc, 1024)
