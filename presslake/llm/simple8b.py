"""Token ids in Simple-8b words, in blocks that decode on their own.

A word's low 4 bits choose how many ids of what width its other 60 bits hold. A
word of all ones (one id of 60 ones) is an escape: the next word is the id
itself. A shard is: magic, number of ids, ids a block, number of blocks (little
endian), where each block's words start and the last end (unsigned 64), words.
"""

from __future__ import annotations

import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from presslake.llm.common import read, shared_path, slices
from presslake.llm.tokens import ENCODE_BYTES, END_ID, encoder, ended

# Fixed values of the code: (ids in a word, bits of each) by selector.
SELECTORS = [(240, 0), (120, 0), (60, 1), (30, 2), (20, 3), (15, 4), (12, 5), (10, 6),
             (8, 7), (7, 8), (6, 10), (5, 12), (4, 15), (3, 20), (2, 30), (1, 60)]
_COUNT = np.array([c for c, _ in SELECTORS])
ESCAPE = np.uint64(0xFFFFFFFFFFFFFFFF)
MAGIC = b"S8B1"
_HEAD = struct.Struct("<4sQII")
BLOCK_IDS = 256
#: Ids a shard row holds before the next begins (a longer document makes a longer one).
SHARD_IDS = 1 << 18


_SHORT = np.frexp(np.arange(1 << 16, dtype=np.float64))[1].astype(np.uint8)


def _widths(ids: np.ndarray) -> np.ndarray:
    """Bits of each id; 61 for one that needs an escape."""
    top = int(ids.max()) if len(ids) else 0
    if top < len(_SHORT):
        return _SHORT[ids.astype(np.uint16)]
    if top < 1 << 52:
        return np.frexp(ids.astype(np.float64))[1].astype(np.uint8)
    width = np.searchsorted(np.uint64(1) << np.arange(60, dtype=np.uint64), ids, side="right").astype(np.uint8)
    width[ids >= np.uint64((1 << 60) - 1)] = 61
    return width


def _best(width: np.ndarray, usable: list[int]) -> np.ndarray:
    """For each place of each block (rows), the selector of ``usable`` that holds most ids from there on."""
    longest = max(SELECTORS[s][0] for s in usable)
    n = width.shape[1]
    spans, size = {1: np.pad(width, ((0, 0), (0, longest)))}, 1
    while size * 2 <= longest:
        last = spans[size]
        spans[size * 2] = np.maximum(last[:, :-size], last[:, size:])
        size *= 2
    best = np.full(width.shape, len(SELECTORS) - 1, dtype=np.uint8)
    for s in sorted(usable, reverse=True)[1:]:
        count, bits = SELECTORS[s]
        size = 1 << (count.bit_length() - 1)
        span = spans[size]
        np.putmask(best, np.maximum(span[:, :n], span[:, count - size:count - size + n]) <= bits, np.uint8(s))
    return best


def encode(ids: np.ndarray, block: int = BLOCK_IDS) -> bytes:
    """A shard of unsigned ids. Blocks are walked side by side: one numpy step
    takes the next word of every block."""
    ids = np.asarray(ids)
    n, blocks = len(ids), -(-len(ids) // block)
    head = _HEAD.pack(MAGIC, n, block, blocks)
    if not n:
        return head + np.zeros(1, dtype="<u8").tobytes()
    width = np.zeros(blocks * block, dtype=np.uint8)
    width[:n] = _widths(ids)
    # a selector that the whole shard has too few small ids for is not looked at
    within = np.cumsum(np.bincount(width[:n], minlength=62))
    usable = [s for s, (count, bits) in enumerate(SELECTORS) if within[bits] >= count or s == len(SELECTORS) - 1]
    width = width.reshape(blocks, block)
    # a block's last word may reach past its end: there are zeros
    stride = block + max(SELECTORS[s][0] for s in usable)
    flat = np.zeros((blocks, stride), dtype=np.uint64)
    flat[:n // block, :block] = ids[:n // block * block].reshape(-1, block)
    flat[n // block:, :n % block] = ids[n // block * block:]
    flat = flat.ravel()
    best = _best(width, usable)
    left = np.full(blocks, block)
    left[-1] = n - (blocks - 1) * block
    live, at, steps = np.arange(blocks), np.zeros(blocks, dtype=np.int64), []
    while len(live):
        steps.append((live, at))
        at = at + _COUNT[best[live, at]]
        more = at < left[live]
        live, at = live[more], at[more]
    walked = np.full((blocks, len(steps)), -1, dtype=np.int32)
    for k, (live, at) in enumerate(steps):
        walked[live, k] = at
    row, step = np.nonzero(walked >= 0)
    place = walked[row, step]
    chosen, escaped = best[row, place], width[row, place] > 60
    size = 1 + escaped
    slot = np.cumsum(size) - size
    offsets = np.concatenate(([0], np.cumsum(np.bincount(row, weights=size, minlength=blocks)))).astype("<u8")
    words = np.zeros(int(offsets[-1]), dtype="<u8")
    start = row * stride + place
    for s in usable:
        count, bits = SELECTORS[s]
        mine = np.flatnonzero((chosen == s) & ~escaped)
        if not len(mine):
            continue
        word = np.full(len(mine), s, dtype=np.uint64)
        at = start[mine]
        for k in range(count if bits else 0):
            word |= flat[at + k] << np.uint64(4 + bits * k)
        words[slot[mine]] = word
    words[slot[escaped]] = ESCAPE
    words[slot[escaped] + 1] = flat[start[escaped]]
    return head + offsets.tobytes() + words.tobytes()


def decode(shard: bytes, first: int = 0, last: int | None = None) -> np.ndarray:
    """The ids of blocks ``first`` to before ``last`` (all of them if not given)."""
    magic, n, block, blocks = _HEAD.unpack_from(shard)
    if magic != MAGIC:
        raise ValueError("not a shard of Simple-8b words")
    last = blocks if last is None else min(last, blocks)
    if first >= last:
        return np.zeros(0, dtype=np.uint64)
    offsets = np.frombuffer(shard, "<u8", blocks + 1, _HEAD.size).astype(np.int64)
    base = _HEAD.size + 8 * (blocks + 1)
    words = np.frombuffer(shard, "<u8", int(offsets[last] - offsets[first]), base + 8 * int(offsets[first]))
    begins = offsets[first:last] - offsets[first]
    left = np.full(last - first, block)
    if last == blocks:
        left[-1] = n - (blocks - 1) * block
    chosen = (words & np.uint64(15)).astype(np.int64)
    # in a run of all ones every second word is an escaped id
    ones = words == ESCAPE
    escape = raw = np.zeros(len(words), dtype=bool)
    if ones.any():
        index = np.arange(len(words))
        run = index - np.maximum.accumulate(np.where(ones, -1, index))
        escape = ones & (run % 2 == 1)
        raw = np.concatenate(([False], escape[:-1]))
    count = np.where(raw, 0, _COUNT[chosen])
    ends = np.append(begins[1:], len(words))
    final = ends - 1 - raw[ends - 1]
    count[final] -= np.add.reduceat(count, begins) - left
    place = np.cumsum(count) - count
    out = np.zeros(int(left.sum()), dtype=np.uint64)
    for s, (many, bits) in enumerate(SELECTORS):
        if not bits:
            continue
        mine = np.flatnonzero((chosen == s) & ~raw & ~escape)
        if not len(mine):
            continue
        word, to, have = words[mine] >> np.uint64(4), place[mine], count[mine]
        mask = np.uint64((1 << bits) - 1)
        for k in range(many):
            some = have > k
            out[to[some] + k] = (word[some] >> np.uint64(bits * k)) & mask
    out[place[escape]] = words[np.flatnonzero(escape) + 1] if escape.any() else 0
    return out


_SHARD_SCHEMA = "part int, shard int, first long, n_ids long, doc_ids array<long>, doc_sizes array<long>, data binary"


def write_ids(docs: DataFrame, path: str, vocabulary: str, id_col: str = "doc_id", text_col: str = "text",
              end_id: int = END_ID, shard_ids: int = SHARD_IDS) -> None:
    """Write the ids of whole texts, ``end_id`` after each, in ascending id order.

    Ranges of ids are dealt to partitions; each writes a file of shard rows and
    numbers the ids it has written, so ``first`` is a shard's place in its part. A
    NULL text is empty, NULL ids come first, rows that share an id follow each
    other by text and are dealt over several partitions where they are many. A
    document lies in one shard. Other columns are not read.
    """
    def run(batches: Iterator[pa.RecordBatch]):
        enc, part = encoder(vocabulary), TaskContext.get().partitionId()
        ids, keys, sizes, shard, first = [], [], [], 0, 0

        def row():
            flat = np.concatenate(ids)
            return pa.RecordBatch.from_pylist([{
                "part": part, "shard": shard, "first": first, "n_ids": len(flat), "doc_ids": keys,
                "doc_sizes": sizes, "data": encode(flat)}], schema)
        for batch in batches:
            for piece in slices(batch, limit=ENCODE_BYTES):
                got, bounds = ended(*enc.encode(piece.column(1)), end_id)
                names, at = piece.column(0).to_pylist(), 0
                # where the running number of ids passes a shard's size
                while at < len(names):
                    have = sum(map(len, ids))
                    end = int(np.searchsorted(bounds, bounds[at] + shard_ids - have, side="left"))
                    end = min(max(end, at + 1), len(names))
                    ids.append(got[bounds[at]:bounds[end]])
                    keys += names[at:end]
                    sizes += np.diff(bounds[at:end + 1]).tolist()
                    at = end
                    if sum(map(len, ids)) >= shard_ids:
                        yield row()
                        first, shard = first + sum(sizes), shard + 1
                        ids, keys, sizes = [], [], []
        if keys:
            yield row()

    schema = pa.schema([("part", pa.int32()), ("shard", pa.int32()), ("first", pa.int64()), ("n_ids", pa.int64()),
                        ("doc_ids", pa.list_(pa.int64())), ("doc_sizes", pa.list_(pa.int64())), ("data", pa.binary())])
    order = ["id", "tie", "row"]
    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text"))
    rows = rows.withColumns({"tie": F.xxhash64("text"), "row": F.monotonically_increasing_id()})
    (rows.repartitionByRange(*order).sortWithinPartitions(*order).select("id", "text")
     .mapInArrow(run, _SHARD_SCHEMA).write.option("compression", "zstd").parquet(path))


def _part_starts(spark: SparkSession, path: str) -> dict[int, int]:
    """How many ids all earlier parts hold: one number for each file written."""
    parts = spark.read.schema(_SHARD_SCHEMA).parquet(path).groupBy("part").agg(F.sum("n_ids")).collect()
    out, total = {}, 0
    for part, n in sorted(parts):
        out[part] = total
        total += n
    return out


def _documents(batch: pa.RecordBatch, starts: dict[int, int]):
    for part, first, names, sizes, data in zip(*(batch.column(c).to_pylist() for c in
                                                 ("part", "first", "doc_ids", "doc_sizes", "data"))):
        ids, start = decode(data).astype("<u4"), 0
        for name, size in zip(names, sizes):
            yield name, starts[part] + first + start, ids[start:start + size]
            start += size


def _read(spark: SparkSession, path: str, emit, schema: str) -> DataFrame:
    starts = _part_starts(spark, path)
    return (spark.read.schema(_SHARD_SCHEMA).parquet(path).select("part", "first", "doc_ids", "doc_sizes", "data")
            .mapInArrow(lambda batches: (emit(list(_documents(b.slice(i, 1), starts)))
                                         for b in batches for i in range(len(b))), schema))


def read_ids(spark: SparkSession, path: str) -> DataFrame:
    """``(id, start, ids)`` of every document in a folder of shards; ``start`` counts the ids before it."""
    def emit(docs):
        return pa.RecordBatch.from_arrays([
            pa.array([d[0] for d in docs], pa.int64()), pa.array([d[1] for d in docs], pa.int64()),
            pa.array([d[2].astype(np.int64) for d in docs], pa.list_(pa.int64()))], ["id", "start", "ids"])
    return _read(spark, path, emit, "id long, start long, ids array<long>")


def read_digests(spark: SparkSession, path: str) -> DataFrame:
    """``(id, start, n_ids, crc32)`` of every document in a folder of shards."""
    def emit(docs):
        return pa.RecordBatch.from_arrays([
            pa.array([d[0] for d in docs], pa.int64()), pa.array([d[1] for d in docs], pa.int64()),
            pa.array([len(d[2]) for d in docs], pa.int64()),
            pa.array([zlib.crc32(d[2].tobytes()) for d in docs], pa.int64())], ["id", "start", "n_ids", "crc32"])
    return _read(spark, path, emit, "id long, start long, n_ids long, crc32 long")


def op3_token_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Contract: ids of every document, written as shards and read back."""
    import public_tokenizers
    path = shared_path(spark, "token-ids")
    write_ids(read(spark, sf_dir, "documents"), path, public_tokenizers.path("byte_bpe_50k.json"))
    return read_digests(spark, path).toDF("doc_id", "start", "n_tokens", "ids_crc32")
