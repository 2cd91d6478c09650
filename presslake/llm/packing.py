"""Packing of token ids into windows: best-fit decreasing."""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from presslake.llm.common import give_back, read, slices, written
from presslake.llm.tokens import ENCODE_BYTES, END_ID, encoder, ended

WINDOW = 1024
#: Rests a task gathers before it packs them (a partition's last gathering may be smaller).
GATHERED = 1 << 14
#: A window with more room than this share of it is opened again and its pieces are packed with other tasks'.
LOOSE = 1 / 128
#: Marks the sequences of that second round.
SECOND = 1 << 62


class CapacityTree:
    """Open windows by remaining capacity: a segment tree whose nodes count the open
    windows below them; ``tightest`` finds the smallest capacity that is enough."""

    def __init__(self, capacity: int):
        self.size = 1 << capacity.bit_length()
        self.count = [0] * (2 * self.size)
        self.open: list[list[int]] = [[] for _ in range(capacity + 1)]

    def add(self, capacity: int, window: int) -> None:
        self.open[capacity].append(window)
        self._change(capacity, 1)

    def take(self, capacity: int) -> int:
        self._change(capacity, -1)
        return self.open[capacity].pop()

    def _change(self, capacity: int, by: int) -> None:
        node = capacity + self.size
        while node:
            self.count[node] += by
            node >>= 1

    def tightest(self, least: int) -> int | None:
        """The smallest capacity of at least ``least`` that an open window has."""
        count, node = self.count, least + self.size
        if not count[node]:
            # up to the first right neighbour that holds a window, then down its left side
            while node > 1 and (node & 1 or not count[node + 1]):
                node >>= 1
            if node == 1:
                return None
            node += 1
            while node < self.size:
                node *= 2
                node += not count[node]
        return node - self.size


def best_fit_decreasing(lengths: np.ndarray, window: int) -> tuple[np.ndarray, np.ndarray]:
    """(window, offset) of each length (1 to ``window``), longest first, equal lengths in their order."""
    tree, used = CapacityTree(window), 0
    where, offset = np.zeros(len(lengths), dtype=np.int64), np.zeros(len(lengths), dtype=np.int64)
    for i in np.argsort(-lengths, kind="stable").tolist():
        n = int(lengths[i])
        room = tree.tightest(n)
        if room is None:
            room, w, used = window, used, used + 1
        else:
            w = tree.take(room)
        where[i], offset[i] = w, window - room
        if room > n:
            tree.add(room - n, w)
    return where, offset


def _batch(pieces: list[tuple]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.array(list(c), t) for c, t in zip(zip(*pieces), [pa.int64()] * 7 + [pa.binary()])], _NAMES)


def _packed(rests: list[tuple], first: int, window: int) -> tuple[list[tuple], int, np.ndarray]:
    """The rests' rows with sequences from ``first`` on and offsets, how many sequences, and the room left in each."""
    lengths = np.array([r[2] for r in rests])
    where, offset = best_fit_decreasing(lengths, window)
    used = np.bincount(where, weights=lengths).astype(np.int64)
    rows = [(*r[:5], first + w, o, r[-1]) for r, w, o in zip(rests, where.tolist(), offset.tolist())]
    return rows, len(used), window - used


_SCHEMA = ("id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, "
           "offset long, ids binary")
_NAMES = [c.split()[0] for c in _SCHEMA.split(", ")]


def pack(docs: DataFrame, vocabulary: str, window: int = WINDOW, id_col: str = "doc_id", text_col: str = "text",
         end_id: int = END_ID, with_ids: bool = False) -> DataFrame:
    """One row for each piece of each document: where it starts in the document's ids
    (``end_id`` included), its length and digest, its sequence and its offset there; with ``with_ids``
    also the ids themselves (unsigned 32-bit little endian).

    Documents longer than a window are cut into full windows; the rests, and the
    shorter documents whole, are packed by best-fit decreasing in two rounds. First each task packs
    what it reads, 16,384 rests at a time; then the pieces of windows left with more room than
    ``LOOSE`` of theirs, and no others, are shuffled into groups of about as many and packed again, so padding does not
    grow with the number of tasks. The first round's rows are written once to the shared folder. A sequence's id is
    its task's number and its number there, of the second round with ``SECOND`` added. A NULL text is empty (one id), NULL
    and repeated ids are documents of their own, no rows give none; other columns
    are not read.
    """
    room = int(window * LOOSE)

    def run(batches: Iterator[pa.RecordBatch]):
        enc, next_id = encoder(vocabulary), TaskContext.get().partitionId() << 40
        rests: list[tuple] = []

        def packed():
            nonlocal rests, next_id
            rows, n, left = _packed(rests, next_id, window)
            loose = left[np.array([r[5] for r in rows]) - next_id] > room
            rests, next_id = [], next_id + n
            # a piece to be packed again keeps its window's number, negative: no two pieces share it and the offset
            return _batch([(*r[:5], -1 - r[5], *r[6:]) if again else r for r, again in zip(rows, loose.tolist())])
        for batch in batches:
            for part in slices(batch, limit=ENCODE_BYTES // 2):
                ids, bounds = ended(*enc.encode(part.column(1)), end_id)
                full = []
                for k, name in enumerate(part.column(0).to_pylist()):
                    low, high = int(bounds[k]), int(bounds[k + 1])
                    for at in range(low, high, window):
                        piece = ids[at:min(high, at + window)].tobytes()
                        row = (name, at - low, len(piece) // 4, zlib.crc32(piece), high - low)
                        if len(piece) == 4 * window:
                            full.append((*row, next_id, 0, piece if with_ids else None))
                            next_id += 1
                        else:
                            rests.append((*row, piece if with_ids else None))
                if full:
                    yield _batch(full)
                if len(rests) >= GATHERED:
                    yield packed()
            give_back()
        if rests:
            yield packed()

    def again(batches: Iterator[pa.RecordBatch]):
        next_id, rests = SECOND + (TaskContext.get().partitionId() << 40), []
        for batch in batches:
            rests += [(*r.values(),) for r in batch.to_pylist()]
            while len(rests) >= 2 * GATHERED:
                rows, n, _ = _packed(rests[:GATHERED], next_id, window)
                next_id, rests = next_id + n, rests[GATHERED:]
                yield _batch(rows)
        if rests:
            yield _batch(_packed(rests, next_id, window)[0])

    out = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text"))
    out = out.mapInArrow(run, _SCHEMA)
    out = written(out if with_ids else out.drop("ids"), "packed")
    loose = out.where("sequence_id < 0")
    groups = max(1, loose.count() // GATHERED)
    if not with_ids:
        loose = loose.withColumn("ids", F.lit(None).cast("binary"))
    # windows fall to groups by their number and come in its order, so a task run again packs alike
    loose = loose.repartition(groups, F.xxhash64("sequence_id")).sortWithinPartitions("sequence_id", "offset")
    loose = loose.mapInArrow(again, _SCHEMA)
    return out.where("sequence_id >= 0").unionByName(loose if with_ids else loose.drop("ids"))


def sequences(pieces: DataFrame) -> DataFrame:
    """``(sequence_id, ids)`` from pieces with ids: each sequence's ids in order (at most a window's)."""
    parts = F.sort_array(F.collect_list(F.struct("offset", "ids")))
    return pieces.groupBy("sequence_id").agg(parts.alias("parts")).select(
        "sequence_id", F.aggregate("parts", F.unhex(F.lit("")), lambda a, p: F.concat(a, p["ids"])).alias("ids"))


def op4_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Contract: every document packed into windows of 1024."""
    import public_tokenizers
    return pack(read(spark, sf_dir, "documents"),
                public_tokenizers.path("byte_bpe_50k.json")).withColumnRenamed("id", "doc_id")
