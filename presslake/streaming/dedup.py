"""Streaming de-duplication that owns its state.

Spark's ``dropDuplicates`` admits an arbitrary row of a key, hands every row of a hot key to one state partition, and drops
late rows without a trace. Here each task first keeps the earliest row of each key and event time (a hot key reaches the state
about once a task), and a stateful processor admits the first arrival, forgets it by time, and marks what is behind the watermark.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Row
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StatefulProcessor

from presslake.operators.metrics import _interval_us
from presslake.session import use_small_batches

#: Rows, and bytes of rows, that a task's first pass holds before it hands them on; a worker's memory is a few times as much.
HELD_ROWS, HELD_BYTES = 50_000, 8 << 20
COPIES, LATE = "copies", "late"
_AT = "_at"


def earliest(table: pa.Table, keys: Sequence[str], order: Sequence[str]) -> pa.Table:
    """The first row of each key by ``order`` (NULL first; of equal ones the first that came), with the ``copies`` of all added up."""
    place = pc.sort_indices(table.append_column("_row", pa.array(np.arange(len(table)))),
                            sort_keys=[*[(c, "ascending") for c in order], ("_row", "ascending")], null_placement="at_start")
    code = np.zeros(len(table), dtype=np.int64)
    for k in keys:
        coded = pc.dictionary_encode(table.column(k).combine_chunks(), null_encoding="encode")
        _, code = np.unique(code * (len(coded.dictionary) + 1) + np.asarray(coded.indices), return_inverse=True)
    place = np.asarray(place)
    _, first = np.unique(code[place], return_index=True)  # by key: its first place in the order
    total = np.bincount(code, weights=table.column(COPIES).to_numpy()).astype(np.int64)
    out = table.take(pa.array(place[first]))
    return out.set_column(out.schema.get_field_index(COPIES), table.schema.field(COPIES), pa.array(total))


def first_pass(df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """Within what a task holds at a time, the first row of each key, which says in ``copies`` how many it stands for.
    A map step for batch and streaming frames alike; a key's first row always comes through."""
    def run(batches: Iterator[pa.RecordBatch]):
        held, rows, size = [], 0, 0
        for b in batches:
            held.append(b)
            rows, size = rows + b.num_rows, size + b.nbytes
            if rows > HELD_ROWS or size > HELD_BYTES:
                kept = earliest(pa.Table.from_batches(held), keys, order)
                held = b = None  # the rows behind what is handed on are not kept beside it
                # what did not shrink by half is handed on: its keys hardly repeat
                if kept.num_rows * 2 > HELD_ROWS or kept.nbytes * 2 > HELD_BYTES:
                    yield from kept.to_batches()
                    held, rows, size = [], 0, 0
                else:
                    held, rows, size = kept.to_batches(), kept.num_rows, kept.nbytes
        if rows:
            yield from earliest(pa.Table.from_batches(held), keys, order).to_batches()
    counted = df.withColumn(COPIES, F.lit(1).cast("long"))
    return counted.mapInArrow(run, counted.schema)


class FirstArrival(StatefulProcessor):
    """Admits a key's first row by ``order`` and remembers the key: until the watermark passes its event time by
    ``delay_ms``, for ``ttl_ms`` of processing time, or for good."""

    def __init__(self, names: Sequence[str], order: Sequence[str], delay_ms: int | None, ttl_ms: int | None, marks_late: bool):
        self.names, self.order, self.delay_ms, self.ttl_ms, self.marks_late = names, order, delay_ms, ttl_ms, marks_late

    def init(self, handle) -> None:
        self.handle = handle
        self.seen = handle.getValueState("seen", T.StructType([T.StructField("at", T.LongType())]), self.ttl_ms)

    def _place(self, row: Row) -> tuple:
        return tuple(x for c in self.order for x in (row[c] is not None, row[c] if row[c] is not None else 0))

    def _out(self, row: Row, late: bool) -> Row:
        return Row(**{n: row[n] for n in self.names}, **{COPIES: row[COPIES], LATE: late})

    def handleInputRows(self, key, rows: Iterator[Row], timerValues) -> Iterator[Row]:
        mark = timerValues.getCurrentWatermarkInMs() if self.marks_late else 0
        first = None
        for row in rows:
            if self.marks_late and mark > 0 and row[_AT] is not None and row[_AT] <= mark:
                yield self._out(row, True)
            elif first is None or self._place(row) < self._place(first):
                first = row
        if first is not None and not self.seen.exists():
            at = first[_AT] if first[_AT] is not None else mark
            self.seen.update((at,))
            if self.delay_ms is not None:
                self.handle.registerTimer(max(at + self.delay_ms, mark + 1))
            yield self._out(first, False)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[Row]:
        self.seen.clear()
        return iter(())

    def close(self) -> None:
        pass


def first_arrivals(sdf: DataFrame, key: str = "url", order: Sequence[str] = ("kafka_timestamp", "offset"), mode: str = "bounded",
                   delay: str = "1 hour", event_time: str = "ingestion_time", ttl: str | None = None) -> DataFrame:
    """One row a key, the first by ``order`` of the micro-batch that brings it, and what came late; ``late`` tells them apart.

    * ``bounded``: a key is forgotten once the watermark passes its event time by ``delay``, and may come again;
      ``global``: never; ``ttl``: after ``ttl`` of processing time, without regard to event time (nothing is late then; such
      a stream never runs out of batches, so it needs an interval trigger).
    * Late: behind the watermark that the state runs under. Late rows come out whether their key is known or not, those
      of one key and event time as one row; ``copies`` says how many each task's row stands for.
    * A NULL key is a key; a NULL event time is not late. Needs the RocksDB state store.

    Rows pass through Python whole, in batches of bounded size (:func:`presslake.session.use_small_batches`), so start the
    stream before any setting of these is changed.
    """
    use_small_batches(sdf.sparkSession)
    names, first_by = sdf.columns, [c for c in order if c in sdf.columns]
    timed = mode in ("bounded", "global")
    if timed:
        sdf = sdf.withWatermark(event_time, delay)
    elif mode != "ttl" or not ttl:
        raise ValueError(f"unknown dedup mode {mode!r}, or no ttl")
    # the state sees event time as a plain number: as a watermark column its late rows would be dropped before it
    at = F.unix_millis(F.col(event_time).cast("timestamp")) if timed else F.lit(None).cast("long")
    plain = [F.when(F.lit(True), F.col(c)).alias(c) if c == event_time and timed else F.col(c) for c in names]
    rows = first_pass(sdf.select(*plain, at.alias(_AT)), [key, _AT], first_by)
    processor = FirstArrival(names, first_by, _interval_us(delay) // 1000 if mode == "bounded" else None,
                             _interval_us(ttl) // 1000 if mode == "ttl" else None, timed)
    schema = T.StructType([*[T.StructField(f.name, f.dataType) for f in sdf.schema.fields], T.StructField(COPIES, T.LongType()),
                           T.StructField(LATE, T.BooleanType())])
    return rows.groupBy(key).transformWithState(processor, schema, "Append", "EventTime" if timed else "ProcessingTime")
