"""Layers written epoch by epoch, each with its counts.

A micro-batch is staged out of sight, its counts are written, then it is renamed to ``epoch=<id>``. A driver that dies
in between runs the epoch again: what was staged is written anew, what was counted is counted anew to the same number, and
what was published stays (the rerun still executes the batch, which stateful operators need, and drops its rows).
So every epoch lies in its layer once and is counted once, however often it ran; nothing waits in memory.
"""

from __future__ import annotations

import datetime as dt
import json

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from presslake.sinks.files import STAGING, Files

COUNT_SCHEMA = "query string, batch_id long, ts timestamp, n long, high timestamp"
#: Column that deals a batch's rows to outputs; it is not written.
OUTPUT = "_output"


def _count_file(counts_path: str, query: str, epoch: int) -> str:
    return f"{counts_path}/query={query}/epoch={epoch}.json"


def write_epoch(batch: DataFrame, epoch: int, outputs: dict[str, str], counts_path: str | None, fmt: str = "parquet",
                options: dict[str, str] | None = None, partition_by: str | None = None, event_time: str | None = None) -> None:
    """Publish one micro-batch. ``outputs`` names folders; with more than one, the column ``_output`` says
    for each row which it goes to. The batch is executed once.

    For every output a count row ``(query, batch_id, ts, n, high)`` goes to ``counts_path``, of empty ones too; ``high`` is the
    greatest ``event_time`` of the rows.
    """
    spark = batch.sparkSession
    files = Files(spark)
    if len(outputs) == 1:
        batch = batch.withColumn(OUTPUT, F.lit(next(iter(outputs))))
    counted, seen = [], Observation()
    for k, name in enumerate(outputs):
        mine = F.col(OUTPUT) == name
        counted.append(F.count(F.when(mine, 1)).alias(f"n{k}"))
        if event_time:
            counted.append(F.max(F.when(mine, F.unix_micros(F.col(event_time).cast("timestamp")))).alias(f"h{k}"))
    first = next(iter(outputs.values()))
    staged = f"{first}/{STAGING}/epoch={epoch}"
    rows = batch.observe(seen, *counted)
    writer = rows.write.mode("overwrite").format(fmt).partitionBy(OUTPUT, *([partition_by] if partition_by else []))
    for k, v in (options or {}).items():
        writer = writer.option(k, v)
    writer.save(staged)
    got = seen.get
    if counts_path:
        now = dt.datetime.now(dt.timezone.utc).isoformat()
        for k, name in enumerate(outputs):
            high = got.get(f"h{k}")
            count_epoch(files, counts_path, name, epoch, got.get(f"n{k}", 0), now, high)
    for name, path in outputs.items():
        # an output without rows has no folder, only its count
        files.publish(f"{staged}/{OUTPUT}={name}", f"{path}/epoch={epoch}")
    files.delete(staged)


def count_epoch(files: Files, counts_path: str, query: str, epoch: int, n: int, ts: str, high_micros: int | None = None) -> None:
    """The count of one epoch, once: a rerun's is the same number and leaves the first run's time."""
    path = _count_file(counts_path, query, epoch)
    if files.exists(path):
        return
    high = None if high_micros is None else (dt.datetime(1970, 1, 1) + dt.timedelta(microseconds=high_micros)).isoformat() + "Z"
    files.write_text(path, json.dumps({"query": query, "batch_id": epoch, "ts": ts, "n": n, "high": high}) + "\n")


def read_counts(spark: SparkSession, path: str, non_empty: bool = True) -> DataFrame:
    """``(query, batch_id, ts, n)``, each micro-batch once; F7: empty ones are skipped by default. No batch yet: no rows."""
    files = Files(spark)
    if not files.exists(path):
        return spark.createDataFrame([], "query string, batch_id long, ts timestamp, n long")
    rows = (spark.read.schema(COUNT_SCHEMA).option("recursiveFileLookup", "true").json(path)
            .select("query", "batch_id", "ts", "n"))
    return rows.filter(F.col("n") > 0) if non_empty else rows


def watermark(spark: SparkSession, counts_path: str, query: str, epoch: int, delay: str) -> Column:
    """The watermark that an epoch runs under: the greatest event time that earlier epochs have counted, less ``delay``.
    NULL (nothing is late) before any. One small file an epoch is read, and one value leaves the table."""
    folder = f"{counts_path}/query={query}"
    if not Files(spark).exists(folder):
        return F.lit(None).cast("timestamp")
    rows = spark.read.schema(COUNT_SCHEMA).option("recursiveFileLookup", "true").json(folder)
    high = rows.where(F.col("batch_id") < epoch).agg(F.max("high").alias("high")).select(F.expr(f"high - INTERVAL {delay}")).first()[0]
    return F.lit(high).cast("timestamp")
