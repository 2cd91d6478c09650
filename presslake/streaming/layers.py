"""Streaming bronze and silver.

One read of the message stream feeds bronze; silver follows the bronze
folder (a second file-stream over committed bronze files), so messages are
parsed once. Row counts are observed while an epoch is written, by the epoch
itself (``epochs.py``), not by extra actions over each micro-batch.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from presslake.operators.messages import decode_or_reject, to_bronze
from presslake.operators.silver import is_valid_article, project_silver, valid_articles
from presslake.schemas import BRONZE_SCHEMA, REJECT_SCHEMA
from presslake.session import ensure_checkpoint_dir, use_rocksdb
from presslake.sinks.files import Files
from presslake.sinks.seen import BUCKETS, SeenTable
from presslake.sources.layers import path_exists
from presslake.streaming.dedup import first_arrivals
from presslake.streaming.epochs import OUTPUT, count_epoch, watermark, write_epoch


def trigger_kwargs(trigger: str | None) -> dict:
    """``"available_now"`` (bounded run), ``"once"`` or an interval
    such as ``"1 minute"`` (processing-time micro-batches)."""
    if trigger in (None, ""):
        return {}
    if trigger == "available_now":
        return {"availableNow": True}
    if trigger == "once":
        return {"once": True}
    return {"processingTime": trigger}


def start_bronze(messages: DataFrame, path: str, checkpoint: str, trigger: str | None = "1 minute", query_name: str = "bronze",
                 counts_path: str | None = None, rejects_path: str | None = None) -> StreamingQuery:
    """K2: decoded messages as JSON files, every epoch once.

    With ``counts_path`` the epochs write their counts (A7, :func:`presslake.streaming.epochs.read_counts`), and with
    ``rejects_path`` messages that are no record keep their text there, as dead letters beside their empty row in bronze;
    epochs then lie in folders ``epoch=<id>``. Without either, Spark's file sink writes.
    """
    def writer(rows: DataFrame):
        return rows.writeStream.queryName(query_name).option("checkpointLocation", checkpoint).trigger(**trigger_kwargs(trigger))
    if not counts_path and not rejects_path:
        return writer(to_bronze(messages)).format("json").outputMode("append").option("path", path).start()
    outputs = {query_name: path}
    rows = decode_or_reject(messages).withColumn("ingestion_time", F.current_timestamp())
    if rejects_path:
        outputs[rejects := f"{query_name}_rejects"] = rejects_path
        # a dead letter is two rows: its place in bronze, and its text
        kinds = F.when(F.col("reason").isNull(), F.array(F.lit(query_name))).otherwise(F.array(F.lit(query_name), F.lit(rejects)))
        mine = F.col(OUTPUT) == rejects
        rows = rows.withColumn(OUTPUT, F.explode(kinds)).withColumns(
            {c: F.when(mine, F.col(c)) for c in ("reason", "value_text")})
    else:
        rows = rows.drop("reason", "value_text")

    def process(batch: DataFrame, epoch_id: int) -> None:
        write_epoch(batch, epoch_id, outputs, counts_path, "json", event_time="ingestion_time")
    return writer(rows).foreachBatch(process).start()


def read_rejects(spark: SparkSession, path: str) -> DataFrame:
    """The dead letters that bronze epochs have kept."""
    return spark.read.schema(REJECT_SCHEMA).option("recursiveFileLookup", "true").json(path)


def bronze_stream(spark: SparkSession, path: str) -> DataFrame:
    """Follow the bronze folder (only committed files, or published epochs, are listed)."""
    return spark.readStream.schema(BRONZE_SCHEMA).option("recursiveFileLookup", "true").json(path)


def dedup_stream(sdf: DataFrame, key: str = "url", mode: str = "global", delay: str = "1 hour",
                 event_time: str = "ingestion_time") -> DataFrame:
    """Streaming de-duplication on ``key``.

    * ``global``: watermark + ``dropDuplicates([key])``: a key is admitted
      once, ever; the event-time column is not in the key, so state is
      never evicted (it grows with the number of distinct keys; use the
      RocksDB state store).
    * ``bounded``: ``dropDuplicatesWithinWatermark([key])``: duplicates
      within ``delay`` are dropped and state is evicted behind the
      watermark; a key can be admitted again after ``delay``.
    Rows later than the watermark are dropped in both modes.
    """
    w = sdf.withWatermark(event_time, delay)
    if mode == "global":
        return w.dropDuplicates([key])
    if mode == "bounded":
        return w.dropDuplicatesWithinWatermark([key])
    raise ValueError(f"unknown dedup mode {mode!r}")


def silver_stream(bronze: DataFrame, mode: str = "global", delay: str = "1 hour",
                  event_time: str = "ingestion_time") -> DataFrame:
    """F1 -> D1 -> clean -> silver order (dedup before the cleaning)."""
    return project_silver(dedup_stream(valid_articles(bronze), "url", mode, delay, event_time))


def start_silver(bronze: DataFrame, path: str, checkpoint: str, trigger: str | None = "1 minute",
                 mode: str = "global", delay: str = "1 hour", event_time: str = "ingestion_time",
                 partition_by: str | None = None, query_name: str = "silver", counts_path: str | None = None,
                 late_path: str | None = None) -> StreamingQuery:
    """K3: silver as snappy Parquet; optional ``partition_by`` (e.g.
    ``date_parsed``) for partition pruning downstream.

    With ``late_path`` (R4) the state is the library's own (:func:`presslake.streaming.dedup.first_arrivals`): the first arrival
    of a url is admitted, rows behind the watermark go to ``late_path`` and are counted as ``<query_name>_late``.
    With ``counts_path`` every epoch writes its counts; epochs then lie in folders ``epoch=<id>``. Without either,
    Spark's dedup and file sink do the work.
    """
    if late_path:
        use_rocksdb(bronze.sparkSession)
        rows = first_arrivals(valid_articles(bronze), "url", mode=mode, delay=delay, event_time=event_time)
        rows = project_silver(rows, keep=("late", "copies"))
    else:
        rows = silver_stream(bronze, mode, delay, event_time)
    w = (rows.writeStream.queryName(query_name).option("checkpointLocation", checkpoint).trigger(**trigger_kwargs(trigger)))
    if not counts_path and not late_path:
        w = w.format("parquet").outputMode("append").option("path", path).option("compression", "snappy")
        return (w.partitionBy(partition_by) if partition_by else w).start()
    outputs = {query_name: path} | ({f"{query_name}_late": late_path} if late_path else {})

    def process(batch: DataFrame, epoch_id: int) -> None:
        if late_path:
            batch = batch.withColumn(OUTPUT, F.when(F.col("late"), F.lit(f"{query_name}_late")).otherwise(F.lit(query_name))).drop("late")
        write_epoch(batch, epoch_id, outputs, counts_path, "parquet", {"compression": "snappy"}, partition_by, event_time)
    return w.foreachBatch(process).start()


def run_available_now(spark: SparkSession, messages: DataFrame, bronze_path: str, silver_path: str,
                      checkpoint_root: str, mode: str = "global", delay: str = "1 hour", event_time: str = "ingestion_time",
                      counts_path: str | None = None, rejects_path: str | None = None,
                      late_path: str | None = None) -> tuple[StreamingQuery, StreamingQuery]:
    """One bounded run: everything available goes to bronze, then
    bronze to silver; both queries end by themselves."""
    qb = start_bronze(messages, bronze_path, f"{checkpoint_root}/bronze", "available_now", counts_path=counts_path,
                      rejects_path=rejects_path)
    qb.awaitTermination()
    qs = start_silver(bronze_stream(spark, bronze_path), silver_path, f"{checkpoint_root}/silver",
                      "available_now", mode, delay, event_time, counts_path=counts_path, late_path=late_path)
    qs.awaitTermination()
    return qb, qs


def compact_seen(spark: SparkSession, seen_path: str, new_path: str, buckets: int = BUCKETS) -> None:
    """All admitted URLs of a seen table as one epoch (-1) of a new table, for a stream's next start: another number of
    buckets, or a table from before there were buckets. A table in use is compacted by :meth:`SeenTable.compact`."""
    rows = spark.read.schema("url string, epoch long").parquet(seen_path)
    SeenTable(spark, new_path, buckets).add(rows.select("url"), -1)


def start_gold_stream(silver: DataFrame, target, checkpoint: str, trigger: str | None = "5 minutes",
                      query_name: str = "gold") -> StreamingQuery:
    """R11 streaming form of the gold job: the one-pass GROUPING SETS count
    kept as complete-mode streaming state (one row per group), and each
    epoch's result materialised once, stamped once, and split into the four
    tables, which ``foreachBatch`` overwrites (one row per group)."""
    from presslake.operators.gold import gold_one_pass, split_gold
    from presslake.sinks.writers import write_gold

    def publish(batch: DataFrame, epoch_id: int) -> None:
        ensure_checkpoint_dir(batch.sparkSession)
        now = dt.datetime.now(dt.timezone.utc)
        write_gold(split_gold(batch.checkpoint(eager=True), run_ts=now), target)

    return (gold_one_pass(silver).writeStream.queryName(query_name).outputMode("complete")
            .option("checkpointLocation", checkpoint).foreachBatch(publish)
            .trigger(**trigger_kwargs(trigger)).start())


def start_silver_table_dedup(bronze: DataFrame, silver_path: str, seen_path: str, checkpoint: str,
                             trigger: str | None = "1 minute",
                             order: tuple[str, ...] = ("kafka_timestamp", "offset"),
                             query_name: str = "silver_table_dedup", buckets: int = BUCKETS, compact_every: int = 0,
                             counts_path: str | None = None, late_path: str | None = None, delay: str = "1 hour",
                             event_time: str = "ingestion_time") -> StreamingQuery:
    """Silver with skew-tolerant global dedup (``foreachBatch``).

    The stateful ``dropDuplicates`` routes every row of a key to one state
    partition, so a URL carrying a large share of a micro-batch lands in
    one task. Here each micro-batch is de-duplicated with the map-side
    combining aggregate (``dedup_first``), then anti-joined with those buckets of the
    table of URLs already admitted (:class:`SeenTable`) that its own URLs lie in, and the
    survivors are appended to silver and to the seen table.

    Exactly once: the batch's winners and the new URLs are checkpointed, and both tables are
    written from them to the partition ``epoch=<batch id>`` with dynamic
    partition overwrite; earlier attempts of the same epoch are ignored when
    reading the seen table, so a replayed epoch rewrites the same rows. An epoch
    that admits nothing writes nothing. Silver gains an ``epoch`` partition
    column. Only a seen table that is missing while silver is missing too counts as
    empty; one that cannot be read stops the stream.

    ``compact_every`` epochs, buckets with as many parts are merged, between two batches. With ``counts_path`` each epoch writes
    its count and its greatest event time; with ``late_path`` too, rows that stand ``delay`` or more behind the greatest
    event time of earlier epochs are late: every one of them goes to ``late_path``, whole, and is counted there.
    """
    from presslake.operators.silver import new_silver_rows
    if late_path and not counts_path:
        raise ValueError("late rows need the counts of earlier epochs: counts_path")

    def process(batch: DataFrame, epoch_id: int) -> None:
        spark = batch.sparkSession
        ensure_checkpoint_dir(spark)
        files, table, now = Files(spark), SeenTable(spark, seen_path, buckets), dt.datetime.now(dt.timezone.utc).isoformat()
        if not table.exists() and path_exists(spark, silver_path):
            raise RuntimeError(f"silver at {silver_path} has no seen table at {seen_path}")
        if compact_every and epoch_id % compact_every == compact_every - 1 and table.exists():
            table.compact(epoch_id - 1, compact_every)
        if late_path:
            mark = watermark(spark, counts_path, query_name, epoch_id, delay)
            late = F.coalesce(F.col(event_time) <= mark, F.lit(False)) & is_valid_article()
            write_epoch(batch.where(late), epoch_id, {f"{query_name}_late": late_path}, counts_path, event_time=event_time)
            batch = batch.where(~late)
        # the batch's winners are written once; which of them are new is decided on their urls alone
        winners = new_silver_rows(batch, None, order).checkpoint(eager=True)
        urls = winners.select("url")
        new = (table.unseen(urls, before=epoch_id) if table.exists() else urls).checkpoint(eager=True)
        n = new.count()
        if n:
            # the seen table first: without it the silver of an epoch would be no reason to stop
            table.add(new, epoch_id)
            out = project_silver(winners.join(new, "url", "left_semi")).withColumn("epoch", F.lit(epoch_id).cast("long"))
            (out.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
             .partitionBy("epoch").parquet(silver_path))
        if counts_path:
            high = batch.agg(F.max(F.unix_micros(F.col(event_time).cast("timestamp")))).first()[0]
            count_epoch(files, counts_path, query_name, epoch_id, n, now, high)

    return (bronze.writeStream.queryName(query_name).option("checkpointLocation", checkpoint)
            .foreachBatch(process).trigger(**trigger_kwargs(trigger)).start())
