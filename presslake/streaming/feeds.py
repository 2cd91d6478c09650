"""Operational feeds: per-batch counts -> metric samples.

The layer counters of the original job lived in process memory and
restarted at 0. Here each micro-batch writes its row count as a row
``(query, batch_id, ts, n)`` (``epochs.py``); running totals are derived by a window over
those rows, so they survive restarts and can be recomputed.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from presslake.operators.metrics import running_total
from presslake.sources.sitemap import read_sitemap
from presslake.streaming.layers import dedup_stream, trigger_kwargs

def batches_to_samples(batches: DataFrame, metric_prefix: str = "news_articles_",
                       instance: str = "streaming-job") -> DataFrame:
    """Per-batch counts -> cumulative counter samples per layer
    (``news_articles_<query>_total``)."""
    rt = running_total(batches, layer="query", batch="batch_id", n="n")
    return rt.select(
        F.concat(F.lit(metric_prefix), F.col("query"), F.lit("_total")).alias("metric"),
        F.create_map(F.lit("instance"), F.lit(instance), F.lit("job"), F.col("query")).alias("labels"),
        F.col("ts").cast("timestamp").alias("ts"),
        F.col("running_total").cast("double").alias("value"),
    )


def start_listing_poll(spark: SparkSession, listing_dir: str, out_path: str, checkpoint: str,
                       source: str, trigger: str | None = "1 minute", media_filter: bool = True):
    """Follow a folder where sitemap snapshots land; emit every URL the
    first time it is seen (global streaming dedup on ``loc``). The first
    ``available_now`` run is the backfill; later runs are the polling."""
    from presslake.operators.listing import drop_media
    lst = read_sitemap(spark, listing_dir, source=source, streaming=True)
    lst = lst.filter(F.col("loc").isNotNull() & (F.col("loc") != ""))
    if media_filter:
        lst = drop_media(lst)
    new = dedup_stream(lst.withColumn("seen_at", F.current_timestamp()), "loc", "global", "1 hour", "seen_at")
    return (new.writeStream.format("parquet").outputMode("append").option("path", out_path)
            .option("checkpointLocation", checkpoint).trigger(**trigger_kwargs(trigger)).start())
