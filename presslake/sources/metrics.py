"""Metric sample table (S7): ``(metric, labels, ts, value)``."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from presslake.schemas import METRIC_SAMPLE_SCHEMA


def read_metric_samples(spark: SparkSession, path: str, streaming: bool = False) -> DataFrame:
    """Samples appended by the feeds of :mod:`presslake.streaming.feeds` (or
    any scraper writing the same columns)."""
    reader = spark.readStream if streaming else spark.read
    return reader.schema(METRIC_SAMPLE_SCHEMA).parquet(path)
