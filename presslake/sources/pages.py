"""Captured pages ``(page_id, url, html)`` (S3)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def read_pages(spark: SparkSession, path: str, fmt: str = "parquet", hosts: Sequence[str] | None = None,
               partitions: int | None = None) -> DataFrame:
    """Pages captured by an external fetcher. Only the columns a query uses
    are read (``html`` is the wide one; title/category queries never
    touch the bytes they do not need). The scan's splits decide how wide
    the CPU-bound extraction runs: a capture that ``sinks.write_pages`` laid
    out splits by itself; ``partitions`` spreads one that does not (a file of a
    single row group), at the cost of one shuffle of the pages. ``hosts`` keeps
    the pages of these hosts (none: no pages); the filter reaches the scan of such a layout.
    """
    pages = spark.read.format(fmt).load(path)
    if hosts is not None:
        pages = pages.where(F.col("host").isin(list(hosts)))
    pages = pages.select("page_id", "url", "html")
    return pages.repartition(partitions) if partitions else pages
