"""Sitemap listings through Spark's XML reader."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

_S = T.StringType()

# One <url> element: the page location, the news publication date and the
# last-modified date (namespaces ignored, so news:publication_date matches).
URL_ENTRY_SCHEMA = T.StructType([
    T.StructField("loc", _S),
    T.StructField("lastmod", _S),
    T.StructField("news", T.StructType([T.StructField("publication_date", _S)])),
])


def _blank_to_null(c):
    return F.nullif(F.trim(c), F.lit(""))


def entry_columns(loc, news, lastmod) -> list:
    """``loc`` and ``pub_date`` of one parsed ``<url>`` element."""
    date = F.coalesce(_blank_to_null(news["publication_date"]), _blank_to_null(lastmod))
    return [F.trim(loc).alias("loc"), date.alias("pub_date")]


def parse_entry(xml, schema: T.StructType = URL_ENTRY_SCHEMA):
    """One ``<url>`` element's text as a struct (namespaces ignored, as in :func:`read_sitemap`)."""
    return F.from_xml(xml, schema, {"ignoreNamespace": "true"})


def read_sitemap(spark: SparkSession, path: str, source: str | None = None,
                 streaming: bool = False) -> DataFrame:
    """Listing ``(position, loc, pub_date, source, listing_file)`` from sitemap XML.

    ``pub_date`` is the news publication date, else ``lastmod`` (the first
    wins whatever the element order). ``loc`` is the direct child of
    ``<url>``; nested ``image:loc`` never replaces it. ``position`` is
    increasing in document order within a file (batch only). Streaming
    mode reads new sitemap files as they land.
    """
    reader = spark.readStream if streaming else spark.read
    raw = (reader.format("xml").option("rowTag", "url").option("ignoreNamespace", "true")
           .schema(URL_ENTRY_SCHEMA).load(path))
    cols = []
    if not streaming:
        cols.append(F.monotonically_increasing_id().alias("position"))
    cols += [
        *entry_columns(F.col("loc"), F.col("news"), F.col("lastmod")),
        F.lit(source).cast("string").alias("source"),
        F.col("_metadata.file_path").alias("listing_file"),
    ]
    return raw.select(*cols)
