"""Listing selection.

A listing is ``(position, loc, pub_date[, source])``; ``position`` keeps the
document order the file readers do not give.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from presslake.functions.dates import parse_timestamp

# A listing entry whose lower-cased URL contains any of these
# substrings is a media link, not an article.
MEDIA_MARKERS = [".jpg", ".jpeg", ".png", "media.cnn.com"]


def valid_entries(listing: DataFrame, require_date: bool = True) -> DataFrame:
    """Entries with a non-empty (trimmed) ``loc`` and, unless the listing
    is one of bare links (``require_date=False``), ``pub_date``."""
    out = listing.withColumns({"loc": F.trim(F.col("loc")), "pub_date": F.trim(F.col("pub_date"))})
    out = out.filter(F.col("loc").isNotNull() & (F.col("loc") != ""))
    return out.filter(F.col("pub_date").isNotNull() & (F.col("pub_date") != "")) if require_date else out


def is_media(col: str = "loc", markers=MEDIA_MARKERS):
    pat = "|".join(re.escape(m) for m in markers)
    return F.coalesce(F.lower(F.col(col)).rlike(pat), F.lit(False))


def drop_media(listing: DataFrame, col: str = "loc", markers=MEDIA_MARKERS) -> DataFrame:
    """Drop media links (substring test anywhere in the URL)."""
    return listing.filter(~is_media(col, markers))


def newer_than(listing: DataFrame, state: DataFrame, mode: str = "timestamp",
               source_col: str = "source") -> DataFrame:
    """Entries strictly newer than their source's high-water mark.

    ``state`` holds ``(source, last_date)``; a source without a row has the
    empty mark and all its entries are new. ``mode="string"`` compares the
    text (the original behaviour; mixed offsets order wrongly);
    ``mode="timestamp"`` compares instants and falls back to text when
    either side does not parse. A plain equi-join on the source: the planner
    picks its form.
    """
    st = state.select(F.col("source").alias("_mark_source"), F.col("last_date").alias("_mark"))
    joined = listing.join(st, F.col(source_col) == F.col("_mark_source"), "left")
    mark = F.coalesce(F.col("_mark"), F.lit(""))
    by_text = F.col("pub_date") > mark
    if mode == "string":
        cond = by_text
    elif mode == "timestamp":
        a, b = parse_timestamp(F.col("pub_date")), parse_timestamp(mark)
        cond = (mark == "") | F.when(a.isNotNull() & b.isNotNull(), a > b).otherwise(by_text)
    else:
        raise ValueError(f"unknown mode {mode!r}")
    return joined.filter(cond).drop("_mark_source", "_mark")


def newest_first(listing: DataFrame) -> DataFrame:
    """Newest date text first; ties keep document order."""
    return listing.orderBy(F.col("pub_date").desc(), F.col("position").asc())


def first_n(listing: DataFrame, n: int) -> DataFrame:
    """T4: the first ``n`` entries in document order (a top-k, not a full sort)."""
    return listing.orderBy(F.col("position").asc()).limit(n)
