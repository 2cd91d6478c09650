"""Bronze -> silver (F1, P5, P6, D2), identical for batch and streaming."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from presslake.functions.dates import parse_date
from presslake.functions.text import clean_text


def dedup_first(df: DataFrame, key: str | Sequence[str], order: Sequence[str], where=None) -> DataFrame:
    """One row per key, the first by ``order`` (a unique tiebreak
    should end ``order``); with ``where``, only rows satisfying it compete
    and keys without such a row disappear.

    Expressed as ``min_by`` in an aggregate, not a window: the partial
    aggregate collapses each key map-side before the shuffle, so a key
    holding a large share of all rows never lands whole on one task.
    One ``min_by`` per column (all with the same ordering) rather than one
    over a struct of the row: Catalyst drops the aggregates nobody reads,
    so unused columns are neither computed upstream nor shuffled.
    ``where`` is applied inside the aggregate (rows failing it get a NULL
    ordering, which ``min_by`` ignores) rather than as a Filter, so the
    optimizer cannot push it below an expensive projection such as a JSON
    decode and evaluate that projection twice.
    """
    keys = [key] if isinstance(key, str) else list(key)
    rest = [c for c in df.columns if c not in keys]
    ordering = F.struct(*order)
    if where is not None:
        ordering = F.when(where, ordering)
    # the ordering is materialised once per row, not once per aggregate
    aggs = [F.min_by(F.col(c), F.col("_ord")).alias(c) for c in rest]
    aggs.append(F.min("_ord").alias("_winner"))
    out = df.withColumn("_ord", ordering).groupBy(*keys).agg(*aggs)
    if where is not None:
        out = out.filter(F.col("_winner").isNotNull())
    return out.select(*df.columns)


def silver_columns(bronze: DataFrame) -> dict:
    return {
        "url": F.col("url"),
        "titre_clean": clean_text("titre"),
        "auteur_clean": clean_text("auteur"),
        "categorie_clean": clean_text("categorie"),
        "date_parsed": parse_date("date_publication"),
        "source": F.col("source"),
        "contenu_clean": clean_text("contenu"),
    }


def is_valid_article():
    """raw title and url present (empty strings pass)."""
    return F.col("titre").isNotNull() & F.col("url").isNotNull()


def valid_articles(bronze: DataFrame) -> DataFrame:
    """F1 as a filter (streaming path, where dedup is stateful)."""
    return bronze.filter(is_valid_article())


def project_silver(df: DataFrame, with_ingestion: bool = True, keep: Sequence[str] = ()) -> DataFrame:
    """Cleaned columns in the silver order, then ``keep``."""
    cols = [v.alias(k) for k, v in silver_columns(df).items()]
    if with_ingestion and "ingestion_time" in df.columns:
        cols.append(F.col("ingestion_time"))
    return df.select(*cols, *keep)


def to_silver(bronze: DataFrame, order: Sequence[str] = ("kafka_timestamp", "offset"),
              with_ingestion: bool = True) -> DataFrame:
    """Batch silver: filter, de-duplicate on url (first arrival wins), then
    clean. Dedup runs before cleaning because cleaning never touches url."""
    order = [c for c in order if c in bronze.columns]
    deduped = dedup_first(bronze, "url", order, where=is_valid_article())
    return project_silver(deduped, with_ingestion)


def new_silver_rows(increment: DataFrame, seen_urls: DataFrame | None,
                    order: Sequence[str] = ("kafka_timestamp", "offset")) -> DataFrame:
    """Bronze rows of an increment that belong in silver, not yet cleaned:
    valid, first arrival per url within the increment, and url not already
    admitted (``seen_urls``: a ``url`` column, e.g. silver itself).

    The increment is de-duplicated with the map-side combining aggregate, so a
    hot url travels once per map task; of the admitted urls only that column
    is read, and the planner picks the anti join's form.
    """
    ordered = [c for c in order if c in increment.columns]
    winners = dedup_first(increment, "url", ordered, where=is_valid_article())
    if seen_urls is None:
        return winners
    return winners.join(seen_urls.select("url"), "url", "left_anti")


def append_silver(increment: DataFrame, silver: DataFrame | None, with_ingestion: bool = True) -> DataFrame:
    """Batch form of the global dedup: the cleaned silver rows to append for
    a bronze increment, given the current silver table."""
    return project_silver(new_silver_rows(increment, silver), with_ingestion)
