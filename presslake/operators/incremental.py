"""Incremental selection and ingest."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from presslake.functions.dates import parse_timestamp
from presslake.operators.extract import PROFILE_SEG3, Profile, extract_articles
from presslake.operators.listing import drop_media, newer_than, valid_entries
from presslake.operators.silver import dedup_first
from presslake.sinks.seen import SeenTable


def unseen(candidates: DataFrame, seen: DataFrame, key: str = "url",
           order: tuple[str, ...] = ("position",)) -> DataFrame:
    """Candidates whose key was never ingested, each key once.

    A key listed twice in one batch is taken at its first place: the first
    by ``order``, then by the other columns (a map-side combining aggregate).
    Of the seen set, which grows without bound, only the key is read; the
    planner picks the anti join's form. A NULL key is never seen.
    """
    return first_listed(candidates, key, order).join(seen.select(key), key, "left_anti")


def first_listed(candidates: DataFrame, key: str = "url", order: tuple[str, ...] = ("position",)) -> DataFrame:
    """Each key once, at its first place (see :func:`unseen`)."""
    rest = [c for c in candidates.columns if c != key]
    return dedup_first(candidates, key, [c for c in order if c in rest] + [c for c in rest if c not in order])


def newest_by_source(articles: DataFrame, mode: str = "timestamp") -> DataFrame:
    """New-article count and newest date per source (successes only)."""
    if mode == "string":
        newest = F.max("pub_date")
    else:
        newest = F.max_by("pub_date", F.struct(parse_timestamp(F.col("pub_date")), F.col("pub_date")))
    return articles.groupBy("source").agg(F.count(F.lit(1)).alias("n_new"), newest.alias("newest_date"))


def advance_state(state: DataFrame, summary: DataFrame, mode: str = "timestamp") -> DataFrame:
    """K6: the new mark per source = the later of the old mark and the
    newest successful item; sources without new items keep their mark."""
    old = state.select("source", F.col("last_date").alias("_old"))
    new = summary.select("source", F.col("newest_date").alias("_new"))
    j = old.join(new, "source", "full_outer")
    a, b = F.col("_old"), F.col("_new")
    if mode == "string":
        later = F.when(b.isNull(), a).when(a.isNull() | (b > a), b).otherwise(a)
    else:
        ta, tb = parse_timestamp(a), parse_timestamp(b)
        later = (F.when(b.isNull(), a).when(a.isNull() | (a == ""), b)
                 .when(ta.isNotNull() & tb.isNotNull(), F.when(tb > ta, b).otherwise(a))
                 .when(b > a, b).otherwise(a))
    return j.select("source", later.alias("last_date"))


@dataclass
class IncrementResult:
    rows: DataFrame          # every tried item with its ``error``, before the split
    articles: DataFrame      # extracted, successful, ready to publish
    failures: DataFrame      # quarantined (retried next run: the mark ignores them)
    summary: DataFrame       # per source: n_new, newest_date
    state: DataFrame         # the advanced mark, to be written after publishing


def run_incremental(listing: DataFrame, pages: DataFrame, state: DataFrame | None = None,
                    seen: DataFrame | SeenTable | None = None, profile: Profile = PROFILE_SEG3,
                    source: str | None = None, as_of: str | None = None,
                    mode: str = "timestamp", media_filter: bool = False, require_date: bool = True,
                    capture_order: tuple[str, ...] = ("page_id",)) -> IncrementResult:
    """One incremental run as a Spark job.

    listing (position, loc, pub_date, source) -> valid (a polled listing of
    bare links: ``require_date=False``) -> [drop media] -> newer than the mark
    (``state``) and/or unseen (``seen`` urls) -> join the captured pages (the
    latest capture per url, by ``capture_order``, NULL earliest) -> extract.
    Failed extractions (page not captured) go to ``failures`` and do not
    move the mark; see :func:`retry_quarantine` for items that newer
    successes pushed below the mark.
    """
    missing = [c for c in capture_order if c not in pages.columns]
    if missing or not capture_order:
        raise ValueError(f"pages need columns that order captures; missing: {missing}")
    cand = valid_entries(listing, require_date)
    if source is not None and "source" not in cand.columns:
        cand = cand.withColumn("source", F.lit(source))
    if media_filter:
        cand = drop_media(cand)
    if state is not None:
        cand = newer_than(cand, state, mode)
    cand = cand.withColumnRenamed("loc", "url")
    if isinstance(seen, DataFrame):
        cand = unseen(cand, seen, "url")
    elif seen is not None:  # a table in buckets: only those of the candidates are read
        cand = seen.unseen(first_listed(cand, "url"))
    # only the captured pages of the candidates are read into the join, one
    # capture per url (the latest); the aggregate runs on the reduced rows
    captured = pages.select("url", "html", *capture_order).join(cand.select("url"), "url", "left_semi")
    latest = F.struct(*[x for c in capture_order for x in (F.col(c).isNotNull().alias(f"has_{c}"), F.col(c))])
    captured = captured.groupBy("url").agg(F.max_by("html", latest).alias("html"))
    joined = cand.join(captured, "url", "left")
    arts = extract_articles(joined.withColumnRenamed("source", "_listing_source"), profile,
                            source=source, as_of=as_of, keep=("position", "pub_date", "_listing_source"))
    if source is None:
        arts = arts.withColumn("source", F.col("_listing_source"))
    arts = arts.drop("_listing_source")
    ok = arts.filter(F.col("error").isNull()).drop("error")
    failed = arts.filter(F.col("error").isNotNull())   # keeps position, url, pub_date, source
    summary = newest_by_source(ok, mode)
    new_state = advance_state(state, summary, mode) if state is not None else \
        summary.select("source", F.col("newest_date").alias("last_date"))
    return IncrementResult(arts, ok, failed, summary, new_state)


def retry_quarantine(failures: DataFrame, pages: DataFrame, profile: Profile = PROFILE_SEG3,
                     source: str | None = None, as_of: str | None = None) -> IncrementResult:
    """Re-run extraction for quarantined items (``position, url, pub_date,
    source``) against the current page captures, bypassing the mark: an
    older failed item stays below a mark that newer successes moved past.
    Items still not captured come back in ``failures``."""
    listing = failures.select("position", F.col("url").alias("loc"), "pub_date", "source")
    return run_incremental(listing, pages, None, profile=profile, source=source, as_of=as_of, require_date=False)
