"""Named queries: each takes ``(spark, sf_dir)`` and returns a DataFrame.

Every query reads whole tables of the data folder (or rows Spark derives
from them) and is the composition a user of the library would write.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from presslake.functions.dates import normalize_date, now_text, parse_date
from presslake.functions.scalars import scale, strip_ns, url_host
from presslake.functions.text import clean_text, preview
from presslake.functions import html as H
from presslake.operators import extract as X
from presslake.operators import gold as G
from presslake.operators import incremental as I
from presslake.operators import listing as L
from presslake.operators import metrics as M
from presslake.operators import rollups as R
from presslake.operators.messages import decode_messages, encode_messages, message_rejects, to_bronze
from presslake.operators.quality import latest_rows, profile
from presslake.operators.ranking import global_row_number
from presslake.operators.silver import dedup_first, project_silver, to_silver, valid_articles
from presslake.plans import fixtures as FX
from presslake.session import new_path, use_rocksdb
from presslake.sinks.pages import write_pages
from presslake.sinks.seen import SeenTable
from presslake.sources.pages import read_pages
from presslake.sources.sitemap import entry_columns, parse_entry
from presslake.sources.tables import table, table_stream
from presslake.streaming.dedup import first_arrivals


def _derive(df: DataFrame, cols: dict[str, str]) -> DataFrame:
    return df.select(*[F.expr(v).alias(k) for k, v in cols.items()])


# ---------------------------------------------------------------- fixtures as DataFrames

def spread_table(spark, sf, name):
    """A table of texts, spread over ``spark.presslake.scan.partitions`` tasks if the session sets that (for files of
    one row group, which a scan cannot split); unset, the scan's own splits decide."""
    df, n = table(spark, sf, name), spark.conf.get("spark.presslake.scan.partitions", None)
    return df.repartition(int(n)) if n else df


def pages_with_head(spark, sf):
    return _derive(spread_table(spark, sf, "pages"), FX.pages_with_head_cols())


def article_messages(spark, sf) -> DataFrame:
    """Documents -> article records -> encoded messages (value, timestamp, offset)."""
    arts = _derive(spread_table(spark, sf, "documents"), FX.article_cols())
    arts = (arts.withColumnRenamed("msg_offset", "offset")
            .withColumn("timestamp", F.timestamp_seconds(F.lit(1704067200) + F.col("offset"))))
    return encode_messages(arts, timestamp_col="timestamp", keep=("offset",))


def bronze_articles(spark, sf) -> DataFrame:
    return decode_messages(article_messages(spark, sf))


def events_silver(spark, sf) -> DataFrame:
    return _derive(table(spark, sf, "events"), FX.events_silver_cols())


def samples(spark, sf) -> DataFrame:
    s = _derive(table(spark, sf, "events"), FX.sample_cols())
    return s.select("metric", F.create_map(F.lit("job"), "job", F.lit("instance"), "instance").alias("labels"),
                    "ts", "value", "sample_id")


def _series_out() -> list:
    return [F.col("labels")["job"].alias("job"), F.col("labels")["instance"].alias("instance")]


# ---------------------------------------------------------------- text / dates

def q_clean_text(spark, sf):
    return spread_table(spark, sf, "documents").select("doc_id", clean_text("text").alias("text_clean"))


def q_clean_html(spark, sf):
    return table(spark, sf, "pages").select("page_id", clean_text("html").alias("html_clean"))


def q_title_preview(spark, sf):
    return table(spark, sf, "documents").select("doc_id", preview("text", 60).alias("preview"))


def q_date_parse(spark, sf):
    d = _derive(table(spark, sf, "orders"), FX.order_date_cols())
    return d.select("o_orderkey", "date_text", parse_date("date_text").alias("date_parsed"))


def q_date_normalize(spark, sf):
    d = _derive(table(spark, sf, "events"), FX.event_date_text_cols())
    return d.select("event_id", "raw", normalize_date("raw").alias("normalized"))


# ---------------------------------------------------------------- extraction

def q_extract_title(spark, sf):
    p = H.with_parts(spread_table(spark, sf, "pages"))
    parts = H.column_parts()
    return p.select("page_id", X.title_expr(F.col("html"), X.PROFILE_SEG3, parts).alias("titre"),
                    X.title_expr(F.col("html"), X.PROFILE_SEG6, parts).alias("titre_seg6"))


def q_extract_title_captured(spark, sf):
    """Titles of all pages, from a capture laid out by host in bounded row groups."""
    path = new_path(spark, "capture")
    write_pages(table(spark, sf, "pages"), path)
    p = H.with_parts(read_pages(spark, path))
    return p.select("page_id", url_host("url").alias("source"),
                    X.title_expr(F.col("html"), X.PROFILE_SEG3, H.column_parts()).alias("titre"))


def q_extract_category(spark, sf):
    p = table(spark, sf, "pages")
    return p.select("page_id", X.category_expr(F.col("url"), X.PROFILE_SEG3).alias("categorie"),
                    X.category_expr(F.col("url"), X.PROFILE_SEG6).alias("categorie_seg6"))


def q_extract_source(spark, sf):
    return table(spark, sf, "pages").select("page_id", url_host("url").alias("source"))


def q_extract_body(spark, sf):
    p = H.with_parts(spread_table(spark, sf, "pages"))
    return p.select("page_id", X.body_expr(F.col("html"), X.PROFILE_SEG3, parts=H.column_parts()).alias("contenu"))


def q_extract_author(spark, sf):
    p = H.with_parts(pages_with_head(spark, sf))
    return p.select("page_id", X.author_expr(F.col("html"), X.PROFILE_SEG3, H.column_parts()).alias("auteur"))


def q_extract_date(spark, sf):
    p = H.with_parts(pages_with_head(spark, sf))
    return p.select("page_id", X.date_expr(F.col("html"), X.PROFILE_SEG3, FX.AS_OF, H.column_parts())
                    .alias("date_publication"))


def q_extract_author_seg6(spark, sf):
    p = H.with_parts(pages_with_head(spark, sf))
    return p.select("page_id", X.author_expr(F.col("html"), X.PROFILE_SEG6, H.column_parts()).alias("auteur"))


def q_extract_date_seg6(spark, sf):
    p = H.with_parts(pages_with_head(spark, sf))
    return p.select("page_id", X.date_expr(F.col("html"), X.PROFILE_SEG6, FX.AS_OF, H.column_parts())
                    .alias("date_publication"))


def q_extract_articles_seg6(spark, sf):
    arts = X.extract_articles(pages_with_head(spark, sf), X.PROFILE_SEG6, source="seg6", as_of=FX.AS_OF)
    return arts.drop("error")


def q_extract_articles(spark, sf):
    arts = X.extract_articles(pages_with_head(spark, sf), X.PROFILE_SEG3, as_of=FX.AS_OF)
    return arts.drop("error")


# ---------------------------------------------------------------- messages / silver

def q_message_decode(spark, sf):
    ev = table(spark, sf, "events")
    msgs = ev.select(F.col("props").cast("binary").alias("value"), F.col("ts").alias("timestamp"),
                     F.col("event_id").alias("offset"))
    return decode_messages(msgs, schema=_k_schema()).select(
        F.col("offset").alias("event_id"), "k", "kafka_timestamp")


def _k_schema():
    from pyspark.sql import types as T
    return T.StructType([T.StructField("k", T.StringType())])


def q_message_roundtrip(spark, sf):
    b = bronze_articles(spark, sf)
    return b.select(F.col("offset").alias("doc_id"), "titre", "auteur", "date_publication", "categorie",
                    "contenu", "source", "url")


def q_silver_articles(spark, sf):
    return to_silver(bronze_articles(spark, sf), order=("kafka_timestamp", "offset"), with_ingestion=False)


def q_dedup_first(spark, sf):
    ev = table(spark, sf, "events")
    return dedup_first(ev, "user_id", ["ts", "event_id"])


def q_stream_first_arrivals(spark, sf):
    """D1/R3 as a bounded stream over all documents: the first of each text, by the library's own state."""
    use_rocksdb(spark)
    rows = _derive(table_stream(spark, sf, "documents"), FX.arrival_cols())
    out = new_path(spark, "first-arrivals")
    (first_arrivals(rows, "url", ("position",), mode="global", event_time="arrived").drop("arrived").writeStream.format("parquet")
     .option("path", f"{out}/rows").option("checkpointLocation", f"{out}/state").trigger(availableNow=True).start().awaitTermination())
    return spark.read.parquet(f"{out}/rows").where(~F.col("late")).select("url", "position", "source", "lang")


def q_incremental_seen_buckets(spark, sf):
    """The polled listing against a seen table in buckets, written by three earlier runs and compacted once."""
    seen = SeenTable(spark, new_path(spark, "seen"), buckets=16)
    earlier = table(spark, sf, "pages").where("page_id % 3 = 0").select("url", F.expr("page_id % 9 / 3").cast("int").alias("run"))
    for run in range(3):
        seen.add(earlier.where(F.col("run") == run), run)
    seen.compact(1, least=2)
    listing = page_listing(spark, sf).select((F.col("position") * 2).alias("position"), F.col("loc").alias("url"))
    twice = listing.union(listing.select((F.col("position") + 1).alias("position"), "url"))
    return seen.unseen(I.first_listed(twice, "url")).select("position", "url")


def q_message_rejects(spark, sf):
    """Dead letters among well-formed, cut, wrapped, empty and missing messages."""
    msgs = _derive(table(spark, sf, "documents"), FX.raw_message_cols())
    msgs = msgs.select(F.col("value_text").cast("binary").alias("value"), F.lit(FX.AS_OF).cast("timestamp").alias("timestamp"), "offset")
    return message_rejects(msgs).select(F.col("offset").alias("doc_id"), "reason", "value_text")


def q_silver_profile(spark, sf):
    pre = project_silver(valid_articles(bronze_articles(spark, sf)), with_ingestion=False)
    return profile(pre)


def q_silver_latest5(spark, sf):
    ev = table(spark, sf, "events")
    return latest_rows(ev, ["ts", "event_id"], 5, ["event_id", "ts", "event_type", "user_id"])


# ---------------------------------------------------------------- gold

def _gold_table(name):
    """One table on its own: a plain aggregate (the job that writes all four counts them in one pass)."""
    keys, count_col = G.GOLD_TABLES[name]

    def q(spark, sf):
        return G.count_by(events_silver(spark, sf), keys, count_col)
    return q


def q_gold_from_articles(spark, sf):
    """Gold over the real batch pipeline: messages -> decode -> silver -> one pass."""
    silver = to_silver(bronze_articles(spark, sf), with_ingestion=False)
    return G.gold_one_pass(silver)


def q_gold_one_pass(spark, sf):
    return G.gold_one_pass(events_silver(spark, sf))


def q_gold_top_categories(spark, sf):
    return G.top_categories(events_silver(spark, sf))


def q_events_ranked(spark, sf):
    """Every event's place in the order of value, then id."""
    ev = table(spark, sf, "events").select("event_id", "value", "event_type")
    return global_row_number(ev, [F.col("value").asc_nulls_last(), F.col("event_id")], "rang")


def q_gold_top_categories_ranked(spark, sf):
    return G.top_categories(events_silver(spark, sf), with_rank=True)


def q_top_categories_pages(spark, sf):
    """Flagship: top categories of cleaned, de-duplicated articles from pages."""
    p = spread_table(spark, sf, "pages")
    arts = X.extract_articles(p, X.PROFILE_SEG3, source="pages", as_of=FX.AS_OF)
    arts = arts.withColumn("kafka_timestamp", F.lit(None).cast("timestamp")).withColumnRenamed("page_id", "offset")
    silver = to_silver(arts.filter(F.col("error").isNull()), with_ingestion=False)
    return G.top_categories(silver)


# ---------------------------------------------------------------- listings / incremental

def page_listing(spark, sf):
    return _derive(table(spark, sf, "pages"), FX.page_listing_cols())


def q_listing_valid(spark, sf):
    return L.valid_entries(page_listing(spark, sf)).select("position", "loc", "pub_date")


def q_listing_media_filter(spark, sf):
    return L.drop_media(L.valid_entries(page_listing(spark, sf))).select("position", "loc", "pub_date")


def q_listing_newest(spark, sf):
    return L.newest_first(L.valid_entries(page_listing(spark, sf))).select("position", "loc", "pub_date")


def q_listing_first_n(spark, sf):
    return L.first_n(L.valid_entries(page_listing(spark, sf)), 20).select("position", "loc", "pub_date")


def marks(spark):
    """The marks as a local relation."""
    return spark.sql(f"SELECT source, last_date FROM {FX.marks_values_sql()}")


def incremental_listing(spark, sf):
    return _derive(table(spark, sf, "pages"), FX.incremental_listing_cols())


def q_incremental_hwm(spark, sf):
    return L.newer_than(incremental_listing(spark, sf), marks(spark), "timestamp").select(
        "position", "loc", "pub_date", "source")


def q_incremental_hwm_text(spark, sf):
    return L.newer_than(incremental_listing(spark, sf), marks(spark), "string").select(
        "position", "loc", "pub_date", "source")


def q_incremental_unseen(spark, sf):
    docs = table(spark, sf, "documents").select("doc_id", "source", "lang")
    return I.unseen(docs, table(spark, sf, "labels"), "doc_id")


def q_incremental_seen(spark, sf):
    """A polled listing with repeated links against the URLs of earlier runs: each new URL once."""
    listing = page_listing(spark, sf).select((F.col("position") * 2).alias("position"), F.col("loc").alias("url"))
    twice = listing.union(listing.select((F.col("position") + 1).alias("position"), "url"))
    seen = table(spark, sf, "pages").where("page_id % 3 = 0").select("url")
    return I.unseen(twice, seen, "url").select("position", "url")


def _sitemap_xml(spark, sf):
    """One ``<url>`` element of a sitemap for each page, as text."""
    return _derive(table(spark, sf, "pages"), FX.sitemap_cols())


def q_sitemap_entries(spark, sf):
    """Listing fields of ``<url>`` elements by Spark's XML parser."""
    xml = _sitemap_xml(spark, sf).withColumn("e", parse_entry(F.col("xml")))
    return xml.select("page_id", *entry_columns(F.col("e.loc"), F.col("e.news"), F.col("e.lastmod")))


def q_strip_namespace(spark, sf):
    p = _derive(table(spark, sf, "pages"), {"page_id": "page_id", "tag": FX.namespaced_tag()})
    return p.select("page_id", "tag", strip_ns("tag").alias("name"))


def q_run_clock_text(spark, sf):
    """The run clock in both profiles' forms, for clocks with and without a fraction of a second."""
    form = F.when(F.col("event_id") % 2 == 0, F.date_format("ts", "yyyy-MM-dd HH:mm:ss.SSSSSS"))
    ev = table(spark, sf, "events").select("event_id", form.otherwise(F.date_format("ts", "yyyy-MM-dd HH:mm:ss")).alias("clock"))
    return ev.select("event_id", "clock", now_text("yyyy-MM-dd HH:mm:ss", F.col("clock")).alias("plain"),
                     now_text("iso", F.col("clock")).alias("iso"))


def q_bronze_stamped(spark, sf):
    """Bronze rows with the fixed stamp of the run that read them."""
    b = to_bronze(article_messages(spark, sf), ingestion_time=FX.AS_OF)
    return b.select(F.col("offset").alias("doc_id"), "url", F.date_format("ingestion_time", "yyyy-MM-dd HH:mm:ss").alias("ingested"))


def _run(spark, sf):
    return I.run_incremental(incremental_listing(spark, sf), table(spark, sf, "pages"), marks(spark),
                             profile=X.PROFILE_SEG3, as_of=FX.AS_OF)


def q_incremental_summary(spark, sf):
    return _run(spark, sf).summary


def q_incremental_state(spark, sf):
    return _run(spark, sf).state


def q_incremental_failures(spark, sf):
    return _run(spark, sf).failures.select("position", "url", "source", "error")


# ---------------------------------------------------------------- metrics

def q_articles_per_minute(spark, sf):
    return M.per_window_count(table(spark, sf, "events"), "ts", "1 minute", "event_type")


def q_metric_latest(spark, sf):
    cur = M.latest(samples(spark, sf))
    return cur.select("metric", *_series_out(), "ts", "value")


def q_metric_sum(spark, sf):
    return M.sum_latest(samples(spark, sf)).select("metric", F.round("value", 2).alias("value"))


def q_metric_sum_by(spark, sf):
    return M.sum_latest(samples(spark, sf), by=("job",)).select("metric", "job", F.round("value", 2).alias("value"))


def q_metric_sum_selector(spark, sf):
    sel = M.select_series(samples(spark, sf), "events_total", job="click")
    return M.sum_latest(sel).select("metric", F.round("value", 2).alias("value"))


def q_metric_increase(spark, sf):
    inc = M.increase(samples(spark, sf), "5 minutes")
    return inc.select(*_series_out(), "sample_id", "ts", F.round("increase", 2).alias("increase"))


def q_metric_rate(spark, sf):
    r = M.rate(samples(spark, sf), "1 minute")
    return r.select(*_series_out(), "sample_id", "ts", F.round("rate", 6).alias("rate"))


def q_metric_rate_extrapolated(spark, sf):
    r = M.rate(samples(spark, sf), "1 minute", extrapolate=True)
    return r.select(*_series_out(), "sample_id", "ts", F.round("rate", 6).alias("rate"))


def q_metric_increase_grid(spark, sf):
    g = M.increase_at(samples(spark, sf), "5 minutes", "1 minute")
    return g.select(*_series_out(), "eval_ts", F.round("increase", 2).alias("increase"))


def _kept_rollup(spark, sf):
    """The records of one-hour buckets, kept as a table."""
    path = new_path(spark, "rollup")
    R.rollup(samples(spark, sf), "1 hour").write.parquet(path)
    return spark.read.parquet(path)


def q_metric_increase_rollup(spark, sf):
    """``increase(m[2d])`` every 6 hours, from records alone: from those of six hours, merged from those of one."""
    inc = R.increase_from_rollup(R.merge_rollup(_kept_rollup(spark, sf), 6), "48 hours", "6 hours", "6 hours")
    return inc.select(*_series_out(), "eval_ts", F.round("increase", 2).alias("increase"))


def q_metric_increase_rollup_cut(spark, sf):
    """Frames and steps that cut buckets: records, and the samples of the buckets that are cut."""
    inc = R.increase_from_rollup(_kept_rollup(spark, sf), "1507 minutes", "90 minutes", "1 hour", samples(spark, sf))
    return inc.select(*_series_out(), "eval_ts", F.round("increase", 2).alias("increase"))


def q_metric_sum_lookback(spark, sf):
    """An instant query: series silent for longer than the lookback do not count."""
    out = M.sum_latest(samples(spark, sf), by=("job",), at=FX.EVAL_AT, lookback="2 hours")
    return out.select("metric", "job", F.round("value", 2).alias("value"))


def q_metric_rate_grid_extrapolated(spark, sf):
    r = M.rate_at(samples(spark, sf), "1 hour", "10 minutes", bucket="6 hours", extrapolate=True)
    # as gain per hour, whose decimals do not end at the rounding's half
    return r.select(*_series_out(), "eval_ts", F.round(F.col("rate") * 3600, 6).alias("per_hour"))


def q_metric_articles_per_minute(spark, sf):
    """``sum by (job) (rate(counter[1m])) * 60``: what a counter gained in each minute."""
    r = M.sum_rate_at(samples(spark, sf), "1 minute", "1 minute", factor=60.0, by=("job",))
    return r.select("metric", "job", "eval_ts", F.round("value", 2).alias("value"))


def q_metric_cpu_percent(spark, sf):
    r = M.instant_rate_sum(samples(spark, sf), "1 minute", factor=100.0)
    return r.select("metric", "eval_ts", F.round("value", 4).alias("value"))


def q_metric_running_total(spark, sf):
    ev = table(spark, sf, "events")
    batches = (ev.groupBy(F.col("event_type").alias("layer"),
                          M.floor_div(F.unix_micros(F.col("ts").cast("timestamp")), 60_000_000).alias("batch_id"))
               .agg(F.count(F.lit(1)).alias("n")))
    return M.running_total(batches)


def q_metric_ram_gib(spark, sf):
    s = samples(spark, sf).withColumn("value", F.col("value") * F.lit(1e6))
    cur = M.sum_latest(s)
    return cur.select("metric", F.round(scale(F.col("value"), 1.0 / 1073741824), 6).alias("gib"))


def q_metric_status(spark, sf):
    cur = M.latest(samples(spark, sf))
    out = M.with_status(cur, "value", M.STEPS_CPU)
    return out.select("metric", *_series_out(), "value", "status")


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "top_categories_pages": q_top_categories_pages,
    "clean_text": q_clean_text,
    "clean_html": q_clean_html,
    "title_preview": q_title_preview,
    "date_parse": q_date_parse,
    "date_normalize": q_date_normalize,
    "extract_title": q_extract_title,
    "extract_title_captured": q_extract_title_captured,
    "extract_category": q_extract_category,
    "extract_source": q_extract_source,
    "extract_body": q_extract_body,
    "extract_author": q_extract_author,
    "extract_date": q_extract_date,
    "extract_articles": q_extract_articles,
    "extract_author_seg6": q_extract_author_seg6,
    "extract_date_seg6": q_extract_date_seg6,
    "extract_articles_seg6": q_extract_articles_seg6,
    "message_decode": q_message_decode,
    "message_roundtrip": q_message_roundtrip,
    "silver_articles": q_silver_articles,
    "message_rejects": q_message_rejects,
    "dedup_first": q_dedup_first,
    "stream_first_arrivals": q_stream_first_arrivals,
    "silver_profile": q_silver_profile,
    "silver_latest5": q_silver_latest5,
    "gold_par_jour": _gold_table("articles_par_jour"),
    "gold_par_source": _gold_table("articles_par_source"),
    "gold_par_source_jour": _gold_table("articles_par_source_jour"),
    "gold_top_categories": q_gold_top_categories,
    "gold_top_categories_ranked": q_gold_top_categories_ranked,
    "events_ranked": q_events_ranked,
    "gold_one_pass": q_gold_one_pass,
    "gold_from_articles": q_gold_from_articles,
    "listing_valid": q_listing_valid,
    "listing_media_filter": q_listing_media_filter,
    "listing_newest": q_listing_newest,
    "listing_first_n": q_listing_first_n,
    "incremental_hwm": q_incremental_hwm,
    "incremental_hwm_text": q_incremental_hwm_text,
    "incremental_unseen": q_incremental_unseen,
    "incremental_seen": q_incremental_seen,
    "incremental_seen_buckets": q_incremental_seen_buckets,
    "sitemap_entries": q_sitemap_entries,
    "strip_namespace": q_strip_namespace,
    "run_clock_text": q_run_clock_text,
    "bronze_stamped": q_bronze_stamped,
    "incremental_summary": q_incremental_summary,
    "incremental_state": q_incremental_state,
    "incremental_failures": q_incremental_failures,
    "articles_per_minute": q_articles_per_minute,
    "metric_latest": q_metric_latest,
    "metric_sum": q_metric_sum,
    "metric_sum_by": q_metric_sum_by,
    "metric_sum_selector": q_metric_sum_selector,
    "metric_increase": q_metric_increase,
    "metric_rate": q_metric_rate,
    "metric_rate_extrapolated": q_metric_rate_extrapolated,
    "metric_increase_grid": q_metric_increase_grid,
    "metric_increase_rollup": q_metric_increase_rollup,
    "metric_increase_rollup_cut": q_metric_increase_rollup_cut,
    "metric_sum_lookback": q_metric_sum_lookback,
    "metric_rate_grid_extrapolated": q_metric_rate_grid_extrapolated,
    "metric_articles_per_minute": q_metric_articles_per_minute,
    "metric_cpu_percent": q_metric_cpu_percent,
    "metric_running_total": q_metric_running_total,
    "metric_ram_gib": q_metric_ram_gib,
    "metric_status": q_metric_status,
}
