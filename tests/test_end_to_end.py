"""The whole pipeline on captured pages: ingest -> messages -> bronze/silver
(streaming) -> gold -> verify, then a second increment."""

from pyspark.sql import functions as F

from presslake.jobs import run_gold, run_ingest, run_streaming_once, verify_silver
from presslake.sinks import GoldTarget
from presslake.sources.messages import read_messages
from presslake.sources.tables import table

SF = "/root/testdata/sf0.001"


def test_pages_to_gold(spark, scratch):
    pages = table(spark, SF, "pages")
    listing = pages.select(F.col("page_id").alias("position"), F.col("url").alias("loc"),
                           F.concat(F.lit("2024-01-"), F.lpad(((F.col("page_id") % 28) + 1).cast("string"), 2, "0"),
                                    F.lit("T10:00:00Z")).alias("pub_date"),
                           F.lit("site").alias("source"))
    first = listing.filter(F.col("position") < 10)
    msgs, state = f"{scratch}/msgs", f"{scratch}/state"
    res = run_ingest(spark, first, pages, msgs, state, "2026-01-01 00:00:00", source="site",
                     quarantine_path=f"{scratch}/quarantine")
    n1 = res.articles.count()
    assert n1 == 10
    root = f"{scratch}/lake"
    run_streaming_once(spark, read_messages(spark, msgs), f"{root}/bronze", f"{root}/silver", f"{root}/ck")
    assert spark.read.parquet(f"{root}/silver").count() == 10
    # second increment: everything newer than the mark
    run_ingest(spark, listing, pages, msgs, state, "2026-01-02 00:00:00", source="site",
               quarantine_path=f"{scratch}/quarantine")
    run_streaming_once(spark, read_messages(spark, msgs), f"{root}/bronze", f"{root}/silver", f"{root}/ck")
    silver = spark.read.parquet(f"{root}/silver")
    newest_first_run = first.agg(F.max("pub_date")).first()[0]
    expected = 10 + listing.filter(F.col("pub_date") > newest_first_run).count()
    assert silver.count() == expected
    assert silver.select("url").distinct().count() == expected
    tables = run_gold(spark, f"{root}/silver", GoldTarget(kind="parquet", path=f"{root}/gold"), "2026-01-02 00:00:00")
    assert spark.read.parquet(f"{root}/gold/articles_par_source").first().nombre_articles == expected
    assert sum(r.total for r in tables["top_categories"].collect()) == expected
    rep = verify_silver(spark, f"{root}/silver")
    assert rep.counts.first().n_duplicate_key == 0


def test_sitemap_xml_to_ingest(spark, scratch):
    import os
    from xml.sax.saxutils import escape

    from presslake.sources.layers import read_state
    from presslake.sources.sitemap import read_sitemap

    pages = table(spark, SF, "pages")
    urls = [r.url for r in pages.select("url").orderBy("page_id").limit(12).collect()]
    entries = "".join(
        f"<url><loc>{escape(u)}</loc><news:news><news:publication_date>2026-05-{10 + i:02d}T10:00:00+00:00"
        f"</news:publication_date></news:news></url>" for i, u in enumerate(urls))
    xml = ('<?xml version="1.0"?><urlset xmlns="http://www.sitemaps.org/schemas/sitemap/0.9" '
           f'xmlns:news="http://www.google.com/schemas/sitemap-news/0.9">{entries}'
           '<url><loc>https://never.captured/x</loc><lastmod>2026-05-30T00:00:00Z</lastmod></url></urlset>')
    os.makedirs(f"{scratch}/sitemaps")
    with open(f"{scratch}/sitemaps/news.xml", "w") as f:
        f.write(xml)
    listing = read_sitemap(spark, f"{scratch}/sitemaps", source="site")
    res = run_ingest(spark, listing, pages, f"{scratch}/msgs", f"{scratch}/state", "2026-06-01 00:00:00",
                     source="site", quarantine_path=f"{scratch}/quarantine")
    assert res.articles.count() == 12
    assert spark.read.parquet(f"{scratch}/quarantine").first().url == "https://never.captured/x"
    # the mark is the newest successful item, not the uncaptured newer one
    assert read_state(spark, f"{scratch}/state").first().last_date == "2026-05-21T10:00:00+00:00"
