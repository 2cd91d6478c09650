"""Job entry points: gold, ingest with state, verify, listing poll, feeds."""

import datetime as dt
import os

import pytest

from presslake.jobs import run_gold, run_ingest, verify_silver
from presslake.sinks import GoldTarget
from presslake.sources.layers import read_seen, read_state
from presslake.sources.messages import read_messages
from presslake.streaming.feeds import batches_to_samples, start_listing_poll

from tests.test_listing import SITEMAP


def test_run_gold_and_verify(spark, scratch):
    silver = f"{scratch}/silver"
    spark.createDataFrame([
        ("u1", "T1", "A", "world", dt.date(2026, 1, 1), "S1", "x", dt.datetime(2026, 1, 1, 1)),
        ("u2", "", "A", "world", None, "S2", "y", dt.datetime(2026, 1, 1, 2)),
    ], "url string, titre_clean string, auteur_clean string, categorie_clean string, date_parsed date, "
       "source string, contenu_clean string, ingestion_time timestamp").write.parquet(silver)
    tables = run_gold(spark, silver, GoldTarget(kind="parquet", path=f"{scratch}/gold"), "2026-01-01 00:00:00")
    assert set(tables) == {"articles_par_jour", "articles_par_source", "top_categories", "articles_par_source_jour"}
    assert spark.sql("select total from top_categories").first()[0] == 2
    rep = verify_silver(spark, silver)
    assert rep.counts.first().n_rows == 2 and rep.latest.first().source == "S2"
    assert ("date_parsed", "date") in [tuple(r) for r in rep.schema.collect()]


def test_run_ingest_publishes_then_advances(spark, scratch):
    listing = spark.createDataFrame([(1, "https://n/x/a", "2026-05-19T10:00:00Z", "aj"),
                                     (2, "https://n/x/b", "2026-05-19T11:00:00Z", "aj")],
                                    "position long, loc string, pub_date string, source string")
    pages = spark.createDataFrame([(1, "https://n/x/a", "<h1>A</h1><p>a</p>"), (2, "https://n/x/b", "<h1>B</h1>")],
                                  "page_id long, url string, html string")
    msgs, state = f"{scratch}/msgs", f"{scratch}/state"
    run_ingest(spark, listing, pages, msgs, state, "2026-05-19 12:00:00", quarantine_path=f"{scratch}/q")
    assert read_messages(spark, msgs, streaming=False).count() == 2
    assert read_state(spark, state).first().last_date == "2026-05-19T11:00:00Z"
    run_ingest(spark, listing, pages, msgs, state, "2026-05-19 13:00:00", quarantine_path=f"{scratch}/q")   # nothing new: no-op
    assert read_messages(spark, msgs, streaming=False).count() == 2


def test_listing_poll_backfill_then_new(spark, scratch):
    d = f"{scratch}/listings"
    os.makedirs(d)
    with open(f"{d}/a.xml", "w") as f:
        f.write(SITEMAP)
    q = start_listing_poll(spark, d, f"{scratch}/new", f"{scratch}/ck", "s", trigger="available_now")
    q.awaitTermination()
    first = spark.read.parquet(f"{scratch}/new").count()
    with open(f"{d}/b.xml", "w") as f:
        f.write(SITEMAP.replace("https://n.example/e", "https://n.example/zz"))
    q = start_listing_poll(spark, d, f"{scratch}/new", f"{scratch}/ck", "s", trigger="available_now")
    q.awaitTermination()
    assert first == 5 and spark.read.parquet(f"{scratch}/new").count() == 6


def test_batches_to_samples(spark):
    b = spark.createDataFrame([("bronze", 0, dt.datetime(2026, 1, 1, 0, 1), 3), ("bronze", 1, dt.datetime(2026, 1, 1, 0, 2), 2)],
                              "query string, batch_id long, ts timestamp, n long")
    s = batches_to_samples(b).orderBy("ts").collect()
    assert [r.value for r in s] == [3.0, 5.0] and s[0].metric == "news_articles_bronze_total"


def _polled(spark, urls):
    return spark.createDataFrame([(i, u, None, "site") for i, u in enumerate(urls)],
                                 "position long, loc string, pub_date string, source string")


def test_two_polls_take_each_url_once(spark, scratch):
    pages = spark.createDataFrame([(i, f"https://n/x/{u}", f"<h1>{u}</h1>") for i, u in enumerate("abc")],
                                  "page_id long, url string, html string")
    paths = dict(quarantine_path=f"{scratch}/q", seen_path=f"{scratch}/seen", media_filter=True, require_date=False)

    def poll(urls, ts):
        return run_ingest(spark, _polled(spark, [f"https://n/x/{u}" for u in urls]), pages, f"{scratch}/m", None, ts, **paths)
    first = poll(["a", "a", "photo.JPG", "gone", "a"], "2026-01-01 00:00:00")
    assert [r.titre for r in first.articles.collect()] == ["a"]
    assert [r.url for r in spark.read.parquet(f"{scratch}/q").collect()] == ["https://n/x/gone"]
    poll(["a", "b", "gone", "b"], "2026-01-01 00:01:00")
    poll(["a", "b", "gone"], "2026-01-01 00:02:00")
    assert read_messages(spark, f"{scratch}/m", streaming=False).count() == 2
    # the failed one counts as seen: it is quarantined once
    assert spark.read.parquet(f"{scratch}/q").count() == 1
    assert sorted(r.url for r in read_seen(spark, f"{scratch}/seen").collect()) == [f"https://n/x/{u}" for u in ("a", "b", "gone")]


def test_a_run_in_which_all_fails_is_quarantined(spark, scratch):
    pages = spark.createDataFrame([], "page_id long, url string, html string")
    listing = spark.createDataFrame([(1, "https://n/x/a", "2026-05-19T10:00:00Z", "s")],
                                    "position long, loc string, pub_date string, source string")
    res = run_ingest(spark, listing, pages, f"{scratch}/m", f"{scratch}/st", "2026-05-19 12:00:00", quarantine_path=f"{scratch}/q")
    assert res.articles.count() == 0 and spark.read.parquet(f"{scratch}/q").first().url == "https://n/x/a"
    assert not os.path.exists(f"{scratch}/m") and not os.path.exists(f"{scratch}/st")


def test_captures_need_an_order(spark):
    import pytest

    from presslake.operators.incremental import run_incremental
    listing = _polled(spark, ["https://n/x/a"])
    pages = spark.createDataFrame([("https://n/x/a", "<h1>A</h1>")], "url string, html string")
    with pytest.raises(ValueError):
        run_incremental(listing, pages, require_date=False)
    null_id = spark.createDataFrame([(None, "https://n/x/a", "<h1>old</h1>"), (5, "https://n/x/a", "<h1>new</h1>"),
                                     (None, "https://n/x/b", "<h1>only</h1>")], "page_id long, url string, html string")
    both = run_incremental(_polled(spark, ["https://n/x/a", "https://n/x/b"]), null_id, require_date=False)
    assert sorted(r.titre for r in both.articles.collect()) == ["new", "only"]


def _crash_run(spark, scratch, ts="2026-05-19 12:00:00"):
    listing = spark.createDataFrame([(i, f"https://n/x/{u}", f"2026-05-19T1{i}:00:00Z", "aj") for i, u in enumerate("abc")],
                                    "position long, loc string, pub_date string, source string")
    pages = spark.createDataFrame([(i, f"https://n/x/{u}", f"<h1>{u}</h1><p>t</p>") for i, u in enumerate("ab")], "page_id long, url string, html string")
    return run_ingest(spark, listing, pages, f"{scratch}/m", f"{scratch}/st", ts, quarantine_path=f"{scratch}/q", seen_path=f"{scratch}/seen")


def _one_copy(spark, scratch):
    assert read_messages(spark, f"{scratch}/m", streaming=False).count() == 2
    assert [r.url for r in spark.read.parquet(f"{scratch}/q").collect()] == ["https://n/x/c"]
    assert sorted(r.url[-1] for r in read_seen(spark, f"{scratch}/seen").collect()) == ["a", "b", "c"]
    assert [tuple(r) for r in read_state(spark, f"{scratch}/st").collect()] == [("aj", "2026-05-19T11:00:00Z")]


CRASHES = [("stage", n) for n in range(1, 5)] + [("write_text", 1)] + [("publish", n) for n in range(1, 5)] + [("add", 1), ("delete", 1)]


@pytest.mark.parametrize("step, nth", CRASHES)
def test_a_crash_in_an_ingest_leaves_one_copy_after_the_rerun(spark, scratch, monkeypatch, step, nth):
    from presslake.jobs import Ingest
    from presslake.sinks.files import Files
    from presslake.sinks.seen import SeenTable
    owner = {"stage": Ingest, "add": SeenTable}.get(step, Files)
    real, calls = getattr(owner, step), []

    def dies(self, *args, **kw):
        calls.append(1)
        if step == "stage":           # the write itself is done
            real(self, *args, **kw)
        if len(calls) == nth:
            raise RuntimeError("killed")
        if step != "stage":
            return real(self, *args, **kw)
    monkeypatch.setattr(owner, step, dies)
    with pytest.raises(RuntimeError):
        _crash_run(spark, scratch)
    monkeypatch.undo()
    if step in ("stage", "write_text"):   # not committed: readers see nothing of it
        assert not os.path.exists(f"{scratch}/m/run=20260519120000") and read_seen(spark, f"{scratch}/seen").count() == 0
    _crash_run(spark, scratch)
    _one_copy(spark, scratch)
    assert _crash_run(spark, scratch) is None        # and once more: committed
    _crash_run(spark, scratch, "2026-05-19 13:00:00")  # the next run finds nothing new
    _one_copy(spark, scratch)


def test_messages_of_committed_runs_reach_bronze_once(spark, scratch):
    from presslake.streaming import run_available_now
    _crash_run(spark, scratch)
    for _ in range(2):
        run_available_now(spark, read_messages(spark, f"{scratch}/m"), f"{scratch}/b", f"{scratch}/s", f"{scratch}/ck", counts_path=f"{scratch}/c")
    assert spark.read.parquet(f"{scratch}/s").count() == 2
