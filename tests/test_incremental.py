"""U5 incremental run: mark, anti join, failures, state (FIXTURES section 3, Increment)."""

from presslake.operators.extract import PROFILE_SEG3
from presslake.operators.incremental import run_incremental, unseen

AS_OF = "2026-01-01 00:00:00"


def _inputs(spark):
    listing = spark.createDataFrame([
        (1, "https://n/x/a", "2026-05-19T15:43:28+00:00", "aj"),   # equal to the mark: skipped
        (2, "https://n/x/b", "2026-05-19T23:43:28-04:00", "aj"),   # newest, captured
        (3, "https://n/x/c", "2026-05-20T05:00:00+00:00", "aj"),   # newest by instant, NOT captured
        (4, "https://n/x/d", "2026-05-19T16:00:00+00:00", "aj"),   # captured
        (5, "https://n/x/e", "2026-05-19T17:00:00+00:00", "aj"),   # older, NOT captured
    ], "position long, loc string, pub_date string, source string")
    pages = spark.createDataFrame([
        (10, "https://n/x/a", "<h1>A</h1><p>a</p>"),
        (11, "https://n/x/b", "<h1>B</h1><p>b</p>"),
        (12, "https://n/x/d", "<h1>D</h1><p>d</p>"),
    ], "page_id long, url string, html string")
    state = spark.createDataFrame([("aj", "2026-05-19T15:43:28+00:00")], "source string, last_date string")
    return listing, pages, state


def test_run_incremental(spark):
    listing, pages, state = _inputs(spark)
    res = run_incremental(listing, pages, state, profile=PROFILE_SEG3, as_of=AS_OF)
    assert sorted(r.titre for r in res.articles.collect()) == ["B", "D"]
    assert sorted(r.position for r in res.failures.collect()) == [3, 5]
    s = res.summary.first()
    assert (s.source, s.n_new, s.newest_date) == ("aj", 2, "2026-05-19T23:43:28-04:00")
    # the mark advances to the newest *successful* item; failures stay retryable
    assert res.state.first().last_date == "2026-05-19T23:43:28-04:00"


def test_empty_run_keeps_mark(spark):
    listing, pages, _ = _inputs(spark)
    state = spark.createDataFrame([("aj", "2027-01-01T00:00:00Z")], "source string, last_date string")
    res = run_incremental(listing, pages, state, profile=PROFILE_SEG3, as_of=AS_OF)
    assert res.articles.count() == 0 and res.summary.count() == 0
    assert [tuple(r) for r in res.state.collect()] == [("aj", "2027-01-01T00:00:00Z")]


def test_seen_set(spark):
    listing, pages, _ = _inputs(spark)
    seen = spark.createDataFrame([("https://n/x/a",), ("https://n/x/a",), ("https://n/x/b",)], "url string")
    res = run_incremental(listing, pages, None, seen=seen, profile=PROFILE_SEG3, source="polled", as_of=AS_OF)
    assert sorted(r.url for r in res.articles.collect()) == ["https://n/x/d"]
    assert all(r.source == "polled" for r in res.articles.collect())
    cands = spark.createDataFrame([("u1",), ("u2",), (None,)], "url string")
    assert sorted(str(r.url) for r in unseen(cands, spark.createDataFrame([("u1",)], "url string")).collect()) == ["None", "u2"]


def test_retry_quarantine(spark):
    from presslake.operators.incremental import retry_quarantine

    listing, pages, state = _inputs(spark)
    res = run_incremental(listing, pages, state, profile=PROFILE_SEG3, as_of=AS_OF)
    failures = res.failures.select("position", "url", "pub_date", "source")
    # the older failure is below the new mark: a plain rerun would skip it
    again = run_incremental(listing, pages, res.state, profile=PROFILE_SEG3, as_of=AS_OF)
    assert sorted(r.position for r in again.failures.collect()) == [3]
    # later the page of item 5 gets captured; the quarantine retry picks it up
    pages2 = pages.union(spark.createDataFrame([(13, "https://n/x/e", "<h1>E</h1>")], pages.schema))
    retried = retry_quarantine(failures, pages2, PROFILE_SEG3, as_of=AS_OF)
    assert [r.titre for r in retried.articles.collect()] == ["E"]
    assert [r.position for r in retried.failures.collect()] == [3]


def test_latest_capture_wins(spark):
    listing, pages, state = _inputs(spark)
    recaptured = pages.union(spark.createDataFrame([(20, "https://n/x/b", "<h1>B v2</h1><p>b</p>")], pages.schema))
    res = run_incremental(listing, recaptured, state, profile=PROFILE_SEG3, as_of=AS_OF)
    assert sorted(r.titre for r in res.articles.collect()) == ["B v2", "D"]
