"""Plan shape: pruning, pushdown, no Python in the hot path, shuffle counts."""

import re

import __spark_entry__ as E

SF = "/root/testdata/sf0.01"


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_silver_has_no_python_evaluation(spark):
    p = _plan(E.queries()["silver_articles"](spark, SF))
    assert "BatchEvalPython" not in p and "ArrowEvalPython" not in p


def test_gold_reads_only_grouping_columns(spark):
    p = _plan(E.queries()["gold_one_pass"](spark, SF))
    assert p.count("FileScan parquet") == 1
    assert "ReadSchema: struct<ts:timestamp_ntz,user_id:bigint,event_type:string>" in p


def test_category_query_does_not_read_html(spark):
    p = _plan(E.queries()["extract_category"](spark, SF))
    assert "html" not in p.split("ReadSchema:")[1].split("\n")[0]


def test_listing_filter_reaches_the_scan(spark):
    from pyspark.sql import functions as F
    from presslake.sources.tables import table
    df = table(spark, SF, "events").filter(F.col("ts") > F.lit("2024-01-15").cast("timestamp_ntz")).select("event_id")
    p = _plan(df)
    assert "PushedFilters: [IsNotNull(ts), GreaterThan(ts," in p


def test_dedup_is_aggregate_not_window(spark):
    p = _plan(E.queries()["dedup_first"](spark, SF))
    assert "Window" not in p


def _assert_windows_are_bucketed(plan):
    """Each window's partition list (the last but one of its arguments) holds the bucket; only the
    windows over bucket summaries, one row a bucket, run over a series, ordered by the bucket."""
    lists = re.findall(r"Window \[.*\], \[([^\[\]]*)\], \[([^\[\]]*)\]", plan)
    assert lists
    for keys, order in lists:
        assert "_b#" in keys or order.startswith("_b#"), (keys, order)


def test_metric_windows_are_bucketed(spark):
    p = _plan(E.queries()["metric_increase"](spark, SF))
    _assert_windows_are_bucketed(p)


def test_extraction_has_no_python_and_no_shuffle(spark):
    for name in [q for q in E.queries() if q.startswith("extract_")]:
        p = _plan(E.queries()[name](spark, SF))
        assert not re.search(r"EvalPython|MapIn|Exchange", p), name
        assert len(p) < 140_000, (name, len(p))


def test_title_only_consumer_prunes_author_body_and_python(spark):
    p = _plan(E.queries()["top_categories_pages"](spark, SF))
    assert "ArrowEvalPython" not in p            # no container / byline balancing needed
    assert "_r_body" not in p and "ld+json" not in p


def test_single_gold_tables_do_not_expand(spark):
    for name in ("gold_par_jour", "gold_par_source", "gold_par_source_jour"):
        assert "Expand" not in _plan(E.queries()[name](spark, SF))


def test_no_job_runs_while_a_query_is_built(spark):
    seen = spark.sparkContext.statusTracker()
    spark.sparkContext.setJobGroup("build-only", "plans are built, nothing runs")
    try:
        for name in ("incremental_summary", "incremental_unseen", "incremental_hwm", "silver_articles", "extract_articles"):
            E.queries()[name](spark, SF)
        # reading a Parquet footer for the schema is the only job a build may start
        stages = [s for j in seen.getJobIdsForGroup("build-only") for s in seen.getJobInfo(j).stageIds]
        assert all(seen.getStageInfo(s) is None or seen.getStageInfo(s).numTasks <= 1 for s in stages)
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
