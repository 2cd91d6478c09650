"""Hot keys: one key holding a third of all rows never travels whole."""

from pyspark.sql import functions as F

from presslake.operators.silver import dedup_first


def _shuffle_records(df):
    """Records written by the first shuffle of the executed (final) plan."""
    df.write.format("noop").mode("overwrite").save()
    plan = df._jdf.queryExecution().executedPlan()
    found = []

    def walk(node):
        name = node.nodeName()
        if "Exchange" in name and not found:
            m = node.metrics()
            if m.contains("shuffleRecordsWritten"):
                found.append(m.apply("shuffleRecordsWritten").value())
        it = node.children().iterator()
        while it.hasNext():
            walk(it.next())
        if name in ("AdaptiveSparkPlan",):
            walk(node.executedPlan())
        if name.startswith("ShuffleQueryStage") or name.startswith("ResultQueryStage"):
            walk(node.plan())

    walk(plan)
    return found[0] if found else None


def test_hot_url_is_collapsed_before_the_shuffle(spark):
    n, parts = 30_000, 8
    df = (spark.range(n).repartition(parts)
          .select(F.when(F.col("id") % 3 == 0, F.lit("hot")).otherwise(F.concat(F.lit("u"), F.col("id").cast("string")))
                  .alias("url"), F.col("id").alias("offset"), F.lit("x").alias("titre")))
    out = dedup_first(df, "url", ["offset"])
    written = _shuffle_records(out)
    distinct_urls = n - n // 3 + 1
    # every non-hot url once, the hot url at most once per map partition
    assert written is not None and written <= distinct_urls - 1 + parts
    assert out.filter("url = 'hot'").first().offset == 0


def test_gold_shuffles_partial_counts_not_rows(spark):
    from presslake.operators.gold import gold_one_pass

    n, parts = 40_000, 8
    silver = (spark.range(n).repartition(parts)
              .select(F.when(F.col("id") % 3 == 0, F.lit("2026-01-01")).otherwise(F.lit("2026-01-02"))
                      .cast("date").alias("date_parsed"),
                      F.when(F.col("id") % 3 == 0, F.lit("hot")).otherwise(F.lit("cold")).alias("source"),
                      (F.col("id") % 5).cast("string").alias("categorie_clean")))
    written = _shuffle_records(gold_one_pass(silver))
    groups = 2 + 2 + 5 + 2          # day, source, category, source x day
    assert written is not None and written <= groups * parts
