"""Page captures: row groups of bounded bytes, splits, pruning by host and url."""

import glob

import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

import __spark_entry__ as E
from presslake.operators import extract as X
from presslake.sinks import write_pages
from presslake.sources import read_pages

SF = "/root/testdata/sf0.01"
SCHEMA = "page_id long, url string, html string"


def _groups(path):
    return [pq.ParquetFile(f).metadata.row_group(i) for f in sorted(glob.glob(f"{path}/*.parquet"))
            for i in range(pq.ParquetFile(f).metadata.num_row_groups)]


def _rows_read(df):
    """Rows that the scan of the executed plan gave."""
    df.write.format("noop").mode("overwrite").save()
    nodes, out = [df._jdf.queryExecution().executedPlan()], None
    while nodes:
        node = nodes.pop()
        if "Scan" in node.nodeName():
            out = node.metrics().apply("numOutputRows").value()
        it = node.children().iterator()
        while it.hasNext():
            nodes.append(it.next())
        if node.nodeName() == "AdaptiveSparkPlan":
            nodes.append(node.executedPlan())
    return out


@pytest.fixture()
def capture(spark, scratch):
    pages = spark.read.parquet(f"{SF}/pages.parquet")
    write_pages(pages, f"{scratch}/capture", files=1, group_bytes=64 << 10)
    return f"{scratch}/capture"


def test_nothing_is_lost_and_groups_are_bounded(spark, capture):
    pages = spark.read.parquet(f"{SF}/pages.parquet").select("page_id", "url", "html")
    back = read_pages(spark, capture)
    assert sorted(map(tuple, back.collect())) == sorted(map(tuple, pages.collect()))
    widest = pages.agg(F.max(F.octet_length("html"))).first()[0]
    groups = _groups(capture)
    assert len(groups) > 4
    assert all(g.total_byte_size <= (64 << 10) + 9 * (widest + 1000) for g in groups)


def test_one_file_splits_into_tasks(spark, capture):
    set_to = {"spark.sql.files.maxPartitionBytes": "65536", "spark.sql.files.openCostInBytes": "0"}
    try:
        for k, v in set_to.items():
            spark.conf.set(k, v)
        arts = X.extract_articles(read_pages(spark, capture), X.PROFILE_SEG3, as_of="2026-01-01 00:00:00")
        parts = arts.groupBy(F.spark_partition_id()).count().collect()
        flat = spark.read.parquet(f"{SF}/pages.parquet").select("html")
        whole = flat.groupBy(F.spark_partition_id()).count().collect()
    finally:
        for k in set_to:
            spark.conf.unset(k)
    assert len(parts) >= spark.sparkContext.defaultParallelism    # as many tasks as cores and more
    assert len(whole) == 1                                        # one row group is one task


def test_host_and_url_filters_skip_row_groups(spark, capture):
    total = read_pages(spark, capture).count()
    host, url = spark.read.parquet(capture).orderBy("host", "url").select("host", "url").first()
    by_host = read_pages(spark, capture, hosts=[host])
    plan = by_host._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters: [IsNotNull(host), EqualTo(host," in plan or "In(host" in plan
    want = {r.page_id for r in spark.read.parquet(capture).where(F.col("host") == host).select("page_id").collect()}
    assert {r.page_id for r in by_host.collect()} == want and len(want) < total
    assert _rows_read(by_host) < total
    by_url = read_pages(spark, capture).where(F.col("url") == url)
    assert "EqualTo(url," in by_url._jdf.queryExecution().executedPlan().toString()
    assert _rows_read(by_url) < total / 2
    assert read_pages(spark, capture, hosts=[]).count() == 0


def test_hot_host_and_equal_rows_are_spread(spark, scratch):
    rows = spark.range(4000).select(F.lit(7).cast("long").alias("page_id"), F.lit("http://hot.example/a").alias("url"),
                                    F.lit("<p>x</p>").alias("html"))
    write_pages(rows, f"{scratch}/hot", files=4)
    sizes = [pq.ParquetFile(f).metadata.num_rows for f in glob.glob(f"{scratch}/hot/*.parquet")]
    assert sum(sizes) == 4000 and max(sizes) < 2000


def test_nulls_no_rows_and_other_columns(spark, scratch):
    rows = spark.createDataFrame([(None, None, None, "a"), (1, "no host", "", None), (1, "http://h/x", "<p>é</p>", "b"),
                                  (1, "http://h/x", "<p>é</p>", "b")], SCHEMA + ", captured string")
    write_pages(rows, f"{scratch}/odd", files=2)
    back = spark.read.parquet(f"{scratch}/odd")
    assert back.columns == ["page_id", "url", "html", "captured", "host"]
    key = lambda r: tuple(str(x) for x in r)
    assert sorted(map(tuple, back.drop("host").collect()), key=key) == sorted(map(tuple, rows.collect()), key=key)
    write_pages(spark.createDataFrame([], SCHEMA), f"{scratch}/none")
    assert read_pages(spark, f"{scratch}/none").count() == 0
    with pytest.raises(ValueError, match="own column"):
        write_pages(rows.withColumn("Host", F.lit(1)), f"{scratch}/clash")


def test_partitions_spread_a_single_group(spark):
    spread = read_pages(spark, f"{SF}/pages.parquet", partitions=6)
    assert spread.groupBy(F.spark_partition_id()).count().count() == 6
    assert spread.count() == spark.read.parquet(f"{SF}/pages.parquet").count()


def test_scan_setting_spreads_and_changes_no_row(spark):
    plain = sorted(map(tuple, E.queries()["extract_title"](spark, SF).collect()))
    spark.conf.set("spark.presslake.scan.partitions", "4")
    try:
        df = E.queries()["extract_title"](spark, SF)
        assert "RoundRobinPartitioning(4)" in df._jdf.queryExecution().executedPlan().toString()
        assert sorted(map(tuple, df.collect())) == plain
    finally:
        spark.conf.unset("spark.presslake.scan.partitions")
