"""Streaming bronze/silver with a file message source."""

import datetime as dt
import json
import os

from pyspark.sql import functions as F

from presslake.operators.messages import to_bronze
from presslake.operators.silver import to_silver
from presslake.schemas import MESSAGE_SCHEMA
from presslake.sources.messages import read_messages
from presslake.streaming import bronze_stream, dedup_stream, run_available_now, start_bronze, start_silver

T0 = dt.datetime(2026, 5, 19, 12, 0, 0)


def _article(i, url, titre="T"):
    d = {"url": url, "source": "S", "categorie": "<b>World</b>", "contenu": f"body {i} <p>x</p>",
         "date_publication": "2026-05-19T23:43:28-04:00", "auteur": "A"}
    if titre is not None:
        d["titre"] = titre
    return json.dumps(d)


def _write_batch(spark, folder, payloads, start):
    rows = [(None if p is None else bytearray(p.encode()), T0 + dt.timedelta(seconds=start + i), start + i)
            for i, p in enumerate(payloads)]
    spark.createDataFrame(rows, MESSAGE_SCHEMA).coalesce(1).write.mode("append").parquet(folder)


def test_bronze_silver_available_now_and_restart(spark, scratch):
    msgs = f"{scratch}/msgs"
    _write_batch(spark, msgs, [_article(0, "u1"), _article(1, "u2"), _article(2, "u1"), "not json",
                               _article(4, "u3", titre=None)], 0)
    bronze, silver, ck = f"{scratch}/bronze", f"{scratch}/silver", f"{scratch}/ck"
    qb, qs = run_available_now(spark, read_messages(spark, msgs), bronze, silver, ck)
    b = spark.read.schema(bronze_stream(spark, bronze).schema).json(bronze)
    assert b.count() == 5                                  # bronze keeps malformed and duplicate rows
    s = spark.read.parquet(silver)
    assert sorted(r.url for r in s.collect()) == ["u1", "u2"]
    row = s.filter("url = 'u2'").first()
    assert row.categorie_clean == "World" and row.date_parsed == dt.date(2026, 5, 20)
    # batch silver over the same messages gives the same rows
    batch = to_silver(to_bronze(read_messages(spark, msgs, streaming=False)), with_ingestion=False)
    assert sorted(r.url for r in batch.collect()) == ["u1", "u2"]
    # restart: nothing new -> nothing added; new file -> only new unseen urls
    run_available_now(spark, read_messages(spark, msgs), bronze, silver, ck)
    assert spark.read.parquet(silver).count() == 2
    _write_batch(spark, msgs, [_article(10, "u1"), _article(11, "u9")], 100)
    qb2, qs2 = run_available_now(spark, read_messages(spark, msgs), bronze, silver, ck)
    assert sorted(r.url for r in spark.read.parquet(silver).collect()) == ["u1", "u2", "u9"]


def test_dedup_modes_and_late_rows(spark, scratch):
    src = f"{scratch}/events"
    schema = "url string, ts timestamp"

    def write(rows, name):
        spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(f"{src}")

    write([("a", T0), ("b", T0)], "1")

    def run(mode):
        sdf = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(src)
        d = dedup_stream(sdf, "url", mode, "10 minutes", "ts")
        q = (d.writeStream.format("parquet").option("path", f"{scratch}/out_{mode}")
             .option("checkpointLocation", f"{scratch}/ck_{mode}").trigger(availableNow=True).start())
        q.awaitTermination()
        return sorted(r.url for r in spark.read.parquet(f"{scratch}/out_{mode}").collect())

    assert run("global") == ["a", "b"] and run("bounded") == ["a", "b"]
    # next files: 'c' two hours later moves the watermark past the delay (state
    # of 'a' is evicted at the end of that batch); then 'a' again; then a row
    # behind the watermark
    write([("c", T0 + dt.timedelta(hours=2))], "2")
    write([("d", T0 + dt.timedelta(hours=2))], "2b")
    write([("a", T0 + dt.timedelta(hours=2, seconds=1))], "3")
    write([("late", T0 - dt.timedelta(hours=1))], "4")
    assert run("global") == ["a", "b", "c", "d"]            # 'a' never again; late row dropped
    assert run("bounded") == ["a", "a", "b", "c", "d"]      # 'a' admitted again after the delay
    assert F is not None and os.path.isdir(src)


def test_start_bronze_processing_time_trigger_and_stop(spark, scratch):
    msgs = f"{scratch}/m"
    _write_batch(spark, msgs, [_article(0, "u1")], 0)
    q = start_bronze(read_messages(spark, msgs), f"{scratch}/b", f"{scratch}/ckb", trigger="1 second")
    q.processAllAvailable()
    q.stop()
    assert spark.read.json(f"{scratch}/b").count() == 1
    qs = start_silver(bronze_stream(spark, f"{scratch}/b"), f"{scratch}/s", f"{scratch}/cks",
                      trigger="available_now", partition_by="date_parsed")
    qs.awaitTermination()
    assert os.path.isdir(f"{scratch}/s/date_parsed=2026-05-20")


def test_counts_of_150_micro_batches_are_all_kept(spark, scratch):
    from presslake.streaming.epochs import read_counts
    from presslake.streaming.feeds import batches_to_samples

    src, n = f"{scratch}/many", 150
    os.makedirs(src)
    for i in range(n):
        with open(f"{src}/{i:03d}.json", "w") as f:
            f.write("".join(json.dumps({"value": "e30=", "timestamp": "2026-05-19T12:00:00Z", "offset": k}) + "\n" for k in range(i % 3)))
    total = sum(i % 3 for i in range(n))
    sdf = spark.readStream.schema(MESSAGE_SCHEMA).option("maxFilesPerTrigger", 1).json(src)
    start_bronze(sdf, f"{scratch}/b", f"{scratch}/ck", "available_now", counts_path=f"{scratch}/counts").awaitTermination()
    every = read_counts(spark, f"{scratch}/counts", non_empty=False)
    assert every.count() == n == every.select("query", "batch_id").distinct().count()
    counts = read_counts(spark, f"{scratch}/counts")
    assert counts.count() == 100 and counts.agg(F.sum("n")).first()[0] == total == spark.read.json(f"{scratch}/b").count()
    assert batches_to_samples(counts).agg(F.max("value")).first()[0] == total


def test_gold_stream_complete_mode(spark, scratch):
    from presslake.sinks import GoldTarget
    from presslake.streaming import start_gold_stream

    silver_dir = f"{scratch}/silver_in"
    schema = "url string, date_parsed date, source string, categorie_clean string"
    spark.createDataFrame([("u1", dt.date(2026, 1, 1), "S1", "a"), ("u2", dt.date(2026, 1, 2), "S2", "a")],
                          schema).write.parquet(silver_dir)
    target = GoldTarget(kind="parquet", path=f"{scratch}/gold")
    sdf = spark.readStream.schema(schema).parquet(silver_dir)
    start_gold_stream(sdf, target, f"{scratch}/gck", trigger="available_now").awaitTermination()
    spark.createDataFrame([("u3", None, "S1", "b")], schema).write.mode("append").parquet(silver_dir)
    start_gold_stream(spark.readStream.schema(schema).parquet(silver_dir), target, f"{scratch}/gck",
                      trigger="available_now").awaitTermination()
    top = {r.categorie_clean: r.total for r in spark.read.parquet(f"{scratch}/gold/top_categories").collect()}
    src = {r.source: r.nombre_articles for r in spark.read.parquet(f"{scratch}/gold/articles_par_source").collect()}
    assert top == {"a": 2, "b": 1} and src == {"S1": 2, "S2": 1}


def test_table_dedup_across_batches_with_hot_key(spark, scratch):
    from presslake.streaming import start_silver_table_dedup

    msgs, bronze, ck = f"{scratch}/tm", f"{scratch}/tb", f"{scratch}/tck"
    # one hot url holds most rows of the first batch
    _write_batch(spark, msgs, [_article(i, "hot") for i in range(30)] + [_article(99, "u1")], 0)
    run_available_now(spark, read_messages(spark, msgs), bronze, f"{scratch}/unused_silver", ck)

    def run():
        q = start_silver_table_dedup(bronze_stream(spark, bronze), f"{scratch}/ts", f"{scratch}/seen",
                                     f"{scratch}/tsck", trigger="available_now")
        q.awaitTermination()
        return sorted(r.url for r in spark.read.parquet(f"{scratch}/ts").collect())

    assert run() == ["hot", "u1"]
    first = spark.read.parquet(f"{scratch}/ts").filter("url = 'hot'").first()
    assert first.contenu_clean == "body 0 x"                       # first arrival won
    _write_batch(spark, msgs, [_article(100, "hot"), _article(101, "u2")], 200)
    run_available_now(spark, read_messages(spark, msgs), bronze, f"{scratch}/unused_silver", ck)
    assert run() == ["hot", "u1", "u2"]                            # hot not admitted twice


def _table_dedup(spark, scratch, bronze):
    from presslake.streaming import start_silver_table_dedup
    q = start_silver_table_dedup(bronze_stream(spark, bronze), f"{scratch}/ts", f"{scratch}/seen", f"{scratch}/tsck",
                                 trigger="available_now")
    q.awaitTermination()
    return sorted(r.url for r in spark.read.parquet(f"{scratch}/ts").collect())


def _to_bronze(spark, folder, payloads, name):
    os.makedirs(folder, exist_ok=True)
    with open(f"{folder}/{name}.json", "w") as f:
        f.write("".join(p + "\n" for p in payloads))


def test_table_dedup_survives_batches_that_admit_nothing(spark, scratch):
    bronze = f"{scratch}/b"
    _to_bronze(spark, bronze, [_article(1, "u1"), _article(2, "u2")], "a")
    assert _table_dedup(spark, scratch, bronze) == ["u1", "u2"]
    _to_bronze(spark, bronze, [_article(3, "u1"), _article(4, "u2")], "b")           # only known urls
    assert _table_dedup(spark, scratch, bronze) == ["u1", "u2"]
    _to_bronze(spark, bronze, [_article(5, "u3", titre=None), "{}"], "c")            # only invalid rows
    assert _table_dedup(spark, scratch, bronze) == ["u1", "u2"]
    _to_bronze(spark, bronze, [_article(6, "u2"), _article(7, "u4")], "d")
    assert _table_dedup(spark, scratch, bronze) == ["u1", "u2", "u4"]


def test_table_dedup_first_batch_may_admit_nothing(spark, scratch):
    bronze = f"{scratch}/b"
    _to_bronze(spark, bronze, ["{}"], "a")
    _to_bronze(spark, bronze, ["{}"], "b")
    from presslake.streaming import start_silver_table_dedup
    start_silver_table_dedup(bronze_stream(spark, bronze), f"{scratch}/ts", f"{scratch}/seen", f"{scratch}/tsck",
                             trigger="available_now").awaitTermination()
    _to_bronze(spark, bronze, [_article(1, "u1")], "c")
    assert _table_dedup(spark, scratch, bronze) == ["u1"]


def test_table_dedup_replayed_epoch_writes_the_same_rows(spark, scratch):
    bronze = f"{scratch}/b"
    _to_bronze(spark, bronze, [_article(1, "u1")], "a")
    assert _table_dedup(spark, scratch, bronze) == ["u1"]
    _to_bronze(spark, bronze, [_article(2, "u1"), _article(3, "u2")], "b")
    assert _table_dedup(spark, scratch, bronze) == ["u1", "u2"]
    # the batch ran but its commit was lost: the restart runs the epoch again
    commits = sorted(x for x in os.listdir(f"{scratch}/tsck/commits") if x.isdigit())
    for x in (commits[-1], f".{commits[-1]}.crc"):
        os.remove(f"{scratch}/tsck/commits/{x}")
    assert _table_dedup(spark, scratch, bronze) == ["u1", "u2"]
    assert spark.read.parquet(f"{scratch}/seen").count() == 2


def test_unreadable_seen_table_stops_the_stream(spark, scratch):
    import pytest
    from pyspark.errors import StreamingQueryException
    bronze = f"{scratch}/b"
    _to_bronze(spark, bronze, [_article(1, "u1")], "a")
    assert _table_dedup(spark, scratch, bronze) == ["u1"]
    _to_bronze(spark, bronze, [_article(2, "u1")], "b")
    os.rename(f"{scratch}/seen", f"{scratch}/gone")                                  # missing, but silver is there
    with pytest.raises(StreamingQueryException):
        _table_dedup(spark, scratch, bronze)
    os.makedirs(f"{scratch}/seen/epoch=0")
    with open(f"{scratch}/seen/epoch=0/part-0.parquet", "w") as f:
        f.write("not parquet")
    with pytest.raises(StreamingQueryException):
        _table_dedup(spark, scratch, bronze)
    assert spark.read.parquet(f"{scratch}/ts").count() == 1


def test_compacted_seen_table_serves_the_next_start(spark, scratch):
    from presslake.streaming import compact_seen, start_silver_table_dedup
    bronze = f"{scratch}/b"
    _to_bronze(spark, bronze, [_article(1, "u1")], "a")
    _table_dedup(spark, scratch, bronze)
    _to_bronze(spark, bronze, [_article(2, "u2")], "b")
    _table_dedup(spark, scratch, bronze)
    compact_seen(spark, f"{scratch}/seen", f"{scratch}/seen2")
    assert os.listdir(f"{scratch}/seen2") and spark.read.parquet(f"{scratch}/seen2").select("epoch").distinct().count() == 1
    _to_bronze(spark, bronze, [_article(3, "u1"), _article(4, "u3")], "c")
    start_silver_table_dedup(bronze_stream(spark, bronze), f"{scratch}/ts", f"{scratch}/seen2", f"{scratch}/tsck",
                             trigger="available_now").awaitTermination()
    assert sorted(r.url for r in spark.read.parquet(f"{scratch}/ts").collect()) == ["u1", "u2", "u3"]


def test_gold_stream_writes_one_stamp(spark, scratch):
    from presslake.sinks import GoldTarget
    from presslake.streaming import start_gold_stream
    schema = "url string, date_parsed date, source string, categorie_clean string"
    spark.createDataFrame([("u1", dt.date(2026, 1, 1), "S1", "a"), ("u2", None, "S2", "b")], schema).write.parquet(f"{scratch}/in")
    start_gold_stream(spark.readStream.schema(schema).parquet(f"{scratch}/in"), GoldTarget(kind="parquet", path=f"{scratch}/g"),
                      f"{scratch}/ck", trigger="available_now").awaitTermination()
    stamps = {r.processing_time for t in os.listdir(f"{scratch}/g") for r in spark.read.parquet(f"{scratch}/g/{t}").collect()}
    assert len(stamps) == 1
