"""Epochs that write their layer and their counts: crashes, replays, dead letters, late rows."""

import datetime as dt
import json
import os
import subprocess
import sys
import textwrap

import pytest
from pyspark.errors import StreamingQueryException
from pyspark.sql import functions as F

from presslake.schemas import MESSAGE_SCHEMA
from presslake.sinks.files import Files
from presslake.sources.messages import read_messages
from presslake.streaming import (bronze_stream, read_counts, read_rejects, run_available_now, start_bronze, start_silver,
                                 start_silver_table_dedup)
from presslake.streaming.layers import trigger_kwargs

T0 = dt.datetime(2026, 5, 19, 12, 0, 0)


def _article(i, url, titre="T"):
    return json.dumps({k: v for k, v in {"titre": titre, "url": url, "source": "S", "contenu": f"body {i}"}.items() if v is not None})


def _messages(spark, folder, payloads, start=0):
    rows = [(None if p is None else bytearray(p.encode()), T0 + dt.timedelta(seconds=start + i), start + i) for i, p in enumerate(payloads)]
    spark.createDataFrame(rows, MESSAGE_SCHEMA).coalesce(1).write.mode("append").parquet(folder)


def _counts(spark, path, **kw):
    return {(r.query, r.batch_id): r.n for r in read_counts(spark, path, **kw).collect()}


def _bronze(spark, scratch, **kw):
    return start_bronze(read_messages(spark, f"{scratch}/m", max_files_per_trigger=1), f"{scratch}/b", f"{scratch}/ck", "available_now",
                        counts_path=f"{scratch}/c", **kw)


@pytest.mark.parametrize("step", ["write_text", "publish", "after"])
def test_a_crash_at_any_step_leaves_each_epoch_once(spark, scratch, monkeypatch, step):
    for k in range(3):
        _messages(spark, f"{scratch}/m", [_article(i, f"u{k}{i}") for i in range(k + 1)], 10 * k)
    real, calls = getattr(Files, step, None), []

    def dies(self, path, *rest):
        calls.append(path)
        if len(calls) == 2:
            raise RuntimeError("killed")
        return real(self, path, *rest)
    if step == "after":  # everything is published, but the query never learns of it
        import presslake.streaming.layers as layers
        write = layers.write_epoch

        def written(batch, epoch, *rest, **kw):
            write(batch, epoch, *rest, **kw)
            calls.append(epoch)
            if len(calls) == 2:
                raise RuntimeError("killed")
        monkeypatch.setattr(layers, "write_epoch", written)
    else:
        monkeypatch.setattr(Files, step, dies)
    with pytest.raises(StreamingQueryException):
        _bronze(spark, scratch).awaitTermination()
    before = _counts(spark, f"{scratch}/c")
    _bronze(spark, scratch).awaitTermination()
    after = _counts(spark, f"{scratch}/c")
    assert len(after) == 3 and sum(after.values()) == 6 and before.items() <= after.items()
    rows = spark.read.json(f"{scratch}/b")
    assert rows.count() == 6 == rows.select("url").distinct().count()
    assert not list(Files(spark).names(f"{scratch}/b/_staging"))


def test_a_replayed_epoch_counts_once_and_its_files_stay(spark, scratch):
    _messages(spark, f"{scratch}/m", [_article(1, "u1")])
    _messages(spark, f"{scratch}/m", [_article(2, "u2"), _article(3, "u3")], 10)
    _bronze(spark, scratch).awaitTermination()
    files = sorted(os.listdir(f"{scratch}/b/epoch=1"))
    for name in ("1", ".1.crc"):
        os.remove(f"{scratch}/ck/commits/{name}")
    _bronze(spark, scratch).awaitTermination()
    assert sorted(os.listdir(f"{scratch}/b/epoch=1")) == files and sorted(_counts(spark, f"{scratch}/c").values()) == [1, 2]


CHILD = """
    import os, signal, sys
    sys.path.insert(0, {repo!r})
    from presslake.session import get_spark
    from presslake.sources.messages import read_messages
    from presslake.streaming import start_bronze
    import presslake.streaming.layers as layers
    spark = get_spark("local[2]", 2, extra={{"spark.ui.showConsoleProgress": "false"}})
    write = layers.write_epoch
    def counted(batch, epoch, *rest, **kw):
        if epoch == 2:
            os.kill(os.getpid(), signal.SIGKILL)
        write(batch, epoch, *rest, **kw)
    layers.write_epoch = counted
    start_bronze(read_messages(spark, {m!r}, max_files_per_trigger=1), {b!r}, {ck!r}, "available_now", counts_path={c!r}).awaitTermination()
"""


def test_a_killed_driver_loses_no_count(spark, scratch):
    for k in range(4):
        _messages(spark, f"{scratch}/m", [_article(i, f"u{k}{i}") for i in range(k + 1)], 10 * k)
    repo = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    code = textwrap.dedent(CHILD).format(repo=repo, m=f"{scratch}/m", b=f"{scratch}/b", ck=f"{scratch}/ck", c=f"{scratch}/c")
    done = subprocess.run([sys.executable, "-c", code], capture_output=True, timeout=300)
    assert done.returncode == -9
    assert len(_counts(spark, f"{scratch}/c")) == 2
    _bronze(spark, scratch).awaitTermination()
    assert sum(_counts(spark, f"{scratch}/c").values()) == 10 == spark.read.json(f"{scratch}/b").count()


def test_both_layers_count_and_silver_follows_published_epochs(spark, scratch):
    paths = dict(counts_path=f"{scratch}/c", rejects_path=f"{scratch}/r", late_path=f"{scratch}/l")

    def run():
        run_available_now(spark, read_messages(spark, f"{scratch}/m"), f"{scratch}/b", f"{scratch}/s", f"{scratch}/ck", **paths)
        return sorted(r.url for r in spark.read.parquet(f"{scratch}/s").collect())
    _messages(spark, f"{scratch}/m", [_article(0, "u1"), _article(1, "u2"), _article(2, "u1"), "not json", None, _article(4, "u3", None)])
    assert run() == ["u1", "u2"]
    assert _counts(spark, f"{scratch}/c") == {("bronze", 0): 6, ("bronze_rejects", 0): 2, ("silver", 0): 2}
    assert _counts(spark, f"{scratch}/c", non_empty=False)[("silver_late", 0)] == 0
    _messages(spark, f"{scratch}/m", [_article(10, "u1"), _article(11, "u9"), '{"titre": "cut'], 100)
    assert run() == ["u1", "u2", "u9"]
    rejects = {r.offset: (r.reason, r.value_text) for r in read_rejects(spark, f"{scratch}/r").collect()}
    assert rejects == {3: ("malformed", "not json"), 4: ("null", None), 102: ("malformed", '{"titre": "cut')}
    bronze = spark.read.schema(bronze_stream(spark, f"{scratch}/b").schema).json(f"{scratch}/b")
    assert bronze.count() == 9 and bronze.where("url IS NULL").count() == 3   # a dead letter keeps its row in bronze
    assert run() == ["u1", "u2", "u9"]                                          # nothing new: nothing written


LATE_SCHEMA = "titre string, auteur string, date_publication string, categorie string, contenu string, source string, url string, " \
              "kafka_timestamp timestamp, offset long, ingestion_time timestamp"


def _late_rows(spark, scratch, rows):
    data = [("t", None, None, None, f"b{o}", "S", u, T0 + dt.timedelta(seconds=o), o, T0 + dt.timedelta(minutes=m)) for u, o, m in rows]
    spark.createDataFrame(data, LATE_SCHEMA).coalesce(1).write.mode("append").json(f"{scratch}/in")


def _late_source(spark, scratch):
    return spark.readStream.schema(LATE_SCHEMA).option("maxFilesPerTrigger", 1).json(f"{scratch}/in")


def _late_batches(spark, scratch):
    _late_rows(spark, scratch, [("a", 2, 0), ("a", 1, 0), ("b", 3, 0)])
    _late_rows(spark, scratch, [("c", 4, 180)])
    _late_rows(spark, scratch, [("d", 5, 180)])
    _late_rows(spark, scratch, [("x", 6, 1), ("x", 7, 1), ("a", 8, 2), ("e", 9, 181)])


def _read(spark, path):
    return sorted((r.url, r.contenu_clean) for r in spark.read.parquet(path).collect())


def test_late_rows_of_the_state_are_kept_and_counted(spark, scratch):
    _late_batches(spark, scratch)
    start_silver(_late_source(spark, scratch), f"{scratch}/s", f"{scratch}/ck", "available_now", mode="bounded", delay="10 minutes",
                 counts_path=f"{scratch}/c", late_path=f"{scratch}/l").awaitTermination()
    assert _read(spark, f"{scratch}/s") == [("a", "b1"), ("b", "b3"), ("c", "b4"), ("d", "b5"), ("e", "b9")]   # first arrivals
    late = {(r.url, r.contenu_clean): r.copies for r in spark.read.parquet(f"{scratch}/l").collect()}
    assert sum(late.values()) == 3 and {u for u, _ in late} == {"x", "a"} and ("x", "b6") in late
    assert _counts(spark, f"{scratch}/c")[("silver_late", max(k[1] for k in _counts(spark, f"{scratch}/c")))] == len(late)


def test_late_rows_of_the_table_dedup_are_kept_whole(spark, scratch):
    _late_batches(spark, scratch)

    def run():
        start_silver_table_dedup(_late_source(spark, scratch), f"{scratch}/s", f"{scratch}/seen", f"{scratch}/ck", "available_now",
                                 counts_path=f"{scratch}/c", late_path=f"{scratch}/l", delay="10 minutes", query_name="t",
                                 buckets=4).awaitTermination()
    run()
    admitted = [("a", "b1"), ("b", "b3"), ("c", "b4"), ("d", "b5"), ("e", "b9")]
    assert _read(spark, f"{scratch}/s") == admitted
    late = spark.read.parquet(f"{scratch}/l")
    assert sorted(r.offset for r in late.collect()) == [6, 7, 8]
    counts = _counts(spark, f"{scratch}/c")
    assert counts[("t_late", 3)] == 3 and [counts[("t", e)] for e in range(4)] == [2, 1, 1, 1]
    _late_rows(spark, scratch, [("late", 20, 3), ("f", 21, 182)])
    run()   # the watermark is read again after a restart
    assert _read(spark, f"{scratch}/s") == admitted + [("f", "b21")] and spark.read.parquet(f"{scratch}/l").count() == 4


def test_empty_batches_and_no_counts(spark, scratch):
    assert read_counts(spark, f"{scratch}/none").count() == 0
    q = (spark.readStream.schema("v long, ts timestamp").json(scratch).where(F.lit(False)).writeStream
         .option("checkpointLocation", f"{scratch}/../ck-{os.path.basename(scratch)}").trigger(**trigger_kwargs("available_now")))
    from presslake.streaming.epochs import write_epoch
    with open(f"{scratch}/x.json", "w") as f:
        f.write('{"v": 1}\n')
    q.foreachBatch(lambda b, e: write_epoch(b, e, {"x": f"{scratch}/out"}, f"{scratch}/c", event_time="ts")).start().awaitTermination()
    assert _counts(spark, f"{scratch}/c", non_empty=False) == {("x", 0): 0}
