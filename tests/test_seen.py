"""The seen table by buckets: pruning, replays, compaction beside readers."""

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from presslake.sinks.seen import SeenTable


def _keys(spark, keys):
    return spark.createDataFrame([(k,) for k in keys], "url string")


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_add_read_and_replay(spark, scratch):
    t = SeenTable(spark, f"{scratch}/t", 8)
    assert t.read().count() == 0 and t.unseen(_keys(spark, ["a"])).count() == 1
    t.add(_keys(spark, ["a", "b", "a", None]), 0)
    t.add(_keys(spark, ["c"]), 1)
    t.add(_keys(spark, ["c"]), 1)                                   # the epoch again: the same rows
    again = SeenTable(spark, f"{scratch}/t", 99)                    # the table's own number of buckets counts
    assert again.buckets == 8 and sorted(r.url for r in again.read().where("url IS NOT NULL").collect()) == ["a", "b", "c"]
    assert sorted(r.url for r in again.unseen(_keys(spark, ["a", "c", "x", "y"])).collect()) == ["x", "y"]
    assert sorted(r.url for r in again.unseen(_keys(spark, ["a", "c"]), before=1).collect()) == ["c"]
    assert again.unseen(_keys(spark, [None])).count() == 1          # a NULL key is never seen


def test_a_batch_reads_only_its_buckets(spark, scratch):
    t = SeenTable(spark, f"{scratch}/t", 16)
    t.add(spark.range(2_000).select(F.concat(F.lit("u"), "id").alias("url")), 0)
    batch = _keys(spark, ["u1", "u2", "new"])
    plan = _plan(t.unseen(batch))
    buckets = {r[0] for r in batch.select(F.pmod(F.xxhash64("url"), F.lit(16)).cast("int")).collect()}
    part = plan[plan.index("PartitionFilters"):].split("]")[0]
    assert "bucket" in part and len(buckets) <= 3
    read = t.read(batch)
    assert read.select(F.input_file_name()).distinct().count() <= len(buckets) and read.count() < 2_000 // 4
    assert [r.url for r in t.unseen(batch).collect()] == ["new"]


def test_compaction_merges_and_readers_that_began_earlier_still_read(spark, scratch):
    t = SeenTable(spark, f"{scratch}/t", 4)
    for e in range(12):
        t.add(spark.range(20).select(F.concat(F.lit(f"{e}-"), "id").alias("url")), e)
    before = t.read()                                               # has listed the files
    assert t.compact(9, least=4) == [0, 1, 2, 3]
    assert before.distinct().count() == 240 and t.read().distinct().count() == 240
    assert t.read(before=5).distinct().count() >= 100
    assert t.compact(9, least=4) == []                              # nothing new
    for e in range(12, 18):
        t.add(spark.range(20).select(F.concat(F.lit(f"{e}-"), "id").alias("url")), e)
    assert t.compact(17, least=4) == [0, 1, 2, 3]                   # drops what the first one had merged
    assert t.read().distinct().count() == 360 == t.read().count()
    names = list(t.files.names(f"{scratch}/t/bucket=0"))
    assert "epoch=3" not in names and "epoch=-19" in names and "epoch=-11" in names


def test_a_crash_between_merging_and_dropping_changes_nothing(spark, scratch, monkeypatch):
    t = SeenTable(spark, f"{scratch}/t", 2)
    for e in range(4):
        t.add(_keys(spark, [f"{e}-{k}" for k in range(10)]), e)
    monkeypatch.setattr(t.files, "publish", lambda *a: (_ for _ in ()).throw(RuntimeError("killed")))
    with pytest.raises(RuntimeError):
        t.compact(3, least=2)
    monkeypatch.undo()
    assert t.read().distinct().count() == 40
    assert t.compact(3, least=2) and t.read().distinct().count() == 40


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.lists(st.integers(0, 30), max_size=8), min_size=1, max_size=6), st.lists(st.integers(0, 40), min_size=1, max_size=8))
def test_unseen_is_set_difference(spark, tmp_path_factory, epochs, batch):
    t = SeenTable(spark, str(tmp_path_factory.mktemp("seen") / "t"), 3)
    for e, keys in enumerate(epochs):
        if keys:
            t.add(_keys(spark, [f"k{k}" for k in keys]), e)
    if t.exists():
        t.compact(len(epochs) - 1, least=2)
    seen = {k for keys in epochs for k in keys}
    got = [r.url for r in t.unseen(_keys(spark, sorted({f"k{k}" for k in batch}))).collect()]
    assert sorted(got) == sorted(f"k{k}" for k in set(batch) - seen)


def test_a_table_without_its_number_of_buckets_is_refused(spark, scratch):
    _keys(spark, ["a"]).withColumn("epoch", F.lit(0)).write.partitionBy("epoch").parquet(f"{scratch}/t")
    with pytest.raises(RuntimeError):
        SeenTable(spark, f"{scratch}/t")


def test_compaction_while_streaming(spark, scratch):
    import json
    import os

    from presslake.streaming import bronze_stream, start_silver_table_dedup
    os.makedirs(f"{scratch}/b")
    for k in range(9):
        with open(f"{scratch}/b/{k}.json", "w") as f:
            f.write("".join(json.dumps({"titre": "t", "url": f"u{(k * 3 + j) % 20}", "offset": k}) + "\n" for j in range(6)))
    src = spark.readStream.schema(bronze_stream(spark, f"{scratch}/b").schema).option("maxFilesPerTrigger", 1).json(f"{scratch}/b")
    start_silver_table_dedup(src, f"{scratch}/s", f"{scratch}/seen", f"{scratch}/ck", "available_now", buckets=2,
                             compact_every=3).awaitTermination()
    rows = spark.read.parquet(f"{scratch}/s")
    assert rows.count() == rows.select("url").distinct().count() == 20
    assert any(n.startswith("epoch=-") for n in os.listdir(f"{scratch}/seen/bucket=0"))
