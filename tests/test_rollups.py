"""Counter summaries: they combine, and answer as the raw samples do."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from presslake.operators.metrics import increase_at
from presslake.operators.rollups import increase_from_rollup, merge_rollup, rollup

T0 = dt.datetime(2026, 1, 1)


def _samples(spark, seed, n=400, hours=60):
    rng, rows = random.Random(seed), []
    for job in ("a", "b"):
        v = 0.0
        for k, t in enumerate(sorted(rng.randrange(hours * 3600) for _ in range(n))):
            v = 0.0 if rng.random() < 0.03 else v + rng.randrange(5)          # resets
            rows.append(("m", {"job": job}, T0 + dt.timedelta(seconds=t // 60 * 60 if rng.random() < 0.3 else t), v, k))
    rows.append(("m", {"job": "one"}, T0 + dt.timedelta(hours=1), 7.0, 0))     # a single sample, on a bucket's end
    return spark.createDataFrame(rows, "metric string, labels map<string,string>, ts timestamp, value double, sample_id long")


def _rows(df):
    return sorted((r.labels["job"], r.eval_ts, round(r.increase, 6)) for r in df.collect())


@pytest.mark.parametrize("seed", [1, 2])
@pytest.mark.parametrize("frame, step", [("6 hours", "1 hour"), ("24 hours", "3 hours"), ("1 hour", "1 hour"), ("397 minutes", "45 minutes"),
                                         ("61 minutes", "7 minutes")])
def test_same_as_raw_samples(spark, seed, frame, step):
    s = _samples(spark, seed)
    got = increase_from_rollup(rollup(s, "1 hour"), frame, step, "1 hour", s)
    assert _rows(got) == _rows(increase_at(s, frame, step))


def test_records_combine(spark):
    s = _samples(spark, 3)
    fine, coarse = rollup(s, "10 minutes"), rollup(s, "1 hour")
    names = coarse.columns
    key = lambda r: (str(r._series), r.c)
    assert sorted(merge_rollup(fine, 6).select(names).collect(), key=key) == sorted(coarse.collect(), key=key)
    # kept bucket by bucket: the records of two halves of the time are those of the whole
    cut = T0 + dt.timedelta(hours=30)
    halves = rollup(s.where(F.col("ts") <= F.lit(cut)), "1 hour").unionByName(rollup(s.where(F.col("ts") > F.lit(cut)), "1 hour"))
    assert sorted(halves.collect(), key=key) == sorted(coarse.collect(), key=key)


def test_whole_buckets_need_no_samples(spark, scratch):
    s = _samples(spark, 4)
    rollup(s, "1 hour").write.parquet(f"{scratch}/r")
    out = increase_from_rollup(spark.read.parquet(f"{scratch}/r"), "12 hours", "2 hours", "1 hour")
    assert "sample_id" not in out._jdf.queryExecution().optimizedPlan().toString() and out.count()
    with pytest.raises(ValueError):
        increase_from_rollup(rollup(s, "1 hour"), "90 minutes", "1 hour", "1 hour")
    with pytest.raises(ValueError):
        increase_from_rollup(rollup(s, "1 hour"), "30 minutes", "30 minutes", "1 hour", s)


def test_no_samples(spark):
    s = _samples(spark, 5).limit(0)
    assert increase_from_rollup(rollup(s, "1 hour"), "2 hours", "1 hour", "1 hour").count() == 0
