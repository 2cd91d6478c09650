"""Counter summaries that combine (W1-W4, S7): wide ranges without raw samples.

A bucket of a series is one record: its first and last sample, the sum of the reset-aware deltas between its own samples, and
their number. Records of adjacent buckets combine into the record of both, so they are kept as a table, added to bucket by
bucket, and merged to coarser ones. Buckets are left-open, ``((c - 1) * width, c * width]``, like the frames of range queries: a
frame whose ends lie on bucket ends is answered from records alone; of any other, only the two buckets that its ends cut are read raw.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from presslake.operators.metrics import _interval_us, floor_div, with_series

_KEY = ("metric", "_series")


def _delta(value: Column, before: Column) -> Column:
    """What a counter gained since the sample before: after a reset, all it shows."""
    return F.when(before.isNull(), F.lit(0.0)).when(value >= before, value - before).otherwise(value)


def _bucket(t: Column, width: int) -> Column:
    return floor_div(t + F.lit(width - 1), width)


def rollup(samples: DataFrame, bucket: str | int = "1 hour") -> DataFrame:
    """``(metric, _series, c, first_t, first_v, last_t, last_v, gain, n)``: one record a series and bucket ``c``. One shuffle of
    the samples; a window partition is one bucket of one series. Samples of one instant count in the order of ``sample_id``."""
    width = _interval_us(bucket)
    s = with_series(samples).withColumn("c", _bucket(F.col("_t"), width))
    w = Window.partitionBy(*_KEY, "c").orderBy("_t", "sample_id")
    s = s.withColumn("_d", _delta(F.col("value"), F.lag("value").over(w)))
    at, place = F.struct("_t", "value"), F.struct("_t", "sample_id")
    out = s.groupBy(*_KEY, "c").agg(F.min_by(at, place).alias("f"), F.max_by(at, place).alias("l"), F.sum("_d").alias("gain"),
                                    F.count(F.lit(1)).alias("n"))
    return out.select(*_KEY, "c", F.col("f._t").alias("first_t"), F.col("f.value").alias("first_v"), F.col("l._t").alias("last_t"),
                      F.col("l.value").alias("last_v"), "gain", "n")


def merge_rollup(records: DataFrame, factor: int) -> DataFrame:
    """Records of buckets ``factor`` times as wide, from records alone."""
    coarse = floor_div(F.col("c") + F.lit(factor - 1), factor)
    r = records.withColumn("_c", coarse)
    w = Window.partitionBy(*_KEY, "_c").orderBy("c")
    lost = F.lag("last_v").over(w)
    r = r.withColumn("_g", F.col("gain") + F.when(lost.isNull(), F.lit(0.0)).otherwise(_delta(F.col("first_v"), lost)))
    first, last = F.struct("first_t", "first_v"), F.struct("last_t", "last_v")
    out = r.groupBy(*_KEY, "_c").agg(F.min_by(first, "c").alias("f"), F.max_by(last, "c").alias("l"), F.sum("_g").alias("gain"),
                                     F.sum("n").alias("n"))
    return out.select(*_KEY, F.col("_c").alias("c"), "f.first_t", "f.first_v", "l.last_t", "l.last_v", "gain", "n")


def increase_from_rollup(records: DataFrame, frame: str | int, step: str | int, bucket: str | int = "1 hour",
                         samples: DataFrame | None = None) -> DataFrame:
    """``increase(m[frame])`` on the ``step`` grid, ``(metric, labels, eval_ts, increase)``, for every series and instant whose
    frame holds a sample: the rule of :func:`presslake.operators.metrics.increase_at`, for frames of at least a bucket.

    What a counter has gained up to an instant is the sum of its records before, and of the deltas in the bucket that the
    instant cuts; a frame's increase is the difference between its ends. With frame and step whole buckets, ``samples`` is not
    needed; else it is read for the buckets that are cut. Windows by series run over a row a record and instant, never over samples.
    """
    width, f_us, step_us = _interval_us(bucket), _interval_us(frame), _interval_us(step)
    if f_us < width:
        raise ValueError("the frame is shorter than a bucket")
    aligned = f_us % width == 0 and step_us % width == 0
    if not aligned and samples is None:
        raise ValueError("frames that cut buckets need the samples")
    w = Window.partitionBy(*_KEY).orderBy("c")
    r = records.withColumns({"_carry": F.lag("last_v").over(w), "_next": F.lead("first_t").over(w)})
    full = F.col("gain") + F.when(F.col("_carry").isNull(), F.lit(0.0)).otherwise(_delta(F.col("first_v"), F.col("_carry")))
    r = r.withColumn("_full", full).withColumn("_upto", F.sum("_full").over(w.rowsBetween(Window.unboundedPreceding, 0)))
    # an instant belongs to the last record that begins at or before it
    start = floor_div(F.col("first_t") + F.lit(step_us - 1), step_us) * F.lit(step_us)
    end = F.least(F.coalesce(F.col("_next") - 1, F.col("last_t") + F.lit(f_us - 1)), F.col("last_t") + F.lit(f_us - 1))
    grid = F.when(start <= end, F.sequence(start, end, F.lit(step_us)))
    instants = r.select(*_KEY, F.explode(grid).alias("te"))
    ends = instants.select(*_KEY, "te", F.explode(F.array(F.struct(F.lit(1).alias("sign"), F.col("te").alias("x")),
                                                          F.struct(F.lit(-1).alias("sign"), (F.col("te") - f_us).alias("x")))).alias("e"))
    ends = ends.select(*_KEY, "te", "e.sign", "e.x")
    record = F.struct("c", "first_t", "last_t", "_carry", "_upto", "_full")
    known = r.select(*_KEY, F.col("first_t").alias("x"), F.lit(0).alias("kind"), record.alias("_r"))
    both = known.unionByName(ends.withColumn("kind", F.lit(1)), allowMissingColumns=True)
    as_of = Window.partitionBy(*_KEY).orderBy("x", "kind")
    both = both.withColumn("_o", F.last("_r", ignorenulls=True).over(as_of.rowsBetween(Window.unboundedPreceding, 0)))
    points = both.where("kind = 1").select(*_KEY, "te", "sign", "x", "_o")
    cut = F.col("x") < F.col("_o.last_t")
    # before the first record nothing was gained
    gained = F.when(F.col("_o").isNull(), F.lit(0.0)).when(cut, F.col("_o._upto") - F.col("_o._full")).otherwise(F.col("_o._upto"))
    total = points.select(*_KEY, "te", (F.col("sign") * gained).alias("part"))
    if not aligned:
        total = total.unionByName(_partial(points.where(cut), samples, width))
    out = total.groupBy(*_KEY, "te").agg(F.sum("part").alias("increase"))
    return out.select("metric", F.map_from_entries("_series").alias("labels"), F.timestamp_micros("te").alias("eval_ts"), "increase")


def _partial(points: DataFrame, samples: DataFrame, width: int) -> DataFrame:
    """What the cut buckets' samples up to each point have gained: only those buckets' samples are joined, and each is one window."""
    points = points.select(*_KEY, "te", "sign", F.col("x").alias("_t"), F.col("_o.c").alias("c"), F.col("_o._carry").alias("_carry"))
    cut = points.groupBy(*_KEY, "c").agg(F.first("_carry").alias("_carry"))
    raw = with_series(samples).withColumn("c", _bucket(F.col("_t"), width))
    raw = raw.join(cut, [*_KEY, "c"]).select(*_KEY, "c", "_t", "sample_id", "value", "_carry", F.lit(0).alias("kind"))
    both = raw.unionByName(points.drop("_carry").withColumn("kind", F.lit(1)), allowMissingColumns=True)
    w = Window.partitionBy(*_KEY, "c").orderBy("_t", "kind", "sample_id")
    before = F.coalesce(F.last("value", ignorenulls=True).over(w.rowsBetween(Window.unboundedPreceding, -1)), F.col("_carry"))
    both = both.withColumn("_d", F.when(F.col("kind") == 0, _delta(F.col("value"), before)))
    so_far = F.sum("_d").over(w.rowsBetween(Window.unboundedPreceding, 0))
    return both.withColumn("_p", so_far).where("kind = 1").select(*_KEY, "te", (F.col("sign") * F.coalesce("_p", F.lit(0.0))).alias("part"))
