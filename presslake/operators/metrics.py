"""Operational metric queries over a long sample table
(S7, F8, A8, A11, A12, W1-W5, C19, C20).

Samples are ``(metric, labels map, ts, value[, sample_id])``. A series is
``metric`` + its labels. Instant queries (latest value, sums) are plain
aggregates. Range queries (increase, rate) need an ordered pass per series;
a series can hold a large share of all rows, so they never run as one
window per series: rows are split into (series, time bucket) partitions and
each bucket gets *halo* copies of the few rows its frame reaches back to.
Every partition is bounded by the rows of one bucket plus its halo, and
the result is exact. Frames are put together from running aggregates, so
the work follows the rows, however many of them a frame holds.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from presslake.functions.scalars import status as status_expr

SERIES = ("metric", "_series")
US = 1_000_000


def _interval_us(spec: str | int) -> int:
    """'5 minutes' / '1m' / '30s' / '1 hour' / micros -> microseconds."""
    if isinstance(spec, int):
        return spec
    s = spec.strip().lower().replace(" ", "")
    units = [("microseconds", 1), ("milliseconds", 1000), ("seconds", US), ("second", US), ("minutes", 60 * US),
             ("minute", 60 * US), ("hours", 3600 * US), ("hour", 3600 * US), ("days", 86400 * US),
             ("day", 86400 * US), ("ms", 1000), ("s", US), ("m", 60 * US), ("h", 3600 * US), ("d", 86400 * US)]
    for u, mult in units:
        if s.endswith(u) and s[: -len(u)].replace(".", "", 1).isdigit():
            return int(float(s[: -len(u)]) * mult)
    raise ValueError(f"bad interval {spec!r}")


def floor_div(c: Column, n: int) -> Column:
    """Exact floor division of a long column by a positive constant:
    ``c - pmod(c, n)`` is an exact multiple of ``n``, so the quotient is exact."""
    return ((c - F.pmod(c, F.lit(n))) / F.lit(n)).cast("long")


def with_series(samples: DataFrame) -> DataFrame:
    """Add a groupable series key: labels as a sorted entry array (maps are
    not groupable) and ``_t`` = micros since epoch."""
    out = samples
    if "labels" in samples.columns:
        out = out.withColumn("_series", F.array_sort(F.map_entries(F.col("labels"))))
    else:
        out = out.withColumn("_series", F.array().cast("array<struct<key:string,value:string>>"))
    if "sample_id" not in out.columns:
        out = out.withColumn("sample_id", F.monotonically_increasing_id())
    return out.withColumn("_t", F.unix_micros(F.col("ts").cast("timestamp")))


def select_series(samples: DataFrame, metric: str | None = None, **labels: str) -> DataFrame:
    """F8: label selector ``metric{k='v', ...}``."""
    cond = F.lit(True)
    if metric is not None:
        cond = cond & (F.col("metric") == metric)
    for k, v in labels.items():
        cond = cond & (F.col("labels")[k] == v)
    return samples.filter(cond)


def latest(samples: DataFrame, at=None, lookback: str | int = "5 minutes") -> DataFrame:
    """The current value of every series (instant vector).

    With ``at`` (a timestamp or its text) the query is evaluated then: only
    samples in ``(at - lookback, at]`` count, so a series that has been silent for
    longer is absent. Without it the last sample counts however old it is.
    ``max_by`` over ``(ts, sample_id)``: a partial/final aggregate, so a hot
    series is reduced map-side; the time range reaches the scan as a filter.
    """
    if at is not None:
        end = F.lit(at).cast("timestamp_ntz")
        start = end - F.expr(f"INTERVAL '{_interval_us(lookback) / US}' SECOND")
        ts = F.col("ts").cast("timestamp_ntz")
        samples = samples.filter((ts > start) & (ts <= end))
    s = with_series(samples)
    return (s.groupBy("metric", "_series")
            .agg(F.max_by(F.struct("ts", "value"), F.struct("_t", "sample_id")).alias("_l"))
            .select("metric", F.map_from_entries(F.col("_series")).alias("labels"), "_series",
                    F.col("_l.ts").alias("ts"), F.col("_l.value").alias("value")))


def sum_latest(samples: DataFrame, by: Sequence[str] = (), at=None, lookback: str | int = "5 minutes") -> DataFrame:
    """``sum(m)`` / ``sum by (labels)(m)`` of the current values, per metric (see :func:`latest`)."""
    cur = latest(samples, at, lookback)
    keys = [F.col("metric")] + [F.col("labels")[b].alias(b) for b in by]
    return cur.groupBy(*keys).agg(F.sum("value").alias("value"))


def _bucketed(samples: DataFrame, b_us: int, f_us: int, step_us: int | None = None) -> DataFrame:
    """Samples laid out for per-(series, bucket) windows, with reset-aware
    ``delta`` computed, in ONE shuffle of the samples.

    Partition (series, b) receives: its own rows (``_halo=0``); copies of
    bucket b-1's rows within ``f_us`` of b's start (``_halo=1``, they fall
    in the frames of b's rows); one carry row (``_halo=2``), the last
    sample before those copies, so the first copied row has its previous
    sample; and with ``step_us`` the instants of the step grid whose frame
    can hold a sample (``_halo=3``, no value). Carry and instants come from a
    per-(series, bucket) aggregate (head = last sample outside the tail, last =
    last sample) and windows over that table: one row a bucket of a series,
    never the samples of a whole series. With ``f_us`` rows name their ``_block``, a frame's length of time.
    """
    s = with_series(samples).withColumn("_b", floor_div(F.col("_t"), b_us))
    in_tail = F.col("_t") > (F.col("_b") + 1) * F.lit(b_us) - F.lit(f_us)
    sample = F.struct("_t", "sample_id", "value")
    order = F.struct("_t", "sample_id")
    agg = (s.groupBy("metric", "_series", "_b")
           .agg(F.max_by(sample, F.when(~in_tail, order)).alias("_head"), F.max_by(sample, order).alias("_last")))
    w = Window.partitionBy("metric", "_series").orderBy("_b")
    adjacent = F.lag("_b").over(w) == F.col("_b") - 1
    carry_pt = F.when(adjacent, F.coalesce(F.lag("_head").over(w), F.lag("_last", 2).over(w))) \
        .otherwise(F.lag("_last").over(w))
    alone = F.coalesce(F.lead("_b").over(w) != F.col("_b") + 1, F.lit(True))  # the next bucket has no samples
    # the instants of an empty next bucket see copies of this one's tail, which need the sample before them
    after_pt = F.when(alone, F.coalesce(F.col("_head"), F.lag("_last").over(w)))
    agg = agg.select("metric", "_series", "_b", carry_pt.alias("_c"), after_pt.alias("_after"), alone.alias("_alone"))
    types = {f.name: f.dataType for f in s.schema.fields}

    def point(b, t, sample_id, value, halo: int):
        cols = {"_b": b, "_t": t, "sample_id": sample_id.cast(types["sample_id"]), "value": value.cast(types["value"])}
        return F.struct(*[c.alias(k) for k, c in cols.items()], F.lit(halo).alias("_halo"))

    def carried(b, c: str):
        return point(b, F.col(c)["_t"], F.col(c)["sample_id"], F.col(c)["value"], 2)
    extra = F.array(carried(F.col("_b"), "_c"))
    if step_us:
        # instants of a bucket with samples, and up to a frame beyond it if the next has none
        spill = F.when(F.col("_alone"), F.lit(f_us)).otherwise(F.lit(0))
        first = floor_div(F.col("_b") * F.lit(b_us) + F.lit(step_us - 1), step_us) * F.lit(step_us)
        last = (F.col("_b") + 1) * F.lit(b_us) + spill - 1
        grid = F.when(first <= last, F.sequence(first, last, F.lit(step_us))).otherwise(F.array().cast("array<bigint>"))
        none = F.lit(None)
        extra = F.concat(extra, F.array(carried(F.col("_b") + 1, "_after")),
                         F.transform(grid, lambda t: point(floor_div(t, b_us), t, none, none, 3)))
    extra = (agg.select("metric", "_series", F.explode(extra).alias("p")).filter(F.col("p._t").isNotNull())
             .select("metric", "_series", F.map_from_entries("_series").alias("labels"), "p.*"))
    own = (s.withColumn("_halo", F.explode(F.when(in_tail, F.array(F.lit(0), F.lit(1)))
                                           .otherwise(F.array(F.lit(0)))))
           .withColumn("_b", F.col("_b") + F.col("_halo")))
    u = own.unionByName(extra, allowMissingColumns=True)
    by = ["_t", "sample_id"]
    if f_us:
        # in the order that the frames' windows need too
        u, by = u.withColumn("_block", floor_div(F.col("_t"), f_us)), ["_block", *by]
    wp = Window.partitionBy("metric", "_series", "_b").orderBy(*by)
    prev = F.last("value", ignorenulls=True).over(wp.rowsBetween(Window.unboundedPreceding, -1))
    delta = (F.when(prev.isNull(), F.lit(0.0))
             .when(F.col("value") >= prev, F.col("value") - prev)
             .otherwise(F.col("value")))
    return u.withColumn("delta", delta)


def _framed(u: DataFrame, f_us: int, halo: int, ends: bool) -> DataFrame:
    """The rows of kind ``halo`` with what the samples in their frame ``(t - f_us, t]`` come to: ``_sum`` of deltas, number
    ``_n``, and with ``ends`` the ``_first`` sample and the time ``_last_t`` of the last.

    A frame is the head of its instant's block up to ``t``, and the tail of the block before from behind ``t - f_us``. Both are
    running aggregates, one forward and one backward, so a row is added twice, where a sliding window adds up each
    frame anew. A tail reaches the instants that it belongs to as a mark, ``f_us`` later: from the back, the
    last mark met before ``t`` is that of the earliest sample behind ``t - f_us``.
    """
    real = F.col("_halo") < 2
    aggs = {"sum": F.sum(F.when(real, F.col("delta"))), "n": F.count(F.when(real, F.lit(1)))}
    if ends:
        aggs |= {"first": F.min_by(F.struct("_t", "value", "delta"), F.when(real, F.struct("_t", "sample_id"))),
                 "last_t": F.max(F.when(real, F.col("_t")))}
    block, back = Window.partitionBy("metric", "_series", "_b", "_block"), F.col("_t").desc()
    so_far = (Window.unboundedPreceding, Window.currentRow)
    head, tail = block.orderBy("_t").rangeBetween(*so_far), block.orderBy(back).rangeBetween(*so_far)
    names = [c for c in u.columns if c not in ("metric", "_series", "_b", "_block", "_t")]
    u = u.filter(F.col("_halo") != 2).withColumns({"_head": F.struct(*[a.over(head).alias(k) for k, a in aggs.items()]),
                                                   "_tail": F.struct(*[a.over(tail).alias(k) for k, a in aggs.items()])})
    here, mark = F.col("_halo") == halo, F.col("_mark")
    kinds = (F.when(here & real, F.array(F.lit(0), F.lit(1))).when(here, F.array(F.lit(0))).when(real, F.array(F.lit(1))))
    u = u.withColumn("_mark", F.explode(kinds))
    u = u.select("metric", "_series", "_b", (F.col("_block") + mark).alias("_block"), (F.col("_t") + mark * F.lit(f_us)).alias("_t"),
                 "_mark", *[F.when(mark == 0, F.col(c)).alias(c) for c in [*names, "_head"]],
                 F.when(mark == 1, F.col("_tail")).alias("_tail"))
    met = block.orderBy(back, "_mark").rowsBetween(*so_far)
    u = u.withColumn("_tail", F.last("_tail", ignorenulls=True).over(met)).filter(mark == 0)
    out = {"_sum": F.coalesce(F.col("_tail.sum") + F.col("_head.sum"), F.col("_tail.sum"), F.col("_head.sum")),
           "_n": F.coalesce(F.col("_tail.n"), F.lit(0)) + F.col("_head.n")}
    if ends:
        out |= {"_first": F.when(F.col("_tail").isNotNull(), F.col("_tail.first")).otherwise(F.col("_head.first")),
                "_last_t": F.when(F.col("_head.n") > 0, F.col("_head.last_t")).otherwise(F.col("_tail.last_t"))}
    return u.withColumns(out).drop("_head", "_tail", "_mark", "_block")


def deltas(samples: DataFrame, bucket: str | int = "1 hour") -> DataFrame:
    """Reset-aware per-sample delta: 0 for a series' first sample, ``v - prev``
    when the counter grew, ``v`` after a reset (``v < prev``)."""
    return _bucketed(samples, _interval_us(bucket), 0).filter(F.col("_halo") == 0).drop("_halo")


def increase(samples: DataFrame, frame: str | int = "5 minutes", bucket: str | int = "1 hour",
             extrapolate: bool = False) -> DataFrame:
    """``increase(m[frame])`` at every sample, over the left-open frame
    ``(t - frame, t]``. One shuffle of the samples; every window partition
    is one (series, bucket) plus its halo.

    ``extrapolate=False``: the exact sum of reset-aware deltas (each
    sample's delta against its predecessor, which may precede the frame).
    ``extrapolate=True``: the dashboard engine's rule instead: the
    reset-corrected increase between the first and last samples inside the
    frame, extended toward the frame start by the gap to the first sample
    when it is under 1.1 average sample intervals (else by half an
    interval), never past the counter's zero point; NULL with fewer than
    two samples in the frame. Evaluated at sample times, so the frame end
    is the last sample.
    """
    f_us = _interval_us(frame)
    b_us = max(_interval_us(bucket), f_us)
    u = _framed(_bucketed(samples, b_us, f_us), f_us, 0, ends=extrapolate).drop("_halo")
    if not extrapolate:
        return u.withColumn("increase", F.col("_sum")).drop("_sum", "_n")
    first_t, first_v = F.col("_first._t"), F.col("_first.value")
    result = F.col("_sum") - F.col("_first.delta")             # increase inside the frame
    sampled = (F.col("_t") - first_t) / F.lit(float(US))       # seconds first -> last
    avg = sampled / (F.col("_n") - 1)
    to_start = (first_t - (F.col("_t") - F.lit(f_us))) / F.lit(float(US))
    to_zero = F.when((result > 0) & (first_v >= 0), sampled * (first_v / result))
    to_start = F.when(to_zero.isNotNull() & (to_zero < to_start), to_zero).otherwise(to_start)
    extended = sampled + F.when(to_start < avg * 1.1, to_start).otherwise(avg / 2)
    value = F.when((F.col("_n") >= 2) & (sampled > 0), result * (extended / sampled))
    return u.withColumn("increase", value).drop("_sum", "_n", "_first", "_last_t")


def rate(samples: DataFrame, frame: str | int = "1 minute", bucket: str | int = "1 hour",
         extrapolate: bool = False) -> DataFrame:
    """``rate(m[frame])`` = increase / frame seconds, at every sample."""
    f_s = _interval_us(frame) / US
    inc = increase(samples, frame, bucket, extrapolate)
    return inc.withColumn("rate", F.col("increase") / F.lit(f_s))


def increase_at(samples: DataFrame, frame: str | int = "5 minutes", step: str | int = "1 minute",
                bucket: str | int = "1 hour", extrapolate: bool = False) -> DataFrame:
    """``increase(m[frame])`` evaluated on the ``step`` grid (epoch-aligned
    instants ``t``), as a range query does: the exact sum of reset-aware
    deltas over ``(t - frame, t]`` for every series and every instant whose
    frame holds at least one sample.

    Instants are generated only from (series, bucket)s that have samples
    (plus, when the next bucket is empty, the instants within ``frame``
    after the bucket), so their number follows the data, and they join
    the samples in the same bounded (series, bucket) windows.

    ``extrapolate=True`` applies the dashboard engine's rule instead (see
    :func:`increase`), extending toward both frame ends: the frame end is
    the instant, not a sample. NULL results (fewer than two samples) are
    dropped.
    """
    f_us, st_us = _interval_us(frame), _interval_us(step)
    b_us = max(_interval_us(bucket), f_us)
    u = _framed(_bucketed(samples, b_us, f_us, st_us), f_us, 3, ends=extrapolate).filter(F.col("_n") > 0)
    if extrapolate:
        first_t, first_v = F.col("_first._t"), F.col("_first.value")
        result = F.col("_sum") - F.col("_first.delta")
        sampled = (F.col("_last_t") - first_t) / F.lit(float(US))
        avg = sampled / (F.col("_n") - 1)
        to_start = (first_t - (F.col("_t") - F.lit(f_us))) / F.lit(float(US))
        to_end = (F.col("_t") - F.col("_last_t")) / F.lit(float(US))
        to_zero = F.when((result > 0) & (first_v >= 0), sampled * (first_v / result))
        to_start = F.when(to_zero.isNotNull() & (to_zero < to_start), to_zero).otherwise(to_start)
        extended = (sampled + F.when(to_start < avg * 1.1, to_start).otherwise(avg / 2)
                    + F.when(to_end < avg * 1.1, to_end).otherwise(avg / 2))
        value = F.when((F.col("_n") >= 2) & (sampled > 0), result * (extended / sampled))
        u = u.withColumn("increase", value).filter(F.col("increase").isNotNull())
    else:
        u = u.withColumn("increase", F.col("_sum"))
    return u.select("metric", "labels", "_series", F.timestamp_micros("_t").cast("timestamp_ntz").alias("eval_ts"),
                    "increase")


def rate_at(samples: DataFrame, frame: str | int = "1 minute", step: str | int = "15 seconds",
            bucket: str | int = "1 hour", extrapolate: bool = False) -> DataFrame:
    """``rate(m[frame])`` on the ``step`` grid (see :func:`increase_at`)."""
    f_s = _interval_us(frame) / US
    return increase_at(samples, frame, step, bucket, extrapolate).withColumn("rate", F.col("increase") / F.lit(f_s))


def sum_rate_at(samples: DataFrame, frame: str | int = "1 minute", step: str | int = "15 seconds",
                factor: float = 1.0, by: Sequence[str] = (), bucket: str | int = "1 hour",
                extrapolate: bool = False) -> DataFrame:
    """``sum [by (labels)] (rate(m[frame])) * factor`` on the ``step`` grid:
    :func:`rate_at` per series, by the exact or (``extrapolate``) the dashboard
    engine's rule, then an aggregate per instant (series absent from an
    instant's frame contribute nothing)."""
    r = rate_at(samples, frame, step, bucket, extrapolate)
    keys = [F.col("metric")] + [F.col("labels")[b].alias(b) for b in by] + [F.col("eval_ts")]
    return r.groupBy(*keys).agg((F.sum("rate") * F.lit(factor)).alias("value"))


def instant_rate_sum(samples: DataFrame, step: str | int = "1 minute", factor: float = 1.0) -> DataFrame:
    """``sum(rate(m[step])) * factor`` per metric at evaluation instants
    on the ``step`` grid (frame = step, so each delta counts once: the
    instant ``t`` sums deltas with ts in ``(t - step, t]``). A plain
    aggregate, no window."""
    st = _interval_us(step)
    d = deltas(samples)
    t_eval = floor_div(F.col("_t") + F.lit(st - 1), st) * F.lit(st)
    return (d.groupBy("metric", t_eval.alias("_te"))
            .agg((F.sum("delta") / F.lit(st / US) * F.lit(factor)).alias("value"))
            .select("metric", F.timestamp_micros("_te").cast("timestamp_ntz").alias("eval_ts"), "value"))


def per_window_count(events: DataFrame, ts_col: str, width: str, *keys: str) -> DataFrame:
    """W2 table form: rows per tumbling ``width`` window and key."""
    return (events.groupBy(F.window(F.col(ts_col), width).alias("w"), *keys)
            .agg(F.count(F.lit(1)).alias("n"))
            .select(F.col("w.start").alias("window_start"), *keys, "n"))


def running_total(batches: DataFrame, layer: str = "layer", batch: str = "batch_id", n: str = "n",
                  bucket: int = 4096) -> DataFrame:
    """Cumulative rows per layer over batches (one row per (layer, batch)).

    Batches are summed by ``bucket`` numbers; a window over these sums gives
    what came before each bucket, and a window inside the bucket the rest, so no
    window holds more than ``bucket`` batches or a layer's buckets.
    """
    rows = batches.withColumn("_b", floor_div(F.col(batch), bucket))
    sums = rows.groupBy(layer, "_b").agg(F.sum(n).alias("_s"))
    earlier = Window.partitionBy(layer).orderBy("_b").rowsBetween(Window.unboundedPreceding, -1)
    sums = sums.select(layer, "_b", F.coalesce(F.sum("_s").over(earlier), F.lit(0)).alias("_before"))
    inside = Window.partitionBy(layer, "_b").orderBy(batch).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return (rows.join(sums, [layer, "_b"]).withColumn("running_total", F.col("_before") + F.sum(n).over(inside))
            .drop("_b", "_before").select(*batches.columns, "running_total"))


# Dashboard threshold steps (None = base colour).
STEPS_UP = [(None, "red"), (1, "green")]
STEPS_CPU = [(None, "green"), (70, "orange"), (90, "red")]
STEPS_RAM = [(None, "green"), (10, "orange"), (14, "red")]


def with_status(df: DataFrame, value_col: str, steps, out: str = "status") -> DataFrame:
    """C20: threshold colour of ``value_col``."""
    return df.withColumn(out, status_expr(F.col(value_col), steps))
