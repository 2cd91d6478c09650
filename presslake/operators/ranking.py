"""Global row numbers without a single-partition window (T1 ``rang``).

``row_number() over (order by ...)`` with no partition runs in one task.
Here rows are sorted by ranges (sampled boundaries, like a distributed
sort), numbered inside each range, and shifted by the number of rows in all
earlier ranges. The numbered rows are checkpointed before both are read from
them: planned twice, the two range exchanges could sample different
boundaries, and the shifts would not fit the rows.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from presslake.session import ensure_checkpoint_dir

#: A row's number holds its range above so many bits and its place in it below.
_PLACE_BITS = 33


def global_row_number(df: DataFrame, order: Sequence[Column], out: str = "rang",
                      partitions: int | None = None) -> DataFrame:
    """``df`` plus ``out`` = 1-based position in the total order ``order``
    (make ``order`` total, e.g. end with a unique column, for a
    deterministic numbering). Runs one job that writes the sorted rows to the
    checkpoint folder."""
    ensure_checkpoint_dir(df.sparkSession)
    ranged = df.repartitionByRange(partitions, *order) if partitions else df.repartitionByRange(*order)
    rows = ranged.sortWithinPartitions(*order).withColumn("_place", F.monotonically_increasing_id()).checkpoint()
    part = F.shiftright("_place", _PLACE_BITS)
    sizes = rows.groupBy(part.alias("_part")).agg(F.count(F.lit(1)).alias("_n"))
    # one row per range: the running total is a window over as many rows as there are partitions
    offsets = sizes.select("_part", (F.sum("_n").over(Window.orderBy("_part")) - F.col("_n")).alias("_before"))
    place = F.col("_place").bitwiseAND((1 << _PLACE_BITS) - 1)
    return (rows.withColumn("_part", part).join(F.broadcast(offsets), "_part")
            .withColumn(out, F.col("_before") + place + 1).drop("_part", "_place", "_before"))
