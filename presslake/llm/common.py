"""Shared helpers: word rule, shared folder, Arrow plumbing, ordered numbering."""

from __future__ import annotations

import ctypes
import uuid
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from presslake.session import checkpoint_dir

# Fixed value: a word is a run of characters outside these six.
SPACES = " \t\n\x0b\x0c\r"
SPACE_RUN = r"[\x20\x09-\x0D]+"
WORD = r"[^\x20\x09-\x0D]+"

#: Rows of texts per Arrow batch that the text operators cut further by size.
TEXT_SLICE_CHARS = 1 << 22


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def shared_path(spark: SparkSession, name: str) -> str:
    """A new folder below the cluster's ``spark.checkpoint.dir``."""
    return f"{checkpoint_dir(spark)}/{name}-{uuid.uuid4().hex}"


def written(df: DataFrame, name: str) -> DataFrame:
    """``df`` written once as Parquet in the shared folder, and read back.

    Cuts the lineage: readers never repeat the work behind ``df``, and a lost
    executor costs only the tasks it was running.
    """
    spark = df.sparkSession
    path = shared_path(spark, name)
    df.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def word_count(text: Column) -> Column:
    """Number of words; NULL and blank texts have none."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def byte_words(text: bytes, slice_bytes: int = 1 << 20) -> Iterator[list[bytes]]:
    """The words of a UTF-8 text, in lists of bounded size (a long text is cut
    between words; ``bytes.split`` splits at exactly the six ASCII spaces)."""
    if len(text) <= slice_bytes:
        yield text.split()
        return
    start, n = 0, len(text)
    while start < n:
        end = min(n, start + slice_bytes)
        while end < n and text[end] not in b" \t\n\x0b\x0c\r":
            end += 1
        yield text[start:end].split()
        start = end


def map_rows(df: DataFrame, fn: Callable[[pa.RecordBatch], Iterator[pa.RecordBatch] | pa.RecordBatch],
             schema: str) -> DataFrame:
    """``mapInArrow`` with one function per batch."""
    def run(batches):
        for b in batches:
            out = fn(b)
            if isinstance(out, pa.RecordBatch):
                yield out
            else:
                yield from out
            give_back()
    return df.mapInArrow(run, schema)


def give_back() -> None:
    """Return memory that is no longer used, of Arrow's pool and (where the C library
    can) of the heap: a Python worker outlives its tasks."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim is not None:
        trim(0)


def slices(batch: pa.RecordBatch, text: str = "text", limit: int = TEXT_SLICE_CHARS) -> Iterator[pa.RecordBatch]:
    """Cut a batch so that no slice holds much more than ``limit`` bytes of text."""
    col = batch.column(batch.schema.get_field_index(text))
    import pyarrow.compute as pc
    sizes = pc.fill_null(pc.binary_length(col), 0).to_pylist()
    start = total = 0
    for i, s in enumerate(sizes):
        if i > start and total + s > limit:
            yield batch.slice(start, i - start)
            start, total = i, 0
        total += s
    if start < len(sizes):
        yield batch.slice(start)


def numbered(df: DataFrame, order: list[Column], name: str) -> DataFrame:
    """``df`` with ``n``, each row's place (from 0) in the given order, which must be total.

    Ranges of the order are sorted and numbered by task and written once; a range's
    place is the number of rows in the ranges before it, one number a partition.
    """
    rows = df.repartitionByRange(*order).sortWithinPartitions(*order)
    rows = written(rows.withColumn("_n", F.monotonically_increasing_id()), name)
    part = F.shiftright("_n", 33)
    counts = rows.groupBy(part.alias("part")).count().orderBy("part").collect()
    starts, total = [], 0
    for part_id, n in counts:
        starts.append((part_id, total))
        total += n
    starts = df.sparkSession.createDataFrame(starts, "_part long, _start long")
    place = F.col("_n").bitwiseAND((1 << 33) - 1)
    return (rows.withColumn("_part", part).join(F.broadcast(starts), "_part")
            .withColumn("n", F.col("_start") + place).drop("_n", "_part", "_start"))
