"""The set of keys that were ever taken, in buckets.

A key lies in bucket ``pmod(xxhash64(key), n)``; every run or epoch adds the partition ``bucket=<b>/epoch=<e>``. A batch reads only the
buckets of its own keys, as partition filters, and compaction merges the epochs of one bucket at a time. The table is a
set: reading a key twice, from an epoch and from what it was merged into, changes no result. So compaction may run
beside readers: merged epochs stay until the next compaction, for readers that have listed them.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from presslake.sinks.files import STAGING, Files

#: Buckets of a new table; a table's own number is kept beside it.
BUCKETS = 64
_META = "_buckets"


class SeenTable:
    """``key`` strings seen by numbered epochs (not negative), under ``path``."""

    def __init__(self, spark: SparkSession, path: str, buckets: int = BUCKETS, key: str = "url"):
        self.spark, self.path, self.key, self.files = spark, path.rstrip("/"), key, Files(spark)
        meta = f"{self.path}/{_META}"
        if self.files.exists(meta):
            buckets = int(self.files.read_text(meta))
        elif self.exists():
            raise RuntimeError(f"the table at {path} does not say its number of buckets")
        self.buckets = buckets

    def exists(self) -> bool:
        return self.files.exists(self.path)

    def _bucket(self, key):
        return F.pmod(F.xxhash64(key.cast("string")), F.lit(self.buckets)).cast("int")

    def _all(self) -> DataFrame:
        return self.spark.read.schema(f"{self.key} string, bucket int, epoch long").parquet(self.path)

    def add(self, keys: DataFrame, epoch: int) -> None:
        """Add the keys of one epoch, in one file a bucket. Adding an epoch again replaces it."""
        if not self.exists():
            self.files.write_text(f"{self.path}/{_META}", str(self.buckets))
        rows = keys.select(F.col(self.key).cast("string").alias(self.key)).distinct()
        rows = rows.withColumns({"bucket": self._bucket(F.col(self.key)), "epoch": F.lit(epoch).cast("long")})
        (rows.repartition("bucket").write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
         .partitionBy("bucket", "epoch").parquet(self.path))

    def read(self, keys: DataFrame | None = None, before: int | None = None) -> DataFrame:
        """The keys seen (by epochs earlier than ``before``), each maybe more than once. With ``keys``, only the buckets that these lie
        in are read: their numbers, at most the number of buckets, are gathered and become partition filters."""
        if not self.exists():
            return self.spark.createDataFrame([], f"{self.key} string")
        rows, buckets = self._all(), self._buckets()
        if before is not None:
            rows = rows.where(F.col("epoch") < before)
        if keys is not None:
            found = {r.b for r in keys.select(self._bucket(F.col(self.key)).alias("b")).distinct().collect()}
            buckets = [b for b in buckets if b in found]
            rows = rows.where(F.col("bucket").isin(buckets))
        # of a compacted bucket, the merged part and what is later than it
        reach = {b: r for b in buckets if (r := self._parts(b)[1]) >= 0}
        if reach:
            upto = F.coalesce(F.create_map(*[F.lit(x) for pair in reach.items() for x in pair])[F.col("bucket")], F.lit(-1))
            rows = rows.where((F.col("epoch") > upto) | (F.col("epoch") == -2 - upto))
        return rows.select(self.key)

    def _buckets(self) -> list[int]:
        return sorted(int(n[7:]) for n in self.files.names(self.path) if n.startswith("bucket="))

    def _parts(self, bucket: int) -> tuple[list[int], int]:
        """The epochs of a bucket, and the last one that a merged part holds (-1: none)."""
        epochs = sorted(int(n[6:]) for n in self.files.names(f"{self.path}/bucket={bucket}") if n.startswith("epoch="))
        return epochs, max((-2 - e for e in epochs if e < 0), default=-1)

    def unseen(self, candidates: DataFrame, before: int | None = None) -> DataFrame:
        """Candidates whose key was never seen. A NULL key is never seen."""
        return candidates.join(self.read(candidates, before), self.key, "left_anti")

    def compact(self, upto: int, least: int = 8) -> list[int]:
        """Merge the epochs up to ``upto`` of every bucket that holds at least ``least`` of them; returns the buckets merged.

        The merged part is ``epoch=<-2 - upto>``, published by one rename; the parts it replaces go at the bucket's next
        compaction. Run by one process at a time, beside any readers and beside writers of later epochs.
        """
        done = []
        for bucket in self._buckets():
            folder = f"{self.path}/bucket={bucket}"
            epochs, reach = self._parts(bucket)
            stale = [e for e in epochs if 0 <= e <= reach or e < 0 and -2 - e < reach]
            fresh = [e for e in epochs if reach < e <= upto]
            if len(fresh) < least:
                continue
            for e in stale:
                self.files.delete(f"{folder}/epoch={e}")
            part = f"epoch={-2 - max(fresh)}"
            staged = f"{folder}/{STAGING}/{part}"
            sources = [f"{folder}/epoch={e}" for e in fresh + [e for e in epochs if e == -2 - reach]]
            (self.spark.read.schema(f"{self.key} string").parquet(*sources).distinct()
             .write.mode("overwrite").parquet(staged))
            self.files.publish(staged, f"{folder}/{part}")
            done.append(bucket)
        return done
