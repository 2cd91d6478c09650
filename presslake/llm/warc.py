"""WARC fixity: Merkle trees over records and offset ranges, compared between replicas."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from presslake.llm.common import numbered, read, written

#: Children of a tree node; a shard file is a whole node of the level ``SHARD_LEVEL``.
FAN_OUT = 16
SHARD_LEVEL = 3


def record(url: Column, html: Column, page_id: Column) -> Column:
    """One WARC resource record as text; line ends in a header value become spaces."""
    def value(c: Column) -> Column:
        return F.regexp_replace(F.coalesce(c.cast("string"), F.lit("")), r"[\r\n]+", " ")
    body = F.coalesce(html.cast("string"), F.lit(""))
    return F.concat(
        F.lit("WARC/1.0\r\nWARC-Type: resource\r\nWARC-Record-ID: <urn:page:"), value(page_id),
        F.lit(">\r\nWARC-Target-URI: "), value(url), F.lit("\r\nContent-Type: text/html\r\nContent-Length: "),
        F.octet_length(body).cast("string"), F.lit("\r\n\r\n"), body, F.lit("\r\n\r\n"))


def archive(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """``(n, id, record)``: every page as a record, numbered by id (NULL ids first), then by
    content, and written to the shared folder in that order.

    NULL urls and pages are empty; repeated rows are records of their own; no rows
    give none; other columns are not read.
    """
    rows = pages.select(F.col(id_col).cast("long").alias("id"),
                        record(F.col(url_col), F.col(html_col), F.col(id_col)).alias("record"))
    # equal rows are told apart by where they were read, so that many of them fill several ranges
    rows = rows.withColumns({"_content": F.xxhash64("record"), "_row": F.monotonically_increasing_id()})
    return numbered(rows, [F.col("id"), F.col("_content"), F.col("_row")], "archive").drop("_content", "_row")


def leaves(records: DataFrame) -> DataFrame:
    """``(n, shard, start, end, hash)`` of the records of an archive: a shard holds
    ``FAN_OUT ** SHARD_LEVEL`` records, and a record's bytes lie at [start, end) of it."""
    size = FAN_OUT ** SHARD_LEVEL
    out = records.select("n", F.expr(f"n div {size}").alias("shard"), F.octet_length("record").cast("long").alias("length"),
                         F.sha2("record", 256).alias("hash"))
    before = Window.partitionBy("shard").orderBy("n")  # at most one shard's records
    out = out.withColumn("end", F.sum("length").over(before))
    return out.select("n", "shard", (F.col("end") - F.col("length")).alias("start"), "end", "hash")


def replica_leaves(manifest: DataFrame, records: DataFrame) -> DataFrame:
    """``(n, shard, start, end, hash, extra)`` of every place that the manifest or the
    replica has: the hash of the replica's record there, NULL where it has nothing, and
    how many further records it holds at that place.

    ``records`` has ``n`` and ``record`` and, where the replica keeps an index of its
    own, the ranges ``start`` and ``end`` that it states. Without these a missing or
    changed record does not move those behind it: a place of the manifest keeps its
    range, and one beyond it has none. Of several records at a place the manifest's own
    comes first. Records without a place are at one place after all others.
    """
    names = ["start", "end"]
    last = max(x.agg(F.max("n")).first()[0] or 0 for x in (manifest, records))
    stated = set(names) <= set(records.columns)
    held = records.select(F.coalesce(F.col("n").cast("long"), F.lit(last + 1)).alias("_n"), F.sha2("record", 256).alias("_hash"),
                          *[(F.col(c) if stated else F.lit(None)).cast("long").alias(f"_{c}") for c in names])
    # equal records of one place are counted before they meet
    held = held.groupBy("_n", "_hash", "_start", "_end").agg(F.count("*").alias("_count"))
    ranges = [F.col(f"_{c}") if stated else F.col(c) for c in names]
    ranges = [F.when(F.col("_n").isNull(), F.col(c)).otherwise(x).alias(c) for c, x in zip(names, ranges)]
    moved = ~(ranges[0].eqNullSafe(F.col("start")) & ranges[1].eqNullSafe(F.col("end")))
    first = F.min(F.struct((~F.col("hash").eqNullSafe(F.col("_hash"))).alias("other"), moved.alias("moved"),
                           F.col("_hash").alias("hash"), *ranges)).alias("first")
    both = manifest.join(held, F.col("n") == F.col("_n"), "full").withColumn("_place", F.coalesce("n", "_n"))
    both = both.groupBy("_place").agg(first, F.min("shard").alias("shard"), F.sum("_count").alias("count"))
    size = FAN_OUT ** SHARD_LEVEL
    return both.select(F.col("_place").alias("n"), F.coalesce("shard", F.expr(f"_place div {size}")).alias("shard"),
                       "first.start", "first.end", "first.hash", (F.coalesce("count", F.lit(1)) - 1).alias("extra"))


def _further(leaf_rows: DataFrame) -> list[Column]:
    """The number of further records of a leaf, NULL for none."""
    return [F.when(F.col("extra") > 0, F.col("extra"))] if "extra" in leaf_rows.columns else []


def tree(leaf_rows: DataFrame, name: str) -> list[DataFrame]:
    """Levels ``(idx, shard, start, end, hash)`` from the leaves to one root, each written once.

    A node's hash is that of its children's hashes and offset ranges in order, so
    it covers an ordered range of its shard; above shards it covers shards in
    order (their ranges then count from each shard's start). A group holds at most
    ``FAN_OUT`` rows, and each level is that much smaller than the last.
    """
    level = written(leaf_rows.withColumnRenamed("n", "idx"), f"{name}-0")
    levels, nodes = [level], level.agg(F.max("idx")).first()[0]
    while nodes:
        child = F.concat_ws(":", F.coalesce("hash", F.lit("-")), "start", "end", *_further(level))
        kids = F.sort_array(F.collect_list(F.struct("idx", child.alias("child"))))
        level = level.groupBy(F.expr(f"idx div {FAN_OUT}").alias("idx")).agg(
            F.min("shard").alias("shard"), F.min("start").alias("start"), F.max("end").alias("end"), kids.alias("kids"))
        digest = F.sha2(F.array_join(F.transform("kids", lambda k: k["child"]), ","), 256)
        level = written(level.select("idx", "shard", "start", "end", digest.alias("hash")), f"{name}-{len(levels)}")
        levels.append(level)
        nodes //= FAN_OUT
    return levels


def audit(good: list[DataFrame], other: list[DataFrame]) -> DataFrame:
    """``(n, shard, start, end, state)`` of the places in which two trees differ:
    ``missing`` where the other has nothing, ``changed`` where it has other bytes,
    ``shifted`` where it has the bytes in another range or at another differing place,
    and ``extra``, in a row of its own, where it has records more than the first.

    Roots are compared first; below a node only the children of mismatching nodes
    are read, so equal replicas cost one comparison and a few damaged records
    a path each. Nodes that only one tree has mismatch, so the other may be larger.
    """
    if len(good) > len(other):
        raise ValueError("the other tree has at least the levels of the first")
    wrong = None
    for k in range(len(good) - 1, -1, -1):
        further = F.coalesce(*_further(other[k]), F.lit(0)).alias("_extra")
        ours = good[k]
        theirs = other[k].select(*[F.col(c).alias(f"_{c}") for c in ("idx", "shard", "start", "end", "hash")], further)
        if wrong is not None:
            parents = wrong.select(F.col("idx").alias("_parent")).distinct()
            ours = ours.join(parents, F.expr(f"idx div {FAN_OUT}") == F.col("_parent"), "left_semi")
            theirs = theirs.join(parents, F.expr(f"_idx div {FAN_OUT}") == F.col("_parent"), "left_semi")
        met = ours.join(theirs, ours["idx"] == theirs["_idx"], "full")
        same = F.col("hash").eqNullSafe(F.col("_hash"))
        moved = same & ~(F.col("start").eqNullSafe(F.col("_start")) & F.col("end").eqNullSafe(F.col("_end")))
        state = (F.when(F.col("idx").isNull(), "extra").when(~same & F.col("_hash").isNull(), "missing")
                 .when(~same, "changed").when(moved, "shifted"))
        more = F.when(F.col("idx").isNotNull() & (F.col("_extra") > 0), "extra")
        met = met.withColumn("state", F.explode(F.array_compact(F.array(state, more))))
        wrong = written(met.select(*[F.coalesce(c, f"_{c}").alias(c) for c in ("idx", "shard", "start", "end")],
                                   "hash", "_hash", "state"), f"mismatch-{k}")
    # bytes that a differing place of the other holds have not been lost
    there = wrong.where("_hash IS NOT NULL AND NOT hash <=> _hash").select(F.col("_hash").alias("_there")).distinct()
    found = wrong.join(there, F.col("hash") == F.col("_there"), "left")
    gone = F.col("state").isin("missing", "changed") & F.col("_there").isNotNull()
    return found.select(F.col("idx").alias("n"), "shard", "start", "end", F.when(gone, "shifted").otherwise(F.col("state")).alias("state"))


def op8_warc_fixity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All of ``pages`` as an archive, audited against a replica with known damage:
    a byte changed where the id leaves 7 by 101, the record lost where it leaves 13 by 211."""
    kept = archive(read(spark, sf_dir, "pages"))
    manifest = tree(leaves(kept), "archive-tree")
    lost, hurt = F.col("id") % 211 == 13, F.col("id") % 101 == 7
    replica = kept.where(~F.coalesce(lost, F.lit(False)))
    replica = replica.withColumn("record", F.when(hurt, F.overlay("record", F.lit("?"), F.lit(1))).otherwise(F.col("record")))
    found = audit(manifest, tree(replica_leaves(manifest[0].withColumnRenamed("idx", "n"), replica), "replica-tree"))
    ranges = manifest[0].withColumnRenamed("idx", "n").join(kept.select("n", F.col("id").alias("page_id")), "n")
    return (ranges.join(found.select("n", "state"), "n", "left")
            .select("page_id", "shard", "start", "end", F.col("hash").alias("record_sha256"),
                    F.coalesce("state", F.lit("ok")).alias("state")))


OP8_SQL = """
WITH r AS (
  SELECT page_id, row_number() OVER (ORDER BY page_id) - 1 AS n,
         concat('WARC/1.0', chr(13), chr(10), 'WARC-Type: resource', chr(13), chr(10),
                'WARC-Record-ID: <urn:page:', page_id, '>', chr(13), chr(10),
                'WARC-Target-URI: ', url, chr(13), chr(10), 'Content-Type: text/html', chr(13), chr(10),
                'Content-Length: ', strlen(html), chr(13), chr(10), chr(13), chr(10), html,
                chr(13), chr(10), chr(13), chr(10)) AS record
  FROM pages
), s AS (
  SELECT *, n // 4096 AS shard, sum(strlen(record)) OVER (PARTITION BY n // 4096 ORDER BY n) AS e FROM r
)
SELECT page_id, shard::BIGINT AS shard, (e - strlen(record))::BIGINT AS start, e::BIGINT AS "end",
       sha256(record) AS record_sha256,
       CASE WHEN page_id % 211 = 13 THEN 'missing' WHEN page_id % 101 = 7 THEN 'changed' ELSE 'ok' END AS state
FROM s
"""
