import hashlib

import duckdb
import pytest
from pyspark.sql import functions as F

import presslake.llm.warc as warc
from presslake.llm.queries import ORACLE_SQL, QUERIES

SCHEMA = "page_id long, url string, html string, n string, idx string, record string, hash string"


def pages(spark, n):
    return spark.createDataFrame([(i, f"https://x.org/{i}", f"<p>page é {i % 7}</p>" * (i % 5), "a", "b", "c", "d")
                                  for i in range(n)], SCHEMA)


def brute_record(i, url, html):
    body = (html or "").encode()
    head = (f"WARC/1.0\r\nWARC-Type: resource\r\nWARC-Record-ID: <urn:page:{'' if i is None else i}>\r\n"
            f"WARC-Target-URI: {url or ''}\r\nContent-Type: text/html\r\nContent-Length: {len(body)}\r\n\r\n")
    return head.encode() + body + b"\r\n\r\n"




@pytest.fixture()
def small(monkeypatch):
    monkeypatch.setattr(warc, "FAN_OUT", 3)
    monkeypatch.setattr(warc, "SHARD_LEVEL", 2)


@pytest.mark.parametrize("n", [1, 2, 9, 10, 40])
def test_tree_root_and_ranges(spark, small, n):
    tree = warc.tree(warc.leaves(warc.archive(pages(spark, n))), "t")
    records = [brute_record(x.page_id, x.url, x.html) for x in sorted(pages(spark, n).collect())]
    ranges, at = [], 0
    for i, r in enumerate(records):
        at = 0 if i % 9 == 0 else at
        ranges.append((at, at + len(r)))
        at += len(r)
    leaves = sorted(tree[0].collect())
    assert [(x.start, x.end) for x in leaves] == ranges and [x.shard for x in leaves] == [i // 9 for i in range(n)]
    assert [x.hash for x in leaves] == [hashlib.sha256(r).hexdigest() for r in records]
    # the tree climbs by index, so a lone node is hashed again on its way up
    assert tree[-1].count() == 1
    if n > 1:
        level = [(x.hash, (x.start, x.end)) for x in leaves]
        for _ in tree[1:]:
            groups = [level[i:i + 3] for i in range(0, len(level), 3)]
            level = [(hashlib.sha256(",".join(f"{h}:{a}:{b}" for h, (a, b) in g).encode()).hexdigest(),
                      (min(r[0] for _, r in g), max(r[1] for _, r in g))) for g in groups]
        assert tree[-1].first().hash == level[0][0]


@pytest.mark.parametrize("changed,lost", [([], []), ([0], []), ([], [39]), ([3, 4, 5, 22], [8, 9, 30]), (list(range(40)), [])])
def test_audit_finds_exactly_the_damage(spark, small, changed, lost):
    kept = warc.archive(pages(spark, 40))
    manifest = warc.tree(warc.leaves(kept), "m")
    replica = kept.where(~F.col("n").isin(lost)).withColumn(
        "record", F.when(F.col("n").isin(changed), F.concat("record", F.lit("x"))).otherwise(F.col("record")))
    other = warc.tree(warc.replica_leaves(manifest[0].withColumnRenamed("idx", "n"), replica), "r")
    got = {x.n: x.state for x in warc.audit(manifest, other).collect()}
    assert got == {**{i: "changed" for i in changed}, **{i: "missing" for i in lost}}


def test_edge_rows(spark, small):
    long = "<p>" + "x" * 2_000_000 + "</p>"
    rows = [(1, "u", "h"), (1, "u", "h"), (None, None, None), (2, None, long), (3, "a\r\nX-Injected: 1", ""), (3, "b", None)]
    df = spark.createDataFrame([(*r, "", "", "", "") for r in rows], SCHEMA)
    kept = warc.archive(df)
    assert sorted(x.n for x in kept.collect()) == list(range(6))
    found = {x.record for x in kept.collect()}
    assert brute_record(1, "u", "h").decode() in found and brute_record(2, None, long).decode() in found
    assert brute_record(3, "a X-Injected: 1", "").decode() in found and brute_record(None, None, None).decode() in found
    manifest = warc.tree(warc.leaves(kept), "m")
    assert warc.audit(manifest, manifest).count() == 0
    with pytest.raises(ValueError):
        warc.audit(manifest, manifest[:-1])
    none = warc.tree(warc.leaves(warc.archive(df.limit(0))), "e")
    assert warc.audit(none, none).count() == 0


def test_equal_replicas_stop_at_the_root(spark, small):
    manifest = warc.tree(warc.leaves(warc.archive(pages(spark, 30))), "m")
    assert len(manifest) == 5 and [x.count() for x in manifest] == [30, 10, 4, 2, 1]


def test_query_against_sql(spark, sf):
    got = QUERIES["op8_warc_fixity"](spark, sf)
    con = duckdb.connect()
    con.execute(f"CREATE VIEW pages AS SELECT * FROM '{sf}/pages.parquet'")
    assert sorted(map(tuple, got.collect())) == sorted(con.execute(ORACLE_SQL["op8_warc_fixity"]).fetchall())


def test_audit_of_what_a_replica_holds_beyond_the_manifest(spark, small):
    kept = warc.archive(pages(spark, 40)).select("n", "record")
    manifest = warc.tree(warc.leaves(kept), "m")
    places = manifest[0].withColumnRenamed("idx", "n")

    def found(replica):
        return sorted((x.n, x.state) for x in warc.audit(manifest, warc.tree(warc.replica_leaves(places, replica), "r")).collect())
    added = spark.createDataFrame([(n, f"new {n}") for n in (40, 41, 100)], "n long, record string")
    assert found(kept.unionByName(added)) == [(40, "extra"), (41, "extra"), (100, "extra")]
    twice = kept.unionByName(kept.where("n IN (3, 39)")).unionByName(kept.where("n = 3"))
    assert found(twice) == [(3, "extra"), (39, "extra")]
    other = kept.withColumn("record", F.when(F.col("n") == 3, F.lit("x")).otherwise(F.col("record"))).unionByName(added.selectExpr("3L", "record").limit(1).toDF("n", "record"))
    assert found(other) == [(3, "changed"), (3, "extra")]
    assert found(kept.unionByName(spark.createDataFrame([(None, "no place")], "n long, record string"))) == [(40, "extra")]
    # a record put in at 30 moves those behind it
    put = kept.withColumn("n", F.col("n") + (F.col("n") >= 30).cast("long")).unionByName(added.selectExpr("30L", "record").limit(1).toDF("n", "record"))
    assert found(put) == [(n, "shifted") for n in range(30, 40)] + [(40, "extra")]
    # the replica's own index of ranges
    index = kept.join(places.select("n", "start", "end"), "n")
    assert found(index) == []
    assert found(index.withColumn("start", F.col("start") + (F.col("n") == 7).cast("long"))) == [(7, "shifted")]
