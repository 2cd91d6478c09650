"""K1, P1, P2, P9, C16, C17 and the silver filter F1 (semantics note 2)."""

import datetime as dt

from presslake.operators.messages import decode_messages, encode_messages, to_bronze
from presslake.operators.silver import to_silver

TS = dt.datetime(2026, 5, 19, 12, 0, 0)


def _msgs(spark, values):
    rows = [(None if v is None else bytearray(v.encode("utf-8")), TS, i) for i, v in enumerate(values)]
    return spark.createDataFrame(rows, "value binary, timestamp timestamp, offset long")


def test_decode_edge_messages(spark):
    values = [
        '{"titre":"T","auteur":"A","date_publication":"2026-05-19","categorie":"c","contenu":"x","source":"S","url":"u"}',
        '{"titre":"T2","url":"u2","source":"S","scraped_at":"2026-05-19T00:00:00"}',
        '{"url":"u3","source":"S"}',
        "not json",
        None,
        '{"titre":"T5","url":12,"source":"S"}',
        '{"titre":{"a":1},"url":"u6","source":"S"}',
        '[{"titre":"T7","url":"u7"}]',
    ]
    rows = decode_messages(_msgs(spark, values)).orderBy("offset").collect()
    assert len(rows) == 8
    assert rows[0].titre == "T" and rows[0].kafka_timestamp == TS
    assert "scraped_at" not in rows[1].asDict()
    assert rows[2].titre is None
    assert rows[3].titre is None and rows[3].url is None       # malformed: row kept, fields NULL
    assert rows[4].titre is None
    assert rows[5].url == "12"                                  # number keeps its text
    assert rows[6].titre == '{"a":1}'                           # object keeps its JSON text
    assert rows[7].titre is None                                # top-level array
    silver = to_silver(decode_messages(_msgs(spark, values)), with_ingestion=False)
    assert sorted(r.url for r in silver.collect()) == ["12", "u", "u2", "u6"]


def test_roundtrip_keeps_non_ascii(spark):
    arts = spark.createDataFrame([("Été à Zürich — 東京", "a", None, "c", "x", "S", "u")],
                                 "titre string, auteur string, date_publication string, categorie string, "
                                 "contenu string, source string, url string")
    enc = encode_messages(arts)
    raw = bytes(enc.first().value).decode("utf-8")
    assert "Été à Zürich — 東京" in raw and "date_publication" not in raw   # NULL fields omitted
    back = decode_messages(enc.withColumn("timestamp", __import__("pyspark.sql.functions", fromlist=["x"]).lit(TS)))
    assert back.first().titre == "Été à Zürich — 東京"


def test_bronze_stamp(spark):
    b = to_bronze(_msgs(spark, ['{"titre":"T","url":"u","source":"S"}']), ingestion_time="2026-01-01 00:00:00")
    assert b.first().ingestion_time == dt.datetime(2026, 1, 1)
