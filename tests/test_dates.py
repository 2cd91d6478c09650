"""Parsing and normalising date texts."""

import datetime as dt

from pyspark.sql import functions as F

from presslake.functions.dates import normalize_date, now_text, parse_date

CASES = [
    ("2026-05-19T15:43:28+00:00", dt.date(2026, 5, 19)),
    ("2026-05-19T23:43:28-04:00", dt.date(2026, 5, 20)),  # next day in UTC
    ("2026-05-19T15:43:28Z", dt.date(2026, 5, 19)),
    ("2026-05-19T15:43:28.123456", dt.date(2026, 5, 19)),
    ("2026-05-19", dt.date(2026, 5, 19)),
    ("  2026-05-19  ", dt.date(2026, 5, 19)),
    ("2026", dt.date(2026, 1, 1)),
    ("May 19, 2026", None),
    ("", None),
    ("2026-13-45", None),
    (None, None),
]


def test_parse_date(spark):
    df = spark.createDataFrame([(i, s) for i, (s, _) in enumerate(CASES)], "i int, s string")
    got = [r[0] for r in df.orderBy("i").select(parse_date(F.col("s"))).collect()]
    assert got == [d for _, d in CASES]


def test_normalize_date(spark):
    cases = [
        ("2026-05-19T15:43:28+00:00", "2026-05-19 15:43:28"),
        ("2026-05-19T23:43:28-04:00", "2026-05-19 23:43:28"),  # offset dropped: same day
        ("published 2026-05-19 15:43:28.5Z", "2026-05-19 15:43:28"),
        ("2026-05-19", "2026-05-19"),
        ("2026-05-19T15:43Z", "2026-05-19T15:43Z"),
        ("May 19, 2026", "May 19, 2026"),
        (None, None),
    ]
    df = spark.createDataFrame([(i, s) for i, (s, _) in enumerate(cases)], "i int, s string")
    got = [r[0] for r in df.orderBy("i").select(normalize_date(F.col("s"))).collect()]
    assert got == [e for _, e in cases]


def test_now_text_is_reproducible_with_as_of(spark):
    r = spark.range(1).select(now_text("yyyy-MM-dd HH:mm:ss", "2026-01-02 03:04:05").alias("a"),
                              now_text("iso", "2026-01-02 03:04:05").alias("b"),
                              now_text("iso", "2026-01-02 03:04:05.25").alias("c")).first()
    assert r.a == "2026-01-02 03:04:05"
    assert r.b == "2026-01-02T03:04:05"          # like datetime.isoformat(): no zero fraction
    assert r.c == "2026-01-02T03:04:05.250000"
