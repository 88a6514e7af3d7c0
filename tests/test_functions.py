"""Scalar functions: health table, display text, truncation and padding."""

import datetime as dt

from pyspark.sql import functions as F

from tidemark.functions import scalars as S

NOW = dt.datetime(2026, 8, 19, 12, 0, 0)


def test_health_table(spark):
    m = dt.timedelta(minutes=1)
    cases = [  # completed, status, threshold, healthy, minutes
        (None, "Success", 60, False, None),
        (NOW - 30 * m, "Failed", 60, False, 30.0),
        (NOW - 30 * m, "failed", 60, False, 30.0),
        (NOW - 30 * m, "Success", 60, True, 30.0),
        (NOW - 30 * m, "NoNewData", 60, True, 30.0),
        (NOW - 60 * m, "Success", 60, True, 60.0),
        (NOW - 61 * m, "Success", 60, False, 61.0),
        (NOW - 30 * m, "", 60, False, 30.0),
        (NOW - 30 * m, None, 60, False, 30.0),
    ]
    df = spark.createDataFrame([(c[0], c[1], c[2]) for c in cases], "completed timestamp_ntz, status string, th int")
    out = df.select(S.is_healthy("completed", "status", F.col("th"), NOW).alias("h"),
                    S.minutes_since("completed", NOW).alias("m")).collect()
    assert [r.h for r in out] == [c[3] for c in cases]
    assert [r.m for r in out] == [c[4] for c in cases]


def test_display_text(spark):
    df = spark.createDataFrame([(None, None, None, None, None), (0.5, 1, 0, 2.346, "a\nb"),
                                (59.4, 5, 9, None, ""), (150.0, None, 7, 1.0, "x")],
                               "m double, lo long, hi long, d double, e string")
    out = df.select(S.age_text("m").alias("a"), S.range_text("lo", "hi").alias("r"),
                    S.seconds_text("d").alias("s"), S.first_line("e").alias("e")).collect()
    assert [r.a for r in out] == ["never", "just now", "59 min ago", "2.5 hr ago"]
    assert [r.r for r in out] == ["—", "1", "5–9", "—–7"]
    assert [r.s for r in out] == ["— s", "2.35 s", "— s", "1.00 s"]
    assert [r.e for r in out] == ["—", "a", "—", "x"]


def test_truncate_pad_concat(spark):
    df = spark.createDataFrame([("ABCDEFGHIJKLMNOPQRS", 123456789, None)], "s string, n long, x string")
    r = df.select(S.truncate_text("s", 10).alias("t10"), S.truncate_text("s", 16).alias("t16"),
                  S.zero_pad("n", 8).alias("p"), S.concat_text("a", F.col("x"), "b").alias("c"),
                  S.dmy(F.lit("2024-03-05").cast("timestamp_ntz")).alias("d")).first()
    assert (r.t10, r.t16, r.p, r.c, r.d) == ("ABCDEFGHIJ", "ABCDEFGHIJKLMNOP", "23456789", "ab", "05/03/2024")
