from __future__ import annotations

import uuid

import pytest
from helpers import frame, rows, texts
from pyspark.sql import functions as F

from starmart.functions import fingerprint, numeric, time as tm


def test_keys_lose_leading_zeros(spark):
    df = frame(spark, "ts timestamp_ntz", ("2024-01-02 05:00:03.9",), (None,))
    got = rows(df.select(tm.date_key("ts"), tm.time_key("ts")))
    assert got == [(20240102, 50003), (None, None)]


def test_keys_to_timestamp_is_null_for_bad_keys(spark):
    df = frame(
        spark, "d int, t int", (20240102, 50003), (20240102, None), (None, 1), (20240231, 1),
        (20240102, 246060), (20240102, 6000), (20240102, -1), (0, 0),
    )
    got = texts(df.select("d", "t", tm.keys_to_timestamp("d", "t").alias("ts")))
    assert [r for r in got if r[2] is not None] == [("20240102", "50003", "2024-01-02 05:00:03")]


def test_duration_uses_whole_seconds(spark):
    df = frame(
        spark, "a timestamp_ntz, b timestamp_ntz",
        ("2024-01-01 00:00:00.900", "2024-01-01 00:00:02.100"),
        ("2024-01-02 00:00:00", "2024-01-01 00:00:00"), (None, "2024-01-01 00:00:00"),
    )
    assert rows(df.select(tm.duration_sec("a", "b"))) == [(-86400,), (2,), (None,)]


def test_zone_of_the_session_does_not_matter(spark):
    """Around the clock change of a zone with daylight saving."""
    df = frame(spark, "a timestamp_ntz, b timestamp_ntz", ("2024-03-10 01:30:00", "2024-03-10 03:30:00"))
    exprs = [tm.duration_sec("a", "b"), tm.time_key("a"), tm.hour_start("b").cast("string"),
             tm.keys_to_timestamp("20240310", "23000").cast("string"), tm.week_start("a").cast("string")]
    try:
        spark.conf.set("spark.sql.session.timeZone", "America/New_York")
        got = rows(df.select(*exprs))
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
    assert got == [(7200, 13000, "2024-03-10 03:00:00", "2024-03-10 02:30:00", "2024-03-04")]


def test_week_starts(spark):
    df = frame(spark, "d date", ("2024-01-07",), ("2024-01-08",))
    got = texts(df.select("d", tm.week_start("d").alias("m"), tm.week_start("d", "sunday").alias("s")))
    assert got == [("2024-01-07", "2024-01-01", "2024-01-07"), ("2024-01-08", "2024-01-08", "2024-01-07")]
    with pytest.raises(ValueError):
        tm.week_start("d", "friday")


def test_rounding_is_half_away_from_zero(spark):
    df = frame(spark, "v double", (0.125,), (1.005,), (-0.125,), (None,))
    assert rows(df.select("v", numeric.rounded("v", 2))) == [
        (-0.125, -0.13), (0.125, 0.13), (1.005, 1.01), (None, None)]


def test_mean_of_nothing_is_null(spark):
    df = frame(spark, "k int, v int", (1, None), (2, 1), (2, 2), (2, None))
    assert rows(df.groupBy("k").agg(numeric.mean("v", 2))) == [(1, None), (2, 1.5)]


def test_coerce_nulls_what_does_not_fit(spark):
    df = frame(spark, "a string, b string", ("1.5", "2024-01-01 00:00:00"), ("x", "y"))
    got = texts(numeric.coerce(df, {"a": "double", "b": "timestamp_ntz", "missing": "int"}))
    assert got == [("1.5", "2024-01-01 00:00:00"), (None, None)]


def test_uuid5_matches_python(spark):
    names = ["", "S1", "STOP-0001,STOP-0002", "Ünïcode,✓"] + [f"r{i}" for i in range(60)]
    df = spark.createDataFrame([(n,) for n in names], "n string")
    got = dict(rows(df.select("n", fingerprint.uuid5_hex(F.col("n")))))
    assert got == {n: uuid.uuid5(uuid.NAMESPACE_DNS, n).hex for n in names}
