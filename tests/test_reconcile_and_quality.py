from __future__ import annotations

from helpers import frame, rows, texts
from pyspark.sql import functions as F

from starmart.operators import quality, reconcile

HOURS = ("route_code string, start_hour string, trips_total string, avg_fare_amount double, "
         "avg_trip_duration_sec double, avg_distance_m double")


def sides(spark):
    left = frame(spark, HOURS, ("A", "2024-01-01 01:00:00", "3", 2.0, 60.0, 1.0),
                 ("A", "2024-01-01 02:00:00", "5", 4.0, None, 1.0), ("B", "2024-01-01 01:00:00", "x", 1.0, 1.0, 1.0))
    right = frame(spark, HOURS, ("A", "2024-01-01 01:00:00", "2", 2.5, 30.0, 1.0),
                  ("A", "2024-01-01 02:00:00", "5", 4.0, 10.0, 1.0), ("C", "2024-01-01 01:00:00", "1", 1.0, 1.0, 1.0))
    return left, right


def test_differences_of_matched_rows(spark):
    got = texts(reconcile.compare(*sides(spark)), "route_code", "start_hour", "trips_diff", "fare_diff", "duration_diff")
    assert got == [("A", "2024-01-01 01:00:00", "1", "-0.5", "30.0"), ("A", "2024-01-01 02:00:00", "0", "0.0", None)]


def test_full_outer_shows_rows_of_one_side(spark):
    got = rows(reconcile.compare(*sides(spark), how="full_outer"), "route_code", "status", "trips_diff")
    assert got == [("A", "matched", 0), ("A", "matched", 1), ("B", "left_only", None), ("C", "right_only", None)]


def test_equal_sources_have_no_difference(spark):
    left, _ = sides(spark)
    same = reconcile.compare(left, left, how="full_outer")
    assert rows(same.filter("status <> 'matched' or trips_diff <> 0 or fare_diff <> 0")) == []
    assert same.count() == left.count()


def test_suffixes_and_columns(spark):
    columns = reconcile.compare(*sides(spark), suffixes=("_star", "_mart")).columns
    assert columns[:2] == ["route_code", "start_hour"] and "trips_total_star" in columns and "avg_distance_m_mart" in columns


def test_series(spark):
    compared = reconcile.compare(*sides(spark))
    hours = reconcile.hourly_series(compared, 1)
    assert texts(hours) == [("2024-01-01 02:00:00", "5", "5")]
    assert rows(reconcile.route_series(compared)) == [("A", 8, 7, 3.0, 3.25, 60.0, 20.0, 1)]


def test_not_null_and_lengths(spark):
    df = frame(spark, "a string, b int", ("x", None), (None, None), ("long", 1))
    assert rows(quality.not_null(df, ["a", "b"])) == [("a", 1), ("b", 2)]
    assert rows(quality.length_violations(df, {"a": 3})) == [("a", 1)]
    assert rows(quality.too_long(df, "a", 3, ["b"])) == [(1, 4)]


def test_unique(spark):
    df = frame(spark, "a int, b int", (1, 1), (1, 1), (1, 2), (None, 1), (None, 1))
    assert rows(quality.unique(df, ["a", "b"])) == [(1, 1, 2), (None, 1, 2)]


def test_foreign_key_ignores_null_and_counts_rows(spark):
    child = frame(spark, "k int", (1,), (2,), (2,), (None,))
    parent = frame(spark, "p int", (1,), (None,))
    assert rows(quality.foreign_key(child, "k", parent, "p", "fk")) == [("fk", 2)]
    assert rows(quality.foreign_key(child.filter("k = 1"), "k", parent, "p", "fk")) == [("fk", 0)]


def test_precision(spark):
    df = frame(spark, "v double", (99.994,), (99.995,), (None,))
    assert rows(df.select("v", quality.fits_decimal(F.col("v"), 4, 2))) == [(99.994, True), (99.995, False), (None, None)]


def test_gate(spark):
    fact = frame(spark, "route_sk bigint", (1,), (None,))
    routes = frame(spark, "is_current boolean", (True,), (False,))
    assert rows(quality.gate_counts(fact, routes, fact)) == [(2, 1, 1, 2, True)]
    assert rows(quality.gate_counts(fact, routes, fact.limit(0)), "passed") == [(False,)]
