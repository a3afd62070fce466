from __future__ import annotations

import pytest
from helpers import frame, rows, texts
from pyspark.sql import functions as F

from starmart import tables as t
from starmart.operators import scd2
from starmart.operators.conform import conform
from starmart.sources.tables import ddl

AS_OF = "2024-02-01 00:00:00"
RAW = ("route_id string, route_code string, route_name string, description string, "
       "valid_from_ts timestamp_ntz, src_updated_at timestamp_ntz, src_created_at timestamp_ntz")


def staged(spark, *values):
    raw = frame(spark, RAW, *((*v, *([None] * (7 - len(v)))) for v in values))
    return conform(raw, t.ROUTE, "b", AS_OF).withColumn("default_fare_product_sk", F.lit(None).cast("bigint"))


def dim(spark, *values):
    """(sk, id, name, description, from, to, current)"""
    given = frame(
        spark, "route_sk bigint, route_id_nat string, route_name string, description string, "
        "valid_from date, valid_to date, is_current boolean", *values)
    return given.withColumn("route_code", F.col("route_id_nat")).select(
        *(c if c in (*given.columns, "route_code") else F.lit(None).cast(k).alias(c)
          for c, k in t.DIM_ROUTE_SCHEMA.items()))


def stored(spark):
    return dim(
        spark, (1, "r1", "One", "x", "2024-01-01", "9999-12-31", True),
        (2, "r2", "Two", None, "2024-01-01", "9999-12-31", True),
        (3, "r3", "Three", "x", "2023-01-01", "2023-12-31", False),
        (4, "r3", "Three b", "x", "2024-01-01", "9999-12-31", True))


def step(spark, old, *values, **policy):
    latest = scd2.latest_versions(staged(spark, *values), AS_OF)
    versions = scd2.new_versions(old, latest, AS_OF, **policy)
    return scd2.snapshot(old, versions)


def kinds(spark, null_safe, *values):
    latest = scd2.latest_versions(staged(spark, *values), AS_OF)
    return rows(scd2.change_set(stored(spark), latest, null_safe=null_safe), "route_id", "change_kind")


FROM = "2024-01-01 00:00:00"


def test_effective_date_falls_back(spark):
    df = staged(
        spark, ("a", "a", "A", "d", "2024-01-05 10:00:00"),
        ("b", "b", "B", "d", None, None, "2023-05-05 10:00:00"), ("c", "c", "C", "d"))
    got = texts(scd2.effective_dates(df, AS_OF), "route_id", "valid_from", "valid_to_candidate")
    assert got == [("a", "2024-01-05", "9999-12-31"), ("b", "2023-05-05", "9999-12-31"), ("c", "2024-02-01", "9999-12-31")]


def test_latest_ignores_the_creation_date(spark):
    """The versioned dimension orders by update and load time only."""
    assert scd2.ROUTE_VERSIONS.order == ("src_updated_at", "etl_loaded_at")
    df = staged(spark, ("a", "a", "old", "d", FROM, "2024-01-01 00:00:00", "2025-01-01 00:00:00"),
                ("a", "a", "new", "d", FROM, "2024-01-02 00:00:00"))
    assert rows(scd2.latest_versions(df, AS_OF), "route_name") == [("new",)]


def test_null_to_value_is_a_change_only_null_safe(spark):
    change = ("r2", "r2", "Two", "now set", FROM)
    assert kinds(spark, True, change) == [("r2", "changed")]
    assert kinds(spark, False, change) == []


def test_later_start_alone_is_a_change_and_equal_rows_are_not(spark):
    same = ("r1", "r1", "One", "x", FROM)
    later = ("r3", "r3", "Three b", "x", "2024-01-15 00:00:00")
    new = ("r9", "r9", "Nine", "x", FROM)
    assert kinds(spark, True, same, later, new) == [("r3", "changed"), ("r9", "new")]


def test_change_on_the_stored_day_is_dropped(spark):
    after = step(spark, stored(spark), ("r1", "r1", "Renamed", "x", FROM))
    assert rows(after) == rows(stored(spark))


def test_new_version_closes_the_current_one_only(spark):
    after = step(spark, stored(spark), ("r3", "r3", "Three c", "x", "2024-01-15 00:00:00"))
    got = texts(after.filter("route_id_nat = 'r3'"), "route_sk", "route_name", "valid_from", "valid_to", "is_current")
    assert got == [
        ("3", "Three", "2023-01-01", "2023-12-31", "false"), ("4", "Three b", "2024-01-01", "2024-01-14", "false"),
        ("5", "Three c", "2024-01-15", "9999-12-31", "true")]


def test_version_before_the_current_one(spark):
    early = ("r1", "r1", "Early", "x", "2023-12-15 00:00:00")
    assert rows(step(spark, stored(spark), early)) == rows(stored(spark))
    after = step(spark, stored(spark), early, late_policy="accept")
    got = texts(after.filter("route_id_nat = 'r1'"), "route_name", "valid_from", "valid_to", "is_current")
    assert got == [("Early", "2023-12-15", "9999-12-31", "true"), ("One", "2024-01-01", "2023-12-14", "false")]
    with pytest.raises(ValueError):
        step(spark, stored(spark), early, late_policy="other")


def test_null_safety_decides_only_for_earlier_starts(spark):
    """An equal start is dropped and a later one inserted whatever the attributes say."""
    for start, inserted in (("2024-01-01 00:00:00", (0, 0)), ("2024-01-15 00:00:00", (1, 1)), ("2023-12-15 00:00:00", (1, 0))):
        latest = scd2.latest_versions(staged(spark, ("r2", "r2", "Two", "now set", start)), AS_OF)
        got = tuple(
            scd2.new_versions(stored(spark), latest, AS_OF, null_safe=safe, late_policy="accept").count()
            for safe in (True, False))
        assert got == inserted, start


def test_nothing_staged_is_the_identity_and_repeating_changes_nothing(spark):
    assert rows(step(spark, stored(spark))) == rows(stored(spark))
    batch = [("r1", "r1", "One b", "x", "2024-01-20 00:00:00"), ("r9", "r9", "Nine", "x", FROM)]
    once = step(spark, stored(spark), *batch)
    assert rows(step(spark, once, *batch)) == rows(once)


def test_invariants_over_many_batches(spark):
    current = spark.createDataFrame([], ddl(t.DIM_ROUTE_SCHEMA))
    for day in (1, 5, 5, 9):
        batch = [(f"r{i}", f"r{i}", f"n{i}-{day if i % 2 else 0}", "x", f"2024-01-{day + i % 3:02d} 00:00:00") for i in range(12)]
        current = step(spark, current, *batch).checkpoint()
    per_key = current.groupBy("route_id_nat").agg(F.count_if("is_current").alias("n"))
    assert rows(per_key.select("n").distinct()) == [(1,)]
    assert current.select("route_sk").distinct().count() == current.count()
    a, b = current.alias("a"), current.alias("b")
    overlap = a.join(b, F.expr("a.route_id_nat = b.route_id_nat and a.route_sk < b.route_sk "
                               "and a.valid_from <= b.valid_to and b.valid_from <= a.valid_to"))
    assert overlap.count() == 0


def test_asof_lookup(spark):
    facts = frame(spark, "f int, key string, day date", (1, "r3", "2023-06-01"), (2, "r3", "2024-06-01"),
                  (3, "r3", "2022-01-01"), (4, "zz", "2024-01-01"), (5, None, "2024-01-01"))
    got = rows(scd2.asof_lookup(facts, stored(spark), "key", "day", ["f"]))
    assert got == [(1, 3), (2, 4), (3, None), (4, None), (5, None)]


def test_asof_lookup_equals_brute_force(spark):
    """Many versions of one key, a reversed interval, gaps, and facts on every boundary."""
    hot = [(i, "hot", f"n{i}", "x", f"2024-{i:02d}-0{1 + i % 3}", f"2024-{i + 1:02d}-01", i == 11) for i in range(1, 12)]
    versions = dim(spark, *hot, (50, "hot", "late", "x", "2024-12-20", "2024-12-01", False),
                   (51, "open", "o", "x", "2023-06-15", "9999-12-31", True))
    days = spark.range(500).selectExpr("id as f", "date_add(date'2023-10-01', cast(id as int)) as day")
    facts = days.selectExpr("f", "day", "'hot' as key").union(days.selectExpr("f + 1000", "day", "'open'"))
    expected = facts.join(
        versions, F.expr("key = route_id_nat and day between valid_from and valid_to"), "left").select("f", "route_sk")
    assert rows(scd2.asof_lookup(facts, versions, "key", "day", ["f"])) == rows(expected)


def test_unknown_default_fare_is_null(spark):
    fares = frame(spark, "fare_product_sk bigint, fare_product_id_nat string", (7, "F1"))
    df = frame(spark, "route_id string, default_fare_product_id string", ("a", "F1"), ("b", "F2"), ("c", None))
    assert rows(scd2.resolve_default_fare(df, fares), "route_id", "default_fare_product_sk") == [
        ("a", 7), ("b", None), ("c", None)]
