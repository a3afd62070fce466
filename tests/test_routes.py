from __future__ import annotations

import uuid
from collections import defaultdict

import pytest
from helpers import frame, rows, texts
from pyspark.sql import functions as F

from starmart import tables as t
from starmart.operators import positions, ranking, routes
from starmart.operators.payments import payments_from_trips
from starmart.operators.ranking import ranked_within


@pytest.fixture(scope="module")
def bridge(spark):
    """One route holds a third of all stops, many hold one or two."""
    pairs = [("hot", f"S{i}") for i in range(900)]
    pairs += [(f"r{i % 700}", f"S{i}") for i in range(1800)]
    return spark.createDataFrame(pairs, "route_id string, stop_id string")


@pytest.fixture(scope="module")
def expected(bridge):
    stops = defaultdict(list)
    for route, stop in bridge.collect():
        stops[route].append(stop)
    return {route: sorted(found) for route, found in stops.items()}


@pytest.mark.parametrize("partitions", [1, 7, 40])
def test_positions_in_groups_of_any_size(bridge, expected, partitions):
    got = rows(ranked_within(bridge, "route_id", "stop_id", "n", partitions))
    assert got == sorted(
        ((r, s, i) for r, found in expected.items() for i, s in enumerate(found, 1)), key=repr)


def test_hot_group_is_spread_over_slices(spark, bridge):
    sliced = bridge.repartitionByRange(12, "route_id", "stop_id").withColumn("p", F.spark_partition_id())
    largest = sliced.groupBy("p").count().agg(F.max("count")).first()[0]
    assert largest < bridge.count() / 4


def test_tasks_that_number_rows_grow_with_the_rows(bridge, expected, monkeypatch):
    """Tasks hold about as many rows as asked for, however few bytes these take when compressed."""
    monkeypatch.setattr(ranking, "TASK_ROWS", 100)
    got = ranked_within(bridge, "route_id", "stop_id", "n", 20).withColumn("p", F.spark_partition_id())
    sizes = got.groupBy("p").count().collect()
    assert len(sizes) > 15 and max(r["count"] for r in sizes) < 500
    assert rows(got.drop("p")) == sorted(
        ((r, s, i) for r, found in expected.items() for i, s in enumerate(found, 1)), key=repr)


@pytest.mark.parametrize("chunk", [2, 100, 900, 10_000])
def test_pattern_hash_matches_python_for_any_chunk(spark, bridge, expected, chunk):
    got = dict(rows(routes.pattern_hash(routes.stop_sequence(bridge, 8), chunk)))
    assert got == {r: uuid.uuid5(uuid.NAMESPACE_DNS, ",".join(found)).hex for r, found in expected.items()}


def test_geometry(spark):
    sequenced = frame(spark, "route_id string, stop_id string, stop_sequence int",
                      ("a", "s1", 1), ("a", "s2", 2), ("a", "s3", 3), ("b", "s3", 1), ("c", "zz", 1))
    stops = frame(spark, "stop_id string, latitude decimal(9,6), longitude decimal(9,6)",
                  ("s1", "55.1", "37.0"), ("s2", "55.2", "37.1"), ("s3", None, "38.0"))
    assert rows(routes.geometry(sequenced, stops)) == [
        ("a", 55.15, 37.05, "s1", "s3"), ("b", None, None, "s3", "s3"), ("c", None, None, "zz", "zz")]


def test_event_id_and_repeated_delivery(spark):
    df = frame(spark, "v string, ts timestamp_ntz", ("VEH-1", "2024-01-01 00:00:00.7"))
    assert rows(df.select(positions.raw_event_id(F.col("v"), F.col("ts")))) == [("VEH-1-1704067200",)]
    feed = frame(
        spark, "raw_event_id string, offset_in_partition bigint, speed double", ("a", 5, 1.0), ("a", 3, None), ("a", None, 3.0),
        ("b", 9, 4.0), ("c", None, 5.0), (None, 1, 6.0), ("b", 9, 4.0))
    assert rows(positions.deduplicate(feed)) == sorted([("a", 3, None), ("b", 9, 4.0), ("c", None, 5.0), (None, 1, 6.0)], key=repr)


def test_payments(spark):
    trips = spark.range(4000).select(
        F.col("id").cast("string").alias("trip_id"), F.lit("u").alias("user_id"), F.lit("f").alias("fare_product_id"),
        F.expr("timestamp_ntz'2024-01-01 12:00:00'").alias("start_ts"), F.lit(2.5).alias("fare_amount"),
        F.lit("EUR").alias("currency_code"),
        F.when(F.col("id") < 2000, "completed").otherwise("canceled").alias("trip_status"))
    paid = payments_from_trips(trips)
    n = paid.count()
    assert 1850 < n < 1950 and rows(paid) == rows(payments_from_trips(trips.repartition(9)))
    assert paid.select("payment_id", "external_txn_id").distinct().count() == n
    early, late = paid.agg(F.min("created_at"), F.max("created_at")).first()
    assert (str(early), str(late)) == ("2024-01-01 11:55:00", "2024-01-01 12:00:00")
    assert texts(paid.groupBy("payment_method").count().filter("count > 400"), "payment_method") == [
        ("apple_pay",), ("card",), ("cash",), ("google_pay",)]
    assert payments_from_trips(trips, share=1.0).count() == 2000
    assert set(t.PAYMENT.columns) | {"src_system"} == set(paid.columns)


@pytest.mark.parametrize("partitions", [1, 6])
def test_null_group_is_one_group(spark, partitions):
    df = spark.createDataFrame([(None, i) for i in range(900)] + [("a", i) for i in range(30)], "g string, o int")
    got = rows(ranked_within(df, "g", "o", "n", partitions))
    assert got == sorted([(None, i, i + 1) for i in range(900)] + [("a", i, i + 1) for i in range(30)], key=repr)


def test_running_digest_starts_at_a_null_route():
    import pandas as pd

    batches = iter([pd.DataFrame({"route_id": [None, "a"], "_text": ["x", "y"]})])
    assert sum(len(b) for b in routes._running_sha1(batches)) == 2
