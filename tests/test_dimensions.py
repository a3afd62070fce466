from __future__ import annotations

import hashlib
import random

from helpers import frame, rows, texts
from pyspark.sql import functions as F

from starmart import tables as t
from starmart.operators import calendar as cal
from starmart.operators.conform import conform
from starmart.operators.dedup import latest_by_key
from starmart.operators.dimensions import merge_insert_only, new_members
from starmart.operators.keys import assign_surrogate_keys
from starmart.sources.tables import ddl

AS_OF = "2024-02-01 00:00:00"


def users(spark, *values):
    schema = "user_id string, email string, src_created_at timestamp_ntz, src_updated_at timestamp_ntz"
    return conform(frame(spark, schema, *values), t.USER, "b", AS_OF)


def empty_dim(spark, spec=t.DIM_USER):
    return spark.createDataFrame([], ddl(spec.schema))


def test_latest_orders_nulls_last(spark):
    df = frame(
        spark, "k string, v string, u timestamp_ntz, c timestamp_ntz",
        ("a", "old", "2024-01-01 00:00:00", None), ("a", "new", "2024-01-02 00:00:00", None),
        ("a", "none", None, "2024-05-01 00:00:00"),
        ("b", "first", None, None), ("b", "second", None, "2024-01-01 00:00:00"),
    )
    assert rows(latest_by_key(df, ["k"], ["u", "c"]), "k", "v") == [("a", "new"), ("b", "second")]


def test_ties_do_not_depend_on_partitioning(spark):
    data = [(i % 5, i) for i in range(500)]
    random.Random(1).shuffle(data)
    df = spark.createDataFrame(data, "k int, v int").withColumn("u", F.lit(1))
    picks = {tuple(rows(latest_by_key(df.repartition(n), ["k"], ["u"]))) for n in (1, 3, 16)}
    assert len(picks) == 1 and len(next(iter(picks))) == 5


def test_hot_key_is_cut_before_the_shuffle(spark, capsys):
    latest_by_key(spark.range(1000).withColumn("k", F.col("id") % 3), ["k"], ["id"]).explain()
    plan = capsys.readouterr().out
    assert plan.index("row_number(), 1, Final") < plan.index("Exchange") < plan.index("row_number(), 1, Partial")


def test_surrogate_keys_equal_a_global_rank_by_digest(spark):
    names = [f"USER-{i:06d}" for i in range(700)]
    expected = sorted(names, key=lambda n: (hashlib.md5(n.encode()).hexdigest(), n))
    for parts, digits in ((1, 1), (7, 2), (16, 3)):
        df = spark.createDataFrame([(n,) for n in names], "nat string").repartition(parts)
        got = rows(assign_surrogate_keys(df, "nat", "sk", 100, digits))
        assert got == sorted(((101 + i, n) for i, n in enumerate(expected)), key=repr)


def test_known_members_are_never_changed(spark):
    first = users(spark, ("u1", "a@x", None, "2024-01-01 00:00:00"), ("u1", "b@x", None, "2024-01-02 00:00:00"))
    dim = merge_insert_only(empty_dim(spark), first, t.DIM_USER, AS_OF)
    assert rows(dim, "user_sk", "user_id_nat", "email") == [(1, "u1", "b@x")]
    second = users(spark, ("u1", "changed@x", None, "2024-03-01 00:00:00"), ("u2", "c@x", None, None))
    merged = merge_insert_only(dim, second, t.DIM_USER, AS_OF)
    assert rows(merged, "user_sk", "user_id_nat", "email") == [(1, "u1", "b@x"), (2, "u2", "c@x")]
    assert new_members(merged, second, t.DIM_USER).count() == 0
    assert dict(merged.dtypes) == t.DIM_USER.schema


def test_fare_currency_default_and_registration_date(spark):
    raw = frame(spark, "fare_product_id string, product_name string, base_price double", ("f", "F", 2.5))
    dim = merge_insert_only(
        empty_dim(spark, t.DIM_FARE_PRODUCT), conform(raw, t.FARE_PRODUCT, "b", AS_OF), t.DIM_FARE_PRODUCT, AS_OF)
    assert texts(dim, "currency_code", "base_price", "src_system") == [("EUR", "2.50", "oltp")]
    raw = frame(spark, "user_id string, registration_ts timestamp_ntz", ("u", "2024-01-05 23:59:00"))
    dim = merge_insert_only(empty_dim(spark), conform(raw, t.USER, "b", AS_OF), t.DIM_USER, AS_OF)
    assert texts(dim, "registration_dt") == [("2024-01-05",)]


def test_calendar(spark):
    days = cal.calendar(spark)
    assert days.count() == 1826
    got = texts(days.filter("date_key in (20230101, 20270101, 20240229)"))
    assert got == [
        ("20230101", "2023-01-01", "2023", "1", "1", "January", "52", "1", "7", "Sunday", "true"),
        ("20240229", "2024-02-29", "2024", "1", "2", "February", "9", "29", "4", "Thursday", "false"),
        ("20270101", "2027-01-01", "2027", "1", "1", "January", "53", "1", "5", "Friday", "false"),
    ]
    assert days.select("date_key").distinct().count() == 1826


def test_clock(spark):
    clock = cal.clock(spark)
    got = rows(clock.agg(F.count("*"), F.countDistinct("time_key"), F.min("time_key"), F.max("time_key")))
    assert got == [(86400, 86400, 0, 235959)]
    assert rows(clock.filter("time_key = 50003")) == [(50003, "05:00:03", 5, 0, 3)]


def test_insert_if_absent(spark):
    stored = cal.calendar(spark, "2024-01-01", "2024-01-03")
    wanted = cal.calendar(spark, "2024-01-02", "2024-01-05")
    assert rows(cal.insert_if_absent(stored, wanted, "date_key"), "date_key") == [(20240104,), (20240105,)]


def test_source_system_is_that_of_the_staged_table(spark):
    staged = conform(frame(spark, "vehicle_id string", ("V1",)), t.VEHICLE, "b", AS_OF)
    merged = merge_insert_only(empty_dim(spark, t.DIM_VEHICLE), staged, t.DIM_VEHICLE, AS_OF)
    assert rows(merged, "src_system") == [("oltp_or_stream",)]
