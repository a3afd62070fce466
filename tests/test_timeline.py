"""Versions whose starts arrive in any order, facts on the version of their day, and a mart that follows both."""

from __future__ import annotations

import datetime as dt
import random

from helpers import frame, rows, texts
from pyspark.sql import functions as F

from starmart import tables as t
from starmart.operators import mart, timeline
from starmart.operators.facts import trip_spec
from starmart.operators.conform import conform
from starmart.plans.warehouse import Warehouse, load_batch
from starmart.sources import tables as io
from test_scd2 import dim
from test_warehouse import write_raw

AS_OF = "2024-02-01 00:00:00"
RAW = "route_id string, route_code string, route_name string, valid_from_ts timestamp_ntz, src_updated_at timestamp_ntz"


def batch(spark, *values):
    raw = frame(spark, RAW, *((k, k, name, f"{day} 00:00:00", f"{seen} 00:00:00") for k, name, day, seen in values))
    return conform(raw, t.ROUTE, "b", AS_OF).withColumn("default_fare_product_sk", F.lit(None).cast("bigint"))


def stored(spark, df, path):
    df.write.mode("overwrite").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def arrive(spark, tmp_path, batches):
    after = dim(spark)
    for k, values in enumerate(batches):
        fresh = stored(spark, timeline.fresh_starts(after, batch(spark, *values), AS_OF), f"{tmp_path}/fresh{k}")
        after = stored(spark, timeline.merge(after, fresh), f"{tmp_path}/after{k}")
    return after


def test_intervals_do_not_depend_on_the_order_of_arrival(spark, tmp_path):
    rng = random.Random(3)
    starts = {(k, f"2024-0{m}-{d:02d}") for k in ("r1", "r2", "r3") for m, d in ((rng.randint(1, 6), rng.randint(1, 28)) for _ in range(7))}
    values = [(k, rng.choice("ABC"), day, "2024-01-01") for k, day in sorted(starts)]
    expected = []
    for key in ("r1", "r2", "r3"):
        own = [v for v in values if v[0] == key]
        for v, following in zip(own, [*own[1:], None]):
            end = dt.date(9999, 12, 31) if following is None else dt.date.fromisoformat(following[2]) - dt.timedelta(1)
            expected.append((key, v[1], v[2], str(end), str(following is None).lower()))
    for seed in range(3):
        order = list(values)
        random.Random(seed).shuffle(order)
        cut = sorted(random.Random(seed).sample(range(1, len(order)), 2))
        lots = [order[a:b] for a, b in zip([0, *cut], [*cut, len(order)])]
        after = arrive(spark, f"{tmp_path}/{seed}", [*lots, order[:4]])  # the last batch brings nothing new
        assert texts(after, "route_id_nat", "route_name", "valid_from", "valid_to", "is_current") == sorted(expected)
        assert sorted(r.route_sk for r in after.collect()) == list(range(1, len(values) + 1))


def test_stored_versions_keep_their_keys_and_a_stored_start_its_values(spark, tmp_path):
    old = dim(spark, (7, "r1", "One", None, "2024-01-10", "9999-12-31", True), (8, "r2", "Two", None, "2024-01-10", "9999-12-31", True))
    values = [("r1", "Early", "2024-01-01", "2024-01-02"), ("r1", "Other", "2024-01-10", "2024-01-02"),
              ("r1", "older", "2024-01-20", "2024-01-02"), ("r1", "newer", "2024-01-20", "2024-01-03")]
    fresh = stored(spark, timeline.fresh_starts(old, batch(spark, *values), AS_OF), f"{tmp_path}/f")
    after = timeline.merge(old, fresh)
    got = [r for r in texts(after, "route_sk", "route_id_nat", "route_name", "valid_from", "valid_to", "is_current") if r[1] == "r1"]
    assert {(r[2], r[3], r[4], r[5]) for r in got} == {
        ("Early", "2024-01-01", "2024-01-09", "false"), ("One", "2024-01-10", "2024-01-19", "false"), ("newer", "2024-01-20", "9999-12-31", "true")}
    assert {r[2]: r[0] for r in got}["One"] == "7" and {r[0] for r in got} == {"7", "9", "10"}
    days = timeline.changed_days(old, after)
    assert texts(days) == [("r1", "2024-01-01", "2024-01-09"), ("r1", "2024-01-20", "9999-12-31")]
    assert rows(timeline.merge(old, fresh.limit(0)).select("route_sk")) == [(7,), (8,)]


def test_a_version_closed_too_early_wins_its_days_back(spark, tmp_path):
    old = dim(spark, (1, "r1", "One", None, "2024-01-01", "2024-01-04", False), (2, "r1", "Two", None, "2024-01-10", "9999-12-31", True))
    fresh = stored(spark, timeline.fresh_starts(old, batch(spark, ("r1", "Mid", "2024-01-08", "2024-01-01")), AS_OF), f"{tmp_path}/f")
    after = timeline.merge(old, fresh)
    assert texts(after, "route_name", "valid_from", "valid_to") == [
        ("Mid", "2024-01-08", "2024-01-09"), ("One", "2024-01-01", "2024-01-07"), ("Two", "2024-01-10", "9999-12-31")]
    assert texts(timeline.changed_days(old, after)) == [("r1", "2024-01-05", "2024-01-07"), ("r1", "2024-01-08", "2024-01-09")]


def house_rows(house, version):
    spec = trip_spec()
    named = house.routes(house.last).select("route_sk", "route_name", "valid_from")
    facts = house.facts(spec, t.TRIP).join(named, "route_sk", "left")
    rejected = house.facts(spec, t.TRIP, io.REJECTED)
    return (
        texts(facts, "trip_id", "etl_batch_id", "route_name", "valid_from"),
        texts(rejected, "trip_id", "etl_batch_id", "reject_reason"), texts(house.mart().drop("etl_loaded_at")))


def test_facts_follow_the_history_of_their_day(spark, tmp_path):
    """A late version takes over the facts of its days in older batches; the result equals loading all anew."""
    raws = [("b1", dict(name="Line 1", from_day="2024-01-01", day="2024-01-30")),
            ("b2", dict(name="Line 1b", from_day="2024-02-10", day="2024-02-12", extra_user=True)),
            ("b3", dict(name="Line 1 late", from_day="2024-01-15", day="2024-02-01")),
            ("b4", dict(name="Line 1 first", from_day="2023-12-01", day="2023-12-20"))]
    root, again = f"{tmp_path}/house", f"{tmp_path}/again"
    for k, (name, given) in enumerate(raws):
        write_raw(spark, f"{tmp_path}/{name}", **given)
        counts = load_batch(spark, f"{tmp_path}/{name}", root, name, AS_OF, first=not k, version="as_of_event")
        if name == "b3":
            assert counts["rebooked"] == {"fact_trip": 1, "fact_vehicle_position": 0}  # the day of the first batch
    house = Warehouse(spark, root)
    house.last = "b4"
    booked = {r[0]: r[2] for r in house_rows(house, "as_booked")[0]}
    assert booked["T12024-01-30"] == "Line 1 late" and booked["T12024-02-12"] == "Line 1b" and booked["T12023-12-20"] == "Line 1 first"

    # The same facts from all batches at once, on the last snapshot.
    for k, (name, _) in enumerate(raws):
        load_batch(spark, f"{tmp_path}/{name}", again, name, AS_OF, first=not k, version="as_of_event")
    rebuilt = Warehouse(spark, again)
    rebuilt.last = "b4"
    rebuilt.load_facts(None, "b4", AS_OF, "as_of_event")
    rebuilt.load_mart(None, "b4", AS_OF, "as_booked")
    assert house_rows(house, "as_booked") == house_rows(rebuilt, "as_booked")

    # A corrected first batch takes its former trips out of the mart, from its part alone.
    write_raw(spark, f"{tmp_path}/b1", name="Line 1", from_day="2024-01-01", day="2024-01-29")
    house.load_staging(f"{tmp_path}/b1", "b1", AS_OF)
    house.load_facts("b1", "b4", AS_OF, "as_of_event")
    before = house.mart().filter("start_date = date'2024-01-30'").count()
    house.load_mart("b1", "b4", AS_OF, "as_booked")
    dates = {str(r.start_date) for r in house.mart().select("start_date").distinct().collect()}
    assert before and "2024-01-30" not in dates and "2024-01-29" in dates
    kept = texts(house.mart().drop("etl_loaded_at"))
    house.load_mart(None, "b4", AS_OF, "as_booked")
    assert texts(house.mart().drop("etl_loaded_at")) == kept


def test_adjusted_sums_equal_sums_of_all_facts(spark):
    schema = ("route_sk bigint, start_date_key int, start_time_key int, trip_status string, trip_duration_sec int, "
              "distance_meters bigint, fare_amount decimal(10,2)")
    rng = random.Random(9)

    def trips(n):
        return frame(spark, schema, *((
            rng.randint(1, 3), 20240100 + rng.randint(1, 3), rng.randint(8, 10) * 10000, rng.choice(["completed", "canceled", None]),
            rng.choice([None, 60]), rng.choice([None, 900]), rng.choice([None, "1.50"])) for _ in range(n)))

    first, second, corrected = trips(40), trips(30), trips(5)
    sums = mart.route_hour_sums
    state = mart.adjusted_sums(sums(first), sums(first).limit(0), sums(second))
    state = mart.adjusted_sums(state, sums(first), sums(corrected))
    assert texts(state.select(*sorted(state.columns))) == texts(
        sums(second.unionByName(corrected)).select(*sorted(state.columns)))
