from __future__ import annotations

import pytest
from helpers import frame, rows, texts
from pyspark.sql import functions as F

from starmart import tables as t
from starmart.operators import facts
from starmart.operators.calendar import calendar, calendar_with, clock
from starmart.operators.conform import conform
from starmart.operators.mart import build_mart, dropped_hours, replace_by_key
from starmart.plans import analytics

AS_OF = "2024-01-31 00:00:00"


@pytest.fixture(scope="module")
def dims(spark):
    return {
        "dim_user": frame(spark, "user_sk bigint, user_id_nat string", (1, "u1")),
        "dim_route": frame(spark, "route_sk bigint, route_id_nat string", (10, "r1")),
        "dim_vehicle": frame(spark, "vehicle_sk bigint, vehicle_id_nat string", (20, "v1")),
        "dim_stop": frame(spark, "stop_sk bigint, stop_id_nat string", (31, "s1"), (32, "s2")),
        "dim_fare_product": frame(spark, "fare_product_sk bigint, fare_product_id_nat string", (40, "f1")),
    }


@pytest.fixture(scope="module")
def trips(spark):
    raw = frame(
        spark,
        "trip_id string, user_id string, route_id string, vehicle_id string, origin_stop_id string, "
        "destination_stop_id string, start_ts timestamp_ntz, end_ts timestamp_ntz, fare_product_id string, "
        "fare_amount double, currency_code string",
        ("full", "u1", "r1", "v1", "s1", "s2", "2024-01-02 05:00:03", "2024-01-02 05:10:03", "f1", 2.5, "USD"),
        ("sparse", "u1", "r1", None, "s2", "zz", "2024-01-02 23:59:59", None, "zz", None, None),
        ("no user", "zz", "r1", "v1", "s1", "s2", "2024-01-02 05:00:03", None, "f1", 1.0, None),
        ("no route", "u1", "zz", "v1", "s1", "s2", "2024-01-02 05:00:03", None, "f1", 1.0, None),
        ("null route", "u1", None, "v1", "s1", "s2", "2024-01-02 05:00:03", None, "f1", 1.0, None),
        ("no start", "u1", "r1", "v1", "s1", "s2", None, None, "f1", 1.0, None),
        ("nothing", "zz", "zz", "zz", "zz", "zz", None, None, "zz", None, None),
    )
    return conform(raw, t.TRIP, "b", AS_OF)


def test_trip_facts(spark, trips, dims):
    got = texts(facts.fact_rows(trips, dims, facts.trip_spec()).drop("created_at", "trip_status", "distance_meters"))
    assert got == [
        ("full", "1", "10", "20", "31", "32", "20240102", "50003", "20240102", "51003", "40", "600", "2.50", "USD"),
        ("sparse", "1", "10", None, "32", None, "20240102", "235959", None, None, None, None, None, "EUR")]


def test_rejects_name_the_first_missing_key(spark, trips, dims):
    spec = facts.trip_spec()
    expected = [("no route", "route_sk"), ("no start", "start_date_key"), ("no user", "user_sk"),
                ("nothing", "user_sk"), ("null route", "route_sk")]
    assert rows(facts.fact_rejects(trips, dims, spec), "trip_id", "reject_reason") == expected
    classified = facts.classified_rows(trips, dims, spec)
    assert rows(classified.filter("reject_reason is not null"), "trip_id", "reject_reason") == expected
    assert classified.count() == trips.count()


def test_mandatory_lookups_become_inner_joins(spark, trips, dims, capsys):
    facts.fact_rows(trips, dims, facts.trip_spec()).explain()
    plan = capsys.readouterr().out
    assert plan.count("], Inner") == 2 and plan.count("], LeftOuter") == 4


def test_positions_need_a_vehicle_but_no_route(spark, dims):
    raw = frame(spark, "raw_event_id string, vehicle_id string, route_id string, event_ts timestamp_ntz",
                ("a", "v1", "zz", "2024-01-02 00:00:01"), ("b", "zz", "r1", "2024-01-02 00:00:01"))
    got = facts.fact_rows(conform(raw, t.VEHICLE_POSITION, "b", AS_OF), dims, facts.position_spec())
    assert rows(got, "raw_event_id", "vehicle_sk", "route_sk", "time_key") == [("a", 20, None, 1)]


ROUTES = ("route_sk bigint, route_id_nat string, route_code string, route_name string, route_type string, "
          "is_current boolean")
FACT = ("route_sk bigint, start_date_key int, start_time_key int, trip_status string, trip_duration_sec int, "
        "distance_meters int, fare_amount decimal(10,2)")


@pytest.fixture(scope="module")
def star(spark):
    routes = frame(
        spark, ROUTES, (1, "r1", "B1", "Old", "bus", False), (2, "r1", "B1", "One", "bus", True),
        (3, "r2", "T1", "Two", "tram", True))
    fact = frame(
        spark, FACT,
        (2, 20240130, 80000, "completed", 600, 1000, "2.50"), (2, 20240130, 85959, "canceled", 300, None, "1.00"),
        (2, 20240130, 90000, "cancelled", None, None, None), (1, 20240130, 80000, "completed", 60, 10, "9.00"),
        (3, 20240124, 0, "completed", 1, 1, "1.11"), (3, 20240123, 235959, "completed", 1, 1, "1.12"),
        (3, 20240130, None, "completed", 1, 1, "1.00"), (3, 20240130, 996099, "completed", 1, 1, "1.00"),
        (3, 20240231, 80000, "completed", 1, 1, "1.00"), (3, 20240130, 70000, None, 1, 1, "1.00"),
        (9, 20240130, 80000, "completed", 1, 1, "1.00"), (3, 20220101, 80000, "completed", 1, 1, "1.00"),
    )
    return fact, routes


COUNTS = ("route_id_nat", "start_hour", "trips_total", "trips_completed", "trips_canceled")


def test_mart_counts_current_versions_and_exact_statuses(spark, star):
    mart = build_mart(*star, AS_OF)
    assert mart.dtypes == list(t.MART_SCHEMA.items())
    assert texts(mart, *COUNTS) == [
        ("r1", "2024-01-30 08:00:00", "2", "1", "1"), ("r1", "2024-01-30 09:00:00", "1", "0", "0"),
        ("r2", "2022-01-01 08:00:00", "1", "1", "0"), ("r2", "2024-01-23 23:00:00", "1", "1", "0"),
        ("r2", "2024-01-24 00:00:00", "1", "1", "0"), ("r2", "2024-01-30 07:00:00", "1", "0", "0")]
    first, second = rows(mart.filter("route_id_nat = 'r1'"), "avg_trip_duration_sec", "total_distance_m",
                         "avg_distance_m", "total_fare_amount", "avg_fare_amount")
    assert first == (450.0, 1000.0, 1000.0, 3.5, 1.75) and second == (None,) * 5


def test_mart_by_key_books_old_versions_on_the_current_one(spark, star):
    mart = build_mart(*star, AS_OF, version="by_key", canceled=("canceled", "cancelled"))
    assert texts(mart.filter("route_id_nat = 'r1'"), *COUNTS, "route_name") == [
        ("r1", "2024-01-30 08:00:00", "3", "2", "1", "One"), ("r1", "2024-01-30 09:00:00", "1", "0", "1", "One")]
    with pytest.raises(ValueError):
        build_mart(*star, AS_OF, version="other")


def test_dropped_hours(spark, star):
    assert rows(dropped_hours(star[0])) == [(12, 3)]


def test_mart_sums_equal_fact_sums(spark, star):
    fact, routes = star
    mart = build_mart(fact, routes, AS_OF).agg(F.sum("trips_total"), F.round(F.sum("total_fare_amount"), 2))
    valid = fact.join(routes.filter("is_current"), "route_sk").filter(
        "start_time_key <> 996099 and start_date_key <> 20240231")
    assert rows(mart) == rows(valid.agg(F.count("*"), F.sum("fare_amount").cast("double")))


def test_replace_by_key_keeps_the_last_load(spark):
    df = frame(spark, "route_id_nat string, start_hour string, route_name string, etl_loaded_at timestamp_ntz",
               ("r", "h", "old name", "2024-01-01 00:00:00"), ("r", "h", "new name", "2024-01-02 00:00:00"),
               ("r", "i", "old name", "2024-01-01 00:00:00"))
    assert rows(replace_by_key(df), "start_hour", "route_name") == [("h", "new name"), ("i", "old name")]


@pytest.mark.parametrize("query", ["star_route_hour", "star_peak_hours", "star_weekly_trend"])
def test_star_queries_agree_with_and_without_lookup_of_generated_keys(spark, star, query):
    fact, routes = star
    ask = getattr(analytics, query)
    days = fact.selectExpr("try_to_date(cast(start_date_key as string), 'yyyyMMdd')")
    joined = ask(fact, routes, calendar_with(spark, days), clock(spark), AS_OF, 3000)
    computed = ask(fact, routes, None, None, AS_OF, 3000)
    assert rows(joined) == rows(computed) and joined.count() > 0


def test_star_window_is_inclusive_and_ends_outside_the_calendar(spark, star):
    got = texts(analytics.star_route_hour(*star, calendar(spark), clock(spark), AS_OF, 7), "route_code", "start_hour")
    assert got == [("B1", "2024-01-30 08:00:00"), ("B1", "2024-01-30 09:00:00"),
                   ("T1", "2024-01-24 00:00:00"), ("T1", "2024-01-30 07:00:00")]


def test_star_status_count_of_a_group_without_status_is_null(spark, star):
    got = analytics.star_route_hour(*star, None, None, AS_OF).filter("hour(start_hour) = 7")
    assert rows(got, "trips_total", "trips_completed", "trips_canceled") == [(1, None, None)]
    assert rows(build_mart(*star, AS_OF).filter("hour(start_hour) = 7"), "trips_completed") == [(0,)]


def test_star_and_mart_agree_where_the_window_begins_on_the_hour(spark, star):
    mart = build_mart(*star, AS_OF)
    columns = [c for c in analytics.ROUTE_HOUR_COLUMNS if c not in ("trips_completed", "trips_canceled")]
    a = analytics.route_hour(mart, AS_OF, 7, None, (2, 2, 2))
    b = analytics.star_route_hour(*star, None, None, AS_OF, 7, None, (2, 2, 2))
    assert rows(a, *columns) == rows(b, *columns)


def test_top_rows_come_newest_first(spark, star):
    top = analytics.latest_hours(build_mart(*star, AS_OF), 2).collect()
    assert [str(r.start_hour) for r in top] == ["2024-01-30 09:00:00", "2024-01-30 08:00:00"]


def test_share_within_type(spark, star):
    got = rows(analytics.peak_hours(build_mart(*star, AS_OF), AS_OF), "route_type", "hour", "trips", "share_in_type")
    assert got == [("bus", 8, 2, 0.667), ("bus", 9, 1, 0.333), ("tram", 0, 1, 0.5), ("tram", 7, 1, 0.5)]


def test_trend_weeks_and_rate(spark, star):
    mart = build_mart(*star, AS_OF)
    sunday = texts(analytics.weekly_trend(mart, AS_OF), "route_code", "week_start", "canceled", "total", "cancel_rate")
    assert sunday == [("B1", "2024-01-28", "1", "3", "0.333"), ("T1", "2024-01-21", "0", "2", "0.0"),
                      ("T1", "2024-01-28", "0", "1", "0.0")]
    monday = texts(analytics.weekly_trend(mart, AS_OF, week="monday"), "week_start")
    assert monday == [("2024-01-22",), ("2024-01-29",), ("2024-01-29",)]


def test_empty_inputs(spark, star):
    fact, routes = star
    nothing = build_mart(fact.limit(0), routes, AS_OF)
    assert nothing.count() == 0 and analytics.peak_hours(nothing, AS_OF).count() == 0
