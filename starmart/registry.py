"""One query per operator, over the given tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from starmart import tables as t
from starmart.adapters import AS_OF, Domain
from starmart.functions import time as tm
from starmart.functions.numeric import coerce, rounded
from starmart.operators import calendar as cal
from starmart.operators import delivery, dimensions, facts, quality, reconcile, routes, scd2
from starmart.operators.conform import batch_rows, conform
from starmart.operators.dedup import latest_by_key
from starmart.operators.mart import adjusted_sums, mart_of_sums, replace_by_key, route_hour_sums
from starmart.operators.payments import payments_from_trips
from starmart.operators.positions import deduplicate
from starmart.plans import analytics

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}


def query(name: str):
    def register(build: Callable[[Domain], DataFrame]):
        QUERIES[name] = lambda spark, folder: build(Domain(spark, folder))
        return build

    return register


# Staging -------------------------------------------------------------------------------------------


def _stage(spec: t.StagingSpec):
    @query("stage_" + spec.name.removeprefix("stg_"))
    def build(d: Domain) -> DataFrame:
        return d.staged(spec).drop("etl_loaded_at")


for _spec in t.STAGING:
    _stage(_spec)


@query("stage_batch_filter")
def stage_batch_filter(d: Domain) -> DataFrame:
    first = F.col("start_ts") < tm.ntz("2024-01-16 00:00:00")
    history = d.staged(t.TRIP).withColumn("etl_batch_id", F.when(first, "b1").otherwise("b2"))
    return batch_rows(history, "b1").select("trip_id", "etl_batch_id")


# Scalar functions ----------------------------------------------------------------------------------


@query("scalar_date_keys")
def scalar_date_keys(d: Domain) -> DataFrame:
    return d.trips().select(
        "trip_id", tm.date_key("start_ts").alias("start_date_key"),
        tm.time_key("start_ts").alias("start_time_key"),
    )


@query("scalar_duration")
def scalar_duration(d: Domain) -> DataFrame:
    lines, orders = d.table("lineitem"), d.table("orders")
    joined = lines.join(orders, F.col("l_orderkey") == F.col("o_orderkey"))
    seconds = tm.duration_sec("o_orderdate", "l_shipdate")
    return joined.select("l_orderkey", "l_linenumber", seconds.alias("duration_sec"))


@query("scalar_key_to_timestamp")
def scalar_key_to_timestamp(d: Domain) -> DataFrame:
    keyed = d.trips().select(
        "trip_id", tm.date_key("start_ts").alias("dk"),
        F.when(F.col("trip_status") != "canceled", tm.time_key("start_ts")).alias("tk"),
    )
    stamped = keyed.withColumn("start_ts", tm.keys_to_timestamp("dk", "tk"))
    return stamped.select("trip_id", "start_ts", tm.hour_start("start_ts").alias("start_hour"))


@query("scalar_week_start")
def scalar_week_start(d: Domain) -> DataFrame:
    return d.table("events").select(
        "event_id", tm.week_start("ts", "monday").alias("week_monday"),
        tm.week_start("ts", "sunday").alias("week_sunday"),
    )


@query("scalar_coerce")
def scalar_coerce(d: Domain) -> DataFrame:
    part = d.table("part").select(
        "p_partkey", F.col("p_name").alias("n1"), F.col("p_size").cast("string").alias("n2")
    )
    return coerce(part, {"n1": "double", "n2": "double"})


# Generated dimensions, filled from the dates and times the tables hold -------------------------------


@query("dim_date")
def dim_date(d: Domain) -> DataFrame:
    return cal.calendar_for(d.table("orders"), F.col("o_orderdate").cast("date"))


@query("dim_date_insert")
def dim_date_insert(d: Domain) -> DataFrame:
    """Days of the orders that the standard calendar lacks, plus the days of the events it has."""
    needed = cal.describe_days(
        d.table("orders").select(F.col("o_orderdate").cast("date").alias("full_date"))
        .unionByName(d.table("events").select(F.col("ts").cast("date").alias("full_date")))
        .distinct()
    )
    return cal.insert_if_absent(cal.calendar(d.spark), needed, "date_key")


@query("dim_time")
def dim_time(d: Domain) -> DataFrame:
    """The clock with the number of trips that start at each second of the day."""
    starts = d.trips().groupBy(tm.time_key("start_ts").alias("time_key")).agg(
        F.count("*").alias("trips")
    )
    return cal.clock(d.spark).join(starts, "time_key", "left").withColumn(
        "trips", F.coalesce("trips", F.lit(0))
    )


# Dimensions ----------------------------------------------------------------------------------------


@query("latest_by_key")
def latest(d: Domain) -> DataFrame:
    events = d.table("events").select("user_id", "event_id", "ts", "event_type")
    return latest_by_key(events, ["user_id"], ["ts", "event_id"])


def _dim_insert(name: str, spec: t.DimSpec, columns: tuple[str, ...]):
    """Load on top of a dimension that holds the members of an earlier, smaller load."""

    @query(name)
    def build(d: Domain) -> DataFrame:
        existing = {
            "dim_user": lambda: d.dim_user(), "dim_vehicle": lambda: d.dim_vehicle(),
            "dim_fare_product": lambda: d.dim_fare_product(),
            "dim_stop": lambda: _seen_stops(d),
        }[spec.name]()
        return dimensions.new_members(existing, d.staged(spec.source), spec).select(spec.nat, *columns)


def _seen_stops(d: Domain) -> DataFrame:
    """Stops where a trip has ended before."""
    return d.trips().select(F.col("destination_stop_id").cast("string").alias("stop_id_nat")).distinct()


_dim_insert("dim_user_insert", t.DIM_USER, ("full_name", "registration_dt", "status"))
_dim_insert("dim_vehicle_insert", t.DIM_VEHICLE, ("registration_number", "capacity"))
_dim_insert("dim_stop_insert", t.DIM_STOP, ("stop_code", "stop_name", "latitude", "longitude", "zone"))
_dim_insert("dim_fare_insert", t.DIM_FARE_PRODUCT, ("product_name", "currency_code", "base_price"))


@query("dim_user_keys")
def dim_user_keys(d: Domain) -> DataFrame:
    stored = _as_dim(d.dim_user(), t.DIM_USER)
    merged = dimensions.merge_insert_only(stored, d.staged(t.USER), t.DIM_USER, AS_OF)
    return merged.select("user_sk", "user_id_nat")


def _as_dim(members: DataFrame, spec: t.DimSpec) -> DataFrame:
    """Members with the other columns of the dimension empty."""
    return members.select(
        *(c if c in members.columns else F.lit(None).cast(k).alias(c) for c, k in spec.schema.items())
    )


# Facts ---------------------------------------------------------------------------------------------


@query("fact_trip")
def fact_trip(d: Domain) -> DataFrame:
    return d.fact_trip()


@query("fact_trip_roles")
def fact_trip_roles(d: Domain) -> DataFrame:
    roles = [look for look in facts.trip_spec().lookups if look.dim == "dim_stop"]
    resolved = facts.resolve(d.staged(t.TRIP), d.dims, roles)
    return resolved.select("trip_id", "origin_stop_sk", "destination_stop_sk")


@query("fact_payment")
def fact_payment(d: Domain) -> DataFrame:
    return facts.fact_rows(d.staged(t.PAYMENT), d.dims, facts.payment_spec())


@query("fact_vehicle_position")
def fact_vehicle_position(d: Domain) -> DataFrame:
    return facts.fact_rows(d.staged(t.VEHICLE_POSITION), d.dims, facts.position_spec())


@query("fact_rejects")
def fact_rejects(d: Domain) -> DataFrame:
    rejected = facts.fact_rejects(d.staged(t.TRIP), d.dims, facts.trip_spec())
    return rejected.select("trip_id", "reject_reason")


@query("fact_trip_redelivered")
def fact_trip_redelivered(d: Domain) -> DataFrame:
    """Trips of two batches, of which the second delivers the completed ones again at another fare: the last one counts."""
    spec = facts.trip_spec()
    first = d.fact_trip().withColumn("etl_batch_id", F.lit("b1"))
    again = first.filter("trip_status = 'completed'").withColumns({
        "fare_amount": (F.col("fare_amount") + 1).cast("decimal(10,2)"), "etl_batch_id": F.lit("b2")})
    both = first.unionByName(again)
    place = F.when(F.col("etl_batch_id") == "b1", 1).otherwise(2)
    index = delivery.index_rows(both, spec.key, spec.date_key, place)
    states = delivery.marked(both, spec.key, delivery.touched_entries(index, index))
    return states.select("trip_id", "etl_batch_id", "fare_amount", "superseded")


# Versioned dimension -------------------------------------------------------------------------------


@query("scd2_latest")
def scd2_latest(d: Domain) -> DataFrame:
    return d.latest_routes().select("route_id", "route_name", "description", "valid_from")


def _change_set(name: str, null_safe: bool):
    @query(name)
    def build(d: Domain) -> DataFrame:
        changes = scd2.change_set(d.stored_routes(), d.latest_routes(), null_safe=null_safe)
        return changes.select(F.col("route_id").alias("route_id_nat"), "change_kind")


_change_set("scd2_change_set", True)
_change_set("scd2_change_set_strict", False)

_VERSION = ("route_id_nat", "route_name", "description", "valid_from", "valid_to", "is_current")


@query("scd2_new_versions")
def scd2_new_versions(d: Domain) -> DataFrame:
    return d.route_versions(late_policy="accept").select(*_VERSION)


@query("scd2_new_versions_in_order")
def scd2_new_versions_in_order(d: Domain) -> DataFrame:
    return d.route_versions(late_policy="reject").select(*_VERSION)


@query("scd2_snapshot")
def scd2_snapshot(d: Domain) -> DataFrame:
    return d.route_snapshot().select("route_sk", *_VERSION)


@query("dim_route_current")
def dim_route_current(d: Domain) -> DataFrame:
    return scd2.current_only(d.route_snapshot()).select(
        "route_id_nat", "route_code", "route_name", "valid_from"
    )


@query("scd2_asof_lookup")
def scd2_asof_lookup(d: Domain) -> DataFrame:
    trips = d.staged(t.TRIP).withColumn("_day", F.col("start_ts").cast("date"))
    return scd2.asof_lookup(trips, d.route_snapshot(), "user_id", "_day", ["trip_id"])


@query("scd2_late_versions")
def scd2_late_versions(d: Domain) -> DataFrame:
    """Two batches of starts in any order, merged into one timeline per route."""
    return d.route_timeline().select("route_sk", *_VERSION)


@query("fact_trip_asof")
def fact_trip_asof(d: Domain) -> DataFrame:
    """Trips on the route version of their day; those before the first version are rejects."""
    dims = {**{k: d.dims[k] for k in ("dim_user", "dim_vehicle", "dim_stop", "dim_fare_product")}, "dim_route": d.nation_versions()}
    rows = facts.classified_rows(d.staged(t.TRIP), dims, facts.trip_spec(), "as_of_event")
    return rows.select("trip_id", "user_sk", "route_sk", "start_date_key", "trip_status", "reject_reason")


# Mart and analytics --------------------------------------------------------------------------------

_AVERAGES = ("avg_trip_duration_sec", "avg_distance_m", "avg_fare_amount")


@query("mart_route_hour")
def mart_route_hour(d: Domain) -> DataFrame:
    mart = d.mart().drop("etl_loaded_at")
    return mart.withColumns({c: rounded(c, 4) for c in _AVERAGES})


@query("mart_replace_by_key")
def mart_replace_by_key(d: Domain) -> DataFrame:
    """The mart, and a second load of one region an hour later with one trip more."""
    mart = d.mart().select("route_id_nat", "route_type", "start_hour", "trips_total", "etl_loaded_at")
    again = mart.filter("route_type = 'AMERICA'").withColumns({
        "trips_total": F.col("trips_total") + 1,
        "etl_loaded_at": tm.ntz("2024-01-31 01:00:00"),
    })
    return replace_by_key(mart.unionByName(again)).select("route_id_nat", "start_hour", "trips_total")


@query("mart_incremental")
def mart_incremental(d: Domain) -> DataFrame:
    """The mart after two batches of trips and a correction of the first, which lacks the trips of errors then."""
    trips, early = d.mart_facts(), F.col("start_ts") < tm.ntz("2024-01-16 00:00:00")
    first, second = route_hour_sums(trips.filter(early)), route_hour_sums(trips.filter(~early))
    corrected = route_hour_sums(trips.filter(early & (F.col("trip_status") != "canceled")))
    nothing = first.limit(0)
    state = adjusted_sums(adjusted_sums(first, nothing, second), first, corrected)
    mart = mart_of_sums(state, d.dims["dim_route"], AS_OF).drop("etl_loaded_at")
    return mart.withColumns({c: rounded(c, 4) for c in _AVERAGES})


@query("mart_latest")
def mart_latest(d: Domain) -> DataFrame:
    top = analytics.latest_hours(d.mart())
    return top.withColumn("avg_trip_duration_sec", rounded("avg_trip_duration_sec", 4))


@query("route_hour_7d")
def route_hour_7d(d: Domain) -> DataFrame:
    return analytics.route_hour(d.mart(), AS_OF)


@query("route_hour_param")
def route_hour_param(d: Domain) -> DataFrame:
    return analytics.route_hour(d.mart(), AS_OF, 3, 50, (2, 2, 2))


@query("peak_hour_share")
def peak_hour_share(d: Domain) -> DataFrame:
    return analytics.peak_hours(d.mart(), AS_OF)


@query("weekly_trend")
def weekly_trend(d: Domain) -> DataFrame:
    return analytics.weekly_trend(d.mart(), AS_OF)


@query("dwh_route_hour")
def dwh_route_hour(d: Domain) -> DataFrame:
    return analytics.star_route_hour(*d.star(), AS_OF)


@query("dwh_route_hour_param")
def dwh_route_hour_param(d: Domain) -> DataFrame:
    return analytics.star_route_hour(*d.star(), AS_OF, 3, 50, (2, 2, 2))


@query("dwh_peak_hour_share")
def dwh_peak_hour_share(d: Domain) -> DataFrame:
    return analytics.star_peak_hours(*d.star(), AS_OF)


@query("dwh_weekly_trend")
def dwh_weekly_trend(d: Domain) -> DataFrame:
    return analytics.star_weekly_trend(*d.star(), AS_OF)


# Reconciliation ------------------------------------------------------------------------------------


@query("reconcile_route_hour")
def reconcile_route_hour(d: Domain) -> DataFrame:
    compared = reconcile.compare(*d.both_sources())
    return compared.select(
        "route_code", "start_hour", "trips_diff",
        *(rounded(c, 2).alias(c) for c in ("fare_diff", "duration_diff")),
    )


@query("reconcile_full")
def reconcile_full(d: Domain) -> DataFrame:
    compared = reconcile.compare(*d.both_sources(), how="full_outer")
    return compared.select("route_code", "start_hour", "status", "trips_diff")


@query("reconcile_buckets")
def reconcile_buckets(d: Domain) -> DataFrame:
    """Drift between the star and a mart that lacks a region, is off in one and holds one twice."""
    star, mart = d.both_sources()
    twice = mart.filter("route_type = 'MIDDLE EAST'")
    return reconcile.drift(star, mart.unionByName(twice)).select(
        "route_code", "start_hour", "status", "n_left", "n_right", "trips_total_left", "trips_total_right")


@query("hourly_compare")
def hourly_compare(d: Domain) -> DataFrame:
    return reconcile.hourly_series(reconcile.compare(*d.both_sources()))


@query("route_diff")
def route_diff(d: Domain) -> DataFrame:
    return reconcile.route_series(reconcile.compare(*d.both_sources()))


# Quality -------------------------------------------------------------------------------------------


@query("dq_not_null")
def dq_not_null(d: Domain) -> DataFrame:
    keyed = facts.resolve(
        d.staged(t.TRIP), d.dims,
        [look for look in facts.trip_spec().lookups if look.out in ("user_sk", "route_sk", "vehicle_sk")],
    )
    return quality.not_null(keyed, ["user_sk", "route_sk", "vehicle_sk", "start_ts"])


@query("dq_unique")
def dq_unique(d: Domain) -> DataFrame:
    return quality.unique(d.table("lineitem"), ["l_orderkey", "l_linenumber"])


@query("dq_foreign_key")
def dq_foreign_key(d: Domain) -> DataFrame:
    stops = quality.foreign_key(
        d.staged(t.TRIP), "destination_stop_id", d.dims["dim_stop"], "stop_id_nat", "trip_destination_stop"
    )
    paid = d.staged(t.PAYMENT).withColumn("payment_date_key", tm.date_key("created_at"))
    days = quality.foreign_key(
        paid, "payment_date_key", cal.calendar(d.spark), "date_key", "payment_date"
    )
    return stops.unionByName(days)


@query("dq_length")
def dq_length(d: Domain) -> DataFrame:
    return quality.too_long(d.table("part"), "p_name", 10, ["p_partkey"])


@query("dq_precision")
def dq_precision(d: Domain) -> DataFrame:
    """Line prices that do not fit seven digits with two decimals."""
    fits = quality.fits_decimal(F.col("l_extendedprice"), 7, 2)
    return d.table("lineitem").filter(~fits).select("l_orderkey", "l_linenumber", "l_extendedprice")


@query("dq_gate_counts")
def dq_gate_counts(d: Domain) -> DataFrame:
    return quality.gate_counts(d.mart_facts(), d.route_snapshot(), d.mart())


# Routes, positions, payments -----------------------------------------------------------------------


@query("route_stop_sequence")
def route_stop_sequence(d: Domain) -> DataFrame:
    return routes.stop_sequence(d.bridge())


@query("route_pattern_hash")
def route_pattern_hash(d: Domain) -> DataFrame:
    return routes.pattern_hash(routes.stop_sequence(d.bridge()))


@query("route_geometry")
def route_geometry(d: Domain) -> DataFrame:
    stops = conform(d.stops(), t.STOP, "b1", AS_OF)
    return routes.geometry(routes.stop_sequence(d.bridge()), stops)


@query("position_dedup")
def position_dedup(d: Domain) -> DataFrame:
    """Positions of which the moving ones are delivered twice."""
    once = d.staged(t.VEHICLE_POSITION)
    twice = once.unionByName(once.filter("speed_kmph > 50"))
    kept = deduplicate(twice)
    return kept.select(
        "raw_event_id", F.col("offset_in_partition").alias("event_id"), "vehicle_id", "route_id", "event_ts", "latitude",
        "longitude", "speed_kmph", "heading_deg", "nearest_stop_id", "partition_id")


@query("payments_from_trips")
def payments(d: Domain) -> DataFrame:
    return payments_from_trips(d.staged(t.TRIP)).drop("src_system", "currency_code")



