"""Route x hour mart."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F

from starmart.functions import sqltext as x
from starmart.operators.dedup import latest_by_key
from starmart.tables import MART_KEY, STATUS_CANCELED, STATUS_COMPLETED

ROUTE_COLUMNS = ("route_id_nat", "route_code", "route_name", "route_type")


MEASURES = {"duration": "trip_duration_sec", "distance": "distance_meters", "fare": "fare_amount"}


def _status_count(statuses: Sequence[str]) -> str:
    return f"count_if(trip_status in ({', '.join(repr(s) for s in statuses)}))"


def route_hour_sums(
    fact_trip: DataFrame,
    completed: Sequence[str] = (STATUS_COMPLETED,),
    canceled: Sequence[str] = (STATUS_CANCELED,),
) -> DataFrame:
    """Mergeable sums and counts per route key and hour; rows without a valid hour drop out.

    Grouping by three integers before any join keeps the hash table narrow, and partial aggregation
    folds a hot route inside the map tasks. The hour is built from aggregates of the group keys: a
    condition on the keys themselves would be pushed down and be checked per row instead of per group.
    """
    sums = [f"sum({c}) as {m}_sum, count({c}) as {m}_n" for m, c in MEASURES.items()]
    return fact_trip.sparkSession.sql(f"""
        select * except (date, hour) from (
            select *, {x.keys_to_hour('date', 'hour')} as start_hour from (
                select route_sk, max(start_date_key) as date, max({x.key_hour('start_time_key')}) as hour,
                       count(*) as trips_total, {_status_count(completed)} as trips_completed,
                       {_status_count(canceled)} as trips_canceled, {', '.join(sums)}
                from {{fact}} where {x.valid_time_key('start_time_key')}
                group by route_sk, start_date_key, {x.key_hour('start_time_key')}))
        where start_hour is not null""", fact=fact_trip)


def build_mart(
    fact_trip: DataFrame, dim_route: DataFrame, as_of, version: str = "current", **statuses
) -> DataFrame:
    """Hourly measures per route, of the facts; see ``mart_of_sums``."""
    return mart_of_sums(route_hour_sums(fact_trip, **statuses), dim_route, as_of, version)


def mart_of_sums(sums: DataFrame, dim_route: DataFrame, as_of, version: str = "current") -> DataFrame:
    """Hourly measures per route, of sums per route key and hour; several rows of a key and hour add up.

    ``version='current'`` keeps only facts that point to a current route version, so facts of older
    versions leave the mart. ``version='by_key'`` books them on the current version of their route, and
    ``version='as_booked'`` on the version they point to.
    """
    route = ", ".join(ROUTE_COLUMNS)
    if version == "current":
        keyed = f"select route_sk, {route} from {{routes}} where is_current"
    elif version == "by_key":
        keyed = f"""select route_sk, {route} from (select route_sk, route_id_nat from {{routes}})
                    join (select {route} from {{routes}} where is_current) using (route_id_nat)"""
    elif version == "as_booked":
        keyed = f"select route_sk, {route} from {{routes}}"
    else:
        raise ValueError(f"version must be 'current', 'by_key' or 'as_booked', not {version!r}")
    mean = {m: x.ratio(f"sum({m}_sum)", f"sum({m}_n)") for m in MEASURES}
    return sums.sparkSession.sql(f"""
        select {route}, start_hour, sum(trips_total) as trips_total,
               sum(trips_completed) as trips_completed, sum(trips_canceled) as trips_canceled,
               {mean['duration']} as avg_trip_duration_sec,
               cast(sum(distance_sum) as double) as total_distance_m,
               {mean['distance']} as avg_distance_m,
               cast(sum(fare_sum) as double) as total_fare_amount,
               {mean['fare']} as avg_fare_amount,
               {x.ntz(as_of)} as etl_loaded_at
        from {{sums}} join ({keyed}) using (route_sk)
        group by {route}, start_hour""", sums=sums, routes=dim_route)


SUMS = ("trips_total", "trips_completed", "trips_canceled", *(f"{m}_{k}" for m in MEASURES for k in ("sum", "n")))


def adjusted_sums(state: DataFrame, former: DataFrame, new: DataFrame) -> DataFrame:
    """Sums per route key and hour after a batch replaces its ``former`` contribution by a ``new`` one.

    All three hold the columns of ``route_hour_sums``; the former ones are taken back, and keys and hours without trips
    drop out. Sums are exact, so the result equals sums of all facts.
    """
    back = former.withColumns({c: -F.col(c) for c in SUMS})
    moved = state.unionByName(back).unionByName(new)
    total = moved.groupBy("route_sk", "start_hour").agg(*(F.sum(c).alias(c) for c in SUMS)).where("trips_total <> 0")
    # Without values left a sum is NULL, as if there had never been any.
    return total.withColumns({f"{m}_sum": F.when(F.col(f"{m}_n") != 0, F.col(f"{m}_sum")) for m in MEASURES})


def dropped_hours(fact_trip: DataFrame) -> DataFrame:
    """How many fact rows there are and how many have no valid hour, in one pass."""
    at = x.keys_to_timestamp("start_date_key", "start_time_key")
    return fact_trip.selectExpr(f"{at} as at").agg(
        F.count("*").alias("rows_total"), F.count_if(F.col("at").isNull()).alias("rows_without_hour")
    )


def replace_by_key(mart: DataFrame, keys: Sequence[str] = MART_KEY) -> DataFrame:
    """Of rows with the same key keep the one loaded last."""
    return latest_by_key(mart, list(keys), ["etl_loaded_at"])

