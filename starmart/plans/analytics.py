"""The analytical questions, each on the mart and on the star, as Spark SQL.

``as_of`` stands for "now" everywhere, so results repeat. All windows include their lower end.
"""

from __future__ import annotations

from pyspark.sql import DataFrame

from starmart.functions import sqltext as x
from starmart.tables import STATUS_CANCELED, STATUS_COMPLETED

ROUTE_HOUR_COLUMNS = (
    "route_code", "route_name", "route_type", "start_hour", "trips_total", "trips_completed",
    "trips_canceled", "avg_trip_duration_sec", "avg_distance_m", "avg_fare_amount",
)
AVERAGES = ("avg_trip_duration_sec", "avg_distance_m", "avg_fare_amount")


def run(text: str, **frames: DataFrame) -> DataFrame:
    """A query over the given frames, which the text names in braces."""
    spark = next(iter(frames.values())).sparkSession
    return spark.sql(text, **frames)


def since(as_of, days: int) -> str:
    return f"({x.ntz(as_of)} - interval '{int(days)}' day)"


def recent_hours(mart: DataFrame, as_of, days: int) -> str:
    """Condition for the last ``days`` days; on the stored mart it also prunes date partitions."""
    start = since(as_of, days)
    pruned = f"start_date >= cast({start} as date) and " if "start_date" in mart.columns else ""
    return f"{pruned}start_hour >= {start}"


def newest_first(limit: int | None, ties: str) -> str:
    """Top rows by hour and route; ``ties`` makes the order total, so the cut is repeatable."""
    return "" if limit is None else f"order by start_hour desc, route_code, {ties} limit {int(limit)}"


def _performance(digits: tuple[int, int, int]) -> str:
    rounds = {n: f"{x.rounded(n, d)} as {n}" for n, d in zip(AVERAGES, digits)}
    return ", ".join(rounds.get(c, c) for c in ROUTE_HOUR_COLUMNS)


def route_hour(
    mart: DataFrame, as_of, days: int = 7, limit: int | None = 200, digits=(1, 1, 2)
) -> DataFrame:
    """Route-hour performance from the mart. The cut comes first, so few rows are rounded."""
    return run(f"""
        select {_performance(digits)} from (
            select * from {{mart}} where {recent_hours(mart, as_of, days)}
            {newest_first(limit, 'route_name, route_type, route_id_nat')})
        """, mart=mart)


def latest_hours(mart: DataFrame, limit: int = 10) -> DataFrame:
    return run(f"""
        select route_code, start_hour, trips_total, avg_trip_duration_sec, total_fare_amount
        from {{mart}} {newest_first(limit, 'route_id_nat')}
        """, mart=mart)


def _share_of_type(base: str) -> str:
    # At most 24 rows per route type reach the window.
    share = x.rounded(x.ratio("trips", "sum(trips) over (partition by route_type)"), 3)
    return f"select *, {share} as share_in_type from ({base}) order by route_type, hour"


def peak_hours(mart: DataFrame, as_of, days: int = 7) -> DataFrame:
    """Trips per route type and hour of day, and their share within the type."""
    return run(_share_of_type(f"""
        select route_type, hour(start_hour) as hour, sum(trips_total) as trips
        from {{mart}} where {recent_hours(mart, as_of, days)} group by all"""), mart=mart)


def _trend(base: str) -> str:
    rate = x.rounded(x.ratio("canceled", "total"), 3)
    return f"""
        select route_code, week_start, cast(fare as double) as fare_sum, canceled, total,
               {rate} as cancel_rate
        from ({base}) order by week_start desc, fare_sum desc"""


def weekly_trend(mart: DataFrame, as_of, days: int = 56, week: str = "sunday") -> DataFrame:
    """Fares, cancellations and cancel rate per route and week, from the mart.

    Hourly totals are exact to the cent; adding them as decimals keeps the sum independent of order.
    """
    return run(_trend(f"""
        select route_code, {x.week_start('start_hour', week)} as week_start,
               sum(cast(total_fare_amount as decimal(28,2))) as fare,
               sum(trips_canceled) as canceled, sum(trips_total) as total
        from {{mart}} where {recent_hours(mart, as_of, days)} group by all"""), mart=mart)


def _recent_trips(as_of, days: int, joined: bool) -> str:
    """Facts of the last ``days`` days with their date and hour of day.

    The date-key range prunes fact partitions and row groups before any join. Calendar and clock have
    a fixed number of rows (one per day, one per second of the day), so they may be broadcast. As the
    clock holds every second and the stored calendar every day of the loaded facts, the same rows come
    from checking that the keys are a date and a time, which costs no join.
    """
    start = since(as_of, days)
    first_key = x.date_key(start)
    at = x.keys_to_timestamp("start_date_key", "start_time_key")
    recent = f"start_date_key >= {first_key} and (start_date_key > {first_key} or {at} >= {start})"
    if joined:
        return f"""
            select /*+ broadcast(d), broadcast(c) */ f.*, d.full_date, cast(c.hour as int) as hour
            from {{fact}} f
            join {{dates}} d on d.date_key = f.start_date_key
            join {{clock}} c on c.time_key = f.start_time_key
            where {recent}"""
    return f"""
        select *, {x.key_hour('start_time_key')} as hour, {x.key_to_date('start_date_key')} as full_date
        from {{fact}}
        where {recent} and {x.valid_time_key('start_time_key')}
          and {x.key_to_date('start_date_key')} is not null"""


def _star(
    fact_trip: DataFrame, dim_route: DataFrame, dim_date: DataFrame | None, dim_time: DataFrame | None,
    as_of, days: int, keys: str, group: str, folded: str, merged: str, wrap,
) -> DataFrame:
    """Fold trips per route key and ``keys``, then merge to ``group`` of the current routes.

    Folding before the route join lets it see one row per group and not one per trip, and hashes
    integers instead of names; merging is needed because route keys may share a name or type.
    """
    frames = {"fact": fact_trip, "routes": dim_route}
    joined = dim_date is not None and dim_time is not None
    if joined:
        frames |= {"dates": dim_date, "clock": dim_time}
    return run(wrap(f"""
        select {group}, {merged}
        from (select route_sk, {keys}, {folded}
              from ({_recent_trips(as_of, days, joined)}) group by all) f
        join (select route_sk, route_code, route_name, route_type from {{routes}} where is_current) r
          on r.route_sk = f.route_sk
        group by all"""), **frames)


def _flag(status: str) -> str:
    """Count of a status; NULL where no row of the group has a status at all."""
    return f"sum(cast(trip_status = '{status}' as int))"


def star_route_hour(
    fact_trip: DataFrame, dim_route: DataFrame, dim_date: DataFrame | None, dim_time: DataFrame | None,
    as_of, days: int = 7, limit: int | None = 200, digits=(1, 1, 2),
) -> DataFrame:
    """Route-hour performance from the star."""
    sums = {"avg_trip_duration_sec": "trip_duration_sec", "avg_distance_m": "distance_meters",
            "avg_fare_amount": "fare_amount"}
    folded = [f"sum({c}) as s_{c}, count({c}) as n_{c}" for c in sums.values()]
    merged = [f"{x.ratio(f'sum(s_{c})', f'sum(n_{c})')} as {name}" for name, c in sums.items()]
    return _star(
        fact_trip, dim_route, dim_date, dim_time, as_of, days,
        keys="start_date_key, hour",
        group=f"""route_code, route_name, route_type,
                  {x.keys_to_hour('start_date_key', 'hour')} as start_hour""",
        folded=f"""count(*) as n, {_flag(STATUS_COMPLETED)} as done, {_flag(STATUS_CANCELED)} as off,
                   {', '.join(folded)}""",
        merged=f"""sum(n) as trips_total, sum(done) as trips_completed, sum(off) as trips_canceled,
                   {', '.join(merged)}""",
        wrap=lambda q: f"""select {_performance(digits)}
                           from (select * from ({q}) {newest_first(limit, 'route_name, route_type')})""",
    )


def star_peak_hours(
    fact_trip: DataFrame, dim_route: DataFrame, dim_date: DataFrame | None, dim_time: DataFrame | None,
    as_of, days: int = 7,
) -> DataFrame:
    """Trips per route type and hour of day, and their share within the type, from the star."""
    return _star(
        fact_trip, dim_route, dim_date, dim_time, as_of, days, keys="hour", group="route_type, hour",
        folded="count(*) as n", merged="sum(n) as trips", wrap=_share_of_type,
    )


def star_weekly_trend(
    fact_trip: DataFrame, dim_route: DataFrame, dim_date: DataFrame | None, dim_time: DataFrame | None,
    as_of, days: int = 56, week: str = "monday",
) -> DataFrame:
    """Fares, cancellations and cancel rate per route and week, from the star."""
    return _star(
        fact_trip, dim_route, dim_date, dim_time, as_of, days,
        keys=f"{x.week_start('full_date', week)} as week_start", group="route_code, week_start",
        folded=f"sum(fare_amount) as fare, {_flag(STATUS_CANCELED)} as canceled, count(*) as total",
        merged="sum(fare) as fare, sum(canceled) as canceled, sum(total) as total", wrap=_trend,
    )
