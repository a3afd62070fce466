"""Facts: resolve natural keys against dimensions, derive keys and measures, split off rejects.

No side is hinted: Catalyst broadcasts a dimension whose measured size is below the threshold, and
joins it by shuffle beyond that, where AQE splits the partitions of hot (or NULL) keys.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F

from starmart.functions.time import date_key, duration_sec, time_key
from starmart.operators.conform import all_of
from starmart.operators.scd2 import asof_lookup
from starmart.tables import (
    DEFAULT_CURRENCY, FACT_PAYMENT_COLUMNS, FACT_POSITION_COLUMNS, FACT_TRIP_COLUMNS,
)


@dataclass(frozen=True)
class Lookup:
    """Resolve ``key`` of the fact against ``nat`` of a dimension; the result is named ``out``."""

    dim: str
    key: str
    nat: str
    sk: str
    out: str


@dataclass(frozen=True)
class FactSpec:
    name: str
    lookups: tuple[Lookup, ...]
    derived: dict[str, Column]
    mandatory: tuple[str, ...]
    columns: tuple[str, ...]
    date_key: str
    #: The moment whose day picks the version of a versioned dimension, with ``resolve_on_day``.
    moment: str
    #: Natural key of the event.
    key: str
    #: Whether an event may come again in another batch, where its last delivery counts.
    redelivered: bool = False


def trip_spec() -> FactSpec:
    start, end = "start_ts", "end_ts"
    return FactSpec(
        "fact_trip",
        (
            Lookup("dim_user", "user_id", "user_id_nat", "user_sk", "user_sk"),
            Lookup("dim_route", "route_id", "route_id_nat", "route_sk", "route_sk"),
            Lookup("dim_vehicle", "vehicle_id", "vehicle_id_nat", "vehicle_sk", "vehicle_sk"),
            Lookup("dim_stop", "origin_stop_id", "stop_id_nat", "stop_sk", "origin_stop_sk"),
            Lookup("dim_stop", "destination_stop_id", "stop_id_nat", "stop_sk", "destination_stop_sk"),
            Lookup("dim_fare_product", "fare_product_id", "fare_product_id_nat",
                   "fare_product_sk", "fare_product_sk"),
        ),
        {
            "start_date_key": date_key(start), "start_time_key": time_key(start),
            "end_date_key": date_key(end), "end_time_key": time_key(end),
            "trip_duration_sec": duration_sec(start, end),
            "currency_code": F.coalesce("currency_code", F.lit(DEFAULT_CURRENCY)),
        },
        ("user_sk", "route_sk", "start_date_key", "start_time_key"),
        FACT_TRIP_COLUMNS,
        "start_date_key",
        start,
        "trip_id",
        True,
    )


def payment_spec() -> FactSpec:
    at = "created_at"
    return FactSpec(
        "fact_payment",
        (
            Lookup("dim_user", "user_id", "user_id_nat", "user_sk", "user_sk"),
            Lookup("dim_fare_product", "fare_product_id", "fare_product_id_nat",
                   "fare_product_sk", "fare_product_sk"),
        ),
        {
            "payment_date_key": date_key(at), "payment_time_key": time_key(at),
            "currency_code": F.coalesce("currency_code", F.lit(DEFAULT_CURRENCY)),
        },
        ("user_sk", "payment_date_key", "payment_time_key"),
        FACT_PAYMENT_COLUMNS,
        "payment_date_key",
        at,
        "payment_id",
        True,
    )


def position_spec() -> FactSpec:
    at = "event_ts"
    return FactSpec(
        "fact_vehicle_position",
        (
            Lookup("dim_vehicle", "vehicle_id", "vehicle_id_nat", "vehicle_sk", "vehicle_sk"),
            Lookup("dim_route", "route_id", "route_id_nat", "route_sk", "route_sk"),
            Lookup("dim_stop", "nearest_stop_id", "stop_id_nat", "stop_sk", "nearest_stop_sk"),
        ),
        {"date_key": date_key(at), "time_key": time_key(at)},
        ("vehicle_sk", "date_key", "time_key"),
        FACT_POSITION_COLUMNS,
        "date_key",
        at,
        "raw_event_id",
    )


def resolve(staged: DataFrame, dims: Mapping[str, DataFrame], lookups: Iterable[Lookup]) -> DataFrame:
    """Left join every lookup; an unknown member gives a NULL key.

    A dimension may be looked up in several roles. A later filter on a key turns its join into an
    inner join, which Catalyst does by itself.
    """
    for look in lookups:
        nat = f"_nat_{look.out}"
        side = dims[look.dim].select(F.col(look.nat).alias(nat), F.col(look.sk).alias(look.out))
        staged = staged.join(side, F.col(look.key) == F.col(nat), "left").drop(nat)
    return staged


def resolve_on_day(staged: DataFrame, dims: Mapping[str, DataFrame], spec: FactSpec, versioned: str = "dim_route") -> DataFrame:
    """``resolve``, but with the version of the versioned dimension that was valid on the day of the event.

    Its key is NULL for a day before the first version, as for an unknown member.
    """
    rows = resolve(staged, dims, [look for look in spec.lookups if look.dim != versioned])
    for look in (look for look in spec.lookups if look.dim == versioned):
        day = f"_day_{look.out}"
        dated = rows.withColumn(day, F.col(spec.moment).cast("date"))
        rows = asof_lookup(dated, dims[versioned], look.key, day, rows.columns).withColumnRenamed(look.sk, look.out)
    return rows


def fact_rows(staged: DataFrame, dims: Mapping[str, DataFrame], spec: FactSpec) -> DataFrame:
    """Accepted fact rows: every mandatory key is known."""
    rows = resolve(staged.withColumns(spec.derived), dims, spec.lookups)
    return rows.filter(all_of([F.col(c).isNotNull() for c in spec.mandatory])).select(*spec.columns)


def reject_reason(mandatory: Iterable[str]) -> Column:
    """Name of the first mandatory column that is NULL, or NULL for a good row."""
    return F.coalesce(*(F.when(F.col(c).isNull(), F.lit(c)) for c in mandatory))


def classified_rows(staged: DataFrame, dims: Mapping[str, DataFrame], spec: FactSpec, version: str = "current") -> DataFrame:
    """All rows with ``reject_reason``, for one write that keeps good rows and rejects apart.

    With ``version='as_of_event'`` routes are those of the day of the event, out of all versions; else ``dims`` holds one
    row per route.
    """
    derived = staged.withColumns(spec.derived)
    rows = resolve_on_day(derived, dims, spec) if version == "as_of_event" else resolve(derived, dims, spec.lookups)
    return rows.select(*spec.columns, reject_reason(spec.mandatory).alias("reject_reason"))


def fact_rejects(staged: DataFrame, dims: Mapping[str, DataFrame], spec: FactSpec) -> DataFrame:
    """Rejected rows only; lookups that cannot cause a reject are left out."""
    needed = [look for look in spec.lookups if look.out in spec.mandatory]
    rows = resolve(staged.withColumns(spec.derived), dims, needed)
    return rows.withColumn("reject_reason", reject_reason(spec.mandatory)).filter(
        F.col("reject_reason").isNotNull()
    )
