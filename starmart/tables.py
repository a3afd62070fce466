"""Declared tables: columns, types, keys, defaults and mandatory columns.

Fixed values: the names, types, key columns, defaults and length limits below define the data model
and must stay as they are for results to match.
"""

from __future__ import annotations

from dataclasses import dataclass, field

DEFAULT_CURRENCY = "EUR"
OPEN_END = "9999-12-31"
CALENDAR_FIRST, CALENDAR_LAST = "2023-01-01", "2027-12-31"
STATUS_COMPLETED, STATUS_CANCELED = "completed", "canceled"

# Ordering that decides which staged record of a key is the latest one.
LATEST_ORDER = ("src_updated_at", "src_created_at", "etl_loaded_at")
LATEST_ORDER_VERSIONED = ("src_updated_at", "etl_loaded_at")


@dataclass(frozen=True)
class StagingSpec:
    """A staging table: ``columns`` maps each column, in order, to its type."""

    entity: str
    name: str
    key: str
    columns: dict[str, str]
    src_system: str = "oltp"
    src_stamps: bool = True
    required: tuple[str, ...] = ()
    lengths: dict[str, int] = field(default_factory=dict)

    @property
    def schema(self) -> dict[str, str]:
        audit = {"src_system": "string"}
        if self.src_stamps:
            audit |= {"src_created_at": "timestamp_ntz", "src_updated_at": "timestamp_ntz"}
        return self.columns | audit | {"etl_batch_id": "string", "etl_loaded_at": "timestamp_ntz"}

    @property
    def ddl(self) -> str:
        return ddl(self.schema)


def ddl(columns: dict[str, str]) -> str:
    return ", ".join(f"`{name}` {kind}" for name, kind in columns.items())


USER = StagingSpec(
    "users", "stg_user", "user_id",
    {
        "user_id": "string", "email": "string", "phone": "string", "full_name": "string",
        "registration_ts": "timestamp_ntz", "status": "string",
    },
    required=("user_id", "src_system", "etl_loaded_at"),
    lengths={"user_id": 64, "email": 255, "phone": 50, "full_name": 255, "status": 50},
)

FARE_PRODUCT = StagingSpec(
    "fare_products", "stg_fare_product", "fare_product_id",
    {
        "fare_product_id": "string", "product_name": "string", "fare_type": "string",
        "currency_code": "string", "base_price": "decimal(10,2)", "description": "string",
    },
    required=("fare_product_id", "product_name", "src_system", "etl_loaded_at"),
    lengths={"fare_product_id": 64, "product_name": 255, "fare_type": 50, "currency_code": 3},
)

STOP = StagingSpec(
    "stops", "stg_stop", "stop_id",
    {
        "stop_id": "string", "stop_code": "string", "stop_name": "string", "city": "string",
        "latitude": "decimal(9,6)", "longitude": "decimal(9,6)", "zone": "string",
    },
    required=("stop_id", "src_system", "etl_loaded_at"),
    lengths={"stop_id": 64, "stop_code": 64, "stop_name": 255, "city": 255, "zone": 64},
)

VEHICLE = StagingSpec(
    "vehicles", "stg_vehicle", "vehicle_id",
    {
        "vehicle_id": "string", "registration_number": "string", "vehicle_type": "string",
        "capacity": "int", "operator_name": "string",
    },
    src_system="oltp_or_stream",
    required=("vehicle_id", "src_system", "etl_loaded_at"),
    lengths={"vehicle_id": 64, "registration_number": 64, "vehicle_type": 50, "operator_name": 255},
)

ROUTE = StagingSpec(
    "routes", "stg_route", "route_id",
    {
        "route_id": "string", "route_code": "string", "route_name": "string",
        "route_type": "string", "description": "string", "route_pattern_hash": "string",
        "default_fare_product_id": "string", "valid_from_ts": "timestamp_ntz",
        "valid_to_ts": "timestamp_ntz", "is_active": "boolean",
    },
    required=("route_id", "route_code", "src_system", "etl_loaded_at"),
    lengths={
        "route_id": 64, "route_code": 64, "route_name": 255, "route_type": 50,
        "route_pattern_hash": 128, "default_fare_product_id": 64,
    },
)

TRIP = StagingSpec(
    "trips", "stg_trip", "trip_id",
    {
        "trip_id": "string", "user_id": "string", "route_id": "string", "vehicle_id": "string",
        "origin_stop_id": "string", "destination_stop_id": "string",
        "start_ts": "timestamp_ntz", "end_ts": "timestamp_ntz", "distance_meters": "int",
        "fare_product_id": "string", "fare_amount": "decimal(10,2)", "currency_code": "string",
        "trip_status": "string", "created_at": "timestamp_ntz", "updated_at": "timestamp_ntz",
    },
    src_stamps=False,
    required=("trip_id", "user_id", "src_system", "etl_loaded_at"),
    lengths={
        "trip_id": 64, "user_id": 64, "route_id": 64, "vehicle_id": 64, "origin_stop_id": 64,
        "destination_stop_id": 64, "fare_product_id": 64, "currency_code": 3, "trip_status": 50,
    },
)

PAYMENT = StagingSpec(
    "payments", "stg_payment", "payment_id",
    {
        "payment_id": "string", "user_id": "string", "fare_product_id": "string",
        "payment_method": "string", "amount": "decimal(10,2)", "currency_code": "string",
        "payment_status": "string", "external_txn_id": "string",
        "created_at": "timestamp_ntz", "updated_at": "timestamp_ntz",
    },
    src_stamps=False,
    required=("payment_id", "user_id", "src_system", "etl_loaded_at"),
    lengths={
        "payment_id": 64, "user_id": 64, "fare_product_id": 64, "payment_method": 50,
        "currency_code": 3, "payment_status": 50, "external_txn_id": 128,
    },
)

VEHICLE_POSITION = StagingSpec(
    "vehicle_positions", "stg_vehicle_position", "raw_event_id",
    {
        "raw_event_id": "string", "vehicle_id": "string", "route_id": "string",
        "event_ts": "timestamp_ntz", "latitude": "decimal(9,6)", "longitude": "decimal(9,6)",
        "speed_kmph": "decimal(6,2)", "heading_deg": "decimal(6,2)", "nearest_stop_id": "string",
        "partition_id": "int", "offset_in_partition": "bigint",
    },
    src_system="kafka_vehicle_positions",
    src_stamps=False,
    required=("vehicle_id", "event_ts", "latitude", "longitude", "src_system", "etl_loaded_at"),
    lengths={"raw_event_id": 128, "vehicle_id": 64, "route_id": 64, "nearest_stop_id": 64},
)

STAGING = (USER, FARE_PRODUCT, STOP, VEHICLE, ROUTE, TRIP, PAYMENT, VEHICLE_POSITION)


@dataclass(frozen=True)
class DimSpec:
    """An insert-only dimension. ``attributes`` maps dimension columns to SQL over staged columns."""

    name: str
    source: StagingSpec
    sk: str
    nat: str
    attributes: dict[str, str]
    schema: dict[str, str]


def _dim(name: str, source: StagingSpec, prefix: str, columns: dict[str, tuple[str, str]]) -> DimSpec:
    sk, nat = f"{prefix}_sk", f"{prefix}_id_nat"
    schema = {sk: "bigint", nat: "string"} | {c: kind for c, (_, kind) in columns.items()}
    schema |= {"src_system": "string", "etl_loaded_at": "timestamp_ntz"}
    return DimSpec(name, source, sk, nat, {c: sql for c, (sql, _) in columns.items()}, schema)


DIM_USER = _dim("dim_user", USER, "user", {
    "email": ("email", "string"), "phone": ("phone", "string"),
    "full_name": ("full_name", "string"),
    "registration_dt": ("cast(registration_ts as date)", "date"),
    "status": ("status", "string"),
})
DIM_VEHICLE = _dim("dim_vehicle", VEHICLE, "vehicle", {
    "registration_number": ("registration_number", "string"),
    "vehicle_type": ("vehicle_type", "string"), "capacity": ("capacity", "int"),
    "operator_name": ("operator_name", "string"),
})
DIM_STOP = _dim("dim_stop", STOP, "stop", {
    "stop_code": ("stop_code", "string"), "stop_name": ("stop_name", "string"),
    "city": ("city", "string"), "latitude": ("latitude", "decimal(9,6)"),
    "longitude": ("longitude", "decimal(9,6)"), "zone": ("zone", "string"),
})
DIM_FARE_PRODUCT = _dim("dim_fare_product", FARE_PRODUCT, "fare_product", {
    "product_name": ("product_name", "string"), "fare_type": ("fare_type", "string"),
    "currency_code": (f"coalesce(currency_code, '{DEFAULT_CURRENCY}')", "string"),
    "base_price": ("base_price", "decimal(10,2)"), "description": ("description", "string"),
})
DIMENSIONS = (DIM_USER, DIM_VEHICLE, DIM_STOP, DIM_FARE_PRODUCT)

DIM_ROUTE_SCHEMA = {
    "route_sk": "bigint", "route_id_nat": "string", "route_code": "string",
    "route_name": "string", "route_type": "string", "description": "string",
    "route_pattern_hash": "string", "default_fare_product_sk": "bigint", "valid_from": "date",
    "valid_to": "date", "is_current": "boolean", "src_system": "string",
    "etl_loaded_at": "timestamp_ntz",
}
# Attributes whose change makes a new version of a route.
ROUTE_TRACKED = (
    "route_code", "route_name", "route_type", "description", "route_pattern_hash",
    "default_fare_product_sk",
)

FACT_TRIP_COLUMNS = (
    "trip_id", "user_sk", "route_sk", "vehicle_sk", "origin_stop_sk", "destination_stop_sk",
    "start_date_key", "start_time_key", "end_date_key", "end_time_key", "fare_product_sk",
    "trip_duration_sec", "distance_meters", "fare_amount", "currency_code", "trip_status",
    "created_at",
)
FACT_PAYMENT_COLUMNS = (
    "payment_id", "user_sk", "fare_product_sk", "payment_date_key", "payment_time_key",
    "payment_method", "amount", "currency_code", "payment_status", "external_txn_id", "created_at",
)
FACT_POSITION_COLUMNS = (
    "raw_event_id", "vehicle_sk", "route_sk", "date_key", "time_key", "latitude", "longitude",
    "speed_kmph", "heading_deg", "nearest_stop_sk",
)

MART_SCHEMA = {
    "route_id_nat": "string", "route_code": "string", "route_name": "string",
    "route_type": "string", "start_hour": "timestamp_ntz", "trips_total": "bigint",
    "trips_completed": "bigint", "trips_canceled": "bigint", "avg_trip_duration_sec": "double",
    "total_distance_m": "double", "avg_distance_m": "double", "total_fare_amount": "double",
    "avg_fare_amount": "double", "etl_loaded_at": "timestamp_ntz",
}
MART_KEY = ("route_id_nat", "start_hour")
