from __future__ import annotations

from helpers import frame, rows, texts
from pyspark.sql import functions as F

from starmart import tables as t
from starmart.operators.conform import apply_defaults, batch_rows, cast_failures, conform

AS_OF = "2024-02-01 00:00:00"


def test_columns_types_and_audit(spark):
    raw = frame(spark, "extra int, user_id bigint, full_name string", (1, 7, "A"))
    out = conform(raw, t.USER, "b7", AS_OF)
    assert dict(out.dtypes) == t.USER.schema
    assert out.columns == list(t.USER.schema)
    row = out.first()
    assert (row.user_id, row.email, row.src_system, row.etl_batch_id) == ("7", None, "oltp", "b7")
    assert row.src_created_at is None and str(row.etl_loaded_at) == AS_OF


def test_source_default_only_where_the_column_is_absent(spark):
    raw = frame(spark, "vehicle_id string, src_system string", ("v1", None), ("v2", "x"))
    assert rows(conform(raw, t.VEHICLE, "b", AS_OF), "vehicle_id", "src_system") == [("v1", None), ("v2", "x")]
    assert conform(raw.drop("src_system"), t.VEHICLE, "b", AS_OF).first().src_system == "oltp_or_stream"
    position = frame(spark, "vehicle_id string", ("v1",))
    assert conform(position, t.VEHICLE_POSITION, "b", AS_OF).first().src_system == "kafka_vehicle_positions"


def test_money_is_rounded_to_the_declared_decimal(spark):
    raw = frame(spark, "trip_id string, fare_amount double, vehicle_id int", ("t1", 2.345, None), ("t2", 1e12, None))
    out = conform(raw, t.TRIP, "b", AS_OF)
    assert texts(out, "trip_id", "fare_amount", "vehicle_id") == [("t1", "2.35", None), ("t2", None, None)]
    failed = cast_failures(raw, t.TRIP)
    assert rows(failed.select("trip_id", F.col("failed_columns")[0])) == [("t2", "fare_amount")]


def test_zoned_stamps_become_zone_less_utc(spark):
    raw = frame(spark, "route_id string, valid_from_ts timestamp, is_active string", ("r", "2024-01-01 10:00:00+02:00", "true"))
    out = conform(raw, t.ROUTE, "b", AS_OF)
    assert texts(out, "valid_from_ts", "is_active") == [("2024-01-01 08:00:00", "true")]


def test_batch_filter(spark):
    df = frame(spark, "k int, etl_batch_id string", (1, "a"), (2, "b"), (3, None))
    assert rows(batch_rows(df, "a"), "k") == [(1,)]
    assert batch_rows(df, None).count() == 3


def test_defaults_fill_nulls(spark):
    df = frame(spark, "k int, currency_code string", (1, None), (2, "USD"))
    assert rows(apply_defaults(df, {"currency_code": "EUR"})) == [(1, "EUR"), (2, "USD")]
