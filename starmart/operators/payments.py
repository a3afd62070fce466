"""Payments derived from completed trips."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from starmart.functions.time import NTZ
from starmart.tables import STATUS_COMPLETED

# Fixed values.
METHODS = ("card", "apple_pay", "google_pay", "cash")
PAID_SHARE = 0.95
SPAN = 1 << 16


def draw(key: Column, purpose: str) -> Column:
    """A repeatable draw from 0 .. 65535 for a key; each purpose has draws of its own."""
    digest = F.md5(F.concat(F.lit(purpose + ":"), key.cast("string")))
    return F.conv(F.substring(digest, 1, 4), 16, 10).cast("int")


def payments_from_trips(trips: DataFrame, share: float = PAID_SHARE) -> DataFrame:
    """A payment for ``share`` of the completed trips, made 0 to 5 minutes before the start.

    Random draws are replaced by draws from a hash of the trip id, so the result does not depend on
    the partitioning and a lost task repeats it exactly.
    """
    trip = F.col("trip_id")
    paid = trips.filter(
        (F.col("trip_status") == STATUS_COMPLETED) & (draw(trip, "paid") < int(share * SPAN))
    )
    method = F.element_at(F.array(*map(F.lit, METHODS)), draw(trip, "method") % len(METHODS) + 1)
    early = F.make_dt_interval(mins=draw(trip, "early") % 6)
    delay = F.make_dt_interval(mins=draw(trip, "delay") % 6)
    created = (F.col("start_ts") - early).cast(NTZ)
    return paid.select(
        F.concat(F.lit("PAY-"), trip.cast("string")).alias("payment_id"),
        "user_id",
        "fare_product_id",
        method.alias("payment_method"),
        F.col("fare_amount").alias("amount"),
        "currency_code",
        F.lit("success").alias("payment_status"),
        F.md5(F.concat(F.lit("txn:"), trip.cast("string"))).alias("external_txn_id"),
        created.alias("created_at"),
        (created + delay).cast(NTZ).alias("updated_at"),
        F.lit("oltp").alias("src_system"),
    )
