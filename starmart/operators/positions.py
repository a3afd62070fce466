"""Vehicle position events: event id and removal of repeated deliveries."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F


def raw_event_id(vehicle: Column, ts: Column) -> Column:
    """Vehicle and epoch second."""
    return F.concat_ws("-", vehicle.cast("string"), F.unix_timestamp(ts).cast("string"))


def deduplicate(positions: DataFrame, pick: str = "offset_in_partition") -> DataFrame:
    """One whole row per event id: the delivery with the lowest ``pick`` (a NULL one only if there is no other).

    Deliveries are folded in the map tasks, so a hot event id costs one row a task. Equal picks are told apart by a hash
    of the row.
    """
    order = F.struct(F.col(pick).isNull(), F.col(pick), F.xxhash64(*positions.columns))
    kept = positions.groupBy("raw_event_id").agg(F.min_by(F.struct(*positions.columns), order).alias("kept"))
    return kept.select("kept.*")
