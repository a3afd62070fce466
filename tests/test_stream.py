"""Positions repeated across micro-batches and restarts are stored once."""

from __future__ import annotations

from helpers import frame, rows, texts
from pyspark.sql import functions as F

from starmart import tables as t
from starmart.operators.facts import position_spec
from starmart.operators.positions import deduplicate
from starmart.plans.warehouse import Warehouse, load_batch, run_stage
from starmart.sources import tables as io
from starmart.streaming.positions import load_positions, read_feed
from test_warehouse import AS_OF, write_raw

SCHEMA = "raw_event_id string, vehicle_id string, event_ts timestamp_ntz, latitude double, longitude double, offset_in_partition bigint"


def test_stream_with_repeats_equals_the_deduplicated_batch(spark, tmp_path):
    raw, root, feed = (str(tmp_path / x) for x in ("raw", "house", "feed"))
    write_raw(spark, raw)
    load_batch(spark, raw, root, "b1", AS_OF, first=True)
    house = Warehouse(spark, root)
    at = "2031-02-03 08:0{}:00"  # a day that the standard calendar lacks
    lots = [[("V1-1", "V1", at.format(1), 55.1, 37.1, 1), ("V1-2", "V1", at.format(2), 55.2, 37.2, 2), ("V1-1", "V1", at.format(1), 55.1, 37.1, 5)],
            [("V1-2", "V1", at.format(2), 55.2, 37.2, 7), ("V1-3", "V1", at.format(3), 55.3, 37.3, 8), ("V9-1", "V9", at.format(3), 55.3, 37.3, 9)],
            [("V1-3", "V1", at.format(3), 55.3, 37.3, 11), ("V1-4", "V1", at.format(4), 55.4, 37.4, 12)]]
    for lot in lots:  # each run is a restart that reads what is new
        frame(spark, SCHEMA, *lot).coalesce(1).write.mode("append").parquet(feed)
        load_positions(read_feed(spark, feed, SCHEMA), house, "b1", AS_OF, "dedup", "2 hours").awaitTermination()
    spec = position_spec()
    stored = house.facts(spec, t.VEHICLE_POSITION).filter("etl_batch_id like 'dedup-%'")
    expected = deduplicate(frame(spark, SCHEMA, *(r for lot in lots for r in lot))).filter("vehicle_id = 'V1'")
    assert texts(stored, "raw_event_id", "latitude") == texts(expected.select("raw_event_id", F.col("latitude").cast("decimal(9,6)")))
    assert house.facts(spec, t.VEHICLE_POSITION, io.REJECTED).filter("etl_batch_id like 'dedup-%'").count() == 1
    last = stored.agg(F.max("etl_batch_id")).first()[0]
    assert rows(house.constraints("b1", "b1").filter("violations > 0")) == []
    assert house.calendar().filter("date_key = 20310203").count() == 1 and last


def test_single_stages_equal_a_whole_load(spark, tmp_path):
    raw, whole, parts = (str(tmp_path / x) for x in ("raw", "whole", "parts"))
    write_raw(spark, raw)
    load_batch(spark, raw, whole, "b1", AS_OF, first=True)
    house = Warehouse(spark, parts)
    for name in ("staging", "generated", "dimensions", "routes", "facts", "mart"):
        run_stage(house, name, "b1", AS_OF, raw, first=True)
    run_stage(house, "facts", None, AS_OF, snapshot="b1")
    run_stage(house, "mart", None, AS_OF, snapshot="b1")
    other = Warehouse(spark, whole)
    assert texts(house.trips()) == texts(other.trips()) and texts(house.mart()) == texts(other.mart())
