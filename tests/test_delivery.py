"""Trips that come again in another batch count once."""

from __future__ import annotations

from helpers import rows, texts
from pyspark.sql import functions as F

from starmart import tables as t
from starmart.operators.facts import trip_spec
from starmart.plans.warehouse import Warehouse, load_batch
from starmart.sources import tables as io
from test_warehouse import AS_OF, write_raw


def states(house):
    spec = trip_spec()
    return {(r.trip_id[:2], r.etl_batch_id): r.row_state for state in (io.ACCEPTED, io.REJECTED, io.SUPERSEDED)
            for r in house.facts(spec, t.TRIP, state).withColumn("row_state", F.lit(state)).collect()}


def trips_of_mart(house):
    return house.mart().agg(F.sum("trips_total")).first()[0]


def reload(house, raw, batch):
    house.load_staging(raw, batch, AS_OF)
    house.load_facts(batch, "b2", AS_OF)
    house.load_mart(batch, "b2", AS_OF)


def test_the_last_delivery_counts(spark, tmp_path):
    raw, root = str(tmp_path / "raw"), str(tmp_path / "house")
    write_raw(spark, f"{raw}/1")
    load_batch(spark, f"{raw}/1", root, "b1", AS_OF, first=True)
    house = Warehouse(spark, root)
    assert trips_of_mart(house) == 2 and states(house)["T1", "b1"] == "accepted"

    # The second batch delivers the same trips again, with one user more, so a rejected one becomes known.
    write_raw(spark, f"{raw}/2", extra_user=True)
    load_batch(spark, f"{raw}/2", root, "b2", AS_OF)
    assert states(house) == {
        ("T1", "b1"): "superseded", ("T2", "b1"): "superseded", ("T3", "b1"): "rejected", ("T4", "b1"): "rejected",
        ("T1", "b2"): "accepted", ("T2", "b2"): "accepted", ("T3", "b2"): "accepted", ("T4", "b2"): "rejected"}
    assert trips_of_mart(house) == 3
    kept = texts(house.mart().drop("etl_loaded_at"))
    house.load_mart(None, "b2", AS_OF)
    assert texts(house.mart().drop("etl_loaded_at")) == kept

    # Repeating the first batch leaves the later deliveries in force.
    reload(house, f"{raw}/1", "b1")
    assert states(house)["T1", "b1"] == "superseded" and states(house)["T1", "b2"] == "accepted" and trips_of_mart(house) == 3

    # A corrected second batch without those trips gives the earlier deliveries back.
    write_raw(spark, f"{raw}/3", day="2024-01-28", extra_user=True)
    reload(house, f"{raw}/3", "b2")
    assert {k: v for k, v in states(house).items() if k[1] == "b1"} == {
        ("T1", "b1"): "accepted", ("T2", "b1"): "accepted", ("T3", "b1"): "accepted", ("T4", "b1"): "rejected"}
    assert trips_of_mart(house) == 6
    kept = texts(house.mart().drop("etl_loaded_at"))
    house.load_mart(None, "b2", AS_OF)
    assert texts(house.mart().drop("etl_loaded_at")) == kept
    assert rows(house.constraints("b2", "b2").filter("violations > 0")) == []
