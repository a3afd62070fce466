"""Headline queries on a stored star and mart; prints one JSON line.

The star (facts, dimensions, calendar, clock) and the mart are stored once from the given tables, as a
load would leave them. Then every query runs on the stored tables, ``RUNS`` times after a warm-up, and
its median counts. Queries with few result rows are timed including the fetch into pandas, as a client
would see them; the others run to a sink that drops the rows.
"""

from __future__ import annotations

import json
import logging
import os
import statistics
import sys
import tempfile
import time
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from starmart import tables as t
from starmart.adapters import AS_OF, Domain
from starmart.operators import facts as facts_op
from starmart.operators.calendar import calendar, clock
from starmart.operators.mart import build_mart
from starmart.operators.reconcile import compare
from starmart.plans import analytics
from starmart.plans.warehouse import fact_schema
from starmart.session import build_session
from starmart.sources import tables as io

RUNS = 5


def fetch(df: DataFrame) -> None:
    df.toPandas()


def drain(df: DataFrame) -> None:
    df.write.format("noop").mode("overwrite").save()


class Stored:
    """Star and mart on disk."""

    def __init__(self, spark: SparkSession, folder: str, root: str):
        self.spark, self.root = spark, root
        domain = Domain(spark, folder)
        for name in ("dim_user", "dim_vehicle", "dim_stop", "dim_fare_product", "dim_route"):
            domain.dims[name].write.parquet(f"{root}/{name}")
            domain.dims[name] = spark.read.parquet(f"{root}/{name}")
        calendar(spark).write.parquet(f"{root}/dim_date")
        clock(spark).write.parquet(f"{root}/dim_time")
        io.write_batch(domain.staged(t.TRIP), f"{root}/stg_trip", "b1")
        self.dims = domain.dims
        self.date, self.time = (spark.read.parquet(f"{root}/{n}") for n in ("dim_date", "dim_time"))
        self.spec = facts_op.trip_spec()
        staged = io.read_table(spark, f"{root}/stg_trip", t.TRIP.schema)
        self.staged = staged
        rows = facts_op.classified_rows(staged, self.dims, self.spec)
        io.write_facts(rows, f"{root}/fact_trip", "b1", self.spec.date_key)
        schema = {k: v for k, v in fact_schema(self.spec, t.TRIP).items() if k != "etl_loaded_at"}
        self.trips = io.read_facts(spark, f"{root}/fact_trip", schema)
        io.write_mart(self.fresh_mart(), f"{root}/mart", reload_all=True)
        self.mart = io.read_table(spark, f"{root}/mart", t.MART_SCHEMA | {"start_date": "date"})

    def fresh_mart(self) -> DataFrame:
        return build_mart(self.trips, self.dims["dim_route"], AS_OF)

    def star(self, joined: bool = False) -> tuple[DataFrame | None, ...]:
        """Facts and routes; with ``joined`` also calendar and clock, to look the keys up there."""
        return self.trips, self.dims["dim_route"], *((self.date, self.time) if joined else (None, None))


def headline(s: Stored) -> dict[str, tuple[Callable[[], DataFrame], Callable[[DataFrame], None]]]:
    wide = (2, 2, 2)

    def both() -> DataFrame:
        left = analytics.star_route_hour(*s.star(), AS_OF, 7, None, wide)
        return compare(left, analytics.route_hour(s.mart, AS_OF, 7, None, wide), how="full_outer")

    return {
        "fact_trip": (lambda: facts_op.fact_rows(s.staged, s.dims, s.spec), drain),
        "mart_route_hour": (s.fresh_mart, drain),
        "route_hour_7d": (lambda: analytics.route_hour(s.mart, AS_OF), fetch),
        "route_hour_mart_5000": (lambda: analytics.route_hour(s.mart, AS_OF, 7, 5000, wide), fetch),
        "route_hour_star_5000": (
            lambda: analytics.star_route_hour(*s.star(), AS_OF, 7, 5000, wide), fetch),
        "route_hour_star_joined_5000": (
            lambda: analytics.star_route_hour(*s.star(True), AS_OF, 7, 5000, wide), fetch),
        "peak_hour_share": (lambda: analytics.peak_hours(s.mart, AS_OF), fetch),
        "weekly_trend": (lambda: analytics.weekly_trend(s.mart, AS_OF), fetch),
        "dwh_peak_hour_share": (lambda: analytics.star_peak_hours(*s.star(), AS_OF), fetch),
        "dwh_weekly_trend": (lambda: analytics.star_weekly_trend(*s.star(), AS_OF), fetch),
        "reconcile_full": (both, drain),
    }


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = build_session(
        "bench", f"local[{cpus}]", spark__sql__shuffle__partitions=cpus,
        spark__ui__enabled="false", spark__driver__memory="16g",
    )
    spark.sparkContext.setLogLevel("ERROR")
    logging.getLogger("py4j").setLevel(logging.ERROR)
    began = time.perf_counter()
    stored = Stored(spark, folder, tempfile.mkdtemp(prefix="bench-") + "/star")
    load = time.perf_counter() - began
    medians = {}
    for name, (build, finish) in headline(stored).items():
        times = []
        for _ in range(RUNS + 2):
            began = time.perf_counter()
            finish(build())
            times.append(time.perf_counter() - began)
        medians[name] = round(statistics.median(times[2:]), 4)
        print(name, [round(x, 3) for x in times], file=sys.stderr)
    print(json.dumps({
        "metric": "median_total", "value": round(sum(medians.values()), 4), "unit": "sec",
        "queries": medians, "sf": folder.rstrip("/").rsplit("sf", 1)[-1], "cpus": int(cpus),
        "runs": RUNS, "load_sec": round(load, 2),
    }))


if __name__ == "__main__":
    main()
