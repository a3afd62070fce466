"""Star against mart: both results, their comparison and the run metrics as files."""

from __future__ import annotations

import time

from pyspark.sql import DataFrame

from starmart.operators.reconcile import compare
from starmart.plans import analytics
from starmart.plans.warehouse import Warehouse
from starmart.sources import tables as io


def write_comparison(
    house: Warehouse, snapshot: str, out: str, as_of, days: int = 7, how: str = "full_outer"
) -> dict[str, float | int]:
    """Store the route-hours of star and mart, then compare the stored results.

    Both sides are whole: a limit would turn cut-off rows into differences.
    """
    spark = house.spark
    digits = (2, 2, 2)
    sides: dict[str, DataFrame] = {
        "star": analytics.star_route_hour(
            house.trips(), house.routes(snapshot), None, None, as_of, days, None, digits),
        "mart": analytics.route_hour(house.mart(), as_of, days, None, digits),
    }
    metrics: dict[str, float | int] = {}
    stored = {}
    for name, df in sides.items():
        counted, seen = io.counted(df)
        began = time.perf_counter()
        io.write_csv(counted, f"{out}/route_hour_{name}")
        metrics[f"{name}_query_seconds"] = time.perf_counter() - began
        metrics[f"{name}_rows"] = seen.get["rows"]
        schema = io.ddl(dict(df.dtypes))
        stored[name] = spark.read.schema(schema).option("header", True).csv(f"{out}/route_hour_{name}")
    io.write_csv(
        compare(stored["star"], stored["mart"], how=how, suffixes=("_star", "_mart")),
        f"{out}/route_hour_comparison",
    )
    io.write_metrics(spark, metrics, f"{out}/performance_metrics")
    return metrics
