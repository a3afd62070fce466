"""Vehicle positions as a stream of files into staging and facts.

A micro-batch goes through the same operators as a batch load. Its id names its folder, which is
replaced when the micro-batch is repeated after a failure, so no position is stored twice.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQuery

from starmart.functions.time import ntz
from starmart.operators import scd2
from starmart.operators.facts import classified_rows, position_spec
from starmart.operators.positions import deduplicate
from starmart.plans.warehouse import Warehouse
from starmart.sources import tables as io
from starmart.tables import DIM_STOP, DIM_VEHICLE, VEHICLE_POSITION


def read_feed(spark: SparkSession, folder: str, schema: str, files_per_batch: int = 1000) -> DataFrame:
    """Position files as they arrive; the schema is declared, not inferred."""
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_batch).parquet(folder)


def load_positions(
    feed: DataFrame, house: Warehouse, snapshot: str, as_of, name: str = "positions", delay: str | None = None
) -> StreamingQuery:
    """Start loading what is available; returns the running query.

    Dimensions are read again for every micro-batch, so members added meanwhile are found. The stream's
    progress is kept in the warehouse, beside the tables whose folders it numbers. Events repeated within a
    micro-batch are stored once; with a ``delay`` (such as "2 hours") also those repeated across micro-batches, as long as
    they come within it: the stream then keeps the ids of that time as its state, and leaves out events that are later.
    The calendar follows the days of the events.
    """
    if delay:
        timed = feed.withColumn("_at", F.col("event_ts").cast("timestamp"))  # watermarks need a moment with a time zone
        feed = timed.withWatermark("_at", delay).dropDuplicatesWithinWatermark(["raw_event_id"]).drop("_at")

    def load(batch: DataFrame, number: int) -> None:
        if batch.isEmpty():  # a micro-batch that only moves the watermark on
            return
        batch_id = f"{name}-{number:012d}"
        house.stage(batch, VEHICLE_POSITION, batch_id, as_of)
        dims = {
            "dim_vehicle": house.dim(DIM_VEHICLE), "dim_stop": house.dim(DIM_STOP),
            "dim_route": scd2.current_only(house.routes(snapshot)),
        }
        spec = position_spec()
        staged = house.staged(VEHICLE_POSITION, batch_id)
        house.extend_calendar(staged.select(F.col("event_ts").cast("date")))
        rows = classified_rows(deduplicate(staged), dims, spec)
        io.write_facts(
            rows.withColumn("etl_loaded_at", ntz(as_of)), house.path("fact", spec.name), batch_id, spec.date_key
        )

    return (
        feed.writeStream.foreachBatch(load)
        .option("checkpointLocation", house.path("stream", name))
        .queryName(name)
        .trigger(availableNow=True)
        .start()
    )
