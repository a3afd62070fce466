"""Stops of a route: sequence, pattern fingerprint, centre and terminals."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, functions as F

from starmart.functions.fingerprint import DNS_NAMESPACE, digest_to_uuid_hex, uuid5_hex
from starmart.functions.numeric import mean
from starmart.operators.ranking import ranked_within


def stop_sequence(bridge: DataFrame, partitions: int | None = None) -> DataFrame:
    """Number the stops of each route by stop id. Starts a job, see ``ranked_within``."""
    return ranked_within(bridge, "route_id", "stop_id", "stop_sequence", partitions)


def pattern_hash(sequenced: DataFrame, chunk: int = 10_000) -> DataFrame:
    """Name-based UUID of the comma-joined stop ids of each route, in sequence order.

    The text is built in chunks of at most ``chunk`` stops, so a very long route is spread over many
    groups. A route that fits one chunk is hashed by Spark's sha1; for a longer one the chunk texts,
    in order, are fed to one running sha1, which holds a chunk at a time.
    """
    part = F.floor((F.col("stop_sequence") - 1) / chunk).cast("int")
    ordered = F.array_sort(F.collect_list(F.struct("stop_sequence", "stop_id")))
    chunks = sequenced.groupBy("route_id", part.alias("_chunk")).agg(
        F.count("*").alias("_n"), F.array_join(ordered["stop_id"], ",").alias("_text")
    )
    whole = (F.col("_chunk") == 0) & (F.col("_n") < chunk)
    short = chunks.filter(whole).select("route_id", uuid5_hex(F.col("_text")).alias("pattern_hash"))
    long = (
        chunks.filter(~whole)
        .select("route_id", "_chunk", "_text")
        .repartition("route_id")
        .sortWithinPartitions("route_id", "_chunk")
        .mapInPandas(_running_sha1, "route_id string, digest string")
        .select("route_id", digest_to_uuid_hex(F.col("digest")).alias("pattern_hash"))
    )
    return short.unionByName(long)


def _running_sha1(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    route, state = None, None
    for batch in batches:
        done = []
        for next_route, text in zip(batch["route_id"], batch["_text"]):
            if state is not None and next_route == route:
                state.update(b",")
            else:
                if state is not None:
                    done.append((route, state.hexdigest()))
                route, state = next_route, hashlib.sha1(bytes.fromhex(DNS_NAMESPACE))
            state.update(text.encode())
        yield pd.DataFrame(done, columns=["route_id", "digest"])
    if state is not None:
        yield pd.DataFrame([(route, state.hexdigest())], columns=["route_id", "digest"])


def geometry(sequenced: DataFrame, stops: DataFrame) -> DataFrame:
    """Mean coordinate of the located stops of a route (NULL if there are none), and its first and last stop."""
    places = stops.select(F.col("stop_id").alias("_stop"), "latitude", "longitude").filter(
        F.col("latitude").isNotNull() & F.col("longitude").isNotNull()
    )
    located = sequenced.join(places, F.col("stop_id") == F.col("_stop"), "left")

    return located.groupBy("route_id").agg(
        mean("latitude", 6).alias("center_lat"), mean("longitude", 6).alias("center_lon"),
        F.min_by("stop_id", "stop_sequence").alias("first_stop"),
        F.max_by("stop_id", "stop_sequence").alias("last_stop"),
    )
