"""One accepted fact per event, however often and in whatever batch it is delivered.

An index has the hash of the natural key of every accepted fact with its batch, the position of that batch in the order of
loads, and its date. The last delivery of a key wins; the earlier ones stay stored, marked as superseded. Only keys that a
batch brings, or brought in its former run, are looked up, and only the partitions that hold them elsewhere are marked.
A rejected delivery displaces nothing. Keys are compared by 64-bit hashes.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

#: Parts of the index, so that a lookup joins like with like.
BUCKETS = 16
INDEX = {"key_hash": "bigint", "position": "int", "cell": "int", "etl_batch_id": "string", "bucket": "int"}


def index_rows(facts: DataFrame, key: str, date_key: str, position) -> DataFrame:
    """Index entries of accepted facts; ``position`` is the place of their batch, as a number or a column."""
    h = F.xxhash64(key)
    place = position if not isinstance(position, int) else F.lit(position)
    return facts.select(
        h.alias("key_hash"), place.cast("int").alias("position"), F.col(date_key).alias("cell"), "etl_batch_id",
        F.pmod(h, F.lit(BUCKETS)).cast("int").alias("bucket")).distinct()


def touched_entries(index: DataFrame, keys: DataFrame) -> DataFrame:
    """Index entries of the given keys, each with the last position that delivers its key."""
    found = index.join(keys.select("bucket", "key_hash").distinct(), ["bucket", "key_hash"], "left_semi")
    last = found.groupBy("bucket", "key_hash").agg(F.max("position").alias("last"))
    return found.join(last, ["bucket", "key_hash"])


def marked(facts: DataFrame, key: str, entries: DataFrame) -> DataFrame:
    """Facts with ``superseded``: whether a later batch than their own delivers their key."""
    later = entries.where("position < last").select("key_hash", F.col("etl_batch_id").alias("_batch")).distinct()
    on = (F.xxhash64(key) == F.col("key_hash")) & (F.col("etl_batch_id") == F.col("_batch"))
    return facts.join(later, on, "left").withColumn("superseded", F.col("_batch").isNotNull()).drop("key_hash", "_batch")
