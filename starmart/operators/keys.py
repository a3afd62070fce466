"""Surrogate keys that depend on the data alone, without a single-task sort."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F


def assign_surrogate_keys(
    members: DataFrame, nat: str, sk: str, start: Column | int = 0, hex_digits: int = 4
) -> DataFrame:
    """Number the members 1, 2, ... above ``start`` in the order of the md5 of their natural key.

    A member's number is its rank inside its bucket plus the number of members in lower buckets. A
    bucket is a prefix of the md5, so buckets are even whatever the keys look like, and there are at
    most ``16 ** hex_digits`` of them, 65536 by default: that bounds the broadcast side and the running
    sum over it. ``members`` is read twice, so a caller with a costly plan writes it first.
    """
    digest = F.md5(F.col(nat).cast("string"))
    bucketed = members.withColumn("_md5", digest).withColumn(
        "_bucket", F.substring("_md5", 1, hex_digits)
    )
    sizes = bucketed.groupBy("_bucket").agg(F.count("*").alias("_n"))
    below = Window.partitionBy(F.lit(0)).orderBy("_bucket").rowsBetween(
        Window.unboundedPreceding, Window.currentRow
    )
    offsets = sizes.select("_bucket", (F.sum("_n").over(below) - F.col("_n")).alias("_below"))
    inside = Window.partitionBy("_bucket").orderBy("_md5", nat)
    base = start if isinstance(start, Column) else F.lit(start)
    return (
        bucketed.withColumn("_rank", F.row_number().over(inside))
        .join(F.broadcast(offsets), "_bucket")
        .select(
            (F.coalesce(base, F.lit(0)) + F.col("_below") + F.col("_rank")).cast("bigint").alias(sk),
            *(F.col(c) for c in members.columns if c != sk),
        )
    )


def highest_key(dim: DataFrame, sk: str) -> Column:
    """The highest key in use, as a scalar subquery (NULL for an empty dimension)."""
    return dim.agg(F.max(sk)).scalar()
