"""Constraint checks as frames of violations; every check folds rows before it shuffles them."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from starmart.tables import StagingSpec


def violations_per_column(df: DataFrame, broken: Mapping[str, Column]) -> DataFrame:
    """Number of rows per column for which its condition holds, from one pass over the rows."""
    counts = df.agg(*(F.count_if(cond).alias(c) for c, cond in broken.items()))
    pairs = F.array(
        *(F.struct(F.lit(c).alias("column_name"), F.col(f"`{c}`").alias("violations")) for c in broken)
    )
    return counts.select(F.inline(pairs))


def not_null(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    return violations_per_column(df, {c: F.col(c).isNull() for c in columns})


def unique(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keys that occur more than once, with their number of rows."""
    return df.groupBy(*keys).agg(F.count("*").alias("n")).filter("n > 1")


def duplicates(df: DataFrame, keys: Sequence[str], name: str) -> DataFrame:
    """Number of keys that occur more than once."""
    return unique(df, keys).agg(F.lit(name).alias("check_name"), F.count("*").alias("violations"))


def staging_checks(staged: DataFrame, spec: StagingSpec) -> DataFrame:
    """NULLs in mandatory columns and over-long texts of a staging table, from one pass."""
    broken = {f"{spec.name}.{c} missing": F.col(c).isNull() for c in spec.required}
    broken |= {f"{spec.name}.{c} too long": F.length(c) > n for c, n in spec.lengths.items()}
    return violations_per_column(staged, broken).withColumnRenamed("column_name", "check_name")


def foreign_key(child: DataFrame, key: str, parent: DataFrame, parent_key: str, name: str) -> DataFrame:
    """Number of child rows whose non-NULL key has no parent.

    The child is counted per key first, so a hot key reaches the join as one row.
    """
    per_key = child.filter(F.col(key).isNotNull()).groupBy(key).agg(F.count("*").alias("_n"))
    known = parent.select(F.col(parent_key).alias("_parent"))
    orphans = per_key.join(known, F.col(key) == F.col("_parent"), "left_anti")
    return orphans.agg(
        F.lit(name).alias("check_name"),
        F.coalesce(F.sum("_n"), F.lit(0)).cast("bigint").alias("violations"),
    )


def references(
    child: DataFrame, parents: Mapping[str, tuple[str, DataFrame, str]]
) -> DataFrame:
    """Number of orphaned keys per check (name: key, parent, parent's key), from one scan of the child.

    Rows are folded per check and key before they meet the parents.
    """
    pairs = F.array(*(
        F.struct(F.lit(name).alias("check_name"), F.col(key).cast("bigint").alias("key"))
        for name, (key, _, _) in parents.items()
    ))
    counted = child.select(F.inline(pairs)).groupBy("check_name", "key").agg(F.count("*").alias("_n"))
    known = reduce(DataFrame.unionByName, (
        parent.select(F.lit(name).alias("check_name"), F.col(key).cast("bigint").alias("key"))
        for name, (_, parent, key) in parents.items()
    ))
    orphans = counted.filter("key is not null").join(known, ["check_name", "key"], "left_anti")
    return orphans.groupBy("check_name").agg(F.sum("_n").cast("bigint").alias("violations"))


def too_long(df: DataFrame, column: str, limit: int, keep: Sequence[str]) -> DataFrame:
    """Rows whose text exceeds ``limit`` characters."""
    length = F.length(column).cast("int")
    return df.filter(length > limit).select(*keep, length.alias("len"))


def length_violations(df: DataFrame, limits: Mapping[str, int]) -> DataFrame:
    return violations_per_column(df, {c: F.length(c) > n for c, n in limits.items()})


def fits_decimal(value: Column, precision: int, scale: int) -> Column:
    """True if the value, rounded to ``scale``, fits the decimal type; NULL for NULL."""
    return F.when(value.isNull(), None).otherwise(
        value.try_cast(f"decimal({precision},{scale})").isNotNull()
    )


def gate_counts(fact_trip: DataFrame, dim_route: DataFrame, mart: DataFrame) -> DataFrame:
    """One row of counts; the gate passes if neither facts nor mart are empty."""
    facts = fact_trip.agg(
        F.count("*").alias("fact_rows"), F.count_if(F.col("route_sk").isNull()).alias("null_route_keys")
    )
    current = dim_route.filter("is_current").agg(F.count("*")).scalar()
    stored = mart.agg(F.count("*")).scalar()
    return facts.select(
        "fact_rows", current.alias("current_routes"), "null_route_keys", stored.alias("mart_rows")
    ).withColumn(
        "passed",
        (F.col("fact_rows") > 0) & (F.col("mart_rows") > 0),
    )
