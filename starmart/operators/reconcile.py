"""Compare two hourly result sets."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, functions as F

from starmart.functions.numeric import coerce, mean

KEYS = ("route_code", "start_hour")
# Names of the difference columns and the measures they compare.
DIFFERENCES = {
    "trips_diff": "trips_total",
    "fare_diff": "avg_fare_amount",
    "duration_diff": "avg_trip_duration_sec",
}
MEASURE_TYPES = {
    "start_hour": "timestamp_ntz",
    "trips_total": "bigint", "trips_completed": "bigint", "trips_canceled": "bigint",
    "avg_trip_duration_sec": "double", "avg_distance_m": "double", "avg_fare_amount": "double",
}


def align(df: DataFrame, types: Mapping[str, str] = MEASURE_TYPES) -> DataFrame:
    """Same types on both sides; values that do not convert become NULL."""
    return coerce(df, dict(types))


def compare(
    left: DataFrame, right: DataFrame, keys: Sequence[str] = KEYS, how: str = "inner",
    suffixes: tuple[str, str] = ("_left", "_right"),
) -> DataFrame:
    """Join both sides on the keys, suffix the other columns and add the difference columns.

    With ``how='full_outer'`` a ``status`` tells matched rows from those of one side only. Compare
    whole results: a limit before the join would turn cut-off rows into missing ones.
    """
    a = _side(align(left), keys, suffixes[0])
    b = _side(align(right), keys, suffixes[1])
    joined = a.join(b, list(keys), how)
    differences = [
        (F.col(m + suffixes[0]) - F.col(m + suffixes[1])).alias(name)
        for name, m in DIFFERENCES.items()
        if m in left.columns and m in right.columns
    ]
    seen_left, seen_right = F.col("_in" + suffixes[0]), F.col("_in" + suffixes[1])
    status = (
        F.when(seen_right.isNull(), "left_only").when(seen_left.isNull(), "right_only")
        .otherwise("matched").alias("status")
    )
    return joined.select("*", *differences, *([status] if how != "inner" else [])).drop(
        "_in" + suffixes[0], "_in" + suffixes[1]
    )


def _side(df: DataFrame, keys: Sequence[str], suffix: str) -> DataFrame:
    others = [F.col(c).alias(c + suffix) for c in df.columns if c not in keys]
    return df.select(*keys, *others, F.lit(True).alias("_in" + suffix))


def hourly_series(compared: DataFrame, hours: int = 48) -> DataFrame:
    """Trips of both sides for the last ``hours`` hours, oldest first."""
    return (
        compared.groupBy("start_hour")
        .agg(
            F.sum("trips_total_left").alias("trips_left"),
            F.sum("trips_total_right").alias("trips_right"),
        )
        .orderBy(F.col("start_hour").desc())
        .limit(hours)
        .orderBy("start_hour")
    )


def route_series(compared: DataFrame, digits: int = 4) -> DataFrame:
    """Per route: trips of both sides, their difference, and unweighted means of hourly means."""

    def hourly_mean(column: str, name: str):
        return mean(f"cast({column} as decimal(24,8))", digits).alias(name)

    return (
        compared.groupBy("route_code")
        .agg(
            F.sum("trips_total_left").alias("trips_left"),
            F.sum("trips_total_right").alias("trips_right"),
            hourly_mean("avg_fare_amount_left", "fare_left"),
            hourly_mean("avg_fare_amount_right", "fare_right"),
            hourly_mean("avg_trip_duration_sec_left", "duration_left"),
            hourly_mean("avg_trip_duration_sec_right", "duration_right"),
        )
        .withColumn("trips_diff", F.col("trips_left") - F.col("trips_right"))
    )


# By digests -------------------------------------------------------------------------------------------

#: Buckets per level. Two levels tell up to ``BUCKETS ** 2`` parts of the keys apart.
BUCKETS = 1024


def _numbered(df: DataFrame, keys: Sequence[str], buckets: int) -> DataFrame:
    """Rows with their bucket on both levels, from the hash of the keys."""
    h = F.xxhash64(*keys)
    return df.withColumns({
        "_coarse": F.pmod(h, F.lit(buckets)).cast("int"),
        "_fine": F.pmod(F.shiftrightunsigned(h, 32), F.lit(buckets)).cast("int")})


def digests(df: DataFrame, by: Sequence[str], columns: Sequence[str]) -> DataFrame:
    """Number and checksum of the rows per bucket. The checksum does not depend on the order of the rows, and counts
    repeated ones: the sum of their hashes. Rows are folded before the shuffle."""
    whole = F.sum(F.xxhash64(*columns).cast("decimal(20,0)")).alias("digest")
    return df.groupBy(*by).agg(F.count(F.lit(1)).alias("n"), whole)


def unequal_buckets(left: DataFrame, right: DataFrame, by: Sequence[str], columns: Sequence[str]) -> DataFrame:
    """Buckets whose digests differ, also those that one side lacks."""
    a, b = (digests(x, by, columns).withColumnsRenamed({"n": f"n_{s}", "digest": f"digest_{s}"}) for x, s in ((left, "a"), (right, "b")))
    same = F.col("n_a").eqNullSafe(F.col("n_b")) & F.col("digest_a").eqNullSafe(F.col("digest_b"))
    return a.join(b, list(by), "full_outer").where(~same).select(*by)


def drift(
    left: DataFrame, right: DataFrame, keys: Sequence[str] = KEYS, measures: Sequence[str] = tuple(DIFFERENCES.values()),
    buckets: int = BUCKETS,
) -> DataFrame:
    """Keys on which two large results differ, with ``status``, the number of rows and the measures of both sides.

    Checksums are compared bucket by bucket, and within unequal buckets once more; only rows of buckets that are unequal
    on both levels are joined, so equal inputs cost two scans and no join, and a few drifted rows little more. A key that
    a side has more than once is one row with status ``duplicate``, without measures of that side. Other statuses are
    ``left_only``, ``right_only`` and ``different``; equal keys are left out. Measures are compared NULL-safe.

    At most ``buckets`` (then ``buckets ** 2`` of unequal ones) digests per side meet, whatever the number of rows.
    """
    columns = [*keys, *measures]
    a, b = (_numbered(x.select(*columns), keys, buckets) for x in (left, right))
    coarse = F.broadcast(unequal_buckets(a, b, ["_coarse"], columns))
    a, b = (x.join(coarse, "_coarse", "left_semi") for x in (a, b))
    fine = unequal_buckets(a, b, ["_coarse", "_fine"], columns)
    a, b = (_once(x.join(fine, ["_coarse", "_fine"], "left_semi"), keys, measures, s) for x, s in ((a, "_left"), (b, "_right")))
    # NULL keys meet too, which a join by name would not let them.
    joined = a.withColumnsRenamed({k: f"{k}_a" for k in keys}).join(
        b.withColumnsRenamed({k: f"{k}_b" for k in keys}), [F.col(f"{k}_a").eqNullSafe(F.col(f"{k}_b")) for k in keys], "full_outer")
    n_left, n_right = (F.coalesce(c, F.lit(0)).alias(c) for c in ("n_left", "n_right"))
    equal = F.lit(True)
    for m in measures:
        equal = equal & F.col(f"{m}_left").eqNullSafe(F.col(f"{m}_right"))
    status = (
        F.when((F.coalesce("n_left", F.lit(0)) > 1) | (F.coalesce("n_right", F.lit(0)) > 1), "duplicate")
        .when(F.col("n_right").isNull(), "left_only").when(F.col("n_left").isNull(), "right_only").when(~equal, "different"))
    return joined.withColumn("status", status).where(F.col("status").isNotNull()).select(
        *(F.coalesce(f"{k}_a", f"{k}_b").alias(k) for k in keys), "status", n_left, n_right,
        *(f"{m}{s}" for m in measures for s in ("_left", "_right")))


def _once(df: DataFrame, keys: Sequence[str], measures: Sequence[str], suffix: str) -> DataFrame:
    """One row per key with its number of rows, and its measures if that is one."""
    folded = df.groupBy(*keys).agg(F.count(F.lit(1)).alias(f"n{suffix}"), *(F.first(m).alias(m + suffix) for m in measures))
    single = F.col(f"n{suffix}") == 1
    return folded.withColumns({m + suffix: F.when(single, F.col(m + suffix)) for m in measures})
