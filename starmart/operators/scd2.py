"""Versioned (type 2) dimension: find changes, build new versions, close old ones."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import DataFrame, functions as F

from starmart.functions.time import ntz
from starmart.operators.dedup import latest_by_key
from starmart.operators.keys import assign_surrogate_keys, highest_key
from starmart.tables import DIM_ROUTE_SCHEMA, LATEST_ORDER_VERSIONED, OPEN_END, ROUTE_TRACKED


@dataclass(frozen=True)
class VersionSpec:
    key: str
    nat: str
    sk: str
    tracked: tuple[str, ...]
    schema: tuple[str, ...]
    order: tuple[str, ...] = LATEST_ORDER_VERSIONED


ROUTE_VERSIONS = VersionSpec(
    "route_id", "route_id_nat", "route_sk", ROUTE_TRACKED, tuple(DIM_ROUTE_SCHEMA)
)


def resolve_default_fare(staged: DataFrame, dim_fare: DataFrame) -> DataFrame:
    """Natural fare product to surrogate key; an unknown product gives NULL."""
    fares = dim_fare.select(
        F.col("fare_product_id_nat").alias("_fare"),
        F.col("fare_product_sk").alias("default_fare_product_sk"),
    )
    return staged.join(fares, F.col("default_fare_product_id") == F.col("_fare"), "left").drop("_fare")


def effective_dates(staged: DataFrame, as_of) -> DataFrame:
    """Start of validity: the given one, else the creation date, else the load date.

    ``valid_to_candidate`` is informative only: a new version is always open-ended.
    """
    return staged.withColumns({
        "valid_from": F.coalesce(
            F.col("valid_from_ts").cast("date"),
            F.col("src_created_at").cast("date"),
            ntz(as_of).cast("date"),
        ),
        "valid_to_candidate": F.coalesce(
            F.col("valid_to_ts").cast("date"), F.lit(OPEN_END).cast("date")
        ),
    })


def latest_versions(staged: DataFrame, as_of, spec: VersionSpec = ROUTE_VERSIONS) -> DataFrame:
    """Latest staged record per key, with its effective date."""
    return latest_by_key(effective_dates(staged, as_of), [spec.key], spec.order)


def change_set(
    dim: DataFrame, latest: DataFrame, spec: VersionSpec = ROUTE_VERSIONS, null_safe: bool = True
) -> DataFrame:
    """Staged records that are new or differ from the current version, with ``change_kind``.

    A later ``valid_from`` alone is a change. With ``null_safe=False`` an attribute that turns from or
    to NULL is not seen as a change, as with plain ``<>``.
    """
    current = dim.filter("is_current").select(
        F.col(spec.nat).alias("_nat"),
        F.col("valid_from").alias("_current_from"),
        *(F.col(c).alias(f"_cur_{c}") for c in spec.tracked),
    )

    def differs(name: str):
        new, old = F.col(name), F.col(f"_cur_{name}")
        return ~new.eqNullSafe(old) if null_safe else new != old

    later = F.col("valid_from") > F.col("_current_from")
    changed = reduce(lambda a, b: a | b, (differs(c) for c in spec.tracked), later)
    kind = F.when(F.col("_nat").isNull(), F.lit("new")).when(changed, F.lit("changed"))
    return (
        latest.join(current, F.col(spec.key) == F.col("_nat"), "left")
        .withColumn("change_kind", kind)
        .filter(F.col("change_kind").isNotNull())
        .select(*latest.columns, "change_kind", "_current_from")
    )


def new_versions(
    dim: DataFrame,
    latest: DataFrame,
    as_of,
    spec: VersionSpec = ROUTE_VERSIONS,
    null_safe: bool = True,
    late_policy: str = "reject",
) -> DataFrame:
    """Versions to insert, without surrogate keys.

    A version that starts on the day of a stored one is dropped. A changed record that starts before
    the current version is dropped with ``late_policy='reject'``; with ``'accept'`` it is inserted and
    becomes the current one.
    """
    if late_policy not in ("reject", "accept"):
        raise ValueError(f"late_policy must be 'reject' or 'accept', not {late_policy!r}")
    changes = change_set(dim, latest, spec, null_safe)
    if late_policy == "reject":
        changes = changes.filter(
            F.col("_current_from").isNull() | (F.col("valid_from") >= F.col("_current_from"))
        )
    stored = dim.select(F.col(spec.nat).alias("_nat"), F.col("valid_from").alias("_from"))
    fresh = changes.join(
        stored,
        (F.col(spec.key) == F.col("_nat")) & (F.col("valid_from") == F.col("_from")),
        "left_anti",
    )
    fixed = {
        spec.nat: F.col(spec.key),
        "valid_to": F.lit(OPEN_END).cast("date"),
        "is_current": F.lit(True),
        "etl_loaded_at": ntz(as_of),
    }
    columns = [c for c in spec.schema if c != spec.sk]
    return fresh.select(*(fixed.get(c, F.col(c)).alias(c) for c in columns))


def snapshot(dim: DataFrame, versions: DataFrame, spec: VersionSpec = ROUTE_VERSIONS) -> DataFrame:
    """The dimension after inserting ``versions``: history, current rows (closed where a version
    replaces them) and the versions with keys above the highest key in use.

    Only current rows, one per key, take part in the join; history passes through. ``versions`` is
    read twice, so a caller with a large change set writes it to the shared folder first.
    """
    starts = versions.select(F.col(spec.nat).alias("_nat"), F.col("valid_from").alias("_from"))
    replaced = F.col("_from").isNotNull() & (F.col("valid_to") >= F.col("_from"))
    closed = (
        dim.filter("is_current")
        .join(starts, F.col(spec.nat) == F.col("_nat"), "left")
        .withColumns({
            "is_current": ~replaced,
            "valid_to": F.when(replaced, F.date_sub("_from", 1)).otherwise(F.col("valid_to")),
        })
    )
    keyed = assign_surrogate_keys(versions, spec.nat, spec.sk, highest_key(dim, spec.sk))
    columns = list(spec.schema)
    return (
        dim.filter(~F.col("is_current")).select(*columns)
        .unionByName(closed.select(*columns))
        .unionByName(keyed.select(*columns))
    )


def current_only(dim: DataFrame) -> DataFrame:
    return dim.filter("is_current")


def asof_lookup(
    facts: DataFrame, dim: DataFrame, key: str, day: str, keep: Sequence[str],
    spec: VersionSpec = ROUTE_VERSIONS,
) -> DataFrame:
    """Surrogate key of the version valid on the fact's day; NULL if there is none.

    Both sides carry the month; versions are laid out over the months that occur in the facts, so one
    fact with an outlying day adds one month to a version and no more. The join is on key and month,
    which spreads a key with many versions or facts over its months, and a fact is held against the
    versions of one month (at most 31, as versions do not overlap) instead of all of its key.
    """
    months = facts.agg(F.sort_array(F.collect_set(F.trunc(day, "month")))).scalar()
    inside = "filter(_months, m -> m between trunc(_from, 'month') and _to)"
    versions = (
        dim.filter("valid_from <= valid_to")
        .select(
            F.col(spec.nat).alias("_nat"), spec.sk, F.col("valid_from").alias("_from"),
            F.col("valid_to").alias("_to"),
        )
        .withColumn("_months", months)
        .withColumn("_month", F.explode(F.expr(inside)))
        .drop("_months")
    )
    matches = (
        (F.col(key) == F.col("_nat"))
        & (F.trunc(day, "month") == F.col("_month"))
        & F.col(day).between(F.col("_from"), F.col("_to"))
    )
    return facts.join(versions, matches, "left").select(*keep, spec.sk)
