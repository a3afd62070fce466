"""Versioned dimension as a timeline: starts may arrive in any order, and the intervals follow from them.

The versions of a key are its starts in order; each is valid until the day before the next one, and the last is the
current one. A start that arrives late splits the interval it falls into, so nothing is dropped and no interval is
inverted or overlaps another, and the intervals do not depend on the order of arrival. Stored versions keep their keys.
Only keys with new starts are sorted, one row per version; all other history passes through.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F

from starmart.functions.time import ntz
from starmart.operators.dedup import latest_by_key
from starmart.operators.keys import assign_surrogate_keys, highest_key
from starmart.operators.scd2 import ROUTE_VERSIONS, VersionSpec, effective_dates
from starmart.tables import OPEN_END


def staged_starts(staged: DataFrame, as_of, spec: VersionSpec = ROUTE_VERSIONS) -> DataFrame:
    """Latest staged record per key and start; a batch may bring several starts of a key."""
    return latest_by_key(effective_dates(staged, as_of), [spec.key, "valid_from"], spec.order)


def fresh_starts(dim: DataFrame, staged: DataFrame, as_of, spec: VersionSpec = ROUTE_VERSIONS) -> DataFrame:
    """Versions to insert, without surrogate keys: every start of the batch that is not stored.

    A stored version stays as it is, also if its start comes again with other values. A start with the values of its
    neighbour is kept too: a later arrival may fall between them.
    """
    stored = dim.select(F.col(spec.nat).alias("_nat"), F.col("valid_from").alias("_from"))
    known = (F.col(spec.key) == F.col("_nat")) & (F.col("valid_from") == F.col("_from"))
    fixed = {
        spec.nat: F.col(spec.key), "valid_to": F.lit(OPEN_END).cast("date"), "is_current": F.lit(True), "etl_loaded_at": ntz(as_of)}
    fresh = staged_starts(staged, as_of, spec).join(stored, known, "left_anti")
    return fresh.select(*(fixed.get(c, F.col(c)).alias(c) for c in spec.schema if c != spec.sk))


def merge(dim: DataFrame, fresh: DataFrame, spec: VersionSpec = ROUTE_VERSIONS) -> DataFrame:
    """The dimension with the ``fresh`` starts in place; they take keys above the highest in use.

    ``fresh`` is read several times, so a caller with a large one writes it first. It has no start that ``dim`` has.
    """
    touched = fresh.select(F.col(spec.nat).alias("_nat")).distinct()
    same_key = F.col(spec.nat) == F.col("_nat")
    # Keys follow the natural key and the start, so several starts of a key have an order too.
    start = F.concat_ws("|", spec.nat, F.col("valid_from").cast("string"))
    keyed = assign_surrogate_keys(fresh.withColumn("_start", start), "_start", spec.sk, highest_key(dim, spec.sk))
    columns = list(spec.schema)
    together = dim.join(touched, same_key, "left_semi").select(*columns).unionByName(keyed.select(*columns))
    following = F.lead("valid_from").over(Window.partitionBy(spec.nat).orderBy("valid_from"))
    ordered = together.withColumn("_next", following).withColumns({
        "valid_to": F.when(F.col("_next").isNotNull(), F.date_sub("_next", 1)).otherwise(F.lit(OPEN_END).cast("date")),
        "is_current": F.col("_next").isNull(),
    })
    return dim.join(touched, same_key, "left_anti").select(*columns).unionByName(ordered.select(*columns))


def changed_days(before: DataFrame, after: DataFrame, spec: VersionSpec = ROUTE_VERSIONS) -> DataFrame:
    """(key, first, last): days on which another version is in force than before, one row per new or shortened version.

    Facts on other days keep their version. A version whose start and end are as before contributes nothing.
    """
    columns = [spec.sk, spec.nat, "valid_from", "valid_to"]
    old = before.select(*columns).withColumnsRenamed({"valid_to": "_to", "valid_from": "_from"}).drop(spec.nat)
    joined = after.select(*columns).join(old, spec.sk, "left")
    # A new version covers new days; a stored one can only have lost days at its end, which a new version covers, or won
    # them there, if it was closed too early.
    longer = F.col("_to").isNotNull() & (F.col("valid_to") > F.col("_to"))
    return joined.where(F.col("_to").isNull() | longer).select(
        F.col(spec.nat).alias("key"), F.when(longer, F.date_add("_to", 1)).otherwise(F.col("valid_from")).alias("first"),
        F.col("valid_to").alias("last"))
