"""Insert-only dimensions: known members are never changed, new ones get the next keys."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from starmart.functions.time import ntz
from starmart.operators.dedup import latest_by_key
from starmart.operators.keys import assign_surrogate_keys, highest_key
from starmart.tables import LATEST_ORDER, DimSpec


def new_members(dim: DataFrame, staged: DataFrame, spec: DimSpec) -> DataFrame:
    """Latest staged record of every natural key that the dimension does not hold yet.

    The anti join runs first: it shrinks the rows that have to be ranked.
    """
    known = dim.select(F.col(spec.nat).alias("_known"))
    fresh = staged.join(known, F.col(spec.source.key) == F.col("_known"), "left_anti")
    latest = latest_by_key(fresh, [spec.source.key], LATEST_ORDER)
    return latest.select(
        F.col(spec.source.key).alias(spec.nat),
        *(F.expr(sql).alias(name) for name, sql in spec.attributes.items()),
    )


def keyed_members(dim: DataFrame, members: DataFrame, spec: DimSpec, as_of) -> DataFrame:
    """Dimension rows of new members, with keys above the highest key in use."""
    audited = members.withColumns({"src_system": F.lit(spec.source.src_system), "etl_loaded_at": ntz(as_of)})
    keyed = assign_surrogate_keys(audited, spec.nat, spec.sk, highest_key(dim, spec.sk))
    return keyed.select(*spec.schema)


def merge_insert_only(dim: DataFrame, staged: DataFrame, spec: DimSpec, as_of) -> DataFrame:
    """The whole dimension after the load."""
    added = keyed_members(dim, new_members(dim, staged, spec), spec, as_of)
    return dim.select(*spec.schema).unionByName(added)
