"""Keep one row per key."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window, functions as F


def latest_by_key(df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """The row of each key that is last by ``order`` (descending, NULLs last).

    Remaining ties are broken by a hash of the whole row, so the choice does not depend on how the
    rows are partitioned. Catalyst turns the rank filter into a group limit before the shuffle: each
    map task sends at most one row per key, so a hot key stays small.
    """
    ordering = [F.col(c).desc_nulls_last() for c in order]
    rest = [c for c in df.columns if c not in keys and c not in order]
    if rest:
        ordering.append(F.xxhash64(*rest).desc())
    window = Window.partitionBy(*keys).orderBy(*ordering)
    return df.withColumn("_rank", F.row_number().over(window)).filter("_rank = 1").drop("_rank")
