"""Bring a raw frame to a declared staging schema in one projection."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from starmart.functions.time import ntz
from starmart.tables import StagingSpec


def conform(raw: DataFrame, spec: StagingSpec, batch_id: str, as_of) -> DataFrame:
    """Cast, null-fill, order and audit the columns of ``spec``; other raw columns are dropped.

    ``src_system`` gets its default only if the raw frame lacks the column. A value that does not fit
    its declared type becomes NULL; ``cast_failures`` finds the rows. Because it is one ``select``,
    column pruning reaches the scan.
    """
    return raw.select(*_columns(raw, spec, batch_id, as_of))


def _columns(raw: DataFrame, spec: StagingSpec, batch_id: str, as_of) -> list[Column]:
    fixed = {"etl_batch_id": F.lit(batch_id), "etl_loaded_at": ntz(as_of)}
    absent = {"src_system": F.lit(spec.src_system)}

    def column(name: str, kind: str) -> Column:
        if name in fixed:
            return fixed[name]
        if name in raw.columns:
            return _as(raw, name, kind)
        return absent.get(name, F.lit(None)).cast(kind)

    return [column(n, k).alias(n) for n, k in spec.schema.items()]


def checked(raw: DataFrame, spec: StagingSpec, batch_id: str, as_of) -> DataFrame:
    """The rows of ``conform`` with ``reject_reason`` and, for rejected ones, the raw row as JSON.

    A row is rejected if a value does not fit its type or a mandatory value is missing.
    """
    rows = raw.select(
        F.struct(*_columns(raw, spec, batch_id, as_of)).alias("row"),
        F.struct(*raw.columns).alias("raw"), _unfit(raw, spec).alias("unfit"),
    )
    absent = (F.when(F.col(f"row.{n}").isNull(), F.lit(n)) for n in spec.required)
    reasons = F.concat(
        F.transform("unfit", lambda c: F.concat(c, F.lit(" does not fit"))),
        F.transform(F.array_compact(F.array(*absent)), lambda c: F.concat(c, F.lit(" missing"))),
    )
    bad = F.size(reasons) > 0
    return rows.select(
        "row.*", F.when(bad, F.array_join(reasons, ", ")).alias("reject_reason"),
        F.when(bad, F.to_json("raw")).alias("raw_row"),
    )


def _as(raw: DataFrame, name: str, kind: str) -> Column:
    source = raw.schema[name].dataType.simpleString()
    if source == kind:
        return F.col(name)
    # Text takes any value, so a plain cast keeps the key expression simple. A decimal target rounds
    # half away from zero.
    return F.col(name).cast(kind) if kind == "string" else F.col(name).try_cast(kind)


def _unfit(raw: DataFrame, spec: StagingSpec) -> Column:
    names = [n for n in spec.schema if n in raw.columns and n not in ("etl_batch_id", "etl_loaded_at")]
    return F.array_compact(
        F.array(
            *(
                F.when(F.col(n).isNotNull() & _as(raw, n, spec.schema[n]).isNull(), F.lit(n))
                for n in names
            )
        )
    )


def cast_failures(raw: DataFrame, spec: StagingSpec) -> DataFrame:
    """Rows with a value that ``conform`` had to null, with the names of the columns."""
    return raw.withColumn("failed_columns", _unfit(raw, spec)).filter(F.size("failed_columns") > 0)


def batch_rows(staged: DataFrame, batch_id: str | None) -> DataFrame:
    """One batch, or the whole history without a batch id. Prunes partitions of a batched table."""
    return staged if batch_id is None else staged.filter(F.col("etl_batch_id") == F.lit(batch_id))


def apply_defaults(df: DataFrame, defaults: dict[str, object]) -> DataFrame:
    """Fill NULLs of the named columns, as column defaults do on insert."""
    return df.withColumns({c: F.coalesce(F.col(c), F.lit(v)) for c, v in defaults.items()})


def all_of(conditions: list[Column]) -> Column:
    return reduce(lambda a, b: a & b, conditions, F.lit(True))

