"""Rounding, averages and tolerant casts; arguments are SQL expressions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from starmart.functions import sqltext


def rounded(value: str, digits: int) -> Column:
    return F.expr(sqltext.rounded(value, digits))


def mean(column: str, digits: int) -> Column:
    """Rounded average of an aggregation."""
    return F.expr(sqltext.rounded(sqltext.mean(column), digits))


def coerce(df: DataFrame, types: dict[str, str]) -> DataFrame:
    """Cast the named columns that exist; a value that does not fit becomes NULL."""
    return df.withColumns({c: F.col(c).try_cast(t) for c, t in types.items() if c in df.columns})
