"""Small frames from text, and sorted rows to compare."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F


def frame(spark: SparkSession, schema: str, *rows) -> DataFrame:
    """Literal rows; date and time columns are given as text and cast to the declared type."""
    kinds = dict(column.strip().split(" ", 1) for column in schema.split(", "))
    as_text = {
        c: k for c, k in kinds.items() if k in ("date", "timestamp", "timestamp_ntz") or k.startswith("decimal")
    }
    raw = ", ".join(f"{c} {'string' if c in as_text else k}" for c, k in kinds.items())
    df = spark.createDataFrame(list(rows), raw)
    return df.withColumns({c: F.col(c).cast(k) for c, k in as_text.items()}) if as_text else df


def rows(df: DataFrame, *columns: str) -> list[tuple]:
    chosen = df.select(*columns) if columns else df
    return sorted((tuple(r) for r in chosen.collect()), key=repr)


def texts(df: DataFrame, *columns: str) -> list[tuple]:
    """Rows with every value as text."""
    chosen = df.select(*(F.col(c).cast("string") for c in (columns or df.columns)))
    return rows(chosen)
