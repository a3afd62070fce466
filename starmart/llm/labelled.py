"""A bounded sample of labelled documents, and its features on the driver."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window, functions as F

from starmart.llm.text import is_held_out

#: At most so many labelled rows fit a classifier; they are those with the smallest hash of their id.
SAMPLE_ROWS = 12_000


def sample_labels(labels: DataFrame, label: str, rows: int = SAMPLE_ROWS) -> DataFrame:
    """(id, label) of at most ``rows`` labelled documents outside the held-out fold, chosen by hash of the id."""
    usable = labels.where(F.col(label).isNotNull() & F.col("doc_id").isNotNull() & ~is_held_out())
    return (
        usable.select(F.col("doc_id").alias("sample_id"), F.col(label).alias("sample_label"))
        .orderBy(F.xxhash64("sample_id"), "sample_id", "sample_label").limit(rows)
    )


def sample_of_each(labels: DataFrame, label: str, rows: int, least: int) -> tuple[DataFrame, int]:
    """((id, label), number of rows at most) of labelled documents, chosen by hash of the id within each label.

    The labels are counted over all documents. Each has its share of ``rows``, but ``least`` rows, or all it has, in any
    case; so there are at most ``rows`` and ``least + 1`` more for each label.
    """
    usable = labels.where(F.col(label).isNotNull() & F.col("doc_id").isNotNull() & ~is_held_out()).select(
        F.col("doc_id").alias("sample_id"), F.col(label).alias("sample_label"))
    counted = {r["sample_label"]: r["n"] for r in usable.groupBy("sample_label").agg(F.count(F.lit(1)).alias("n")).collect()}
    total = sum(counted.values())
    parts = [(c, max(min(n, least), -(-rows * n // total) if total > rows else n), n) for c, n in counted.items()]
    # Twice the rows wanted pass by their hash, so that few rows of a label meet to be ranked.
    cut = [(c, wanted, min(2 * wanted / n, 1.0)) for c, wanted, n in parts]
    bounds = labels.sparkSession.createDataFrame(cut, f"of_label {dict(usable.dtypes)['sample_label']}, wanted long, share double")
    near = usable.join(F.broadcast(bounds), F.col("sample_label") == F.col("of_label")).where(
        F.pmod(F.xxhash64("sample_id"), F.lit(1 << 30)) < F.col("share") * (1 << 30))
    order = Window.partitionBy("sample_label").orderBy(F.xxhash64("sample_id", F.lit(1)), "sample_id")
    chosen = near.withColumn("rank_in_label", F.row_number().over(order)).where("rank_in_label <= wanted")
    return chosen.select("sample_id", "sample_label"), sum(wanted for _, wanted, _ in parts)


def sample_features(
    docs: DataFrame, chosen: DataFrame, features: Callable[[str | None], tuple[bytes, ...]], names: tuple[str, ...],
    rows: int = SAMPLE_ROWS,
) -> pd.DataFrame:
    """Label and feature arrays (as bytes) of the chosen documents, on the driver, in an order that does not vary.

    ``chosen`` has at most ``rows`` narrow rows, so it may be broadcast. Documents that repeat an id could exceed the
    bound, so what comes to the driver is limited to twice the bound as well.
    """
    joined = docs.select("doc_id", "text").join(F.broadcast(chosen), F.col("doc_id") == F.col("sample_id"))

    def made(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for part in parts:
            arrays = [features(t) for t in part["text"]]
            out = part[["doc_id", "sample_label"]].reset_index(drop=True)
            for k, name in enumerate(names):
                out[name] = pd.Series([a[k] for a in arrays], dtype=object)
            yield out

    kind = dict(chosen.dtypes)["sample_label"]
    schema = f"doc_id long, sample_label {kind}, " + ", ".join(f"{n} binary" for n in names)
    found = joined.mapInPandas(made, schema).limit(2 * rows).toPandas()
    return found.sort_values(["doc_id", "sample_label", names[0]]).reset_index(drop=True)


def indices(blob: bytes) -> np.ndarray:
    return np.frombuffer(blob, np.int32)
