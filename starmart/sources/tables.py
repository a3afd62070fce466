"""Table readers and writers over Parquet folders, and an optional JDBC reader."""

from __future__ import annotations

import re
from collections.abc import Mapping

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, Observation, SparkSession, functions as F

from starmart.tables import ddl

#: States of stored rows; a superseded fact is one that a later batch delivers again.
ACCEPTED, REJECTED, SUPERSEDED = "accepted", "rejected", "superseded"


def read_raw(spark: SparkSession, base: str, entity: str) -> DataFrame:
    """One raw entity; the schema comes from the file footers."""
    return spark.read.parquet(f"{base.rstrip('/')}/{entity}")


def read_table(
    spark: SparkSession, path: str, columns: Mapping[str, str], or_empty: bool = False
) -> DataFrame:
    """A stored table with its declared columns. A missing one raises, so that a wrong path does not
    read as no rows; with ``or_empty``, for a first load, it is an empty frame."""
    schema = ddl(dict(columns))
    try:
        return spark.read.schema(schema).parquet(path)
    except AnalysisException as missing:
        if not or_empty or missing.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], schema)


def jdbc_options(
    url: str, table: str, user: str, password: str, driver: str, fetch_size: int = 10_000,
    split: tuple[str, object, object, int] | None = None,
) -> dict[str, str]:
    """Options of a JDBC scan; ``split`` is (column, lower, upper, number of parallel reads)."""
    options = {
        "url": url, "dbtable": table, "user": user, "password": password, "driver": driver,
        "fetchsize": str(fetch_size),
    }
    if split:
        column, lower, upper, reads = split
        options |= {
            "partitionColumn": column, "lowerBound": str(lower), "upperBound": str(upper),
            "numPartitions": str(reads),
        }
    return options


def read_jdbc(spark: SparkSession, **kwargs) -> DataFrame:
    """A table of a database. Without ``split`` one task reads it all."""
    return spark.read.format("jdbc").options(**jdbc_options(**kwargs)).load()


def batch_folder(path: str, batch_id: str) -> str:
    if not re.fullmatch(r"[A-Za-z0-9_.-]+", batch_id):
        raise ValueError(f"batch id {batch_id!r} is not usable as a folder name")
    return f"{path.rstrip('/')}/etl_batch_id={batch_id}"


def counted(df: DataFrame, **extra) -> tuple[DataFrame, Observation]:
    """Attach row counters that are filled by the write itself, without a second pass."""
    seen = Observation()
    measures = {"rows": F.count(F.lit(1)), **extra}
    return df.observe(seen, *(c.alias(n) for n, c in measures.items())), seen


def write_batch(df: DataFrame, path: str, batch_id: str) -> int:
    """Store one batch in its own folder, replacing what an earlier run of the batch left there."""
    rows, seen = counted(df.drop("etl_batch_id"))
    rows.write.mode("overwrite").parquet(batch_folder(path, batch_id))
    return seen.get["rows"]


def append_rows(df: DataFrame, path: str) -> int:
    """Add rows to a table; for frames that are anti-joined with the table, so a replay adds none."""
    rows, seen = counted(df)
    rows.write.mode("append").parquet(path)
    return seen.get["rows"]


def write_staged(checked: DataFrame, path: str, batch_id: str) -> dict[str, int]:
    """Store accepted and rejected staging rows of a batch in one pass, without a shuffle."""
    state = F.when(F.col("reject_reason").isNull(), ACCEPTED).otherwise(REJECTED)
    rows, seen = counted(
        checked.withColumn("row_state", state).drop("etl_batch_id"), rejected=F.count("reject_reason")
    )
    rows.write.mode("overwrite").partitionBy("row_state").parquet(batch_folder(path, batch_id))
    counts = seen.get
    return {ACCEPTED: counts["rows"] - counts["rejected"], REJECTED: counts["rejected"]}


def read_staged(spark: SparkSession, path: str, columns: Mapping[str, str], state: str = ACCEPTED) -> DataFrame:
    stored = {**columns, "reject_reason": "string", "raw_row": "string", "row_state": "string"}
    rows = read_table(spark, path, stored).filter(F.col("row_state") == state)
    return rows.select(*columns) if state == ACCEPTED else rows.drop("row_state")


def _folder(spark: SparkSession, path: str):
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark._jsc.hadoopConfiguration()), target


def stored_batches(spark: SparkSession, path: str) -> list[str]:
    """Ids of the batches that have a folder in a table."""
    files, target = _folder(spark, path)
    if not files.exists(target):
        return []
    names = [status.getPath().getName() for status in files.listStatus(target)]
    return sorted(n.split("=", 1)[1] for n in names if n.startswith("etl_batch_id="))


def remove(spark: SparkSession, path: str) -> None:
    """Delete a folder of a table, if it is there."""
    files, target = _folder(spark, path)
    files.delete(target, True)


def write_facts(classified: DataFrame, path: str, batch_id: str, date_key: str) -> dict[str, int]:
    """Store accepted and rejected rows of a batch in one pass, partitioned by state and date.

    Rebalancing splits the partition of a hot date and merges small ones, so neither one huge task
    nor a file per task and date results.
    """
    state = F.when(F.col("reject_reason").isNull(), ACCEPTED).otherwise(REJECTED)
    rows, seen = counted(
        classified.withColumn("row_state", state), rejected=F.count("reject_reason")
    )
    (
        rows.hint("rebalance", F.col("row_state"), F.col(date_key))
        .write.mode("overwrite")
        .partitionBy("row_state", date_key)
        .parquet(batch_folder(path, batch_id))
    )
    counts = seen.get
    return {ACCEPTED: counts["rows"] - counts["rejected"], REJECTED: counts["rejected"]}


def rewrite_facts(classified: DataFrame, cells: DataFrame, path: str, date_key: str) -> int:
    """Replace the partitions of facts that ``cells`` (etl_batch_id, cell) names by the ``classified`` rows of those cells.

    Both are stored tables; rows may bring their ``row_state``. A state of a cell that has no rows any more is removed.
    Returns the number of cells.
    """
    spark, rows = classified.sparkSession, classified
    if "row_state" not in rows.columns:
        rows = rows.withColumn("row_state", F.when(F.col("reject_reason").isNull(), ACCEPTED).otherwise(REJECTED))
    named = cells.select("etl_batch_id", "cell").collect()  # one row per batch and day
    filled = {tuple(r) for r in rows.select("etl_batch_id", date_key, "row_state").distinct().collect()}
    if filled:
        (
            rows.hint("rebalance", F.col("etl_batch_id"), F.col("row_state"), F.col(date_key))
            .write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
            .partitionBy("etl_batch_id", "row_state", date_key).parquet(path)
        )
    for batch, day in named:
        for kind in (ACCEPTED, REJECTED, SUPERSEDED):
            if (batch, day, kind) not in filled:
                remove(spark, f"{batch_folder(path, batch)}/row_state={kind}/{date_key}={day}")
    return len(named)


def read_facts(
    spark: SparkSession, path: str, columns: Mapping[str, str], state: str | None = ACCEPTED, or_empty: bool = False
) -> DataFrame:
    """Facts of one state, or of all with their ``row_state``."""
    stored = {**columns, "reject_reason": "string", "etl_batch_id": "string", "row_state": "string"}
    if state is None:
        return read_table(spark, path, stored, or_empty)
    rows = read_table(spark, path, stored, or_empty).filter(F.col("row_state") == state).drop("row_state")
    return rows.drop("reject_reason") if state == ACCEPTED else rows


def write_mart(mart: DataFrame, path: str, reload_all: bool = False) -> int:
    """Store the mart by date, sorted for skipping; only the dates present in ``mart`` are replaced
    unless ``reload_all`` is set."""
    rows, seen = counted(mart.withColumn("start_date", F.col("start_hour").cast("date")))
    (
        rows.hint("rebalance", F.col("start_date"))
        .sortWithinPartitions("start_date", "route_id_nat", "start_hour")
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "static" if reload_all else "dynamic")
        .partitionBy("start_date")
        .parquet(path)
    )
    return seen.get["rows"]


def write_csv(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").option("header", True).csv(path)


def write_metrics(spark: SparkSession, metrics: Mapping[str, float | int], path: str) -> None:
    """One JSON line of run metrics."""
    spark.createDataFrame([tuple(metrics.values())], list(metrics)).write.mode("overwrite").json(path)
