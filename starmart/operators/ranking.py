"""Positions 1..n inside groups of any size."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F

from starmart.session import scratch_path

#: Rows that one task sorts on average; the number of tasks grows with the rows, and their memory does not.
TASK_ROWS = 250_000


def ranked_within(
    df: DataFrame, group: str, order: str, out: str, partitions: int | None = None
) -> DataFrame:
    """Number the rows of each group by ``order``; (group, order) must be unique.

    A window over the group alone would sort a hot group in one task. Instead the rows are range
    partitioned by (group, order), so a hot group spreads over many even slices, and written once to
    the shared folder, which fixes the slice of every row. A row's position is its rank in its slice
    plus the rows of its group in lower slices. Starts the job that writes the slices, and one that reads
    their number of rows, from which the number of tasks follows: coalesced to a size in compressed bytes,
    a task would hold millions of short rows, and so would every sort behind the positions.
    """
    spark = df.sparkSession
    ranges = [c for c in (partitions, F.col(group), F.col(order)) if c is not None]
    path = scratch_path(spark, "ranked")
    (
        df.repartitionByRange(*ranges)
        .withColumn("_slice", F.spark_partition_id())
        .write.parquet(path)
    )
    sliced = spark.read.parquet(path)
    tasks = -(-sliced.count() // TASK_ROWS) or 1
    inside = Window.partitionBy("_slice", group).orderBy(order)
    # Only the first group of a slice can have begun in a lower one, so just those groups are counted,
    # and at most one row per slice is broadcast.
    firsts = sliced.groupBy("_slice").agg(F.min(F.struct(group)).getField(group).alias(group)).select(group).distinct()
    first = firsts.withColumnRenamed(group, "_first")
    shared = sliced.join(F.broadcast(first), F.col(group).eqNullSafe(F.col("_first")), "left_semi")
    sizes = shared.groupBy("_slice", group).agg(F.count("*").alias("_n"))
    below = Window.partitionBy(group).orderBy("_slice").rowsBetween(
        Window.unboundedPreceding, Window.currentRow
    )
    offsets = sizes.select(
        F.col("_slice").alias("_of"), F.col(group).alias("_in"), (F.sum("_n").over(below) - F.col("_n")).alias("_below"))
    lower = (F.col("_slice") == F.col("_of")) & F.col(group).eqNullSafe(F.col("_in"))
    return (
        sliced.repartition(tasks, "_slice", group).withColumn("_rank", F.row_number().over(inside))
        .join(F.broadcast(offsets.filter("_below > 0")), lower, "left")
        .withColumn(out, (F.coalesce("_below", F.lit(0)) + F.col("_rank")).cast("int"))
        .select(*df.columns, out)
    )
