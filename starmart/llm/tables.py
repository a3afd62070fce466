"""Intermediate tables in the shared folder, and connected components over a table of links."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from starmart.session import scratch_path


class Stored:
    """Written intermediate tables of one operator; ``drop`` removes those that no result reads any more."""

    def __init__(self, spark: SparkSession, label: str):
        self.spark, self.label = spark, label

    def keep(self, df: DataFrame, name: str) -> DataFrame:
        """The rows, written once in the shared folder and read back, so that their lineage ends there."""
        path = scratch_path(self.spark, f"{self.label}-{name}")
        df.write.option("compression", "zstd").parquet(path)
        out = self.spark.read.schema(df.schema).parquet(path)
        out.stored_path = path
        return out

    def drop(self, *tables: DataFrame) -> None:
        for table in tables:
            path = self.spark._jvm.org.apache.hadoop.fs.Path(table.stored_path)
            path.getFileSystem(self.spark._jsc.hadoopConfiguration()).delete(path, True)


def components(stored: Stored, links: DataFrame) -> DataFrame:
    """(node, component) for every node of ``links(a, b)``; a component is named by its smallest node.

    Each round takes the smallest label among the neighbours and then the label of that label, so the distance to the
    smallest node shrinks by more than half; labels are written between rounds.
    """
    both = stored.keep(links.select("a", "b").unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b"))), "links")
    start = both.groupBy("a").agg(F.min("b").alias("m")).select(
        F.col("a").alias("node"), F.least("a", "m").alias("component"))
    labels = stored.keep(start, "labels")
    while True:
        near = both.join(labels.withColumnRenamed("node", "b"), "b").groupBy("a").agg(F.min("component").alias("m"))
        lower = labels.join(near.withColumnRenamed("a", "node"), "node").select(
            "node", F.col("component").alias("was"), F.least("component", "m").alias("component"))
        jump = labels.select(F.col("node").alias("component"), F.col("component").alias("next"))
        moved = stored.keep(
            lower.join(jump, "component").select("node", "was", F.least("component", "next").alias("component")), "labels")
        changed = moved.where("component < was").limit(1).count()
        stored.drop(labels)
        labels = moved.select("node", "component")
        labels.stored_path = moved.stored_path
        if not changed:
            stored.drop(both)
            return labels
