"""Session settings the operators rely on, and the shared scratch folder."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession

# A join side is broadcast only when Catalyst's or AQE's size of it is below this bound; beyond it
# the same join runs as a shuffle join, and AQE splits its hot partitions.
BROADCAST_BYTES = "64MB"

SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
    "spark.sql.autoBroadcastJoinThreshold": BROADCAST_BYTES,
    "spark.sql.adaptive.autoBroadcastJoinThreshold": BROADCAST_BYTES,
    # Recording the Python call site of every column expression costs most of the plan-building time.
    "spark.python.sql.dataFrameDebugging.enabled": "false",
}


def build_session(app: str = "starmart", master: str | None = None, **extra: str) -> SparkSession:
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in {**SETTINGS, **{k.replace("__", "."): v for k, v in extra.items()}}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


_local_scratch: str | None = None


def shared_folder(spark: SparkSession) -> str:
    """The folder all executors can reach, as the cluster names it in ``spark.checkpoint.dir``.

    Only a local session may fall back to a temporary folder, because there driver and executors
    share one disk.
    """
    global _local_scratch
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder:
        return folder
    if not spark.conf.get("spark.master", "").startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder shared by all executors")
    if _local_scratch is None:
        _local_scratch = tempfile.mkdtemp(prefix="starmart-")
    return _local_scratch


def scratch_path(spark: SparkSession, label: str) -> str:
    """A fresh path in the shared folder for a written intermediate table."""
    return f"{shared_folder(spark).rstrip('/')}/{label}-{uuid.uuid4().hex}"
