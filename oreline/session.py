"""Spark session settings and the shared scratch folder."""

from __future__ import annotations

import uuid

from pyspark.sql import SparkSession

SHUFFLE_BYTES_PER_TASK = 256 * 1024**2

# AQE coalesces small shuffles, splits skewed join partitions and turns to a broadcast only when
# the measured side is small.
SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.parquet.compression.codec": "zstd",
    # A join side is planned as a broadcast by its file size; count files as unpacked.
    "spark.sql.sources.fileCompressionFactor": "3.0",
    "spark.ui.enabled": "false",
}


def shuffle_tasks(shuffled_bytes: int) -> int:
    """Shuffle partitions to start from, so that one fits an executor; AQE merges small ones."""
    return max(200, -(-shuffled_bytes // SHUFFLE_BYTES_PER_TASK))


def build_session(
    app_name: str = "oreline",
    master: str | None = None,
    shuffled_bytes: int | None = None,
    **conf: str,
) -> SparkSession:
    """A session with the library's settings; ``conf`` uses ``__`` for dots and wins over them.

    ``master`` is only for local runs: on a cluster the submitter names it. ``shuffled_bytes`` is
    the size of the largest shuffle to expect, from which its partitions are counted.
    """
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    if shuffled_bytes is not None:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_tasks(shuffled_bytes)))
    for key, value in SETTINGS.items():
        builder = builder.config(key, value)
    for key, value in conf.items():
        builder = builder.config(key.replace("__", "."), value)
    return builder.getOrCreate()


class NoSharedFolder(ValueError):
    """There is no folder that driver and executors share."""


def scratch_path(spark: SparkSession, purpose: str) -> str:
    """A fresh path in the shared folder that ``spark.checkpoint.dir`` names.

    Every executor must be able to read it. Without that setting it is a folder of the warehouse, if
    that is shared: on a store, or on this machine when the executors run here too.
    """
    base = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not base:
        base = spark.conf.get("spark.sql.warehouse.dir").rstrip("/") + "/_scratch"
        local = spark.sparkContext.master.startswith("local")
        if not local and base.partition(":/")[0] in ("file", base):
            raise NoSharedFolder(f"set spark.checkpoint.dir: executors cannot see {base}")
    return f"{base.rstrip('/')}/oreline/{purpose}-{uuid.uuid4().hex}"
