"""Session settings the operators count on."""

from __future__ import annotations

from pyspark.sql import SparkSession

SETTINGS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.parquet.compression.codec": "zstd",
}


def local_session(cores: int | str = "*", memory: str = "8g") -> SparkSession:
    """A session on this machine, for trials and measurements. A cluster session is the caller's:
    it needs ``SETTINGS``, enough shuffle partitions, and ``spark.checkpoint.dir`` on shared storage.
    """
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName("pubweave")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", memory)
        .config("spark.sql.shuffle.partitions", "8" if cores == "*" else str(cores))
    )
    for name, value in SETTINGS.items():
        builder = builder.config(name, value)
    return builder.getOrCreate()
