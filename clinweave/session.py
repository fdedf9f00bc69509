"""Session defaults for local runs; on a cluster the submitted settings win."""

from __future__ import annotations

from pyspark.sql import SparkSession

DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def local_session(cpus: int | str = "*", partitions: int = 8, memory: str = "8g", **more: str) -> SparkSession:
    """A session on this machine, for tests and the benchmark."""
    builder = SparkSession.builder.master(f"local[{cpus}]").appName("clinweave")
    conf = DEFAULTS | {"spark.sql.shuffle.partitions": str(partitions), "spark.driver.memory": memory} | more
    for key, value in conf.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark
