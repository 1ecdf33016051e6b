"""Session settings the jobs are written for."""

from __future__ import annotations

from pyspark.sql import SparkSession

# fixed values: adaptive execution does skew splitting and partition coalescing
SETTINGS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
    # expressions of wide models have hundreds of nodes; do not record a call site for each
    "spark.python.sql.dataFrameDebugging.enabled": "false",
}


def build_session(
    app: str = "clickweave",
    master: str | None = None,
    shuffle_partitions: int | None = None,
    driver_memory: str | None = None,
    **extra: str,
) -> SparkSession:
    b = SparkSession.builder.appName(app)
    if master:
        b = b.master(master)
    if shuffle_partitions:
        b = b.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    if driver_memory:
        b = b.config("spark.driver.memory", driver_memory)
    for k, v in {**SETTINGS, **extra}.items():
        b = b.config(k, v)
    return b.getOrCreate()
