"""Sessions of a stream by event time."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def session_counts(events: DataFrame, user: str, ts: str, gap: str, late: str) -> DataFrame:
    """Per user and session its bounds, number of events and summed value.

    State per open session is a few numbers. Rows later than the watermark are
    dropped; a batch table gives the same result without a watermark's delay.
    """
    timed = events.withColumn("_ts", F.col(ts).cast("timestamp"))
    if events.isStreaming:
        timed = timed.withWatermark("_ts", late)
    grouped = timed.groupBy(user, F.session_window("_ts", gap).alias("w"))
    return grouped.agg(F.count(F.lit(1)).alias("n_events"), F.sum("value").alias("total")).select(
        user, F.col("w.start").alias("session_start"), F.col("w.end").alias("session_end"), "n_events", "total"
    )


def start_sessions(stream: DataFrame, user: str, ts: str, gap: str, late: str, out: str, checkpoint: str):
    return (
        session_counts(stream, user, ts, gap, late)
        .writeStream.outputMode("append")
        .format("parquet")
        .option("path", out)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
