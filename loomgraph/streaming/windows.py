"""Windowed counts over a stream of events."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def counts(events: DataFrame, window: str = "1 hour", late: str = "10 minutes") -> DataFrame:
    """Events per type and window; rows that come later than `late` behind the newest are left out of a stream's result."""
    return events.withColumn("ts", F.col("ts").cast("timestamp")).withWatermark("ts", late).groupBy(F.window("ts", window).alias("w"), "event_type").agg(F.count(F.lit(1)).alias("n"), F.round(F.sum("value"), 6).alias("total")).select(F.col("w.start").alias("start"), "event_type", "n", "total")
