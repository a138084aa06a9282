"""Streams over the event and entry tables (an extension: the batch jobs have no streaming counterpart).

Late rows count as long as the watermark has not passed them; a batch form of each aggregation gives the same final rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def stream(spark: SparkSession, path: str, schema: T.StructType, per_trigger: int = 4) -> DataFrame:
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", per_trigger).parquet(path)


def windowed(events: DataFrame, time: str = "ts", by: str = "event_type", value: str = "value", width: str = "1 day", late: str | None = None) -> DataFrame:
    """(window_start, by, n, total) per tumbling window; with `late`, a watermark for streams."""
    rows = events if late is None else events.withColumn(time, F.col(time).cast("timestamp")).withWatermark(time, late)
    out = rows.groupBy(F.window(time, width).alias("w"), by).agg(F.count(F.lit(1)).alias("n"), F.sum(value).alias("total"))
    return out.select(F.col("w.start").alias("window_start"), by, "n", "total")


def sessions(events: DataFrame, time: str = "ts", by: str = "user_id", gap: str = "30 minutes", late: str | None = None) -> DataFrame:
    """(by, session_start, session_end, n) per session of a key; a session ends after a gap."""
    rows = events if late is None else events.withColumn(time, F.col(time).cast("timestamp")).withWatermark(time, late)
    out = rows.groupBy(F.session_window(time, gap).alias("w"), by).agg(F.count(F.lit(1)).alias("n"))
    return out.select(by, F.col("w.start").alias("session_start"), F.col("w.end").alias("session_end"), "n")


def distinct_entries(entries: DataFrame, key: list[str], time: str = "entered_at", late: str = "30 days") -> DataFrame:
    """Entries once each within the watermark, for rows delivered twice."""
    return entries.withColumn(time, F.col(time).cast("timestamp")).withWatermark(time, late).dropDuplicatesWithinWatermark(key)
