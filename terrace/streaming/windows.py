"""Event-time windows with watermarks, for batch tables and streams alike (an extension)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def event_stream(spark: SparkSession, folder: str, schema, names: str = "*.parquet") -> DataFrame:
    """A folder's Parquet files of some names as a stream."""
    return spark.readStream.schema(schema).option("pathGlobFilter", names).parquet(folder)


def _marked(events: DataFrame, late: str) -> DataFrame:
    return events.withColumn("ts", F.col("ts").cast("timestamp")).withWatermark("ts", late) if events.isStreaming else events


def tumbling(events: DataFrame, width: str, late: str = "1 hour") -> DataFrame:
    """``start, event_type, n, total`` by fixed windows."""
    out = _marked(events, late).groupBy(F.window("ts", width).alias("w"), "event_type").agg(F.count(F.lit(1)).alias("n"), F.sum("value").alias("total"))
    return out.select(F.col("w.start").alias("start"), "event_type", "n", "total")


def sliding(events: DataFrame, width: str, step: str, late: str = "1 hour") -> DataFrame:
    out = _marked(events, late).groupBy(F.window("ts", width, step).alias("w")).agg(F.count(F.lit(1)).alias("n"))
    return out.select(F.col("w.start").alias("start"), "n")


def sessions(events: DataFrame, gap: str, late: str = "1 hour") -> DataFrame:
    """``user_id, start, n`` by runs of a user's events with no gap as long as ``gap``."""
    out = _marked(events, late).groupBy("user_id", F.session_window("ts", gap).alias("w")).agg(F.count(F.lit(1)).alias("n"))
    return out.select("user_id", F.col("w.start").alias("start"), "n")
