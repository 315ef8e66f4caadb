"""Streaming variants (an extension: the batch operators carry state between runs instead)."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..sources.staging import folder


def first_seen(events: DataFrame, delay: str = "7 days") -> DataFrame:
    """First sighting of each (user, type) within the watermark; later repeats fall away."""
    stream = events.withColumn("at", F.col("ts").cast("timestamp")).withWatermark("at", delay)
    return stream.dropDuplicatesWithinWatermark(["user_id", "event_type"])


def period_counts(events: DataFrame, delay: str = "1 day") -> DataFrame:
    """Listings per Monday-to-Sunday week and type, late rows admitted up to `delay`."""
    stream = events.withColumn("at", F.col("ts").cast("timestamp")).withWatermark("at", delay)
    # windows count from Thursday 1970-01-01; four days later is a Monday
    return stream.groupBy(F.window("at", "7 days", startTime="4 days"), "event_type").count()


def stream_first_seen(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Drain the landed events through the stream once, and read what the sink holds."""
    schema = spark.read.parquet(f"{sf_dir}/events.parquet").schema
    source = spark.readStream.schema(schema).option("pathGlobFilter", "*.parquet").parquet(f"{sf_dir}/events.parquet*")
    base = f"{folder(spark)}/stream-{uuid.uuid4().hex}"
    run = first_seen(source).select("user_id", "event_type").writeStream.format("parquet").option("checkpointLocation", f"{base}/log").option("path", f"{base}/out").trigger(availableNow=True).start()
    run.awaitTermination()
    return spark.read.schema("user_id long, event_type string").parquet(f"{base}/out")
