"""The flagship query: observed listings to daily facets of first performances."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..sources.tables import table


def flagship(spark: SparkSession, sf_dir: str) -> DataFrame:
    """First listing per (date, artist), joined to its venue's nation, counted by month and nation, ordered."""
    events = table(spark, sf_dir, "events").select("event_id", "user_id", "event_type", F.col("ts").cast("timestamp_ntz").alias("ts"))
    listed = events.where(F.col("ts").isNotNull()).withColumn("day", F.to_date("ts"))
    first = listed.withColumn("nth", F.row_number().over(Window.partitionBy("day", "user_id").orderBy("ts", "event_id"))).where("nth = 1")
    venues = table(spark, sf_dir, "supplier").select(F.col("s_suppkey").alias("venue"), "s_nationkey")
    nations = table(spark, sf_dir, "nation").select(F.col("n_nationkey").alias("s_nationkey"), F.col("n_name").alias("nation"))
    placed = first.join(venues, first["user_id"] == venues["venue"], "left").join(nations, "s_nationkey", "left")
    facets = placed.groupBy(F.date_format("day", "yyyy-MM").alias("month"), F.coalesce("nation", F.lit("Unsorted")).alias("nation")).agg(F.count("*").alias("listings"), F.count_distinct("user_id").alias("artists"))
    return facets.orderBy("month", "nation")
