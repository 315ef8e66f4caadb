"""Keyed state carried between runs."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def upsert(state: DataFrame, seen: DataFrame, key: str, now: Column, oldest: Column) -> DataFrame:
    """State(key, day, first_seen, last_seen) after a run that saw seen(key, day).

    First sightings keep the earliest time, new keys get `now`, rows whose day
    is before `oldest` expire. Keys are unique on both sides.
    """
    both = state.alias("s").join(seen.alias("n"), key, "full")
    new = F.col("n.day").isNotNull()
    out = both.select(key, F.coalesce("n.day", "s.day").alias("day"), F.coalesce("s.first_seen", now).alias("first_seen"), F.when(new, now).otherwise(F.col("s.last_seen")).alias("last_seen"))
    return out.where(F.col("day") >= oldest)

