"""Keyed state inside a stream: when each key was first and last seen, until its day lies too far back.

The batch upsert (operators/state.py) carries the same columns between runs;
here the state lives in the stream's store, and event-time timers drop it.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from ..sources.staging import folder

PROVIDER, STORE = "spark.sql.streaming.stateStore.providerClass", "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
#: Days that a key outlives its day, and, for replay of a failed source, its last sighting (fixed values).
PAST, IDLE = 180, 7
_DAY = 86_400_000_000
_OUT = "key string, day long, first_seen long, last_seen long, expired boolean"


class Sightings(StatefulProcessor):
    """One value for each key: (day, first_seen, last_seen) in microseconds, and a timer for its end."""

    def __init__(self, past: int, idle: int | None):
        self.past, self.idle = past, idle

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.state = handle.getValueState("sighting", "day long, first_seen long, last_seen long")

    def end(self, day: int, last: int) -> int:
        """Milliseconds after which the key is dropped."""
        ends = [day + (self.past + 1) * _DAY] + ([last + self.idle * _DAY] if self.idle is not None else [])
        return min(ends) // 1000

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        seen = [(int(d), int(a)) for part in rows for d, a in zip(part["day_us"], part["at_us"], strict=True)]
        day, last = max(seen, key=lambda x: (x[1], x[0]))
        first = min(a for _, a in seen)
        if self.state.exists():
            old_day, old_first, old_last = self.state.get()
            first = min(first, old_first)
            day, last = max((day, last), (old_day, old_last), key=lambda x: (x[1], x[0]))
        for timer in list(self.handle.listTimers()):
            self.handle.deleteTimer(timer)
        self.state.update((day, first, last))
        self.handle.registerTimer(self.end(day, last))
        yield pd.DataFrame({"key": [key[0]], "day": [day], "first_seen": [first], "last_seen": [last], "expired": [False]})

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        if not self.state.exists():
            return
        day, first, last = self.state.get()
        self.state.clear()
        yield pd.DataFrame({"key": [key[0]], "day": [day], "first_seen": [first], "last_seen": [last], "expired": [True]})

    def close(self) -> None:
        pass


def sightings(seen: DataFrame, past: int = PAST, idle: int | None = None, delay: str = "1 day") -> DataFrame:
    """Changes of the state of a stream seen(key, day, at): (key, day, first_seen, last_seen, expired).

    Each batch gives one row for every key it holds; the day is that of the
    latest sighting. A key is dropped, and told so once, when the watermark has
    passed `past` days behind its day or `idle` days after its last sighting; a
    later sighting begins anew. Rows later than `delay` are left out by the
    watermark, as are rows without key or time. The session needs the RocksDB
    state store.
    """
    at = F.col("at").cast("timestamp")
    day = F.unix_micros(F.coalesce(F.col("day").cast("timestamp"), F.date_trunc("day", at)))
    rows = seen.where("key is not null and at is not null").select(F.col("key").cast("string").alias("key"), at.alias("at"), day.alias("day_us"), F.unix_micros(at).alias("at_us"))
    out = rows.withWatermark("at", delay).groupBy("key").transformWithStateInPandas(statefulProcessor=Sightings(past, idle), outputStructType=_OUT, outputMode="append", timeMode="eventTime")
    back = lambda c: F.timestamp_micros(c).alias(c)
    return out.select("key", F.to_date(F.timestamp_micros("day")).alias("day"), back("first_seen"), back("last_seen"), "expired")


def current(changes: DataFrame) -> DataFrame:
    """(key, day, first_seen, last_seen) of the keys that live after all changes."""
    last = changes.groupBy("key").agg(F.max_by(F.struct("day", "first_seen", "last_seen", "expired"), F.struct("last_seen", "expired", (-F.unix_micros("first_seen")).alias("f"))).alias("s"))
    return last.where("not s.expired").select("key", "s.day", "s.first_seen", "s.last_seen")


def drain(spark: SparkSession, source: DataFrame, base: str, **options) -> DataFrame:
    """Run all that has landed through the state once, and read the changes that the sink holds."""
    had = spark.conf.get(PROVIDER, None)
    spark.conf.set(PROVIDER, STORE)
    try:
        run = sightings(source, **options).writeStream.format("parquet").option("checkpointLocation", f"{base}/log").option("path", f"{base}/out").trigger(availableNow=True).start()
        run.awaitTermination()
    finally:
        spark.conf.unset(PROVIDER) if had is None else spark.conf.set(PROVIDER, had)
    return spark.read.schema("key string, day date, first_seen timestamp, last_seen timestamp, expired boolean").parquet(f"{base}/out")


def stream_keyed_state(spark: SparkSession, sf_dir: str) -> DataFrame:
    """First and last sighting of every user among the landed events, kept by the stream."""
    schema = spark.read.parquet(f"{sf_dir}/events.parquet").schema
    source = spark.readStream.schema(schema).option("pathGlobFilter", "*.parquet").parquet(f"{sf_dir}/events.parquet*")
    seen = source.select(F.col("user_id").alias("key"), F.to_date("ts").alias("day"), F.col("ts").alias("at"))
    live = current(drain(spark, seen, f"{folder(spark)}/state-{uuid.uuid4().hex}"))
    told = lambda c: F.date_format(c, "yyyy-MM-dd HH:mm:ss.SSSSSS").alias(c)
    return live.select(F.col("key").cast("long").alias("user_id"), F.col("day").cast("string").alias("day"), told("first_seen"), told("last_seen"))
