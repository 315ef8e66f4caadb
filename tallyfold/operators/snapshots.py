"""Per-source snapshots: judged loads, bounded replay, replacement, and what replay must keep."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..sources.staging import cut
from . import listings

#: A fallback holding under half of the last inventory and missing at least twenty rows is partial (fixed values).
LEAST_RATIO, LEAST_MISSING = 0.5, 20
RETENTION_DAYS = 7

#: Parts (64-bit numbers) that all tasks may hold at once; more are met by a shuffle.
BROADCAST_PARTS = 2_000_000


def judge(loads: DataFrame, fresh: DataFrame, held: DataFrame, today: Column) -> DataFrame:
    """loads(source, status, path, incomplete) with prior_n, fresh_n and the final status.

    An ok load becomes partial if it says so, or if it is a fallback that lost
    too much of the held rows that still lie ahead.
    """
    n = lambda d, name: d.groupBy("source").agg(F.count("*").alias(name))
    out = loads.join(n(held.where(F.col("day") >= today), "prior_n"), "source", "left").join(n(fresh, "fresh_n"), "source", "left").fillna(0, ["prior_n", "fresh_n"])
    shrunk = (F.col("path") == "fallback") & (F.col("prior_n") > 0) & (F.col("fresh_n") < LEAST_RATIO * F.col("prior_n")) & (F.col("prior_n") - F.col("fresh_n") >= LEAST_MISSING)
    partial = (F.col("status") == "ok") & (F.coalesce("incomplete", F.lit(False)) | shrunk)
    return out.withColumn("status", F.when(partial, "partial").otherwise(F.col("status")))


def replay(fresh: DataFrame, held: DataFrame, judged: DataFrame, same: list[str], now: Column, today: Column) -> DataFrame:
    """Held rows of failed and partial sources with fate: restored, suppressed, past, expired.

    held(source, day, last_success, ...). A row is expired when its source's last
    success is over seven days old, in the future or unknown; past before today;
    suppressed when a fresh row equals it on the columns `same`.
    """
    live = fresh.select(*same).distinct().withColumn("_live", F.lit(True))
    return _weak(held, judged).join(live, same, "left").withColumn("fate", _fate(now, today)).drop("_live")


def _weak(held: DataFrame, judged: DataFrame) -> DataFrame:
    """Held rows of failed and partial sources with _status; judged holds one row a source, so it is broadcast and rows are not dealt by source."""
    weak = judged.where(F.col("status").isin("failed", "partial")).select("source", F.col("status").alias("_status"))
    return held.join(F.broadcast(weak), "source")


def _gone(now: Column, today: Column) -> Column:
    """expired or past; null for rows whose fate the fresh ones decide."""
    age = F.unix_timestamp(now) - F.unix_timestamp(F.col("last_success"))
    old = F.coalesce(~age.between(0, RETENTION_DAYS * 86400), F.lit(True))
    return F.when(old, "expired").when(F.col("day") < today, "past")


def _fate(now: Column, today: Column) -> Column:
    return F.coalesce(_gone(now, today), F.when(F.col("_live"), "suppressed").otherwise("restored"))


def replay_equivalent(fresh: DataFrame, held: DataFrame, judged: DataFrame, now: Column, today: Column) -> DataFrame:
    """`replay` where a held row is suppressed when the listing merge would put it into one group with a fresh row.

    fresh and held have the columns of the merge (row, day, venue_key, title,
    time, source, official, ticket); rows are numbered through both sides.
    """
    told = ("row", "day", "venue_key", "title", "time", "source", "official", "ticket")
    side = lambda d, name, asks: d.select(*[F.concat(F.lit(f"{name}:"), F.col("row").cast("string")).alias("row") if c == "row" else F.col(c) for c in told], asks.alias("_asks"))
    weak = _weak(held, judged)
    rows = listings.parted(side(fresh, "fresh", F.lit(1)).unionByName(side(weak, "held", F.when(_gone(now, today).isNull(), 2).otherwise(0))))
    # only parts with a fresh row and a held one that asks for it are merged, but these with all their rows
    asking = cut(rows.where("_asks = 2").select("part").distinct())
    near = cut(rows.join(F.broadcast(asking) if asking.count() <= BROADCAST_PARTS else asking, "part", "left_semi"))
    groups = listings.merge(near.join(near.where("_asks = 1").select("part").distinct(), "part", "left_semi"), part="part")
    # the least row names a group, and fresh: comes before held:
    live = groups.where("startswith(row, 'held:') and startswith(`group`, 'fresh:')").select(F.substring("row", 6, 1 << 20).alias("_key"), F.lit(True).alias("_live")).distinct()
    return weak.withColumn("_key", F.col("row").cast("string")).join(live, "_key", "left").withColumn("fate", _fate(now, today)).drop("_key", "_live")


def update(fresh: DataFrame, replayed: DataFrame, judged: DataFrame, now: Column, today: Column) -> DataFrame:
    """The next snapshot: ok sources are replaced, empty ones cleared, failed and partial ones carry what replay kept.

    A partial source keeps its suppressed rows too: its last whole inventory stays for later replays.
    """
    ok = fresh.where(F.col("day") >= today).join(judged.where("status = 'ok'").select("source"), "source", "left_semi").withColumn("last_success", now)
    kept = replayed.where((F.col("fate") == "restored") | ((F.col("fate") == "suppressed") & (F.col("_status") == "partial")))
    return ok.unionByName(kept.select(*ok.columns))


def lost_identities(restored: DataFrame, final: DataFrame, key: str = "public_id") -> DataFrame:
    """Restored rows whose identity or first sighting the final rows no longer have; a run demands none."""
    after = final.select(key, F.col("first_seen").alias("_first"))
    j = restored.join(after, key, "left")
    return j.where(~F.col("_first").eqNullSafe(F.col("first_seen"))).drop("_first")


def unmixed(df: DataFrame, judged: DataFrame) -> DataFrame:
    """Rows whose sources are both healthy and weak: deduplication must leave none."""
    return unmixed_sources(df.select("row", F.explode("sources").alias("source")), judged)


def unmixed_sources(each: DataFrame, judged: DataFrame) -> DataFrame:
    """`unmixed` of each(row, source), one row for every source that a row has: two flags a row, no list.

    judged holds one row a source and is broadcast, so rows are never dealt by the few values of their source.
    """
    sound = F.col("status").isin("ok", "empty").alias("_ok")
    told = each.join(F.broadcast(judged.select("source", sound)), "source")
    return told.groupBy("row").agg(F.max(F.col("_ok").cast("int")).alias("_most"), F.min(F.col("_ok").cast("int")).alias("_least")).where("_most > _least").select("row")
