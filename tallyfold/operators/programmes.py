"""Programmes: festival days, windows of dates, performers' evidence, bills of merged listings, the archive's audit."""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..sources.staging import cut

#: What stands between the names of a bill (fixed values).
BILL_MARKS = r"\s+(?:\+|&|/|x)\s+|\s*,\s+"


def festival_days(acts: DataFrame, main: Column) -> DataFrame:
    """(day, headliner, openers): the longest act of the main stage, then all others as listed.

    acts(day, position, artist, minutes); of equally long acts the first listed
    counts; days without a main stage give no row.
    """
    top = F.max(F.when(main, F.struct("minutes", (-F.col("position")).alias("back"), "artist"))).alias("top")
    days = acts.groupBy("day").agg(top, F.array_sort(F.collect_list(F.struct("position", "artist"))).alias("acts")).where("top is not null")
    return days.select("day", F.col("top.artist").alias("headliner"), F.transform(F.filter("acts", lambda a: a["position"] != -F.col("top.back")), lambda a: a["artist"]).alias("openers"))


def date_windows(spark, first: dt.date, days: int = 385, step: int = 7) -> DataFrame:
    """(start, stop): the days from `first` on, dealt in windows of `step` days; stop included."""
    w = spark.range(0, days, step).select(F.date_add(F.lit(first), F.col("id").cast("int")).alias("start"))
    return w.select("start", F.least(F.date_add("start", step - 1), F.date_add(F.lit(first), days - 1)).alias("stop"))


def bisected(windows: DataFrame) -> DataFrame:
    """(start, stop): the halves of windows(start, stop, more) that had more than they gave; windows of one day end there."""
    middle = F.date_add("start", F.floor(F.date_diff("stop", "start") / 2).cast("int"))
    halves = F.array(F.struct("start", middle.alias("stop")), F.struct(F.date_add(middle, 1).alias("start"), "stop"))
    return windows.where("more and start < stop").select(F.explode(halves).alias("w")).select("w.*")


def adaptive_windows(windows: DataFrame, fetch: Callable[[DataFrame], tuple[DataFrame, DataFrame]], most: int = 95) -> tuple[DataFrame, DataFrame]:
    """(rows, windows asked) of fetch over windows(start, stop), halved until none has more than it gave.

    fetch takes windows(start, stop) and gives (rows with start and stop,
    windows with `more`). Every window is one request; where a round would go
    beyond `most` requests, its earliest windows are asked and the others told
    as not asked. Windows asked: (start, stop, round, status), where status is
    complete, halved, overflow (a single day with more), or not asked; only
    rows of windows that are complete or overflow count, so no row comes twice.
    The load is incomplete if any window overflows or was not asked.
    """
    spent, got, told, number = 0, [], [], 0
    windows = cut(windows.select("start", "stop"))
    while (n := windows.count()) and spent < most:
        number += 1
        left = most - spent
        if n > left:
            told.append(windows.orderBy("start").offset(left).select("start", "stop", F.lit(number).alias("round"), F.lit("not asked").alias("status")))
            windows = windows.orderBy("start").limit(left)
        rows, seen = fetch(windows)
        spent += min(n, left)
        status = F.when(~F.col("more"), "complete").when(F.col("start") < F.col("stop"), "halved").otherwise("overflow")
        seen = cut(seen.select("start", "stop", "more", status.alias("status")))
        told.append(seen.select("start", "stop", F.lit(number).alias("round"), "status"))
        got.append(cut(rows.join(seen.where("status <> 'halved'").select("start", "stop"), ["start", "stop"], "left_semi")))
        windows = cut(bisected(seen))
    if n:
        told.append(windows.select("start", "stop", F.lit(number + 1).alias("round"), F.lit("not asked").alias("status")))
    if not got:
        raise ValueError("no window was asked")
    return reduce(DataFrame.unionByName, got), reduce(DataFrame.unionByName, told)


def within_windows(rows: DataFrame, day: str) -> DataFrame:
    """rows(start, stop, ...) whose day lies in the window that was asked for."""
    return rows.where(F.col(day).between(F.col("start"), F.col("stop")))


def structured_identities(events: DataFrame, known: DataFrame, artist: Column | None = None) -> DataFrame:
    """(key, status, name, sources, events): artists that sources list one by one; status says what they are worth.

    events(title, performers, sources) with at least two different performers;
    a list fails whole if two names share a key, if one is the bill itself, or
    fails `artist`, a test of the column `name`. known(key, name). Several
    spellings need review, names under four letters need two sources.
    """
    squeeze = lambda c: F.trim(F.regexp_replace(c, r"\s+", " "))
    e = events.select("title", "sources", F.array_distinct(F.transform(F.array_compact("performers"), squeeze)).alias("names"), F.monotonically_increasing_id().alias("_row"))
    keys = F.transform("names", F.lower)
    title = F.lower(squeeze(F.col("title")))
    opaque = F.exists("names", lambda n: (F.lower(n) == title) & n.rlike(BILL_MARKS))
    e = e.where((F.size("names") > 1) & (F.size(F.array_distinct(keys)) == F.size("names")) & ~F.coalesce(opaque, F.lit(False)) & (F.size("sources") > 0))
    acts = e.select("_row", "sources", F.explode("names").alias("name"))
    if artist is not None:
        acts = acts.join(acts.where(~artist).select("_row").distinct(), "_row", "left_anti")
    acts = acts.withColumn("key", F.lower("name")).where("key <> ''")
    listed = acts.groupBy("key").agg(F.count_distinct("_row").alias("events"), F.min("name").alias("first"), F.count_distinct(F.lower("name")).alias("spellings"))
    told = acts.select("key", F.explode("sources").alias("source")).groupBy("key").agg(F.count_distinct("source").alias("sources"))
    all_ = listed.join(told, "key").join(known.select("key", F.col("name").alias("given")), "key", "left")
    status = F.when(F.col("given").isNotNull(), "already_known").when(F.col("spellings") > 1, "variant_spelling").when((F.length("key") < 4) & (F.col("sources") < 2), "short_name").otherwise("new_verified")
    return all_.select("key", status.alias("status"), F.coalesce("given", "first").alias("name"), "sources", "events")


def headlined(listings: DataFrame, group: str = "group", split: str = BILL_MARKS) -> DataFrame:
    """(group, headliner, co_headliners): what a merged group of listings(group, title, source) bills.

    The shortest title is the headliner and is never split. If the longest one
    begins with it, followed by a mark between names, and several sources
    speak, the names behind become co-headliners; where that mark is none of
    `split`, the longest title is the headliner as it stands.
    """
    size = F.struct(F.length("title"), "title")
    g = listings.groupBy(group).agg(F.min_by("title", size).alias("headliner"), F.max_by("title", size).alias("whole"), F.min("source").alias("low"), F.max("source").alias("high"))
    rest = F.substr("whole", F.length("headliner") + 1)
    longer = (F.col("low") < F.col("high")) & F.startswith(F.lower("whole"), F.lower("headliner")) & rest.rlike(f"^(?:{BILL_MARKS})")
    names = F.filter(F.transform(F.split(rest, BILL_MARKS), F.trim), lambda n: n != "")
    parted = longer & rest.rlike(f"^(?:{split})")
    return g.select(group, F.when(longer & ~parted, F.col("whole")).otherwise(F.col("headliner")).alias("headliner"), F.when(parted, names).otherwise(F.array().cast("array<string>")).alias("co_headliners"))


def reviewed_titles(listings: DataFrame, equal: DataFrame) -> DataFrame:
    """listings(day, venue, key, ...) with the key that a review names for it on that day at that place; equal(day, venue, key, same).

    Keys only become candidates: whether equal ones merge still depends on their times.
    """
    e = equal.groupBy("day", "venue", "key").agg(F.min("same").alias("_same"))
    out = listings.join(e, ["day", "venue", "key"], "left")
    return out.select(*[F.coalesce("_same", "key").alias("key") if c == "key" else F.col(c) for c in listings.columns])


def kept_apart(merged: DataFrame, group: str = "group") -> DataFrame:
    """(day, venue, key, groups, first, last): equal titles of one day and place that the merge left in several groups of merged(day, venue, key, group)."""
    known = merged.where("day is not null and venue is not null and key is not null")
    return known.groupBy("day", "venue", "key").agg(F.count_distinct(group).alias("groups"), F.min(group).alias("first"), F.max(group).alias("last")).where("groups > 1")


#: Flags of an archived post and the reasons they give, in order (fixed values).
FLAGS = {"wrong_primary": "WRONG_PRIMARY", "catalogue_owner_mismatch": "CATALOGUE_OWNER_MISMATCH", "context_as_artist": "CONTEXT_PROMOTED_AS_ARTIST", "contamination": "CONTAMINATION", "shared_id": "SUSPICIOUS_SHARED_APPLE_ID", "unproven_recovery": "UNPROVEN_HISTORICAL_RECOVERY"}


def archive_tiers(posts: DataFrame, row: str = "post", reasons: dict[str, str] | None = None) -> DataFrame:
    """(post, tier, reasons) of posts(post, ordinary, subject, artist_key, confident, has_payload, the columns of FLAGS, found, found_key, found_name, found_id, payload_id, valid, exact).

    reasons: names of single reasons of FLAGS that a catalogue words in its own
    way. D: nobody surely named. C: nothing to show, or the catalogue does not know
    the artist. A: to repair, by flag or by evidence that does not agree. B: sound.
    """
    yes = lambda c: F.coalesce(F.col(c).cast("boolean"), F.lit(False))
    some = lambda c: F.coalesce(F.col(c) != "", F.lit(False))
    all_ = lambda *tests: reduce(lambda a, b: a & b, tests)
    flags = F.array_compact(F.array(*[F.when(yes(c), reason) for c, reason in (FLAGS | (reasons or {})).items()]))
    agrees = all_(F.equal_null(F.lower(F.trim("subject")), F.lower(F.trim("found_name"))), F.equal_null("artist_key", "found_key"), some("payload_id"), F.equal_null("payload_id", "found_id"), yes("valid"), yes("exact"))
    told = lambda tier, reason: F.struct(F.lit(tier).alias("tier"), F.array(F.lit(reason)).alias("reasons"))
    out = F.when(~all_(yes("ordinary"), some("subject"), some("artist_key"), yes("confident")), told("D", "DEFERRED_NON_ORDINARY_OR_AMBIGUOUS"))
    out = out.when(~yes("has_payload"), told("C", "NO_READY_RECOMMENDATION_PAYLOAD")).when(F.size(flags) > 0, F.struct(F.lit("A").alias("tier"), flags.alias("reasons")))
    out = out.when(~all_(yes("found"), some("found_key"), some("found_name"), some("found_id")), told("C", "CATALOGUE_UNRESOLVED"))
    out = out.when(~agrees, told("A", "INDEPENDENT_IDENTITY_EVIDENCE_INCOMPLETE_OR_CONFLICTING")).otherwise(told("B", "INDEPENDENT_HEALTHY_LEGACY_IDENTITY"))
    return posts.select(row, out.alias("_o")).select(row, "_o.*")


def archive_audit(posts: DataFrame, payloads: DataFrame, static: DataFrame, key: str = "post") -> DataFrame:
    """Posts, their preferred payloads and static payloads by `key`, each side whole: what one lacks is null, `sides` tells which have it."""
    mark = lambda d, name: d.withColumn(f"_{name}", F.lit(name))
    out = mark(posts, "post").join(mark(payloads, "payload"), key, "full").join(mark(static, "static"), key, "full")
    return out.withColumn("sides", F.concat_ws("+", "_post", "_payload", "_static")).drop("_post", "_payload", "_static")


def agreed_ids(payloads: DataFrame) -> DataFrame:
    """(key, external, posts): names whose sure payloads(post, names, confident, external) all give one external id."""
    sure = payloads.where((F.size("names") == 1) & F.col("confident") & (F.col("external") != "")).select(F.lower(F.trim(F.get("names", F.lit(0)))).alias("key"), "post", "external")
    g = sure.groupBy("key").agg(F.min("external").alias("external"), F.max("external").alias("_last"), F.count_distinct("post").alias("posts"))
    return g.where("external = _last").drop("_last")
