"""Decisions by ordered evidence: an event's genre, a bill's acts, blanks filled by corroboration, predecessors of an identity."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.keys import event_identity

_NONE = "array<string>"
#: Genres in one unordered selection from which it says nothing (fixed value).
UNORDERED = 3
#: Confidence of each kind of evidence for a bill, and the least that an outside proposal needs (fixed values).
REVIEWED, CORROBORATED, CATALOGUE, LEAST = 100, 95, 90, 90


def source_genres(evidence: DataFrame, row: str) -> DataFrame:
    """(row, mapped, compound, unresolved, weak) from evidence(row, raw, genres, unordered, weak), one line per source label.

    mapped: the union of all sets; compound: one line alone supports that whole
    union; unresolved: an unordered selection of UNORDERED or more was set aside;
    weak: every label is weak.
    """
    broad = F.coalesce("unordered", F.lit(False)) & (F.size("genres") >= UNORDERED)
    e = evidence.withColumn("_set", F.array_sort(F.array_distinct(F.when(broad, F.array().cast(_NONE)).otherwise(F.coalesce("genres", F.array().cast(_NONE))))))
    g = e.groupBy(row).agg(F.array_sort(F.array_distinct(F.flatten(F.collect_list("_set")))).alias("mapped"), F.collect_set("_set").alias("_sets"), F.bool_or(broad).alias("unresolved"), F.bool_and(F.coalesce("weak", F.lit(False))).alias("weak"), F.array_distinct(F.collect_list(F.lower("raw"))).alias("raws"))
    return g.withColumn("compound", (F.size("mapped") > 1) & F.array_contains("_sets", F.col("mapped"))).drop("_sets")


def genre_cascade(events: DataFrame, row: str = "row") -> DataFrame:
    """(row, genre, method, source): the first of twelve branches that holds.

    events has festival, mapped, compound, unresolved, weak, raws (source_genres;
    null: no evidence), override and artist (struct<genre,source>), co_headliners,
    venue_genre, context_genre and bill_genre. An override or an artist's genre
    counts only for somebody who plays alone; an artist beats weak labels.
    """
    mapped = F.coalesce("mapped", F.array().cast(_NONE))
    flag = lambda c: F.coalesce(F.col(c), F.lit(False))
    alone = F.size(F.coalesce("co_headliners", F.array().cast(_NONE))) == 0
    has = lambda c: F.col(c).isNotNull()
    said = F.array_contains(F.coalesce("raws", F.array().cast(_NONE)), F.lower(mapped[0]))
    give = lambda g, m, s: F.struct(g.cast("string").alias("genre"), F.lit(m).alias("method"), (s if isinstance(s, Column) else F.lit(s)).cast("string").alias("source"))
    null = F.lit(None)
    one = F.size(mapped) == 1
    branches = [
        (has("festival"), give(null, "blank_festival", null)),
        (flag("unresolved") & (F.size(mapped) == 0), give(null, "blank_unresolved_taxonomy", null)),
        (has("artist") & one & flag("weak"), give(F.col("artist.genre"), "artist_mapping", F.col("artist.source"))),
        (one & said, give(mapped[0], "source_explicit", null)),
        (one, give(mapped[0], "source_mapping", null)),
        (flag("compound"), give(mapped[0], "source_mapping", null)),
        (has("override") & alone, give(F.col("override.genre"), "manual_override", F.col("override.source"))),
        (F.size(mapped) > 1, give(null, "conflict", null)),
        (has("artist") & alone, give(F.col("artist.genre"), "artist_mapping", F.col("artist.source"))),
        (has("venue_genre"), give(F.col("venue_genre"), "event_context", "venue")),
        (has("context_genre"), give(F.col("context_genre"), "event_context", "event_title_or_series")),
        (has("bill_genre"), give(F.col("bill_genre"), "bill_consensus", "mapped_bill_artists")),
    ]
    blank = F.when(has("mapped"), give(null, "blank_unresolved_raw", null)).otherwise(give(null, "blank_no_raw", null))
    chain = reduce(lambda out, b: out.when(*b), branches, F).otherwise(blank)
    return events.select(row, chain.alias("_c")).select(row, "_c.*")


def bill_genre(headliner: Column, others: Column) -> Column:
    """The headliner's mapped genre if no mapped co-headliner disagrees; `others` holds null for unmapped ones."""
    return F.when(F.size(others) > 0, F.when(F.forall(F.array_compact(others), lambda g: g == headliner), headliner))


def performance_consensus(resolved: DataFrame, artist: str, least: int = 2) -> DataFrame:
    """(artist, genre) where source evidence of at least two dated performances names one genre and no performance another.

    resolved(artist, genre, method, day, venue): rows of standalone artists.
    """
    own = resolved.where(F.col("method").isin("source_explicit", "source_mapping"))
    per = own.groupBy(artist, "genre").agg(F.count_distinct(F.struct("day", "venue")).alias("_n"))
    return per.groupBy(artist).agg(F.count("*").alias("_kinds"), F.min("genre").alias("genre"), F.max("_n").alias("_n")).where((F.col("_kinds") == 1) & (F.col("_n") >= least)).select(artist, "genre")


def resolve_bills(events: DataFrame, row: str = "row", inference: bool = True) -> DataFrame:
    """(row, artists, method, confidence): the first evidence for a bill that holds, null artists where none does.

    events has array columns reviewed_event, structured, reviewed_bill,
    cross_source, same_source, catalogue, external (with external_confidence),
    text columns reviewed_description and canonical, and boolean known. Arrays
    of fewer than two acts prove nothing; a known identity keeps its title;
    without inference only reviewed and structured evidence counts.
    """
    many = lambda c: F.size(F.coalesce(F.col(c), F.array().cast(_NONE))) > 1
    flat = F.size(F.coalesce("structured", F.array().cast(_NONE))) < 2
    give = lambda a, m, n: F.struct(a.cast(_NONE).alias("artists"), F.lit(m).alias("method"), (n if isinstance(n, Column) else F.lit(n)).cast("int").alias("confidence"))
    name = lambda c: F.array(F.col(c))
    nothing = F.lit(None)
    sure = [
        (many("reviewed_event"), give(F.col("reviewed_event"), "reviewed_event", REVIEWED)),
        (many("structured"), give(F.col("structured"), "structured_source", REVIEWED)),
        (F.coalesce("reviewed_description", F.lit("")) != "", give(name("reviewed_description"), "reviewed_registry", REVIEWED)),
        (many("reviewed_bill") & flat, give(F.col("reviewed_bill"), "reviewed_registry", REVIEWED)),
        (F.coalesce("canonical", F.lit("")) != "", give(name("canonical"), "reviewed_registry", REVIEWED)),
    ]
    inferred = [
        (F.coalesce("known", F.lit(False)), give(nothing, "known_identity", nothing)),
        (many("cross_source"), give(F.col("cross_source"), "cross_source", CORROBORATED)),
        (many("same_source"), give(F.col("same_source"), "same_source", CORROBORATED)),
        (many("catalogue"), give(F.col("catalogue"), "canonical_identity", CATALOGUE)),
        (many("external") & (F.coalesce("external_confidence", F.lit(0)) >= LEAST), give(F.col("external"), "external_corroboration", F.col("external_confidence"))),
    ]
    chain = reduce(lambda out, b: out.when(*b), sure + (inferred if inference else []), F).otherwise(give(nothing, "unresolved" if inference else "not_inferred", nothing))
    return events.select(row, chain.alias("_b")).select(row, "_b.*")


def fill_blanks(df: DataFrame, evidence: DataFrame, keys: list[str], columns: list[str], order: str) -> DataFrame:
    """`df` with its null `columns` taken from the first `evidence` row (by `order`) of equal keys; values never change.

    Evidence that lacks a key verifies nothing.
    """
    known = reduce(lambda a, k: a & F.col(k).isNotNull(), keys, F.lit(True))
    first = evidence.where(known).groupBy(*keys).agg(F.min_by(F.struct(*columns), order).alias("_first"))
    out = df.join(first, keys, "left")
    return out.select(*[F.coalesce(c, f"_first.{c}").alias(c) if c in columns else F.col(c) for c in df.columns])


def predecessors(events: DataFrame, row: str, moves: DataFrame, titles: DataFrame) -> DataFrame:
    """(row, identity): identities that an event may have had before, its own left out.

    events(row, day, headliner, venue, aliases, raw_title, event_title, time)
    with folded keys; moves(day, headliner, old_venue, venue) and titles(headliner,
    old_title) are reviewed. Sources: aliases, titles with the clock written
    behind them, places that were moved from, titles that were replaced.
    """
    day = F.col("day").cast("string")
    clock = F.when(F.col("time").rlike("^[0-9]{2}:[0-9]{2}$"), F.replace("time", F.lit(":"), F.lit("h")))
    timed = F.transform(F.array_compact(F.array("headliner", "raw_title", "event_title")), lambda t: F.concat(t, F.lit(" – "), clock))
    names = F.array_distinct(F.array_compact(F.concat(F.coalesce("aliases", F.array().cast(_NONE)), F.when(clock.isNotNull(), timed).otherwise(F.array().cast(_NONE)))))
    spelled = events.select(row, day.alias("day"), "venue", F.explode(names).alias("headliner"))
    renamed = events.join(titles, "headliner").select(row, day.alias("day"), "venue", F.col("old_title").alias("headliner"))
    moved = events.withColumn("day", day).join(moves.withColumn("day", F.col("day").cast("string")), ["day", "headliner", "venue"]).select(row, "day", F.col("old_venue").alias("venue"), "headliner")
    all_ = reduce(DataFrame.unionByName, (d.select(row, event_identity(F.col("day"), F.col("headliner"), F.col("venue")).alias("identity")) for d in (spelled, renamed, moved)))
    own = events.select(row, event_identity(day, F.col("headliner"), F.col("venue")).alias("identity"))
    return all_.distinct().join(own, [row, "identity"], "left_anti")


def carried(events: DataFrame, before: DataFrame, state: DataFrame, row: str, now: Column) -> DataFrame:
    """(row, first_seen): the earliest sighting of an event's own identity and its predecessors in state(identity, first_seen), else now."""
    own = events.select(row, event_identity(F.col("day").cast("string"), F.col("headliner"), F.col("venue")).alias("identity"))
    seen = own.unionByName(before).join(state, "identity").groupBy(row).agg(F.min("first_seen").alias("first_seen"))
    return events.select(row).join(seen, row, "left").select(row, F.coalesce("first_seen", now).alias("first_seen"))


#: Words in titles that tell sets of one day apart (fixed values).
SETS = ("1er set", "2e set", "first set", "first performance", "second set", "second performance", "matinée", "evening", "early show", "late show")


def performance(time: Column, marker: Column, title: Column) -> Column:
    """What tells performances of one identity apart: HH:MM and a set marker, the source's or the title's; empty if neither."""
    found = F.regexp_extract(F.lower(F.coalesce(title, F.lit(""))), rf"(?<!\w)({'|'.join(SETS)})(?!\w)", 1)
    mark = F.when(F.coalesce(marker, F.lit("")) != "", marker).otherwise(found)
    clock = F.coalesce(time, F.lit(""))
    return F.when((clock == "") & (mark == ""), "").otherwise(F.concat(clock, F.lit("|"), mark))
