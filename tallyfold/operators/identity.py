"""Identities that outlive a run: scored continuity, assignment of keys and routes, quarantine."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.keys import canonical_url, fold, fold_latin, fold_letters
from ..sources.staging import cut
from . import joins
from .resolution import similar

#: Last path parts of ticket addresses that name no event (fixed values).
LANDING = ("agenda", "events", "event", "billetterie", "tickets", "ticketing", "programme", "programmation")
#: Words that may follow a name without changing it (fixed values).
PRESENTATION = ("live", "tour", "world tour", "paris")
#: Evidence scores of a continuity edge (fixed values).
TICKET, BILL, ARTIST, SPELLING, WEAK = 400, 340, 320, 300, 280
SAME_VENUE, SAME_ARTIST, SAME_TIME = 40, 20, 10
MOST_DAYS, LEAST_RATIO = 180, 0.96
#: Lengths of the longer of two names that may differ by one letter and no more; from LONG letters on both, by more.
ONE_LETTER, LONG = (13, 25), 24
_SEVERAL = r"\s(?:&|\+|/|,|–|—|-)\s"


def phrase(text: Column, folded=fold_latin) -> Column:
    """Latin letters and digits of a name as single-spaced words; names of other scripts give none, and match nothing."""
    return F.trim(F.regexp_replace(folded(F.coalesce(text, F.lit(""))), "[^a-z0-9]+", " "))


def ticket_key(url: Column | str) -> Column:
    """Canonical address of an event's own ticket page; landing pages without a query are none."""
    clean = canonical_url(url)
    leaf = F.lower(F.regexp_extract(clean, r"([^/]*)$", 1))
    return F.when(~leaf.isin(*LANDING), clean)


def _sides(df: DataFrame, row: str, tag: str) -> DataFrame:
    bill = F.concat_ws(" + ", "headliner", F.coalesce("co_headliners", F.array().cast("array<string>")))
    keys = {"row": F.col(row), "day": F.to_date("day"), "time": F.nullif(F.col("time"), F.lit("")), "ticket": ticket_key("ticket"), "venue": F.nullif(F.concat_ws("|", fold("venue", "venue"), fold("city", "city")), F.lit("|")), "name": phrase(F.col("headliner")), "bill": phrase(bill), "title": F.col("headliner")}
    out = cut(df.select(*(v.alias(f"{tag}_{k}") for k, v in keys.items())))
    # counted by an aggregate over real tickets: rows without one never meet
    alone = out.where(F.col(f"{tag}_ticket").isNotNull()).groupBy(f"{tag}_ticket").agg((F.count("*") == 1).alias(f"{tag}_alone"))
    return cut(out.join(alone, f"{tag}_ticket", "left"))  # three joins read it


def _shorter(name: Column) -> Column:
    """A name of the lengths where a ratio of 0.96 allows one letter more or less, each letter in turn left out."""
    out = F.transform(F.sequence(F.lit(1), F.length(name)), lambda i: F.concat(F.substring(name, F.lit(1), i - 1), F.substring(name, i + 1, F.length(name))))
    return F.when(F.length(name).between(*ONE_LETTER), out).otherwise(F.array().cast("array<string>"))


def _older(name: Column, title: Column) -> Column:
    """Every old name that `name` may continue by being it, dressing it, or naming more; or by one letter more."""
    words = F.split(name, " ")
    runs = F.flatten(F.transform(F.sequence(F.lit(1), F.size(words)), lambda i: F.transform(F.sequence(i, F.size(words)), lambda j: F.concat_ws(" ", F.slice(words, i, j - i + 1)))))
    bare = [F.when(F.endswith(name, F.lit(f" {w}")), F.substring(name, F.lit(1), F.length(name) - len(w) - 1)) for w in PRESENTATION]
    told = F.array_compact(F.array(name, *(F.concat(name, F.lit(f" {w}")) for w in PRESENTATION), *bare))
    keys = F.concat(told, F.when(title.rlike(_SEVERAL), runs).otherwise(F.array().cast("array<string>")), _shorter(name))
    return F.filter(F.array_distinct(keys), lambda k: k != "")


def continuity(listings: DataFrame, published: DataFrame, row: str, public_id: str) -> DataFrame:
    """(row, public_id, score): which published identity each listing may continue.

    Both tables have day, time (HH:MM), headliner, co_headliners, venue, city,
    ticket. Candidates come from three equi joins: (ticket, day), (venue, day),
    and ticket alone where it is unique on both sides, which is the only way to
    move to another day (same venue and bill, at most 180 days). A shared ticket
    page therefore never multiplies over days. Null names, venues and tickets
    match nothing; differing times rule an edge out.
    """
    a, b = _sides(listings, row, "a"), _sides(published, public_id, "b")
    eq = lambda k: F.col(f"a_{k}") == F.col(f"b_{k}")
    known = lambda k: F.col(f"a_{k}") != ""
    at = lambda c: F.coalesce(c, F.lit(False))
    calm = F.coalesce(eq("time"), F.lit(True))
    moved = eq("ticket") & F.col("a_alone") & F.col("b_alone") & ~eq("day") & eq("venue") & eq("bill") & known("bill") & (F.abs(F.datediff("a_day", "b_day")) <= MOST_DAYS)
    old, new = F.col("b_name"), F.col("a_name")
    pad = lambda c: F.concat(F.lit(" "), c, F.lit(" "))
    richer = (old != "") & (old != new) & F.contains(pad(new), pad(old)) & F.col("a_title").rlike(_SEVERAL)
    dressed = reduce(lambda x, w: x | (old == F.concat(new, F.lit(f" {w}"))) | (new == F.concat(old, F.lit(f" {w}"))), PRESENTATION, F.lit(False))
    # a ratio of 0.96 bounds the difference of the lengths, so most pairs never reach Python
    longer, both = F.abs(F.length(old) - F.length(new)), F.length(old) + F.length(new)
    # names of one length that differ match in one letter less at most
    close = (old != "") & (new != "") & (longer <= (1 - LEAST_RATIO) * both) & ((old == new) | (longer > 0) | (both * (1 - LEAST_RATIO) >= 1.999))
    certain = ((eq("bill") & known("bill")) | (eq("name") & known("name")) | richer | (dressed & known("name") & (old != "")))
    # within a venue's day only names that can be near meet: by equal keys, and long ones pair by pair
    keyed = lambda d, keys: d.withColumn("_key", F.explode(keys))
    here, near = eq("venue") & eq("day"), calm & (certain | close)
    edges = [
        a.join(b, eq("ticket") & eq("day") & calm),
        a.join(b, moved & calm),
        a.where(known("bill")).join(b, here & eq("bill") & calm),
        keyed(a, _older(new, F.col("a_title"))).join(b, here & (F.col("_key") == old) & near).drop("_key"),
        a.join(keyed(b, _shorter(old)), here & (F.col("_key") == new) & near).drop("_key"),
        a.where(F.length(new) >= LONG).join(b.where(F.length(old) >= LONG), here & (both >= 2 * ONE_LETTER[1]) & close & calm),
    ]
    pairs = reduce(DataFrame.unionByName, edges).distinct()
    spelled = F.when(close & (old != new), similar(F.when(close & (old != new), old), new) >= LEAST_RATIO).otherwise(old == new)
    pairs = pairs.withColumn("_spelled", at(spelled)).withColumn("_certain", at(certain))
    pairs = pairs.where(at(eq("ticket")) | F.col("_certain") | F.col("_spelled"))
    score = F.when(eq("ticket"), TICKET).when(eq("bill") & known("bill"), BILL).when(eq("name") & known("name"), ARTIST).when(F.col("_spelled"), SPELLING).otherwise(WEAK)
    more = [(eq("venue"), SAME_VENUE), (eq("name") & known("name"), SAME_ARTIST), (eq("time"), SAME_TIME)]
    score = reduce(lambda x, r: x + F.when(r[0], r[1]).otherwise(0), more, score)
    return pairs.select(F.col("a_row").alias(row), F.col("b_row").alias(public_id), score.cast("int").alias("score"))


def match_continuity(listings: DataFrame, published: DataFrame, row: str, public_id: str) -> DataFrame:
    """One-to-one continuity, best score first, ties by (row, public_id)."""
    return joins.greedy_match(continuity(listings, published, row, public_id), row, public_id, "score")


def assign(listings: DataFrame, state: DataFrame, matched: DataFrame, row: str) -> DataFrame:
    """listings(row, base, performance) with key and public_id, each unique.

    state(key, public_id, base, performance) is the last run's; matched(row,
    public_id) comes from match_continuity. A listing asks, in this order, for
    the key it continues, the key with its base and performance, and its base's
    key without performance. The first by (rank, row) gets it; all others take
    a new key from base, performance and row. A route already used gives way to
    one derived from the key. Null performances count as empty.
    """
    perf = F.coalesce("performance", F.lit(""))
    held = state.select(F.col("key").alias("_key"), F.col("public_id").alias("_id"), F.col("base").alias("_base"), perf.alias("_perf"))
    rows = listings.select(row, "base", perf.alias("performance"))
    wishes = [
        rows.join(matched.select(row, F.col("public_id").alias("_id")), row).join(held, "_id").select(row, "_key", "_id", F.lit(0).alias("_rank")),
        rows.join(held, (F.col("base") == F.col("_base")) & (F.col("performance") == F.col("_perf"))).select(row, "_key", "_id", F.lit(1)),
        rows.join(held.where("_perf = ''"), F.col("base") == F.col("_base")).select(row, "_key", "_id", F.lit(2)),
    ]
    asked = reduce(DataFrame.union, wishes).groupBy(row, "_key", "_id").agg(F.min("_rank").alias("_rank"))
    granted = joins.greedy_match(asked.withColumn("_score", -F.col("_rank")), row, "_key", "_score").select(row, "_key")
    ids = held.select("_key", "_id")
    out = rows.join(granted.join(ids, "_key"), row, "left")
    first = F.row_number().over(Window.partitionBy("base").orderBy(F.col("_key").isNotNull().desc(), "performance", row))
    fresh = F.when((F.col("_n") == 1) & F.col("_taken").isNull(), F.col("base")).otherwise(F.sha2(F.concat_ws(chr(31), "base", "performance", F.col(row).cast("string")), 256))
    out = out.withColumn("_n", first).join(held.select(F.col("_key").alias("base"), F.lit(True).alias("_taken")).distinct(), "base", "left")
    out = out.withColumn("key", F.coalesce("_key", fresh))
    # a route goes to its holder first, then to the least key; a route held by any state row is taken
    route = F.coalesce("_id", F.substring("key", 1, 16))
    out = out.withColumn("_route", route).join(held.select(F.col("_id").alias("_route"), F.lit(True).alias("_used")).distinct(), "_route", "left")
    turn = F.row_number().over(Window.partitionBy("_route").orderBy(F.col("_id").isNotNull().desc(), "key"))
    clash = (F.col("_turn") > 1) | (F.col("_id").isNull() & F.col("_used").isNotNull())
    return out.withColumn("_turn", turn).select(row, "key", F.when(clash, F.substring(F.sha2(F.concat("key", F.lit("|route")), 256), 1, 16)).otherwise(F.col("_route")).alias("public_id"))


def require_unique(df: DataFrame, *columns: str) -> DataFrame:
    """`df`, after a check that each column alone is unique: one aggregate each, which shortened routes need."""
    df = cut(df)  # each check and the result read it
    for c in columns:
        if not df.groupBy(c).count().where("count > 1").isEmpty():
            raise ValueError(f"{c} is not unique")
    return df


def quarantine(df: DataFrame, base: str, performance: str) -> tuple[DataFrame, DataFrame]:
    """(kept, set aside): all rows of a base in which two rows share a performance go; none left is an error."""
    bad = df.groupBy(base, performance).count().where("count > 1").select(base).distinct()
    kept = df.join(bad, base, "left_anti")
    if kept.isEmpty() and not df.isEmpty():
        raise ValueError("every identity is ambiguous")
    return kept, df.join(bad, base, "left_semi")


def changes(before: DataFrame, after: DataFrame, key: str) -> DataFrame:
    """(key, change, new_openers) over tables with openers, genre, status: new, gone, and what an event gained.

    change is an array: an event can gain openers, a genre and a status at once. Openers compare by folded name.
    """
    names = lambda c: F.transform(F.coalesce(c, F.array().cast("array<string>")), lambda v: phrase(v, fold_letters))
    j = before.alias("b").join(after.alias("a"), F.col(f"b.{key}") == F.col(f"a.{key}"), "full")
    old, new = F.col(f"b.{key}"), F.col(f"a.{key}")
    gained = F.array_except(names(F.col("a.openers")), names(F.col("b.openers")))
    both = old.isNotNull() & new.isNotNull()
    empty = lambda c: F.coalesce(F.col(c), F.lit("")) == ""
    tests = [(old.isNull(), "new"), (new.isNull(), "gone"), (both & (F.size(gained) > 0), "openers"), (both & empty("b.genre") & ~empty("a.genre"), "genre"), (both & ~F.col("b.status").eqNullSafe(F.col("a.status")), "status")]
    change = F.array_compact(F.array(*(F.when(c, n) for c, n in tests)))
    return j.select(F.coalesce(old, new).alias(key), change.alias("change"), F.when(both, gained).alias("new_openers")).where(F.size("change") > 0)
