"""Duplicate listings across sources: the ordered merge inside (day, place) blocks.

Equal rows meet first in a native aggregate, so a block holds distinct
(title, time, ticket, source) combinations whatever the volume of copies. The
merge itself is not transitive and depends on an order, so it runs over a
block's combinations, looked up by key, never over pairs. Rows only ever join a
group through a key they share, so a large block falls apart into the connected
parts of its rows and keys, which are merged each for itself with the same
result.
"""

from __future__ import annotations

import functools
import itertools
import re
from collections import Counter, defaultdict
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.keys import canonical_url, fold_latin, fold_promoter, fold_text, normal_time
from ..sources.staging import cut
from .components import components
from .programmes import headlined, reviewed_titles

# Wordings that part or qualify bills.
_PART = re.compile(r"\s+(?:&|x|\+|/|,)\s+|\s*,\s+", re.I)
_QUALIFIER = re.compile(r"\s*\((?:live|[A-Z]{2,3}|(?:19|20)\d\d)\)|\s+(?:19|20)\d\d$|\s+live$", re.I)
_TOUR = re.compile(r"\s*[–—:-]\s+.*\btour\b.*$|\s+\S*\s*tour(?:\s+\d{4})?$", re.I)
_TRIBUTE = re.compile(r"\b(?:tribute|hommage|experience|cover)\b", re.I)
_PASS = re.compile(r"\b(?:pass|package|forfait)\b", re.I)
_SET = re.compile(r"\b(?:1er set|2e set|first set|second set|early show|late show|matin[ée]e)\b", re.I)
_GUESTS = re.compile(r"\s*\+\s*(?:special )?guests?\s*$", re.I)

#: Rows of a block up to which one task takes it whole: looked up by key, they take some 100 microseconds each.
BLOCK_ROWS = 100_000

#: Rows of parts, or titles, for which there is a task: their number, not their few bytes, is what they cost. Whole blocks are dealt by Spark: tasks of many blocks meet more titles again.
TASK_ROWS = 10_000


def names_of(title: str) -> frozenset[str]:
    """Folded acts of a title without qualifiers and unnamed guests."""
    bare = _GUESTS.sub("", _QUALIFIER.sub("", title))
    return frozenset(n for n in (fold_promoter(p) for p in _PART.split(bare)) if n)


@functools.lru_cache(1 << 15)
def _said(title: str) -> dict:
    marks = tuple(sorted(m.lower() for m in _SET.findall(title)))
    acts, short = names_of(title), _TOUR.sub("", title)
    bare = acts if short == title else names_of(short) or acts
    return {"title": title, "strict": fold_text(_QUALIFIER.sub("", title)), "acts": acts, "bare": bare, "kind": (marks, bool(_TRIBUTE.search(title)), bool(_PASS.search(title)))}


def read(x: dict) -> dict:
    """A row {title, ...} with its acts, those of the title without a tour, and the kind of show."""
    return x | _said(x["title"] or "")


def hollow(x: dict) -> bool:
    """Whether a row without acts may yet share a group with rows that have some: then single acts are keys of its kind."""
    return not x["acts"] and bool(x["bare"] or x["ticket"])


def keys(x: dict) -> list[tuple]:
    """What a row can meet others by; rows without a common key never share a group."""
    kind, acts = (x["kind"],), x["acts"]
    out = [("strict", x["strict"], *kind), ("acts", acts, *kind), *(("act", a, *kind) for a in acts)]
    out += [("ticket", x["ticket"], *kind)] if x["ticket"] else []
    out += [("acts", x["bare"], *kind), *(("act", a, *kind) for a in x["bare"])] if x["bare"] != acts else []
    return out


def groups_of(block: list[dict]) -> dict:
    """row -> group (least row) for one block's rows {row, title, time, source, official, ticket}.

    Timed rows settle first; an untimed row joins only when exactly one group
    fits. A group never holds two times, except that the venue's own clock beats
    one outside clock for the same acts. Set markers, tributes and passes part
    groups before anything joins them.
    """
    groups: list[dict] = []
    index: dict[tuple, dict[int, None]] = defaultdict(dict)
    # sets of acts by each act, and by the rarest one: a set lies in another only if this holds the rarest of that
    holding: dict[tuple, dict[int, None]] = defaultdict(dict)
    owned: dict[tuple, dict[int, None]] = defaultdict(dict)

    def fits(x: dict, g: dict) -> bool:
        outside = x["source"] not in g["sources"]
        strict = x["strict"] in g["strict"]
        ticket = bool(x["ticket"]) and x["ticket"] in g["tickets"]
        equal = outside and x["acts"] in g["acts"]
        toured = outside and (x["bare"] in g["acts"] or x["acts"] in g["bares"] ) and not (x["bare"] != x["acts"] and g["toured"])
        part = outside and any(x["acts"] < a or a < x["acts"] for a in g["acts"])
        if not (strict or ticket or equal or toured or part):
            return False
        if not x["time"] or not g["times"] or x["time"] in g["times"]:
            return True
        return (strict or equal) and x["official"] != g["official"] and len(g["times"]) == 1

    rows = [read(x) for x in block]
    often = Counter(a for acts in {x["acts"] for x in rows} for a in acts)
    rarest = lambda acts: min(acts, key=lambda a: (often[a], a))

    void: dict[tuple, dict[int, None]] = defaultdict(dict)  # groups that hold a row without acts: these lie in all others

    def near(x: dict, met_by: list[tuple]) -> set[int]:
        kind, acts = x["kind"], x["acts"]
        single = [index[k] for k in met_by if k[0] == "act" and k in index]
        out = {i for k in met_by if k[0] != "act" for i in index.get(k, ())}
        if not acts:
            return out.union(*single)
        out.update(holding.get((rarest(acts), kind), ()))
        out.update(i for a in acts for i in owned.get((a, kind), ()))
        out.update(i for i in void.get(kind, ()) if any(i in met for met in single))
        return out

    for x in sorted(rows, key=lambda r: (not r["time"], not r["official"], -len(r["acts"]), r["title"], r["time"] or "", r["source"] or "", r["row"])):
        met_by = keys(x)
        fitting = [i for i in sorted(near(x, met_by)) if fits(x, groups[i])]
        exact = [i for i in fitting if x["acts"] in groups[i]["acts"]]
        if x["time"] and len(exact) > 1:
            exact = [i for i in exact if x["time"] in groups[i]["times"]] or exact
        choice = exact if len(exact) == 1 else fitting
        if len(choice) == 1:
            at = choice[0]
        else:  # none fits, or several do: no bridge between them
            at = len(groups)
            groups.append({"rows": [], "sources": set(), "strict": set(), "tickets": set(), "acts": set(), "bares": set(), "times": set(), "official": False, "toured": False})
        g = groups[at]
        g["rows"].append(x["row"])
        g["sources"].add(x["source"])
        g["strict"].add(x["strict"])
        g["acts"].add(x["acts"])
        g["bares"].add(x["bare"])
        g["toured"] |= x["bare"] != x["acts"]
        g["official"] |= bool(x["official"])
        g["tickets"] |= {x["ticket"]} if x["ticket"] else set()
        g["times"] |= {x["time"]} if x["time"] else set()
        for k in met_by:
            index[k][at] = None
        if x["acts"]:
            owned[rarest(x["acts"]), x["kind"]][at] = None
            for a in x["acts"]:
                holding[a, x["kind"]][at] = None
        else:
            void[x["kind"]][at] = None
    return {r: min(g["rows"]) for g in groups for r in g["rows"]}


def _tasks(df: DataFrame, rows: int) -> int:
    return max(df.sparkSession.sparkContext.defaultParallelism, rows // TASK_ROWS + 1)


def placed() -> Column:
    """Whether a row has a day and a place; others merge with nothing."""
    return F.col("day").isNotNull() & F.col("venue_key").isNotNull() & (F.col("venue_key").cast("string") != "")


def _ticket() -> Column:
    return F.coalesce(canonical_url("ticket"), F.nullif(F.trim("ticket"), F.lit("")))


def merge(df: DataFrame, row: str = "row", part: str | None = None) -> DataFrame:
    """df(row, day, venue_key, title, time, source, official, ticket) to (row, group).

    Times are compared as HH:MM, tickets without tracking parameters. Rows
    without a day or a place merge with nothing: each is its own group. Blocks
    fall apart by the column `part` (that of `parted`), if one is named.
    """
    df = df.withColumns({"time": F.coalesce(normal_time(F.col("time")), F.nullif(F.trim("time"), F.lit(""))), "ticket": _ticket()})
    return _merge(df.where(placed()), row, part).unionByName(df.where(~placed()).select(row, F.col(row).alias("group")))


def parted(df: DataFrame) -> DataFrame:
    """df(day, venue_key, title, ticket, ...) with `part`: rows that may share a group have the same.

    Titles that meet by a key are one family, whatever their days and places,
    so each is read once; a part is a family on a day at a place. It may hold
    more than the connected rows (a 64-bit hash names it), which changes no group.
    """
    title = F.coalesce("title", F.lit(""))
    told = cut(df.select(title.alias("title"), "ticket").distinct())
    told = told.repartition(_tasks(told, told.count())).select(F.xxhash64("title").alias("row"), F.lit("").alias("day"), F.lit("").alias("venue_key"), "title", _ticket().alias("ticket"))
    edges = cut(shared_keys(told).where("u <> v").distinct())
    df, family = df.withColumn("_title", F.xxhash64(title)), F.col("_title")
    if not edges.isEmpty():
        met = components(edges)
        df, family = df.join(met.withColumnsRenamed({"node": "_title", "root": "_root"}), "_title", "left"), F.coalesce("_root", "_title")
    return df.withColumn("part", F.xxhash64(F.col("day").cast("string"), F.col("venue_key").cast("string"), family)).drop("_title", "_root")


_SAME = ("day", "venue_key", "title", "time", "source", "official", "ticket")


def _combination() -> list[Column]:
    """Two 64-bit hashes of what makes rows equal, nulls apart from texts."""
    told = [F.coalesce(F.col(c).cast("string"), F.lit("\0")) for c in _SAME]
    return [F.xxhash64(F.lit(k), *told).alias(f"_c{k}") for k in (1, 2)]


def _rows(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
    for b in batches:
        yield from b.to_pylist()


def _merge(df: DataFrame, row: str, part: str | None = None) -> DataFrame:
    kind = df.schema[row].dataType.simpleString()
    slim = df.select(F.col(row).alias("_row"), "day", "venue_key", "title", "time", "source", F.coalesce("official", F.lit(False)).alias("official"), "ticket", (F.col(part).cast("string") if part else F.lit("")).alias("part")).select("*", *_combination())
    once = cut(slim.groupBy("_c1", "_c2", *_SAME, "part").agg(F.min("_row").alias("row")))
    place = ["day", "venue_key", "part"]
    sizes = once.groupBy(*place).count()
    n, most = sizes.agg(F.coalesce(F.sum("count"), F.lit(0)), F.coalesce(F.max("count"), F.lit(0))).head()
    parts = once
    if most > BLOCK_ROWS:
        large = sizes.where(F.col("count") > BLOCK_ROWS).drop("count")
        wide = once.join(large, place, "left_semi")
        met = components(shared_keys(wide)).select(F.col("node").alias("row"), F.col("root").cast("string").alias("_root"))
        parts = once.join(large, place, "left_anti").unionByName(wide.join(met, "row", "left").withColumn("part", F.coalesce("_root", F.col("row").cast("string"))).drop("_root"))

    def run(batches):
        for _, block in itertools.groupby(_rows(batches), lambda x: (x["day"], x["venue_key"], x["part"])):
            out = groups_of(list(block))
            yield pa.RecordBatch.from_arrays([pa.array(list(out), schema), pa.array(list(out.values()), schema)], ["row", "group"])

    schema = pa.string() if kind == "string" else pa.int64() if kind == "bigint" else pa.int32()
    groups = parts.drop("_c1", "_c2").repartition(*([_tasks(df, n)] if part else []), *place).sortWithinPartitions(*place).mapInArrow(run, f"row {kind}, `group` {kind}")
    first = once.select("_c1", "_c2", "row").join(groups, "row").drop("row")
    return slim.select("_row", "_c1", "_c2").join(first, ["_c1", "_c2"]).select(F.col("_row").alias(row), "group")


def shared_keys(rows: DataFrame) -> DataFrame:
    """Edges (u, v) between rows of a block that may share a group.

    A row goes to the least row of its block with an equal key, and one with
    each set of acts to those whose acts hold all of its own: the two meet by
    the rarest of these, so an act that all bills have in common ties nothing.
    """
    kind = rows.schema["row"].dataType.simpleString()

    def run(batches):
        text = lambda k: "\x1f".join(map(str, (k[0], sorted(k[1]) if isinstance(k[1], frozenset) else k[1], k[2])))
        for b in batches:
            told = [read(x) for x in b.select(["title", "ticket"]).to_pylist()]
            exact = [[text(k) for k in keys(x) if k[0] != "act"] for x in told]
            single = [[text(k) for k in keys(x) if k[0] == "act"] for x in told]
            texts = pa.list_(pa.string())
            columns = [b.column("row"), b.column("block"), pa.array([str(x["kind"]) for x in told]), pa.array([sorted(x["acts"]) for x in told], texts), pa.array(map(hollow, told), pa.bool_()), pa.array(exact, texts), pa.array(single, texts)]
            yield pa.RecordBatch.from_arrays(columns, ["row", "block", "kind", "acts", "hollow", "keys", "single"])

    blocks = rows.select("row", F.to_json(F.struct("day", "venue_key")).alias("block"), "title", "ticket")
    told = cut(blocks.mapInArrow(run, f"row {kind}, block string, kind string, acts array<string>, hollow boolean, keys array<string>, single array<string>"))
    loose = told.where("hollow").select("block", "kind").distinct()
    flat = told.select("row", "block", F.explode("keys").alias("key")).union(told.join(loose, ["block", "kind"], "left_semi").select("row", "block", F.explode("single")))
    hubs = flat.groupBy("block", "key").agg(F.min("row").alias("hub"), F.count("*").alias("n")).where("n > 1")
    equal = flat.join(hubs, ["block", "key"]).select(F.col("row").alias("u"), F.col("hub").alias("v"))
    sets = told.groupBy("block", "kind", "acts").agg(F.min("row").alias("row"))
    each = sets.select("*", F.explode("acts").alias("act"))
    often = each.groupBy("block", "kind", "act").agg(F.count("*").alias("n"))
    rare = each.join(often, ["block", "kind", "act"]).groupBy("block", "kind", "acts", "row").agg(F.min_by("act", F.struct("n", "act")).alias("act"))
    wider = each.select("block", "kind", "act", F.col("acts").alias("_acts"), F.col("row").alias("v")).where(F.size("_acts") > 1)
    inside = rare.join(wider, ["block", "kind", "act"]).where((F.size("acts") < F.size("_acts")) & (F.size(F.array_except("acts", "_acts")) == 0))
    return equal.union(inside.select(F.col("row").alias("u"), "v"))


def merged(df: DataFrame, fills: list[str], reviewed: DataFrame | None = None, row: str = "row") -> DataFrame:
    """One row for each engagement among df(row, day, venue_key, title, time, source, official, ticket, first_seen, sold_out, programme, fills).

    (group, day, venue_key, headliner, co_headliners, time, programme, sources,
    first_seen, sold_out, rows, fills). reviewed(day, venue, key, same) names
    folded titles that are one on a day at a place: they become candidates, and
    still part by their times. The merge's groups get their bill and their
    survivor; groups that then share day, place, bill, time and programme are
    one in the end. A bill with unnamed guests yields to any other. Rows
    without a day or a place stay alone.
    """
    told = df.withColumn("_title", F.col("title"))
    if reviewed is not None:
        keyed = told.withColumns({"key": fold_latin(F.col("title")), "venue": F.col("venue_key"), "_own": fold_latin(F.col("title"))})
        told = reviewed_titles(keyed, reviewed).withColumn("title", F.when(F.equal_null("key", "_own"), F.col("title")).otherwise(F.col("key"))).drop("key", "venue", "_own")
    rows = cut(told.join(merge(told, row), row).withColumns({"title": F.col("_title"), "time": F.coalesce(normal_time(F.col("time")), F.nullif(F.trim("time"), F.lit("")))}).drop("_title"))
    placed = F.col("day").isNotNull() & F.col("venue_key").isNotNull() & (F.col("venue_key") != "")
    identity = [F.col("day"), F.col("venue_key"), fold_latin(F.col("headliner")), F.coalesce("time", F.lit("")), F.coalesce("programme", F.lit("")), F.when(~placed, F.col("group"))]
    alike = Window.partitionBy(*identity)
    once = cut(_engagements(rows, fills, row).withColumns({"_final": F.min("group").over(alike), "_n": F.count("*").over(alike)}))
    joint = rows.join(once.where("_n > 1").select("group", "_final"), "group").withColumn("group", F.col("_final")).drop("_final")
    return once.where("_n = 1").drop("_final", "_n").unionByName(_engagements(joint, fills, row))


def _engagements(rows: DataFrame, fills: list[str], row: str) -> DataFrame:
    """Groups of rows folded to one row each, with their bill."""
    rows = rows.repartition("group")  # dealt once for all that follows
    unnamed = F.lower("title").rlike(r"\+ *(special )?guests?$")
    named = rows.withColumn("_n", F.min(unnamed.cast("int")).over(Window.partitionBy("group"))).where(unnamed.cast("int") == F.col("_n"))
    bills = headlined(named, split=r"\s+\+\s+")
    about = rows.groupBy("group").agg(F.min("day").alias("day"), F.min("venue_key").alias("venue_key"), F.count("*").alias("rows"))
    return fold_groups(rows, "group", row, [*fills, "time", "programme"]).join(bills, "group").join(about, "group")


def fold_groups(df: DataFrame, group: str, row: str, fills: list[str]) -> DataFrame:
    """One row per group: sources united, oldest first_seen, sold_out if any, columns `fills` from the venue's own row first.

    Each filled column takes the first value that is not null by (official, richness, least row), so input order is of no account.
    """
    rich = sum((F.col(c).isNotNull().cast("int") for c in fills), F.lit(0))
    order = F.struct(F.coalesce("official", F.lit(False)), rich, -F.col(row))
    best = [F.max_by(c, F.when(F.col(c).isNotNull(), order)).alias(c) for c in fills]
    return df.groupBy(group).agg(F.array_sort(F.collect_set("source")).alias("sources"), F.min("first_seen").alias("first_seen"), F.bool_or("sold_out").alias("sold_out"), *best)


def drop_postponed(df: DataFrame, row: str = "row") -> DataFrame:
    """Rows of (day, venue_key, artist_key) that the venue itself calls postponed go, from every source; others' word alone removes nothing."""
    gone = df.where(F.coalesce("official", F.lit(False)) & (F.col("status") == "postponed")).select("day", "venue_key", "artist_key").distinct()
    return df.join(gone, ["day", "venue_key", "artist_key"], "left_anti")
