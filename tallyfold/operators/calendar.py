"""What a visitor of the calendar asks for: orders, facets in an address, lists of places and genres."""

from __future__ import annotations

from collections.abc import Iterable
from urllib.parse import parse_qs

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.keys import fold_latin
from ..sources.staging import cut

ORDERS = ("date-asc", "date-desc", "artist-asc", "venue-asc")
MODES = ("tonight", "week", "weekend")


def sort_keys(mode: str) -> list[Column]:
    """Sort columns over day, headliner, venue and a strict last key `id`; names compare without case and accents."""
    artist, venue = fold_latin(F.col("headliner")), fold_latin(F.col("venue"))
    keys = {"date-asc": [F.asc("day"), artist.asc()], "date-desc": [F.desc("day"), artist.asc()], "artist-asc": [artist.asc(), F.asc("day")], "venue-asc": [venue.asc(), F.asc("day"), artist.asc()]}
    if mode not in keys:
        raise ValueError(mode)
    return [*keys[mode], F.asc("id")]


def ordered(df: DataFrame, mode: str) -> DataFrame:
    return df.orderBy(*sort_keys(mode))


def in_locale(column: Column | str, locale: str = "fr", case: bool = True, accents: bool = True) -> Column:
    """The text under a locale's collation, so that sorting, joining and grouping follow it; without case or accents these make no difference."""
    return F.collate(F.col(column) if isinstance(column, str) else column, locale + ("" if case else "_CI") + ("" if accents else "_AI"))


def locale_order(df: DataFrame, mode: str, locale: str = "fr") -> DataFrame:
    """`ordered` with names in the order of a locale: first without case and accents, then with them."""
    loose = lambda c: in_locale(c, locale, False, False)
    names = {"headliner": [loose("headliner"), in_locale("headliner", locale)], "venue": [loose("venue"), in_locale("venue", locale)]}
    keys = {"date-asc": [F.asc("day"), *names["headliner"]], "date-desc": [F.desc("day"), *names["headliner"]], "artist-asc": [*names["headliner"], F.asc("day")], "venue-asc": [*names["venue"], F.asc("day"), *names["headliner"]]}
    if mode not in keys:
        raise ValueError(mode)
    return df.orderBy(*keys[mode], F.asc("id"))


def same_names(df: DataFrame, name: str, locale: str = "fr") -> DataFrame:
    """(name, spellings, rows): names that are one without case and accents, under their first spelling in the locale's order."""
    key, order = in_locale(name, locale, False, False), in_locale(name, locale)
    g = df.where(F.col(name).isNotNull()).groupBy(key.alias("_k"))
    return g.agg(F.min_by(name, F.struct(order.alias("o"), F.col(name))).alias(name), F.count_distinct(name).alias("spellings"), F.count("*").alias("rows")).drop("_k")


def facets(query: str, venues: Iterable[str], genres: Iterable[str], months: Iterable[str]) -> dict:
    """The facets of an address's query; unknown values are dropped, a quick range beats a month."""
    asked = parse_qs(query.lstrip("?"))
    first = lambda k, known: next((v for v in asked.get(k, ()) if v in known), None)
    known = set(genres) | {"Unsorted"}
    out = {"q": " ".join((asked.get("q") or [""])[0].split()), "venue": first("venue", set(venues)), "genres": [g for v in asked.get("genre", ()) for g in v.split(",") if g in known], "quick": first("when", MODES), "month": first("month", set(months)), "sort": first("sort", ORDERS) or ORDERS[0], "new": first("new", ("1",)) == "1"}
    return out | {"month": None} if out["quick"] else out


def listed(df: DataFrame, text: str, columns: list[str]) -> DataFrame:
    """Rows whose columns, read one after the other without case and accents, hold the text; an empty one keeps all."""
    whole = fold_latin(F.concat_ws(" ", *columns))
    return df.where(F.contains(whole, fold_latin(F.lit(text)))) if text.strip() else df


def concert_order() -> list[Column]:
    """Concerts of a newsletter: day, artist, venue without case, id."""
    return [F.asc("day"), F.lower("headliner").asc(), F.lower("venue").asc(), F.asc("id")]


def venue_order() -> list[Column]:
    """Events of one venue: day, time (none first), artist without case, id."""
    return [F.asc("day"), F.coalesce("start_time", F.lit("")).asc(), F.lower("headliner").asc(), F.asc("id")]


def placed(df: DataFrame, group: str, order: list[Column], name: str) -> DataFrame:
    """df with `name`: each row's place from 1 among those of its group, by a strict order.

    Rows are dealt by ranges of (group, order) and counted range by range, so a
    group of any size is spread over many tasks.
    """
    dealt = cut(df.repartitionByRange(F.col(group), *order).withColumn("_range", F.spark_partition_id()))
    before = Window.partitionBy(group).orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    counts = dealt.groupBy(group, "_range").agg(F.count("*").alias("_n")).select(F.col(group).alias("_group"), F.col("_range").alias("_at"), F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before"))
    here = F.row_number().over(Window.partitionBy(group, "_range").orderBy(*order))
    out = dealt.withColumn("_here", here).join(F.broadcast(counts), F.equal_null(group, "_group") & (F.col("_range") == F.col("_at")))
    return out.select(*df.columns, (F.col("_before") + F.col("_here")).alias(name))


def canonical_order(row: Column) -> list[Column]:
    """Order of a stored snapshot that does not depend on how it was made: its names, then the whole row as JSON."""
    blank = lambda c: F.coalesce(c, F.lit("")).asc()
    return [F.asc("day"), F.asc("headliner"), F.asc("venue"), blank("start_time"), blank("public_id"), F.to_json(row).asc()]


def in_genres(df: DataFrame, genre: str, asked: list[str], tree: DataFrame) -> DataFrame:
    """Rows whose genre is one of those asked for or lies below one; tree(genre, ancestor) is a closure."""
    below = tree.where(F.col("ancestor").isin(*asked)).select(F.col("genre").alias(genre))
    own = df.sparkSession.createDataFrame([(g,) for g in asked], f"{genre} string")
    return df.join(below.union(own).distinct(), genre, "left_semi")
