"""Places and evidence between sources: venue names in text, resolved venues, covered listings, series, shared bills."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def word_runs(folded: Column, longest: int) -> Column:
    """Every run of one to `longest` words of single-spaced text: whole-word containment becomes an equi join."""
    words = F.filter(F.split(folded, " "), lambda w: w != "")

    def runs_of(n: int) -> Column:
        starts = F.sequence(F.lit(1), F.greatest(F.size(words) - (n - 1), F.lit(1)))
        return F.transform(starts, lambda i: F.array_join(F.slice(words, i, n), " "))

    runs = F.flatten(F.array(*map(runs_of, range(1, longest + 1))))
    return F.when(F.size(words) > 0, F.array_distinct(runs))


def named_places(df: DataFrame, row: str, folded: str, aliases: DataFrame, longest: int = 6) -> DataFrame:
    """(row, place) of the first place, by aliases.order, whose alias the text has as whole words.

    aliases(alias, place, order) has folded aliases of at most `longest` words; longer ones are an error.
    """
    if not aliases.where(F.size(F.split("alias", " ")) > longest).isEmpty():
        raise ValueError(f"an alias has more than {longest} words")
    runs = df.select(row, F.explode(word_runs(F.col(folded), longest)).alias("alias"))
    return runs.join(aliases.select("alias", "place", "order"), "alias").groupBy(row).agg(F.min_by("place", F.struct("order", "place")).alias("place"))


def resolve_venues(df: DataFrame, row: str, venue: str, city: str, aliases: DataFrame, known: DataFrame) -> DataFrame:
    """(row, key, how): an alias of the whole name, else the known venue the name ends with, else (venue, city).

    aliases(alias, key) and known(key) are folded and unique. Suffixes are joined, longest first; a name without a match keeps itself.
    """
    words = F.filter(F.split(venue, " "), lambda w: w != "")
    base = df.select(row, F.col(venue).alias("alias"), F.col(city).alias("_city"), words.alias("_w"))
    ends = base.where("size(_w) > 1").select(row, F.posexplode(F.transform(F.sequence(F.lit(2), F.size("_w")), lambda i: F.array_join(F.slice("_w", i, F.size("_w")), " "))).alias("_i", "key"))
    suffix = ends.join(known.select("key"), "key").groupBy(row).agg(F.min_by("key", "_i").alias("_suffix"))
    j = base.join(aliases.select("alias", F.col("key").alias("_alias")), "alias", "left").join(suffix, row, "left")
    how = F.when(F.col("_alias").isNotNull(), "alias").when(F.col("_suffix").isNotNull(), "suffix").otherwise("name")
    return j.select(row, F.coalesce("_alias", "_suffix", F.concat_ws("|", "alias", "_city")).alias("key"), how.alias("how"))


def covered_by(df: DataFrame, others: DataFrame, row: str, keys: list[str], time: str) -> DataFrame:
    """df with covered: another source lists the same keys at the same time, or one of the two gives no time.

    Only the distinct times of a key travel, so copies on the other side cost nothing.
    """
    times = others.groupBy(*keys).agg(F.collect_set(F.coalesce(F.col(time), F.lit(""))).alias("_times"))
    hit = F.col("_times").isNotNull() & (F.col(time).isNull() | F.array_contains("_times", F.col(time)) | F.array_contains("_times", F.lit("")))
    return df.join(times, keys, "left").withColumn("covered", F.coalesce(hit, F.lit(False))).drop("_times")


def series(df: DataFrame, source: str, prefix: str, rest: str, least: int = 2) -> DataFrame:
    """Rows whose (source, prefix) introduces `least` or more different titles: evidence that the prefix is a series."""
    good = df.where(F.col(prefix).isNotNull()).groupBy(source, prefix).agg(F.count_distinct(rest).alias("_n")).where(F.col("_n") >= least)
    return df.join(good.select(source, prefix), [source, prefix], "left_semi")


def rosters_elsewhere(bills: DataFrame, rosters: DataFrame, row: str) -> DataFrame:
    """(row, members) of bills(row, day, venue, names, source) that exactly one roster of another source explains.

    rosters(day, venue, members, source): the sorted, folded names must be equal, which makes the search an equi join.
    """
    key = lambda c: F.array_join(F.array_sort(F.transform(F.col(c), lambda v: F.lower(F.trim(v)))), chr(31))
    a = bills.withColumn("_k", key("names")).withColumnRenamed("source", "_own")
    b = rosters.withColumn("_k", key("members")).select("day", "venue", "_k", "members", "source")
    j = a.join(b, ["day", "venue", "_k"]).where(F.col("source") != F.col("_own"))
    return j.groupBy(row).agg(F.count_distinct("members").alias("_n"), F.min("members").alias("members")).where("_n = 1").drop("_n")
