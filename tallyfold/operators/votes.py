"""Votes, admissions and preferred rows: what several rows of a key agree on, as aggregates with partial sums."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def consensus(rows: DataFrame, key: str, value: str, unit: Column, least: int) -> DataFrame:
    """(key, value, units) of keys for which exactly one value has `least` different units or more; null values say nothing."""
    g = rows.where(F.col(value).isNotNull()).groupBy(key, value).agg(F.count_distinct(unit).alias("units")).where(F.col("units") >= least)
    return g.groupBy(key).agg(F.count("*").alias("_n"), F.min(value).alias(value), F.max("units").alias("units")).where("_n = 1").drop("_n")


def admitted(rows: DataFrame, key: str, source: str, engagement: Column, sources: int = 2, engagements: int = 2) -> DataFrame:
    """Keys that so many different sources list in so many different engagements."""
    g = rows.groupBy(key).agg(F.count_distinct(source).alias("_s"), F.count_distinct(engagement).alias("_e"))
    return g.where((F.col("_s") >= sources) & (F.col("_e") >= engagements)).select(key)


def verdict(rows: DataFrame, key: str, value: str, provider: str, least: int = 2) -> DataFrame:
    """(key, value, verdict): ambiguous where providers give several values, resolved where `least` of them give one, else review; an ambiguous key has no value."""
    g = rows.where(F.col(value).isNotNull()).groupBy(key).agg(F.count_distinct(value).alias("_v"), F.count_distinct(provider).alias("_p"), F.min(value).alias(value))
    word = F.when(F.col("_v") > 1, "ambiguous").when(F.col("_p") >= least, "resolved").otherwise("review")
    return g.select(key, F.when(F.col("_v") == 1, F.col(value)).alias(value), word.alias("verdict"))


def preferred(rows: DataFrame, key: str, value: str, *order: Column) -> DataFrame:
    """(key, value) of the row that comes last in `order`; the order should end in something unique."""
    return rows.groupBy(key).agg(F.max_by(value, F.struct(*order)).alias(value))


def collapsed(rows: DataFrame, key: str, place: str, sold_out: Column) -> DataFrame:
    """(key, first, sold_out, sessions): the place of a key's first row, whether all its sessions are sold out, and how many there are; unknown counts as not sold out."""
    return rows.groupBy(key).agg(F.min(place).alias("first"), F.bool_and(F.coalesce(sold_out, F.lit(False))).alias("sold_out"), F.count("*").alias("sessions"))


def canonical_list(rows: DataFrame, key: str, name: str, known: DataFrame | None = None) -> DataFrame:
    """(key, names): a key's different names in order, null where there is none; blank names are left out.

    known(name, canonical) gives names their canonical form; others stay.
    """
    bare = F.nullif(F.trim(F.regexp_replace(name, r"\s+", " ")), F.lit(""))
    told = rows.select(key, bare.alias("_n"))
    if known is not None:
        told = told.join(known.select(F.col("name").alias("_n"), "canonical"), "_n", "left").withColumn("_n", F.coalesce("canonical", "_n"))
    return told.groupBy(key).agg(F.array_sort(F.collect_set("_n")).alias("names")).withColumn("names", F.when(F.size("names") > 0, F.col("names")))


def roles(rows: DataFrame, key: str, place: str, co: Column) -> DataFrame:
    """rows with `part`: headliner at a key's first place, then co_headliner where `co` says so, else opener."""
    first = rows.groupBy(key).agg(F.min(place).alias("_first"))
    part = F.when(F.col(place) == F.col("_first"), "headliner").when(co, "co_headliner").otherwise("opener")
    return rows.join(first, key, "left").withColumn("part", part).drop("_first")


def quality(rows: DataFrame, group: str, value: str, person: str) -> DataFrame:
    """(group, n, missing, people, mean): rows, rows without a value, different people, and the mean value to two places."""
    return rows.groupBy(group).agg(F.count("*").alias("n"), F.count_if(F.col(value).isNull()).alias("missing"), F.count_distinct(person).alias("people"), F.round(F.avg(value), 2).alias("mean"))
