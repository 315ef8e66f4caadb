"""Enrichment: raw labels to public genres, votes, provider ladders, inheritance, links and ranked search.

Registries come as DataFrames and are joined as they are; Spark broadcasts the
ones its own size check finds small.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.keys import contains_words, fold_latin


def raw_genres(df: DataFrame, row: str, raw: str, exact: DataFrame, compounds: DataFrame, tokens: dict[str, list[str]], jazz: str = "Jazz / Blues") -> DataFrame:
    """(row, genres, method) of raw source labels.

    exact(term, genre) and compounds(term, genres) have folded, unique terms.
    In this order: a reviewed compound; a comma list of exact terms only (all of
    them); an exact term; the word jazz without / or comma; a token rule, if the
    tokens found belong to one genre. Others, and null labels, get no row.
    """
    term = fold_latin(F.col(raw))
    base = df.select(row, term.alias("term")).where("term is not null")
    parts = base.select(row, F.posexplode(F.split("term", r"\s*,\s*")).alias("_i", "term"))
    listed = parts.join(exact.select("term", "genre"), "term", "left").groupBy(row).agg(F.count("*").alias("_n"), F.count("genre").alias("_known"), F.array_sort(F.collect_set("genre")).alias("_listed"))
    j = base.join(compounds.select("term", F.col("genres").alias("_compound")), "term", "left").join(listed, row)
    found = F.array_compact(F.array(*(F.when(F.col("term").rlike(r"(?<!\w)(?:" + "|".join(rf"\Q{t}\E" for t in words) + r")(?!\w)"), F.lit(g)) for g, words in tokens.items()))) if tokens else F.array().cast("array<string>")
    rungs = [
        ("compound", F.col("_compound").isNotNull(), F.col("_compound")),
        ("exact", F.col("_n") == F.col("_known"), F.col("_listed")),
        ("jazz", F.col("term").rlike(r"\bjazz\b") & ~F.col("term").rlike("[/,]"), F.array(F.lit(jazz))),
        ("token", F.size(found) == 1, found),
    ]
    out = reduce(lambda c, r: c.when(r[1], F.struct(F.lit(r[0]).alias("method"), r[2].alias("genres"))), rungs, F)
    return j.select(row, out.alias("_o")).where("_o is not null").select(row, "_o.genres", "_o.method")


def agreed_context(df: DataFrame, row: str, text: str, rules: dict[str, list[str]], acts: DataFrame, known: DataFrame) -> DataFrame:
    """(row, genre) where exactly one rule's words occur in the text, and no billed act with a known genre disagrees.

    acts(row, artist) is the exploded bill, known(artist, genre) the map; a text or bill without evidence gives no row.
    """
    folded = fold_latin(F.col(text))
    hits = F.array_compact(F.array(*(F.when(reduce(lambda x, w: x | contains_words(folded, F.lit(w)), words, F.lit(False)), F.lit(g)) for g, words in rules.items())))
    one = df.select(row, hits.alias("_h")).where("size(_h) = 1").select(row, F.col("_h")[0].alias("genre"))
    against = acts.join(known.select("artist", F.col("genre").alias("_act")), "artist").join(one, row).where("_act <> genre").select(row).distinct()
    return one.join(against, row, "left_anti")


def votes(df: DataFrame, key: str, value: str, weight: Column, least: int) -> DataFrame:
    """(key, value, votes) of the best value by summed weight where it reaches `least` and leads alone."""
    sums = df.groupBy(key, value).agg(F.sum(weight).alias("votes"))
    w = Window.partitionBy(key)
    lead = sums.withColumn("_top", F.max("votes").over(w)).where("votes = _top").withColumn("_n", F.count("*").over(w))
    return lead.where((F.col("_n") == 1) & (F.col("votes") >= least)).select(key, value, "votes")


def ranked_tags(df: DataFrame, key: str, tag: str, count: str, canonical: DataFrame) -> DataFrame:
    """(key, genres): canonical(tag, genre) genres of tags by summed count, largest first, ties by name; counts are at least one."""
    sums = df.join(canonical.select(tag, "genre"), tag).groupBy(key, "genre").agg(F.sum(F.greatest(F.coalesce(F.col(count), F.lit(0)), F.lit(1))).alias("_s"))
    order = F.array_sort(F.collect_list(F.struct((-F.col("_s")).alias("s"), F.lower("genre").alias("l"), "genre")))
    return sums.groupBy(key).agg(F.transform(order, lambda x: x["genre"]).alias("genres"))


def first_layer(layers: list[tuple[str, DataFrame]], key: str, value: str) -> DataFrame:
    """(key, value, layer): each key's value from the first layer that has it; one aggregate for any number of layers."""
    tagged = [d.where(F.col(value).isNotNull()).select(key, value, F.lit(i).alias("_i"), F.lit(name).alias("layer")) for i, (name, d) in enumerate(layers)]
    rows = reduce(DataFrame.unionByName, tagged)
    return rows.groupBy(key).agg(F.min(F.struct("_i", value, "layer")).alias("_m")).select(key, f"_m.{value}", "_m.layer")


def inherited(edges: DataFrame, genres: DataFrame, kind: str = "member of band") -> DataFrame:
    """(artist, genres) of artists without genres: those of their `kind` relations, one hop, by (most votes, name)."""
    near = edges.where(F.col("kind") == kind).select("artist", F.col("other").alias("_o")).distinct()
    got = near.join(genres.select(F.col("artist").alias("_o"), "genre"), "_o").join(genres.select("artist"), "artist", "left_anti")
    counted = got.groupBy("artist", "genre").agg(F.count("*").alias("_n"))
    return counted.groupBy("artist").agg(F.transform(F.array_sort(F.collect_list(F.struct((-F.col("_n")).alias("n"), "genre"))), lambda x: x["genre"]).alias("genres"))


def pending(wanted: DataFrame, cache: DataFrame, key: str) -> DataFrame:
    """Keys that the lookup cache does not hold yet; tasks never call out themselves."""
    return wanted.select(key).where(F.col(key).isNotNull()).distinct().join(cache.select(key), key, "left_anti")


def single_match(results: DataFrame, key: str, least: int = 90) -> DataFrame:
    """Lookup results with a score of `least` or more, where the key has exactly one."""
    # an aggregate, so a key with very many results holds one row in memory
    good = results.where(F.col("score") >= least).groupBy(key).agg(F.count("*").alias("_n"), F.first(F.struct(*results.columns)).alias("_r"))
    return good.where("_n = 1").select("_r.*")


def bill_links(bills: DataFrame, artists: DataFrame) -> DataFrame:
    """(event, slug, name, role): billed names that equal a known artist, once per slug, at their first place.

    bills(event, names: array) lists headliner, co-headliners, openers in order; artists(key, slug) has unique keys.
    """
    acts = bills.select("event", F.posexplode("names").alias("role", "name")).withColumn("key", fold_latin(F.col("name")))
    return acts.join(artists.select("key", "slug"), "key").repartition("event").groupBy("event", "slug").agg(F.min_by("name", "role").alias("name"), F.min("role").alias("role"))


def artist_page(events: DataFrame, links: DataFrame, slug: str, key: str) -> DataFrame:
    """Events linked to the slug, or billing the name: a semi join on the union of both."""
    named = events.select("event", F.explode("names").alias("n")).where(fold_latin(F.col("n")) == key).select("event")
    return events.join(links.where(F.col("slug") == slug).select("event").union(named).distinct(), "event", "left_semi")


def coverage(events: DataFrame, links: DataFrame, articles: DataFrame) -> DataFrame:
    """(event, url, type, day, artists): articles on an event's linked artists, once per address, names collected.

    Events with the same artists (by two 64-bit hashes of these) share what is found for one.
    """
    bills = links.groupBy("event").agg(F.array_sort(F.collect_set(F.struct("slug", "name"))).alias("bill")).join(events.select("event"), "event", "left_semi")
    bills = bills.withColumns({f"_b{k}": F.xxhash64(F.lit(k), "bill") for k in (1, 2)})
    once = bills.groupBy("_b1", "_b2").agg(F.first("bill").alias("bill")).select("_b1", "_b2", F.explode("bill").alias("act")).select("_b1", "_b2", "act.*")
    told = articles.groupBy("slug", "url").agg(F.min("type").alias("type"), F.max("day").alias("day"))
    found = once.join(told, "slug").groupBy("_b1", "_b2", "url").agg(F.min("type").alias("type"), F.max("day").alias("day"), F.array_sort(F.collect_set("name")).alias("artists"))
    return bills.select("event", "_b1", "_b2").join(found, ["_b1", "_b2"]).drop("_b1", "_b2")


def search(terms: DataFrame, query: str, per_group: int = 8) -> DataFrame:
    """(group, id, name, score, rank): the best of each group for a query, lower scores first, ties by (name, id).

    terms(group, id, name, term, alias) has folded terms: 0 exact, 10 exact alias,
    20 prefix, 30 alias prefix, 40 all words, 50 substring (three letters or more).
    """
    q, t = F.lit(query), F.col("term")
    words = reduce(lambda x, w: x & contains_words(t, F.lit(w)), query.split(), F.lit(bool(query.split())))
    score = F.when(t == q, F.when(F.col("alias"), 10).otherwise(0)).when(F.startswith(t, q), F.when(F.col("alias"), 30).otherwise(20)).when(words, 40)
    score = score.when(F.contains(t, q), 50) if len(query) >= 3 else score
    best = terms.withColumn("score", score).where("score is not null").groupBy("group", "id").agg(F.min("name").alias("name"), F.min("score").alias("score"))
    rank = F.row_number().over(Window.partitionBy("group").orderBy("score", "name", "id"))
    return best.withColumn("rank", rank).where(F.col("rank") <= per_group)
