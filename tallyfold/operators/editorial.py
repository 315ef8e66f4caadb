"""Articles: whom they are about, the known artist a review names, genres that they agree on, their places."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.keys import contains_words

#: Verbs that follow the subject of a headline (fixed values).
ACTIONS = ("announce", "announces", "release", "releases", "share", "shares", "unveil", "unveils", "return", "returns", "revisit", "revisits", "back", "perform", "performs")
#: What leads to the name in headlines of interviews (fixed values).
TALKS = ("conversation with ", "interview with ", "a conversation with ", "a interview with ")


def name_key(text: Column) -> Column:
    """Artists in articles compare without case; accents count."""
    return F.trim(F.regexp_replace(F.lower(text), r"\s+", " "))


def _before(text: Column, mark: str) -> Column:
    return F.trim(F.get(F.split(text, mark, 2), F.lit(0)))


def _first_word(words: Column, test) -> Column:
    """Place from 1 of the first word after the first that passes test(word, next word); 0 if none does."""
    plain = F.transform(words, lambda w: F.regexp_extract(F.lower(w), r"^[\p{L}\p{N}_]+", 0))
    hits = F.transform(plain, lambda w, i: (i > 0) & test(w, F.coalesce(F.get(plain, i + 1), F.lit(""))))
    return F.array_position(hits, True)


def subject(title: Column, kind: Column) -> Column:
    """Whom a headline is about, by the article's type and then by its verb; null where the wording does not tell."""
    title = F.trim(F.regexp_replace(title, r"\s+", " "))
    low, dash = F.lower(title), " [–-] "
    album = F.regexp_replace(title, "^(?i:album review)(?: ?:| ?[–-]) ?", "")
    talk = F
    for lead in TALKS:
        talk = talk.when(F.startswith(low, F.lit(lead)), _before(F.substr(title, F.lit(len(lead) + 1)), dash))
    words = F.split(title, " ")
    at = lambda p: F.when(p > 0, F.array_join(F.slice(words, F.lit(1), p - 1), " "))
    acts = F.coalesce(at(_first_word(words, lambda w, n: (w == "to") & (n == "celebrate"))), at(_first_word(words, lambda w, n: w.isin(*ACTIONS))))
    found = F.when((kind == "concert_review") & F.contains(title, F.lit(" @ ")), _before(title, " @ ")).when(kind == "album_review", _before(album, dash)).otherwise(F.coalesce(F.when(kind == "interview", talk), acts))
    return F.nullif(found, F.lit(""))


def primary_labels(articles: DataFrame, generic: list[str]) -> DataFrame:
    """(id, label, subject): labels of articles(id, title, type, labels) that can be what the article is about.

    A label must be whole words of the subject where there is one; labels in
    `generic` (lower case) must be the subject. Repeated labels count once.
    """
    a = articles.select("id", subject(F.col("title"), F.col("type")).alias("subject"), F.explode(F.array_distinct(F.array_compact("labels"))).alias("label"))
    label, about = name_key(F.col("label")), name_key(F.col("subject"))
    fits = F.when(label.isin(*generic), F.coalesce(label == about, F.lit(False))).otherwise(F.coalesce(contains_words(about, label), F.lit(True)))
    return a.where(fits & (label != "")).select("id", "label", "subject")


def bare_key(text: Column) -> Column:
    """name_key without a leading article and a trailing "(DJ Set)"."""
    return F.regexp_replace(name_key(F.regexp_replace(text, r"(?i)\s*\(\s*dj\s+set\s*\)\s*$", "")), "^the ", "")


def known_artists(reviews: DataFrame, known: DataFrame, least: int = 5) -> DataFrame:
    """(id, artist): the known artist that reviews(id, name) mean; known(artist) has one row per artist.

    Equal names count first. Then the longest known name counts that is equal
    without "the" and spaces, or that stands in the reviewed one as whole words
    and has `least` letters; ties go to the smaller name. Both sides meet by
    equal keys: a review gives its runs of words, no longer than any known name.
    """
    k = known.select("artist", name_key(F.col("artist")).alias("exact"), bare_key(F.col("artist")).alias("bare")).where("bare <> ''")
    most = k.agg(F.max(F.size(F.split("bare", " ")))).first()[0] or 0
    squeezed = lambda c: F.replace(c, F.lit(" "), F.lit(""))
    keys = lambda *kv: F.array(*[F.struct(F.lit(s).alias("sort"), v.alias("key")) for s, v in kv])
    long = F.when(F.length("bare") >= least, F.col("bare"))
    ours = k.select("artist", F.length("bare").alias("size"), F.explode(keys((0, F.col("exact")), (1, squeezed(F.col("bare"))), (2, long))).alias("k")).select("artist", "size", "k.*")
    r = reviews.select("id", name_key(F.col("name")).alias("exact"), bare_key(F.col("name")).alias("bare")).withColumn("words", F.split("bare", " "))
    runs = F.flatten(F.transform("words", lambda w, i: F.transform(F.sequence(F.lit(1), F.least(F.lit(max(1, most)), F.size("words") - i)), lambda n: F.array_join(F.slice("words", i + 1, n), " "))))
    asked = F.concat(keys((0, F.col("exact")), (1, squeezed(F.col("bare")))), F.transform(F.array_distinct(runs), lambda v: F.struct(F.lit(2).alias("sort"), v.alias("key"))))
    met = r.select("id", F.explode(asked).alias("k")).select("id", "k.*").where("key <> ''").join(ours, ["sort", "key"])
    best = F.min(F.struct(F.when(F.col("sort") == 0, 0).otherwise(1).alias("later"), (-F.col("size")).alias("shorter"), "artist"))
    return met.groupBy("id").agg(best.alias("b")).select("id", "b.artist")


def may_found(name: Column, generic: list[str]) -> Column:
    """Whether a reviewed name may become a new artist: no bill, place or festival, none of the generic labels."""
    n = name_key(name)
    signs = (F.contains(n, F.lit("@")), n.rlike(" - [^,]+,[^,]+$"), n.rlike(r"(?U)\b(?:feat|featuring|hellfest|festival)\b"), n.rlike(r" (?:\+|&|and|et) "))
    return F.coalesce((n != "") & ~n.isin(*generic) & ~reduce(lambda a, b: a | b, signs), F.lit(False))


def editorial_genres(artists: DataFrame, articles: DataFrame, credits: DataFrame, labels: DataFrame, least: int = 2) -> DataFrame:
    """(key, genre, method): genres that reviewed identities or at least `least` articles give an artist.

    artists(slug, name, key, reviewed: array of genres, null where unclear);
    articles(id, title); credits(id, slug); labels(id, genre), already public.
    Keys of several artists give nothing. A reviewed identity decides alone. Of
    articles those count that credit one artist only and name it in the title;
    one with two genres, or two that differ, decide against the artist.
    """
    sole = artists.groupBy("key").agg(F.count("*").alias("n"), F.first(F.struct(*artists.columns)).alias("a")).where("n = 1 and key <> ''").select("a.*")
    same = F.array_distinct("reviewed")
    reviewed = sole.where(F.size("reviewed") > 0).where((F.size(same) == 1) & F.get(same, F.lit(0)).isNotNull()).select("key", F.get(same, F.lit(0)).alias("genre"), F.lit("editorial_reviewed_identity").alias("method"))
    open_ = sole.where(F.coalesce(F.size("reviewed"), F.lit(0)) <= 0).select("slug", "name", "key")
    one = credits.groupBy("id").agg(F.min("slug").alias("slug"), F.max("slug").alias("_last")).where("slug = _last").drop("_last")
    tagged = labels.where("genre is not null").groupBy("id").agg(F.min("genre").alias("low"), F.max("genre").alias("high"))
    about = one.join(articles.select("id", "title"), "id").join(open_, "slug").where(contains_words(F.regexp_replace(F.lower("title"), r"[^\p{L}\p{N}]+", " "), F.regexp_replace(F.lower("name"), r"[^\p{L}\p{N}]+", " ")))
    agreed = about.join(tagged, "id").groupBy("key").agg(F.count("*").alias("n"), F.min("low").alias("genre"), F.max("high").alias("high")).where((F.col("n") >= least) & (F.col("genre") == F.col("high")))
    return reviewed.unionByName(agreed.select("key", "genre", F.lit("editorial_article_consensus").alias("method")))


def editorial_fill(events: DataFrame, genres: DataFrame) -> DataFrame:
    """events(key, genre, method, alone) with the editorial genre of the artist where a concert of one artist has none."""
    g = genres.select("key", F.col("genre").alias("_genre"), F.col("method").alias("_method"))
    open_ = F.col("alone") & F.col("genre").isNull()
    out = events.join(g, "key", "left")
    return out.select(*[F.when(open_, F.col(f"_{c}")).otherwise(F.col(c)).alias(c) if c in ("genre", "method") else F.col(c) for c in events.columns])


def review_places(articles: DataFrame, places: DataFrame, manual: DataFrame | None = None, known: DataFrame | None = None) -> DataFrame:
    """(id, venue, status) of concert reviews titled "artist @ place - date".

    places(key, venue) resolves what stands for the place; manual(title, venue)
    names it for single titles and goes first. Status: associated; outside,
    where known(venue) is given and lacks the venue; unresolved, never guessed.
    Of several venues for a key or a title the least counts.
    """
    place = name_key(F.get(F.split(F.get(F.split("title", " @ ", 2), F.lit(1)), " [–-] |, "), F.lit(0)))
    resolver = places.groupBy("key").agg(F.min("venue").alias("_resolved"))
    r = articles.where("type = 'concert_review'").select("id", "title", place.alias("key")).join(resolver, "key", "left")
    if manual is not None:
        r = r.join(manual.groupBy("title").agg(F.min("venue").alias("_manual")), "title", "left")
    r = r.withColumn("venue", F.coalesce("_manual", "_resolved") if manual is not None else F.col("_resolved"))
    status = F.when(F.col("venue").isNull(), "unresolved")
    if known is not None:
        r = r.join(known.select("venue", F.lit(True).alias("_known")).distinct(), "venue", "left")
        status = status.when(F.col("_known").isNull(), "outside")
    return r.select("id", "venue", status.otherwise("associated").alias("status"))
