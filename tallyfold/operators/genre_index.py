"""The genre index: artists, articles and visibility of every genre with all that lies below it."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..sources.staging import cut
from .graph import closure


def artist_genres(layers: list[tuple[str, DataFrame]], inherited: DataFrame, excluded: DataFrame) -> DataFrame:
    """(artist, genre, direct, sources): what each layer(artist, genre) says, then what is inherited and not said directly.

    excluded(artist, genre) takes a genre away from an artist whoever says it.
    """
    said = reduce(DataFrame.unionByName, [d.select("artist", "genre", F.lit(name).alias("source"), F.lit(True).alias("direct")) for name, d in layers] + [inherited.select("artist", "genre", F.lit("inherited").alias("source"), F.lit(False).alias("direct"))])
    kept = said.where("artist is not null and genre is not null").join(excluded.select("artist", "genre").distinct(), ["artist", "genre"], "left_anti")
    return kept.groupBy("artist", "genre").agg(F.bool_or("direct").alias("direct"), F.array_sort(F.collect_set("source")).alias("sources"))


def genre_index(taxonomy: DataFrame, genres: DataFrame, articles: DataFrame, qualified: DataFrame) -> DataFrame:
    """(genre, parent, direct, inherited, artists, articles, visible) for each genre of taxonomy(genre, parent).

    genres as `artist_genres` gives them; articles(artist, article); qualified
    (artist): who makes a genre visible. direct and inherited count a genre's
    own artists; artists and articles count each once below it, itself
    included; it is visible if it or a genre below has a qualified artist.
    Terms outside the taxonomy count nowhere.
    """
    up = closure(taxonomy.select(F.col("genre").alias("child"), "parent")).select(F.col("child").alias("genre"), F.col("ancestor"))
    # (genre, artist) once, from the artist's own genres upwards: partial aggregates meet before each shuffle
    below = cut(genres.select("artist", "genre").join(up, "genre").select(F.col("ancestor").alias("genre"), "artist").distinct())
    own = genres.groupBy("genre").agg(F.count_if("direct").alias("direct"), F.count_if(~F.col("direct")).alias("inherited"))
    seen = below.join(qualified.select("artist", F.lit(True).alias("_q")).distinct(), "artist", "left")
    total = seen.groupBy("genre").agg(F.count("*").alias("artists"), F.bool_or(F.coalesce("_q", F.lit(False))).alias("visible"))
    written = below.join(articles.select("artist", "article").distinct(), "artist").select("genre", "article").distinct().groupBy("genre").agg(F.count("*").alias("articles"))
    out = taxonomy.select("genre", "parent").join(own, "genre", "left").join(total, "genre", "left").join(written, "genre", "left")
    count = lambda c: F.coalesce(F.col(c), F.lit(0).cast("long")).alias(c)
    return out.select("genre", "parent", count("direct"), count("inherited"), count("artists"), count("articles"), F.coalesce("visible", F.lit(False)).alias("visible"))
