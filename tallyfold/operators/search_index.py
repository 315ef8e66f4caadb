"""Search over a stored index: postings of words, beginnings and runs of three letters answer many queries in one join.

Each query asks for its beginning, its rarest word and its rarest run of three
letters; only terms under one of these keys are scored, which loses none that
the score ladder accepts.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..sources.staging import cut

#: Letters of a beginning that has postings of its own.
PREFIX = 3


def _grams(term: Column) -> Column:
    """Keys of a term: its words, its beginnings up to PREFIX letters, its runs of three letters."""
    runs = F.transform(F.sequence(F.lit(1), F.length(term) - 2), lambda i: F.concat(F.lit("t:"), F.substring(term, i, F.lit(3))))
    heads = F.transform(F.sequence(F.lit(1), F.least(F.length(term), F.lit(PREFIX))), lambda i: F.concat(F.lit("p:"), F.substring(term, F.lit(1), i)))
    words = F.transform(F.filter(F.split(term, " "), lambda w: w != ""), lambda w: F.concat(F.lit("w:"), w))
    return F.array_distinct(F.concat(heads, words, F.when(F.length(term) >= 3, runs).otherwise(F.array().cast("array<string>"))))


def write_index(terms: DataFrame, path: str, files: int | None = None) -> None:
    """Write terms(group, id, name, term, alias, role) as entries in order of their terms, and postings of the different terms in order of their keys, with how many each key has.

    Terms are folded; empty and null ones are left out. role is added to the
    score: where in a bill the name stands, 0 elsewhere. A term that many
    entries share has its postings once.
    """
    rows = terms.where(F.coalesce("term", F.lit("")) != "").select("group", "id", "name", "term", F.coalesce("alias", F.lit(False)).alias("alias"), F.coalesce("role", F.lit(0)).alias("role"))
    ordered = lambda d, *by: (d.repartitionByRange(files, *by) if files else d.repartitionByRange(*by)).sortWithinPartitions(*by)
    ordered(rows, "term", "id").write.mode("overwrite").parquet(f"{path}/entries")
    spark = terms.sparkSession
    once = spark.read.parquet(f"{path}/entries").select("term").distinct()
    ordered(once.withColumn("key", F.explode(_grams(F.col("term")))), "key", "term").write.mode("overwrite").parquet(f"{path}/postings")
    spark.read.parquet(f"{path}/postings").groupBy("key").agg(F.count("*").alias("n")).write.mode("overwrite").parquet(f"{path}/keys")


def score(term: Column, query: Column, alias: Column) -> Column:
    """0 exact, 10 exact alias, 20 beginning, 30 alias beginning, 40 all words, 50 inside (queries of three letters or more), else null."""
    held = F.split(term, " ")
    every = F.forall(F.filter(F.split(query, " "), lambda w: w != ""), lambda w: F.array_contains(held, w))
    return F.when(term == query, F.when(alias, 10).otherwise(0)).when(F.startswith(term, query), F.when(alias, 30).otherwise(20)).when(every, 40).when((F.length(query) >= 3) & F.contains(term, query), 50)


def search_many(spark, path: str, queries: DataFrame, per_group: int = 8, bills: DataFrame | None = None) -> DataFrame:
    """(query, group, id, name, score, rank): the best of each group for every query of queries(query), ties by (name, id).

    Queries are folded; empty ones find nothing. bills(artist, id, name, role)
    tells in which concerts a known artist plays: a query that finds the artist
    finds the concert too, and a concert's score is the least of its own terms'
    and its artists', each with the role added.
    """
    asked = queries.select("query").where(F.coalesce("query", F.lit("")) != "").distinct()
    keys, postings, entries = (spark.read.parquet(f"{path}/{part}") for part in ("keys", "postings", "entries"))
    every = asked.select("query", F.explode(_grams(F.col("query"))).alias("key"))
    head = F.concat(F.lit("p:"), F.substring("query", 1, PREFIX))
    kind = F.substring("key", 1, 1)
    rarest = every.join(keys, "key").where((kind != "p") | (F.col("key") == head)).groupBy("query", kind.alias("kind")).agg(F.min_by("key", F.struct("n", "key")).alias("key"))
    met = rarest.join(postings, "key").select("query", "term").distinct()
    said = F.col("term"), F.col("query")
    told = cut(met.withColumns({"own": score(*said, F.lit(False)), "other": score(*said, F.lit(True))}).where("own is not null"))
    found = entries.join(told.select("term").distinct(), "term", "left_semi")
    if bills is not None:
        artists = found.where(F.col("group") == "artists").select(F.col("id").alias("artist"), "term", "alias", F.col("role").alias("_role"))
        played = bills.select("artist", "id", "name", F.coalesce("role", F.lit(0)).alias("role")).join(artists, "artist")
        found = found.unionByName(played.select("term", F.lit("concerts").alias("group"), "id", "name", "alias", (F.col("role") + F.col("_role")).alias("role")))
    hits = told.join(_first(found, per_group), "term").withColumn("score", F.when(F.col("alias"), F.col("other")).otherwise(F.col("own")) + F.col("role"))
    best = hits.groupBy("query", "group", "id").agg(F.min("name").alias("name"), F.min("score").alias("score"))
    rank = F.row_number().over(Window.partitionBy("query", "group").orderBy("score", "name", "id"))
    return best.withColumn("rank", rank).where(F.col("rank") <= per_group)


def _first(found: DataFrame, per_group: int) -> DataFrame:
    """The entries among found(group, id, name, term, alias, role) that can be among the best `per_group` of their group for a query.

    Every query scores all entries of a term alike but for their role, so of
    those with one role only the first by (name, id) can count: each of them
    comes before the others whatever else is found. That holds for ids of one
    name; entries of an id with several names all stay, for its least name
    depends on what a query finds.
    """
    twice = [F.xxhash64(F.lit(k), F.coalesce("name", F.lit("\0"))) for k in (1, 2)]
    several = found.groupBy("group", "id").agg(*[f(c).alias(f"_{f.__name__}{k}") for k, c in enumerate(twice) for f in (F.min, F.max)])
    several = cut(several.where("_min0 <> _max0 or _min1 <> _max1").select("group", "id"))
    place = F.dense_rank().over(Window.partitionBy("group", "term", "alias", "role").orderBy("name", "id"))
    if several.isEmpty():
        return found.withColumn("_n", place).where(F.col("_n") <= per_group).drop("_n").distinct()
    one = found.join(several, ["group", "id"], "left_anti").withColumn("_n", place).where(F.col("_n") <= per_group).drop("_n")
    return one.unionByName(found.join(several, ["group", "id"], "left_semi")).distinct()
