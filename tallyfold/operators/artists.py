"""The artist index: names from labels, reviews and aliases, their articles, and one owner for each slug.

Names compare by `fold_content` (case folds, accents count), slugs by letters
and digits only, so different names can ask for one slug: the first by name
owns it, the others are set aside and told. An artist's articles stay rows, so
a name that holds a third of all articles fills no record.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.keys import fold, slug
from ..sources.staging import cut
from .components import components


def _keyed(names: DataFrame, name: str = "name", key: str = "key") -> DataFrame:
    return names.withColumn(key, fold(F.col(name), "content")).where(F.coalesce(F.col(key), F.lit("")) != "")


def identities(labels: DataFrame, reviewed: DataFrame, others: list[DataFrame], aliases: DataFrame, blocked: DataFrame) -> DataFrame:
    """(key, name): the canonical name of every known key.

    labels(article, place, label); reviewed(name), others[i](name), blocked(name)
    and aliases(alias, name). A key's name is the reviewed one, else its most
    frequent label (the earliest of equals), else the first of `others`; of
    several in one list the least. Blocked keys are known by none of these.
    Aliases are closed over chains: an alias carries the name of the known key
    at the end of its chain, which is no alias itself (in a ring: of the best
    key); of several ends the best. An alias without such an end stays what it
    is by itself.
    """
    # counts of whole numbers by place first: no sort of all labels
    placed = labels.where(F.col("label").isNotNull()).groupBy(F.col("label").alias("name"), "place", F.col("article").isNull().alias("_none")).agg(F.count("*").alias("n"), F.min("article").alias("article"))
    seen = placed.groupBy("name").agg(F.sum("n").alias("n"), F.min(F.struct("article", "place")).alias("first"))
    none = F.struct(F.lit(0).cast("long").alias("n"), F.lit(None).cast(seen.schema["first"].dataType).alias("first"))
    layer = lambda d, i, order: d.select("name", F.lit(i).alias("layer"), order.alias("order"))
    told = [layer(reviewed, 0, none), layer(seen, 1, F.struct((-F.col("n")).alias("n"), "first")), *(layer(d, i + 2, none) for i, d in enumerate(others))]
    ranked = _keyed(reduce(DataFrame.unionByName, told)).join(_keyed(blocked.select("name")).select("key").distinct(), "key", "left_anti")
    best = cut(ranked.groupBy("key").agg(F.min(F.struct("layer", "order", "name")).alias("best")))
    edges = cut(_keyed(_keyed(aliases, "alias", "u"), "name", "v").select("u", "v").where("u <> v").distinct())
    tied = components(edges)
    member = tied.join(best.withColumnRenamed("key", "node"), "node", "left").join(edges.select(F.col("u").alias("node"), F.lit(True).alias("alias")).distinct(), "node", "left").withColumn("alias", F.coalesce("alias", F.lit(False)))
    about = member.groupBy("root").agg(F.bool_and("alias").alias("ring"), F.min(F.when(F.col("best").isNotNull(), F.struct("alias", "best"))).alias("m"))
    chosen = about.where("m is not null and (ring or not m.alias)").select("root", F.col("m.best.name").alias("name"))
    told = member.where("alias").join(chosen, "root").select(F.col("node").alias("key"), "name")
    return cut(told.unionByName(best.join(told, "key", "left_anti").select("key", "best.name")))


def article_links(labels: DataFrame, names: DataFrame, more: DataFrame, excluded: DataFrame) -> DataFrame:
    """(article, name, place, direct): the artists of each article, once each, at the first place that names them.

    labels(article, place, label, primary, direct): labels that are not primary
    link nothing. more(article, name): reviewed associations, direct and after
    the labels, past what excluded(article, name) takes away.
    """
    primary = labels.where("primary")
    known = _keyed(primary.select("label").distinct(), "label").join(names, "key").select("label", "name")  # each wording is folded once
    by_label = primary.join(_keyed(known), "label").select("article", "name", "place", "direct", "key")
    gone = _keyed(excluded).select("article", "key").distinct()
    kept = by_label.join(gone, ["article", "key"], "left_anti").drop("key")
    reviewed = more.select("article", "name", F.lit(1 << 30).alias("place"), F.lit(True).alias("direct"))
    return cut(kept.unionByName(reviewed).groupBy("article", "name").agg(F.min("place").alias("place"), F.bool_or(F.coalesce("direct", F.lit(False))).alias("direct")))


def slug_owners(names: DataFrame) -> DataFrame:
    """(name, slug, owner, collides) of names(name) with a slug; the least key owns it."""
    keyed = _keyed(names.select("name").distinct()).withColumn("slug", slug(F.col("name"))).where("slug <> ''")
    first = keyed.groupBy("slug").agg(F.min(F.struct("key", "name")).alias("first"))
    return keyed.join(first, "slug").select("name", "slug", F.col("first.name").alias("owner"), (F.col("name") != F.col("first.name")).alias("collides"))


def artist_index(links: DataFrame, articles: DataFrame, labels: DataFrame, names: DataFrame, aliases: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(records, links with slug, collisions) of artists with an article.

    articles(article, day, type, url, image). Records: slug, name, aliases
    (other spellings among primary labels, and given aliases, by key), articles,
    direct, hero (image, url, day of the newest concert review with an image; of
    one day the least article). Collisions: slug, owner, name.
    """
    owners = cut(slug_owners(links))
    mine = links.join(owners.where("not collides").select("name", "slug"), "name")
    shown = articles.where((F.col("type") == "concert_review") & (F.coalesce("image", F.lit("")) != ""))
    days = mine.join(shown.select("article", "day"), "article").groupBy("name", "day").agg(F.min("article").alias("article"))
    newest = days.groupBy("name").agg(F.max(F.struct("day", (-F.col("article")).alias("back"))).alias("top")).select("name", F.col("top.day").alias("_day"), (-F.col("top.back")).alias("_article"))
    told = shown.join(newest, (F.col("article") == F.col("_article")) & F.equal_null("day", "_day"))
    heroes = told.groupBy("name").agg(F.max(F.struct("image", "url", "day")).alias("hero"))
    spelled = _keyed(labels.where("primary").select("label").distinct(), "label").join(names, "key").where("label <> name").select("name", F.col("label").alias("alias"))
    given = _keyed(aliases).join(names.withColumnRenamed("name", "canonical"), "key").select(F.col("canonical").alias("name"), "alias").where("alias <> name")
    spellings = _keyed(spelled.unionByName(given).distinct(), "alias", "key").groupBy("name").agg(F.transform(F.array_sort(F.collect_set(F.struct("key", "alias"))), lambda x: x["alias"]).alias("aliases"))
    counted = mine.groupBy("slug", "name").agg(F.count("*").alias("articles"), F.count_if("direct").alias("direct"))
    records = counted.join(spellings, "name", "left").join(heroes, "name", "left").withColumn("aliases", F.coalesce("aliases", F.array().cast("array<string>")))
    return records, mine.select("slug", "article", "place", "direct"), owners.where("collides").select("slug", "owner", "name")


def lookup(records: DataFrame) -> DataFrame:
    """(key, slug): every name and alias of the records; a key that several claim goes to the least slug."""
    said = records.select("slug", F.explode(F.array_append("aliases", F.col("name"))).alias("name"))
    return _keyed(said).groupBy("key").agg(F.min("slug").alias("slug"))

