"""Joins: priority lookups, ranges, one-to-one, replays, comparisons."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .components import components


def priority_lookup(df: DataFrame, lookups: list[tuple[DataFrame, str, str]], output: str) -> DataFrame:
    """The first lookup (table, key, value) that knows the key wins; keys are unique in each table.

    Tables are joined as they are: Spark broadcasts those that its size check finds small.
    """
    values = []
    for i, (table, key, value) in enumerate(lookups):
        df = df.join(table.select(F.col(key), F.col(value).alias(f"_v{i}")), key, "left")
        values.append(f"_v{i}")
    return df.withColumn(output, F.coalesce(*values)).drop(*values)


def unique_in_range(points: DataFrame, ranges: DataFrame, keys: list[str], at: str, first: str, last: str, value: str) -> DataFrame:
    """Points with the value of the ranges that hold them, where all of those agree on one; repeated points stay repeated."""
    places = points.select(*keys, at).distinct()
    hit = places.join(ranges, keys).where(F.col(at).between(F.col(first), F.col(last)))
    agreed = hit.groupBy(*keys, at).agg(F.count_distinct(value).alias("_n"), F.min(value).alias(value)).where("_n = 1").drop("_n")
    return points.join(agreed, [*keys, at]).select(*points.columns, value)


def one_to_one(left: DataFrame, right: DataFrame, keys: list[str]) -> DataFrame:
    """Inner join of rows whose key is unique on both sides; others are ambiguous and fall away."""
    alone = lambda d: d.withColumn("_n", F.count("*").over(Window.partitionBy(*keys))).where("_n = 1").drop("_n")
    return alone(left).join(alone(right), keys)


def full_compare(before: DataFrame, after: DataFrame, key: str, differs: Column) -> DataFrame:
    """Full outer join on a unique key; change is new, gone, changed or same (`differs` sees b.* and a.*)."""
    both = before.alias("b").join(after.alias("a"), F.col(f"b.{key}") == F.col(f"a.{key}"), "full")
    change = F.when(F.col(f"b.{key}").isNull(), "new").when(F.col(f"a.{key}").isNull(), "gone").when(differs, "changed").otherwise("same")
    return both.withColumn("change", change)


#: Edges of the largest component that one task matches in a pass.
MOST_EDGES = 5_000_000
#: Rounds over all edges before what is left goes by components.
FIRST_ROUNDS = 3


def greedy_match(edges: DataFrame, left: str, right: str, score: str, rounds: int = 50) -> DataFrame:
    """One-to-one matches, best score first, ties by (left, right): what a sorted greedy loop would take.

    An edge that ranks first at both its ends is taken whatever the others do,
    so a few rounds take most of them. Components of what is left do not bear on
    each other: each is dealt to a task, which passes once over its edges in
    order and holds the taken ends only. A component of over MOST_EDGES edges is matched by rounds over the whole
    cluster instead; one that takes more than `rounds` is an error, never a
    partial result. Edges with a null end match nothing.
    """
    from ..sources.staging import cut

    edges = cut(edges.select(left, right, score).where(F.col(left).isNotNull() & F.col(right).isNotNull()).distinct())
    taken = []
    for _ in range(FIRST_ROUNDS):
        won, edges = _round(edges, left, right, score)
        taken.append(won)
        if edges.isEmpty():
            return reduce(DataFrame.union, taken)
    return reduce(DataFrame.union, [*taken, _by_components(edges, left, right, score, rounds)])


def _by_components(edges: DataFrame, left: str, right: str, score: str, rounds: int) -> DataFrame:
    from ..sources.staging import cut

    ends = [F.xxhash64(F.lit(i), c) for i, c in enumerate((left, right))]  # equal hashes would only join two components
    roots = components(edges.select(ends[0].alias("u"), ends[1].alias("v")))
    placed = edges.withColumn("_u", ends[0]).join(roots.select(F.col("node").alias("_u"), F.col("root").alias("_root")), "_u").drop("_u")
    large = cut(placed.groupBy("_root").agg(F.count("*").alias("_n")).where(F.col("_n") > MOST_EDGES).select("_root"))
    if large.isEmpty():
        return _passes(placed, left, right, score)
    small = placed.join(large, "_root", "left_anti")
    return _passes(small, left, right, score).union(_rounds(cut(placed.join(large, "_root", "left_semi").drop("_root")), left, right, score, rounds))


def _passes(placed: DataFrame, left: str, right: str, score: str) -> DataFrame:
    schema = placed.select(left, right, score).schema

    def run(batches):
        root, taken = None, (set(), set())
        for b in batches:
            keep = []
            for r, x, y in zip(b["_root"].tolist(), b[left].tolist(), b[right].tolist(), strict=True):
                if r != root:
                    root, taken = r, (set(), set())
                free = x not in taken[0] and y not in taken[1]
                keep.append(free)
                if free:
                    taken[0].add(x)
                    taken[1].add(y)
            yield b.loc[keep, [left, right, score]]

    return placed.repartition("_root").sortWithinPartitions("_root", F.desc(score), left, right).mapInPandas(run, schema)


def _round(edges: DataFrame, left: str, right: str, score: str) -> tuple[DataFrame, DataFrame]:
    """(edges taken, edges left): every edge that ranks first at both its ends is taken; hot ends meet in partial minima."""
    from ..sources.staging import cut

    rank = F.struct((-F.col(score)).alias("_s"), F.col(left).alias("_l"), F.col(right).alias("_r"))
    first = [edges.groupBy(c).agg(F.min(rank).alias("_b")).select("_b.*") for c in (left, right)]
    won = first[0].join(first[1], ["_s", "_l", "_r"], "left_semi").select(F.col("_l").alias(left), F.col("_r").alias(right), (-F.col("_s")).cast(edges.schema[score].dataType).alias(score))
    won = cut(won)
    return won, cut(edges.join(won.select(left), left, "left_anti").join(won.select(right), right, "left_anti"))


def _rounds(edges: DataFrame, left: str, right: str, score: str, rounds: int) -> DataFrame:
    taken = []
    for _ in range(rounds):
        won, edges = _round(edges, left, right, score)
        taken.append(won)
        if edges.isEmpty():
            return reduce(DataFrame.union, taken)
    raise RuntimeError("matching did not end")
