"""Hierarchies and bounded traversals; every round is written once and read by the next."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..sources.staging import cut


def closure(edges: DataFrame, deepest: int = 16) -> DataFrame:
    """(child, ancestor, depth) of edges(child, parent), depth 0 included; a cycle is an error."""
    edges = cut(edges.select("child", "parent"))
    nodes = edges.select("child").union(edges.select(F.col("parent").alias("child"))).where("child is not null").distinct()
    levels = [cut(nodes.select("child", F.col("child").alias("ancestor"), F.lit(0).alias("depth")))]
    up = edges.where("parent is not null").select(F.col("child").alias("ancestor"), "parent")
    for depth in range(1, deepest + 1):
        step = cut(levels[-1].join(up, "ancestor").select("child", F.col("parent").alias("ancestor"), F.lit(depth).alias("depth")))
        found = step.agg(F.count("*").alias("n"), F.count_if(F.col("child") == F.col("ancestor")).alias("back")).first()
        if not found["n"]:
            return reduce(DataFrame.union, levels)
        if found["back"]:
            raise ValueError("the hierarchy has a cycle")
        levels.append(step)
    raise ValueError("the hierarchy is too deep or has a cycle")


def first_covered(starts: DataFrame, edges: DataFrame, covered: DataFrame, deepest: int) -> DataFrame:
    """(source, target, depth): covered nodes reached from uncovered sources through uncovered nodes only."""
    return covered_paths(starts, edges, covered, deepest).select("source", "target", "depth")


def covered_paths(starts: DataFrame, edges: DataFrame, covered: DataFrame, deepest: int, allowed: DataFrame | None = None) -> DataFrame:
    """(source, target, depth, path): the first covered nodes on every way from an uncovered source, with the way there.

    starts(node), edges(u, v), covered(node). A node is reached once a source,
    at its least depth and there by its least path (compared node by node from
    the source); covered nodes end a way. allowed(source, target) restricts the
    sources that it names: they only count the targets it lists, and go through
    all others as if these were uncovered.
    """
    known = covered.select(F.col("node").alias("target")).distinct().withColumn("_stop", F.lit(True))
    edges = edges.select(F.col("u").alias("target"), "v")  # repeated edges meet in the partial minima of the ways
    first = starts.select(F.col("node").alias("source"), F.col("node").alias("target")).distinct().join(known, "target", "left_anti")
    step = cut(first.select("source", "target", F.array("source").alias("path")))
    seen, found = [step.select("source", "target")], []
    if allowed is not None:
        allowed = allowed.select("source", "target").distinct()
        bound = allowed.select("source").distinct().withColumn("_bound", F.lit(True))
    for depth in range(1, deepest + 1):
        # ways of one source, length and end compare by what lies between: only that is shuffled
        near = step.join(edges, "target").select("source", F.col("v").alias("target"), F.slice("path", 2, depth).alias("between")).groupBy("source", "target").agg(F.min("between").alias("between"))
        near = near.join(reduce(DataFrame.union, seen), ["source", "target"], "left_anti").join(known, "target", "left").withColumn("_stop", F.coalesce("_stop", F.lit(False)))
        if allowed is not None:
            near = near.join(bound, "source", "left").join(allowed.withColumn("_may", F.lit(True)), ["source", "target"], "left")
            near = near.withColumn("_stop", F.col("_stop") & (F.col("_bound").isNull() | F.col("_may").isNotNull())).drop("_bound", "_may")
        near = cut(near.select("source", "target", F.concat(F.array("source"), "between", F.array("target")).alias("path"), "_stop"))
        seen.append(near.select("source", "target"))
        found.append(near.where("_stop").select("source", "target", F.lit(depth).alias("depth"), "path"))
        step = near.where("not _stop").select("source", "target", "path")
    if not found:
        return step.select("source", "target", F.lit(0).alias("depth"), "path").where("false")
    return reduce(DataFrame.union, found)


def named_paths(paths: DataFrame, names: DataFrame) -> DataFrame:
    """paths with `names`: what names(node, name) calls the nodes of the path, in order; nodes without a name are left out."""
    each = paths.select("source", "target", F.posexplode("path").alias("place", "node")).join(names.select("node", "name"), "node")
    told = each.groupBy("source", "target").agg(F.transform(F.array_sort(F.collect_list(F.struct("place", "name"))), lambda x: x["name"]).alias("names"))
    return paths.join(told, ["source", "target"], "left").withColumn("names", F.coalesce("names", F.array().cast("array<string>")))
