"""Approximate nearest neighbours by learned partitions.

A bounded sample gives a neighbour graph; balanced partitioning cuts it with few
edges across; a small classifier learns, for any vector, in which partitions its
neighbours lie. Beyond what one such model can tell apart, every partition gets
a model of its own, fitted in a task on a bounded sample of its rows, so the
number of partitions grows with the rows. Every row is indexed under its most
probable partition. A query goes to its most probable partitions, whose rows are
ranked by the exact inner product in double precision: first to those that hold
half of its probability, then to the others, which answer only what beats the
k-th row found so far. Partitions are dealt over tasks in bounded chunks, so a
hot vector that fills one partition fills no task.
"""

from __future__ import annotations

import pickle

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import arrow_map, materialize, ship
from .minhash import _groups

#: Rows that the model is fitted on, at most (least by a hash of the id), and rows for the model inside a partition.
SAMPLE, INNER_SAMPLE = 6000, 3000
#: Rows a partition should hold, and the bounds of the number of partitions that one model tells apart.
ROWS, FEWEST, MOST = 1500, 8, 64
#: Partitions searched for a query: until they hold this share of its probability, and at least so many.
MASS, PROBES = 0.97, 2
#: Share of a query's probability that is searched before the others get a floor.
FIRST = 0.5
NEIGHBOURS = 20
CHUNK = 20_000


def neighbours(x: np.ndarray, rows: np.ndarray, k: int, same: bool) -> np.ndarray:
    """The k `rows` of largest inner product with each row of x; `same`: x is `rows`, and no row is its own neighbour."""
    out = np.empty((len(x), k), np.int64)
    for a in range(0, len(x), 1000):
        s = x[a : a + 1000] @ rows.T
        if same:
            s[np.arange(len(s)), np.arange(a, a + len(s))] = -np.inf
        out[a : a + 1000] = np.argpartition(-s, k - 1, axis=1)[:, :k]
    return out


def balanced_partition(x: np.ndarray, graph: np.ndarray, parts: int, rounds: int = 12, slack: float = 1.1) -> np.ndarray:
    """Part of each row: halved along principal directions, then rows move to where most of their neighbours are, within capacity."""
    part = np.zeros(len(x), np.int64)
    groups = [np.arange(len(x))]
    while len(groups) < parts:
        groups.sort(key=len)
        g = groups.pop()
        c = x[g] - x[g].mean(0)
        direction = np.linalg.eigh(c.T @ c)[1][:, -1]
        order = g[np.argsort(c @ direction, kind="stable")]
        groups += [order[: len(g) // 2], order[len(g) // 2 :]]
    for i, g in enumerate(groups):
        part[g] = i
    most = int(np.ceil(slack * len(x) / parts))
    k = graph.shape[1]
    source = np.r_[np.repeat(np.arange(len(x)), k), graph.ravel()]
    target = np.r_[graph.ravel(), np.repeat(np.arange(len(x)), k)]
    for _ in range(rounds):
        votes = np.zeros((len(x), parts))
        np.add.at(votes, (source, part[target]), 1)
        want = votes.argmax(1)
        gain = votes[np.arange(len(x)), want] - votes[np.arange(len(x)), part]
        size, moved = np.bincount(part, minlength=parts), 0
        for i in np.argsort(-gain, kind="stable").tolist():
            if gain[i] <= 0:
                break
            if size[want[i]] < most:
                size[part[i]] -= 1
                size[want[i]] += 1
                part[i] = want[i]
                moved += 1
        if not moved:
            break
    return part


class Router:
    """One hidden layer and a softmax over partitions, trained on where sample rows' neighbours lie."""

    def __init__(self, x: np.ndarray, target: np.ndarray, hidden: int = 128, epochs: int = 30, seed: int = 5):
        rng = np.random.default_rng(seed)
        self.scale = 1 / max(1e-9, float(np.sqrt((x**2).mean())))
        n, d, p = len(x), x.shape[1], target.shape[1]
        w = [rng.normal(0, (2 / d) ** 0.5, (d, hidden)), np.zeros(hidden), rng.normal(0, (1 / hidden) ** 0.5, (hidden, p)), np.zeros(p)]
        m, v, t = [np.zeros_like(a) for a in w], [np.zeros_like(a) for a in w], 0
        x = x * self.scale
        for epoch in range(epochs):
            rate = 0.004 * (1 - epoch / epochs) + 1e-4
            order = rng.permutation(n)
            for a in range(0, n, 128):
                i = order[a : a + 128]
                h = np.maximum(x[i] @ w[0] + w[1], 0)
                e = (self._softmax(h @ w[2] + w[3]) - target[i]) / len(i)
                back = (e @ w[2].T) * (h > 0)
                t += 1
                for k, g in enumerate((x[i].T @ back + 1e-5 * w[0], back.sum(0), h.T @ e + 1e-5 * w[2], e.sum(0))):
                    m[k] = 0.9 * m[k] + 0.1 * g
                    v[k] = 0.999 * v[k] + 0.001 * g * g
                    w[k] -= rate * (m[k] / (1 - 0.9**t)) / (np.sqrt(v[k] / (1 - 0.999**t)) + 1e-8)
        self.w = [a.astype(np.float32) for a in w]

    @staticmethod
    def _softmax(z: np.ndarray) -> np.ndarray:
        z = np.exp(z - z.max(1, keepdims=True))
        return z / z.sum(1, keepdims=True)

    def __call__(self, x: np.ndarray) -> np.ndarray:
        h = np.maximum((x * self.scale).astype(np.float32) @ self.w[0] + self.w[1], 0)
        return self._softmax(h @ self.w[2] + self.w[3])


def fit(x: np.ndarray, parts: int, others: np.ndarray | None = None, k: int = 10) -> Router:
    """Router over balanced parts of the rows x, trained on where the neighbours of x (and of `others`) in x lie."""
    x = x.astype(np.float64)
    if len(x) < 2:
        return Router(x if len(x) else np.zeros((1, x.shape[1])), np.ones((max(1, len(x)), 1)))
    graph = neighbours(x, x, min(k, len(x) - 1), True)
    parts = max(1, min(parts, len(x) // 4))
    part = balanced_partition(x, graph, parts)

    def shares(near: np.ndarray) -> np.ndarray:
        t = np.zeros((len(near), parts))
        np.add.at(t, (np.repeat(np.arange(len(near)), near.shape[1]), part[near].ravel()), 1)
        return t

    target = shares(graph)
    # a row's own part counts as one neighbour, so that rows nobody is near still get a place
    target[np.arange(len(x)), part] += 1
    if others is not None and len(others):
        others = others.astype(np.float64)
        target, x = np.r_[target, shares(neighbours(others, x, graph.shape[1], False))], np.r_[x, others]
    return Router(x, target / target.sum(1, keepdims=True))


class Index:
    """A router, and for each of its parts one inside it (none: the part stays whole). Parts are numbered through."""

    def __init__(self, outer: Router, inner: list[Router] | None = None):
        self.outer, self.inner = outer, inner
        self.first = np.cumsum([0, *(r.w[3].shape[0] for r in inner)]) if inner else None
        self.parts = int(self.first[-1]) if inner else outer.w[3].shape[0]

    def probabilities(self, x: np.ndarray) -> np.ndarray:
        p = self.outer(x)
        return np.concatenate([p[:, i : i + 1] * r(x) for i, r in enumerate(self.inner)], 1) if self.inner else p

    def places(self, x: np.ndarray) -> np.ndarray:
        """The part of each row: the most probable one, then the most probable inside it."""
        top = self.outer(x).argmax(1)
        if not self.inner:
            return top.astype(np.int32)
        out = np.zeros(len(x), np.int32)
        for i in np.unique(top):
            own = top == i
            out[own] = self.first[i] + self.inner[i](x[own]).argmax(1)
        return out

    def probes(self, x: np.ndarray, sizes: np.ndarray, k: int) -> list[tuple[np.ndarray, int]]:
        """For each query its parts, most probable first, and how many of them hold FIRST of the probability.

        sizes: rows of each part. Parts go on until they hold k rows besides the query itself, or all rows.
        """
        p = self.probabilities(x)
        order = np.argsort(-p, axis=1, kind="stable").astype(np.int32)
        mass = np.cumsum(np.take_along_axis(p, order, 1), axis=1)
        enough = (np.cumsum(sizes[order], axis=1) <= k).sum(1) + 1
        n = np.minimum(np.maximum(np.maximum((mass < MASS).sum(1) + 1, PROBES), enough), p.shape[1])
        early = np.minimum(np.maximum((mass < FIRST).sum(1) + 1, PROBES), n)
        return [(o[:m], int(e)) for o, m, e in zip(order, n, early, strict=True)]


def best(query: np.ndarray, rows: np.ndarray, query_ids: np.ndarray, ids: np.ndarray, k: int, floor: np.ndarray | None = None) -> list[tuple[np.ndarray, np.ndarray]]:
    """For each query the (ids, scores) of its k best rows, ties to smaller ids; scores summed in one fixed order."""
    out = []
    bound = 1e-9 * np.abs(rows).max(initial=0) * np.abs(query).sum(1)
    for a in range(0, len(query), 256):
        rough = query[a : a + 256] @ rows.T
        if len(ids) > k + 1:
            least = np.partition(rough, len(ids) - k - 1, axis=1)[:, len(ids) - k - 1]  # one more, for the query itself
        else:
            least = np.full(len(rough), -np.inf)
        for i in range(len(rough)):
            near = np.flatnonzero(rough[i] >= least[i] - bound[a + i])
            near = near[ids[near] != query_ids[a + i]]
            score = (rows[near] * query[a + i]).sum(1)
            order = np.lexsort((ids[near], -score))[:k]
            if floor is not None:
                order = order[score[order] >= floor[a + i]]
            out.append((ids[near[order]], score[order]))
    return out


def matrix(column: pa.Array, size: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(-1, size).astype(np.float64, copy=False)


def usable(vectors: DataFrame, queries: str, id_col: str, vector_col: str) -> DataFrame:
    """(id, v, query) of the rows that take part, one for each id."""
    kind = "array<float>" if vectors.schema[vector_col].dataType.simpleString() == "array<float>" else "array<double>"
    v = F.col(vector_col).cast(kind)
    good = F.col(id_col).isNotNull() & v.isNotNull() & F.forall(v, lambda x: x.isNotNull() & (F.abs(x) < float("inf")) & ~F.isnan(x)) & F.exists(v, lambda x: x != 0)
    base = vectors.withColumn("_query", F.expr(queries)).where(good).select(F.col(id_col).cast("long").alias("id"), v.alias("v"), F.coalesce("_query", F.lit(False)).alias("query"))
    return base.groupBy("id").agg(F.min(F.struct("v", "query")).alias("r")).select("id", "r.*")


def train(base: DataFrame, count: int) -> tuple[Index, int]:
    """(index, components of a vector) for a materialized `base` of `count` rows, one at least.

    The outer model sees SAMPLE rows. Only where its MOST parts would hold much
    over ROWS rows, models inside them are fitted, each in a task, on some
    INNER_SAMPLE rows of the part and the outer sample's rows that look there.
    """
    sample = [r["v"] for r in base.orderBy(F.xxhash64("id"), "id").limit(SAMPLE).select("v").collect()]
    lengths = [len(x) for x in sample]
    size = max(sorted(set(lengths)), key=lengths.count)
    near = np.array([x for x in sample if len(x) == size])
    power = lambda n: 2 ** round(np.log2(max(1, n)))
    parts = int(min(MOST, max(FEWEST, power(count / ROWS))))
    outer = fit(near, parts)
    inside = int(min(MOST, power(count / (parts * ROWS))))
    if inside < 2:
        return Index(outer), size
    p = outer(near)
    parts, rows, seen = p.shape[1], INNER_SAMPLE, near.astype(np.float32)
    picked = base.where(F.size("v") == size).where(F.pmod(F.xxhash64(F.lit(2), "id"), F.lit(1 << 20)) < int(min(1.0, parts * rows / count) * (1 << 20)))

    def place(batches):
        index = Index(outer)
        for b in batches:
            if b.num_rows:
                yield pa.RecordBatch.from_arrays([pa.array(index.places(matrix(b.column("v"), size))), b.column("id"), b.column("v")], ["part", "id", "v"])

    def inner(key: tuple, block: pd.DataFrame) -> pd.DataFrame:
        block = block.sort_values("id", kind="stable").iloc[:: max(1, len(block) // rows)]
        looks = np.argsort(-p[:, key[0]], kind="stable")[: len(seen) // 8]
        return pd.DataFrame({"part": [key[0]], "router": [pickle.dumps(fit(np.array(block["v"].tolist()), inside, seen[looks][p[looks, key[0]] > 0.01]))]})

    placed = arrow_map(picked, place, f"part int, id long, v {base.schema['v'].dataType.simpleString()}")
    found = {r["part"]: pickle.loads(r["router"]) for r in placed.groupBy("part").applyInPandas(inner, "part int, router binary").collect()}  # at most MOST models
    whole = fit(np.zeros((0, size)), 1)
    return Index(outer, [found.get(i, whole) for i in range(parts)]), size


def routed(base: DataFrame, index: Index, size: int) -> DataFrame:
    """(id, v, part, query): the part of each row."""

    def route(batches):
        for b in batches:
            if b.num_rows:
                yield pa.RecordBatch.from_arrays([b.column("id"), b.column("v"), pa.array(index.places(matrix(b.column("v"), size))), b.column("query")], ["id", "v", "part", "query"])

    return arrow_map(base.where(F.size("v") == size), route, f"id long, v {base.schema['v'].dataType.simpleString()}, part int, query boolean")


def asked(rows: DataFrame, index: Index, size: int, k: int) -> DataFrame:
    """(id, v, probes, early) of the queries among routed rows: the parts to search and how many of them come first."""
    sizes = np.zeros(index.parts, np.int64)
    for r in rows.groupBy("part").count().collect():  # a row for each part, MOST * MOST at most
        sizes[r["part"]] = r["count"]

    def ask(batches):
        for b in batches:
            if b.num_rows:
                probes = index.probes(matrix(b.column("v"), size), sizes, k)
                yield pa.RecordBatch.from_arrays([b.column("id"), b.column("v"), pa.array([p for p, _ in probes], pa.list_(pa.int32())), pa.array([e for _, e in probes], pa.int32())], ["id", "v", "probes", "early"])

    return arrow_map(rows.where("query").select("id", "v"), ask, f"id long, v {rows.schema['v'].dataType.simpleString()}, probes array<int>, early int")


def search(rows: DataFrame, asked: DataFrame, size: int, k: int) -> DataFrame:
    """(query_id, vec_id, score): the k best of `rows`(id, v, part) for each of `asked`(id, v, part, floor), floors included.

    A part's rows and queries are dealt over chunks of some CHUNK, every chunk
    of rows with every chunk of queries of its part.
    """
    spread = lambda d: d.groupBy("part").agg(F.ceil(F.count("*") / CHUNK).cast("int").alias("chunks"))
    grid = spread(rows).withColumnRenamed("chunks", "rc").join(spread(asked).withColumnRenamed("chunks", "qc"), "part")  # a row for each part that is asked
    mine, theirs = F.pmod(F.xxhash64("id"), F.col("rc")), F.pmod(F.xxhash64("id"), F.col("qc"))
    fan = lambda n: F.explode(F.sequence(F.lit(0), F.col(n) - 1))
    a = rows.join(grid, "part").select("part", mine.cast("int").alias("chunk"), fan("qc").alias("block"), F.lit(False).alias("query"), "id", "v", F.lit(None).cast("double").alias("floor"))
    b = asked.join(grid, "part").select("part", fan("rc").alias("chunk"), theirs.cast("int").alias("block"), F.lit(True).alias("query"), "id", "v", "floor")
    both = a.unionByName(b).select(F.xxhash64("part", "chunk", "block").alias("task"), "query", "id", "v", "floor")

    def run(batches):
        for t in _groups(batches, "task"):
            t = t.combine_chunks()
            query = t.column("query").to_numpy()
            if not query.any() or query.all():
                continue
            ids, v = t.column("id").to_numpy(), matrix(t.column("v").combine_chunks(), size)
            found = best(v[query], v[~query], ids[query], ids[~query], k, t.column("floor").to_numpy()[query])
            n = [len(i) for i, _ in found]
            yield pa.RecordBatch.from_arrays([pa.array(np.repeat(ids[query], n)), pa.array(np.concatenate([i for i, _ in found])), pa.array(np.concatenate([s for _, s in found]))], ["query_id", "vec_id", "score"])

    return arrow_map(both.repartition("task").sortWithinPartitions("task"), run, "query_id long, vec_id long, score double")


def nearest(vectors: DataFrame, queries: str, id_col: str = "vec_id", vector_col: str = "embedding", k: int = NEIGHBOURS) -> DataFrame:
    """(query_id, rank, vec_id, score): the k nearest rows found for the rows that satisfy the SQL condition `queries`.

    Nearness is the inner product; the query's own id is no candidate. Null or
    zero vectors, vectors with null or non-finite components, of another length
    than most of the sample, or without an id take no part. Equal vectors tie
    and go by id; a repeated id counts once (its least vector). Every row is
    indexed; only the fit uses a sample. A query whose probable parts hold fewer
    than k other rows goes on to further ones, so it gets k rows, or all others
    where there are fewer. An empty table gives no rows.
    """
    spark = vectors.sparkSession
    ship(spark)
    base = materialize(usable(vectors, queries, id_col, vector_col))
    count = base.count()
    if not count:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    index, size = train(base, count)
    rows = materialize(routed(base, index, size))
    asks = materialize(asked(rows, index, size, k))
    none = F.lit(float("-inf"))
    first = materialize(search(rows.select("id", "v", "part"), asks.select("id", "v", F.explode(F.slice("probes", F.lit(1), F.col("early"))).alias("part"), none.alias("floor")), size, k))
    w = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    floors = first.withColumn("rank", F.row_number().over(w)).where(F.col("rank") == k).select(F.col("query_id").alias("id"), F.col("score").alias("floor"))
    rest = asks.where(F.size("probes") > F.col("early")).join(floors, "id", "left")
    rest = rest.select("id", "v", F.explode(F.slice("probes", F.col("early") + 1, F.size("probes"))).alias("part"), F.coalesce("floor", none).alias("floor"))
    found = first.union(search(rows.select("id", "v", "part"), rest, size, k))
    return found.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
