"""Centroid clustering in whole numbers, with partial-distance search.

Vectors become integers, so sums, means and distances are exact and do not
depend on how rows are dealt to tasks. Squared differences are added up over the
dimensions of the highest variance first; a centroid is given up as soon as
what has come together lies strictly above the best distance so far, and only
the survivors go through all dimensions.

Each round is one pass: tasks send a count, a sum for each dimension and the
inertia of each centroid, added up by Spark, so the driver gets k rows whatever
the table holds.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import arrow_map, materialize

DIMENSIONS, CLUSTERS, ROUNDS, SCALE, SEED = 64, 8, 10, 1024, 3
#: Dimensions that are added between two looks at the best distance.
STEP = 8
#: Largest magnitude of a component in whole units: squared distances over some 500 dimensions then fit 64 bits.
LARGEST = 1 << 26


def whole_vectors(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", dimensions: int = DIMENSIONS, scale: int = SCALE) -> DataFrame:
    """(vec_id, v array<long>): floor(scale * component) of the vectors that have all components, each a number."""
    v = F.col("v")
    rows = vectors.select(F.col(id_col).cast("long").alias("vec_id"), F.col(vector_col).cast("array<double>").alias("v"))
    finite = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf")))
    fits = lambda x: F.when(F.abs(x) * scale <= LARGEST, F.floor(x * scale)).otherwise(F.raise_error(F.concat(F.lit(f"a component lies beyond {LARGEST // scale}: "), x.cast("string"))).cast("long"))
    return rows.where(v.isNotNull() & (F.size(v) == dimensions)).where(finite).select("vec_id", F.transform("v", fits).alias("v"))


def nearest_centroid(v: np.ndarray, centroids: np.ndarray, order: np.ndarray, step: int = STEP) -> tuple[np.ndarray, np.ndarray]:
    """(number, squared distance) of the nearest centroid of each row; of equal ones the smaller number."""
    v, centroids = np.ascontiguousarray(v[:, order]), centroids[:, order]
    best, at = np.full(len(v), np.iinfo(np.int64).max), np.zeros(len(v), np.int64)
    for j, c in enumerate(centroids):
        alive, sums = np.arange(len(v)), np.zeros(len(v), np.int64)
        for k in range(0, v.shape[1], step):
            part = v[alive, k : k + step] - c[k : k + step]
            sums += np.einsum("ij,ij->i", part, part)
            if j:
                stay = sums <= best[alive]
                if not stay.all():
                    alive, sums = alive[stay], sums[stay]
        nearer = sums < best[alive]
        best[alive[nearer]], at[alive[nearer]] = sums[nearer], j
    return at, best


def _matrix(batch: pa.RecordBatch, dimensions: int) -> np.ndarray:
    return batch.column("v").flatten().to_numpy(zero_copy_only=False).astype(np.int64).reshape(-1, dimensions)


def _tally(rows: DataFrame, centroids: np.ndarray, order: np.ndarray) -> list:
    """For each centroid that is the nearest of any row: (cluster, count, inertia, a sum for each dimension)."""
    k, dims = centroids.shape
    names = [f"s{i}" for i in range(dims)]

    def run(batches):
        got = np.zeros((k, dims + 2), np.int64)
        for b in batches:
            v = _matrix(b, dims)
            at, dist = nearest_centroid(v, centroids, order)
            for j in np.unique(at):
                mine = at == j
                got[j, 0] += mine.sum()
                got[j, 1] += dist[mine].sum()
                got[j, 2:] += v[mine].sum(axis=0)
        some = np.flatnonzero(got[:, 0])
        yield pa.RecordBatch.from_arrays([pa.array(some.astype(np.int32)), *[pa.array(c) for c in got[some].T]], ["cluster", "n", "inertia", *names])

    parts = arrow_map(rows.select("v"), run, ", ".join(["cluster int", *[f"{c} long" for c in ("n", "inertia", *names)]]))
    exact = lambda c: F.sum(F.col(c).cast("decimal(20,0)")).alias(c)  # noqa: E731  beyond 64 bits where many rows meet
    return parts.groupBy("cluster").agg(*[exact(c) for c in ("n", "inertia", *names)]).collect()


def _start(rows: DataFrame, k: int, seed: int) -> np.ndarray:
    """The k vectors with the smallest hash of seed and id; rows without id come last, of equal ids the smaller vector first."""
    named = rows.withColumn("h", F.sha2(F.concat(F.lit(f"{seed}:"), F.col("vec_id").cast("string")), 256))
    return np.array([r["v"] for r in named.orderBy(F.col("h").asc_nulls_last(), "v").limit(k).select("v").collect()], np.int64)


def cluster(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", k: int = CLUSTERS, rounds: int = ROUNDS, dimensions: int = DIMENSIONS, scale: int = SCALE, seed: int = SEED) -> DataFrame:
    """(vec_id, cluster, distance, cluster_inertia, inertia, centroid_sha256) of every vector kept.

    Null vectors, other lengths, and null or non-finite components take no
    part; fewer vectors than k give as many centroids; no vector gives an empty
    result. Every row counts by itself, also with a repeated or null id, and
    equal rows may be two equal centroids, of which the second stays empty and
    as it is. Components beyond 65,536 (distances would leave 64 bits) are an
    error. Extra columns are ignored whatever their names.
    """
    rows = materialize(whole_vectors(vectors, id_col, vector_col, dimensions, scale))
    out = "vec_id long, cluster int, distance long, cluster_inertia long, inertia long, centroid_sha256 string"
    centroids = _start(rows, k, seed)
    if not len(centroids):
        return rows.sparkSession.createDataFrame([], out)
    spread = rows.agg(*[F.var_pop(F.col("v")[i]).alias(f"s{i}") for i in range(dimensions)]).first()
    order = np.argsort([-x for x in spread], kind="stable")
    for _ in range(rounds):
        for r in _tally(rows, centroids, order):
            centroids[r["cluster"]] = [int(r[f"s{i}"]) // int(r["n"]) for i in range(dimensions)]
    inertia = {r["cluster"]: int(r["inertia"]) for r in _tally(rows, centroids, order)}
    own, total = np.array([inertia.get(j, 0) for j in range(len(centroids))], np.int64), sum(inertia.values())
    digests = np.array([hashlib.sha256(",".join(map(str, c.tolist())).encode()).hexdigest() for c in centroids], object)

    def run(batches):
        for b in batches:
            at, dist = nearest_centroid(_matrix(b, dimensions), centroids, order)
            yield pa.RecordBatch.from_arrays([b.column("vec_id"), pa.array(at.astype(np.int32)), pa.array(dist), pa.array(own[at]), pa.array(np.full(len(at), total)), pa.array(digests[at], pa.string())], ["vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256"])

    return arrow_map(rows, run, out)


def cluster_sql(k: int = CLUSTERS, rounds: int = ROUNDS, dimensions: int = DIMENSIONS, scale: int = SCALE, seed: int = SEED) -> str:
    """The same for DuckDB, every distance in full, one pair of common tables a round."""
    steps = []
    for r in range(rounds + 1):
        steps.append(f"""
a{r} AS MATERIALIZED (SELECT id, arg_min(j, d * {k} + j) AS j, min(d) AS d FROM
  (SELECT v.id, c.j, list_sum(list_transform(list_zip(v.v, c.c), lambda p: (p[1] - p[2]) * (p[1] - p[2])))::BIGINT AS d FROM vs v CROSS JOIN c{r} c) GROUP BY id)""")
        if r < rounds:
            steps.append(f"""
m{r} AS (SELECT j, list((s - ((s % n) + n) % n) // n ORDER BY i) AS c FROM
  (SELECT a.j, g.i, sum(v.v[g.i])::BIGINT AS s, count(*) AS n FROM a{r} a JOIN vs v USING (id) CROSS JOIN range(1, {dimensions + 1}) g(i) GROUP BY 1, 2) GROUP BY j),
c{r + 1} AS MATERIALIZED (SELECT c.j, coalesce(m.c, c.c) AS c FROM c{r} c LEFT JOIN m{r} m USING (j))""")
    last = f"a{rounds}"
    return f"""
WITH vs AS MATERIALIZED (SELECT row_number() OVER () AS id, vec_id, list_transform(embedding, lambda x: floor(x::DOUBLE * {scale})::BIGINT) AS v FROM embeddings
  WHERE len(embedding) = {dimensions} AND len(list_filter(embedding, lambda x: x IS NOT NULL AND isfinite(x))) = {dimensions}),
c0 AS MATERIALIZED (SELECT row_number() OVER (ORDER BY h NULLS LAST, v) - 1 AS j, v AS c FROM (SELECT sha256('{seed}:' || vec_id) AS h, v FROM vs) ORDER BY h NULLS LAST, v LIMIT {k}),{",".join(steps)}
SELECT v.vec_id, a.j::INTEGER AS cluster, a.d AS distance, (sum(a.d) OVER (PARTITION BY a.j))::BIGINT AS cluster_inertia, (sum(a.d) OVER ())::BIGINT AS inertia,
       sha256(list_aggregate(c.c, 'string_agg', ',')) AS centroid_sha256
FROM {last} a JOIN vs v USING (id) JOIN c{rounds} c ON c.j = a.j"""
