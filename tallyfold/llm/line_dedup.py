"""Cross-site boilerplate lines by HyperLogLog spread, DataFrame functions only.

Each line hash keeps a sketch of the sites that carry it; sketches merge in
partial aggregates before the shuffle. Lines whose estimate clearly exceeds or
misses the threshold are settled by it; those inside the sketch's error band get
an exact distinct count of sites. Lines found on enough sites leave every document.
"""

from __future__ import annotations

import json

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import heavy_light, materialize

MIN_SITES = 8
#: 2**10 registers: relative error 1.04 / 32 = 3.3 %; the band is six of those.
LG_K = 10
BAND = 0.2
#: A table of at most so many 16-byte keys is broadcast (some 20 MB); beyond that the joins shuffle.
BROADCAST_KEYS = 200_000
#: Lines to remove that travel with the plan as a hash table (some 2 MB); beyond that texts meet their lines in a join.
INLINE_KEYS = 50_000


def _lines(text: Column) -> Column:
    return F.split(text, "\n", -1)


def _key(line: Column) -> Column:
    """128 bits, so that no two lines of a corpus are taken for one another."""
    return F.struct(F.xxhash64(line).alias("a"), F.xxhash64(F.lit(1), line).alias("b"))


def _meet(lines: DataFrame, keys: DataFrame, how: str) -> DataFrame:
    """Rows of `lines` whose key is in `keys(key, n)`; hot keys never meet in one task."""
    if keys.count() <= BROADCAST_KEYS:
        return lines.join(F.broadcast(keys.select("key")), "key", how)
    lines = materialize(lines)
    return heavy_light(lines, keys, "key", "n").drop("n")


def _table(keys: list[tuple[int, int]]) -> tuple[Column, int]:
    """(array of buckets of first halves, buckets) for at most INLINE_KEYS keys: one literal, looked up by the second half."""
    size = max(1, 2 * len(keys))
    buckets: list[list[int]] = [[] for _ in range(size)]
    for a, b in keys:
        buckets[b % size].append(a)
    return F.from_json(F.lit(json.dumps(buckets)), "array<array<bigint>>"), size


def remove_boilerplate(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", site_col: str = "source", min_sites: int = MIN_SITES) -> DataFrame:
    """`docs` with `text_col` replaced, and n_lines, n_removed.

    Lines are parts between line feeds, compared without leading and trailing
    spaces; blank ones always stay. A line on min_sites or more distinct sites
    goes from every document, other lines keep their order. Null sites count as
    none. A null text stays null (0 lines); an empty text is one blank line.
    Every row is treated by its own text, whatever its id: repeated and null ids
    are of no account. n_lines and n_removed replace input columns of these
    names; other columns may have any name. An empty table gives an empty table.
    Texts stay where they are while at most INLINE_KEYS lines have to go.
    """
    docs = docs.drop("n_lines", "n_removed")
    names = docs.columns
    fresh = lambda name: next(n for k in range(len(names) + 1) if (n := f"__{name}{k}") not in names)
    row, bad, kept = fresh("row"), fresh("bad"), fresh("kept")
    parts = lambda t: F.explode(F.array_distinct(F.transform(_lines(t), lambda x: F.trim(x))))
    text, site = F.col(text_col).cast("string"), F.col(site_col).cast("string")
    lines = docs.select(site.alias("site"), parts(text).alias("line")).where("line <> ''").select("site", _key(F.col("line")).alias("key"))

    spread = lines.groupBy("key").agg(F.hll_sketch_agg("site", F.lit(LG_K)).alias("sketch"), F.count("*").alias("n"))
    spread = materialize(spread.select("key", "n", F.hll_sketch_estimate("sketch").alias("estimate")).where(F.col("estimate") >= min_sites * (1 - BAND)))
    sure, near = (spread.where(c).select("key", "n") for c in (F.col("estimate") > min_sites * (1 + BAND), F.col("estimate") <= min_sites * (1 + BAND)))
    counted = _meet(lines, near, "left_semi").groupBy("key").agg(F.count_distinct("site").alias("sites")).where(F.col("sites") >= min_sites)
    frequent = materialize(sure.unionByName(near.join(counted.select("key"), "key", "left_semi")))

    if frequent.count() <= INLINE_KEYS:
        table, size = _table([(r["a"], r["b"]) for r in frequent.select("key.*").collect()])
        out = docs
        gone = lambda x: F.array_contains(F.element_at(table, F.pmod(F.xxhash64(F.lit(1), x), F.lit(size)).cast("int") + 1), F.xxhash64(x))
    else:  # distinct (row, key) pairs meet the lines to remove; then texts travel once
        out = materialize(docs.withColumn(row, F.monotonically_increasing_id()))
        own = out.select(F.col(row).alias("row"), parts(text).alias("line")).where("line <> ''").select("row", _key(F.col("line")).alias("key"))
        hits = _meet(own, frequent, "left_semi").groupBy(F.col("row").alias(row)).agg(F.collect_set("key").alias(bad))
        out = out.join(hits, row, "left")
        gone = lambda x: F.coalesce(F.array_contains(bad, _key(x)), F.lit(False))
    out = out.withColumn(kept, F.filter(_lines(text), lambda x: (F.trim(x) == "") | ~gone(F.trim(x))))
    size_of = lambda c: F.when(text.isNull(), F.lit(0)).otherwise(F.size(c)).cast("long")
    n, left = size_of(_lines(text)), size_of(F.col(kept))
    new = F.when(n == left, text).otherwise(F.array_join(kept, "\n"))
    return out.select(*[new.alias(c) if c == text_col else F.col(f"`{c}`") for c in names], n.alias("n_lines"), (n - left).alias("n_removed"))


def line_dedup_sql(min_sites: int = MIN_SITES) -> str:
    """The same by exact distinct counts, for DuckDB."""
    return f"""
WITH parts AS (SELECT doc_id, source, generate_subscripts(ls, 1) AS i, unnest(ls) AS line
               FROM (SELECT doc_id, source, string_split(text, chr(10)) AS ls FROM documents)),
bad AS (SELECT trim(line) AS line FROM parts WHERE trim(line) <> '' GROUP BY 1 HAVING count(DISTINCT source) >= {min_sites}),
marked AS (SELECT p.*, b.line IS NOT NULL AS gone FROM parts p LEFT JOIN bad b ON trim(p.line) = b.line),
texts AS (SELECT doc_id, count(*) AS n_lines, count(*) FILTER (WHERE gone) AS n_removed,
                 coalesce(string_agg(line, chr(10) ORDER BY i) FILTER (WHERE NOT gone), '') AS text FROM marked GROUP BY doc_id)
SELECT d.doc_id, t.text, CAST(coalesce(t.n_lines, 0) AS BIGINT) AS n_lines, CAST(coalesce(t.n_removed, 0) AS BIGINT) AS n_removed
FROM documents d LEFT JOIN texts t USING (doc_id)"""
