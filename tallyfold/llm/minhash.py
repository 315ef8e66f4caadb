"""Near-duplicate groups by b-bit MinHash.

Signatures keep the low B bits of each minimum, packed; bands over the full
minima give candidates; collision-corrected bit counts screen pairs; full
shingle sets confirm them. Documents with equal sets are one node, so copies
are never paired. Candidate buckets join nodes into blocks through their
smallest node; inside a block only pairs of still separate groups are tested,
so no bucket is expanded into all of its pairs. A block beyond BLOCK_DOCS texts
or BLOCK_SHINGLES shingles is dealt over several tasks, and what those leave
apart is compared across tasks.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import LOWER, NONSPACE, arrow_map, heavy_light, materialize, mix, prefix_hash, scan_words, slices, span_hash, staged, text_buffers
from .components import components

HASHES, ROWS, BITS = 160, 5, 4
BANDS = HASHES // ROWS
#: Screening margin below the threshold: six standard deviations of the estimate at 0.8.
MARGIN = 0.2
#: Texts and shingles that one task holds, about (a longer text is a task's share by itself).
BLOCK_DOCS, BLOCK_SHINGLES = 3000, 3_000_000
_rng = np.random.default_rng(811)
_A = _rng.integers(1, 2**62, HASHES, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_B = _rng.integers(1, 2**63, HASHES, dtype=np.uint64)
_ORDER = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0x27D4EB2F165667C5, 0x85EBCA77C2B2AE63, 0xD6E8FEB86659FD93, 0xA0761D6478BD642F, 0xE7037ED1A0B428DB], np.uint64)
#: Equal 4-bit fields in a byte whose XOR is the index.
_EQUAL = np.array([(x & 15 == 0) + (x >> 4 == 0) for x in range(256)], np.uint8)


def shingle_sets(buf: np.ndarray, off: np.ndarray, width: int) -> list[np.ndarray]:
    """Sorted distinct shingle hashes of each document; fewer words than `width` form one shingle."""
    buf = LOWER[buf]
    starts, ends, at = scan_words(buf, off, NONSPACE)
    h = span_hash(prefix_hash(buf), starts, ends)
    n = max(0, len(h) - width + 1)
    grams = np.zeros(n, np.uint64)
    for k in range(width):
        grams += h[k : k + n] * _ORDER[k]
    grams = mix(grams)
    out = []
    for a, b in zip(at[:-1].tolist(), at[1:].tolist(), strict=True):
        if b - a >= width:
            out.append(np.unique(grams[a : b - width + 1]))
        elif b > a:
            out.append(mix(np.array([(h[a:b] * _ORDER[: b - a]).sum() + np.uint64(b - a)], np.uint64)))
        else:
            out.append(np.zeros(0, np.uint64))
    return out


def set_keys(sets: list[np.ndarray]) -> list[bytes | None]:
    """128 bits for each non-empty set."""
    cat, at = np.concatenate([*sets, np.zeros(0, np.uint64)]), np.cumsum([0, *map(len, sets)])
    sums = np.zeros((2, len(cat) + 1), np.uint64)
    np.cumsum(mix(cat ^ np.uint64(0x5851F42D4C957F2D)), out=sums[0, 1:])
    np.cumsum(mix(cat + np.uint64(0x14057B7EF767814F)), out=sums[1, 1:])
    both = np.stack([x[at[1:]] - x[at[:-1]] + np.diff(at).astype(np.uint64) for x in sums], 1).astype(">u8")
    return [both[i].tobytes() if len(s) else None for i, s in enumerate(sets)]


def sign(sets: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """(packed low bits, band keys) of non-empty sets."""
    if not sets:
        return np.zeros((0, HASHES * BITS // 8), np.uint8), np.zeros((0, BANDS), np.int64)
    cat, at = np.concatenate(sets), np.cumsum([0, *map(len, sets)])[:-1]
    least = np.empty((len(sets), HASHES), np.uint64)
    part = np.empty_like(cat)
    for k in range(HASHES):
        np.multiply(cat, _A[k], out=part)
        np.add(part, _B[k], out=part)
        least[:, k] = np.minimum.reduceat(part, at)
    least = mix(least)
    low = (least & np.uint64(15)).astype(np.uint8)
    grouped = least.reshape(len(sets), BANDS, ROWS)
    keys = mix((grouped * _ORDER[:ROWS]).sum(2, dtype=np.uint64) + np.arange(BANDS, dtype=np.uint64) * _ORDER[7])
    return low[:, ::2] | low[:, 1::2] << 4, keys.view(np.int64)


def estimate(one: np.ndarray, many: np.ndarray) -> np.ndarray:
    """Jaccard similarity from equal fields, corrected for chance agreement of BITS bits."""
    same = _EQUAL[many ^ one].sum(1, dtype=np.int64) / HASHES
    chance = 2.0**-BITS
    return (same - chance) / (1 - chance)


def link(sets: list[np.ndarray], sigs: np.ndarray, bands: np.ndarray, percent: int, side: np.ndarray | None = None) -> np.ndarray:
    """Group label of each set: groups of the links among candidates (`side`: only pairs with a True member)."""
    n = len(sets)
    label = np.arange(n)
    size = np.array([len(s) for s in sets])
    failed: set[tuple[int, int]] = set()
    for band in range(bands.shape[1]):
        order = np.argsort(bands[:, band], kind="stable")
        cuts = np.flatnonzero(np.r_[True, np.diff(bands[order, band]) != 0, True])
        for a, b in zip(cuts[:-1], cuts[1:], strict=True):
            if b - a < 2:
                continue
            bucket = order[a:b]
            for x, i in enumerate(bucket[:-1]):
                rest = bucket[x + 1 :]
                rest = rest[label[rest] != label[i]]
                if side is not None and len(rest) and not side[i]:
                    rest = rest[side[rest]]
                if not len(rest):
                    continue
                rest = rest[estimate(sigs[i], sigs[rest]) >= percent / 100 - MARGIN]
                rest = np.array([j for j in rest.tolist() if (min(i, j), max(i, j)) not in failed], int)
                if not len(rest):
                    continue
                cat = np.concatenate([sets[j] for j in rest])
                at = np.minimum(np.searchsorted(sets[i], cat), size[i] - 1)
                common = np.add.reduceat((sets[i][at] == cat).astype(np.int64), np.cumsum([0, *size[rest]])[:-1])
                ok = 100 * common >= percent * (size[i] + size[rest] - common)
                for j, good in zip(rest.tolist(), ok.tolist(), strict=True):
                    if good:
                        label[label == label[j]] = label[i]
                    else:
                        failed.add((min(i, j), max(i, j)))
    return label


def _groups(batches: Iterator[pa.RecordBatch], key: str) -> Iterator[pa.Table]:
    """Runs of equal `key` in sorted batches, one at a time in memory."""
    held: list[pa.RecordBatch] = []
    last = None
    for batch in batches:
        if not batch.num_rows:
            continue
        keys = np.asarray(batch.column(key).to_numpy(zero_copy_only=False))
        cuts = [0, *(np.flatnonzero(keys[1:] != keys[:-1]) + 1).tolist(), len(keys)]
        for a, b in zip(cuts[:-1], cuts[1:], strict=True):
            if held and keys[a] != last:
                yield pa.Table.from_batches(held)
                held = []
            held.append(batch.slice(a, b - a))
            last = keys[a]
    if held:
        yield pa.Table.from_batches(held)


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 5, percent: int = 80) -> DataFrame:
    """(doc_id, n_shingles, component_id, kept) for every row of `docs`.

    Words are lower-cased (A-Z) runs of non-space bytes; sets hold distinct
    `shingle`-word shingles; links need a Jaccard similarity of `percent`/100.
    Null or wordless texts have no shingles and link to nothing. Rows without
    an id link to nothing either: component_id null, kept true. Rows that
    repeat an id are all returned; a repeated row falls into its own group.
    Other columns of any name are ignored; an empty table gives no rows.
    """
    docs = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    n = docs.agg(F.count("doc_id").alias("rows"), F.count_distinct("doc_id").alias("ids")).first()
    # what names the text of a node: its id, or a number where ids repeat
    docs = docs.withColumn("row", F.col("doc_id")) if n["rows"] == n["ids"] else staged(docs.withColumn("row", F.monotonically_increasing_id()), "rows")

    def signatures(batches):
        for b in slices(batches):
            sets = shingle_sets(*text_buffers(b.column("text")), shingle)
            keys = set_keys(sets)
            full = [i for i, s in enumerate(sets) if len(s)]
            sig, bands = sign([sets[i] for i in full])
            at = dict(zip(full, range(len(full)), strict=True))
            yield pa.RecordBatch.from_pydict({
                "doc_id": b.column("doc_id"),
                "row": b.column("row"),
                "n_shingles": pa.array([len(s) for s in sets], pa.int64()),
                "node": pa.array(keys, pa.binary()),
                "sig": pa.array([sig[at[i]].tobytes() if i in at else None for i in range(len(sets))], pa.binary()),
                "bands": pa.array([bands[at[i]].tobytes() if i in at else None for i in range(len(sets))], pa.binary()),
            })

    signed = materialize(arrow_map(docs, signatures, "doc_id long, row long, n_shingles long, node binary, sig binary, bands binary"))
    linkable = signed.where("doc_id is not null and node is not null")
    nodes = linkable.groupBy("node").agg(F.min("doc_id").alias("min_id"), F.count("*").alias("copies"), F.min(F.struct("doc_id", "row", "sig", "bands", "n_shingles")).alias("s"))
    # numbered once written, so that everything after meets on longs
    nodes = materialize(nodes.select("node", "min_id", "s.row", "copies", "s.sig", "s.bands", F.col("s.n_shingles").alias("size"), F.monotonically_increasing_id().alias("id")))

    banded = nodes.select("id", F.explode(F.transform(F.sequence(F.lit(0), F.lit(BANDS - 1)), lambda k: F.struct(k.alias("band"), F.substring("bands", k * 8 + 1, F.lit(8)).alias("key")))).alias("b")).select("id", "b.band", "b.key")
    hubs = banded.groupBy("band", "key").agg(F.min("id").alias("hub"), F.count("*").alias("n")).where("n > 1")
    blocks = components(banded.join(hubs, ["band", "key"]).select(F.col("id").alias("u"), F.col("hub").alias("v"))).withColumnRenamed("node", "id")
    placed = blocks.join(nodes, "id")
    parts = placed.groupBy("root").agg(F.ceil(F.greatest(F.count("*") / BLOCK_DOCS, F.sum("size") / BLOCK_SHINGLES)).alias("parts"))
    # tasks: (block, chunk); a block within the bounds has one chunk
    members = materialize(placed.join(parts, "root").select("id", "node", "row", "sig", "bands", "root", "parts", F.expr("pmod(xxhash64(id), parts)").alias("part")))
    with_text = lambda m: m.join(docs.select("row", "text"), "row").drop("row")

    def solve(tag):
        def run(batches):
            for t in _groups(batches, "task"):
                t = t.combine_chunks()
                sets = shingle_sets(*text_buffers(t.column("text")), shingle)
                keys, want = set_keys(sets), t.column("node").to_pylist()
                if keys != want:
                    raise RuntimeError("a text is not the one that was signed")
                own = list(range(len(keys)))
                sig = np.frombuffer(b"".join(t.column("sig").take(own).to_pylist()), np.uint8).reshape(len(own), -1)
                bands = np.frombuffer(b"".join(t.column("bands").take(own).to_pylist()), np.int64).reshape(len(own), -1)
                side = np.array(t.column("side").take(own).to_pylist()) if tag else None
                label = link([sets[i] for i in own], sig, bands, percent, side)
                ids = t.column("id").take(own).to_pylist()
                root: dict[int, int] = {}
                for l, k in zip(label.tolist(), ids, strict=True):
                    root[l] = min(root.get(l, k), k)
                pairs = [(k, root[l]) for l, k in zip(label.tolist(), ids, strict=True) if root[l] != k]
                if pairs:
                    yield pa.RecordBatch.from_pydict({"u": pa.array([p[0] for p in pairs], pa.int64()), "v": pa.array([p[1] for p in pairs], pa.int64())})

        return run

    def tasks(df: DataFrame, tag: bool) -> DataFrame:
        return arrow_map(df.repartition("task").sortWithinPartitions("task"), solve(tag), "u long, v long")

    task = F.xxhash64("root", "part")
    edges = materialize(tasks(with_text(members.withColumn("task", task)), False))
    split = members.where("parts > 1")
    if split.isEmpty():
        linked = edges.groupBy(F.col("u").alias("id")).agg(F.min("v").alias("root"))
        linked = linked.union(linked.select(F.col("root").alias("id"), "root").distinct())
    else:
        # within chunks all is settled; what lies outside a block's largest group meets all other chunks
        groups = components(edges)
        placed = split.join(groups.select(F.col("node").alias("id"), F.col("root").alias("g")), "id", "left").withColumn("g", F.coalesce("g", "id"))
        per = placed.groupBy("root", "g").agg(F.count("*").alias("c"))
        main = per.groupBy("root").agg(F.max_by("g", F.struct("c", "g")).alias("main"))
        placed = materialize(placed.join(main, "root").withColumn("side", F.col("g") != F.col("main")))
        # chunk pairs: each residual node goes to the pairs of its chunk, each node to those that hold residual nodes
        fan = placed.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("parts") - 1))).where("other <> part")
        fan = fan.withColumn("task", F.xxhash64("root", F.least("part", "other"), F.greatest("part", "other")))
        live = fan.where("side").select("task").distinct()
        more = tasks(with_text(fan.join(live, "task", "left_semi").select("id", "node", "row", "sig", "bands", "task", "side")), True)
        linked = components(edges.union(materialize(more))).withColumnRenamed("node", "id")

    named = linked.join(nodes.select("id", "node", "min_id"), "id")
    lowest = named.groupBy("root").agg(F.min("min_id").alias("component_id"))
    grouped = named.join(lowest, "root").select("node", "component_id")
    special = materialize(nodes.select("node", "min_id", "copies").join(grouped, "node", "left").where("copies > 1 or component_id is not null").select("node", "copies", F.coalesce("component_id", "min_id").alias("component_id")))
    slim = signed.select("doc_id", "n_shingles", "node")
    with_node = slim.where("doc_id is not null and node is not null")
    alone = slim.where("doc_id is null or node is null").withColumn("component_id", F.col("doc_id"))
    out = heavy_light(with_node, special, "node", "copies", "left")
    out = out.select("doc_id", "n_shingles", F.coalesce("component_id", "doc_id").alias("component_id"))
    out = out.unionByName(alone.select("doc_id", "n_shingles", "component_id"))
    return out.withColumn("kept", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True)))


def near_duplicates_sql(shingle: int = 4, percent: int = 80) -> str:
    """The same by exact counts of shared shingles, for DuckDB; ids are unique."""
    return f"""
WITH RECURSIVE words AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\\x20\\x09-\\x0D]+') AS w FROM documents),
sets AS (SELECT doc_id, CASE WHEN len(w) = 0 THEN [] WHEN len(w) < {shingle} THEN [array_to_string(w, ' ')] ELSE list_distinct(list_transform(range(1, len(w) - {shingle} + 2), lambda i: array_to_string(w[i : i + {shingle} - 1], ' '))) END AS s FROM words),
nodes AS (SELECT min(doc_id) AS node, len(list_sort(s)) AS n, list_sort(s) AS key FROM sets WHERE len(s) > 0 GROUP BY list_sort(s)),
flat AS (SELECT node, n, hash(x) AS x FROM (SELECT node, n, unnest(key) AS x FROM nodes)),
links AS (SELECT a.node AS u, b.node AS v FROM flat a JOIN flat b ON a.x = b.x AND a.node < b.node AND 100 * a.n >= {percent} * b.n AND 100 * b.n >= {percent} * a.n GROUP BY a.node, b.node, a.n, b.n HAVING 100 * count(*) >= {percent} * (a.n + b.n - count(*))),
pairs AS (SELECT u, v FROM links UNION SELECT v, u FROM links),
reach(node, other) AS (SELECT node, node FROM nodes UNION SELECT reach.node, pairs.v FROM reach JOIN pairs ON pairs.u = reach.other),
roots AS (SELECT node, min(other) AS root FROM reach GROUP BY node)
SELECT d.doc_id, CAST(len(d.s) AS BIGINT) AS n_shingles, coalesce(root, d.doc_id) AS component_id, coalesce(root, d.doc_id) = d.doc_id AS kept
FROM sets d LEFT JOIN nodes ON nodes.key = list_sort(d.s) AND len(d.s) > 0 LEFT JOIN roots ON roots.node = nodes.node"""
