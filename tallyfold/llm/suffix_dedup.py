"""Removal of repeated byte strings over the whole corpus, by bucket-pointer refinement.

Suffixes only need to be sorted to depth `length`. Every window of that many
bytes has one minimizer (its least GRAM-gram by hash, leftmost on ties), so
equal windows share it, and consecutive windows with one minimizer form a
segment. Segments meet by minimizer: a minimizer seen once settles its segment
(nothing repeats), equal segments settle each other (all repeats). Only the
texts of unequal segments with one minimizer travel to a task, which sorts
their suffixes: 8-gram buckets first, then each bucket by the bucket pointers
at a later offset, whose updates the next pass reuses. Windows left with
company at full depth repeat. Texts are named by a 128-bit hash, so copies,
repeated ids and null ids need no care.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import arrow_map, materialize, mix, prefix_hash, slices, span_hash, text_buffers
from .minhash import _groups

LENGTH = 200
GRAM = 48
#: Bytes that one refinement sorts at once.
SORT_BYTES = 1_500_000
#: A minimizer with more distinct segments than this has its windows counted by hash instead of sorted in one task.
GIANT = 10_000
#: Minimizers that are broadcast, at most: those that each hold at least such a part of the rows.
MOST_HOT = 1000


def segments(buf: np.ndarray, off: np.ndarray, length: int, gram: int) -> tuple[np.ndarray, ...]:
    """(document, minimizer hash, segment hash, first window, windows) of each segment; offsets within the slice."""
    n, width = len(buf), length - gram + 1
    sizes = np.maximum(np.diff(off) - length + 1, 0)
    if not sizes.sum():
        return tuple(np.zeros(0, np.int64) for _ in range(5))
    prefix = prefix_hash(buf)
    at = np.arange(n - gram + 1)
    h = span_hash(prefix, at, at + gram)
    place = np.uint64(0xFFFFFFFF)
    v = (h & ~place) | at.astype(np.uint64)
    pad = np.full(-len(v) % width + width, ~np.uint64(0))
    blocks = np.concatenate([v, pad]).reshape(-1, width)
    ahead = np.minimum.accumulate(blocks, axis=1).ravel()
    behind = np.minimum.accumulate(blocks[:, ::-1], axis=1)[:, ::-1].ravel()
    start = np.repeat(off[:-1] - np.r_[0, np.cumsum(sizes)[:-1]], sizes) + np.arange(sizes.sum())
    least = (np.minimum(behind[start], ahead[start + width - 1]) & place).astype(np.int64)
    new = np.flatnonzero(np.r_[True, (least[1:] != least[:-1]) | (start[1:] != start[:-1] + 1)])
    lo, m = start[new], least[new]
    count = np.diff(np.r_[new, len(start)])
    seg = mix(span_hash(prefix, lo, lo + count - 1 + length) + (m - lo).astype(np.uint64))
    doc = np.searchsorted(off, lo, "right") - 1
    return doc, h[m].view(np.int64), seg.view(np.int64), lo, count


def refine(text: np.ndarray, ends: np.ndarray, length: int) -> np.ndarray:
    """True at each position whose next `length` bytes (within its part of `text`) also start elsewhere.

    `ends`: for each position, where its part ends. Bucket-pointer refinement:
    a position's pointer names its bucket; passes double the sorted depth.
    """
    n, q = len(text), min(8, length)
    out = np.zeros(n, bool)
    at = np.flatnonzero(np.arange(n) + length <= ends)  # windows
    if not len(at):
        return out
    all_ = np.flatnonzero(np.arange(n) + q <= ends)
    key = np.zeros(len(all_), np.uint64)
    for k in range(q):
        key = key << np.uint64(8) | text[all_ + k]
    pointer = np.full(n, -1, np.int64)
    order = np.argsort(key, kind="stable")
    fresh = np.r_[True, key[order][1:] != key[order][:-1]]
    bucket = np.maximum.accumulate(np.where(fresh, np.arange(len(order)), 0))
    pointer[all_[order]] = bucket
    live = all_[order][~(fresh & np.r_[fresh[1:], True])]  # buckets of one need no more work
    depth = q
    while depth < length:
        step = min(depth, length - depth)  # the last pass overlaps, so that the depth is exactly `length`
        live = live[live + depth + step <= ends[live]]
        own, later = pointer[live], pointer[live + step]
        by = np.lexsort((later, own))
        live, own, later = live[by], own[by], later[by]
        fresh = np.r_[True, (own[1:] != own[:-1]) | (later[1:] != later[:-1])][: len(live)]
        # a bucket's first part keeps its pointer's order; parts get pointers of their own
        first = np.r_[True, own[1:] != own[:-1]][: len(live)]
        head = np.maximum.accumulate(np.where(first, np.arange(len(live)), 0)) if len(live) else live
        part = np.maximum.accumulate(np.where(fresh, np.arange(len(live)), 0)) if len(live) else live
        pointer[live] = own + part - head
        # positions too short for this depth keep a pointer that no deeper pass reads
        live = live[~(fresh & np.r_[fresh[1:], True][: len(live)])]
        depth += step
    out[live] = True
    return out & (np.arange(n) + length <= ends)


def _spans(docs: DataFrame, length: int) -> DataFrame:
    """(t1, t2, spans): for each text the windows that repeat, as (first window, windows)."""
    gram = max(1, min(GRAM, length // 2))

    def cut(batches):
        for b in slices(batches):
            buf, off = text_buffers(b.column("text"))
            doc, mini, seg, lo, n = segments(buf, off, length, gram)
            if len(doc):
                take = pa.array(doc)
                yield pa.RecordBatch.from_arrays([b.column("t1").take(take), b.column("t2").take(take), pa.array(mini), pa.array(seg), pa.array((lo - off[doc]).astype(np.int32)), pa.array(n.astype(np.int32))], ["t1", "t2", "mini", "seg", "lo", "n"])

    rows = arrow_map(docs, cut, "t1 long, t2 long, mini long, seg long, lo int, n int")
    shared = materialize(rows.groupBy("mini").agg(F.count("*").alias("c"), F.min("seg").alias("s0"), F.max("seg").alias("s1")).where("c > 1").select("mini", "c", (F.col("s0") != F.col("s1")).alias("mixed")))
    # at most MOST_HOT minimizers can each hold so many of the rows: those are broadcast, and their rows go round the join by keys of their own
    cut_ = max(2, (shared.agg(F.sum("c")).first()[0] or 0) // MOST_HOT + 1)
    hot = shared.where(F.col("c") >= cut_).select("mini", F.col("mixed").alias("_hot"))
    cold = shared.where(F.col("c") < cut_).select(F.lit(False).alias("_is_hot"), F.col("mini").alias("_key"), F.col("mixed").alias("_cold"))
    rows = rows.join(F.broadcast(hot), "mini", "left").withColumn("_is_hot", F.col("_hot").isNotNull()).withColumn("_key", F.when(F.col("_is_hot"), F.xxhash64("t1", "lo")).otherwise(F.col("mini")))
    rows = rows.join(cold, ["_is_hot", "_key"], "left").withColumn("mixed", F.coalesce("_hot", "_cold")).where("mixed is not null")
    rows = materialize(rows.select("t1", "t2", "mini", "seg", "lo", "n", "mixed"))
    mixed = rows.where("mixed")
    kinds = materialize(mixed.groupBy("mini", "seg").agg(F.count("*").alias("c"), F.min(F.struct("t1", "t2", "lo", "n")).alias("r")))
    alone = kinds.where("c = 1")
    sure = rows.where("not mixed").select("t1", "t2", "lo", "n").union(mixed.join(alone.select("mini", "seg"), ["mini", "seg"], "left_anti").select("t1", "t2", "lo", "n"))

    groups = kinds.groupBy("mini").agg(F.count("*").alias("kinds"), F.sum(F.when(F.col("c") == 1, 1).otherwise(0)).alias("alone")).where("alone > 0")
    asked = kinds.join(groups, "mini").select("mini", (F.col("kinds") > GIANT).alias("giant"), (F.col("c") == 1).alias("alone"), "r.*")
    per_text = asked.groupBy("t1", "t2").agg(F.collect_list(F.struct("lo", "n", "mini", "giant", "alone")).alias("asked"))

    def fetch(batches):
        for b in slices(batches):
            rows_ = []
            for i, (t, ask) in enumerate(zip(b.column("text").cast(pa.binary()).to_pylist(), b.column("asked").to_pylist(), strict=True)):
                rows_ += [(i, r["mini"], r["giant"], r["alone"], r["lo"], t[r["lo"] : r["lo"] + r["n"] - 1 + length]) for r in ask]
            i, *cols = zip(*rows_, strict=True)
            yield pa.RecordBatch.from_arrays([b.column("t1").take(pa.array(i)), b.column("t2").take(pa.array(i)), *[pa.array(c, kind) for c, kind in zip(cols, (pa.int64(), pa.bool_(), pa.bool_(), pa.int32(), pa.binary()), strict=True)]], ["t1", "t2", "mini", "giant", "alone", "lo", "piece"])

    # copies of a text send equal rows; only one of each is of use, and `alone` texts have no copies
    pieces = arrow_map(docs.join(per_text, ["t1", "t2"]), fetch, "t1 long, t2 long, mini long, giant boolean, alone boolean, lo int, piece binary")
    pieces = pieces.groupBy("t1", "t2", "mini", "giant", "alone", "lo").agg(F.first("piece").alias("piece"))
    giants = not groups.where(F.col("kinds") > GIANT).isEmpty()
    if giants:
        pieces = materialize(pieces)

    def sort(batches):
        held, size = [], 0
        for t in _groups(batches, "mini"):
            held.append(t.select(["t1", "t2", "alone", "lo", "piece"]))
            size += sum(map(len, t.column("piece").to_pylist()))
            if size > SORT_BYTES:
                yield from done(held)
                held, size = [], 0
        if held:
            yield from done(held)

    def done(held):
        t = pa.concat_tables(held).combine_chunks()
        buf, off = text_buffers(t.column("piece"))
        hit = refine(buf, np.repeat(off[1:], np.diff(off)), length)
        hit &= np.repeat(t.column("alone").to_numpy(zero_copy_only=False) if isinstance(t.column("alone"), pa.Array) else t.column("alone").to_numpy(), np.diff(off))
        part = np.repeat(np.arange(len(off) - 1), np.diff(off))
        first = np.flatnonzero(hit & ~(np.r_[False, hit[:-1]] & np.r_[False, part[1:] == part[:-1]]))
        last = np.flatnonzero(hit & ~(np.r_[hit[1:], False] & np.r_[part[1:] == part[:-1], False]))
        if len(first):
            own = part[first]
            take = pa.array(own)
            lo = t.column("lo").take(take).to_numpy() + (first - off[own])
            yield pa.RecordBatch.from_arrays([t.column("t1").take(take).combine_chunks(), t.column("t2").take(take).combine_chunks(), pa.array(lo.astype(np.int32)), pa.array((last - first + 1).astype(np.int32))], ["t1", "t2", "lo", "n"])

    found = arrow_map(pieces.where("not giant").repartition("mini").sortWithinPartitions("mini"), sort, "t1 long, t2 long, lo int, n int")
    spans = sure.union(found)
    if giants:

        def windows(batches):
            for b in slices(batches, "piece", SORT_BYTES // 8):
                buf, off = text_buffers(b.column("piece"))
                n = np.diff(off) - length + 1
                start = np.repeat(off[:-1] - np.r_[0, np.cumsum(n)[:-1]], n) + np.arange(n.sum())
                own = np.repeat(np.arange(len(n)), n)
                take = pa.array(own)
                yield pa.RecordBatch.from_arrays([b.column("t1").take(take), b.column("t2").take(take), b.column("mini").take(take), b.column("alone").take(take), pa.array(span_hash(prefix_hash(buf), start, start + length).view(np.int64)), pa.array((b.column("lo").to_numpy()[own] + start - off[own]).astype(np.int32))], ["t1", "t2", "mini", "alone", "h", "lo"])

        each = arrow_map(pieces.where("giant"), windows, "t1 long, t2 long, mini long, alone boolean, h long, lo int")
        again = each.groupBy("mini", "h").agg(F.count("*").alias("c")).where("c > 1").select("mini", "h")
        spans = spans.union(each.where("alone").join(again, ["mini", "h"]).select("t1", "t2", "lo", F.lit(1).alias("n")))
    return spans.groupBy("t1", "t2", "lo").agg(F.max("n").alias("n")).groupBy("t1", "t2").agg(F.collect_list(F.struct("lo", "n")).alias("spans"))


def _named(docs: DataFrame, text_col: str) -> DataFrame:
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    return docs.withColumn("text", text).withColumns({"t1": F.xxhash64("text"), "t2": F.xxhash64(F.lit(1), "text")})


def covered(size: int, spans: list[dict] | None, length: int) -> np.ndarray:
    """True at each byte of a text that a repeated window covers."""
    edge = np.zeros(size + 1, np.int64)
    for s in spans or ():
        edge[s["lo"]] += 1
        edge[s["lo"] + s["n"] - 1 + length] -= 1
    return np.cumsum(edge)[:-1] > 0


def repeated_spans(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", length: int = LENGTH) -> DataFrame:
    """(doc_id, n_bytes, n_removed, n_spans, kept_sha256) for every row of `docs`.

    A byte goes if a `length`-byte string that covers it also starts anywhere
    else in the input, the same text included; overlaps count; texts are UTF-8
    bytes and matches never cross them. Null counts as empty; texts shorter
    than `length` lose nothing; repeated rows are copies of one another and
    lose everything; null ids are kept; other columns are ignored; an empty
    table gives no rows.
    """
    docs = _named(docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text")), "text")

    def cut(batches):
        for b in slices(batches):
            buf, off = text_buffers(b.column("text"))
            out = []
            for i, spans in enumerate(b.column("spans").to_pylist()):
                own = buf[off[i] : off[i + 1]]
                gone = covered(len(own), spans, length)
                out.append((len(own), int(gone.sum()), int((np.diff(np.r_[False, gone].astype(np.int8)) == 1).sum()), hashlib.sha256(own[~gone].tobytes()).hexdigest()))
            n, removed, runs, sha = zip(*out, strict=True)
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), pa.array(n, pa.int64()), pa.array(removed, pa.int64()), pa.array(runs, pa.int64()), pa.array(sha)], ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"])

    joined = docs.join(_spans(docs.select("t1", "t2", "text"), length), ["t1", "t2"], "left").select("doc_id", "text", "spans")
    return arrow_map(joined, cut, "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string")
