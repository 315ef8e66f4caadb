"""Benchmark decontamination by an FM-index over each training shard.

A shard is a bounded run of documents held by one task. Its words become ranks
in the vocabulary of the test phrases (all other words, and document ends, are
one separator symbol, which no phrase holds; runs of separators and stretches
shorter than the shortest phrase shrink to one). Over that sequence the task
builds a suffix array, its Burrows-Wheeler transform as a wavelet tree, and
sampled suffix positions. All phrases are searched backward at once; their
occurrences are located by walking to the samples and checked word by word;
their spans merge into removal spans.
"""

from __future__ import annotations

import hashlib
import itertools
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import ALNUM, LOWER, arrow_map, materialize, prefix_hash, scan_words, slices, span_hash, text_buffers

WINDOW = 10
#: Bytes of text in one shard (a longer document is a shard of its own).
SHARD_BYTES = 3_000_000
#: Every SAMPLE-th suffix position is kept.
SAMPLE = 8
#: Bytes of test items sent to the tasks at once; more items take further passes.
BLOCK_BYTES = 8_000_000


def word_ids(buf: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(64-bit word hashes, starts, ends, words before each document)."""
    buf = LOWER[buf]
    starts, ends, at = scan_words(buf, off, ALNUM)
    return span_hash(prefix_hash(buf), starts, ends), starts, ends, at


class WaveletTree:
    """Ranks over symbols 0..2**bits - 1 by one bit vector a level, zeros before ones (a wavelet matrix)."""

    def __init__(self, symbols: np.ndarray, bits: int):
        self.bits, self.ones, self.zeros = bits, [], []
        for level in range(bits - 1, -1, -1):
            bit = (symbols >> level) & 1
            count = np.zeros(len(symbols) + 1, np.int32)
            np.cumsum(bit, out=count[1:])
            self.ones.append(count)
            self.zeros.append(len(symbols) - int(count[-1]))
            symbols = np.concatenate([symbols[bit == 0], symbols[bit == 1]])

    def rank(self, symbol: np.ndarray, at: np.ndarray) -> np.ndarray:
        """How often each symbol occurs before each place."""
        low = np.zeros_like(at)
        for k, (ones, zeros) in enumerate(zip(self.ones, self.zeros, strict=True)):
            one = ((symbol >> (self.bits - 1 - k)) & 1).astype(bool)
            up_at, up_low = ones[at], ones[low]
            at = np.where(one, zeros + up_at, at - up_at)
            low = np.where(one, zeros + up_low, low - up_low)
        return at - low

    def access(self, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(symbol at each place, its rank there)."""
        symbol, low = np.zeros_like(at), np.zeros_like(at)
        for ones, zeros in zip(self.ones, self.zeros, strict=True):
            one = ones[at + 1] > ones[at]
            symbol = symbol * 2 + one
            # where the symbol's own block begins is followed along
            up_at = ones[at]
            up_low = ones[low]
            at = np.where(one, zeros + up_at, at - up_at)
            low = np.where(one, zeros + up_low, low - up_low)
        return symbol, at - low


def suffix_array(text: np.ndarray) -> np.ndarray:
    """Suffixes of `text` (its last symbol is the only 0) by prefix doubling; only unsettled groups are sorted again."""
    n = len(text)
    order = np.argsort(text, kind="stable")
    new = np.r_[True, text[order][1:] != text[order][:-1]]
    rank = np.empty(n, np.int64)
    rank[order] = np.maximum.accumulate(np.where(new, np.arange(n), 0))
    step = 1
    open_ = np.flatnonzero(~(new & np.r_[new[1:], True]))  # places in groups of two or more
    while len(open_):
        at = order[open_]
        key = rank[np.minimum(at + step, n - 1)]
        by = np.lexsort((key, rank[at]))
        at, key = at[by], key[by]
        order[open_] = at
        group = rank[at]
        fresh = np.r_[True, (group[1:] != group[:-1]) | (key[1:] != key[:-1])]
        rank[at] = open_[np.maximum.accumulate(np.where(fresh, np.arange(len(at)), 0))]
        alone = fresh & np.r_[fresh[1:], True]
        open_ = open_[~alone]
        step *= 2
    return order


class FMIndex:
    """Backward search and location over a sequence of symbols 1..most that ends with 0."""

    def __init__(self, text: np.ndarray, most: int):
        order = suffix_array(text)
        self.bwt = WaveletTree(text[order - 1], most.bit_length())
        self.before = np.zeros(most + 2, np.int64)
        np.cumsum(np.bincount(text, minlength=most + 1), out=self.before[1:])
        kept = order % SAMPLE == 0
        self.kept_before = np.zeros(len(order) + 1, np.int64)
        np.cumsum(kept, out=self.kept_before[1:])
        self.sampled = order[kept]
        self.size = len(text)

    def search(self, phrases: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Suffix interval of each phrase (rows of `phrases`, padded at the end)."""
        low, high = np.zeros(len(phrases), np.int64), np.full(len(phrases), self.size, np.int64)
        live = np.arange(len(phrases))
        for k in range(phrases.shape[1]):
            live = live[(lengths[live] > k) & (low[live] < high[live])]
            if not len(live):
                break
            c = phrases[live, lengths[live] - 1 - k]
            low[live] = self.before[c] + self.bwt.rank(c, low[live])
            high[live] = self.before[c] + self.bwt.rank(c, high[live])
        return low, np.maximum(low, high)

    def locate(self, at: np.ndarray) -> np.ndarray:
        """Text position of each suffix, walking back to a sampled one."""
        out, steps, todo = np.zeros(len(at), np.int64), 0, np.arange(len(at))
        at = at.copy()
        while len(todo):
            hit = self.kept_before[at[todo] + 1] > self.kept_before[at[todo]]
            done = todo[hit]
            out[done] = self.sampled[self.kept_before[at[done]]] + steps
            todo = todo[~hit]
            symbol, rank = self.bwt.access(at[todo])
            at[todo] = self.before[symbol] + rank
            steps += 1
        return out


@dataclass
class Phrases:
    """Windows of a block of test items, in vocabulary ranks."""

    vocabulary: np.ndarray  # sorted hashes
    symbols: np.ndarray  # (windows, WINDOW), 0-padded
    lengths: np.ndarray
    hashes: np.ndarray  # the words' hashes, same shape
    owners: list[list[int]]  # item numbers of each window


def phrases_of(texts: list[str | None], window: int) -> Phrases:
    """Distinct windows of the items; the symbols start at 2 (0 ends the text, 1 separates)."""
    found: dict[tuple[int, ...], list[int]] = {}
    h, _, _, at = word_ids(*text_buffers(pa.array(texts, pa.string())))
    for i, (a, b) in enumerate(zip(at[:-1].tolist(), at[1:].tolist(), strict=True)):
        words = h[a:b].tolist()
        for k in range(max(1, len(words) - window + 1) if words else 0):
            owner = found.setdefault(tuple(words[k : k + window]), [])
            if not owner or owner[-1] != i:
                owner.append(i)
    lengths = np.array([len(w) for w in found], np.int64)
    hashes = np.zeros((len(found), window), np.uint64)
    for i, w in enumerate(found):
        hashes[i, : len(w)] = w
    vocabulary = np.unique(hashes[np.arange(window) < lengths[:, None]]) if len(found) else np.zeros(0, np.uint64)
    return Phrases(vocabulary, np.searchsorted(vocabulary, hashes) + 2, lengths, hashes, list(found.values()))


def occurrences(words: np.ndarray, at: np.ndarray, p: Phrases) -> tuple[np.ndarray, np.ndarray]:
    """(word position, window number) of every occurrence of a window in the documents of one shard."""
    none = np.zeros(0, np.int64), np.zeros(0, np.int64)
    if not len(p.lengths) or not len(words):
        return none
    rank = np.minimum(np.searchsorted(p.vocabulary, words), len(p.vocabulary) - 1)
    symbol = np.where(p.vocabulary[rank] == words, rank + 2, 1)
    # separators between documents; runs of phrase words too short for any phrase shrink away
    known = np.zeros(len(words) + 2, bool)
    known[1:-1] = symbol > 1
    first = np.zeros(len(words) + 1, bool)
    first[at[(at < len(words))]] = True
    begins = np.flatnonzero(known[1:-1] & (~known[:-2] | first[:-1]))
    ends = np.flatnonzero(known[1:-1] & (~known[2:] | np.r_[first[1:-1], True])) + 1
    long = ends - begins >= p.lengths.min()
    begins, ends = begins[long], ends[long]
    if not len(begins):
        return none
    sizes = ends - begins + 1  # with a separator behind each stretch
    place = np.repeat(begins - np.r_[0, np.cumsum(sizes)[:-1]], sizes) + np.arange(sizes.sum())
    text = np.ones(len(place) + 1, np.int64)
    inside = np.ones(len(place), bool)
    inside[np.cumsum(sizes) - 1] = False
    text[:-1][inside] = symbol[place[inside]]
    text[-1] = 0
    index = FMIndex(text, len(p.vocabulary) + 1)
    low, high = index.search(p.symbols, p.lengths)
    n = high - low
    which = np.repeat(np.arange(len(n)), n)
    if not len(which):
        return none
    suffix = np.repeat(low - np.r_[0, np.cumsum(n)[:-1]], n) + np.arange(n.sum())
    where = place[index.locate(suffix)]
    # every occurrence is checked against the words themselves
    ok = np.ones(len(where), bool)
    for k in range(p.symbols.shape[1]):
        ask = np.flatnonzero(p.lengths[which] > k)
        ok[ask] &= words[where[ask] + k] == p.hashes[which[ask], k]
    return where[ok], which[ok]


def _runs(batches: Iterator[pa.RecordBatch], p: Phrases) -> Iterator[tuple]:
    """For each shard: its batch, word bounds, a hit mark per word and (document, item) pairs."""
    for b in slices(batches, limit=SHARD_BYTES):
        buf, off = text_buffers(b.column("text"))
        words, starts, ends, at = word_ids(buf, off)
        where, which = occurrences(words, at, p)
        edge = np.zeros(len(words) + 1, np.int64)
        np.add.at(edge, where, 1)
        np.add.at(edge, where + p.lengths[which], -1)
        hit = np.cumsum(edge)[:-1] > 0
        doc = np.searchsorted(at, where, "right") - 1
        owned: dict[int, set[int]] = {}
        for d, w in set(zip(doc.tolist(), which.tolist(), strict=True)):
            owned.setdefault(d, set()).update(p.owners[w])
        yield b, buf, off, starts, ends, at, hit, owned


def _blocks(benchmark: DataFrame, item_col: str, text_col: str) -> Iterator[list[tuple]]:
    """Test items in blocks of bounded bytes, fetched item by item: the driver holds the one block that is being searched."""
    block, size = [], 0
    rows = benchmark.select(F.col(item_col).cast("string").alias("item"), F.col(text_col).cast("string").alias("text")).where("item is not null and text is not null")
    for r in rows.toLocalIterator():
        if size + len(r["text"]) > BLOCK_BYTES and block:
            yield block
            block, size = [], 0
        block.append((r["item"], r["text"]))
        size += len(r["text"])
    yield block


def _few(blocks: Iterator[list[tuple]]) -> tuple[list[tuple] | None, Iterator[list[tuple]]]:
    """(the only block, or None where there are more; all blocks)."""
    first = next(blocks)
    second = next(blocks, None)
    return (first if second is None else None), itertools.chain([first], [] if second is None else [second], blocks)


def _spans(starts: np.ndarray, ends: np.ndarray, hit: np.ndarray) -> list[tuple[int, int]]:
    """Byte spans of runs of hit words, with what stands between the words of a run."""
    edges = np.diff(np.r_[0, hit.astype(np.int8), 0])
    return list(zip(starts[np.flatnonzero(edges == 1)].tolist(), ends[np.flatnonzero(edges == -1) - 1].tolist(), strict=True))


def contamination(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id", window: int = WINDOW) -> DataFrame:
    """(doc_id, n_words, n_hit, n_items, items_sha256, contaminated) for every row of `docs`.

    Words: A-Z lower-cased, runs of ASCII letters, digits and non-ASCII characters.
    An item's windows hold `window` words; an item of fewer, but not none, is
    one window. Null or empty texts have no words and no hits; items without
    words or id match nothing. Repeated rows are treated each for itself, null
    ids kept; other columns are ignored; an empty table gives no rows, an empty
    benchmark no hits.
    """
    docs = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    schema = "doc_id long, n_words long, n_hit long, n_items long, items_sha256 string, contaminated boolean"

    def whole(items):
        p = phrases_of([t for _, t in items], window)
        names = [i for i, _ in items]

        def run(batches):
            for b, _, _, _, _, at, hit, owned in _runs(batches, p):
                total = np.r_[0, np.cumsum(hit)]
                n_hit = total[at[1:]] - total[at[:-1]]
                own = [sorted({names[k] for k in owned.get(d, ())}) for d in range(b.num_rows)]
                yield pa.RecordBatch.from_pydict({
                    "doc_id": b.column("doc_id"),
                    "n_words": pa.array(np.diff(at)),
                    "n_hit": pa.array(n_hit.astype(np.int64)),
                    "n_items": pa.array([len(x) for x in own], pa.int64()),
                    "items_sha256": pa.array([hashlib.sha256(",".join(x).encode()).hexdigest() for x in own]),
                    "contaminated": pa.array(n_hit > 0),
                })

        return run

    only, blocks = _few(_blocks(benchmark, item_col, text_col))
    if only is not None:
        return arrow_map(docs, whole(only), schema)
    # a benchmark beyond one block: one search a block, then hit words and items meet by row
    keyed = materialize(docs.withColumn("row", F.monotonically_increasing_id()))

    def part(items):
        p = phrases_of([t for _, t in items], window)
        names = [i for i, _ in items]

        def run(batches):
            for b, _, _, _, _, at, hit, owned in _runs(batches, p):
                some = sorted(owned)
                yield pa.RecordBatch.from_pydict({
                    "row": b.column("row").take(pa.array(some, pa.int64())),
                    "hits": pa.array([np.flatnonzero(hit[at[d] : at[d + 1]]) for d in some], pa.list_(pa.int64())),
                    "items": pa.array([[names[k] for k in owned[d]] for d in some], pa.list_(pa.string())),
                })

        return run

    def count(batches):
        for b in slices(batches):
            yield pa.RecordBatch.from_pydict({"row": b.column("row"), "doc_id": b.column("doc_id"), "n_words": pa.array(np.diff(word_ids(*text_buffers(b.column("text")))[3]))})

    found = None
    for items in blocks:
        one = materialize(arrow_map(keyed, part(items), "row long, hits array<long>, items array<string>"))
        found = one if found is None else found.union(one)
    found = found.groupBy("row").agg(F.array_distinct(F.flatten(F.collect_list("hits"))).alias("hits"), F.array_sort(F.array_distinct(F.flatten(F.collect_list("items")))).alias("items"))
    items = F.coalesce("items", F.array().cast("array<string>"))
    out = arrow_map(keyed, count, "row long, doc_id long, n_words long").join(found, "row", "left")
    return out.select("doc_id", "n_words", F.coalesce(F.size("hits"), F.lit(0)).cast("long").alias("n_hit"), F.size(items).cast("long").alias("n_items"), F.sha2(F.array_join(items, ","), 256).alias("items_sha256"), F.col("hits").isNotNull().alias("contaminated"))


def decontaminate(docs: DataFrame, benchmark: DataFrame, text_col: str = "text", item_col: str = "item_id", window: int = WINDOW) -> DataFrame:
    """`docs` with the merged spans of hit words cut out of `text_col` (a line feed stands for each).

    Documents without hits, null and empty texts stay as they are; all rows and
    columns are kept. A benchmark beyond one block is searched block by block in
    the unchanged texts, and the hit words of all blocks are cut at once.
    """
    schema = docs.schema
    named = lambda bs: (b.rename_columns([f"c{i}" if c != text_col else "text" for i, c in enumerate(b.schema.names)]) for b in bs)

    def without(raw, starts, ends, hit):
        cut, out = 0, []
        for x, y in _spans(starts, ends, hit):
            out.append(raw[cut:x])
            cut = y
        out.append(raw[cut:])
        return b"\n".join(out).decode()

    only, blocks = _few(_blocks(benchmark, item_col, "text"))
    if only is not None:
        p = phrases_of([t for _, t in only], window)

        def run(batches):
            for b, buf, off, starts, ends, at, hit, owned in _runs(named(batches), p):
                col = b.column("text")
                if owned:
                    texts = col.to_pylist()
                    for d in owned:
                        mine = slice(at[d], at[d + 1])
                        texts[d] = without(buf[off[d] : off[d + 1]].tobytes(), starts[mine] - off[d], ends[mine] - off[d], hit[mine])
                    col = pa.array(texts, col.type)
                yield pa.RecordBatch.from_arrays([col if n == "text" else c for n, c in zip(b.schema.names, b.columns, strict=True)], schema.names)

        return arrow_map(docs, run, schema)
    # one search a block over the same rows, then hit words meet by row
    fresh = lambda name: next(n for k in range(len(docs.columns) + 1) if (n := f"__{name}{k}") not in docs.columns)
    row, words = fresh("row"), fresh("hits")
    keyed = materialize(docs.withColumn(row, F.monotonically_increasing_id()))
    texts_only = keyed.select(F.col(row).alias("row"), F.col(text_col).cast("string").alias("text"))

    def part(items):
        p = phrases_of([t for _, t in items], window)

        def run(batches):
            for b, _, _, _, _, at, hit, owned in _runs(batches, p):
                some = sorted(owned)
                yield pa.RecordBatch.from_pydict({"row": b.column("row").take(pa.array(some, pa.int64())), "hits": pa.array([np.flatnonzero(hit[at[d] : at[d + 1]]) for d in some], pa.list_(pa.int64()))})

        return run

    found = None
    for items in blocks:
        one = materialize(arrow_map(texts_only, part(items), "row long, hits array<long>"))
        found = one if found is None else found.union(one)
    found = found.groupBy(F.col("row").alias(row)).agg(F.array_distinct(F.flatten(F.collect_list("hits"))).alias(words))

    def cut(batches):
        for b in slices(named(batches), limit=SHARD_BYTES):
            col, hits = b.column("text"), b.column(b.num_columns - 1).to_pylist()
            if any(h is not None for h in hits):
                buf, off = text_buffers(col)
                _, starts, ends, at = word_ids(buf, off)
                texts = col.to_pylist()
                for d, h in enumerate(hits):
                    if h is not None:
                        mine = slice(at[d], at[d + 1])
                        hit = np.zeros(at[d + 1] - at[d], bool)
                        hit[h] = True
                        texts[d] = without(buf[off[d] : off[d + 1]].tobytes(), starts[mine] - off[d], ends[mine] - off[d], hit)
                col = pa.array(texts, col.type)
            yield pa.RecordBatch.from_arrays([col if n == "text" else c for n, c in zip(b.schema.names, b.columns, strict=True)][: len(schema.names)], schema.names)

    return arrow_map(keyed.join(found, row, "left").drop(row), cut, schema)


def contamination_sql(window: int = WINDOW) -> str:
    """The same by joining windows as texts, for DuckDB; ids are unique."""
    words = "regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+')"
    return f"""
WITH d AS (SELECT doc_id, {words} AS w FROM documents), b AS (SELECT CAST(item_id AS VARCHAR) AS item, {words} AS w FROM benchmark WHERE item_id IS NOT NULL),
asked AS (SELECT DISTINCT item, least(len(w), {window}) AS n, array_to_string(w[i : i + {window} - 1], ' ') AS x FROM (SELECT item, w, unnest(range(1, greatest(len(w) - {window}, 0) + 2)) AS i FROM b WHERE len(w) > 0)),
sizes AS (SELECT DISTINCT n FROM asked),
places AS (SELECT doc_id, n, i, array_to_string(w[i : i + n - 1], ' ') AS x FROM (SELECT doc_id, w, n, unnest(range(1, CAST(len(w) - n + 2 AS BIGINT))) AS i FROM d, sizes WHERE len(w) >= n)),
found AS (SELECT doc_id, item, i, p.n FROM places p JOIN asked a ON a.n = p.n AND a.x = p.x),
hit AS (SELECT doc_id, count(DISTINCT k) AS n_hit FROM (SELECT doc_id, unnest(range(i, CAST(i + n AS BIGINT))) AS k FROM found) GROUP BY 1),
own AS (SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items FROM (SELECT DISTINCT doc_id, item FROM found) GROUP BY 1)
SELECT d.doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items, sha256(coalesce(items, '')) AS items_sha256, n_hit IS NOT NULL AS contaminated
FROM d LEFT JOIN hit USING (doc_id) LEFT JOIN own USING (doc_id)"""
