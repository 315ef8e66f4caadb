"""Best-two-fit packing of token pieces into sequences of bounded length.

Piece lengths lie in 1..max_tokens, so the whole packing problem is a histogram
of at most max_tokens counts, whatever the corpus holds. The driver packs that
histogram: a bin is filled greedily by best fit, then its smallest piece is
replaced by two unpacked ones where they fill a widened gap more tightly; the
pattern found is repeated as often as its counts last. Rows find their place by
their rank among pieces of equal length: a count for each (length, bucket),
prefix sums over buckets, and a rank inside each bucket. No group of equal
lengths meets in one task and nothing that grows with the corpus is collected.
"""

from __future__ import annotations

import base64
import zlib
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import arrow_map, materialize, slices

MAX_TOKENS = 1024
END_OF_TEXT = 2
#: Rows of one (length, bucket) group that one task ranks, about.
RANK_ROWS = 100_000
#: Gaps that are left as they are, one packing for each.
SLACKS = (0, 1, 2, 4, 8, 16, 32, 64, 128, 256)


class Encoder:
    """Token ids of whole texts as little-endian unsigned 32-bit bytes.

    Texts of Latin letters go through the same vocabulary as ranks, which gives
    equal ids three times as fast; any other script, and texts that hold the
    string of an added token, go through `tokenizers`.
    """

    def __init__(self, vocabulary: str, ranks: str | None = None):
        import public_tokenizers
        import tiktoken
        from tokenizers import Tokenizer

        with open(ranks or vocabulary.removesuffix(".json") + ".tiktoken", "rb") as f:
            table = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
        self.ranks = tiktoken.Encoding("ranks", pat_str=public_tokenizers.PATTERN, mergeable_ranks=table, special_tokens={})
        self.tokenizer = Tokenizer.from_file(vocabulary)
        self.added = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]  # found in texts, which ranks do not do

    def __call__(self, texts: list[str]) -> list[bytes]:
        return [self.one(t) for t in texts]

    def one(self, text: str) -> bytes:
        if max(text, default="") < "\u0250" and not any(a in text for a in self.added):
            return self.ranks.encode_to_numpy(text, disallowed_special=()).astype("<u4").tobytes()
        return np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, "<u4").tobytes()


@lru_cache(1)
def encoder(vocabulary: str) -> Encoder:
    import os

    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    return Encoder(vocabulary)


def vocabulary_path(name: str = "byte_bpe_50k.json") -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def token_pieces(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", max_tokens: int = MAX_TOKENS, vocabulary: str | None = None) -> DataFrame:
    """(doc_id, piece, start, length, ids_crc32) of every document, cut where it is longer than max_tokens."""
    docs = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    end = np.array([END_OF_TEXT], "<u4").tobytes()

    def run(batches):
        encode = encoder(vocabulary or vocabulary_path())
        for b in slices(batches, limit=1_000_000):
            rows = []
            for i, ids in zip(b.column("doc_id").to_pylist(), encode([t or "" for t in b.column("text").to_pylist()]), strict=True):
                ids += end
                n = len(ids) // 4
                at, first = 0, (n - 1) % max_tokens + 1
                for piece in range(-(-n // max_tokens)):
                    to = first + piece * max_tokens
                    rows.append((i, piece, at, to - at, zlib.crc32(ids[4 * at : 4 * to])))
                    at = to
            cols = list(zip(*rows, strict=True))
            yield pa.RecordBatch.from_arrays([pa.array(cols[0], pa.int64()), pa.array(cols[1], pa.int32()), *[pa.array(c, pa.int64()) for c in cols[2:]]], ["doc_id", "piece", "start", "length", "ids_crc32"])

    return arrow_map(docs, run, "doc_id long, piece int, start long, length long, ids_crc32 long")


def pack_histogram(counts: dict[int, int], size: int) -> list[tuple[list[int], int]]:
    """[(lengths of one bin, largest first; bins of this kind)] by best-two-fit.

    Swaps use up small pieces that later bins may need more, so the packing is
    made once for each of SLACKS, and the one of the fewest bins counts.
    """
    return min((best_two_fit(counts, size, slack) for slack in SLACKS), key=lambda bins: sum(times for _, times in bins))


def best_two_fit(counts: dict[int, int], size: int, slack: int) -> list[tuple[list[int], int]]:
    """One packing, with swaps in bins whose gap exceeds `slack`.

    Each step uses up some length, so there are at most a few steps per length.
    """
    left = np.zeros(size + 1, np.int64)
    for length, n in counts.items():
        left[length] = n
    out: list[tuple[list[int], int]] = []
    top = size
    while True:
        while top and not left[top]:
            top -= 1
        if not top:
            return out
        used: dict[int, int] = {}

        def take(length: int, n: int = 1) -> None:
            used[length] = used.get(length, 0) + n
            left[length] -= n

        take(top)
        gap = size - top
        while gap:
            fit = np.flatnonzero(left[1 : gap + 1])
            if not len(fit):
                break
            take(int(fit[-1]) + 1)
            gap -= int(fit[-1]) + 1
        if gap > slack and sum(used.values()) > 1:
            small = min(used)
            room = gap + small
            have = np.flatnonzero(left[: room + 1])
            best = (small, 0, 0)
            if len(have):
                # for each first piece the longest second one that still fits; equal lengths need two of them
                mate = np.searchsorted(have, room - have, "right") - 1
                for a, m in zip(have.tolist(), mate.tolist(), strict=True):
                    b = int(have[m]) if m >= 0 else 0
                    if b == a and left[a] < 2:
                        b = int(have[m - 1]) if m > 0 else 0
                    if b and a + b > best[0]:
                        best = (a + b, a, b)
            if best[1]:
                used[small] -= 1
                left[small] += 1
                if not used[small]:
                    del used[small]
                take(best[1])
                take(best[2])
        times = 1 + min(int(left[length]) // n for length, n in used.items())
        for length, n in used.items():
            left[length] -= n * (times - 1)
        out.append(([length for length in sorted(used, reverse=True) for _ in range(used[length])], times))


def pack(pieces: DataFrame, max_tokens: int = MAX_TOKENS) -> DataFrame:
    """Adds sequence_id and offset to pieces(doc_id, piece, length, ...), lengths 1..max_tokens.

    Sequences are gapless from offset 0. `pieces` must be materialized (it is
    read several times, and its rows are numbered where they lie). Equal rows get places of their own. No row is dropped.
    """
    spark = pieces.sparkSession
    cols = pieces.columns
    histogram = {r["length"]: r["n"] for r in pieces.groupBy("length").agg(F.count("*").alias("n")).collect()}  # at most max_tokens rows
    rows, base = [], 0
    done = dict.fromkeys(histogram, 0)
    for lengths, times in pack_histogram(histogram, max_tokens):
        at = 0
        for length in dict.fromkeys(lengths):
            k = lengths.count(length)
            rows.append((length, done[length], done[length] + k * times, k, base, at))
            done[length] += k * times
            at += k * length
        base += times
    buckets = max(1, -(-max(histogram.values(), default=1) // RANK_ROWS))
    # a row's number is in the hash: rows alike in all else are dealt too
    keyed = pieces.withColumn("_bucket", F.pmod(F.xxhash64(F.monotonically_increasing_id(), "doc_id", "piece", "start"), F.lit(buckets)))
    sums = keyed.groupBy("length", "_bucket").agg(F.count("*").alias("_n"))
    before = sums.withColumn("_before", F.sum("_n").over(Window.partitionBy("length").orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1))).select("length", "_bucket", F.coalesce("_before", F.lit(0)).alias("_before"))
    inside = Window.partitionBy("length", "_bucket").orderBy("doc_id", "piece", "ids_crc32") if "ids_crc32" in cols else Window.partitionBy("length", "_bucket").orderBy("doc_id", "piece")
    ranked = keyed.withColumn("_in", F.row_number().over(inside) - 1)
    ranked = ranked.join(before, ["length", "_bucket"]) if buckets > 1 else ranked.withColumn("_before", F.lit(0))
    ranked = ranked.withColumn("_rank", F.col("_in") + F.col("_before"))
    # a few runs for each of at most max_tokens lengths: bounded whatever the corpus holds
    runs = spark.createDataFrame(rows, "length long, _from long, _to long, _k long, _base long, _at long")
    runs = runs.groupBy("length").agg(F.array_sort(F.collect_list(F.struct("_from", "_to", "_k", "_base", "_at"))).alias("_runs"))
    out = ranked.join(F.broadcast(runs), "length").withColumn("_run", F.expr("element_at(filter(_runs, r -> _rank >= r._from and _rank < r._to), 1)"))
    nth = F.col("_rank") - F.col("_run._from")
    return out.select(*cols, (F.col("_run._base") + F.floor(nth / F.col("_run._k"))).cast("long").alias("sequence_id"), (F.col("_run._at") + F.pmod(nth, F.col("_run._k")) * F.col("length")).cast("long").alias("offset"))


def pack_documents(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", max_tokens: int = MAX_TOKENS, vocabulary: str | None = None) -> DataFrame:
    """One row per piece: doc_id, piece, start, length, ids_crc32, sequence_id, offset.

    A null text counts as empty and still yields one piece (the end-of-text id).
    Rows that repeat a document are packed each for itself; null ids are kept.
    Very long texts are encoded whole. An empty table gives no rows; other
    columns are ignored.
    """
    return pack(materialize(token_pieces(docs, id_col, text_col, max_tokens, vocabulary)), max_tokens)
