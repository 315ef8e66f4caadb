"""Cross-tokenizer alignment: two tokenizers' tokens of the same text, grouped at the bytes where both end one.

Each tokenizer marks the byte offsets where its tokens end in a packed bitset
of 64-bit words. The AND of both holds the shared cuts; running popcounts turn a
cut's byte offset into token ranks on either side (rank), and set bits give the
cuts in order (select). Within a group every stretch between neighbouring ends
of the OR belongs to one token of either side, so those stretches, ranked on
both sides, are the links.

How many documents hold a pair of ids linked is counted over the whole corpus.
Texts travel as blocks of some MB: each lists its distinct pairs once, with the
number of its documents that hold them, so even a pair found in every document
is met once a block in the shuffles, and each block gets the counts of its own
pairs back.
"""

from __future__ import annotations

import hashlib
from dataclasses import dataclass
from functools import cached_property, lru_cache

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import arrow_map, ship, slices, staged
from .packing import Encoder, vocabulary_path

#: Bytes of text of one block; a longer single text forms a block of its own.
BLOCK_BYTES = 4_000_000
_U = np.uint64


class Pair:
    """Both tokenizers, the bytes of each id, and the ids' decimal digits."""

    def __init__(self, vocabulary: str, pieces: str):
        import os

        import sentencepiece

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        self.a = Encoder(vocabulary)
        self.a.added, self.a.tokenizer.encode_special_tokens = [], True  # their strings in texts are ordinary text
        self.b = sentencepiece.SentencePieceProcessor(model_file=pieces)
        byte = _byte_level()
        self.bytes_a = [_decoded(self.a.tokenizer.id_to_token(i) or "", byte) for i in range(self.a.tokenizer.get_vocab_size())]
        self.bytes_b = [bytes([int(p[3:5], 16)]) if self.b.is_byte(i) else p.replace("▁", " ").encode() for i in range(self.b.get_piece_size()) for p in [self.b.id_to_piece(i)]]
        self.len_a, self.len_b = (np.array([len(x) for x in t], np.int64) for t in (self.bytes_a, self.bytes_b))
        n = max(len(self.bytes_a), len(self.bytes_b))
        self.digits = np.frombuffer(b"".join(str(i).encode().ljust(len(str(n)), b"\0") for i in range(n)), np.uint8).reshape(n, -1)

    def tokens(self, text: str | None) -> tuple[np.ndarray, np.ndarray] | None:
        """(ids of A, ids of B), or None where there are none."""
        if not text:
            return None
        a = np.frombuffer(self.a.one(f" {text}"), "<u4").astype(np.int64)
        b = self.b.encode(text)
        raw = f" {text}".encode()
        if b"".join([self.bytes_b[i] for i in b]) != raw or b"".join([self.bytes_a[i] for i in a.tolist()]) != raw:
            return None
        return a, np.array(b, np.int64)


def _byte_level() -> dict[str, int]:
    """The byte that each sign of a byte-level vocabulary stands for: printable ones for themselves, others from U+0100 on."""
    shown = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in set(shown)]
    return {chr(b): b for b in shown} | {chr(0x100 + k): b for k, b in enumerate(rest)}


def _decoded(entry: str, byte: dict[str, int]) -> bytes:
    return bytes(byte[c] for c in entry) if all(c in byte for c in entry) else entry.encode()


@lru_cache(1)
def pair(vocabulary: str, pieces: str) -> Pair:
    return Pair(vocabulary, pieces)


class Bits:
    """A packed bitset with rank and select."""

    def __init__(self, words: np.ndarray):
        self.words = words
        self.before = np.concatenate([[0], np.cumsum(np.bitwise_count(words), dtype=np.int64)])

    @classmethod
    def at(cls, places: np.ndarray, n: int) -> Bits:
        bits = np.zeros(-(-n // 64) * 64, bool)
        bits[places] = True
        return cls(np.packbits(bits, bitorder="little").view("<u8"))

    def rank(self, places: np.ndarray) -> np.ndarray:
        """Set bits before each place."""
        word = places >> 6
        below = self.words[word] & ((_U(1) << (places & 63).astype(_U)) - _U(1))
        return self.before[word] + np.bitwise_count(below)

    def select(self) -> np.ndarray:
        """Places of all set bits, in order."""
        return np.flatnonzero(np.unpackbits(self.words.view(np.uint8), bitorder="little"))


@dataclass
class Aligned:
    """Tokens of some texts one after the other; `rows` numbers the texts that have tokens, `last` is the last byte of each."""

    rows: np.ndarray
    last: np.ndarray
    a: np.ndarray
    b: np.ndarray
    bits_a: Bits
    bits_b: Bits

    @cached_property
    def shared(self) -> Bits:
        return Bits(self.bits_a.words & self.bits_b.words)

    @cached_property
    def either(self) -> Bits:
        return Bits(self.bits_a.words | self.bits_b.words)

    def per_text(self, bits: Bits) -> np.ndarray:
        """Set bits inside each text."""
        return np.diff(bits.rank(self.last) + 1, prepend=0)

    def links(self) -> tuple[np.ndarray, np.ndarray]:
        """(token of A, token of B) of every link, as numbers over all texts."""
        ends = self.either.select()
        return self.bits_a.rank(ends), self.bits_b.rank(ends)

    def groups(self) -> tuple[np.ndarray, np.ndarray]:
        """Tokens of A and of B up to the end of each group."""
        cuts = self.shared.select()
        return self.bits_a.rank(cuts) + 1, self.bits_b.rank(cuts) + 1

    def written(self, digits: np.ndarray) -> list[memoryview]:
        """`a1,a2|b1;a3|b2,b3` of each text: ids in order, groups parted by a semicolon."""
        to_a, to_b = self.groups()
        from_a, from_b = np.concatenate([[0], to_a[:-1]]), np.concatenate([[0], to_b[:-1]])
        group_a, group_b = (np.repeat(np.arange(len(x)), np.diff(x, prepend=0)) for x in (to_a, to_b))
        place_a, place_b = np.arange(len(self.a)) + from_b[group_a], np.arange(len(self.b)) + to_a[group_b]
        n = len(self.a) + len(self.b)
        out = np.zeros((n, 1 + digits.shape[1]), np.uint8)
        out[place_a, 1:], out[place_b, 1:] = digits[self.a], digits[self.b]
        out[:, 0] = ord(",")
        out[place_a[from_a], 0], out[place_b[from_b], 0] = ord(";"), ord("|")
        size = np.count_nonzero(out, axis=1)
        end = np.concatenate([[0], np.cumsum(size)])
        flat = memoryview(out[out != 0])
        tokens = np.cumsum(self.per_text(self.bits_a) + self.per_text(self.bits_b))
        return [flat[end[i] + 1 : end[j]] for i, j in zip(np.concatenate([[0], tokens[:-1]]), tokens, strict=True)]


def aligned(texts: list[str | None], tok: Pair) -> Aligned | None:
    """Tokens and end bits of the texts that have tokens; None if none has."""
    found = [(i, t) for i, x in enumerate(texts) if (t := tok.tokens(x))]
    if not found:
        return None
    a, b = (np.concatenate([t[k] for _, t in found]) for k in (0, 1))
    ends_a, ends_b = np.cumsum(tok.len_a[a]) - 1, np.cumsum(tok.len_b[b]) - 1
    n = int(ends_a[-1]) + 1
    last = ends_a[np.cumsum([len(t[0]) for _, t in found]) - 1]
    return Aligned(np.array([i for i, _ in found]), last, a, b, Bits.at(ends_a, n), Bits.at(ends_b, n))


def _read(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    return docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))


def _pair(vocabulary: str | None, pieces: str | None) -> Pair:
    return pair(vocabulary or vocabulary_path(), pieces or vocabulary_path("piece_bpe_32k.model"))


def token_groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", vocabulary: str | None = None, pieces: str | None = None) -> DataFrame:
    """(doc_id, a, b, a_ends, b_ends): ids of both sides, and for each group how many tokens of A and of B lie up to its end.

    Rows as in `link_statistics`; texts without tokens have empty lists.
    """

    def run(batches):
        tok = _pair(vocabulary, pieces)
        for batch in slices(batches, limit=BLOCK_BYTES // 4):
            out = [([], [], [], []) for _ in range(batch.num_rows)]
            if got := aligned(batch.column("text").to_pylist(), tok):
                ends = got.groups()
                at = [np.concatenate([[0], np.cumsum(got.per_text(x))]) for x in (got.bits_a, got.bits_b, got.shared)]
                for k, i in enumerate(got.rows):
                    (a, to_a), (b, to_b), (g, to_g) = ((x[k], x[k + 1]) for x in at)
                    out[i] = (got.a[a:to_a], got.b[b:to_b], ends[0][g:to_g] - a, ends[1][g:to_g] - b)
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), *[pa.array(c, pa.list_(pa.int32())) for c in zip(*out, strict=True)]], ["doc_id", "a", "b", "a_ends", "b_ends"])

    return arrow_map(_read(docs, id_col, text_col), run, "doc_id long, a array<int>, b array<int>, a_ends array<int>, b_ends array<int>")


_DOCS = pa.struct([("doc_id", pa.int64()), ("n_a", pa.int64()), ("n_b", pa.int64()), ("n_groups", pa.int64()), ("n_links", pa.int64()), ("groups_sha256", pa.string()), ("n_pairs", pa.int32())])


def _block(batch: pa.RecordBatch, tok: Pair, number: int) -> pa.RecordBatch:
    """One row: the block's documents, its distinct pairs with their documents, and which pairs each document links how often."""
    n = batch.num_rows
    counts = np.zeros((5, n), np.int64)
    digests = [""] * n
    pairs, held, codes, times = (np.zeros(0, np.int64) for _ in range(4))
    if got := aligned(batch.column("text").to_pylist(), tok):
        counts[:4, got.rows] = [got.per_text(x) for x in (got.bits_a, got.bits_b, got.shared, got.either)]
        for i, text in zip(got.rows, got.written(tok.digits), strict=True):
            digests[i] = hashlib.sha256(text).hexdigest()
        from_a, from_b = got.links()
        width = len(tok.len_a) * len(tok.len_b)
        key = np.repeat(got.rows, counts[3, got.rows]) * width + got.a[from_a] * len(tok.len_b) + got.b[from_b]
        key, times = np.unique(key, return_counts=True)
        counts[4] = np.bincount(key // width, minlength=n)
        pairs, codes, held = np.unique(key % width, return_inverse=True, return_counts=True)
    docs = pa.StructArray.from_arrays([batch.column("doc_id"), *[pa.array(c) for c in counts[:4]], pa.array(digests, pa.string()), pa.array(counts[4].astype(np.int32))], fields=list(_DOCS))
    links = np.concatenate([codes, times]).astype("<u4").view(np.uint8).reshape(-1, 4).T.tobytes()  # bytes of like weight side by side shrink best
    one = lambda x, kind: pa.ListArray.from_arrays(pa.array([0, len(x)], pa.int32()), x if isinstance(x, pa.Array) else pa.array(x, kind))
    return pa.RecordBatch.from_arrays([pa.array([number], pa.int64()), one(docs, None), one(pairs, pa.int64()), one(held, pa.int32()), pa.array([pa.compress(links, "zstd", asbytes=True)], pa.binary()), pa.array([len(links)], pa.int64())], ["block", "docs", "pairs", "held", "links", "links_bytes"])


_BLOCK = "block long, docs array<struct<doc_id long, n_a long, n_b long, n_groups long, n_links long, groups_sha256 string, n_pairs int>>, pairs array<long>, held array<int>, links binary, links_bytes long"


def _scored(blocks: pa.Table, found: pa.Table) -> pa.Table:
    """Documents of one block with the sums over their links. `found`: the block's pairs by their place, with count and whether it is their A id's highest."""
    found = found.sort_by("place")
    count, best = found["count"].to_numpy(), found["best"].to_numpy().astype(np.int64)
    out = []
    for row in blocks.to_batches():
        for i in range(row.num_rows):
            docs = pa.RecordBatch.from_struct_array(row.column("docs")[i].values)
            size = row.column("links_bytes")[i].as_py()
            links = pa.decompress(row.column("links")[i].as_py(), size, "zstd", asbytes=True) if size else b""
            codes, times = np.ascontiguousarray(np.frombuffer(links, np.uint8).reshape(4, -1).T).view("<u4").reshape(2, -1).astype(np.int64)
            ends = np.concatenate([[0], np.cumsum(docs.column("n_pairs").to_numpy())])
            sums = [np.diff(np.concatenate([[0], np.cumsum(x)])[ends]) for x in (times * best[codes], times * count[codes])]
            out.append(pa.table([docs.column(c) for c in ("doc_id", "n_a", "n_b", "n_groups", "n_links")] + [pa.array(x) for x in sums] + [docs.column("groups_sha256")], names=["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]))
    return pa.concat_tables(out)


def blocks_of(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", vocabulary: str | None = None, pieces: str | None = None) -> DataFrame:
    """Aligned blocks of some MB of text, written once into the shared folder and read back."""

    def run(batches):
        tok = _pair(vocabulary, pieces)
        first = TaskContext.get().partitionId() << 33
        for k, batch in enumerate(slices(batches, limit=BLOCK_BYTES)):
            yield _block(batch, tok, first + k)

    return staged(arrow_map(_read(docs, id_col, text_col), run, _BLOCK), "alignment")


def pair_counts(blocks: DataFrame, n_b: int) -> DataFrame:
    """(pair, count, best): documents that hold each pair (A id * n_b + B id) linked, and whether no pair of its A id has more.

    The window of an A id holds at most n_b rows.
    """
    pairs = blocks.select(F.explode(F.arrays_zip("pairs", "held")).alias("p")).groupBy(F.col("p.pairs").alias("pair")).agg(F.sum("p.held").alias("count"))
    own = Window.partitionBy(F.expr(f"pair div {n_b}"))
    return pairs.withColumn("best", F.col("count") == F.max("count").over(own))


def link_statistics(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", vocabulary: str | None = None, pieces: str | None = None) -> DataFrame:
    """(doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256), one row for each row of docs.

    Null and empty texts, and texts that either side does not give back byte by
    byte, have no tokens: zeros and an empty digest. Every row is a document of
    its own, so rows with a repeated or null id each count and each come back;
    equal counts all are the highest; extra columns are ignored whatever their
    names; an empty table gives an empty one. Whole texts are read: one longer
    than a block forms a block, whose arrays take some 300 bytes of memory a
    byte of text at the most.
    """
    spark = docs.sparkSession
    ship(spark)
    n_b = len(_pair(vocabulary, pieces).len_b)
    blocks = blocks_of(docs, id_col, text_col, vocabulary, pieces)
    own = blocks.select("block", F.posexplode("pairs").alias("place", "pair"))
    found = own.join(pair_counts(blocks, n_b), "pair").select(F.col("block").alias("of"), "place", "count", "best")
    schema = "doc_id long, n_a long, n_b long, n_groups long, n_links long, n_best long, count_sum long, groups_sha256 string"
    return blocks.groupBy("block").cogroup(found.groupBy("of")).applyInArrow(_scored, schema)
