"""Shared plumbing of the corpus operators: checkpoints, Arrow slices, byte-level word scanning."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from pathlib import Path

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Bytes of text that one vectorised pass holds (a longer single text forms a pass of its own).
SLICE_BYTES = 1_000_000
#: Bytes and rows of an Arrow batch on its way to a Python worker.
BATCH_BYTES, BATCH_ROWS = 4_000_000, 1000

_RNG = np.random.default_rng(20240607)
_TABLE = _RNG.integers(1, 2**63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_BASE = 0x9E3779B97F4A7C15 | 1
_INV = pow(_BASE, -1, 2**64)
_powers: dict[int, tuple[np.ndarray, np.ndarray]] = {}


def shared_dir(spark: SparkSession) -> None:
    """Set the checkpoint directory the cluster names; one of our own only in a local session that names none (as in tests)."""
    if spark.sparkContext._jsc.sc().getCheckpointDir().isEmpty():
        named = spark.conf.get("spark.checkpoint.dir", None)
        if not named and not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that driver and executors share")
        spark.sparkContext.setCheckpointDir(named or tempfile.mkdtemp(prefix="tallyfold-ckpt-"))


def ship(spark: SparkSession) -> None:
    """Let Python workers find this package where only the driver has it on its path (local runs)."""
    root = str(Path(__file__).resolve().parents[2])
    have = spark.sparkContext.environment.get("PYTHONPATH", "")
    if root not in have.split(":"):
        spark.sparkContext.environment["PYTHONPATH"] = f"{root}:{have}".rstrip(":")


def arrow_map(df: DataFrame, fn, schema: str) -> DataFrame:
    """mapInArrow with small batches: two workers and their executor share little memory. A session's own settings stay."""
    spark = df.sparkSession
    ship(spark)
    for key, value in (("maxRecordsPerBatch", BATCH_ROWS), ("maxBytesPerBatch", BATCH_BYTES)):
        if spark.conf.get(f"spark.sql.execution.arrow.{key}", None) is None:
            spark.conf.set(f"spark.sql.execution.arrow.{key}", str(value))
    return df.mapInArrow(fn, schema)


def materialize(df: DataFrame) -> DataFrame:
    """Cut the lineage into the shared checkpoint directory; survives the loss of executors."""
    shared_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def staged(df: DataFrame, name: str) -> DataFrame:
    """The rows of df, written once as compressed Parquet into the shared folder and read back; smaller than a checkpoint where rows hold texts."""
    df.write.option("compression", "zstd").parquet(path := f"{shared_uri(df.sparkSession)}/{name}-{uuid.uuid4().hex}")
    return df.sparkSession.read.parquet(path)


def shared_uri(spark: SparkSession) -> str:
    """The checkpoint folder with all the slashes that a URI has."""
    shared_dir(spark)
    folder = spark.sparkContext._jsc.sc().getCheckpointDir().get()
    return f"file:///{folder[5:].lstrip('/')}" if folder.startswith("file:") else folder


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def text_buffers(col: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, offsets of n + 1) of a string column; null counts as empty."""
    if isinstance(col, pa.ChunkedArray):
        col = col.combine_chunks()
    col = col.cast(pa.large_binary()).fill_null(b"")
    off = np.frombuffer(col.buffers()[1], np.int64)[col.offset : col.offset + len(col) + 1]
    data = col.buffers()[2]
    buf = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return buf[off[0] : off[-1]], off - off[0]


def slices(batches: Iterator[pa.RecordBatch], column: str = "text", limit: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """Cut Arrow batches so that each holds about `limit` bytes of text."""
    for batch in batches:
        if not batch.num_rows:
            continue
        _, off = text_buffers(batch.column(column))
        at = 0
        while at < batch.num_rows:
            to = int(np.searchsorted(off, off[at] + limit, "right")) - 1
            to = max(to, at + 1)
            yield batch.slice(at, to - at)
            at = to


def _power(n: int) -> tuple[np.ndarray, np.ndarray]:
    have = _powers.get(0)
    if have is None or len(have[0]) < n:
        size = max(n, SLICE_BYTES + 1)
        with np.errstate(over="ignore"):
            b = np.full(size, _BASE, np.uint64)
            b[0] = 1
            i = np.full(size, _INV, np.uint64)
            i[0] = 1
            have = (np.multiply.accumulate(b), np.multiply.accumulate(i))
        if size <= 2 * SLICE_BYTES:
            _powers[0] = have
    return have


def mix(h: np.ndarray) -> np.ndarray:
    """Finalizer: every input bit reaches every output bit."""
    h = (h ^ (h >> np.uint64(33))) * np.uint64(0xFF51AFD7ED558CCD)
    h = (h ^ (h >> np.uint64(33))) * np.uint64(0xC4CEB9FE1A85EC53)
    return h ^ (h >> np.uint64(33))


def prefix_hash(buf: np.ndarray) -> np.ndarray:
    """P with P[j] - P[i] = sum of table[byte k] * base**k over i <= k < j, modulo 2**64."""
    out = np.zeros(len(buf) + 1, np.uint64)
    if len(buf):
        np.cumsum(_TABLE[buf] * _power(len(buf) + 1)[0][: len(buf)], out=out[1:])
    return out


def span_hash(prefix: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Place-independent 64-bit hash of each byte span."""
    return mix((prefix[ends] - prefix[starts]) * _power(len(prefix))[1][starts] + (ends - starts).astype(np.uint64))


def word_table(separators: set[int] | None = None) -> np.ndarray:
    """True where a byte belongs to a word."""
    t = np.ones(256, bool)
    t[list(separators)] = False
    return t


#: Bytes of `[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]` after A-Z are lower-cased; every non-ASCII code point counts as part of a word.
ALNUM = word_table({b for b in range(128) if not chr(b).isalnum()})
#: Bytes of `[^\\x20\\x09-\\x0D]`.
NONSPACE = word_table({0x20, *range(0x09, 0x0E)})
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32


def scan_words(buf: np.ndarray, off: np.ndarray, table: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(starts, ends, words before each of the n + 1 document offsets); words never cross documents."""
    w = table[buf]
    before = np.zeros(len(w) + 1, bool)
    before[1:] = w
    after = np.zeros(len(w) + 1, bool)
    after[:-1] = w
    first, last = before.copy(), after.copy()
    first[off] = False
    last[off] = False
    starts = np.flatnonzero(after[:-1] & ~first[:-1])
    ends = np.flatnonzero(before[1:] & ~last[1:]) + 1
    return starts, ends, np.searchsorted(starts, off)


def heavy_light(left: DataFrame, right: DataFrame, key: str, count: str, how: str = "inner", most: int = 1000) -> DataFrame:
    """Join rows of `left` to the unique key of `right`, hot keys apart.

    `right[count]` is the number of rows in `left` that carry the key. At most
    `most` keys can each hold a `most`-th of all rows, so those (and only those)
    are broadcast: the broadcast is bounded whatever the data are. Every other
    key goes through a shuffled join, where none holds more than that share.
    `left` should be cheap to read twice (materialized). `how`: inner or left.
    """
    total = left.count()
    cut = max(2, total // most + 1)
    heavy = right.filter(F.col(count) >= cut)
    light = right.filter(F.col(count) < cut)
    hot = left.join(F.broadcast(heavy), key, "inner")
    rest = left.join(F.broadcast(heavy.select(key)), key, "left_anti").join(light, key, how)
    return hot.unionByName(rest)
