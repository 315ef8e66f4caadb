"""Toxicity grades by cumulative-link ordinal regression on sparse text features.

Features are hashed lower-cased words and word beginnings of MIN_PREFIX to
MAX_PREFIX bytes; a value is log(1 + occurrences). One weight vector is shared
by all ordered thresholds: P(grade <= k) = sigmoid(threshold_k - weights . x).
The fit uses a bounded sample of labelled rows; every document is scored whole.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from .common import ALNUM, LOWER, arrow_map, materialize, mix, prefix_hash, scan_words, slices, span_hash, text_buffers

#: Labelled rows that the model is fitted on, at most (least by a hash of the id).
SAMPLE = 6000
#: Bytes of text of those rows, at most.
SAMPLE_BYTES = 64_000_000
MIN_PREFIX, MAX_PREFIX = 4, 9
#: Features kept: those whose rates differ most between toxic and other rows.
FEATURES = 4096
SIZES = 16
#: Marker words from which a toxic row counts as grade 2, and 3.
GRADES = (3, 6)
#: A document is toxic if grade 1 or more is at least so probable.
THRESHOLD = 0.5


def hashed(buf: np.ndarray, off: np.ndarray, known: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(word, feature, words before each document); only features in sorted `known`, as their places, if given."""
    buf = LOWER[buf]
    starts, ends, at = scan_words(buf, off, ALNUM)
    prefix = prefix_hash(buf)
    words, features = [], []
    for n in [0, *range(MIN_PREFIX, MAX_PREFIX + 1)]:
        use = np.arange(len(starts)) if not n else np.flatnonzero(ends - starts > n)
        h = span_hash(prefix, starts[use], ends[use] if not n else starts[use] + n)
        h = h if not n else mix(h + np.uint64(n))
        if known is not None:
            place = np.minimum(np.searchsorted(known, h), len(known) - 1)
            hit = known[place] == h
            use, h = use[hit], place[hit]
        words.append(use)
        features.append(h)
    return np.concatenate(words), np.concatenate(features), at


def size_class(words: np.ndarray) -> np.ndarray:
    """Doublings of a document's length, 0 to SIZES - 1: a chance marker weighs less in a long text."""
    return np.minimum(np.log2(words + 1).astype(int), SIZES - 1)


class OrdinalModel:
    """Weights shared across ordered thresholds, fitted by gradient descent with moments."""

    def __init__(self, known: np.ndarray, weights: np.ndarray, cuts: np.ndarray):
        self.known, self.weights, self.cuts = known, weights, cuts

    def probabilities(self, buf: np.ndarray, off: np.ndarray) -> np.ndarray:
        """Probability of each grade, a row per document."""
        word, feature, at = hashed(buf, off, self.known)
        words, k = np.diff(at), len(self.known)
        pair, n = np.unique((np.searchsorted(at, word, "right") - 1) * k + feature, return_counts=True)
        score = np.bincount(pair // k, self.weights[pair % k] * np.log1p(n), len(words)) + self.weights[k + size_class(words)]
        below = 1 / (1 + np.exp(-np.clip(self.cuts - score[:, None], -60, 60)))
        return np.diff(np.c_[np.zeros(len(words)), below, np.ones(len(words))], axis=1)


def fit(texts: list[str | None] | pa.ChunkedArray, toxic: np.ndarray) -> OrdinalModel:
    """The model of labelled texts (toxic: 0 or 1); grades of toxic ones follow their number of marker words.

    Texts are read in small slices, three times: for the features of toxic
    rows, for their counts in other rows, and for the values of those kept.
    """
    batch = pa.table({"text": texts if isinstance(texts, pa.ChunkedArray) else pa.array(texts, pa.string()), "toxic": pa.array(toxic)})

    def parts(known=None, only=None):
        rows = batch if only is None else batch.filter(pc.equal(batch.column("toxic"), only))
        first = 0
        for b in slices(rows.to_batches(), limit=1_000_000):
            word, feature, at = hashed(*text_buffers(b.column("text")), known)
            yield first, word, feature, at
            first += b.num_rows

    def distinct(word, feature, at):
        names, col = np.unique(feature, return_inverse=True)
        return names[np.unique((np.searchsorted(at, word, "right") - 1) * max(1, len(names)) + col) % max(1, len(names))]

    seen = [np.unique(distinct(w, f, at), return_counts=True) for _, w, f, at in parts(only=1.0)]
    names, back = np.unique(np.concatenate([np.zeros(0, np.uint64), *[n for n, _ in seen]]), return_inverse=True)
    ones = np.bincount(back, np.concatenate([np.zeros(0), *[c for _, c in seen]]), len(names))
    names, ones = names[ones >= 3], ones[ones >= 3]
    if not len(names):
        return OrdinalModel(np.array([np.iinfo(np.uint64).max], np.uint64), np.zeros(1 + SIZES), np.array([5.0, 6.0, 7.0]))
    zeros = np.zeros(len(names))
    for _, w, f, at in parts(names, 0.0):
        pair = np.unique((np.searchsorted(at, w, "right") - 1) * len(names) + f)
        zeros += np.bincount(pair % len(names), minlength=len(names))
    n1, n0 = max(1, toxic.sum()), max(1, (1 - toxic).sum())
    odds = np.log((ones + 0.5) / (n1 + 1)) - np.log((zeros + 0.5) / (n0 + 1))
    keep = np.flatnonzero(odds > 2.5)
    keep = np.sort(keep[np.argsort(-(odds * np.sqrt(ones))[keep], kind="stable")[:FEATURES]])
    if not len(keep):
        return OrdinalModel(np.array([np.iinfo(np.uint64).max], np.uint64), np.zeros(1 + SIZES), np.array([5.0, 6.0, 7.0]))
    names = names[keep]
    doc, col, n, words, markers = [], [], [], [], []
    for first, w, f, at in parts(names):
        pair, k = np.unique((np.searchsorted(at, w, "right") - 1) * len(names) + f, return_counts=True)
        doc.append(first + pair // len(names))
        col.append(pair % len(names))
        n.append(k)
        words.append(np.diff(at))
        markers.append(np.bincount(np.searchsorted(at, np.unique(w), "right") - 1, minlength=len(at) - 1))
    doc, col, n, words, markers = map(np.concatenate, (doc, col, n, words, markers))
    value = np.log1p(n)
    # grades: how many of a toxic row's words carry a marker
    grade = np.where(toxic == 1, 1 + np.digitize(markers, GRADES), 0)
    every = np.arange(len(toxic))
    doc, col, value = np.r_[doc, every], np.r_[col, len(names) + size_class(words)], np.r_[value, np.ones(len(toxic))]
    weights, gaps = np.zeros(len(names) + SIZES), np.array([2.0, 0.0, 0.0])
    state = [[np.zeros_like(a), np.zeros_like(a)] for a in (weights, gaps)]
    sigmoid = lambda z: 1 / (1 + np.exp(-np.clip(z, -60, 60)))
    for step in range(1, 1001):
        cuts = gaps[0] + np.r_[0, np.cumsum(np.exp(gaps[1:]))]
        score = np.bincount(doc, weights[col] * value, len(toxic))
        edge = np.r_[-np.inf, cuts, np.inf]
        up, low = edge[grade + 1] - score, edge[grade] - score
        p_up, p_low = np.where(np.isinf(up), 1, sigmoid(up)), np.where(np.isinf(low), 0, sigmoid(low))
        p = np.maximum(p_up - p_low, 1e-9)
        d_up, d_low = p_up * (1 - p_up) / p, p_low * (1 - p_low) / p
        on_score = d_up - d_low  # of -log p
        g_cut = np.array([-(d_up[grade == k].sum() - d_low[grade == k + 1].sum()) for k in range(3)]) / len(toxic)
        g_gap = np.r_[g_cut.sum(), [g_cut[k:].sum() * np.exp(gaps[k]) for k in (1, 2)]]
        g_w = np.bincount(col, on_score[doc] * value, len(weights)) / len(toxic) + 1e-6 * weights
        for a, g, s in ((weights, g_w, state[0]), (gaps, g_gap, state[1])):
            s[0] = 0.9 * s[0] + 0.1 * g
            s[1] = 0.999 * s[1] + 0.001 * g * g
            a -= 0.05 * (s[0] / (1 - 0.9**step)) / (np.sqrt(s[1] / (1 - 0.999**step)) + 1e-9)
    return OrdinalModel(names, weights, gaps[0] + np.r_[0, np.cumsum(np.exp(gaps[1:]))])


def train(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> OrdinalModel:
    """Fit on at most SAMPLE labelled rows of at most SAMPLE_BYTES of text, the least by a hash of the id, classes in their natural shares.

    The bounds are the fit's only: every document is scored. Of rows that
    repeat an id the least text counts; unlabelled and null rows are no part.
    """
    known = labels.where(F.col("doc_id").isNotNull() & F.col("toxic").isin(0, 1)).groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    picked = known.orderBy(F.xxhash64("doc_id"), "doc_id").limit(SAMPLE)
    texts = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text")).where("text is not null")
    # at most SAMPLE ids
    rows = materialize(texts.join(F.broadcast(picked), "doc_id").groupBy("doc_id").agg(F.min("text").alias("text"), F.first("toxic").alias("toxic")))
    sizes = rows.select("doc_id", F.octet_length("text").cast("long").alias("size"), F.xxhash64("doc_id").alias("h"))
    before = F.sum("size").over(Window.orderBy("h", "doc_id").rowsBetween(Window.unboundedPreceding, 0))
    fits = sizes.select("doc_id", before.alias("sum")).where(F.col("sum") <= SAMPLE_BYTES).select("doc_id")  # numbers of at most SAMPLE rows meet
    rows = rows.join(F.broadcast(fits), "doc_id").orderBy("doc_id").toArrow()
    return fit(rows.column("text"), rows.column("toxic").to_numpy().astype(float))


def score(docs: DataFrame, model: OrdinalModel, text_col: str = "text") -> DataFrame:
    """`docs` with grade int (most probable), expected_severity double (mean grade, 0 to 3) and toxic boolean.

    Null, empty and wordless texts get the grades of a text without features.
    All rows and columns are kept; the three replace input columns of these
    names. An empty table stays empty.
    """
    docs = docs.drop("grade", "expected_severity", "toxic")
    names = docs.columns
    schema = StructType(list(docs.schema)).add("grade", "integer").add("expected_severity", "double").add("toxic", "boolean")
    at = names.index(text_col)

    def run(batches):
        named = (b.rename_columns([f"c{i}" if i != at else "text" for i in range(len(names))]) for b in batches)
        for b in slices(named):
            p = model.probabilities(*text_buffers(b.column(at).cast(pa.string())))
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(p.argmax(1).astype(np.int32)), pa.array(p @ np.arange(p.shape[1])), pa.array(1 - p[:, 0] >= THRESHOLD)], [*names, "grade", "expected_severity", "toxic"])

    return arrow_map(docs, run, schema)
