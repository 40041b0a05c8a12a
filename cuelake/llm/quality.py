"""Quality scores by histogram gradient-boosted trees over document statistics.

The statistics come from the text alone: shares of byte classes, word and line
lengths, repetition. Trees are grown on the driver over a bounded sample of
labelled rows (SAMPLE_ROWS, the rows whose ids hash lowest), then flattened into
arrays of split features, split bins and leaf values, over which batches of
documents go down all at once.

Null and empty texts have statistics of zero and a score like any other; rows
without a label are scored too. Without usable labels every score is 0.5.
Repeated label rows of a document count once, with the highest quality; of several
texts with one doc_id the one with the smallest hash is learned from. Rows are
scored one by one, so repeated rows get equal scores. Other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cuelake.llm import kernels as K

#: Bound of the labelled sample that the driver gathers for growing trees: rows of FEATURES doubles.
SAMPLE_ROWS = 20_000
#: Folds by crc32(doc_id as text) modulo FOLDS; fold HELD_OUT is never learned from.
FOLDS, HELD_OUT = 3, 1
BINS, DEPTH, TREES, RATE, SMOOTHING = 64, 5, 80, 0.15, 1.0
#: Bytes of text whose statistics are worked out together.
SLICE = 2 << 20

_CLASS_BYTES = {
    "upper": range(65, 91),
    "lower": range(97, 123),
    "digit": range(48, 58),
    "blank": [32],
    "newline": [10],
    "other_space": [9, 11, 12, 13],
    "stop": b".?",
    "exclaim": b"!",
    "comma": b",;:",
    "quote": b"'\"()-",
    "symbol": b"#$%&*+/<=>@[\\]^_`{}~",
    "bar": b"|",
    "high": range(128, 256),
    "continuation": range(128, 192),
}
_TABLES = []
for _pair in zip(list(_CLASS_BYTES.values())[::2], list(_CLASS_BYTES.values())[1::2], strict=True):
    _table = np.zeros(256, np.uint64)
    for _shift, _members in zip((0, 32), _pair, strict=True):
        _table[list(_members)] += np.uint64(1 << _shift)
    _TABLES.append(_table)

FEATURES = [*(f"share_{c}" for c in _CLASS_BYTES), "log_bytes", "log_words", "word_length", "longest_word", "short_words", "distinct_words", "repeats_before", "capital_words", "symbol_ends", "line_length", "lines_per_word", "distinct_lines", "words_per_stop"]


def statistics(raw: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """A row of FEATURES for each text."""
    n = len(offsets) - 1
    size = np.diff(offsets).astype(float)
    safe = np.maximum(size, 1)
    out = np.zeros((n, len(FEATURES)))
    counts = {}
    names = list(_CLASS_BYTES)
    total = np.zeros(len(raw) + 1, np.uint64)
    for k, table in enumerate(_TABLES):
        np.cumsum(table[raw], out=total[1:])
        both = total[offsets[1:]] - total[offsets[:-1]]
        counts[names[2 * k]] = (both & np.uint64(0xFFFFFFFF)).astype(float)
        counts[names[2 * k + 1]] = (both >> np.uint64(32)).astype(float)
    for k, name in enumerate(names):
        out[:, k] = counts[name] / safe
    start, end, first = K.words(raw, offsets)
    length = end - start
    n_words = np.diff(first).astype(float)
    per_word = np.maximum(n_words, 1)
    prefix = K.byte_prefix(raw)
    hashes = K.range_hash(prefix, start, end)

    def summed(x: np.ndarray) -> np.ndarray:
        run = np.concatenate([[0], np.cumsum(x, dtype=np.int64)])
        return (run[first[1:]] - run[first[:-1]]).astype(float)

    longest = -K.segment_min(-length, first, 0)
    same = np.zeros(len(hashes), bool)
    same[1:] = hashes[1:] == hashes[:-1]
    same[first[:-1][first[:-1] < first[1:]]] = False
    is_symbol = np.zeros(256, bool)
    is_symbol[[*_CLASS_BYTES["symbol"], *_CLASS_BYTES["exclaim"], *_CLASS_BYTES["bar"]]] = True
    is_capital = np.zeros(256, bool)
    is_capital[list(_CLASS_BYTES["upper"])] = True
    breaks = np.flatnonzero(raw == 10)
    line_start = np.unique(np.concatenate([offsets[:-1], breaks + 1]))
    line_start = line_start[line_start < len(raw)]
    line_end = np.append(line_start[1:], len(raw))
    line_first = np.searchsorted(line_start, offsets)
    n_lines = np.diff(line_first).astype(float)
    line_hash = K.range_hash(prefix, line_start, line_end)
    columns = [
        np.log1p(size),
        np.log1p(n_words),
        summed(length) / per_word,
        np.log1p(longest),
        summed(length <= 3) / per_word,
        _distinct(hashes, first) / per_word,
        summed(same) / per_word,
        summed(is_capital[raw[start]]) / per_word,
        summed(is_symbol[raw[end - 1]]) / per_word,
        size / np.maximum(n_lines, 1),
        n_lines / per_word,
        _distinct(line_hash, line_first) / np.maximum(n_lines, 1),
        n_words / (counts["stop"] + counts["exclaim"] + 1),
    ]
    out[:, len(names) :] = np.stack(columns, axis=1)
    return out


def _distinct(hashes: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Number of distinct values in each text's run."""
    n = len(first) - 1
    if not len(hashes):
        return np.zeros(n)
    owner = np.repeat(np.arange(n, dtype=np.uint64), np.diff(first))
    key = np.sort(owner << np.uint64(40) | hashes >> np.uint64(24))
    new = np.ones(len(key), bool)
    new[1:] = key[1:] != key[:-1]
    return np.bincount((key[new] >> np.uint64(40)).astype(np.int64), minlength=n).astype(float)


def batch_statistics(column: pa.Array) -> np.ndarray:
    raw, offsets = K.strings(column)
    parts = [statistics(raw[offsets[a] : offsets[b]], offsets[a : b + 1] - offsets[a]) for a, b in K.slices(offsets, SLICE)]
    return np.concatenate(parts) if parts else np.zeros((0, len(FEATURES)))


@dataclass
class Trees:
    """Complete binary trees in arrays: node i has children 2i+1 and 2i+2."""

    edges: list[np.ndarray]
    feature: np.ndarray
    cut: np.ndarray
    leaf: np.ndarray
    base: float

    def bins(self, x: np.ndarray) -> np.ndarray:
        return np.stack([np.searchsorted(e, x[:, j], side="left") for j, e in enumerate(self.edges)], axis=1).astype(np.uint8) if len(x) else np.zeros((0, len(self.edges)), np.uint8)

    def scores(self, x: np.ndarray) -> np.ndarray:
        """Probabilities of label 1."""
        binned, margin = self.bins(x), np.full(len(x), self.base)
        rows = np.arange(len(x))
        for feature, cut, leaf in zip(self.feature, self.cut, self.leaf, strict=True):
            at = np.zeros(len(x), np.int64)
            for _ in range(DEPTH):
                at = 2 * at + 1 + (binned[rows, feature[at]] > cut[at])
            margin += leaf[at - len(feature)]
        return 1 / (1 + np.exp(-margin))


def grow(x: np.ndarray, y: np.ndarray) -> Trees:
    """Boosts trees on logistic loss. Splits maximise the gain over histograms of gradients and second derivatives."""
    f = len(FEATURES)
    edges = [np.unique(np.quantile(x[:, j], np.linspace(0, 1, BINS)[1:-1])) if len(x) else np.zeros(0) for j in range(f)]
    share = y.mean() if len(y) else 0.5
    if not 0 < share < 1:
        return Trees(edges, np.zeros((0, 1), int), np.zeros((0, 1), int), np.zeros((0, 1)), 0.0 if not len(y) else 4.0 * (2 * share - 1))
    trees = Trees(edges, np.zeros((TREES, 2**DEPTH - 1), np.int64), np.full((TREES, 2**DEPTH - 1), 255, np.int64), np.zeros((TREES, 2**DEPTH)), float(np.log(share / (1 - share))))
    binned = trees.bins(x).astype(np.int64)
    flat = binned + np.arange(f) * BINS
    margin = np.full(len(x), trees.base)
    for t in range(TREES):
        p = 1 / (1 + np.exp(-margin))
        gradient, second = y - p, p * (1 - p)
        at = np.zeros(len(x), np.int64)
        for level in range(DEPTH):
            width, begin = 2**level, 2**level - 1
            cell = (at - begin)[:, None] * (f * BINS) + flat
            shape = (width, f, BINS)
            g, h = (np.bincount(cell.ravel(), np.repeat(v, f), width * f * BINS).reshape(shape).cumsum(axis=2) for v in (gradient, second))
            g_all, h_all = g[:, :, -1:], h[:, :, -1:]
            gain = g**2 / (h + SMOOTHING) + (g_all - g) ** 2 / (h_all - h + SMOOTHING) - g_all**2 / (h_all + SMOOTHING)
            gain[(h < 1) | (h_all - h < 1)] = 0
            best = gain.reshape(width, -1).argmax(axis=1)
            good = gain.reshape(width, -1)[np.arange(width), best] > 1e-9
            trees.feature[t, begin : begin + width] = np.where(good, best // BINS, 0)
            trees.cut[t, begin : begin + width] = np.where(good, best % BINS, 255)
            at = 2 * at + 1 + (binned[np.arange(len(x)), trees.feature[t, at]] > trees.cut[t, at])
        own = at - (2**DEPTH - 1)
        value = RATE * np.bincount(own, gradient, 2**DEPTH) / (np.bincount(own, second, 2**DEPTH) + SMOOTHING)
        trees.leaf[t] = value
        margin += value[own]
    return trees


def fold(key: str = "doc_id"):
    """Spark column: crc32 of the id as text, modulo FOLDS."""
    return F.crc32(F.col(key).cast("string").cast("binary")) % FOLDS


def train(docs: DataFrame, labels: DataFrame, target: str = "quality", rows: int = SAMPLE_ROWS) -> Trees:
    """Grows trees on at most `rows` labelled documents outside fold HELD_OUT."""
    usable = labels.where(F.col("doc_id").isNotNull() & F.col(target).isin(0, 1) & (fold() != HELD_OUT))
    usable = usable.groupBy("doc_id").agg(F.max(target).cast("double").alias("_y"))
    sample = usable.orderBy(F.xxhash64("doc_id"), "doc_id").limit(rows)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            x = batch_statistics(b.column(1))
            yield pa.RecordBatch.from_arrays([b.column(0).cast(pa.int64()), b.column(2), pa.array(list(x), pa.list_(pa.float64())), b.column(3)], ["_id", "_y", "_x", "_h"])

    found = docs.select("doc_id", "text").join(F.broadcast(sample), "doc_id").select("doc_id", "text", "_y", F.xxhash64("text").alias("_h"))  # at most `rows` pairs of numbers
    rows_of = found.mapInArrow(K.releasing(run), "_id long, _y double, _x array<double>, _h long")
    got = rows_of.groupBy("_id").agg(F.min(F.struct("_h", "_y", "_x")).alias("_r")).select("_id", "_r._y", "_r._x").toArrow().sort_by("_id")
    x = np.array(got["_x"].to_pylist(), dtype=float).reshape(len(got), len(FEATURES))
    return grow(x, got["_y"].to_numpy())


def score(docs: DataFrame, trees: Trees) -> DataFrame:
    """(doc_id, held_out, score, predicted) for each row of docs."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            p = trees.scores(batch_statistics(b.column(1)))
            yield pa.RecordBatch.from_arrays([b.column(0).cast(pa.int64()), b.column(2), pa.array(p, pa.float64()), pa.array((p >= 0.5).astype(np.int32))], ["doc_id", "held_out", "score", "predicted"])

    return docs.select("doc_id", "text", F.coalesce(fold() == HELD_OUT, F.lit(False)).alias("held_out")).mapInArrow(K.releasing(run), "doc_id long, held_out boolean, score double, predicted int")


def keep_good(docs: DataFrame, trees: Trees, columns: list[str]) -> DataFrame:
    """The rows of docs that score at least 0.5, with the given columns, of which one is text."""
    at = columns.index("text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            yield b.filter(pa.array(trees.scores(batch_statistics(b.column(at))) >= 0.5))

    own = docs.select(*columns)
    return own.mapInArrow(K.releasing(run), own.schema)
