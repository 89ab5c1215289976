"""A quality classifier: histogram gradient-boosted trees over statistics of a text.

``statistics`` turns each whole text into a fixed row of numbers. ``fit`` bins them by quantiles and grows trees of fixed
depth on histograms of gradients; the trees are flattened into arrays, a level after the other, and ``score`` walks all
rows through all trees with numpy indexing alone. The model is fitted on ``MOST_ROWS`` labelled rows at most, those of
smallest hash; features are computed for, and scores given to, every text.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from tilewright.llm import bytetext as bt

#: The bound of the fitting sample, in rows.
MOST_ROWS = 20_000
BINS, DEPTH, TREES, RATE, L2, LEAST = 64, 4, 60, 0.15, 5.0, 20

NAMES = ("length words mean_word long_word upper lower digit space punctuation symbol non_ascii lines mean_line short_line repeated_line distinct_words "
         "repeated_words adjacent_words top_word stop_end capital_words bar bang hash_sign percent ampersand star dollar kinds_of_bytes repeated_pairs").split()

_SPACE = np.zeros(256, bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True
_KIND = np.zeros((256, 8), np.float32)  # upper, lower, digit, space, punctuation, symbol, non-ASCII, line end
_KIND[65:91, 0] = _KIND[97:123, 1] = _KIND[48:58, 2] = _KIND[128:, 6] = 1
_KIND[_SPACE, 3] = 1
_KIND[[ord(c) for c in ".,;:!?'\"()-"], 4] = 1
_KIND[[ord(c) for c in "#$%&*+/<=>@[\\]^_`{|}~"], 5] = 1
_KIND[10, 7] = 1
_SIGNS = [ord(c) for c in "|!#%&*$"]


def _repeats(h: np.ndarray) -> float:
    return 1 - len(np.unique(h)) / len(h) if len(h) else 0.0


def statistics(d: np.ndarray, off: np.ndarray) -> np.ndarray:
    """One row of numbers for each text of a slice."""
    n = len(off) - 1
    out = np.zeros((n, len(NAMES)), np.float32)
    start, end, text = bt.words(d, off, ~_SPACE)
    sums = bt.prefix_sums(d, bt.byte_table(True))
    word = bt.spans_hash(sums, start, end)
    first = np.searchsorted(text, np.arange(n + 1))
    newline = np.arange(256) == 10
    ls, le, lt = bt.words(d, off, ~newline)
    line = bt.spans_hash(sums, ls, le)
    lfirst = np.searchsorted(lt, np.arange(n + 1))
    for i in range(n):
        x = d[off[i] : off[i + 1]]
        size = len(x)
        if not size:
            continue
        count = np.bincount(x, minlength=256).astype(np.float32)
        share = count @ _KIND / size
        a, b = first[i], first[i + 1]
        w, length = word[a:b], (end - start)[a:b]
        l, llen = line[lfirst[i] : lfirst[i + 1]], (le - ls)[lfirst[i] : lfirst[i + 1]]
        m = max(1, len(w))
        _, many = np.unique(w, return_counts=True) if len(w) else (None, np.zeros(1))
        last = d[end[a:b] - 1] if len(w) else np.zeros(0, np.uint8)
        head = d[start[a:b]] if len(w) else np.zeros(0, np.uint8)
        pairs = bt.mix(w[:-1]) + w[1:] if len(w) > 1 else w[:0]
        out[i] = (
            np.log1p(size), np.log1p(len(w)), length.mean() if len(w) else 0, (length > 20).sum() / m, *share[:7], len(l) / size * 100, np.log1p(llen.mean()) if len(l) else 0,
            (llen < 20).sum() / max(1, len(l)), _repeats(l), len(many) / m, 1 - len(many) / m, (w[1:] == w[:-1]).sum() / m, many.max() / m, ((last == 46) | (last == 63)).sum() / m,
            ((head >= 65) & (head <= 90)).sum() / m, *(count[_SIGNS] / m), (count > 0).sum(), _repeats(pairs))
    return out


def features(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, x): the statistics of each whole text, row by row; a null text counts as empty and has zeros.

    Texts may be of any length, repeated rows and null ids stay, an empty table gives an empty result; other columns, also those
    named like the result's, are not looked at.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, off = bt.column_bytes(batch.column(1))
            for i, j, d, o in bt.slices(data, off):
                x = statistics(d, o)
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(i, j - i), pa.array(list(x), pa.list_(pa.float32()))], ["doc_id", "x"])

    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).cast("binary").alias("text"))
    return rows.mapInArrow(run, f"doc_id {rows.schema['doc_id'].dataType.simpleString()}, x array<float>")


class Trees:
    """Trees of one depth as arrays: of each tree and inner node the feature and the threshold, of each leaf the value."""

    def __init__(self, base: float, feature: np.ndarray, threshold: np.ndarray, leaf: np.ndarray):
        self.base, self.feature, self.threshold, self.leaf = base, feature, threshold, leaf

    def score(self, x: np.ndarray) -> np.ndarray:
        row = np.arange(len(x))[:, None]
        tree = np.arange(len(self.leaf))[None, :]
        node = np.zeros((len(x), len(self.leaf)), np.int64)
        for _ in range(DEPTH if len(self.leaf) else 0):
            node = 2 * node + 1 + (x[row, self.feature[tree, node]] > self.threshold[tree, node])
        total = self.base + (self.leaf[tree, node - (2**DEPTH - 1)].sum(axis=1) if len(self.leaf) else np.zeros(len(x)))
        return 1 / (1 + np.exp(-total))


def fit_trees(x: np.ndarray, y: np.ndarray) -> Trees:
    """Newton boosting of the logistic loss; a node splits where the gain over its quantile bins is largest."""
    inner, width = 2**DEPTH - 1, x.shape[1] if x.ndim == 2 else len(NAMES)
    mean = float(np.clip(y.mean(), 1e-3, 1 - 1e-3)) if len(y) else 0.5
    base = float(np.log(mean / (1 - mean)))
    none = Trees(base, np.zeros((0, inner), np.int64), np.zeros((0, inner), np.float32), np.zeros((0, inner + 1)))
    if len(y) < 2 * LEAST or y.min() == y.max():
        return none
    edges = [np.unique(np.quantile(x[:, f], np.linspace(0, 1, BINS + 1)[1:-1]).astype(np.float32)) for f in range(width)]
    bins = np.stack([np.searchsorted(e, x[:, f], side="left") for f, e in enumerate(edges)], axis=1)
    flat = bins + np.arange(width) * BINS
    features_, thresholds, leaves = [], [], []
    total = np.full(len(y), base)
    for _ in range(TREES):
        p = 1 / (1 + np.exp(-total))
        g, h = y - p, np.maximum(p * (1 - p), 1e-6)
        feature, threshold = np.zeros(inner, np.int64), np.full(inner, np.inf, np.float32)
        node = np.zeros(len(y), np.int64)
        for level in range(DEPTH):
            low, n = 2**level - 1, 2**level
            key = ((node - low)[:, None] * (width * BINS) + flat).ravel()
            size = n * width * BINS
            gs, hs, cs = (np.cumsum(np.bincount(key, np.repeat(v, width), size).reshape(n, width, BINS), axis=2) for v in (g, h, np.ones(len(y))))
            gt, ht, ct = gs[..., -1:], hs[..., -1:], cs[..., -1:]
            gain = gs**2 / (hs + L2) + (gt - gs) ** 2 / (ht - hs + L2) - gt**2 / (ht + L2)
            gain[(cs < LEAST) | (ct - cs < LEAST)] = -1
            best = gain.reshape(n, -1).argmax(axis=1)
            f, b = best // BINS, best % BINS
            real = (gain.reshape(n, -1)[np.arange(n), best] > 1e-9) & np.array([bb < len(edges[ff]) for ff, bb in zip(f, b, strict=True)])
            feature[low : low + n] = f
            threshold[low : low + n] = [edges[ff][bb] if ok else np.inf for ff, bb, ok in zip(f, b, real, strict=True)]
            node = 2 * node + 1 + (x[np.arange(len(y)), feature[node]] > threshold[node])
        at = node - inner
        leaf = RATE * np.bincount(at, g, inner + 1) / (np.bincount(at, h, inner + 1) + L2)
        total += leaf[at]
        features_.append(feature)
        thresholds.append(threshold)
        leaves.append(leaf)
    return Trees(base, np.array(features_), np.array(thresholds, np.float32), np.array(leaves))


def fit(known: DataFrame, most: int = MOST_ROWS) -> Trees:
    """The trees of the rows (doc_id, x, label) of ``known``, of ``most`` of them at most, those of smallest hash of the id.

    Rows with a null label add nothing; repeated rows count anew, also with labels that contradict each other. Without rows, with
    too few or with labels of one kind there are no trees: every text then scores the labels' mean, 0.5 without any.
    """
    rows = known.where("label is not null").orderBy(F.xxhash64("doc_id", F.lit(9))).limit(most).select("x", F.col("label").cast("double").alias("y")).toArrow()
    x = np.stack([np.asarray(v, np.float32) for v in rows.column("x").to_pylist()]) if rows.num_rows else np.zeros((0, len(NAMES)), np.float32)
    return fit_trees(x, rows.column("y").to_numpy())


def score(rows: DataFrame, trees: Trees) -> DataFrame:
    """(doc_id, score) of each row (doc_id, x); repeated rows stay, an empty table gives an empty result."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(0, len(batch), 4096):
                part = batch.slice(i, 4096)
                x = part.column(1).flatten().to_numpy(zero_copy_only=False).reshape(len(part), -1)
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array(trees.score(x))], ["doc_id", "score"])

    return rows.select("doc_id", "x").mapInArrow(run, f"doc_id {rows.schema['doc_id'].dataType.simpleString()}, score double")
