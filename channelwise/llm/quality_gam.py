"""Document quality by a generalised additive model with pairwise interactions.

The model is a sum of lookup tables: one per text feature, and one per chosen pair of features.
Boosting goes round the features in turn; each step fits a shallow tree to the log-loss gradients of
one feature's bins and adds a small part of it to that feature's table, so that no feature can take
over what others explain. When the single tables have settled, the ``PAIRS`` pairs whose coarse grid
explains most of what is left are boosted in the same way by trees that split both features. A
held-back part of the sample ends the rounds. A score is the logistic of the intercept and the table
entries that a document's bins name: scoring is a handful of vectorised additions.

All features come from the whole text. Learned from at most ``BOUND`` labelled rows of the learning
folds (a documented bound). Cases: null and empty texts have all features 0 and a score like any
other; without labels of both classes every score is the share of label 1 (0.5 without labels);
extra columns are ignored.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import batches_by_bytes, distinct_rows, held_out, materialize, sampled_labels, table, text_or_empty

BOUND = 20_000
BINS, COARSE, PAIRS = 48, 12, 6
ROUNDS, RATE, LEAVES, LEAST, PATIENCE = 300, 0.15, 4, 8, 25
NAMES = ("log_words", "word_length", "upper", "symbols", "stops", "digits", "distinct_words", "distinct_lines",
         "log_line", "marks_per_word", "top_word", "beyond_ascii", "short_words", "glued_marks", "spaces",
         "capital_words", "long_words")

_KINDS = np.zeros(256, np.int64)  # 0 other, 1 lower, 2 upper, 3 digit, 4 white, 5 sentence mark, 6 symbol, 7 beyond ASCII
for _c in range(128):
    _s = chr(_c)
    _KINDS[_c] = (1 if _s.islower() else 2 if _s.isupper() else 3 if _s.isdigit() else 4 if _s.isspace()
                  else 5 if _s in ".,;:!?'\"()-" else 6 if _c > 32 else 0)
_KINDS[128:] = 7


def features(text: str) -> list[float]:
    """The features of NAMES."""
    words = text.split()
    if not words:
        return [0.0] * len(NAMES)
    data = np.frombuffer(text.encode("utf-8", "surrogatepass"), np.uint8)
    by_byte = np.bincount(data, minlength=256)
    kind = np.bincount(_KINDS, weights=by_byte, minlength=8)
    n, chars, words_n = float(len(data)), float(len(text)), float(len(words))
    lines = [x for x in text.split("\n") if x]
    sizes = np.fromiter(map(len, words), np.int64, len(words))
    counts = Counter(words)
    distinct, top = len(counts), max(counts.values())
    letters = kind[1] + kind[2] + kind[7] / 2 + 1
    return [float(np.log1p(words_n)), float(sizes.mean()), kind[2] / letters, kind[6] / n,
            float(by_byte[46]) / words_n, kind[3] / n, distinct / words_n, len(set(lines)) / len(lines),
            float(np.log1p(chars / len(lines))), kind[5] / words_n, top / words_n, kind[7] / n,
            float((sizes <= 3).mean()), float(by_byte[33] + by_byte[63]) / words_n, kind[4] / n,
            sum(map(str.isupper, words)) / words_n, float((sizes >= 12).mean())]


def feature_table(docs: DataFrame) -> DataFrame:
    """(doc_id, held_out, f array<double>) for every row of ``docs``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches_by_bytes(batches, "text"):
            f = [features(t) for t in b.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), b.column("held_out"),
                                              pa.array(f, pa.list_(pa.float64()))], ["doc_id", "held_out", "f"])

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), held_out().alias("held_out"),
                       text_or_empty().alias("text"))
    return rows.mapInArrow(run, "doc_id long, held_out boolean, f array<double>")


def tree(gradient: np.ndarray, hessian: np.ndarray, count: np.ndarray, leaves: int = LEAVES) -> np.ndarray:
    """Newton values per bin of a tree with at most ``leaves`` leaves, each an interval of bins that
    holds ``LEAST`` rows or more; greedy best splits."""
    cuts = [0, len(gradient)]
    g, h, c = (np.concatenate([[0.0], np.cumsum(x)]) for x in (gradient, hessian, count))

    def value(a, b):
        return (g[b] - g[a]) ** 2 / (h[b] - h[a] + 1.0)

    for _ in range(leaves - 1):
        best, where = 1e-9, None
        for a, b in zip(cuts, cuts[1:]):
            if b - a < 2:
                continue
            at = np.arange(a + 1, b)
            gain = value(a, at) + value(at, b) - value(a, b)
            gain[(c[at] - c[a] < LEAST) | (c[b] - c[at] < LEAST)] = 0
            k = int(gain.argmax())
            if gain[k] > best:
                best, where = gain[k], a + 1 + k
        if where is None:
            break
        cuts = sorted([*cuts, where])
    out = np.zeros(len(gradient))
    for a, b in zip(cuts, cuts[1:]):
        out[a:b] = -(g[b] - g[a]) / (h[b] - h[a] + 1.0)
    return out


def grid_tree(gradient: np.ndarray, hessian: np.ndarray, count: np.ndarray) -> np.ndarray:
    """A tree over a grid of two features' bins: one split of either feature, then the best interval
    tree of the other feature on each side."""
    best, out = -1.0, np.zeros_like(gradient)
    for axis in (0, 1):
        g, h, c = (x if axis == 0 else x.T for x in (gradient, hessian, count))
        gc, hc = g.sum(axis=1).cumsum(), h.sum(axis=1).cumsum()
        gains = gc[:-1] ** 2 / (hc[:-1] + 1) + (gc[-1] - gc[:-1]) ** 2 / (hc[-1] - hc[:-1] + 1)
        # besides the best cut, the middle one: an interaction may show no gain on either side alone
        for cut in {int(gains.argmax()) + 1, len(g) // 2}:
            values = np.zeros_like(g)
            for side in (slice(0, cut), slice(cut, None)):
                values[side] = tree(g[side].sum(axis=0), h[side].sum(axis=0), c[side].sum(axis=0), 2)
            gain = float(-(values * g).sum())
            if gain > best:
                best, out = gain, values if axis == 0 else values.T
    return out


@dataclass
class Gam:
    """Intercept, bin edges, a table per feature, and (i, j, table) per pair on coarse bins."""

    intercept: float = 0.0
    edges: list = field(default_factory=list)
    tables: list = field(default_factory=list)
    coarse: list = field(default_factory=list)
    pairs: list = field(default_factory=list)

    def score(self, x: np.ndarray) -> np.ndarray:
        total = np.full(len(x), self.intercept)
        for k, (edges, values) in enumerate(zip(self.edges, self.tables)):
            total += values[np.searchsorted(edges, x[:, k], side="right")]
        for i, j, values in self.pairs:
            total += values[np.searchsorted(self.coarse[i], x[:, i], side="right"),
                            np.searchsorted(self.coarse[j], x[:, j], side="right")]
        return 1 / (1 + np.exp(-np.clip(total, -50, 50)))


def _edges(x: np.ndarray, bins: int) -> np.ndarray:
    return np.unique(np.quantile(x, np.linspace(0, 1, bins + 1)[1:-1]))


def fit_gam(x: np.ndarray, y: np.ndarray, seed: int = 7) -> Gam:
    """Fit on rows ``x`` (features) with labels ``y`` (0 or 1); the rows' order doesn't matter to the
    bins, and the split that ends the rounds is drawn from ``seed``."""
    if not len(y) or y.min() == y.max():
        share = (y.sum() + 0.5) / (len(y) + 1) if len(y) else 0.5
        return Gam(float(np.log(share / (1 - share))))
    model = Gam(float(np.log(y.mean() / (1 - y.mean()))))
    model.edges = [_edges(x[:, k], BINS) for k in range(x.shape[1])]
    model.coarse = [_edges(x[:, k], COARSE) for k in range(x.shape[1])]
    fine = [np.searchsorted(e, x[:, k], side="right") for k, e in enumerate(model.edges)]
    rough = [np.searchsorted(e, x[:, k], side="right") for k, e in enumerate(model.coarse)]
    model.tables = [np.zeros(len(e) + 1) for e in model.edges]
    learn = np.random.default_rng(seed).random(len(y)) >= 0.15
    if len(set(y[learn])) < 2 or len(set(y[~learn])) < 2:
        learn[:] = True
    check = ~learn if not learn.all() else learn
    margin = np.full(len(y), model.intercept)

    def loss() -> float:
        return float(np.logaddexp(0, np.where(y[check] == 1, -margin[check], margin[check])).mean())

    def sums(bins: np.ndarray, size: int):
        p = 1 / (1 + np.exp(-margin[learn]))
        b = bins[learn]
        return (np.bincount(b, p - y[learn], size), np.bincount(b, p * (1 - p), size),
                np.bincount(b, minlength=size).astype(float))

    def boost(bins: list[np.ndarray], tables: list[np.ndarray], fit) -> None:
        nonlocal margin
        best, since = loss(), 0
        kept = [t.copy() for t in tables]
        for _ in range(ROUNDS):
            for b, t in zip(bins, tables):
                step = RATE * fit(*(s.reshape(t.shape) for s in sums(b, t.size)))
                t += step
                margin += step.ravel()[b]
            now = loss()
            if now < best - 1e-6:
                best, since, kept = now, 0, [t.copy() for t in tables]
            else:
                since += 1
                if since >= PATIENCE:
                    break
        for b, t, k in zip(bins, tables, kept):
            margin += (k - t).ravel()[b]
            t[:] = k

    boost(fine, model.tables, tree)
    gains = []
    for i, j in combinations(range(x.shape[1]), 2):
        shape = len(model.coarse[i]) + 1, len(model.coarse[j]) + 1
        g, h, c = (s.reshape(shape) for s in sums(rough[i] * shape[1] + rough[j], shape[0] * shape[1]))
        gains.append((float(-(grid_tree(g, h, c) * g).sum()), i, j, shape))
    chosen = sorted(gains, reverse=True)[:PAIRS]
    grids = [np.zeros(shape) for *_, shape in chosen]
    boost([rough[i] * shape[1] + rough[j] for _, i, j, shape in chosen], grids, grid_tree)
    model.pairs = [(i, j, t) for (_, i, j, _), t in zip(chosen, grids)]
    return model


def fit(table_of_features: DataFrame, labels: DataFrame, bound: int = BOUND) -> Gam:
    sample = sampled_labels(labels, "quality", bound)
    rows = distinct_rows(table_of_features.join(F.broadcast(sample), "doc_id").select("doc_id", "f", "label"), "f", bound,
                         "quality-sample").orderBy("doc_id", "f").collect()
    return fit_gam(np.array([r.f for r in rows], float).reshape(len(rows), len(NAMES)), np.array([float(r.label) for r in rows]))


def score_features(table_of_features: DataFrame, model: Gam) -> DataFrame:
    """doc_id, held_out, score, predicted."""
    shared = table_of_features.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = shared.value
        for b in batches:
            if b.num_rows:
                x = np.asarray(b.column("f").flatten()).reshape(b.num_rows, -1)
                s = m.score(x)
                yield pa.RecordBatch.from_arrays(
                    [b.column("doc_id"), b.column("held_out"), pa.array(s), pa.array((s >= 0.5).astype(np.int32))],
                    ["doc_id", "held_out", "score", "predicted"])

    return table_of_features.mapInArrow(run, "doc_id long, held_out boolean, score double, predicted int")


def op6_quality(spark, sf_dir: str) -> DataFrame:
    """Quality of every document."""
    found = materialize(feature_table(table(spark, sf_dir, "documents")), "quality-features")
    return score_features(found, fit(found, table(spark, sf_dir, "labels")))
