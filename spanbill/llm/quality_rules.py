"""Quality rules: gradient-boosted trees over document statistics, scored from flat numpy node arrays.

Two base rules (too few words; too many words in repeated windows) fail a document outright.
What remains is judged by boosted trees that are fitted here on labelled documents. Chosen
features are monotonic: more symbols, repeats or duplicate lines never raise a score. A tree of
the ensemble is four arrays (feature, threshold, left child, value), all trees together one set of
arrays, so a batch is scored by a few array look-ups per level.

Null and empty texts have no words and fail the base rule. Rows with the same id are scored each for
themselves. Without labels, or with labels of one class only, nothing is learned and the base rules
alone decide. At most ``most_labels`` labelled documents are used for the fit (by a hash of the id). Very long texts are read whole. An
empty table gives an empty result. Extra columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from spanbill.llm.textstats import FEATURES, MIN_WORDS, REPEAT_PERCENT, RULE_STATS, label_sample, with_stats

#: -1: more of it never raises the score.
MONOTONIC = {"symbol_share": -1, "dup_line_share": -1, "repeat_share": -1, "mark_share": -1, "pipe_share": -1, "adjacent_share": -1}
MOST_LABELS = 20_000


@dataclass
class Trees:
    """Nodes of all trees; a leaf is its own child, so that all rows can take the same number of steps."""

    roots: np.ndarray
    feature: np.ndarray
    threshold: np.ndarray
    left: np.ndarray  # the right child follows
    leaf: np.ndarray
    value: np.ndarray
    start: float
    depth: int

    def margin(self, x: np.ndarray) -> np.ndarray:
        out, rows = np.full(len(x), self.start), np.arange(len(x))
        for root in self.roots:
            node = np.full(len(x), root)
            for _ in range(self.depth):
                right = x[rows, self.feature[node]] > self.threshold[node]
                node = np.where(self.leaf[node], node, self.left[node] + right)
            out += self.value[node]
        return out

    def score(self, x: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.margin(x), -30, 30)))


class Booster:
    """Histogram boosting of the logistic loss with monotonic constraints.

    A split on a constrained feature must order its two values, and each side's later values are
    held on their side of the middle.
    """

    def __init__(self, rounds: int = 60, depth: int = 3, rate: float = 0.2, bins: int = 32, l2: float = 1.0, least: float = 2.0):
        self.rounds, self.depth, self.rate, self.bins, self.l2, self.least = rounds, depth, rate, bins, l2, least

    def fit(self, x: np.ndarray, y: np.ndarray, signs: list[int]) -> Trees:
        rate = np.clip(y.mean(), 1e-3, 1 - 1e-3)
        edges = [np.unique(np.quantile(x[:, f], np.linspace(0, 1, self.bins + 1)[1:-1])) for f in range(x.shape[1])]
        codes = np.stack([np.searchsorted(e, x[:, f], side="left") for f, e in enumerate(edges)], 1)
        self.nodes: list[list] = []
        start, roots = float(np.log(rate / (1 - rate))), []
        margin = np.full(len(y), start)
        for _ in range(self.rounds):
            p = 1 / (1 + np.exp(-margin))
            grad, hess = y - p, np.maximum(p * (1 - p), 1e-6)
            roots.append(len(self.nodes))
            self.nodes.append([0, 0.0, 0, True, 0.0])
            self._grow(roots[-1], np.arange(len(y)), 0, -np.inf, np.inf, codes, edges, grad, hess, signs, margin)
        part = [np.array([n[i] for n in self.nodes]) for i in range(5)]
        return Trees(np.array(roots), part[0], part[1], part[2], part[3].astype(bool), part[4], start, self.depth)

    def _grow(self, node, rows, level, low, high, codes, edges, grad, hess, signs, margin):
        g, h = grad[rows], hess[rows]
        value = float(np.clip(g.sum() / (h.sum() + self.l2), low, high))
        best = (1e-6, None, None, None)
        if level < self.depth and len(rows) > 1:
            for f, edge in enumerate(edges):
                k = len(edge) + 1
                gs = np.bincount(codes[rows, f], g, k).cumsum()[:-1]
                hs = np.bincount(codes[rows, f], h, k).cumsum()[:-1]
                gr, hr = g.sum() - gs, h.sum() - hs
                lv, rv = np.clip(gs / (hs + self.l2), low, high), np.clip(gr / (hr + self.l2), low, high)
                gain = self._gain(gs, hs, lv) + self._gain(gr, hr, rv) - self._gain(g.sum(), h.sum(), value)
                gain[(np.minimum(hs, hr) < self.least) | (signs[f] * (rv - lv) < 0)] = -1
                if len(gain) and gain.max() > best[0]:
                    at = int(gain.argmax())
                    best = (float(gain[at]), f, at, (lv[at] + rv[at]) / 2)
        if best[1] is None:
            self.nodes[node] = [0, 0.0, node, True, self.rate * value]
            margin[rows] += self.rate * value
            return
        _, f, at, middle = best
        child = len(self.nodes)
        self.nodes += [[0, 0.0, 0, True, 0.0], [0, 0.0, 0, True, 0.0]]
        self.nodes[node] = [f, float(edges[f][at]), child, False, 0.0]
        goes_left = codes[rows, f] <= at
        for side, part in ((0, rows[goes_left]), (1, rows[~goes_left])):
            lo, hi = low, high
            if signs[f]:
                if (signs[f] < 0) == (side == 0):
                    lo = max(lo, middle)
                else:
                    hi = min(hi, middle)
            self._grow(child + side, part, level + 1, lo, hi, codes, edges, grad, hess, signs, margin)

    def _gain(self, g, h, v):
        return g * v - 0.5 * (h + self.l2) * v * v


def fit_trees(docs: DataFrame, labels: DataFrame, most_labels: int = MOST_LABELS) -> Trees | None:
    """Trees fitted on the labelled documents; None where there is nothing to tell apart.

    The sample of labels has a fixed bound, so it is broadcast; texts turn into statistics in the scan.
    """
    chosen = label_sample(labels, "quality", most_labels)
    rows = with_stats(docs.select("doc_id", "text").join(F.broadcast(chosen), "doc_id"), ["doc_id", "y"])
    sample = rows.orderBy(F.xxhash64("doc_id"), "doc_id").limit(most_labels).select("y", "features").toPandas()
    y = sample["y"].to_numpy(float)
    if len(y) == 0 or y.min() == y.max():
        return None
    return Booster().fit(np.stack(sample["features"].to_numpy()), y, [MONOTONIC.get(f, 0) for f in FEATURES])


def apply_rules(docs: DataFrame, trees: Trees | None) -> DataFrame:
    """doc_id, the statistics, base_failed, score and kept for every row."""
    shared = docs.sparkSession.sparkContext.broadcast(trees)

    @F.pandas_udf("double")
    def judge(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for features in batches:
            model = shared.value
            yield pd.Series(np.ones(len(features)) if model is None or not len(features) else model.score(np.stack(features.to_numpy())))

    stats = with_stats(docs, ["doc_id"])
    failed = (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > REPEAT_PERCENT * F.col("n_words"))
    scored = stats.withColumn("base_failed", failed).withColumn("score", judge("features"))
    return scored.select("doc_id", *RULE_STATS, "base_failed", (~F.col("base_failed") & (F.col("score") >= 0.5)).alias("kept"), "score")
