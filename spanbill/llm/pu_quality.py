"""Quality classifier by positive-unlabelled learning.

A linear model over text statistics and hashed word shapes is fitted with the non-negative unbiased risk

    prior * R(positives as +) + max(0, R(unlabelled as -) - prior * R(positives as -))

Trusted positives are labelled documents of quality 1, at most ``most`` of them, chosen by a hash of the id. The unlabelled are all
documents outside the held-out third (crc32 of the id as text, modulo 3, is 1), labelled or not, and the class prior is the share of
positives among all labels outside it. Ids, languages, sources and labels are no inputs of a score; the text alone is.

Features are computed once and written. Means, deviations, and at ANCHORS points on the way the risk of all unlabelled documents and
its slope are summed over the whole table by Spark. Between two such points the steps follow a sample of at most ``most``
unlabelled documents, corrected by what it lacked at the last point (the variance-reduced gradient), so the sample shapes the path
between the points, and all documents the risk.

Null and empty texts are scored as texts without words, very long ones whole. Rows with the same id are scored each for
themselves. Without positives, all documents score 0.5 and are predicted 1; without documents the result is empty. Extra columns are
not read.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from spanbill.llm.common import slices, small_batches
from spanbill.llm.textstats import text_stats, voted_labels
from spanbill.operators.stage import settle

MOST, ANCHORS = 8_000, 6
SHAPES = 64


def held_out(doc_id: Column) -> Column:
    return F.coalesce(F.crc32(doc_id.cast("string")) % 3 == 1, F.lit(False))


def _shape(word: bytes) -> int:
    """A word's shape: how it begins, how it ends, and whether its letters are all capital."""
    a, z = word[0], word[-1]
    kind = [0 if c > 127 or 97 <= c < 123 else 1 if 65 <= c < 91 else 2 if 48 <= c < 58 else 3 + c % 5 for c in (a, z)]
    return (kind[0] * 8 + kind[1]) % (SHAPES // 2) + (SHAPES // 2) * (len(word) > 1 and word.isupper())


def document_features(text: bytes | None) -> np.ndarray:
    """Statistics, their squares' roots (small shares matter), and the share of each word shape."""
    stats = np.array(text_stats(text)[1])
    shapes = np.zeros(SHAPES)
    words = (text or b"").split()
    counts: dict[bytes, int] = {}
    for w in words:
        counts[w] = counts.get(w, 0) + 1
    for w, c in counts.items():
        shapes[_shape(w)] += c
    return np.concatenate([stats, np.sqrt(np.abs(stats)), np.sqrt(shapes / max(len(words), 1))])


@dataclass
class Linear:
    mean: np.ndarray
    scale: np.ndarray
    weight: np.ndarray
    bias: float
    prior: float

    def score(self, x: np.ndarray) -> np.ndarray:
        z = np.clip((x - self.mean) / self.scale, -8, 8) @ self.weight + self.bias
        return 1 / (1 + np.exp(-np.clip(z, -30, 30)))


Slope = tuple[float, np.ndarray]


def loss_slope(x: np.ndarray, sign: int, w: np.ndarray, b: float) -> Slope:
    """Summed sigmoid loss of standardised rows taken as `sign`, and its gradient by weights and bias."""
    loss = 1 / (1 + np.exp(np.clip(sign * (x @ w + b), -30, 30)))
    d = -sign * loss * (1 - loss)
    return float(loss.sum()), np.append(x.T @ d, d.sum())


def standardised(x: np.ndarray, mean: np.ndarray, scale: np.ndarray) -> np.ndarray:
    return np.clip((x - mean) / scale, -8, 8)


def fit_nnpu(
    pos: np.ndarray, unl: np.ndarray, prior: float, mean: np.ndarray, scale: np.ndarray, whole: Callable[[np.ndarray, float], Slope],
    anchors: int = ANCHORS, steps: int = 1500, rate: float = 0.02, l2: float = 1e-4,
) -> Linear:
    """Minimises the risk with the sigmoid loss by Adam; where the negative part falls below zero, its gradient is turned round, as the
    estimator prescribes. `whole` gives mean loss and gradient of all unlabelled rows taken as negative."""
    p, u = standardised(pos, mean, scale), standardised(unl, mean, scale)
    w, b = np.zeros(p.shape[1]), 0.0
    m, v = np.zeros(len(w) + 1), np.zeros(len(w) + 1)

    def slope(x, sign) -> Slope:
        loss, gradient = loss_slope(x, sign, w, b)
        return loss / len(x), gradient / len(x)

    for step in range(1, steps + 1):
        loss_un, unl_as_neg = slope(u, -1)
        if (step - 1) % -(-steps // anchors) == 0:
            of_all = whole(w, b)
            lacking = of_all[0] - loss_un, of_all[1] - unl_as_neg
        _, as_pos = slope(p, 1)
        loss_pn, pos_as_neg = slope(p, -1)
        rest = loss_un + lacking[0] - prior * loss_pn
        grad_rest = unl_as_neg + lacking[1] - prior * pos_as_neg
        grad = prior * as_pos + grad_rest if rest >= 0 else -grad_rest
        grad[:-1] += l2 * w
        m, v = 0.9 * m + 0.1 * grad, 0.999 * v + 0.001 * grad**2
        move = rate * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.999**step)) + 1e-9)
        w, b = w - move[:-1], b - move[-1]
    return Linear(mean, scale, w, float(b), prior)


def featured(docs: DataFrame, keep: list[str]) -> DataFrame:
    """The columns to keep, and the features as an array; texts go no further than their task."""
    types = docs.select(*keep).schema
    schema = ", ".join([*(f"`{f.name}` {f.dataType.simpleString()}" for f in types), "features array<double>"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for some in slices(batch, "_text"):
                rows = [document_features(x.as_py()) for x in some.column("_text")]
                yield pa.RecordBatch.from_arrays([*(some.column(k) for k in keep), pa.array(rows, pa.list_(pa.float64()))], names=[*keep, "features"])

    return docs.select(*keep, F.col("text").cast("binary").alias("_text")).mapInArrow(run, schema)


def features_of(texts: pa.Array) -> np.ndarray:
    """A row of features for each text; texts are looked at one by one."""
    out = np.empty((0, 0))
    for i, x in enumerate(texts):
        row = document_features(x.as_py())
        out = out if i else np.empty((len(texts), len(row)))
        out[i] = row
    return out


def _totals(rows: DataFrame, add: Callable[[np.ndarray], np.ndarray], size: int) -> np.ndarray:
    """Sum of `add` over the features of all rows, one vector a task; tasks are added up in their order."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(size)
        for batch in batches:
            if batch.num_rows:
                values = batch.column("features").flatten().to_numpy()
                total += add(values.reshape(batch.num_rows, -1))
        yield pa.RecordBatch.from_arrays([pa.array([TaskContext.get().partitionId()]), pa.array([total], pa.list_(pa.float64()))], names=["part", "total"])

    parts = rows.select("features").mapInArrow(run, "part bigint, total array<double>").collect()  # one short vector a task
    return np.sum([r["total"] for r in sorted(parts)], axis=0) if parts else np.zeros(size)


def _open(doc_id: Column) -> Column:
    return doc_id.isNotNull() & ~held_out(doc_id)


def mean_and_scale(rows: DataFrame, size: int) -> tuple[int, np.ndarray, np.ndarray]:
    """Number of rows, and mean and deviation of each feature."""
    total = _totals(rows, lambda x: np.concatenate([[len(x)], x.sum(0), (x * x).sum(0)]), 2 * size + 1)
    n = max(total[0], 1)
    mean = total[1 : size + 1] / n
    return int(total[0]), mean, np.sqrt(np.maximum(total[size + 1 :] / n - mean**2, 0)) + 1e-6


def risk_of_all(rows: DataFrame, n: int, mean: np.ndarray, scale: np.ndarray) -> Callable[[np.ndarray, float], Slope]:
    """Mean loss of all rows taken as negative and its gradient, as a function of weights and bias; one Spark job a call."""

    def whole(w: np.ndarray, b: float) -> Slope:
        def add(x: np.ndarray) -> np.ndarray:
            loss, gradient = loss_slope(standardised(x, mean, scale), -1, w, b)
            return np.append(loss, gradient)

        total = _totals(rows, add, len(w) + 2) / n
        return float(total[0]), total[1:]

    return whole


def fit_featured(rows: DataFrame, labels: DataFrame, most: int = MOST, anchors: int = ANCHORS) -> Linear | None:
    """The model, from a written table of doc_id and features."""
    unlabelled = rows.where(_open(F.col("doc_id")))
    voted = voted_labels(labels, "quality", _open(F.col("doc_id")))
    tally = voted.agg(F.sum("y").alias("p"), F.count("*").alias("n")).first()
    if not tally["n"] or not tally["p"]:
        return None
    some = unlabelled.select("doc_id").distinct().orderBy(F.xxhash64("doc_id", F.lit(1)), "doc_id").limit(most)
    positives = voted.where("y = 1").join(unlabelled.select("doc_id").distinct(), "doc_id").orderBy(F.xxhash64("doc_id"), "doc_id").limit(most)
    wanted = positives.select("doc_id", F.lit(1).alias("p")).union(some.select("doc_id", F.lit(0).alias("p")))
    chosen = unlabelled.join(F.broadcast(wanted), "doc_id").groupBy("doc_id", "p").agg(F.min("features").alias("features"))  # a row an id
    sample = chosen.orderBy("p", "doc_id").select("p", "features").toPandas()
    x, p = np.stack(sample["features"].to_numpy()) if len(sample) else np.zeros((0, 1)), sample["p"].to_numpy()
    if not (p == 1).any() or not (p == 0).any():
        return None
    n, mean, scale = mean_and_scale(unlabelled, x.shape[1])
    prior = min(tally["p"] / tally["n"], 0.99)
    return fit_nnpu(x[p == 1], x[p == 0], prior, mean, scale, risk_of_all(unlabelled, n, mean, scale), anchors)


def fit(docs: DataFrame, labels: DataFrame, most: int = MOST) -> Linear | None:
    """The model, from the features of all documents outside the held-out third."""
    rows = docs.where(_open(F.col("doc_id"))).select("doc_id", "text")
    with small_batches(docs.sparkSession):
        rows = settle(featured(rows, ["doc_id"]))
    return fit_featured(rows, labels, most)


def _rated(rows: DataFrame, keep: list[str], score: Column) -> DataFrame:
    scored = rows.select(*keep, held_out(F.col("doc_id")).alias("held_out"), score.alias("score"))
    return scored.withColumn("predicted", (F.col("score") >= 0.5).cast("int"))


def _rater(spark, model: Linear | None, features: Callable[[pa.Array], np.ndarray]):
    shared = spark.sparkContext.broadcast(model)

    @F.arrow_udf("double")
    def rate(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for values in batches:
            model = shared.value
            if model is None or not len(values):
                yield pa.array(np.full(len(values), 0.5))
            else:
                yield pa.array(model.score(features(values)))

    return rate


def score(docs: DataFrame, model: Linear | None, keep: list[str]) -> DataFrame:
    """The columns to keep, held_out, score and predicted for every row."""
    rate = _rater(docs.sparkSession, model, features_of)
    return _rated(docs, keep, rate(F.col("text").cast("binary")))


def score_featured(rows: DataFrame, model: Linear | None, keep: list[str]) -> DataFrame:
    """As `score`, from a written table of features."""
    rate = _rater(rows.sparkSession, model, lambda features: features.flatten().to_numpy().reshape(len(features), -1))
    return _rated(rows, keep, rate("features"))


def quality(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """doc_id, held_out, score and predicted for every row; each text is read once."""
    with small_batches(docs.sparkSession):
        rows = settle(featured(docs.select("doc_id", "text"), ["doc_id"]))
    return score_featured(rows, fit_featured(rows, labels), ["doc_id"])
