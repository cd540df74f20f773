"""Gradient-boosted trees: trained by Spark ML on a bounded sample, calibrated
by isotonic regression, and exported as flat arrays so that a scan over texts
can score its rows in place."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.ml.classification import GBTClassifier
from pyspark.ml.functions import array_to_vector
from pyspark.ml.regression import IsotonicRegression
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Rows of the sample that one task holds in each of the training's many passes, about.
TASK_ROWS = 2_000


@dataclass(frozen=True)
class Boosted:
    """Trees as arrays (feature -1: a leaf), and the isotonic steps that map the
    margin to a probability. Without trees every row gets ``prior``."""

    trees: tuple[tuple[np.ndarray, ...], ...]
    weights: tuple[float, ...]
    margins: np.ndarray
    probabilities: np.ndarray
    prior: float

    def margin(self, x: np.ndarray) -> np.ndarray:
        out = np.zeros(len(x))
        rows = np.arange(len(x))
        for weight, (feature, threshold, left, right, value) in zip(self.weights, self.trees, strict=True):
            at = np.zeros(len(x), dtype=np.int64)
            while (inner := feature[at] >= 0).any():
                low = x[rows, np.maximum(feature[at], 0)] <= threshold[at]
                at = np.where(inner, np.where(low, left[at], right[at]), at)
            out += weight * value[at]
        return out

    def probability(self, x: np.ndarray) -> np.ndarray:
        if not self.trees:
            return np.full(len(x), self.prior)
        return np.clip(np.interp(self.margin(x), self.margins, self.probabilities), 0.0, 1.0)


def _flat(root) -> tuple[np.ndarray, ...]:
    rows: list[list[float]] = []

    def walk(node) -> int:
        rows.append([-1, 0.0, 0, 0, node.prediction()])
        k = len(rows) - 1
        if node.getClass().getSimpleName() == "InternalNode":
            rows[k][:2] = node.split().featureIndex(), node.split().threshold()
            rows[k][2], rows[k][3] = walk(node.leftChild()), walk(node.rightChild())
        return k

    walk(root)
    feature, threshold, left, right, value = zip(*rows, strict=True)
    return (np.array(feature, dtype=np.int64), np.array(threshold), np.array(left, dtype=np.int64),
            np.array(right, dtype=np.int64), np.array(value))


def fit(sample: DataFrame, *, rounds: int = 15, depth: int = 4, step: float = 0.3, held: float = 0.3) -> Boosted:
    """Boosted trees for ``sample``: features array<double>, label int, key (any
    value; its hash sets a share ``held`` aside, on which the isotonic steps are
    fitted). The caller bounds the sample. With fewer than 20 rows, or one class
    only, nothing is learned: the score is the share of label 1, but under 0.5, so
    that such a model rejects nothing. The passes over the sample run in few tasks,
    however many its scan has: there are some hundreds of them."""
    rows = sample.select(array_to_vector("features").alias("features"), F.col("label").cast("double").alias("label"),
                         (F.pmod(F.xxhash64("key"), F.lit(1000)) < int(1000 * held)).alias("held")).persist()
    try:
        got = {(r.held, r.label): r["count"] for r in rows.groupBy("held", "label").count().collect()}
        n, ones = sum(got.values()), sum(v for (_, y), v in got.items() if y == 1)
        if n < 20 or len(got) < 4:
            return Boosted((), (), np.zeros(1), np.zeros(1), min(0.49, ones / n) if n else 0.0)
        model = GBTClassifier(maxIter=rounds, maxDepth=depth, stepSize=step, minInstancesPerNode=5, maxBins=64,
                              seed=7).fit(rows.filter("not held").coalesce(max(2, -(-n // TASK_ROWS))))
        java = model._java_obj  # the trees' nodes have no Python form
        trees = tuple(_flat(t.rootNode()) for t in java.trees())
        weights = tuple(float(w) for w in java.treeWeights())
        bare = Boosted(trees, weights, np.zeros(1), np.zeros(1), 0.0)
        aside = rows.filter("held").select("features", "label").collect()
        margin = bare.margin(np.array([r.features.toArray() for r in aside]))
        # From an Arrow table: a list would start Python workers of another kind, which then stay.
        steps = IsotonicRegression().fit(sample.sparkSession.createDataFrame(
            pa.table({"features": margin, "label": pa.array([r.label for r in aside], pa.float64())})))
        return Boosted(trees, weights, np.array(steps.boundaries.toArray()), np.array(steps.predictions.toArray()), 0.0)
    finally:
        rows.unpersist()
