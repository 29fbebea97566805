"""Losses of every round of boosted models, and the round to keep.

* :func:`round_losses` - one pass over the rows of all folds: each task adds the
  trees of its fold's models up one after the other, so that every prefix of an
  ensemble is scored on the way, and hands on one sum per model and round.
* :func:`kept_rounds` - patience: the round of the least held-out loss, where
  the search ends once ``patience`` rounds in a row have not lowered it.
* :func:`truncate` - the first rounds of a fitted model as a model of its own.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator
from concurrent.futures import ThreadPoolExecutor

import numpy as np
import pyarrow as pa
from pyspark.ml.classification import GBTClassificationModel
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .treeshap import node_tables


class FlatTrees:
    """Trees of one model as arrays; a leaf is its own child."""

    def __init__(self, trees: dict, weights: list[float]):
        self.trees = []
        for t, nodes in sorted(trees.items()):
            ids = sorted(nodes)
            place = {i: p for p, i in enumerate(ids)}
            own = [nodes[i] for i in ids]
            inner = [n["leftChild"] >= 0 for n in own]
            self.trees.append((
                np.array([int(n["featureIndex"]) if k else 0 for n, k in zip(own, inner)]),
                np.array([float(n["leftCategoriesOrThreshold"][0]) if k else 0.0 for n, k in zip(own, inner)]),
                np.array([place[n["leftChild"]] if k else p for p, (n, k) in enumerate(zip(own, inner))]),
                np.array([place[n["rightChild"]] if k else p for p, (n, k) in enumerate(zip(own, inner))]),
                np.array(inner), np.array([float(n["prediction"]) for n in own]) * weights[t]))

    def margins(self, x: np.ndarray) -> Iterator[np.ndarray]:
        """The margin of all rows after each round."""
        rows, margin = np.arange(len(x)), np.zeros(len(x))
        for feature, threshold, left, right, inner, value in self.trees:
            at = np.zeros(len(x), int)
            while inner[at].any():
                # Spark sends x to the left if x <= t, anything else (NaN too) to the right
                at = np.where(x[rows, feature[at]] <= threshold[at], left[at], right[at])
            margin = margin + value[at]
            yield margin


def _losses(fold: int, shared):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums, count = defaultdict(float), 0
        for batch in batches:
            lists = batch.column(0)
            bounds = lists.offsets.to_numpy()
            x = lists.values.to_numpy(zero_copy_only=False)[bounds[0]:bounds[-1]].reshape(batch.num_rows, -1)
            y = batch.column(1).to_numpy(zero_copy_only=False)
            count += len(y)
            for code, target, trees in shared.value[fold]:
                side = np.where(y == target, 2.0, -2.0)
                for r, margin in enumerate(trees.margins(x)):
                    sums[code, r + 1] += float(2 * np.logaddexp(0, -side * margin).sum())
        if count:
            keys = sorted(sums)
            yield pa.RecordBatch.from_arrays(
                [pa.array([fold] * len(keys), pa.int32()), pa.array([c for c, _ in keys], pa.int32()),
                 pa.array([r for _, r in keys], pa.int32()), pa.array([sums[k] for k in keys], pa.float64()),
                 pa.array([count] * len(keys), pa.int64())], names=["fold", "code", "round", "s", "n"])
    return run


def round_losses(models: list, parts: list[DataFrame]) -> DataFrame:
    """``(fold, code, round, loss)``: the mean log loss after every round of ``models[fold]``
    over the rows ``(features, y)`` of ``parts[fold]``.

    A model is a binary GBT (``code`` 1) or a one-vs-rest set (one row set per class code).
    Weights of rows play no part. A fold without rows has no curve."""
    flat = [[(c, float(c), m) for c, m in enumerate(m.models)] if hasattr(m, "models") else [(1, 1.0, m)] for m in models]
    spark = parts[0].sparkSession
    with ThreadPoolExecutor(max_workers=4) as pool:
        tables = list(pool.map(lambda m: FlatTrees(*node_tables(m, spark)), [m for f in flat for _, _, m in f]))
    each = iter(tables)
    shared = spark.sparkContext.broadcast(  # as large as the models
        [[(c, target, next(each)) for c, target, _ in f] for f in flat])
    sums = None
    for fold, rows in enumerate(parts):
        own = rows.select(vector_to_array("features").alias("x"), F.col("y").cast("double").alias("y")) \
            .mapInArrow(_losses(fold, shared), "fold int, code int, round int, s double, n bigint")
        sums = own if sums is None else sums.unionByName(own)
    return sums.groupBy("fold", "code", "round").agg((F.sum("s") / F.sum("n")).alias("loss"))


def kept_rounds(losses: list[float], patience: int) -> int:
    """Rounds up to the least loss that is reached before ``patience`` rounds in a row gain nothing."""
    best = 0
    for i, loss in enumerate(losses):
        if loss < losses[best]:
            best = i
        elif i - best >= patience:
            break
    return best + 1


def truncate(model: GBTClassificationModel, rounds: int) -> GBTClassificationModel:
    """The model of the first ``rounds`` rounds, with the columns and settings of ``model``."""
    if rounds >= model.getNumTrees:
        return model
    sc = SparkSession.getActiveSession().sparkContext
    jvm, java = sc._jvm, model._java_obj
    trees = sc._gateway.new_array(jvm.org.apache.spark.ml.regression.DecisionTreeRegressionModel, rounds)
    weights = sc._gateway.new_array(jvm.double, rounds)
    all_trees, all_weights = java.trees(), java.treeWeights()
    for i in range(rounds):
        trees[i], weights[i] = all_trees[i], float(all_weights[i])
    cut = GBTClassificationModel(jvm.org.apache.spark.ml.classification.GBTClassificationModel(
        java.uid(), trees, weights, java.numFeatures(), java.numClasses()))
    cut._resetUid(model.uid)
    model._copyValues(cut)
    cut._transfer_params_to_java()
    return cut


def keep_best(models: list, holdouts: list[DataFrame], patience: int) -> tuple[list, dict]:
    """Every model cut to the round that :func:`kept_rounds` picks on its fold's hold-out rows,
    and the rounds kept ``{(fold, code): rounds}``.  A fold without hold-out rows keeps all."""
    curves = defaultdict(list)
    # rounds x classes x folds values
    for r in sorted(round_losses(models, holdouts).collect(), key=lambda r: (r["fold"], r["code"], r["round"])):
        curves[r["fold"], r["code"]].append(r["loss"])
    kept = {k: kept_rounds(v, patience) for k, v in curves.items()}
    out = []
    for fold, model in enumerate(models):
        if hasattr(model, "models"):
            model.models = [truncate(m, kept.get((fold, c), m.getNumTrees)) for c, m in enumerate(model.models)]
            out.append(model)
        else:
            out.append(truncate(model, kept.get((fold, 1), model.getNumTrees)))
    return out, kept
