"""Spark ML experts with out-of-fold predictions.

* :func:`to_ml_frame` - long cells -> dense vector per sample (bounded feature
  dictionary), label codes, fold; written to the checkpoint folder so the k
  fold fits reuse it and survive executor loss.
* :func:`make_estimator` - model family registry: ``lr`` (multinomial
  logistic regression), ``rf`` (random forest), ``gbt`` (boosted trees; a
  one-vs-rest set of binary GBTs whose K probabilities are normalised, since
  Spark's GBT is binary only).  Unknown keys are rejected.
* :func:`fit_oof` - cross-fitted training: fold ``i`` is scored by a model
  fitted on the other folds; the k fits are submitted concurrently.
* :func:`random_search` - seeded draws from discrete grids, scored by k-fold
  weighted F1; a table of finished (draw, fold) trials lets a rerun go on.
"""

from __future__ import annotations

import os
import random
from concurrent.futures import ThreadPoolExecutor

from pyspark.ml.classification import (GBTClassifier, LogisticRegression,
                                       RandomForestClassifier)
from pyspark.ml.evaluation import MulticlassClassificationEvaluator
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import materialize
from ..sources.paths import child_names, path_exists
from . import reshape as R
from .folds import stratified_holdout
from .joins import MAX_CLASSES, checked_broadcast, class_codes
from .rounds import keep_best


def to_ml_frame(cells: DataFrame, labels: DataFrame, folds: DataFrame | None = None,
                fill=0.0, label: str = "label", materialise: bool = True):
    """``(frame, dictionary, codes)``; frame = sample_id, features, label,
    y (double code) [, fold]."""
    dictionary = R.feature_dictionary(cells)
    d = dictionary.count()
    vec = R.assemble(R.align_long(cells, dictionary), d, fill)
    codes = class_codes(labels, label)
    lab = labels.select("sample_id", label).join(checked_broadcast(codes, MAX_CLASSES), label) \
        .withColumn("y", F.col("code").cast("double")).drop("code")
    frame = vec.join(lab, "sample_id")
    if folds is not None:
        frame = frame.join(folds.select("sample_id", "fold"), "sample_id")
    if materialise:
        frame = materialize(frame, "ml_frame")
    return frame, dictionary, codes


def wide_ml_frame(wide: DataFrame, cols: list[str], label: str = "label",
                  codes: DataFrame | None = None) -> tuple[DataFrame, DataFrame]:
    codes = codes if codes is not None else class_codes(wide, label)
    vec = VectorAssembler(inputCols=list(cols), outputCol="features", handleInvalid="keep").transform(wide)
    x = vec.join(checked_broadcast(codes, MAX_CLASSES), label).withColumn("y", F.col("code").cast("double")).drop("code")
    return x, codes


class OneVsRestGBT:
    """K binary GBTs (class c vs rest); probabilities normalised to sum 1."""

    def __init__(self, n_classes: int, parallel: int = 2, **params):
        self.n_classes = n_classes
        self.parallel = parallel  # class fits in flight per fold (folds already run concurrently)
        self.params = params

    def fit(self, df: DataFrame) -> "OneVsRestGBTModel":
        def one(c):
            est = GBTClassifier(featuresCol="features", labelCol="_yc", seed=42, **self.params)
            est.setProbabilityCol(f"_prob{c}").setRawPredictionCol(f"_raw{c}").setPredictionCol(f"_pred{c}")
            return est.fit(df.withColumn("_yc", (F.col("y") == c).cast("double")))
        with ThreadPoolExecutor(max_workers=max(1, min(self.parallel, self.n_classes))) as pool:
            models = list(pool.map(one, range(self.n_classes)))
        return OneVsRestGBTModel(models)


class OneVsRestGBTModel:
    def __init__(self, models):
        self.models = models

    def transform(self, df: DataFrame) -> DataFrame:
        out = df
        for m in self.models:
            out = m.transform(out)
        ps = [vector_to_array(F.col(f"_prob{c}"))[1] for c in range(len(self.models))]
        total = sum(ps[1:], ps[0])
        arr = F.array(*[p / total for p in ps])
        drop = [c for c in out.columns if c.startswith(("_prob", "_raw", "_pred"))]
        return out.withColumn("probability_array", arr).drop(*drop)


def make_estimator(kind: str, n_classes: int, **params):
    if kind == "lr":
        p = {"maxIter": 1000, "family": "multinomial"}
        p.update(params)
        return LogisticRegression(featuresCol="features", labelCol="y", **p)
    if kind == "rf":
        p = {"numTrees": 200, "seed": 42}
        p.update(params)
        return RandomForestClassifier(featuresCol="features", labelCol="y", **p)
    if kind in ("gbt", "lgbm", "xgb"):
        p = {"maxIter": 200}
        p.update(params)
        if n_classes == 2:
            return GBTClassifier(featuresCol="features", labelCol="y", seed=42, **p)
        return OneVsRestGBT(n_classes, **p)
    raise ValueError(f"unknown model kind {kind!r}")


def probabilities(model, df: DataFrame) -> DataFrame:
    """``(sample_id, code, prob)`` rows from any fitted model."""
    out = model.transform(df)
    arr = F.col("probability_array") if "probability_array" in out.columns \
        else vector_to_array(F.col("probability"))
    return out.select("sample_id", F.posexplode(arr).alias("code", "prob"))


def fit_oof(frame: DataFrame, kind: str, codes: DataFrame, k: int = 5, holdout: bool = False,
            parallel: int = 5, patience: int = 10, **params):
    """Cross-fitted OOF probabilities ``(sample_id, label, fold, class, prob)``
    and the fold models.  With ``holdout`` (GBT only) all rounds are fitted
    without an inner stratified 20% hold-out of the training folds, and each
    model keeps its rounds up to the least hold-out loss that is reached before
    ``patience`` rounds in a row gain nothing."""
    n_classes = codes.count()
    early = holdout and kind in ("gbt", "lgbm", "xgb")
    trains = [frame.where(F.col("fold") != i) for i in range(k)]
    if early:
        trains = [stratified_holdout(x, "sample_id", "label", 0.2, 42) for x in trains]

    def fit_fold(i):
        train = trains[i].where(~F.col("is_holdout")) if early else trains[i]
        return make_estimator(kind, n_classes, **params).fit(train)

    with ThreadPoolExecutor(max_workers=max(1, min(parallel, k))) as pool:
        models = list(pool.map(fit_fold, range(k)))
    if early:
        models, _ = keep_best(models, [x.where("is_holdout") for x in trains], patience)
    parts = []
    for i, m in enumerate(models):
        val = frame.where(F.col("fold") == i)
        p = probabilities(m, val).withColumn("fold", F.lit(i))
        parts.append(p)
    probs = parts[0]
    for p in parts[1:]:
        probs = probs.unionByName(p)
    named = probs.join(checked_broadcast(codes.withColumnRenamed("label", "class"), MAX_CLASSES), "code") \
        .join(frame.select("sample_id", "label"), "sample_id")
    return named.select("sample_id", "label", "fold", "class", "prob"), models


def fit_folds(frame: DataFrame, estimator, k: int, parallel: int = 5) -> list:
    """One model per fold, fitted on the rows of the other folds; the fits are submitted concurrently."""
    with ThreadPoolExecutor(max_workers=max(1, min(parallel, k))) as pool:
        return list(pool.map(lambda i: estimator.fit(frame.where(F.col("fold") != i)), range(k)))


def fit_final(frame: DataFrame, kind: str, codes: DataFrame, **params):
    return make_estimator(kind, codes.count(), **params).fit(frame)


# The discrete search grids of the binary stacker's random
# search (rounds, learning rate, depth, column sample, row sample, minimum
# leaf size), mapped onto Spark GBT parameters.  Leaf count and L1/L2 leaf
# penalties have no Spark GBT counterpart and are not searched.
SEARCH_GRID = {
    "maxIter": [100, 200, 300, 500],
    "stepSize": [0.01, 0.02, 0.03, 0.05],
    "maxDepth": [2, 3, 5],
    "featureSubsetStrategy": ["0.7", "0.8", "0.9", "1.0"],
    "subsamplingRate": [0.7, 0.8, 0.9, 1.0],
    "minInstancesPerNode": [10, 20, 30],
}
# Positive-class weight choices besides the computed ratio.
POSITIVE_WEIGHTS = [1.0, 0.5, 2.0]


def draw_params(n_iter: int, seed: int = 42, grid: dict | None = None) -> list[dict]:
    grid = grid or SEARCH_GRID
    rng = random.Random(seed)
    return [{k: rng.choice(v) for k, v in sorted(grid.items())} for _ in range(n_iter)]


def with_weight_columns(frame: DataFrame, class_ratio: float) -> tuple[DataFrame, list[str]]:
    """One weight column per positive-weight choice (positive rows weighted)."""
    names = []
    for i, w in enumerate([class_ratio] + POSITIVE_WEIGHTS):
        n = f"_w{i}"
        frame = frame.withColumn(n, F.when(F.col("y") == 1.0, F.lit(float(w))).otherwise(F.lit(1.0)))
        names.append(n)
    return frame, names


TRIALS = "draw int, fold int, params string, f1 double"


def random_search(frame: DataFrame, n_iter: int = 100, seed: int = 42, parallelism: int = 4,
                  grid: dict | None = None, class_ratio: float | None = None, trial_path: str | None = None):
    """Seeded draws scored by k-fold weighted F1 (``fold`` column).

    Returns ``(best_params, best_score, trials DataFrame)``.  With
    ``class_ratio`` the positive-class weight is searched too (as a choice of
    weight column).

    Every trial is one (draw, fold); ``parallelism`` fits are in flight.  With
    ``trial_path`` each finished trial is written to a folder of its own there, and a
    rerun fits only what is missing: a trial counts as finished if its draw,
    fold and parameters are those of this search.  The path belongs to one
    input; a search over other rows takes another path."""
    grid = dict(grid or SEARCH_GRID)
    if class_ratio is not None:
        frame, wcols = with_weight_columns(frame, class_ratio)
        grid["weightCol"] = wcols
    draws = draw_params(n_iter, seed, grid)
    texts = [str(sorted(d.items())) for d in draws]
    k = int(frame.agg(F.max("fold")).first()[0]) + 1
    spark = frame.sparkSession
    done = finished_trials(spark, trial_path, texts, k)

    def trial(at):
        i, fold = at
        est = GBTClassifier(featuresCol="features", labelCol="y", seed=seed).setParams(**draws[i])
        scored = est.fit(frame.where(F.col("fold") != fold)).transform(frame.where(F.col("fold") == fold))
        ev = MulticlassClassificationEvaluator(labelCol="y", predictionCol="prediction", metricName="f1")
        f1 = float(ev.evaluate(scored))
        if trial_path:
            spark.createDataFrame([(i, fold, texts[i], f1)], TRIALS).coalesce(1) \
                .write.mode("overwrite").parquet(os.path.join(trial_path, f"trial-{i}-{fold}"))
        return at, f1

    todo = [(i, f) for i in range(n_iter) for f in range(k) if (i, f) not in done]
    with ThreadPoolExecutor(max_workers=max(1, parallelism)) as pool:
        done.update(pool.map(trial, todo))
    scores = [sum(done[i, f] for f in range(k)) / k for i in range(n_iter)]
    best = max(range(len(scores)), key=lambda i: scores[i])
    trials = spark.createDataFrame([(i, texts[i], sc) for i, sc in enumerate(scores)],
                                   "trial int, params string, mean_f1 double")
    return draws[best], scores[best], trials


def finished_trials(spark, trial_path: str | None, texts: list[str], k: int) -> dict[tuple[int, int], float]:
    """``{(draw, fold): f1}`` of the written trials whose parameters are those of ``texts``.
    A folder whose write did not end (no ``_SUCCESS`` file) doesn't count."""
    if not trial_path or not path_exists(spark, trial_path):
        return {}
    whole = [os.path.join(trial_path, n) for n in child_names(spark, trial_path)
             if n.startswith("trial-") and path_exists(spark, os.path.join(trial_path, n, "_SUCCESS"))]
    if not whole:
        return {}
    rows = spark.read.schema(TRIALS).parquet(*whole).collect()  # draws x folds rows
    return {(r["draw"], r["fold"]): r["f1"] for r in rows
            if r["draw"] < len(texts) and r["fold"] < k and texts[r["draw"]] == r["params"]}
