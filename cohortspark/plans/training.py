"""Training jobs (entry points B and C): Spark ML experts per modality, the
multiclass stacker and the binary stacker with random search.

Every job takes lazily defined inputs, writes its vector frame once to the
checkpoint folder (lineage cut, reused by the k fold fits), and returns
DataFrames: OOF probabilities, predictions, scores, attributions.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators import experts as X
from ..operators import folds as FO
from ..operators import joins as J
from ..operators import metrics as M
from ..operators import ml as ML
from ..operators import stats as ST
from ..operators.topk import argmax_class
from ..session import materialize, spread
from ..sources.tables import Tables
from . import bindings as B
from .queries import K_FOLDS
from .queries_eval import meta_table

# Multiclass stacker settings (rounds, learning rate, depth).
STACKER_PARAMS = {"maxIter": 100, "stepSize": 0.05, "maxDepth": 3}
# Rounds of the final binary model.
BINARY_FINAL_ROUNDS = 500
# Rounds without a gain after which boosting ends (experts, binary stacker).
EXPERT_PATIENCE, BINARY_PATIENCE = 10, 100


def expression_frame(t: Tables):
    from ..operators import reshape as R
    cells = R.cell_mean(B.expression_long(t))
    folds = FO.stratified_folds(B.samples(t), "sample_id", "label", K_FOLDS, 42)
    return ML.to_ml_frame(cells, B.samples(t), folds)


def train_expert(t: Tables, kind: str, **params):
    frame, dictionary, codes = expression_frame(t)
    oof, models = ML.fit_oof(frame, kind, codes, K_FOLDS,
                             holdout=kind in ("gbt", "lgbm", "xgb"), patience=EXPERT_PATIENCE, **params)
    return oof, models, frame, dictionary, codes


def oof_predictions(oof: DataFrame) -> DataFrame:
    pred = argmax_class(oof)
    return oof.select("sample_id", "label", "fold").distinct().join(pred, "sample_id")


def train_stacker(t: Tables, **params):
    """Multiclass stacker on the outer-joined OOF table."""
    meta, cols, classes = meta_table(t)
    meta = meta.join(FO.stratified_folds(B.samples(t)).select("sample_id", "fold"), "sample_id")
    frame, codes = ML.wide_ml_frame(meta, cols)
    frame = materialize(spread(frame, t.customer.count(), "sample_id", width=len(cols)), "stacker_frame")
    p = dict(STACKER_PARAMS)
    p.update(params)
    oof, models = ML.fit_oof(frame, "gbt", codes, K_FOLDS, **p)
    return oof, models, frame, cols, codes


def document_binary_meta(t: Tables) -> tuple[DataFrame, list[str]]:
    """Binary meta table: two document experts (source, language), each
    harmonised to ``pred_<m>_normal_prob`` / ``pred_<m>_cancer_prob``."""
    docs = B.binary_documents(t)
    folds = FO.stratified_folds(docs, "sample_id", "label", K_FOLDS, 42)
    parts, cols = [], []
    for m, col in (("src", "source"), ("lang", "lang")):
        cells = docs.select("sample_id", F.col(col).alias("feature"), F.lit(1).alias("w"))
        oof = X.frequency_expert(cells, folds, [0, 1], K_FOLDS, "w").where(F.col("class") == 1)
        h = J.harmonise_binary(oof.select("sample_id", F.col("prob").alias(f"pred_{m}_binary")), m)
        parts.append(h)
        cols += [c for c in h.columns if c != "sample_id"]
    meta = parts[0]
    for p in parts[1:]:
        meta = meta.join(p, "sample_id", "full_outer")
    meta = J.fill_uninformative(meta, cols, 2)
    meta = J.attach_labels(meta, docs.select("sample_id", "label")).join(
        folds.select("sample_id", "fold"), "sample_id")
    return meta, cols


def train_binary_stacker(t: Tables, n_iter: int = 100, params: str = "best", grid: dict | None = None,
                         trial_path: str | None = None):
    """Binary stacker (L8-L10): class weight, random search, CV with an inner
    hold-out, threshold 0.5; final model refit on all rows."""
    meta, cols = document_binary_meta(t)
    frame, codes = ML.wide_ml_frame(meta, cols, "label")
    frame = materialize(frame, "binary_frame")
    ratio = ST.class_weight(frame, "y", 1.0).first()[0]
    best, best_score, trials = ML.random_search(frame, n_iter, 42, grid=grid, class_ratio=float(ratio),
                                               trial_path=trial_path)
    # the tuned weight is one of the weight columns; folds and refit use it like the search
    weighted, _ = ML.with_weight_columns(frame, float(ratio))
    oof, models = ML.fit_oof(weighted, "gbt", codes, K_FOLDS, holdout=True, patience=BINARY_PATIENCE, **best)
    final_params = best if params == "best" else {"maxIter": BINARY_FINAL_ROUNDS, "weightCol": "_w0"}
    final = ML.make_estimator("gbt", 2, **final_params).fit(weighted)
    return oof, trials, best_score, final, frame


def binary_scores(oof: DataFrame) -> DataFrame:
    s = oof.where(F.col("class") == 1).select("sample_id", "label", "fold", F.col("prob").alias("score"))
    return s.withColumn("pred", (F.col("score") > 0.5).cast("int"))


def binary_fold_scores(scores: DataFrame) -> DataFrame:
    acc = M.accuracy(scores, ("fold",)).select("fold", F.lit("acc").alias("metric"), F.col("accuracy").alias("value"))
    f1 = M.f1_binary(scores, ("fold",)).select("fold", F.lit("f1").alias("metric"), F.col("f1").alias("value"))
    auc = M.roc_auc(scores, ("fold",), "label", "score").select(
        "fold", F.lit("auc").alias("metric"), F.col("auc").alias("value"))
    return acc.unionByName(f1).unionByName(auc)

