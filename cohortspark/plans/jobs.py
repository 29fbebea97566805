"""File-to-file jobs for the entry points integration, expert training and
stacking, for users who run the steps on their own cohort files rather than
on the driver tables (the sample-dataset job is ``features.py``).

Each job reads its inputs lazily, runs as Spark jobs, and writes parquet
outputs plus small parameter tables; the CLI (``python -m cohortspark``)
takes a JSON config.
"""

from __future__ import annotations

import os
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.scalar import pred_column_name
from ..operators import folds as FO
from ..operators import joins as J
from ..operators import metrics as M
from ..operators import ml as ML
from ..operators.topk import argmax_class
from ..session import materialize
from ..sources import sinks as SK
from ..sources.ingest import EVENTS, CohortSource, scan_cohorts
from . import integrate as I
from .training import EXPERT_PATIENCE, STACKER_PARAMS


def registry_table(spark: SparkSession, sources: list[CohortSource]) -> DataFrame:
    """``(cohort, ordinal)`` in registry order (bounded by the source list)."""
    return spark.createDataFrame([(s.cohort, i) for i, s in enumerate(sources)], "cohort string, ordinal int")


def integration_job(spark: SparkSession, sources: list[CohortSource], out_dir: str,
                    prefix: str | None = None, coerce: bool = True) -> dict:
    """Entry point A: cohort files -> ``cells`` (long), ``labels``, ``report``."""
    long, report = scan_cohorts(spark, sources)
    if all(s.layout == EVENTS for s in sources):
        cells = I.integrate_events_labelled(long, registry_table(spark, sources))
    else:
        cells = I.integrate_long_labelled(long, registry_table(spark, sources), prefix, coerce,
                                          value_is_string=True)
    cells = materialize(cells, "integrated")
    paths = {name: os.path.join(out_dir, name) for name in ("cells", "labels", "report", "summary")}
    SK.write_matrix(cells.select("sample_id", "feature", F.col("value").cast("double")), paths["cells"])
    labels = cells.select("sample_id", "label").distinct()
    SK.write_matrix(labels, paths["labels"])
    SK.write_matrix(report, paths["report"])
    summary = cells.agg(F.countDistinct("sample_id").alias("n_samples"),
                        F.countDistinct("feature").alias("n_features"),
                        F.countDistinct("label").alias("n_labels"))
    SK.write_matrix(summary, paths["summary"])
    return paths


def expert_job(spark: SparkSession, cells_path: str, labels_path: str, modality: str, out_dir: str,
               kind: str = "gbt", k: int = 5, seed: int = 42, **params) -> dict:
    """Entry point B: one expert per modality with OOF predictions, fold
    scores (acc / f1 / auc / log loss) and the fold models."""
    cells = spark.read.parquet(cells_path)
    labels = spark.read.parquet(labels_path)
    folds = FO.stratified_folds(labels, "sample_id", "label", k, seed)
    frame, dictionary, codes = ML.to_ml_frame(cells, labels, folds)
    oof, models = ML.fit_oof(frame, kind, codes, k, holdout=kind in ("gbt", "lgbm", "xgb"), patience=EXPERT_PATIENCE, **params)
    oof = materialize(oof, f"oof_{modality}")
    classes = [r["label"] for r in codes.orderBy("code").collect()]
    preds = oof.select("sample_id", "label", "fold").distinct().join(argmax_class(oof), "sample_id")
    scores = M.fold_scores(preds, oof, classes, ("fold",))
    paths = {n: os.path.join(out_dir, n) for n in ("oof", "oof_wide", "fold_scores", "run")}
    SK.write_matrix(oof.withColumn("modality", F.lit(modality)), paths["oof"])
    from ..operators.experts import oof_table
    SK.write_oof(oof_table(oof, modality, classes), paths["oof_wide"])
    SK.write_matrix(scores, paths["fold_scores"])
    saved = {}
    for i, m in enumerate(models):
        if hasattr(m, "write"):
            saved[f"fold{i}"] = m
        else:  # one-vs-rest: one binary model per class
            saved.update({f"fold{i}_class{c}": cm for c, cm in enumerate(m.models)})
    SK.save_run(paths["run"], saved,
                {"dictionary": dictionary, "codes": codes}, {"modality": modality, "kind": kind, "k": k})
    return paths


def stacking_job(spark: SparkSession, oof_paths: list[str], labels_path: str, out_dir: str,
                 k: int = 5, seed: int = 42, **params) -> dict:
    """Entry point C: outer-joined OOF table (union + bounded pivot), labels,
    uninformative fill 1/K, multiclass stacker OOF and its report."""
    oofs = [spark.read.parquet(p) for p in oof_paths]
    long = reduce(lambda a, b: a.unionByName(b), [
        o.select("sample_id", pred_column_name(F.col("modality"), F.col("class")).alias("column"), "prob")
        for o in oofs])
    labels = spark.read.parquet(labels_path)
    classes = J.class_list(labels)
    cols = sorted(r[0] for r in long.select("column").distinct().collect())  # bounded: modalities x classes
    meta = J.fill_uninformative(J.attach_labels(J.stack_outer(long, cols), labels), cols, len(classes))
    meta = meta.join(FO.stratified_folds(labels, "sample_id", "label", k, seed).select("sample_id", "fold"),
                     "sample_id")
    frame, codes = ML.wide_ml_frame(meta, cols)
    frame = materialize(frame, "stack_frame")
    p = dict(STACKER_PARAMS, **params)
    oof, _ = ML.fit_oof(frame, "gbt", codes, k, **p)
    preds = oof.select("sample_id", "label", "fold").distinct().join(argmax_class(oof), "sample_id")
    report = M.classification_report(M.confusion_matrix(preds, classes))
    paths = {n: os.path.join(out_dir, n) for n in ("meta", "stacker_oof", "report")}
    SK.write_matrix(meta.drop("fold"), paths["meta"])
    SK.write_matrix(oof, paths["stacker_oof"])
    SK.write_matrix(report, paths["report"])
    return paths
