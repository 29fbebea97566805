"""Out-of-fold experts.

Two families share one output contract, the long OOF table
``(sample_id, label, fold, class, prob)``:

* the *frequency expert* - Laplace-smoothed class share of a sample's dominant
  feature, counted on the other folds.  Count arithmetic only, so it is exact,
  deterministic and checkable against SQL;
* Spark ML experts (``lr``, ``rf``, ``gbt`` one-vs-rest), fitted per fold with
  :func:`fit_oof` (see ``ml.py``).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.scalar import pred_column_name
from ..session import materialize


def dominant_feature(cells: DataFrame, weight: str = "value", group=()) -> DataFrame:
    """``(…group, sample_id, feature)``: the feature with the largest summed
    weight per sample, ties -> smallest feature name.  Two partial aggregates
    (a sample has at most one row per feature in the second)."""
    g = list(group)
    tot = cells.groupBy(*g, "sample_id", "feature").agg(F.sum(weight).alias("_w"))
    return tot.groupBy(*g, "sample_id").agg(
        F.min_by("feature", F.struct((-F.col("_w")).alias("w"), F.col("feature").alias("f")))
        .alias("feature"))


def frequency_model(assigned: DataFrame, classes: list, k: int,
                    label: str = "label", group=()) -> DataFrame:
    """``(…group, feature, fold, class, prob)`` with
    ``prob = (n(f,c) - n_fold(f,c) + 1) / (n(f) - n_fold(f) + K)``.

    ``assigned`` is ``(…group, sample_id, feature, label, fold)``.  The table
    has features x k x K rows per group; its windows partition by (group,
    feature), so each window holds k x K rows whatever the data size.
    """
    g = list(group)
    K = len(classes)
    c = assigned.groupBy(*g, "feature", F.col(label).alias("class"), "fold") \
        .agg(F.count(F.lit(1)).alias("n"))
    grid = assigned.select(*g, "feature").distinct() \
        .select(*g, "feature", F.explode(F.sequence(F.lit(0), F.lit(k - 1))).alias("fold")) \
        .select(*g, "feature", "fold", F.explode(F.array(*[F.lit(x) for x in classes])).alias("class"))
    gr = grid.join(c, [*g, "feature", "class", "fold"], "left").na.fill(0, ["n"])
    n_fc = F.sum("n").over(Window.partitionBy(*g, "feature", "class"))
    n_f = F.sum("n").over(Window.partitionBy(*g, "feature"))
    n_ff = F.sum("n").over(Window.partitionBy(*g, "feature", "fold"))
    prob = (n_fc - F.col("n") + 1).cast("double") / (n_f - n_ff + F.lit(K)).cast("double")
    return gr.select(*g, "feature", "fold",
                     F.col("class").cast(assigned.schema[label].dataType).alias("class"),
                     prob.alias("prob"))


def frequency_expert(cells: DataFrame, folds: DataFrame, classes: list, k: int = 5,
                     weight: str = "value", label: str = "label", group=()) -> DataFrame:
    """Leakage-free OOF probabilities ``(…group, sample_id, label, fold, class, prob)``.

    ``folds`` is ``(sample_id, label, fold)``.  Samples without any cell get
    no prediction (the stacker sees them as missing).  With ``group`` (e.g.
    ``modality``) several experts are fitted in one pass over one input.
    """
    g = list(group)
    dom = dominant_feature(cells, weight, g)
    # one row per (group, sample), read three times below (counts, feature
    # grid, scoring): written once so the raw rows are aggregated only once
    assigned = materialize(dom.join(folds.select("sample_id", label, "fold"), "sample_id"), "assigned")
    model = frequency_model(assigned, classes, k, label, g)
    return assigned.join(model, [*g, "feature", "fold"]).select(
        *g, "sample_id", label, "fold", "class", "prob")


def oof_long_named(oof: DataFrame, modality: str) -> DataFrame:
    """``(sample_id, column, prob)`` with ``column = pred_<modality>_<class>``."""
    return oof.select("sample_id", pred_column_name(modality, F.col("class")).alias("column"), "prob")


def oof_columns(modality: str, classes: list) -> list[str]:
    return [f"pred_{modality}_{c}" for c in classes]


def oof_table(oof: DataFrame, modality: str, classes: list) -> DataFrame:
    """Wide OOF table ``sample_id, pred_<m>_<class> x K`` (bounded pivot)."""
    named = oof_long_named(oof, modality)
    return named.groupBy("sample_id").pivot("column", oof_columns(modality, classes)).agg(F.first("prob"))


def frequency_scores_by_split(cells: DataFrame, folds: DataFrame, classes: list, k: int = 5,
                              weight: str = "value", label: str = "label") -> DataFrame:
    """Training- and validation-row probabilities of every fold's model:
    ``(split, fold, sample_id, label, class, prob)``.

    Fold ``i``'s model (counts of the other folds) scores its own fold
    (``val``) and the other folds' rows (``train``), as a per-fold train /
    validation score table needs.  Each sample is emitted once per fold.
    """
    dom = dominant_feature(cells, weight)
    assigned = materialize(dom.join(folds.select("sample_id", label, "fold"), "sample_id"), "assigned")
    model = frequency_model(assigned, classes, k, label)
    per_fold = assigned.select("sample_id", "feature", label, F.col("fold").alias("_own"),
                               F.explode(F.sequence(F.lit(0), F.lit(k - 1))).alias("fold"))
    per_fold = per_fold.withColumn("split", F.when(F.col("fold") == F.col("_own"), F.lit("val"))
                                   .otherwise(F.lit("train")))
    return per_fold.join(model, ["feature", "fold"]).select(
        "split", "fold", "sample_id", label, "class", "prob")
