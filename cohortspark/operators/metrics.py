"""Exact evaluation metrics as DataFrame aggregates.

Inputs use two shapes:
* predictions ``(…group, label, pred)`` - one row per scored sample;
* long probabilities ``(…group, sample_id, label, class, prob)``.

Built-in evaluators return one scalar or bin scores (``numBins``); these are
exact, grouped (per fold, per split) and keep zero cells.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .ordered import running_totals_before


def accuracy(preds: DataFrame, group=(), label="label", pred="pred") -> DataFrame:
    return preds.groupBy(*group).agg(
        F.avg((F.col(label) == F.col(pred)).cast("double")).alias("accuracy"))


def confusion_counts(preds: DataFrame, group=(), label="label", pred="pred") -> DataFrame:
    return preds.groupBy(*group, label, pred).agg(F.count(F.lit(1)).alias("n"))


def confusion_matrix(preds: DataFrame, classes: list, group=(), label="label",
                     pred="pred") -> DataFrame:
    """Long K x K confusion table ``(…group, label, pred, n)`` with zero cells.

    The spine is every observed (group, true label) row exploded over the
    bounded class list - no join of two data-sized sides.
    """
    counts = confusion_counts(preds, group, label, pred)
    spine = preds.select(*group).distinct() if group else None
    cls = F.array(*[F.lit(c) for c in classes])
    base = (spine if spine is not None else preds.sparkSession.range(1).select())
    grid = base.select(*group, F.explode(cls).alias(label)).select(
        *group, label, F.explode(cls).alias(pred))
    return grid.join(counts, [*group, label, pred], "left") \
        .select(*group, label, pred, F.coalesce("n", F.lit(0)).cast("long").alias("n"))


def _per_class(confusion: DataFrame, group=(), label="label", pred="pred") -> DataFrame:
    sup = confusion.groupBy(*group, F.col(label).alias("class")).agg(
        F.sum("n").alias("support"),
        F.sum(F.when(F.col(label) == F.col(pred), F.col("n")).otherwise(0)).alias("tp"))
    prd = confusion.groupBy(*group, F.col(pred).alias("class")).agg(F.sum("n").alias("predicted"))
    t = sup.join(prd, [*group, "class"], "full_outer").na.fill(0, ["support", "tp", "predicted"])
    precision = F.when(F.col("predicted") > 0, F.col("tp") / F.col("predicted")).otherwise(0.0)
    recall = F.when(F.col("support") > 0, F.col("tp") / F.col("support")).otherwise(0.0)
    t = t.select(*group, F.col("class").cast("string").alias("class"),
                 precision.alias("precision"), recall.alias("recall"), "support", "tp")
    f1 = F.when(F.col("precision") + F.col("recall") > 0,
                2 * F.col("precision") * F.col("recall") / (F.col("precision") + F.col("recall"))) \
        .otherwise(0.0)
    return t.withColumn("f1", f1)


def classification_report(confusion: DataFrame, group=(), label="label", pred="pred") -> DataFrame:
    """Per-class precision / recall / f1 / support plus ``accuracy``,
    ``macro avg`` and ``weighted avg`` rows (accuracy row: f1 = accuracy)."""
    pc = _per_class(confusion, group, label, pred)
    per = pc.select(*group, "class", "precision", "recall", "f1",
                    F.col("support").cast("long").alias("support"))
    tot = pc.groupBy(*group).agg(
        F.sum("support").alias("_s"), F.sum("tp").alias("_tp"),
        F.avg("precision").alias("_mp"), F.avg("recall").alias("_mr"), F.avg("f1").alias("_mf"),
        F.sum(F.col("precision") * F.col("support")).alias("_wp"),
        F.sum(F.col("recall") * F.col("support")).alias("_wr"),
        F.sum(F.col("f1") * F.col("support")).alias("_wf"))
    s = F.col("_s")
    acc = tot.select(*group, F.lit("accuracy").alias("class"), F.lit(None).cast("double").alias("precision"),
                     F.lit(None).cast("double").alias("recall"), (F.col("_tp") / s).alias("f1"),
                     s.cast("long").alias("support"))
    macro = tot.select(*group, F.lit("macro avg").alias("class"), F.col("_mp").alias("precision"),
                       F.col("_mr").alias("recall"), F.col("_mf").alias("f1"), s.cast("long").alias("support"))
    weighted = tot.select(*group, F.lit("weighted avg").alias("class"), (F.col("_wp") / s).alias("precision"),
                          (F.col("_wr") / s).alias("recall"), (F.col("_wf") / s).alias("f1"),
                          s.cast("long").alias("support"))
    return per.unionByName(acc).unionByName(macro).unionByName(weighted)


def f1_weighted(confusion: DataFrame, group=(), label="label", pred="pred") -> DataFrame:
    pc = _per_class(confusion, group, label, pred)
    return pc.groupBy(*group).agg(
        (F.sum(F.col("f1") * F.col("support")) / F.sum("support")).alias("f1_weighted"))


def f1_binary(preds: DataFrame, group=(), label="label", pred="pred", positive=1) -> DataFrame:
    y, p = F.col(label) == F.lit(positive), F.col(pred) == F.lit(positive)
    tp, fp, fn = F.count_if(y & p), F.count_if(~y & p), F.count_if(y & ~p)
    return preds.groupBy(*group).agg(
        F.when(2 * tp + fp + fn > 0, 2 * tp / (2 * tp + fp + fn)).otherwise(0.0).alias("f1"))


def binary_summary(preds: DataFrame, group=(), label="label", pred="pred", positive=1) -> DataFrame:
    """Binary F1 of ``positive`` and accuracy in one aggregate."""
    y, p = F.col(label) == F.lit(positive), F.col(pred) == F.lit(positive)
    tp, fp, fn = F.count_if(y & p), F.count_if(~y & p), F.count_if(y & ~p)
    return preds.groupBy(*group).agg(
        F.when(2 * tp + fp + fn > 0, 2 * tp / (2 * tp + fp + fn)).otherwise(0.0).alias("f1"),
        F.avg((F.col(label) == F.col(pred)).cast("double")).alias("accuracy"))


def log_loss(probs: DataFrame, group=(), label="label", class_col="class", prob_col="prob",
             eps: float = 2.220446049250313e-16) -> DataFrame:
    """Mean negative log probability of the true class; probabilities are
    clipped to [eps, 1-eps] and renormalised per sample (a window over the
    sample's K class rows, so bounded)."""
    from pyspark.sql import Window
    p = F.greatest(F.least(F.col(prob_col), F.lit(1 - eps)), F.lit(eps))
    z = F.sum(p).over(Window.partitionBy(*group, "sample_id"))
    x = probs.select(*group, "sample_id", class_col, label, p.alias("_p"), z.alias("_z"))
    return x.where(F.col(class_col) == F.col(label)).groupBy(*group).agg(
        (-F.avg(F.ln(F.col("_p") / F.col("_z")))).alias("log_loss"))


def roc_auc(scores: DataFrame, group=(), label="label", score="score", positive=1,
            n_buckets: int = 128) -> DataFrame:
    """Exact binary ROC AUC (Mann-Whitney U, ties counted one half).

    Rows collapse to one per distinct score (partial aggregation), negatives
    below each score come from a bucketed running sum, and the U statistic is
    a final sum - no single-task window over all rows.
    """
    g = list(group)
    y = F.col(label) == F.lit(positive)
    by_score = scores.groupBy(*g, score).agg(
        F.count_if(y).cast("double").alias("pos"), F.count_if(~y).cast("double").alias("neg"))
    with_before = running_totals_before(by_score, g, score, ["neg"], n_buckets)
    u = with_before.groupBy(*g).agg(
        F.sum(F.col("pos") * (F.col("neg_before") + 0.5 * F.col("neg"))).alias("_u"),
        F.sum("pos").alias("_p"), F.sum("neg").alias("_n"))
    return u.select(*g, F.when((F.col("_p") > 0) & (F.col("_n") > 0),
                               F.col("_u") / (F.col("_p") * F.col("_n"))).alias("auc"))


def roc_auc_ovr(probs: DataFrame, group=(), label="label", class_col="class",
                prob_col="prob") -> DataFrame:
    """One-vs-rest macro AUC: per class, AUC of (label == class, prob); plain mean."""
    per = probs.select(*group, class_col, (F.col(label) == F.col(class_col)).cast("int").alias("_y"),
                       F.col(prob_col).alias("_s"))
    aucs = roc_auc(per, [*group, class_col], "_y", "_s")
    return aucs.groupBy(*group).agg(F.avg("auc").alias("auc_ovr"))


def fold_scores(preds: DataFrame, probs: DataFrame, classes: list, group=("fold",),
                label="label", pred="pred") -> DataFrame:
    """``(…group, metric, value)`` for acc, f1 (weighted), auc (ovr) and log loss."""
    g = list(group)
    conf = confusion_matrix(preds, classes, g, label, pred)
    acc = accuracy(preds, g, label, pred).select(*g, F.lit("acc").alias("metric"), F.col("accuracy").alias("value"))
    f1 = f1_weighted(conf, g, label, pred).select(*g, F.lit("f1").alias("metric"), F.col("f1_weighted").alias("value"))
    auc = roc_auc_ovr(probs, g, label).select(*g, F.lit("auc").alias("metric"), F.col("auc_ovr").alias("value"))
    ll = log_loss(probs, g, label).select(*g, F.lit("log_loss").alias("metric"), F.col("log_loss").alias("value"))
    return acc.unionByName(f1).unionByName(auc).unionByName(ll)


def learning_curve(model, df: DataFrame, fold: int) -> list[tuple]:
    """``(fold, round, loss)`` of a fitted GBT model on ``df``: one distributed
    pass per call (the loss is the model's own)."""
    losses = model.evaluateEachIteration(df)
    return [(int(fold), i + 1, float(v)) for i, v in enumerate(losses)]
