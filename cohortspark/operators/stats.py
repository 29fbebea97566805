"""Per-feature statistics on the long form, with implicit zeros.

A modality declares how absent cells read: ``absent='zero'`` (pivot with fill
0: expression, copy number, presence) or ``absent='null'`` (methylation).
With N samples and n present rows per feature, zero-filled moments are formed
analytically (Chan's parallel combination of the present rows with N-n zeros),
and the zero-filled median is an exact frequency-weighted percentile.  No
sample x feature matrix is ever materialised; every statistic is a
``groupBy(feature)`` with map-side partial aggregation.
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.scalar import log2p1
from .ordered import exact_percentile


def label_counts(df: DataFrame, label: str = "label", normalize: bool = False) -> DataFrame:
    out = df.groupBy(label).agg(F.count(F.lit(1)).alias("count"))
    if normalize:
        # the window runs over one row per label (a bounded class count)
        out = out.withColumn("share", F.col("count") / F.sum("count").over(Window.partitionBy()))
    return out


def matrix_shape(long: DataFrame) -> DataFrame:
    return long.agg(F.countDistinct("sample_id").alias("n_samples"),
                    F.countDistinct("feature").alias("n_features"))


def n_samples_of(df: DataFrame, key: str = "sample_id") -> int:
    return df.select(key).distinct().count()


def feature_moments(cells: DataFrame, n_samples: int | None = None,
                    absent: str = "zero") -> DataFrame:
    """``(feature, n_present, mean, var_samp, std_pop)`` per feature.

    ``cells`` has one row per present (sample, feature) with a non-NULL value.
    With ``absent='zero'`` the statistics include ``n_samples - n_present``
    implicit zeros; with ``absent='null'`` only present values count.
    """
    base = cells.where(F.col("value").isNotNull()).groupBy("feature").agg(
        F.count(F.lit(1)).alias("n_present"),
        F.avg("value").alias("_mp"),
        (F.var_pop("value") * F.count(F.lit(1))).alias("_m2p"))
    if absent == "zero":
        if n_samples is None:
            raise ValueError("n_samples is required for implicit zeros")
        N = F.lit(float(n_samples))
    else:
        N = F.col("n_present").cast("double")
    n = F.col("n_present").cast("double")
    mean = n * F.col("_mp") / N
    m2 = F.col("_m2p") + n * (N - n) / N * F.col("_mp") * F.col("_mp")
    return base.select(
        "feature", "n_present", mean.alias("mean"),
        F.when(N > 1, m2 / (N - 1)).alias("var_samp"),
        F.sqrt(F.greatest(m2 / N, F.lit(0.0))).alias("std_pop"))


def log_cells(cells: DataFrame) -> DataFrame:
    """log2(x+1) on present cells; zero maps to zero, so the form stays sparse."""
    return cells.withColumn("value", log2p1("value"))


# Variances computed by distributed sums differ in the last bits with the
# summation order; "equal" and "above the threshold" are judged with this
# relative tolerance so identical columns are treated as identical.
VAR_RTOL = 1e-12


def variance_threshold(moments: DataFrame, q: float | None) -> tuple[str, float | None]:
    """Decide the low-variance rule: ``('quantile', t)``, ``('positive', tol)``
    or ``('skip', None)``; the returned cut already includes the tolerance."""
    row = moments.agg(F.count(F.lit(1)).alias("d"),
                      F.max("var_samp").alias("hi"), F.min("var_samp").alias("lo"),
                      (F.percentile("var_samp", q) if q is not None and 0 < q < 1
                       else F.lit(None)).alias("t")).first()
    if q is None or not (0 < q < 1) or row["d"] <= 1:
        return "skip", None
    scale = max(abs(row["hi"] or 0.0), abs(row["lo"] or 0.0))
    tol = VAR_RTOL * scale
    if (row["hi"] or 0.0) - (row["lo"] or 0.0) > tol:
        t = float(row["t"])  # relative to the cut itself, so small distinct variances stay apart
        return "quantile", t + VAR_RTOL * abs(t)
    return "positive", tol


def filter_low_variance(cells: DataFrame, n_samples: int | None, q: float | None = 0.05,
                        absent: str = "zero") -> DataFrame:
    """Keep features whose sample variance is above the ``q`` quantile of all
    feature variances (linear interpolation); if every variance is equal keep
    variance > 0; skipped for one feature or q outside (0, 1)."""
    moments = feature_moments(cells, n_samples, absent)
    rule, t = variance_threshold(moments, q)
    if rule == "skip":
        return cells
    keep = moments.where(F.col("var_samp") > F.lit(t)).select("feature")
    return cells.join(keep, "feature", "left_semi")


def filter_prevalence(presence_cells: DataFrame, pct: float = 1.0,
                      n_samples: int | None = None) -> DataFrame:
    """Keep features present in at least ``max(1, ceil(n * pct / 100))`` samples."""
    if n_samples is None:
        n_samples = presence_cells.select("sample_id").distinct().count()
    min_count = max(1, int(math.ceil(n_samples * pct / 100.0))) if pct and pct > 0 else 0
    counts = presence_cells.groupBy("feature").agg(F.countDistinct("sample_id").alias("_c"))
    keep = counts.where(F.col("_c") >= F.lit(min_count)).select("feature")
    return presence_cells.join(keep, "feature", "left_semi")


def fit_scaler(cells: DataFrame, n_samples: int | None, absent: str = "zero") -> DataFrame:
    """Population z-score parameters ``(feature, mean, std)``; zero std -> 1."""
    m = feature_moments(cells, n_samples, absent)
    return m.select("feature", "mean",
                    F.when(F.col("std_pop") == 0, F.lit(1.0)).otherwise(F.col("std_pop")).alias("std"))


def apply_scaler(cells: DataFrame, params: DataFrame) -> DataFrame:
    """Scale present cells; ``zero_value`` is what an absent (zero) cell becomes."""
    return cells.join(params, "feature", "inner").select(
        *[c for c in cells.columns if c != "value"],
        ((F.col("value") - F.col("mean")) / F.col("std")).alias("value"),
        (-F.col("mean") / F.col("std")).alias("zero_value"))


def fit_median(cells: DataFrame, n_samples: int | None = None, absent: str = "null") -> DataFrame:
    """Exact per-feature median ``(feature, median)``.

    ``absent='zero'`` adds one weighted row ``(0.0, N - n)`` per feature, so the
    result equals the median of the zero-filled column.  Features without any
    observed value get no row (they are dropped, see :func:`median_fit_report`).
    """
    present = cells.where(F.col("value").isNotNull()) \
        .groupBy("feature", F.col("value").cast("double").alias("value")) \
        .agg(F.count(F.lit(1)).alias("w"))
    if absent == "zero":
        zeros = present.groupBy("feature").agg(
            (F.lit(int(n_samples)) - F.sum("w")).cast("long").alias("w")) \
            .where(F.col("w") > 0).select("feature", F.lit(0.0).alias("value"), "w")
        present = present.unionByName(zeros).groupBy("feature", "value").agg(F.sum("w").alias("w"))
    # distinct values with frequencies, then an exact order-statistic pick:
    # no per-feature value buffer, so a hot feature never sits in one task
    return exact_percentile(present, ["feature"], "value", "w", 0.5, "median")


def median_fit_report(cells: DataFrame, params: DataFrame) -> DataFrame:
    """Features seen in ``cells`` that received no median (never observed)."""
    return cells.select("feature").distinct().join(params, "feature", "left_anti") \
        .withColumn("status", F.lit("dropped: no observed value"))


def apply_median(cells: DataFrame, params: DataFrame) -> DataFrame:
    """Fill NULL values with the stored median; features without one are dropped."""
    return cells.join(params, "feature", "inner").select(
        *[c for c in cells.columns if c != "value"],
        F.coalesce(F.col("value"), F.col("median")).alias("value"))


def fill_median(cells: DataFrame) -> DataFrame:
    """Per-feature median fill within one frame (median of observed values)."""
    return apply_median(cells, fit_median(cells, absent="null"))


def class_weight(df: DataFrame, label: str = "label", positive=1) -> DataFrame:
    """``neg / pos`` for positive weighting; 1.0 when there is no positive row."""
    pos = F.count_if(F.col(label) == F.lit(positive))
    neg = F.count_if(F.col(label) != F.lit(positive))
    return df.agg(F.when(pos == 0, F.lit(1.0)).otherwise(neg / pos).alias("scale_pos_weight"))


def summarise_folds(scores: DataFrame, group=("metric",)) -> DataFrame:
    return scores.groupBy(*group).agg(F.avg("value").alias("mean_value"))


def any_null(df: DataFrame, cols: list[str]) -> DataFrame:
    return df.agg(F.bool_or(F.greatest(*[F.col(f"`{c}`").isNull() for c in cols])
                            if len(cols) > 1 else F.col(f"`{cols[0]}`").isNull()).alias("any_null"))


def any_match(df: DataFrame, col: str, needle: str) -> DataFrame:
    return df.agg(F.bool_or(F.col(col).contains(needle)).alias("any_match"))


def fit_scaler_by_fold(cells: DataFrame, folds: DataFrame, k: int) -> DataFrame:
    """Fold-aware scaler: ``(fold, feature, mean, std)`` fitted on the samples
    of every *other* fold (absent cells are zeros), so fold ``i`` is scaled
    without seeing itself.

    One pass: per (fold, feature) count / sum / sum of squares; the training
    statistics of fold ``i`` are the feature totals minus fold ``i``'s share
    (a window over k rows per feature) - no k-fold re-aggregation.
    """
    x = cells.join(folds.select("sample_id", "fold"), "sample_id")
    per = x.groupBy("fold", "feature").agg(F.sum("value").alias("_s"),
                                           F.sum(F.col("value") * F.col("value")).alias("_q"))
    n_fold = x.select("sample_id", "fold").distinct().groupBy("fold").agg(F.count(F.lit(1)).alias("_n"))
    grid = per.select("feature").distinct() \
        .select("feature", F.explode(F.sequence(F.lit(0), F.lit(k - 1))).alias("fold"))
    g = grid.join(per, ["fold", "feature"], "left").na.fill(0.0, ["_s", "_q"]) \
        .join(F.broadcast(n_fold), "fold", "left").na.fill(0, ["_n"])  # k rows
    w = Window.partitionBy("feature")
    n_t = (F.sum("_n").over(w) - F.col("_n")).cast("double")
    s_t = F.sum("_s").over(w) - F.col("_s")
    q_t = F.sum("_q").over(w) - F.col("_q")
    mean = s_t / n_t
    std = F.sqrt(F.greatest(q_t / n_t - mean * mean, F.lit(0.0)))
    return g.select("fold", "feature", mean.alias("mean"),
                    F.when(std == 0, F.lit(1.0)).otherwise(std).alias("std"))
