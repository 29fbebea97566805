"""Sample-based dataset job (entry point D): per-modality feature building,
category gathering, PCA and the X / y split.

Everything stays long: ``(category, sample_id, feature, value, zero_value)``
where ``zero_value`` is what an absent cell reads after scaling (absent cells
are zeros before scaling).  Per-file statistics are grouped by ``category``
(``scope='file'``) or pooled (``scope='pooled'``).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.scalar import category_sample_id, log2p1, prefixed_feature
from ..operators import reshape as R


def _moments(cells: DataFrame, n_by: DataFrame, by: list[str]) -> DataFrame:
    """Zero-aware moments per (by, feature); ``n_by`` holds ``(by, _N)``."""
    base = cells.groupBy(*by, "feature").agg(
        F.count(F.lit(1)).alias("n_present"), F.avg("value").alias("_mp"),
        (F.var_pop("value") * F.count(F.lit(1))).alias("_m2p"))
    x = base.join(n_by, by)
    N, n = F.col("_N").cast("double"), F.col("n_present").cast("double")
    m2 = F.col("_m2p") + n * (N - n) / N * F.col("_mp") * F.col("_mp")
    return x.select(*by, "feature", (n * F.col("_mp") / N).alias("mean"),
                    F.when(N > 1, m2 / (N - 1)).alias("var_samp"),
                    F.sqrt(F.greatest(m2 / N, F.lit(0.0))).alias("std_pop"))


def build_modality_features(long: DataFrame, modality: str, log: bool = False,
                            var_q: float | None = 0.05, scale: bool = True,
                            scope: str = "file", by: str = "category") -> DataFrame:
    """Feature job of one modality for every file in ``by``.

    Steps per file: cell mean (pivot-mean equivalent, absent = 0), optional
    log2(x+1), low-variance filter (quantile rule, or > 0 when all variances
    are equal, skipped for one feature), population z-score, modality prefix,
    and restoration of every sample of the file (a sample left without
    features gets one row with NULL feature).
    """
    keys = [by] if scope == "file" else []
    raw = long.where(F.col("sample_id").isNotNull())
    cells = R.cell_agg(raw, "mean", keys=(by, "sample_id", "feature"))
    if log:
        cells = cells.withColumn("value", log2p1("value"))
    if keys:
        n_by = cells.groupBy(*keys).agg(F.countDistinct("sample_id").alias("_N"))
        mom = _moments(cells, n_by, keys)
        if var_q is not None and 0 < var_q < 1:
            from ..operators.stats import VAR_RTOL
            rule = mom.groupBy(*keys).agg(
                F.count(F.lit(1)).alias("_d"), F.max("var_samp").alias("_hi"), F.min("var_samp").alias("_lo"),
                F.percentile("var_samp", var_q).alias("_t"))
            m = mom.join(rule, keys)
            tol = F.lit(VAR_RTOL) * F.greatest(F.abs("_hi"), F.abs("_lo"))
            distinct = (F.col("_hi") - F.col("_lo")) > tol
            keep = m.where((F.col("_d") <= 1)
                           | (distinct & (F.col("var_samp") > F.col("_t") + F.lit(VAR_RTOL) * F.abs("_t")))
                           | (~distinct & (F.col("var_samp") > tol)))
            mom = keep.select(*keys, "feature", "mean", "var_samp", "std_pop")
    else:
        # pooled: one matrix over all files; a sample id of two files is two rows
        from ..operators import stats as ST
        n_rows = cells.select(by, "sample_id").distinct().count()
        mom = ST.feature_moments(cells.select("feature", "value"), n_rows, "zero")
        if var_q is not None and 0 < var_q < 1:
            rule, t = ST.variance_threshold(mom, var_q)
            if rule != "skip":
                mom = mom.where(F.col("var_samp") > F.lit(t))
    stat_keys = keys
    if scale:
        std = F.when(F.col("std_pop") == 0, F.lit(1.0)).otherwise(F.col("std_pop"))
        params = mom.select(*stat_keys, "feature", F.col("mean").alias("_mean"), std.alias("_std"))
        x = cells.join(params, [*stat_keys, "feature"])
        x = x.select(by, "sample_id", "feature",
                     ((F.col("value") - F.col("_mean")) / F.col("_std")).alias("value"),
                     (-F.col("_mean") / F.col("_std")).alias("zero_value"))
    else:
        x = cells.join(mom.select(*stat_keys, "feature"), [*stat_keys, "feature"]) \
            .select(by, "sample_id", "feature", "value", F.lit(0.0).alias("zero_value"))
    x = x.withColumn("feature", prefixed_feature(modality, F.col("feature")))
    spine = raw.select(by, "sample_id").distinct()
    return spine.join(x, [by, "sample_id"], "left") \
        .select(by, "sample_id", "feature", "value", "zero_value")


def assemble_samples(features: DataFrame, by: str = "category", positive: str = "cancer") -> DataFrame:
    """Gather per (sample, category): id ``<sample>_<CATEGORY>``, target 0/1.
    A sample whose category holds no feature emits no row."""
    x = features.where(F.col("feature").isNotNull())
    return x.select(category_sample_id("sample_id", by).alias("sample_id"),
                    (F.col(by) == F.lit(positive)).cast("int").alias("target"),
                    "feature", "value", "zero_value")


def split_xy(samples: DataFrame) -> tuple[DataFrame, DataFrame]:
    X = samples.select("sample_id", "feature", "value", "zero_value")
    y = samples.select("sample_id", "target").distinct()
    return X, y


def pca_component_cap(k: int | None, n_samples: int, n_features: int) -> int:
    """``min(k, n, d)``; 0 or less means PCA is skipped."""
    if k is None:
        return 0
    return int(min(int(k), n_samples, n_features))


def impute_and_reduce(features: DataFrame, modality: str, k: int, by: str = "category"):
    """PCA step of the sample dataset job for one modality (L11 in L15), at any width.

    The feature columns of all files are united (sorted dictionary, U3).
    Within a file an absent cell reads that file's scaled zero; a feature the
    file does not have reads NULL, as does every feature of a restored sample
    (one without any feature).  Per-feature medians over the rows that are not
    NULL (exact, distributed) fill the NULLs (A13).  PCA is fitted on the rows
    of all files: a row is its file's pattern of zeros and medians plus its own
    cells, so no dense row is built.  Returns long scores ``(category,
    sample_id, feature=<m>_PCA_PC<i>, value)`` and the explained variance
    ratios; with ``k <= 0`` the features pass through unchanged.
    """
    import numpy as np

    from ..operators import reduce as RD
    from ..operators.ordered import exact_percentile
    from ..session import materialize

    given, features = features, materialize(features, "reduce_features")  # read six times below
    present = features.where(F.col("feature").isNotNull())
    dictionary = materialize(R.feature_dictionary(present), "reduce_dictionary")
    d = dictionary.count()
    rows = features.groupBy(by, "sample_id").agg(F.count("feature").alias("_n"))
    rows = materialize(rows.select(F.monotonically_increasing_id().alias("_row"), by, "sample_id",
                                   (F.col("_n") > 0).alias("_has")), "reduce_rows")
    counts = rows.where("_has").groupBy(by).agg(F.count(F.lit(1)).alias("_N"))
    files = {r[by]: g for g, r in enumerate(counts.orderBy(by).collect())}  # bounded: files of a modality
    n = rows.count()
    k = RD.component_cap(k, n, d)
    if k <= 0:
        return given, None
    cells = present.join(dictionary, "feature")
    zeros = materialize(cells.groupBy(by, "pos").agg(F.max("zero_value").alias("zero"), F.count(F.lit(1)).alias("_present")), "reduce_zeros")
    absent = zeros.join(counts, by).select("pos", F.col("zero").alias("value"), (F.col("_N") - F.col("_present")).alias("w"))
    observed = cells.groupBy("pos", "value").agg(F.count(F.lit(1)).alias("w")).unionByName(absent.where("w > 0")) \
        .groupBy("pos", "value").agg(F.sum("w").alias("w"))
    bases = np.zeros((len(files) + 1, d))  # the last one is of restored samples
    for r in exact_percentile(observed, ["pos"], "value", "w", 0.5, "median").collect():  # d values
        bases[:, r["pos"]] = r["median"]
    for r in zeros.select(by, "pos", "zero").collect():  # files x d values
        bases[files[r[by]], r["pos"]] = r["zero"]
    group = F.lit(len(files))
    for name, g in files.items():
        group = F.when(F.col("_has") & (F.col(by) == F.lit(name)), F.lit(g)).otherwise(group)
    samples = rows.select("_row", group.cast("int").alias("grp"))
    delta = cells.join(rows, [by, "sample_id"]).select("_row", "pos", (F.col("value") - F.col("zero_value")).alias("value"))
    delta = materialize(delta.where("value <> 0"), "reduce_cells")
    comps, var, mu, total = RD.randomized_pca(delta, d, k, n, key="_row", samples=samples, bases=bases)
    scores = RD.randomized_scores(delta, comps, mu, modality, "_row", samples, bases)
    out = scores.join(rows, "_row").select(by, "sample_id", F.col("component").alias("feature"),
                                           F.col("score").alias("value"), F.lit(0.0).alias("zero_value"))
    return out, var / total if total > 0 else var
