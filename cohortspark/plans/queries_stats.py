"""Feature statistics and selection queries."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import folds as FO
from ..operators import joins as J
from ..operators import reshape as R
from ..operators import stats as ST
from ..session import materialize
from ..sources.tables import Tables
from . import bindings as B
from .features import build_modality_features, assemble_samples, split_xy
from . import queries_ingest  # noqa: F401  (shared SQL twins)
from .registry import register, rounded
from .sql_ctes import cte, with_ctes

VAR_Q = 0.05

cte("expr_samples", "SELECT DISTINCT sample_id FROM expr_cells_all", ("expr_cells_all",))
cte("expr_log", "SELECT sample_id, feature, log2(value + 1) AS value FROM expr_cells_all", ("expr_cells_all",))
cte("expr_dense_log", """
SELECT s.sample_id, f.feature, coalesce(c.value, 0.0) AS value
FROM expr_samples s CROSS JOIN (SELECT DISTINCT feature FROM expr_cells_all) f
LEFT JOIN expr_log c ON c.sample_id = s.sample_id AND c.feature = f.feature""", ("expr_samples", "expr_log"))
cte("expr_var", "SELECT feature, var_samp(value) AS var FROM expr_dense_log GROUP BY feature", ("expr_dense_log",))


def expression_cells(t: Tables) -> DataFrame:
    """The integrated expression cells, staged once as a table: every
    statistic below reads them several times (sample count, moments,
    filters), while the raw order lines are aggregated a single time."""
    return materialize(R.cell_mean(B.expression_long(t)), "expression_cells")


@register("filter_prevalence", with_ctes("""
SELECT feature, count(*) AS n_samples FROM (SELECT DISTINCT sample_id, feature FROM mut_events
                                            WHERE variant_class IN ('A', 'R')) p
GROUP BY feature
HAVING count(*) >= greatest(1, ceil((SELECT count(DISTINCT sample_id) FROM mut_events WHERE variant_class IN ('A', 'R')) * 1.0 / 100.0))""",
                                         "mut_events"))
def q_filter_prevalence(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Keep event features present in >= max(1, ceil(1% of samples))."""
    t = Tables(spark, sf_dir)
    pres = R.presence(R.filter_in(B.mutation_events(t), "variant_class", ["A", "R"]))
    kept = ST.filter_prevalence(pres, 1.0)
    return kept.groupBy("feature").agg(F.count(F.lit(1)).alias("n_samples"))


cte("cnv_cells", """
SELECT sample_id, feature, avg(value) AS value FROM cnv_long
WHERE sample_id IS NOT NULL AND feature IS NOT NULL GROUP BY sample_id, feature""", ("cnv_long",))


@register("fill_median", with_ctes("""
SELECT c.sample_id, c.feature, round(coalesce(c.value, m.median), 6) AS value
FROM cnv_cells c JOIN (SELECT feature, median(value) AS median FROM cnv_cells WHERE value IS NOT NULL GROUP BY feature) m
  ON c.feature = m.feature""", "cnv_cells"))
def q_fill_median(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per-feature median fill of missing cells (a cell whose every
    measurement is missing stays an explicit NULL, then is filled)."""
    t = Tables(spark, sf_dir)
    cells = R.cell_agg(B.copy_number_long(t), "mean", keep_null_cells=True)
    return rounded(ST.fill_median(cells))


@register("filter_low_variance", with_ctes("""
SELECT feature, round(var, 6) AS var_samp FROM expr_var
WHERE var > (SELECT quantile_cont(var, 0.05) FROM expr_var)""", "expr_var"))
def q_filter_low_variance(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A10 + A12: log2(x+1), zero-aware sample variance, keep > 5% quantile."""
    t = Tables(spark, sf_dir)
    cells = ST.log_cells(expression_cells(t))
    n = ST.n_samples_of(cells)
    kept = ST.filter_low_variance(cells, n, VAR_Q, absent="zero")
    mom = ST.feature_moments(cells, n, "zero")
    return rounded(mom.join(kept.select("feature").distinct(), "feature", "left_semi")
                   .select("feature", "var_samp"))


@register("fit_scaler", with_ctes("""
SELECT feature, round(avg(value), 6) AS mean,
       round(CASE WHEN stddev_pop(value) = 0 THEN 1.0 ELSE stddev_pop(value) END, 6) AS std
FROM expr_dense_log GROUP BY feature""", "expr_dense_log"))
def q_fit_scaler(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A11 (fit): population z-score parameters with implicit zeros."""
    t = Tables(spark, sf_dir)
    cells = ST.log_cells(expression_cells(t))
    return rounded(ST.fit_scaler(cells, ST.n_samples_of(cells), "zero"))


@register("apply_scaler", with_ctes("""
SELECT c.sample_id, c.feature, round((c.value - p.mean) / p.std, 6) AS value, round(-p.mean / p.std, 6) AS zero_value
FROM expr_log c JOIN (SELECT feature, avg(value) AS mean,
                             CASE WHEN stddev_pop(value) = 0 THEN 1.0 ELSE stddev_pop(value) END AS std
                      FROM expr_dense_log GROUP BY feature) p ON c.feature = p.feature""", "expr_dense_log", "expr_log"))
def q_apply_scaler(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A11 (apply): scaled present cells + the value an absent cell takes."""
    t = Tables(spark, sf_dir)
    cells = ST.log_cells(expression_cells(t))
    params = ST.fit_scaler(cells, ST.n_samples_of(cells), "zero")
    return rounded(ST.apply_scaler(cells, params))


@register("fit_median_zero", with_ctes("""
SELECT feature, round(median(value), 6) AS median FROM expr_dense_log GROUP BY feature""", "expr_dense_log"))
def q_fit_median(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A13 (fit): exact median of zero-filled columns via a weighted percentile."""
    t = Tables(spark, sf_dir)
    cells = ST.log_cells(expression_cells(t))
    return rounded(ST.fit_median(cells, ST.n_samples_of(cells), absent="zero"))


@register("class_weight", """
SELECT CASE WHEN count_if(quality = 1) = 0 THEN 1.0
            ELSE round(count_if(quality <> 1) / count_if(quality = 1), 6) END AS scale_pos_weight
FROM labels""")
def q_class_weight(spark: SparkSession, sf_dir: str) -> DataFrame:
    """neg/pos ratio for positive-class weighting."""
    t = Tables(spark, sf_dir)
    return rounded(ST.class_weight(t.labels, "quality", 1))


@register("stratified_holdout", with_ctes("""
SELECT sample_id, label,
       row_number() OVER (PARTITION BY label ORDER BY md5(concat('42', '-', CAST(sample_id AS VARCHAR))), sample_id)
       <= round(0.2 * count(*) OVER (PARTITION BY label)) AS is_holdout
FROM samples""", "samples"))
def q_holdout(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Stratified 80/20 hold-out flag (same hash order as the folds)."""
    t = Tables(spark, sf_dir)
    return FO.stratified_holdout(B.samples(t), "sample_id", "label", 0.2, 42) \
        .select("sample_id", "label", "is_holdout")


@register("feature_dictionary", with_ctes("""
SELECT CAST(row_number() OVER (ORDER BY feature) - 1 AS INTEGER) AS pos, feature
FROM (SELECT DISTINCT feature FROM expr_cells_all)""", "expr_cells_all"))
def q_feature_dictionary(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lexical feature order -> positions."""
    return R.feature_dictionary(expression_cells(Tables(spark, sf_dir)))


@register("restore_samples", with_ctes("""
SELECT s.sample_id, c.feature, round(c.value, 6) AS value
FROM (SELECT DISTINCT sample_id FROM expr_long) s
LEFT JOIN (SELECT sample_id, feature, avg(value) AS value FROM expr_long
           WHERE starts_with(feature, 'Brand#25') GROUP BY ALL) c ON s.sample_id = c.sample_id""", "expr_long"))
def q_restore_samples(spark: SparkSession, sf_dir: str) -> DataFrame:
    """After a feature filter, every original sample comes back
    (NULL feature row when nothing is left)."""
    t = Tables(spark, sf_dir)
    long = B.expression_long(t)
    kept = R.cell_mean(R.filter_prefix(long, "feature", "Brand#25"))
    return rounded(R.restore_samples(long, kept))


# ---- sample-based dataset (entry point D without PCA) ---------------------------------

cte("cat_long", """
SELECT user_id AS sample_id, CASE WHEN event_type = 'error' THEN 'cancer' ELSE 'normal' END AS category,
       concat('k', CAST(floor(CAST(json_extract_string(props, '$.k') AS INTEGER) / 10) AS BIGINT)) AS feature,
       value
FROM events""")
cte("cat_cells", """
SELECT category, sample_id, feature, log2(avg(value) + 1) AS value FROM cat_long
WHERE sample_id IS NOT NULL AND feature IS NOT NULL AND value IS NOT NULL GROUP BY ALL""", ("cat_long",))
cte("cat_dense", """
SELECT s.category, s.sample_id, f.feature, coalesce(c.value, 0.0) AS value
FROM (SELECT DISTINCT category, sample_id FROM cat_cells) s
JOIN (SELECT DISTINCT category, feature FROM cat_cells) f ON s.category = f.category
LEFT JOIN cat_cells c ON c.category = s.category AND c.sample_id = s.sample_id AND c.feature = f.feature""",
    ("cat_cells",))
cte("cat_var", "SELECT category, feature, var_samp(value) AS var FROM cat_dense GROUP BY ALL", ("cat_dense",))
cte("cat_kept", """
SELECT v.category, v.feature FROM cat_var v
JOIN (SELECT category, quantile_cont(var, 0.05) AS t, count(DISTINCT var) AS nd, count(*) AS d
      FROM cat_var GROUP BY category) q ON v.category = q.category
WHERE (q.d <= 1) OR (q.nd > 1 AND v.var > q.t) OR (q.nd <= 1 AND v.var > 0)""", ("cat_var",))
cte("cat_scaled", """
SELECT c.category, c.sample_id, concat('evt_', c.feature) AS feature,
       (c.value - p.mean) / p.std AS value, -p.mean / p.std AS zero_value
FROM cat_cells c
JOIN cat_kept k ON c.category = k.category AND c.feature = k.feature
JOIN (SELECT category, feature, avg(value) AS mean,
             CASE WHEN stddev_pop(value) = 0 THEN 1.0 ELSE stddev_pop(value) END AS std
      FROM cat_dense GROUP BY ALL) p ON c.category = p.category AND c.feature = p.feature""",
    ("cat_cells", "cat_kept", "cat_dense"))
cte("cat_features", """
SELECT s.category, s.sample_id, x.feature, x.value, x.zero_value
FROM (SELECT DISTINCT category, sample_id FROM cat_long WHERE sample_id IS NOT NULL) s
LEFT JOIN cat_scaled x ON s.category = x.category AND s.sample_id = x.sample_id""", ("cat_long", "cat_scaled"))


def category_features(t: Tables) -> DataFrame:
    return build_modality_features(B.category_events(t), "evt", log=True, var_q=VAR_Q, scale=True,
                                   scope="file", by="category")


@register("build_modality_features", with_ctes("""
SELECT category, sample_id, feature, round(value, 6) AS value, round(zero_value, 6) AS zero_value
FROM cat_features""", "cat_features"))
def q_build_modality_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    """L14 (+A10/A11/A12/P14/P16): per category file: pivot mean, log2(x+1),
    variance filter, z-score (file scope), modality prefix, restore samples."""
    return rounded(category_features(Tables(spark, sf_dir)))


@register("assemble_samples", with_ctes("""
SELECT concat(CAST(sample_id AS VARCHAR), '_', upper(category)) AS sample_id,
       CASE WHEN category = 'cancer' THEN 1 ELSE 0 END AS target,
       feature, round(value, 6) AS value
FROM cat_features WHERE feature IS NOT NULL""", "cat_features"))
def q_assemble_samples(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per (sample, category) rows ``<id>_NORMAL`` / ``<id>_CANCER``,
    target 0/1; a sample with an empty category emits no row."""
    x = assemble_samples(category_features(Tables(spark, sf_dir)))
    return rounded(x.select("sample_id", "target", "feature", "value"))


@register("split_xy_target", with_ctes("""
SELECT DISTINCT concat(CAST(sample_id AS VARCHAR), '_', upper(category)) AS sample_id,
       CASE WHEN category = 'cancer' THEN 1 ELSE 0 END AS target
FROM cat_features WHERE feature IS NOT NULL""", "cat_features"))
def q_split_xy(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The target table of the X / y split."""
    _, y = split_xy(assemble_samples(category_features(Tables(spark, sf_dir))))
    return y


@register("any_null_any_match", with_ctes("""
SELECT bool_or(value IS NULL) AS any_null, bool_or(contains(feature, '_')) AS any_match
FROM cat_features WHERE feature IS NOT NULL""", "cat_features"))
def q_any_null(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Residual-NULL probe and feature-name probe over the assembled X."""
    x = assemble_samples(category_features(Tables(spark, sf_dir)))
    return x.agg(F.bool_or(F.col("value").isNull()).alias("any_null"),
                 F.bool_or(F.col("feature").contains("_")).alias("any_match"))


# ---- scoring-time preparation (L13) -------------------------------------------------

cte("train_dictionary", """
SELECT CAST(row_number() OVER (ORDER BY feature) - 1 AS INTEGER) AS pos, feature
FROM expr_var WHERE var > (SELECT quantile_cont(var, 0.05) FROM expr_var)""", ("expr_var",))


def training_dictionary(t: Tables) -> DataFrame:
    cells = ST.log_cells(expression_cells(t))
    kept = ST.filter_low_variance(cells, ST.n_samples_of(cells), VAR_Q, absent="zero")
    return R.feature_dictionary(kept)


@register("prepare_long", with_ctes("""
SELECT s.sample_id, x.feature, x.pos, x.value
FROM (SELECT DISTINCT sample_id FROM expr_long WHERE sample_id IS NOT NULL AND feature IS NOT NULL) s
LEFT JOIN (SELECT c.sample_id, c.feature, d.pos, round(c.value, 6) AS value FROM (SELECT sample_id, feature, avg(coalesce(CASE WHEN isnan(value) THEN NULL ELSE value END, 0.0)) AS value
      FROM expr_long WHERE sample_id IS NOT NULL AND feature IS NOT NULL GROUP BY ALL) c
JOIN train_dictionary d ON c.feature = d.feature) x ON s.sample_id = x.sample_id""", "expr_long", "train_dictionary"))
def q_prepare_long(spark: SparkSession, sf_dir: str) -> DataFrame:
    """L13 (long): coerce, mean per cell, keep the saved training features
    (dictionary of the variance-filtered training features) with positions."""
    from .integrate import prepare_long
    t = Tables(spark, sf_dir)
    raw = B.expression_long(t).select("sample_id", "feature", "value")
    return rounded(prepare_long(raw, training_dictionary(t)).select("sample_id", "feature", "pos", "value"))


@register("prepare_events", with_ctes("""
SELECT s.sample_id, x.feature, x.pos, x.value
FROM (SELECT DISTINCT sample_id FROM mut_events WHERE sample_id IS NOT NULL AND feature IS NOT NULL) s
LEFT JOIN (SELECT p.sample_id, p.feature, d.pos, 1 AS value
FROM (SELECT DISTINCT sample_id, feature FROM mut_events) p
JOIN (SELECT CAST(row_number() OVER (ORDER BY feature) - 1 AS INTEGER) AS pos, feature FROM (
        SELECT feature FROM (SELECT DISTINCT sample_id, feature FROM mut_events WHERE variant_class IN ('A', 'R'))
        GROUP BY feature
        HAVING count(*) >= greatest(1, ceil((SELECT count(DISTINCT sample_id) FROM mut_events
                                             WHERE variant_class IN ('A', 'R')) * 1.0 / 100.0)))) d
  ON p.feature = d.feature) x ON s.sample_id = x.sample_id""", "mut_events"))
def q_prepare_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """L13 (events): presence of every event pair aligned to the saved list of
    prevalent protein-altering features."""
    from .integrate import prepare_events
    t = Tables(spark, sf_dir)
    ev = B.mutation_events(t)
    kept = ST.filter_prevalence(R.presence(R.filter_in(ev, "variant_class", ["A", "R"])), 1.0)
    dictionary = R.feature_dictionary(kept)
    out = prepare_events(ev.select("sample_id", "feature"), dictionary)
    return out.select("sample_id", "feature", "pos", F.col("value").cast("int").alias("value"))


@register("binary_contract", """
SELECT count(DISTINCT quality) AS n_classes,
       (SELECT code FROM (SELECT quality, dense_rank() OVER (ORDER BY quality) - 1 AS code
                          FROM (SELECT DISTINCT quality FROM labels)) WHERE quality = 1) AS positive_code
FROM labels""")
def q_binary_contract(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Exactly-two-classes guard and the positive class code."""
    t = Tables(spark, sf_dir)
    lab = t.labels.select(F.col("quality").alias("label"))
    n = J.require_binary(lab)
    codes = J.class_codes(lab)
    return J.positive_code(codes, 1).select(F.lit(n).cast("long").alias("n_classes"),
                                            F.col("positive_code").cast("long"))


@register("fit_scaler_by_fold", with_ctes("""
SELECT f.fold, d.feature, round(avg(d.value), 6) AS mean,
       round(CASE WHEN stddev_pop(d.value) = 0 THEN 1.0 ELSE stddev_pop(d.value) END, 6) AS std
FROM (SELECT CAST(range AS INTEGER) AS fold FROM range(5)) f
JOIN (SELECT x.sample_id, x.feature, x.value, k.fold FROM expr_dense_log x JOIN folds k ON x.sample_id = k.sample_id) d
  ON d.fold <> f.fold
GROUP BY f.fold, d.feature""", "expr_dense_log", "folds"))
def q_fit_scaler_by_fold(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A11 fold-aware (blueprint quirk Q6): z-score parameters of each fold
    fitted on the other folds only, from one aggregation pass."""
    from .queries import customer_folds
    t = Tables(spark, sf_dir)
    cells = ST.log_cells(expression_cells(t))
    return rounded(ST.fit_scaler_by_fold(cells, customer_folds(t), 5))
