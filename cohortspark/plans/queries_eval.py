"""Stacking, evaluation and attribution queries (J1, J2, A15-A19, P17, P18,
E1-E9, X2a-X6, W1, T1, T2, F2-F13)."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import scalar as S
from ..operators import explain as EX
from ..operators import experts as X
from ..operators import folds as FO
from ..operators import joins as J
from ..operators import metrics as M
from ..operators import reshape as R
from ..operators import topk as T
from ..session import materialize, spread
from ..sources.tables import Tables
from . import bindings as B
from .queries import (K_FOLDS, activity_expert, classes_of, expert_predictions, expression_expert,
                      mutation_expert)
from . import queries_ingest  # noqa: F401  (shared SQL twins)
from .registry import register, rounded
from .sql_ctes import cte, frequency_expert_ctes, with_ctes

# The five market segments are the class domain of the
# customer label; the SQL twins spell the stacked column names from them.
SEGMENTS = ["AUTOMOBILE", "BUILDING", "FURNITURE", "HOUSEHOLD", "MACHINERY"]
MODALITIES = ["expr", "mut", "act"]
EPS = 2.220446049250313e-16


def stacked_columns() -> list[str]:
    return [f"pred_{m}_{c}" for m in MODALITIES for c in SEGMENTS]


def expert_oofs(t: Tables, classes: list) -> dict[str, DataFrame]:
    return {"expr": expression_expert(t, classes), "mut": mutation_expert(t, classes),
            "act": activity_expert(t, classes)}


def stacked_experts(t: Tables, classes: list) -> DataFrame:
    """``(modality, sample_id, label, fold, class, prob)`` of the three
    experts: expression and mutation from one pass over the order lines
    (grouped by modality), activity from the events table."""
    from .queries import customer_folds
    folds = customer_folds(t)
    lines = X.frequency_expert(B.line_modalities(t), folds, classes, K_FOLDS, "w", group=["modality"])
    act = X.frequency_expert(B.activity_events(t).withColumn("w", F.lit(1.0)), folds, classes, K_FOLDS, "w") \
        .withColumn("modality", F.lit("act"))
    return lines.unionByName(act)


def meta_table(t: Tables) -> tuple[DataFrame, list, list]:
    classes = classes_of(t)
    oof = stacked_experts(t, classes)
    named = oof.select("sample_id", S.pred_column_name(F.col("modality"), F.col("class")).alias("column"), "prob")
    cols = [f"pred_{m}_{c}" for m in MODALITIES for c in classes]
    stacked = J.stack_outer(named, cols, n_rows=t.customer.count() * len(cols))  # a row per sample and column, at most
    labelled = J.attach_labels(stacked, B.samples(t))
    return J.fill_uninformative(labelled, cols, len(classes)), cols, classes


# ---- SQL twins ---------------------------------------------------------------------
cte("stack_long", " UNION ALL ".join(
    f"SELECT sample_id, concat('pred_{m}_', class) AS col, prob FROM fx_{m}_oof" for m in MODALITIES),
    tuple(f"fx_{m}_oof" for m in MODALITIES))
cte("meta", "SELECT u.sample_id, " + ", ".join(
    f"coalesce(avg(u.prob) FILTER (WHERE u.col = '{c}'), 0.2) AS \"{c}\"" for c in stacked_columns())
    + ", s.label FROM stack_long u JOIN samples s ON u.sample_id = s.sample_id GROUP BY u.sample_id, s.label",
    ("stack_long", "samples"))
cte("doc_samples", """
SELECT d.doc_id AS sample_id, l.quality AS label, d.source FROM documents d JOIN labels l ON d.doc_id = l.doc_id""")
cte("doc_classes", "SELECT DISTINCT label AS class FROM doc_samples", ("doc_samples",))
cte("doc_folds", """
SELECT sample_id, label,
       CAST((row_number() OVER (PARTITION BY label ORDER BY md5(concat('42', '-', CAST(sample_id AS VARCHAR))), sample_id) - 1) % 5 AS INTEGER) AS fold
FROM doc_samples""", ("doc_samples",))
cte("doc_long", "SELECT sample_id, source AS feature FROM doc_samples", ("doc_samples",))
frequency_expert_ctes("fx_doc", "doc_long", "1", folds="doc_folds", classes="doc_classes")
cte("doc_scores", "SELECT sample_id, label, fold, prob AS score FROM fx_doc_oof WHERE class = 1", ("fx_doc_oof",))

cte("conf", """
SELECT t.class AS label, p.class AS pred, count(x.sample_id) AS n
FROM classes t CROSS JOIN classes p
LEFT JOIN fx_expr_pred x ON x.label = t.class AND x.pred = p.class GROUP BY t.class, p.class""",
    ("classes", "fx_expr_pred"))
cte("per_class", """
SELECT class, support, tp, precision, recall,
       CASE WHEN precision + recall > 0 THEN 2 * precision * recall / (precision + recall) ELSE 0.0 END AS f1
FROM (SELECT c.class, coalesce(s.support, 0) AS support, coalesce(s.tp, 0) AS tp,
             CASE WHEN coalesce(p.predicted, 0) > 0 THEN s.tp / p.predicted ELSE 0.0 END AS precision,
             CASE WHEN coalesce(s.support, 0) > 0 THEN s.tp / s.support ELSE 0.0 END AS recall
      FROM classes c
      LEFT JOIN (SELECT label AS class, sum(n) AS support, sum(CASE WHEN label = pred THEN n ELSE 0 END) AS tp
                 FROM conf GROUP BY label) s ON s.class = c.class
      LEFT JOIN (SELECT pred AS class, sum(n) AS predicted FROM conf GROUP BY pred) p ON p.class = c.class)""",
    ("conf",))


def _auc_sql(scores_sql: str, group: list[str]) -> str:
    """Exact Mann-Whitney AUC over ``(…group, y, s)`` rows."""
    g = ", ".join(group)
    gsel = (g + ", ") if group else ""
    part = f"PARTITION BY {g} " if group else ""
    grp = f"GROUP BY {g}" if group else ""
    return f"""
SELECT {gsel}sum(pos * (nb + 0.5 * neg)) / (sum(pos) * sum(neg)) AS auc FROM (
  SELECT {gsel}pos, neg,
         coalesce(sum(neg) OVER ({part}ORDER BY s ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS nb
  FROM (SELECT {gsel}s, CAST(count_if(y = 1) AS DOUBLE) AS pos, CAST(count_if(y = 0) AS DOUBLE) AS neg
        FROM ({scores_sql}) GROUP BY {gsel}s)) {grp}"""


# ---- stacking ------------------------------------------------------------------------

@register("stack_outer", with_ctes(
    "SELECT sample_id, " + ", ".join(f"round(\"{c}\", 6) AS \"{c}\"" for c in stacked_columns())
    + ", label FROM meta", "meta"))
def q_stack_outer(spark: SparkSession, sf_dir: str) -> DataFrame:
    """J1 (union + bounded pivot) + J2 (labels) + A19 (fill 1/K) + U5."""
    meta, _, _ = meta_table(Tables(spark, sf_dir))
    return rounded(meta)


@register("stack_outer_join", with_ctes(
    "SELECT sample_id, " + ", ".join(f"round(\"{c}\", 6) AS \"{c}\"" for c in stacked_columns())
    + ", label FROM meta", "meta"))
def q_stack_outer_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """J1 as the full-outer join chain of per-expert wide OOF tables (keys
    are unique per expert, so the result equals the union form)."""
    t = Tables(spark, sf_dir)
    classes = classes_of(t)
    wides = [X.oof_table(o, m, classes) for m, o in expert_oofs(t, classes).items()]
    chained = J.stack_outer_join(wides)
    cols = [c for c in chained.columns if c != "sample_id"]
    labelled = J.attach_labels(chained, B.samples(t))
    return rounded(J.fill_uninformative(labelled, cols, len(classes)))


def document_expert(t: Tables) -> DataFrame:
    docs = B.binary_documents(t)
    folds = FO.stratified_folds(docs, "sample_id", "label", K_FOLDS, 42)
    cells = docs.select("sample_id", F.col("source").alias("feature"), F.lit(1).alias("w"))
    return X.frequency_expert(cells, folds, [0, 1], K_FOLDS, "w")


def document_scores(t: Tables) -> DataFrame:
    return document_expert(t).where(F.col("class") == 1) \
        .select("sample_id", "label", "fold", F.col("prob").alias("score"))


@register("harmonise_binary", with_ctes("""
SELECT sample_id, round(score, 6) AS pred_doc_normal_prob, round(1 - score, 6) AS pred_doc_cancer_prob
FROM doc_scores""", "doc_scores"))
def q_harmonise(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Binary OOF ``pred_<m>_binary`` -> normal / cancer probabilities."""
    s = document_scores(Tables(spark, sf_dir)).select("sample_id", F.col("score").alias("pred_doc_binary"))
    return rounded(J.harmonise_binary(s, "doc"))


# ---- multiclass metrics ------------------------------------------------------------

@register("accuracy", with_ctes(
    "SELECT round(avg(CASE WHEN label = pred THEN 1.0 ELSE 0.0 END), 6) AS accuracy FROM fx_expr_pred",
    "fx_expr_pred"))
def q_accuracy(spark: SparkSession, sf_dir: str) -> DataFrame:
    """E1 over the out-of-fold predictions."""
    return rounded(M.accuracy(expert_predictions(expression_expert(Tables(spark, sf_dir)))))


@register("classification_report", with_ctes("""
SELECT class, round(precision, 6) AS precision, round(recall, 6) AS recall, round(f1, 6) AS f1,
       CAST(support AS BIGINT) AS support FROM per_class
UNION ALL SELECT 'accuracy', NULL, NULL, round(sum(tp) / sum(support), 6), CAST(sum(support) AS BIGINT) FROM per_class
UNION ALL SELECT 'macro avg', round(avg(precision), 6), round(avg(recall), 6), round(avg(f1), 6),
       CAST(sum(support) AS BIGINT) FROM per_class
UNION ALL SELECT 'weighted avg', round(sum(precision * support) / sum(support), 6),
       round(sum(recall * support) / sum(support), 6), round(sum(f1 * support) / sum(support), 6),
       CAST(sum(support) AS BIGINT) FROM per_class""", "per_class"))
def q_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    """E7 (+E8 underneath): per-class precision/recall/f1/support and averages."""
    t = Tables(spark, sf_dir)
    classes = classes_of(t)
    # the K x K table feeds four report branches: write it once
    conf = materialize(M.confusion_matrix(expert_predictions(expression_expert(t, classes)), classes),
                       "confusion")
    return rounded(M.classification_report(conf))


@register("f1_weighted", with_ctes(
    "SELECT round(sum(f1 * support) / sum(support), 6) AS f1_weighted FROM per_class", "per_class"))
def q_f1_weighted(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Support-weighted F1."""
    t = Tables(spark, sf_dir)
    classes = classes_of(t)
    conf = materialize(M.confusion_matrix(expert_predictions(expression_expert(t, classes)), classes),
                       "confusion")
    return rounded(M.f1_weighted(conf))


@register("log_loss", with_ctes(f"""
SELECT round(-avg(ln(p / z)), 6) AS log_loss FROM (
  SELECT class, label, greatest(least(prob, 1 - {EPS!r}), {EPS!r}) AS p,
         sum(greatest(least(prob, 1 - {EPS!r}), {EPS!r})) OVER (PARTITION BY sample_id) AS z
  FROM fx_expr_oof) WHERE class = label""", "fx_expr_oof"))
def q_log_loss(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Log loss of the true class after clipping to [eps, 1-eps] and
    renormalising each sample's probabilities."""
    return rounded(M.log_loss(expression_expert(Tables(spark, sf_dir)), eps=EPS))


@register("roc_auc_ovr", with_ctes(
    "SELECT round(avg(auc), 6) AS auc_ovr FROM (" + _auc_sql(
        "SELECT class, CASE WHEN label = class THEN 1 ELSE 0 END AS y, prob AS s FROM fx_expr_oof", ["class"])
    + ")", "fx_expr_oof"))
def q_auc_ovr(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One-vs-rest macro AUC (exact, ties counted one half)."""
    return rounded(M.roc_auc_ovr(expression_expert(Tables(spark, sf_dir))))


_FOLD_SQL = with_ctes("""
SELECT fold, 'acc' AS metric, round(avg(CASE WHEN label = pred THEN 1.0 ELSE 0.0 END), 6) AS value
FROM fx_expr_pred GROUP BY fold
UNION ALL
SELECT fold, 'log_loss', round(-avg(ln(p / z)), 6) FROM (
  SELECT fold, class, label, greatest(least(prob, 1 - 2.220446049250313e-16), 2.220446049250313e-16) AS p, sum(greatest(least(prob, 1 - 2.220446049250313e-16), 2.220446049250313e-16)) OVER (PARTITION BY fold, sample_id) AS z FROM fx_expr_oof)
WHERE class = label GROUP BY fold
UNION ALL
SELECT fold, 'auc', round(avg(auc), 6) FROM (""" + _auc_sql(
    "SELECT fold, class, CASE WHEN label = class THEN 1 ELSE 0 END AS y, prob AS s FROM fx_expr_oof",
    ["fold", "class"]) + """) GROUP BY fold
UNION ALL
SELECT fold, 'f1', round(sum(f1 * support) / sum(support), 6) FROM (
  SELECT fold, class, support, CASE WHEN precision + recall > 0 THEN 2 * precision * recall / (precision + recall) ELSE 0.0 END AS f1
  FROM (SELECT f.fold, c.class, coalesce(s.support, 0) AS support,
               CASE WHEN coalesce(p.predicted, 0) > 0 THEN s.tp / p.predicted ELSE 0.0 END AS precision,
               CASE WHEN coalesce(s.support, 0) > 0 THEN s.tp / s.support ELSE 0.0 END AS recall
        FROM (SELECT DISTINCT fold FROM fx_expr_pred) f CROSS JOIN classes c
        LEFT JOIN (SELECT fold, label AS class, count(*) AS support, count_if(label = pred) AS tp
                   FROM fx_expr_pred GROUP BY ALL) s ON s.fold = f.fold AND s.class = c.class
        LEFT JOIN (SELECT fold, pred AS class, count(*) AS predicted FROM fx_expr_pred GROUP BY ALL) p
               ON p.fold = f.fold AND p.class = c.class))
GROUP BY fold""", "fx_expr_pred", "fx_expr_oof", "classes")


def _fold_scores(t: Tables) -> DataFrame:
    classes = classes_of(t)
    # the OOF table feeds four metric branches: write it once
    oof = materialize(expression_expert(t, classes), "oof")
    return M.fold_scores(expert_predictions(oof), oof, classes, ("fold",))


@register("fold_scores", _FOLD_SQL)
def q_fold_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per-fold acc / weighted f1 / ovr auc / log loss (long)."""
    return rounded(_fold_scores(Tables(spark, sf_dir)))


@register("summarise_folds", "SELECT metric, round(avg(value), 6) AS mean_value FROM (" + _FOLD_SQL + ") GROUP BY metric")
def q_summarise_folds(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Unweighted mean of the fold metrics."""
    from ..operators.stats import summarise_folds
    # the mean of the reported (rounded) fold scores, as a report would show
    return rounded(summarise_folds(rounded(_fold_scores(Tables(spark, sf_dir)))))


# ---- binary metrics ------------------------------------------------------------------

@register("roc_auc_binary", with_ctes(
    "SELECT round(auc, 6) AS auc FROM (" + _auc_sql("SELECT label AS y, score AS s FROM doc_scores", []) + ")",
    "doc_scores"))
def q_auc_binary(spark: SparkSession, sf_dir: str) -> DataFrame:
    """E5: exact binary ROC AUC of the document expert (many tied scores)."""
    return rounded(M.roc_auc(document_scores(Tables(spark, sf_dir)), (), "label", "score"))


@register("f1_binary_threshold", with_ctes("""
SELECT round(CASE WHEN 2 * tp + fp + fn > 0 THEN 2 * tp / (2 * tp + fp + fn) ELSE 0.0 END, 6) AS f1,
       round(acc, 6) AS accuracy
FROM (SELECT count_if(label = 1 AND score > 0.5) AS tp, count_if(label <> 1 AND score > 0.5) AS fp,
             count_if(label = 1 AND NOT score > 0.5) AS fn,
             avg(CASE WHEN label = CAST(score > 0.5 AS INTEGER) THEN 1.0 ELSE 0.0 END) AS acc
      FROM doc_scores)""", "doc_scores"))
def q_f1_binary(spark: SparkSession, sf_dir: str) -> DataFrame:
    """E3 + P17: threshold 0.5 -> 0/1, binary F1 of code 1, accuracy."""
    s = document_scores(Tables(spark, sf_dir)).withColumn("pred", S.threshold("score", 0.5))
    return rounded(M.binary_summary(s, (), "label", "pred", 1))


# ---- attributions and importance ------------------------------------------------------

cte("act_counts", """
SELECT sample_id, feature, CAST(count(*) AS DOUBLE) AS value FROM act_events
WHERE sample_id IS NOT NULL AND feature IS NOT NULL GROUP BY ALL""", ("act_events",))
cte("combo_cells", """
SELECT sample_id, concat(feature, '_expr') AS feature, value FROM expr_cells_all
UNION ALL SELECT sample_id, concat(feature, '_mut'), CAST(value AS DOUBLE) FROM mut_presence
UNION ALL SELECT sample_id, concat(feature, '_act'), value FROM act_counts""",
    ("expr_cells_all", "mut_presence", "act_counts"))


def linear_model_ctes(prefix: str, cells: str, labels: str, classes: str):
    cte(f"{prefix}_x", f"""
SELECT c.sample_id, c.feature, c.value, s.label AS class FROM {cells} c JOIN {labels} s ON c.sample_id = s.sample_id""",
        (cells, labels))
    cte(f"{prefix}_n", f"SELECT count(DISTINCT sample_id) AS n FROM {prefix}_x", (f"{prefix}_x",))
    cte(f"{prefix}_means", f"""
SELECT feature, sum(value) / (SELECT n FROM {prefix}_n) AS mean, count(*) AS n_present FROM {prefix}_x GROUP BY feature""",
        (f"{prefix}_x", f"{prefix}_n"))
    cte(f"{prefix}_w", f"""
SELECT k.class, m.feature, coalesce(s.s, 0.0) / nc.nc - m.mean AS w
FROM {prefix}_means m CROSS JOIN {classes} k
JOIN (SELECT class, count(DISTINCT sample_id) AS nc FROM {prefix}_x GROUP BY class) nc ON nc.class = k.class
LEFT JOIN (SELECT class, feature, sum(value) AS s FROM {prefix}_x GROUP BY ALL) s
  ON s.class = k.class AND s.feature = m.feature""", (f"{prefix}_means", f"{prefix}_x", classes))
    cte(f"{prefix}_imp", f"""
SELECT w.feature, avg(abs(w.w)) * d.mad AS importance
FROM {prefix}_w w JOIN (
  SELECT x.feature, (sum(abs(x.value - m.mean)) + ((SELECT n FROM {prefix}_n) - m.n_present) * abs(m.mean))
                    / (SELECT n FROM {prefix}_n) AS mad
  FROM {prefix}_x x JOIN {prefix}_means m ON x.feature = m.feature GROUP BY x.feature, m.mean, m.n_present) d
  ON w.feature = d.feature
GROUP BY w.feature, d.mad""", (f"{prefix}_w", f"{prefix}_x", f"{prefix}_means", f"{prefix}_n"))


linear_model_ctes("lm", "combo_cells", "samples", "classes")
cte("meta_long", "UNPIVOT meta ON COLUMNS(* EXCLUDE (sample_id, label)) INTO NAME feature VALUE value", ("meta",))
linear_model_ctes("mm", "meta_long", "samples", "classes")


def combined_cells(t: Tables) -> DataFrame:
    expr = R.cell_mean(B.expression_long(t)) \
        .select("sample_id", F.concat("feature", F.lit("_expr")).alias("feature"), "value")
    mut = R.presence(R.filter_in(B.mutation_events(t), "variant_class", ["A", "R"])) \
        .select("sample_id", F.concat("feature", F.lit("_mut")).alias("feature"),
                F.col("value").cast("double").alias("value"))
    act = R.cell_agg(B.activity_events(t).withColumn("value", F.lit(1.0)), "count") \
        .select("sample_id", F.concat("feature", F.lit("_act")).alias("feature"), "value")
    return expr.unionByName(mut).unionByName(act)


def combined_model(t: Tables):
    classes = classes_of(t)
    # staged once: the model, the attributions and the importances all read it
    cells = materialize(combined_cells(t), "combined_cells")
    w, means, n = EX.centroid_model(cells, B.samples(t), classes)
    return cells, w, means, n, classes


def combined_importance(t: Tables) -> DataFrame:
    cells, w, means, n, _ = combined_model(t)
    return EX.linear_importance(cells.join(B.samples(t).select("sample_id"), "sample_id"), w, means, n)


@register("linear_shapley", with_ctes("""
SELECT x.sample_id, w.class, x.feature, round(w.w * (x.value - m.mean), 6) AS phi
FROM lm_x x JOIN lm_means m ON x.feature = m.feature JOIN lm_w w ON w.feature = x.feature""",
                                      "lm_x", "lm_means", "lm_w"))
def q_linear_shapley(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Exact Shapley values of a linear scorer (class-centroid weights
    learnt from the data), one row per present cell and class."""
    t = Tables(spark, sf_dir)
    cells, w, means, _, _ = combined_model(t)
    lab = cells.join(B.samples(t).select("sample_id"), "sample_id")
    return rounded(EX.linear_shapley(lab, w, means))


@register("feature_importance", with_ctes(
    "SELECT feature, round(importance, 6) AS importance FROM lm_imp", "lm_imp"))
def q_feature_importance(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Mean |phi| over all samples and classes (absent cells included)."""
    return rounded(combined_importance(Tables(spark, sf_dir)))


@register("importance_by_modality", with_ctes("""
SELECT split_part(feature, '_', -1) AS omics_type, round(sum(importance), 6) AS importance
FROM lm_imp GROUP BY 1""", "lm_imp"))
def q_importance_by_modality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """modality = last ``_`` token, summed and sorted desc."""
    imp = combined_importance(Tables(spark, sf_dir))
    if not EX.expert_rollup_applies(imp):  # the expert roll-up needs >1 parsed modality
        return rounded(EX.importance_by_modality(imp, "suffix").limit(0))
    return rounded(EX.importance_by_modality(imp, "suffix"))


@register("top_features", with_ctes("""
SELECT feature, round(importance, 6) AS importance FROM lm_imp ORDER BY importance DESC, feature LIMIT 20""",
                                    "lm_imp"))
def q_top_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Global top 20 features by importance (a top-k report)."""
    return rounded(T.top_features(combined_importance(Tables(spark, sf_dir)), "importance", 20))


@register("top_per_group", with_ctes("""
SELECT omics_type, feature, round(importance, 6) AS importance FROM (
  SELECT split_part(feature, '_', -1) AS omics_type, feature, importance,
         row_number() OVER (PARTITION BY split_part(feature, '_', -1) ORDER BY importance DESC, feature) AS rn
  FROM lm_imp) WHERE rn <= 10""", "lm_imp"))
def q_top_per_group(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Top 10 features inside each modality."""
    imp = combined_importance(Tables(spark, sf_dir)) \
        .withColumn("omics_type", S.modality_from_suffix("feature"))
    return rounded(T.top_per_group(imp, "omics_type", "importance", 10)
                   .select("omics_type", "feature", "importance"))


@register("check_attributions", with_ctes("""
SELECT count(DISTINCT sample_id) AS n_samples, count(DISTINCT class) AS n_classes,
       (SELECT count(*) FROM classes) AS n_classes_expected
FROM (SELECT x.sample_id, w.class FROM lm_x x JOIN lm_w w ON w.feature = x.feature)""",
                                          "lm_x", "lm_w", "classes"))
def q_check_attributions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Attribution shape check (samples, classes) and additivity."""
    t = Tables(spark, sf_dir)
    cells, w, means, _, classes = combined_model(t)
    lab = cells.join(B.samples(t).select("sample_id"), "sample_id")
    phi = EX.linear_shapley(lab, w, means)
    chk = EX.check_attributions(phi, lab, w, means, len(classes))
    bad = chk.where(~F.col("additive")).count()
    if bad:
        raise AssertionError("linear attributions are not additive")
    return chk.select("n_samples", "n_classes", F.col("n_classes_expected").cast("long"))


@register("meta_importance_by_modality", with_ctes("""
SELECT CASE WHEN starts_with(feature, 'pred_') THEN coalesce(split_part(feature, '_', 2), '') ELSE 'other_omics' END
         AS omics_type, round(sum(importance), 6) AS importance
FROM mm_imp GROUP BY 1""", "mm_imp"))
def q_meta_importance(spark: SparkSession, sf_dir: str) -> DataFrame:
    """X3/X4/F6 at the stacking level: importance of each ``pred_<m>_<c>``
    input rolled up by modality (second ``_`` token)."""
    t = Tables(spark, sf_dir)
    meta, cols, classes = meta_table(t)
    meta = materialize(meta, "meta_table")  # read four times below
    long = R.melt_wide(meta.drop("label"), "sample_id", cols)
    w, means, n = EX.centroid_model(long, meta.select("sample_id", "label"), classes)
    imp = EX.linear_importance(long, w, means, n)
    return rounded(EX.importance_by_modality(imp, "pred"))


@register("name_parsing", with_ctes("""
SELECT name, split_part(name, '_', -1) AS suffix_modality,
       CASE WHEN starts_with(name, 'pred_') THEN coalesce(split_part(name, '_', 2), '') ELSE 'other_omics' END AS pred_modality,
       CASE WHEN starts_with(name, 'pred_')
            THEN replace(replace(replace(name, 'pred_', ''), '_cancer_prob', ''), '_normal_prob', '') ELSE name END
         AS binary_modality,
       upper(name) AS upper_name, contains(name, '_') AS has_underscore
FROM (SELECT DISTINCT col AS name FROM stack_long
      UNION SELECT 'pred_doc_normal_prob' FROM doc_scores UNION SELECT 'pred_doc_cancer_prob' FROM doc_scores
      UNION SELECT DISTINCT feature FROM combo_cells)""", "stack_long", "doc_scores", "combo_cells"))
def q_name_parsing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """name parsing rules over every produced column name."""
    t = Tables(spark, sf_dir)
    classes = classes_of(t)
    names = reduce(lambda a, b: a.unionByName(b), [
        X.oof_long_named(o, m).select(F.col("column").alias("name")) for m, o in expert_oofs(t, classes).items()])
    harm = J.harmonise_binary(document_scores(t).select("sample_id", F.col("score").alias("pred_doc_binary")), "doc")
    hnames = harm.select(F.explode(F.array(*[F.lit(c) for c in harm.columns if c != "sample_id"])).alias("name"))
    fnames = combined_cells(t).select(F.col("feature").alias("name"))
    allnames = names.unionByName(hnames).unionByName(fnames).distinct()
    n = F.col("name")
    return allnames.select("name", S.modality_from_suffix(n).alias("suffix_modality"),
                           S.modality_from_pred(n).alias("pred_modality"),
                           S.modality_from_binary_pred(n).alias("binary_modality"),
                           F.upper(n).alias("upper_name"), n.contains("_").alias("has_underscore"))


@register("encode_labels", with_ctes("""
SELECT s.sample_id, s.label, CAST(k.code AS INTEGER) AS code
FROM samples s JOIN (SELECT label, dense_rank() OVER (ORDER BY label) - 1 AS code FROM (SELECT DISTINCT label FROM samples)) k
  ON s.label = k.label""", "samples"))
def q_encode_labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Alphabetical class codes from 0 (label-encoder order)."""
    t = Tables(spark, sf_dir)
    s = B.samples(t)
    return J.encode_labels(s, J.class_codes(s)).select("sample_id", "label", "code")


@register("coerce_numeric_text", r"""
SELECT doc_id, count(*) AS n_tokens,
       CAST(count_if(regexp_full_match(tok, '[ \t\n\r\f]*[+-]?(([0-9]+(\.[0-9]*)?|\.[0-9]+)([eE][+-]?[0-9]+)?|[iI][nN][fF]([iI][nN][iI][tT][yY])?|[nN][aA][nN])[ \t\n\r\f]*')
                AND NOT isnan(TRY_CAST(regexp_replace(tok, '^[ \t\n\r\f]+|[ \t\n\r\f]+$', '', 'g') AS DOUBLE))) AS BIGINT) AS n_numeric,
       max(CASE WHEN regexp_full_match(tok, '[ \t\n\r\f]*[+-]?(([0-9]+(\.[0-9]*)?|\.[0-9]+)([eE][+-]?[0-9]+)?|[iI][nN][fF]([iI][nN][iI][tT][yY])?|[nN][aA][nN])[ \t\n\r\f]*')
                      THEN coalesce(nullif(TRY_CAST(regexp_replace(tok, '^[ \t\n\r\f]+|[ \t\n\r\f]+$', '', 'g') AS DOUBLE), 'NaN'::DOUBLE), 0.0)
                      ELSE 0.0 END) AS value_max
FROM (SELECT doc_id, unnest(string_split(text, ' ')) AS tok FROM documents) GROUP BY doc_id""")
def q_coerce_numeric_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Coercing numeric parse of every whitespace token of every
    document (bad text -> 0); token counts and the largest coerced value per
    document (an order-free aggregate: sums of 16-digit numbers differ in the
    last bit between engines)."""
    t = Tables(spark, sf_dir)
    toks = t.documents.select("doc_id", F.explode(F.split("text", " ")).alias("tok"))
    parsed = toks.select("doc_id", S.coerce_numeric("tok", None).alias("v"))
    return rounded(parsed.groupBy("doc_id").agg(
        F.count(F.lit(1)).alias("n_tokens"), F.count("v").alias("n_numeric"),
        F.max(F.coalesce("v", F.lit(0.0))).alias("value_max")))


@register("strip_feature_lines", r"""
SELECT item_id, CAST(pos - 1 AS INTEGER) AS pos,
       regexp_replace(line, '^[ \t\n\r\f\x0B]+|[ \t\n\r\f\x0B]+$', '', 'g') AS feature
FROM (SELECT item_id, unnest(string_split(text, chr(10))) AS line,
             generate_subscripts(string_split(text, chr(10)), 1) AS pos FROM benchmark)""")
def q_strip_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One feature per line, surrounding whitespace stripped, order kept."""
    t = Tables(spark, sf_dir)
    x = t.benchmark.select("item_id", F.posexplode(F.split("text", "\n")).alias("pos", "line"))
    return x.select("item_id", F.col("pos").cast("int").alias("pos"), S.strip_ws("line").alias("feature"))


@register("normalise_key", """
SELECT upper(CAST(source AS VARCHAR)) AS key, count(*) AS n FROM documents WHERE source IS NOT NULL GROUP BY 1""")
def q_normalise_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    """P10: key normalisation (text, upper case; missing keys dropped)."""
    t = Tables(spark, sf_dir)
    k = t.documents.select(S.normalise_key("source").alias("key")).where(F.col("key").isNotNull())
    return k.groupBy("key").agg(F.count(F.lit(1)).alias("n"))


cte("fx_expr_split", """
SELECT CASE WHEN f.fold = a.fold THEN 'val' ELSE 'train' END AS split, f.fold, a.sample_id, a.label, m.class, m.prob
FROM fx_expr_assigned a CROSS JOIN (SELECT CAST(range AS INTEGER) AS fold FROM range(5)) f
JOIN fx_expr_model m ON m.feature = a.feature AND m.fold = f.fold""", ("fx_expr_assigned", "fx_expr_model"))
cte("fx_expr_split_pred", """
SELECT split, fold, sample_id, label, arg_min(class, (-prob, class)) AS pred FROM fx_expr_split GROUP BY ALL""",
    ("fx_expr_split",))


@register("fold_scores_by_split", with_ctes("""
SELECT split, fold, 'acc' AS metric, round(avg(CASE WHEN label = pred THEN 1.0 ELSE 0.0 END), 6) AS value
FROM fx_expr_split_pred GROUP BY split, fold
UNION ALL
SELECT split, fold, 'log_loss', round(-avg(ln(p / z)), 6) FROM (
  SELECT split, fold, class, label, greatest(least(prob, 1 - 2.220446049250313e-16), 2.220446049250313e-16) AS p, sum(greatest(least(prob, 1 - 2.220446049250313e-16), 2.220446049250313e-16)) OVER (PARTITION BY split, fold, sample_id) AS z
  FROM fx_expr_split)
WHERE class = label GROUP BY split, fold
UNION ALL
SELECT split, fold, 'auc', round(avg(auc), 6) FROM (""" + _auc_sql(
    "SELECT split, fold, class, CASE WHEN label = class THEN 1 ELSE 0 END AS y, prob AS s FROM fx_expr_split",
    ["split", "fold", "class"]) + """) GROUP BY split, fold""", "fx_expr_split", "fx_expr_split_pred"))
def q_fold_scores_by_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    """E9 (training and validation rows): every fold's model scores its own
    fold and the other folds; acc / ovr auc / log loss per (split, fold)."""
    t = Tables(spark, sf_dir)
    classes = classes_of(t)
    from .queries import customer_folds
    probs = materialize(X.frequency_scores_by_split(B.expression_long(t), customer_folds(t), classes,
                                                    K_FOLDS, "value"), "split_scores")
    g = ["split", "fold"]
    keys = ["split", "fold", "sample_id"]
    probs = spread(probs, probs.count(), *keys)
    pred = T.argmax_class(probs, keys, "class", "prob", "pred")
    preds = probs.select(*keys, "label").distinct().join(pred, keys)
    acc = M.accuracy(preds, g).select(*g, F.lit("acc").alias("metric"), F.col("accuracy").alias("value"))
    ll = M.log_loss(probs, g).select(*g, F.lit("log_loss").alias("metric"), F.col("log_loss").alias("value"))
    auc = M.roc_auc_ovr(probs, g).select(*g, F.lit("auc").alias("metric"), F.col("auc_ovr").alias("value"))
    return rounded(acc.unionByName(ll).unionByName(auc))


@register("fold_members", with_ctes("""
SELECT f.fold, CASE WHEN k.fold = f.fold THEN 'val' ELSE 'train' END AS split, count(*) AS n_samples,
       count(DISTINCT k.label) AS n_labels
FROM folds k CROSS JOIN (SELECT CAST(range AS INTEGER) AS fold FROM range(5)) f
GROUP BY 1, 2""", "folds"))
def q_fold_members(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fold membership as used by the fits - validation rows are the
    fold, training rows every other fold (filters on ``fold``, not positions)."""
    from .queries import customer_folds
    f = customer_folds(Tables(spark, sf_dir))
    per = f.select("sample_id", "label", F.col("fold").alias("_own"),
                   F.explode(F.sequence(F.lit(0), F.lit(K_FOLDS - 1))).alias("fold"))
    per = per.withColumn("split", F.when(F.col("fold") == F.col("_own"), F.lit("val")).otherwise(F.lit("train")))
    return per.groupBy("fold", "split").agg(F.count(F.lit(1)).alias("n_samples"),
                                            F.countDistinct("label").alias("n_labels"))
