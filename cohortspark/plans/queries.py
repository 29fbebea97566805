"""Query definitions (Spark plan + DuckDB twin) over the role bindings."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import experts as X
from ..operators import folds as FO
from ..operators import joins as J
from ..operators import metrics as M
from ..operators import reshape as R
from ..operators import topk as T
from ..sources.tables import Tables
from . import bindings as B
from .registry import register, rounded
from .sql_ctes import with_ctes

K_FOLDS = 5
SEED = 42


# ---- shared Spark steps -------------------------------------------------------

def customer_folds(t: Tables) -> DataFrame:
    return FO.stratified_folds(B.samples(t), "sample_id", "label", K_FOLDS, SEED)


def classes_of(t: Tables) -> list:
    return _classes(t.spark, t.sf_dir)


def _classes(spark: SparkSession, sf_dir: str) -> list:
    return J.class_list(B.samples(Tables(spark, sf_dir)), "label")


def expression_expert(t: Tables, classes: list | None = None) -> DataFrame:
    classes = classes or classes_of(t)
    return X.frequency_expert(B.expression_long(t), customer_folds(t), classes, K_FOLDS, "value")


def mutation_expert(t: Tables, classes: list | None = None) -> DataFrame:
    classes = classes or classes_of(t)
    ev = R.filter_in(B.mutation_events(t), "variant_class", ["A", "R"]).withColumn("w", F.lit(1))
    return X.frequency_expert(ev, customer_folds(t), classes, K_FOLDS, "w")


def activity_expert(t: Tables, classes: list | None = None) -> DataFrame:
    classes = classes or classes_of(t)
    ev = B.activity_events(t).withColumn("w", F.lit(1))
    return X.frequency_expert(ev, customer_folds(t), classes, K_FOLDS, "w")


def expert_predictions(oof: DataFrame) -> DataFrame:
    pred = T.argmax_class(oof, "sample_id", "class", "prob", "pred")
    return oof.select("sample_id", "label", "fold").distinct().join(pred, "sample_id")


# ---- minimum slice ---------------------------------------------------------------

@register("stratified_folds", with_ctes("SELECT sample_id, label, fold FROM folds", "folds"))
def q_stratified_folds(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Deterministic stratified 5-fold assignment (md5 order, seed 42)."""
    return customer_folds(Tables(spark, sf_dir)).select("sample_id", "label", "fold")


@register("frequency_expert_oof", with_ctes(
    "SELECT sample_id, label, fold, class, round(prob, 6) AS prob FROM fx_expr_oof", "fx_expr_oof"))
def q_frequency_expert(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Leakage-free OOF probabilities of the frequency expert (long)."""
    return rounded(expression_expert(Tables(spark, sf_dir)))


@register("argmax_class", with_ctes(
    "SELECT sample_id, label, fold, pred FROM fx_expr_pred", "fx_expr_pred"))
def q_argmax(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Row-wise argmax over class probabilities, ties -> lowest code."""
    return expert_predictions(expression_expert(Tables(spark, sf_dir)))


@register("confusion_matrix", with_ctes("""
SELECT t.class AS label, p.class AS pred, CAST(count(x.sample_id) AS BIGINT) AS n
FROM classes t CROSS JOIN classes p
LEFT JOIN fx_expr_pred x ON x.label = t.class AND x.pred = p.class
GROUP BY t.class, p.class""", "fx_expr_pred", "classes"))
def q_confusion(spark: SparkSession, sf_dir: str) -> DataFrame:
    """K x K confusion table with zero cells (flagship query)."""
    t = Tables(spark, sf_dir)
    classes = classes_of(t)
    return M.confusion_matrix(expert_predictions(expression_expert(t, classes)), classes)


def flagship(spark: SparkSession, sf_dir: str) -> DataFrame:
    return q_confusion(spark, sf_dir)
