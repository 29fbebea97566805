"""Physical-plan assertions: pushdown, pruning, bounded top-n, no cartesian products."""

from cohortspark.operators import reshape as R
from cohortspark.operators import topk as T
from cohortspark.plans import bindings as B
from cohortspark.sources.tables import Tables

from conftest import SF001


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_prefix_filter_pushed_and_pruned(spark):
    part = Tables(spark, SF001).part
    p = _plan(R.filter_prefix(part.select("p_partkey", "p_brand"), "p_brand", "Brand#1"))
    assert "StringStartsWith(p_brand,Brand#1)" in p
    assert "ReadSchema: struct<p_partkey:bigint,p_brand:string>" in p


def test_top_per_group_is_group_limited(spark):
    t = Tables(spark, SF001)
    df = t.part.select("p_brand", "p_name", "p_retailprice")
    p = _plan(T.top_per_group(df, "p_brand", "p_retailprice", 3, "p_name"))
    assert "WindowGroupLimit" in p


def test_registered_queries_have_no_cartesian_product(spark):
    import __spark_entry__ as E
    for name, fn in E.queries().items():
        if name in {"expert_oof_lr", "expert_oof_rf", "expert_oof_gbt", "expert_fold_scores", "learning_curve",
                    "stacker_oof", "tree_shapley", "tree_importance", "pca_scores", "sample_forest",
                    "binary_stacker_oof", "random_search_trials", "check_attributions"}:
            continue
        plan = _plan(fn(spark, SF001))
        assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan, name


def test_fold_ranking_never_windows_a_whole_label(spark):
    """Every data-sized window of the fold assignment is partitioned by a hash bucket."""
    from cohortspark.operators.folds import stratified_folds
    from cohortspark.plans.bindings import samples
    df = stratified_folds(samples(Tables(spark, SF001)))
    p = df._jdf.queryExecution().executedPlan().toString()
    windows = [line for line in p.splitlines() if "Window [" in line and "row_number" in line]
    assert windows and all("_bucket" in w for w in windows)
