"""Model-training queries (Spark ML; rows-only checks).

Spark ML fits cannot be replayed in SQL, so these queries have no SQL twin;
their properties (coverage, additivity, probability sums) are unit-tested.
Round counts of the boosted experts and of the search in the registered queries
are kept small (``QUERY_ROUNDS``) so the whole registry runs in bounded time; the
stacker and the library defaults follow the reference settings.
"""

from __future__ import annotations

import os
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import explain as EX
from ..operators import joins as J
from ..operators import metrics as M
from ..operators import ml as ML
from ..operators import reduce as RD
from ..operators import reshape as R
from ..operators import rounds as RO
from ..operators import treeshap as TS
from ..session import ensure_checkpoint_dir, materialize, spread
from ..sources.tables import Tables
from . import bindings as B
from . import chain as CH
from . import training as TR
from .features import assemble_samples, split_xy
from .queries_stats import category_features
from .queries import K_FOLDS
from .registry import register, rounded
from .sql_ctes import with_ctes

QUERY_ROUNDS = 20
# Rounds of the checks of curves and of the round kept.
CHECK_ROUNDS = 12
# The registered search keeps every grid except the round count, which is
# held at QUERY_ROUNDS (Spark's GBT costs a few jobs per round).
QUERY_GRID = dict(ML.SEARCH_GRID, maxIter=[QUERY_ROUNDS])


@register("expert_oof_lr")
def q_expert_lr(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Multinomial logistic regression expert, OOF probabilities."""
    oof, *_ = TR.train_expert(Tables(spark, sf_dir), "lr")
    return rounded(oof)


@register("expert_oof_rf")
def q_expert_rf(spark: SparkSession, sf_dir: str) -> DataFrame:
    """L2/L3: random forest expert (200 trees, seed 42), OOF probabilities."""
    oof, *_ = TR.train_expert(Tables(spark, sf_dir), "rf")
    return rounded(oof)


@register("expert_oof_gbt")
def q_expert_gbt(spark: SparkSession, sf_dir: str) -> DataFrame:
    """L2/L4: one-vs-rest boosted trees with inner hold-out early stopping."""
    oof, *_ = TR.train_expert(Tables(spark, sf_dir), "gbt", maxIter=QUERY_ROUNDS, maxDepth=3)
    return rounded(oof)


@register("expert_fold_scores")
def q_expert_fold_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    """E9 on a Spark ML expert: per-fold acc / f1 / auc / log loss."""
    t = Tables(spark, sf_dir)
    oof, _, _, _, codes = TR.train_expert(t, "lr")
    classes = [r.label for r in codes.orderBy("code").collect()]
    return rounded(M.fold_scores(TR.oof_predictions(oof), oof, classes, ("fold",)))


@register("learning_curve")
def q_learning_curve(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Validation loss of every fold / class model after every round fitted."""
    frame, _, codes = TR.expression_frame(Tables(spark, sf_dir))
    _, models = ML.fit_oof(frame, "gbt", codes, K_FOLDS, maxIter=QUERY_ROUNDS, maxDepth=3)
    curve = RO.round_losses(models, [frame.where(F.col("fold") == i) for i in range(K_FOLDS)])
    return curve.join(J.checked_broadcast(codes, J.MAX_CLASSES), "code").select("fold", F.col("label").alias("class"), "round", "loss")


@register("boosting_round_checks", with_ctes("""
SELECT f.fold, k.class, %d AS n_rounds, 0::BIGINT AS n_off, TRUE AS kept_best
FROM (SELECT DISTINCT f.fold FROM expr_cells s JOIN folds f ON s.sample_id = f.sample_id) f CROSS JOIN classes k""" % CHECK_ROUNDS,
                                             "expr_cells", "folds", "classes"))
def q_boosting_round_checks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per fold and class the rounds of the curve on the fold's own rows, the rounds whose
    loss differs from Spark's own, and whether a model cut by patience has the least loss of its curve."""
    frame, _, codes = TR.expression_frame(Tables(spark, sf_dir))
    classes = [r.label for r in codes.orderBy("code").collect()]
    _, models = ML.fit_oof(frame, "gbt", codes, K_FOLDS, maxIter=CHECK_ROUNDS, maxDepth=3)
    parts = [frame.where(F.col("fold") == i) for i in range(K_FOLDS)]
    own = []  # folds x classes x rounds values
    for fold, m in enumerate(models):
        for c, cm in enumerate(m.models):
            losses = cm.evaluateEachIteration(parts[fold].withColumn("_yc", (F.col("y") == c).cast("double")))
            own += [(fold, c, i + 1, float(v)) for i, v in enumerate(losses)]
    own = spark.createDataFrame(own, "fold int, code int, round int, spark_loss double")
    curve = materialize(RO.round_losses(models, parts), "round_losses")
    _, kept = RO.keep_best(models, parts, CHECK_ROUNDS)
    cut = materialize(RO.round_losses(models, parts), "cut_losses").groupBy("fold", "code").agg(
        F.max_by("loss", "round").alias("last"), F.max("round").alias("cut_rounds"))
    kept = spark.createDataFrame([(f, c, n) for (f, c), n in kept.items()], "fold int, code int, kept int")
    per = curve.join(own, ["fold", "code", "round"], "full").groupBy("fold", "code").agg(
        F.count(F.lit(1)).cast("int").alias("n_rounds"), F.min("loss").alias("least"),
        F.count_if(~F.coalesce(F.abs(F.col("loss") - F.col("spark_loss")) < 1e-9, F.lit(False))).alias("n_off"))
    names = F.array(*[F.lit(str(c)) for c in classes])
    return per.join(cut, ["fold", "code"], "left").join(kept, ["fold", "code"], "left").select(
        "fold", F.element_at(names, F.col("code") + 1).alias("class"), "n_rounds", "n_off",
        F.coalesce((F.abs(F.col("last") - F.col("least")) < 1e-12) & (F.col("cut_rounds") == F.col("kept")), F.lit(False)).alias("kept_best"))


@register("stacker_oof")
def q_stacker(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Multiclass stacker over the outer-joined OOF table, all its rounds, hard predictions."""
    oof, *_ = TR.train_stacker(Tables(spark, sf_dir))
    return TR.oof_predictions(oof)


@register("tree_shapley")
def q_tree_shapley(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per-row path-dependent tree Shapley values of a random forest."""
    t = Tables(spark, sf_dir)
    frame, dictionary, codes = TR.expression_frame(t)
    model = ML.make_estimator("rf", codes.count(), numTrees=50, maxDepth=5).fit(frame)
    names = [r.feature for r in dictionary.orderBy("pos").collect()]
    classes = [r.label for r in codes.orderBy("code").collect()]
    phi, _ = TS.tree_shapley(model, frame, "rf", names, classes)
    return rounded(phi)


@register("tree_attribution_checks", with_ctes("""
SELECT m.model, f.fold, k.class, count(*) AS n_rows, 0::BIGINT AS n_off
FROM (SELECT DISTINCT sample_id FROM expr_cells) s JOIN folds f ON s.sample_id = f.sample_id
CROSS JOIN classes k CROSS JOIN (VALUES ('forest'), ('one_vs_rest'), ('binary')) m(model)
WHERE m.model <> 'binary' OR k.class = (SELECT min(class) FROM classes)
GROUP BY ALL""", "expr_cells", "folds", "classes"))
def q_tree_attribution_checks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Attributions of every validation row by its own fold's model, for
    a forest of depth 12, a one-vs-rest boosted set and a binary boosted model;
    per fold and class the rows, and the rows that miss additivity."""
    t = Tables(spark, sf_dir)
    frame, dictionary, codes = TR.expression_frame(t)
    names = [r.feature for r in dictionary.orderBy("pos").collect()]
    classes = [r.label for r in codes.orderBy("code").collect()]
    first = frame.withColumn("y", (F.col("y") == 0).cast("double"))
    runs = []
    for model, rows, kind, listed, est in (
            ("forest", frame, "rf", classes, ML.make_estimator("rf", len(classes), numTrees=20, maxDepth=12)),
            ("one_vs_rest", frame, "gbt", classes, ML.make_estimator("gbt", len(classes), maxIter=3, maxDepth=4)),
            ("binary", first, "gbt", classes[:1], ML.make_estimator("gbt", 2, maxIter=3, maxDepth=4))):
        models = ML.fit_folds(rows, est, K_FOLDS)
        phi, base = TS.fold_attributions(models, rows, kind, names, listed)
        checked = TS.additivity(phi, base, TS.model_outputs(models, rows, kind, listed))
        runs.append(checked.select(F.lit(model).alias("model"), "fold", "class", "n_rows", "n_off"))
    return runs[0].unionByName(runs[1]).unionByName(runs[2])


@register("tree_importance")
def q_tree_importance(spark: SparkSession, sf_dir: str) -> DataFrame:
    """X3/X5 on tree attributions: mean |phi| per feature, top 20."""
    t = Tables(spark, sf_dir)
    frame, dictionary, codes = TR.expression_frame(t)
    model = ML.make_estimator("rf", codes.count(), numTrees=50, maxDepth=5).fit(frame)
    names = [r.feature for r in dictionary.orderBy("pos").collect()]
    classes = [r.label for r in codes.orderBy("code").collect()]
    phi, _ = TS.tree_shapley(model, frame, "rf", names, classes)
    imp = EX.feature_importance(phi, frame.count(), len(classes))
    return rounded(imp.orderBy(F.col("importance").desc(), "feature").limit(20))


@register("pca_scores")
def q_pca(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Centred PCA of the probe matrix (component count capped at
    min(k, n, d)), scores in long form with ``<m>_PCA_PC<i>`` names."""
    t = Tables(spark, sf_dir)
    long = B.methylation_long(t).select("sample_id", "feature", "value")
    dictionary = R.feature_dictionary(long)
    d = dictionary.count()
    vec = R.assemble_dense(R.align_long(long, dictionary), d, 0.0)
    n = vec.count()
    k = RD.component_cap(100, n, d)
    scaler, model, signs, ev = RD.fit_pca(vec, k, d)
    return rounded(RD.apply_pca(vec, scaler, model, signs, "Meth"))


@register("sample_forest")
def q_sample_forest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Random forest (seed 42) on the assembled normal/cancer
    samples; returns the fitted model's feature importances."""
    t = Tables(spark, sf_dir)
    # read by the dictionary, the vectors and the targets, the frame by every pass of the fit
    X_long, y = split_xy(materialize(assemble_samples(category_features(t)), "forest_cells"))
    cells = X_long.select("sample_id", "feature", "value")
    dictionary = R.feature_dictionary(cells)
    d = dictionary.count()
    vec = R.assemble_dense(R.align_long(cells, dictionary), d, 0.0)
    n = y.count()
    frame = vec.join(y.withColumn("y", F.col("target").cast("double")), "sample_id")
    frame = materialize(spread(frame, n, "sample_id", width=d), "forest_frame")
    model = ML.make_estimator("rf", 2, numTrees=100).fit(frame)
    imp = model.featureImportances.toArray()
    names = [r.feature for r in dictionary.orderBy("pos").collect()]
    return spark.createDataFrame([(f, float(v)) for f, v in zip(names, imp)],
                                 "feature string, importance double")


@register("binary_stacker_oof")
def q_binary_stacker(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Binary stacker: class weight, random search, CV with
    inner hold-out, threshold 0.5; per-fold acc / f1 / auc."""
    oof, trials, best, final, frame = TR.train_binary_stacker(Tables(spark, sf_dir), n_iter=3, grid=QUERY_GRID)
    return rounded(TR.binary_fold_scores(TR.binary_scores(oof)))


@register("random_search_trials")
def q_random_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Seeded random-search trials (weighted F1 per draw)."""
    meta, cols = TR.document_binary_meta(Tables(spark, sf_dir))
    frame, _ = ML.wide_ml_frame(meta, cols, "label")
    _, _, trials = ML.random_search(materialize(frame, "search_frame"), 3, 42, grid=QUERY_GRID)
    return rounded(trials)


@register("sampled_shapley")
def q_sampled_shapley(spark: SparkSession, sf_dir: str) -> DataFrame:
    """X2 (b): model-agnostic sampled-permutation Shapley values of the
    logistic-regression expert against a 10-row background sample."""
    t = Tables(spark, sf_dir)
    frame, dictionary, codes = TR.expression_frame(t)
    model = ML.make_estimator("lr", codes.count()).fit(frame)
    names = [r.feature for r in dictionary.orderBy("pos").collect()]
    classes = [r.label for r in codes.orderBy("code").collect()]
    bg = EX.background_rows(frame, 10)
    return rounded(EX.sampled_shapley(model, frame, bg, classes, n_perm=2, feature_names=names))


@register("sample_dataset_pca")
def q_sample_dataset_pca(spark: SparkSession, sf_dir: str) -> DataFrame:
    """L15 with L11/U3/A13: per modality features of both categories united,
    median-imputed (combined fit), reduced by PCA fitted on both, gathered per
    (sample, category) into ``<id>_NORMAL`` / ``<id>_CANCER`` rows."""
    from .features import impute_and_reduce
    t = Tables(spark, sf_dir)
    reduced, _ = impute_and_reduce(category_features(t), "evt", 50)
    return rounded(assemble_samples(reduced).select("sample_id", "target", "feature", "value"))


@register("pca_randomized")
def q_pca_randomized(spark: SparkSession, sf_dir: str) -> DataFrame:
    """L11 for wide modalities: randomized range-finder PCA (no d x d
    covariance, no n x n Gram matrix) of the probe matrix, 10 components."""
    t = Tables(spark, sf_dir)
    long = B.methylation_long(t).select("sample_id", "feature", "value")
    dictionary = R.feature_dictionary(long)
    d = dictionary.count()
    lp = R.align_long(long, dictionary)
    n = long.select("sample_id").distinct().count()
    scores, _ = RD.pca_long(lp, d, RD.component_cap(10, n, d), n, "Meth", method="randomized")
    return rounded(scores)


@register("pca_variance", """
SELECT route, least(count(*), (SELECT count(*) FROM embeddings)) AS n_components, round(sum(v), 4) AS variance
FROM (SELECT i, var_samp(x) AS v
      FROM (SELECT generate_subscripts(embedding, 1) AS i, CAST(unnest(embedding) AS DOUBLE) AS x FROM embeddings) GROUP BY i)
CROSS JOIN (VALUES ('exact'), ('sketch')) r(route) GROUP BY route""")
def q_pca_variance(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The components of the probe matrix together hold its whole variance, by the covariance
    route and by the sketch."""
    t = Tables(spark, sf_dir)
    long = materialize(B.methylation_long(t).select("sample_id", "feature", "value"), "probe_cells")
    dictionary = R.feature_dictionary(long)
    d, n = dictionary.count(), long.select("sample_id").distinct().count()
    cells = R.align_long(long, dictionary)
    out = None
    for route, method in (("exact", "exact"), ("sketch", "randomized")):
        scores, _ = RD.pca_long(cells, d, RD.component_cap(d, n, d), n, "Meth", method=method)
        per = scores.groupBy("component").agg(F.var_samp("score").alias("v"))
        row = per.agg(F.count(F.lit(1)).alias("n_components"), F.round(F.sum("v"), 4).alias("variance")) \
            .select(F.lit(route).alias("route"), "n_components", "variance")
        out = row if out is None else out.unionByName(row)
    return out


@register("chain_replay_checks", with_ctes("""
SELECT v.variant, k.class, count(*) AS n_rows, 0::BIGINT AS n_off
FROM folds f CROSS JOIN classes k CROSS JOIN (VALUES ('scaled'), ('reduced')) v(variant) GROUP BY ALL""", "folds", "classes"))
def q_chain_replay(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The chain of medians, scaler, components and model, saved and loaded, scores every
    sample as it did when it was fitted; per class the rows, and the rows that differ."""
    t = Tables(spark, sf_dir)
    cells, labels = materialize(R.cell_mean(B.expression_long(t)), "chain_cells"), B.samples(t)
    out = None
    for variant, components in (("scaled", None), ("reduced", 5)):
        chain = CH.fit_chain(cells, labels, "lr", components, maxIter=50)
        path = os.path.join(ensure_checkpoint_dir(spark), "chains", uuid.uuid4().hex)
        CH.save_chain(chain, path)
        want = chain.score(cells, labels).withColumnRenamed("prob", "fitted")
        got = CH.load_chain(spark, path).score(cells, labels)
        same = F.coalesce(F.abs(F.col("fitted") - F.col("prob")) < 1e-9, F.lit(False))
        row = want.join(got, ["sample_id", "class"], "full").groupBy("class").agg(
            F.count(F.lit(1)).alias("n_rows"), F.count_if(~same).alias("n_off")) \
            .select(F.lit(variant).alias("variant"), "class", "n_rows", "n_off")
        out = row if out is None else out.unionByName(row)
    return out
