import itertools
import math

import numpy as np
import pytest
from pyspark.ml.functions import vector_to_array
from pyspark.ml.linalg import Vectors
from pyspark.sql import functions as F

from cohortspark.operators import ml as ML
from cohortspark.operators import reduce as RD
from cohortspark.operators import treeshap as TS


def _frame(spark, n=120, d=4, k=3, seed=0):
    rng = np.random.default_rng(seed)
    X = rng.normal(size=(n, d))
    y = (np.argmax(X[:, :k] + 0.3 * rng.normal(size=(n, k)), axis=1)).astype(float)
    rows = [(i, Vectors.dense(X[i].tolist()), float(y[i]), str(int(y[i])), i % 5) for i in range(n)]
    return spark.createDataFrame(rows, ["sample_id", "features", "y", "label", "fold"]), X


def _brute_phi(recs, x, d, n_out):
    """Shapley values by enumerating all feature subsets of the game
    v(S) = sum_leaves value * prod_{f in S on path} 1[x_f in I_f] * prod_{f not in S} r_f."""
    def v(S):
        tot = np.zeros(n_out)
        for feats, lo, hi, rr, val in recs:
            w = 1.0
            for g, f in enumerate(feats):
                w *= (1.0 if lo[g] < x[f] <= hi[g] else 0.0) if f in S else rr[g]
            tot += w * val
        return tot
    phi = np.zeros((d, n_out))
    for j in range(d):
        others = [f for f in range(d) if f != j]
        for size in range(d):
            for S in itertools.combinations(others, size):
                wgt = math.factorial(size) * math.factorial(d - size - 1) / math.factorial(d)
                phi[j] += wgt * (v(set(S) | {j}) - v(set(S)))
    return phi


def test_tree_shapley_rf_brute_force_and_additivity(spark):
    df, X = _frame(spark)
    m = ML.make_estimator("rf", 3, numTrees=3, maxDepth=3).fit(df)
    trees, weights = TS.node_tables(m)
    recs = TS.path_records(trees, weights, "rf")
    fast = TS.shap_batch(X[:5], recs, 4, 3)
    for i in range(5):
        assert np.allclose(fast[i], _brute_phi(recs, X[i], 4, 3), atol=1e-12)
    phi, base = TS.tree_shapley(m, df, "rf", ["a", "b", "c", "d"], ["0", "1", "2"])
    sums = {(r[0], r[1]): r[2] for r in phi.groupBy("sample_id", "class").agg(F.sum("phi")).collect()}
    probs = {r[0]: r[1] for r in m.transform(df).select("sample_id", vector_to_array("probability")).collect()}
    for (sid, c), s in sums.items():
        assert s + base[int(c)] == pytest.approx(probs[sid][int(c)], abs=1e-12)


def test_tree_shapley_gbt_margin(spark):
    df, _ = _frame(spark)
    b = df.withColumn("y", (F.col("y") == 0).cast("double"))
    m = ML.make_estimator("gbt", 2, maxIter=4, maxDepth=3).fit(b)
    phi, base = TS.tree_shapley(m, b, "gbt", ["a", "b", "c", "d"])
    sums = {r[0]: r[1] for r in phi.groupBy("sample_id").agg(F.sum("phi")).collect()}
    raw = m.transform(b).select("sample_id", vector_to_array("rawPrediction")).collect()
    for sid, r in raw:
        assert sums.get(sid, 0.0) + base[0] == pytest.approx(r[1], abs=1e-12)


def test_tree_shapley_of_deep_trees_repeated_features_and_odd_values():
    """Paths of up to 12 distinct features, with and without satisfied conditions, NaN and infinities."""
    rng = np.random.default_rng(8)
    d = 12
    recs = []
    for m in (0, 1, 2, 5, 9, 12):
        feats = np.sort(rng.choice(d, m, replace=False))
        lo = np.where(rng.random(m) < 0.5, -np.inf, rng.normal(size=m))
        hi = np.where(rng.random(m) < 0.5, np.inf, np.where(np.isinf(lo), 0, lo) + rng.random(m))
        recs.append((feats, lo, hi, rng.uniform(0.05, 1, m), rng.normal(size=2)))
    X = rng.normal(size=(3, d))
    fast = TS.shap_batch(X, recs, d, 2)
    for i in range(len(X)):
        assert np.allclose(fast[i], _brute_phi(recs, X[i], d, 2), atol=1e-12)
    one = [(np.array([0]), np.array([-np.inf]), np.array([1.0]), np.array([0.4]), np.array([1.0])),
           (np.array([0]), np.array([1.0]), np.array([np.inf]), np.array([0.6]), np.array([3.0]))]
    odd = np.array([[np.nan], [-np.inf], [np.inf], [1.0]])  # Spark sends NaN to the right
    assert np.allclose(TS.shap_batch(odd, one, 1, 1).ravel(), np.array([3.0, 1.0, 3.0, 1.0]) - 2.2)


def test_deep_forest_and_one_vs_rest_add_up_on_validation_rows(spark):
    df, _ = _frame(spark, n=200, d=14)
    names = [f"f{i}" for i in range(14)]
    for kind, est in (("rf", ML.make_estimator("rf", 3, numTrees=4, maxDepth=12)), ("gbt", ML.make_estimator("gbt", 3, maxIter=2, maxDepth=3))):
        models = ML.fit_folds(df, est, 5)
        phi, base = TS.fold_attributions(models, df, kind, names, ["0", "1", "2"])
        got = TS.additivity(phi, base, TS.model_outputs(models, df, kind, ["0", "1", "2"])).collect()
        assert len(got) == 15 and sum(r.n_rows for r in got) == 600 and not any(r.n_off for r in got)


def test_vectors_are_assembled_in_one_sorted_pass(spark):
    from cohortspark.operators import vectors as V
    rng = np.random.default_rng(1)
    d, want = 300, {}
    for i in range(40):
        want[f"s{i}"] = {int(j): float(rng.normal()) for j in rng.choice(d, 250 if i % 2 else 3, replace=False)}
    rows = [(s, j, v) for s, cells in want.items() for j, v in cells.items()]
    rows += [("s1", None, 5.0), ("s2", 299 if 299 not in want["s2"] else 298, None), (None, 3, 1.0)]
    cells = spark.createDataFrame(rows, "sample_id string, pos int, value double").repartition(5)
    got = {r[0]: r[1] for r in V.assemble_vectors(cells, d).collect()}
    assert got == {s: Vectors.sparse(d, cells) for s, cells in want.items()}
    fill = rng.normal(size=d)
    spine = spark.createDataFrame([("s0",), ("s0",), ("new",), (None,)], "sample_id string")
    kept = {r[0]: r[1].toArray() for r in V.assemble_vectors(cells, d, fill=list(fill), samples=spine.distinct()).collect()}
    assert set(kept) == {"s0", "new"} and np.array_equal(kept["new"], fill)
    assert all(kept["s0"][j] == want["s0"].get(j, fill[j]) for j in range(d))
    with pytest.raises(Exception, match="twice"):
        V.assemble_vectors(cells.unionByName(cells), d).collect()


def test_fit_oof_probabilities_sum_to_one(spark):
    df, _ = _frame(spark)
    codes = spark.createDataFrame([("0", 0), ("1", 1), ("2", 2)], "label string, code int")
    for kind, p in (("lr", {"maxIter": 50}), ("rf", {"numTrees": 10}), ("gbt", {"maxIter": 3})):
        oof, models = ML.fit_oof(df, kind, codes, 5, **p)
        sums = oof.groupBy("sample_id").agg(F.sum("prob").alias("s"), F.countDistinct("fold").alias("f"))
        r = sums.agg(F.min("s"), F.max("s"), F.max("f"), F.count("*")).first()
        assert r[0] == pytest.approx(1.0) and r[1] == pytest.approx(1.0) and r[2] == 1 and r[3] == 120
    with pytest.raises(ValueError):
        ML.make_estimator("svm", 3)


def test_pca_matches_numpy(spark):
    df, X = _frame(spark, n=60, d=5)
    scaler, model, signs, ev = RD.fit_pca(df, 3, 5)
    Xc = X - X.mean(axis=0)
    _, s, vt = np.linalg.svd(Xc, full_matrices=False)
    assert np.allclose(ev, (s ** 2 / (s ** 2).sum())[:3], atol=1e-9)
    scores = RD.apply_pca(df, scaler, model, signs, "M", long=False).orderBy("sample_id").collect()
    got = np.array([r[1].toArray() for r in scores])
    ref = Xc @ vt[:3].T
    assert np.allclose(np.abs(got), np.abs(ref), atol=1e-8)
    assert RD.component_cap(100, 60, 5) == 5 and RD.component_cap(None, 1, 1) == 0


def test_random_search_trials(spark):
    df, _ = _frame(spark, n=80)
    b = df.withColumn("y", (F.col("y") == 0).cast("double"))
    best, score, trials = ML.random_search(b, 2, 42, grid=dict(ML.SEARCH_GRID, maxIter=[2]), class_ratio=2.0)
    assert trials.count() == 2 and 0 <= score <= 1 and best["maxIter"] == 2
    assert ML.draw_params(3, 42) == ML.draw_params(3, 42)


def test_sampled_shapley_additive_and_exact_for_linear(spark):
    from pyspark.ml.regression import LinearRegression
    from cohortspark.operators import explain as EX
    df, X = _frame(spark, n=40, d=4)
    lr = LinearRegression(featuresCol="features", labelCol="y", predictionCol="pred").fit(df)
    wrapped = lr.setPredictionCol("pred")

    class VecOut:
        def transform(self, d):
            from pyspark.ml.functions import array_to_vector
            return wrapped.transform(d).withColumn("out", array_to_vector(F.array("pred")))
    bg = EX.background_rows(df, 3)
    phi = EX.sampled_shapley(VecOut(), df, bg, ["y"], n_perm=2, output="out",
                             feature_names=["a", "b", "c", "d"])
    got = {(r["sample_id"], r["feature"]): r["phi"] for r in phi.collect()}
    coef = lr.coefficients.toArray()
    mean_bg = np.mean(np.array(bg), axis=0)
    for i in range(5):
        for j, f in enumerate("abcd"):
            assert got[(i, f)] == pytest.approx(coef[j] * (X[i, j] - mean_bg[j]), abs=1e-9)


def test_impute_and_reduce_matches_numpy(spark):
    from cohortspark.plans.features import impute_and_reduce
    rng = np.random.default_rng(4)
    rows = []
    dense = {}
    for cat in ("normal", "cancer"):
        feats = ["f0", "f1", "f2"] if cat == "normal" else ["f1", "f2", "f3"]
        for s in range(12):
            for f in feats:
                v = float(rng.normal())
                rows.append((cat, s, f, v, -0.5 if cat == "normal" else 0.25))
                dense[(cat, s, f)] = v
    df = spark.createDataFrame(rows, "category string, sample_id long, feature string, value double, zero_value double")
    out, ev = impute_and_reduce(df, "M", 2)
    # reference: union of columns, NULL where a file lacks the feature, median fill, centred PCA
    names = ["f0", "f1", "f2", "f3"]
    keys = [(c, s) for c in ("cancer", "normal") for s in range(12)]
    X = np.array([[dense.get((c, s, f), np.nan) for f in names] for c, s in keys])
    med = np.nanmedian(X, axis=0)
    X = np.where(np.isnan(X), med, X)
    Xc = X - X.mean(axis=0)
    _, sv, _ = np.linalg.svd(Xc, full_matrices=False)
    assert np.allclose(ev, (sv ** 2 / (sv ** 2).sum())[:2], atol=1e-9)
    assert out.count() == 24 * 2
    same, _ = impute_and_reduce(df, "M", 0)
    assert same is df


def test_randomized_pca_matches_numpy(spark):
    from cohortspark.operators import reduce as RD
    rng = np.random.default_rng(7)
    n, d = 80, 30
    base = rng.normal(size=(n, 3)) @ rng.normal(size=(3, d)) * 3 + rng.normal(size=(n, d)) * 0.1
    base[rng.random((n, d)) < 0.3] = 0.0
    rows = [(i, j, float(base[i, j])) for i in range(n) for j in range(d) if base[i, j] != 0]
    lp = spark.createDataFrame(rows, "sample_id long, pos int, value double")
    comps, ev, mu, tv = RD.randomized_pca(lp, d, 3, n, oversample=5, power_iters=2)
    Xc = base - base.mean(axis=0)
    _, s, vt = np.linalg.svd(Xc, full_matrices=False)
    assert np.allclose(ev, s[:3] ** 2 / (n - 1), rtol=1e-3)  # randomized: approximate
    assert tv == pytest.approx((s ** 2).sum() / (n - 1))
    for j in range(3):
        assert abs(abs(comps[:, j] @ vt[j]) - 1) < 1e-3
    sc = {(r[0], r[1]): r[2] for r in RD.randomized_scores(lp, comps, mu, "M").collect()}
    ref = Xc @ comps
    assert sc[(5, "M_PCA_PC1")] == pytest.approx(ref[5, 0], abs=1e-8)


def test_impute_and_reduce_has_no_width_limit(spark):
    """5,000 features: components come back and equal those of the dense matrix."""
    from cohortspark.plans.features import impute_and_reduce
    rng = np.random.default_rng(4)
    d, rows = 5000, [(c, s) for c in ("cancer", "normal") for s in range(8)]
    dense = rng.standard_normal((len(rows), 3)) @ rng.standard_normal((3, d))
    cells = [(c, s, f"f{j:04d}", float(dense[i, j]), 0.0) for i, (c, s) in enumerate(rows) for j in range(d)]
    df = spark.createDataFrame(cells, "category string, sample_id int, feature string, value double, zero_value double")
    out, ev = impute_and_reduce(df, "M", 3)
    got = {(r.category, r.sample_id, r.feature): r.value for r in out.collect()}
    _, s, vt = np.linalg.svd(dense - dense.mean(0), full_matrices=False)
    for j in range(3):
        want = (dense - dense.mean(0)) @ vt[j]
        have = np.array([got[c, i, f"M_PCA_PC{j + 1}"] for c, i in rows])
        assert np.allclose(np.abs(want), np.abs(have), rtol=1e-6, atol=1e-6)
    assert abs(ev.sum() - 1) < 1e-9


def test_scoring_keeps_samples_without_a_listed_feature(spark):
    from cohortspark.plans.integrate import prepare_events, prepare_long
    raw = spark.createDataFrame([(1, "a", 2.0), (1, "z", 5.0), (2, "z", 1.0), (3, None, 1.0)], "sample_id int, feature string, value double")
    names = spark.createDataFrame([(0, "a"), (1, "b")], "pos int, feature string")
    for out in (prepare_long(raw, names), prepare_events(raw.drop("value"), names)):
        assert sorted((r.sample_id, r.feature, r.pos) for r in out.collect()) == [(1, "a", 0), (2, None, None)]
    from cohortspark.operators.vectors import assemble_vectors
    got = {r.sample_id: list(r.features.toArray()) for r in assemble_vectors(prepare_long(raw, names), 2).collect()}
    assert got == {1: [2.0, 0.0], 2: [0.0, 0.0]}


def test_round_losses_equal_sparks_and_the_best_round_is_kept(spark):
    from cohortspark.operators import rounds as RO
    df, _ = _frame(spark, n=200)
    binary = df.withColumn("y", (F.col("y") == 0).cast("double"))
    for rows, n in ((df, 3), (binary, 2)):
        models = ML.fit_folds(rows, ML.make_estimator("gbt", n, maxIter=8, maxDepth=3), 5)
        parts = [rows.where(F.col("fold") == i) for i in range(5)]
        got = {(r["fold"], r["code"], r["round"]): r["loss"] for r in RO.round_losses(models, parts).collect()}
        want = {}
        for fold, m in enumerate(models):
            for c, cm in enumerate(m.models) if n == 3 else [(1, m)]:
                own = parts[fold].withColumn("_yc", (F.col("y") == c).cast("double"))
                want.update({(fold, c, i + 1): v for i, v in enumerate(cm.evaluateEachIteration(own))})
        assert set(got) == set(want) and all(got[k] == pytest.approx(want[k], abs=1e-12) for k in want)
        whole = models[0].models[0] if n == 3 else models[0]
        cut = RO.truncate(whole, 3)
        assert cut.getNumTrees == 3 and cut.treeWeights == whole.treeWeights[:3] and cut.getLabelCol() == whole.getLabelCol()
        fold0 = parts[0].withColumn("_yc", (F.col("y") == (0 if n == 3 else 1)).cast("double"))
        assert cut.evaluateEachIteration(fold0) == pytest.approx(whole.evaluateEachIteration(fold0)[:3])
        best, kept = RO.keep_best(models, parts, 8)
        for (fold, c), rounds in kept.items():
            curve = [want[fold, c, i + 1] for i in range(8)]
            assert rounds == 1 + curve.index(min(curve))
            assert (best[fold].models[c] if n == 3 else best[fold]).getNumTrees == rounds
        assert RO.round_losses(models, [p.limit(0) for p in parts]).count() == 0


def test_patience_looks_past_a_round_that_gains_nothing():
    from cohortspark.operators.rounds import kept_rounds
    curve = [5, 4, 4.5, 4.2, 3, 3.5, 3.4, 3.3, 1]
    assert [kept_rounds(curve, p) for p in (1, 2, 3, 4, 9)] == [2, 2, 5, 9, 9]
    assert kept_rounds([2, 2, 2], 10) == 1 and kept_rounds([float("inf"), 1], 1) == 2


def test_sampled_shapley_needs_no_window_and_skips_null_rows(spark):
    from cohortspark.operators import explain as EX
    df, _ = _frame(spark, n=30, d=3)
    model = ML.make_estimator("lr", 3).fit(df)
    bg = EX.background_rows(df, 2)
    rows = df.select("sample_id", "features").unionByName(
        spark.createDataFrame([(None, Vectors.dense([0.0] * 3)), (99, None)], df.select("sample_id", "features").schema))
    phi = EX.sampled_shapley(model, rows, bg, ["0", "1", "2"], n_perm=3)
    plan = phi._jdf.queryExecution().executedPlan().toString()
    assert "Window" not in plan and plan.count("Exchange hashpartitioning") == 1
    out = phi.groupBy("sample_id", "class").agg(F.sum("phi").alias("s"), F.count("*").alias("n")).collect()
    assert len(out) == 90 and all(r["n"] == 3 for r in out)
    proba = {r["sample_id"]: r["probability"].toArray() for r in model.transform(df).collect()}
    base = np.mean([r["probability"].toArray() for r in model.transform(
        spark.createDataFrame([(Vectors.dense(b),) for b in bg], ["features"])).collect()], axis=0)
    assert all(r["s"] == pytest.approx(proba[r["sample_id"]][int(r["class"])] - base[int(r["class"])], abs=1e-9) for r in out)


def test_search_goes_on_from_its_trials(spark, tmp_path, monkeypatch):
    df, _ = _frame(spark, n=80)
    b = df.withColumn("y", (F.col("y") == 0).cast("double"))
    path, grid = str(tmp_path / "trials"), dict(ML.SEARCH_GRID, maxIter=[2])
    whole = ML.random_search(b, 2, 42, grid=grid)
    assert ML.random_search(b, 1, 42, grid=grid, trial_path=path)[1] >= 0
    (tmp_path / "trials" / "trial-0-3" / "_SUCCESS").unlink()
    fits = []
    fit = ML.GBTClassifier.fit
    monkeypatch.setattr(ML.GBTClassifier, "fit", lambda self, rows: fits.append(1) or fit(self, rows))
    again = ML.random_search(b, 2, 42, grid=grid, trial_path=path)
    assert len(fits) == 6  # one torn trial and the second draw's five folds
    assert again[0] == whole[0] and again[2].orderBy("trial").collect() == whole[2].orderBy("trial").collect()
    ML.random_search(b, 2, 42, grid=grid, trial_path=path)
    assert len(fits) == 6
    ML.random_search(b, 1, 42, grid=dict(grid, maxIter=[3]), trial_path=path)
    assert len(fits) == 11  # other parameters are other trials


def test_sampled_shapley_scores_only_changed_rows_and_sums_repeated_keys(spark):
    import hashlib
    from cohortspark.operators import explain as EX
    df, X = _frame(spark, n=24, d=5)
    model = ML.make_estimator("lr", 3).fit(df)
    bg = [X[0].tolist(), X[1].tolist()]
    seen = []

    class Counting:
        def transform(self, rows):
            seen.append(rows)
            return model.transform(rows)
    rows = df.select("sample_id", "features").where("sample_id < 4")
    rows = rows.unionAll(rows.where("sample_id = 3"))
    got = {(r["sample_id"], r["feature"], r["class"]): r["phi"]
           for r in EX.sampled_shapley(Counting(), rows, bg, ["0", "1", "2"], n_perm=2).collect()}
    assert len(got) == 4 * 5 * 3
    # 5 rows x 4 draws of 6 steps, less the 5 steps of the two draws in which a sample is its own background
    assert seen[0].count() == 5 * 4 * 6 - 2 * 2 * 5

    def f(z):
        e = model.interceptVector.toArray() + model.coefficientMatrix.toArray() @ z
        p = np.exp(e - e.max())
        return p / p.sum()
    for i in range(4):
        want = np.zeros((5, 3))
        for b, p in itertools.product(range(2), range(2)):
            z = X[b].copy()
            for j in sorted(range(5), key=lambda j: hashlib.md5(f"42-{i}-{b}-{p}-{j}".encode()).hexdigest()):
                before, z[j] = f(z), X[i, j]
                want[j] += (f(z) - before) / 4 * (2 if i == 3 else 1)
        for j, c in itertools.product(range(5), range(3)):
            assert got[i, str(j), str(c)] == pytest.approx(want[j, c], abs=1e-9)


def test_tree_walks_equal_path_records(spark):
    df, X = _frame(spark, n=700, d=5)
    model = ML.make_estimator("rf", 3, numTrees=3, maxDepth=9).fit(df)  # paths repeat features
    trees, weights = TS.node_tables(model, spark)
    X = X.copy()
    X[3, 1] = np.nan
    walks = TS.TreeWalks(trees, weights, "rf")
    want = TS.shap_batch(X, TS.path_records(trees, weights, "rf"), 5, 3)  # 700 rows: two blocks
    assert np.abs(walks.attributions(X) - want[:, walks.touched, :]).max() < 1e-12
    gbt = ML.make_estimator("gbt", 2, maxIter=2, maxDepth=4).fit(df.withColumn("y", (F.col("y") == 0).cast("double")))
    trees, weights = TS.node_tables(gbt, spark)
    walks = TS.TreeWalks(trees, weights, "gbt")
    want = TS.shap_batch(X, TS.path_records(trees, weights, "gbt"), 5, 1)
    assert np.abs(walks.attributions(X) - want[:, walks.touched, :]).max() < 1e-12
    stump = {0: {0: {"leftChild": -1, "rightChild": -1, "prediction": 2.0}}}
    assert TS.TreeWalks(stump, [1.0], "gbt").attributions(X).shape == (700, 0, 1)
    split = {"featureIndex": 0, "leftCategoriesOrThreshold": [0.0], "leftChild": 1, "rightChild": 2, "rawCount": 4}
    leaf = {"leftChild": -1, "rightChild": -1}
    empty = {0: {0: split, 1: {**leaf, "prediction": 1.0, "rawCount": 4}, 2: {**leaf, "prediction": 3.0, "rawCount": 0}}}
    assert isinstance(TS._evaluator(empty, [1.0], "gbt")[0], TS.PathGroups)


def test_spread_bounds_what_a_task_holds(spark, monkeypatch):
    from cohortspark import session as SE
    from cohortspark.operators import joins as J
    preds = spark.range(1000).select(F.col("id").alias("sample_id"), F.lit("a").alias("column"), F.lit(0.5).alias("prob"))
    assert SE.spread(preds, 1000, "sample_id") is preds
    monkeypatch.setattr(SE, "SPREAD_ROWS", 100)
    assert SE.spread(preds, 1000, "sample_id", width=3).rdd.getNumPartitions() == 30
    stacked = J.stack_outer(preds, ["a"], n_rows=1000)
    assert stacked.rdd.getNumPartitions() == 10  # not coalesced, and not shuffled again
    assert stacked.where("a = 0.5").count() == 1000


def test_fits_read_a_written_and_spread_frame(spark, monkeypatch):
    from cohortspark import session as SE
    from cohortspark.plans import queries_ml as QM
    from cohortspark.plans import training as TR
    from cohortspark.sources.tables import Tables
    monkeypatch.setattr(SE, "SPREAD_ROWS", 100)
    seen = []

    class Stop(Exception):
        pass

    class Estimator:
        def fit(self, frame):
            seen.append(frame)
            raise Stop

    def stop(frame, *a, **k):
        seen.append(frame)
        raise Stop
    monkeypatch.setattr(ML, "make_estimator", lambda *a, **k: Estimator())
    monkeypatch.setattr(ML, "fit_oof", stop)
    with pytest.raises(Stop):
        QM.q_sample_forest(spark, "/root/testdata/sf0.001")
    with pytest.raises(Stop):
        TR.train_stacker(Tables(spark, "/root/testdata/sf0.001"))
    for frame, name in zip(seen, ("forest_frame", "stacker_frame")):
        files = frame.inputFiles()
        assert len(files) > 1 and all(name in f for f in files)


def test_reduction_evaluates_its_features_once(spark):
    from cohortspark.plans.features import impute_and_reduce
    calls = spark.sparkContext.accumulator(0)

    def value(v):
        calls.add(1)
        return v
    rng = np.random.default_rng(3)
    rows = [(c, s, f, float(rng.normal()), 0.0) for c in ("normal", "cancer") for s in range(8) for f in ("f0", "f1", "f2")]
    features = spark.createDataFrame(rows, ["category", "sample_id", "feature", "value", "zero_value"]) \
        .withColumn("value", F.udf(value, "double")("value"))
    out, _ = impute_and_reduce(features, "m", 2)
    assert out.count() == 16 * 2 and calls.value == len(rows)


def test_modality_roll_up_reads_a_written_meta_table(spark, monkeypatch):
    from cohortspark.operators import explain as EX
    from cohortspark.plans import queries_eval as QE
    seen = []
    model = EX.centroid_model
    monkeypatch.setattr(EX, "centroid_model", lambda cells, *a, **k: seen.append(cells) or model(cells, *a, **k))
    assert QE.q_meta_importance(spark, "/root/testdata/sf0.001").count() == 3
    assert all("meta_table" in f for f in seen[0].inputFiles())


def test_split_scores_are_spread_before_their_metrics(spark, monkeypatch):
    from cohortspark import session as SE
    from cohortspark.plans import queries_eval as QE
    want = sorted(map(tuple, QE.q_fold_scores_by_split(spark, "/root/testdata/sf0.001").collect()))
    monkeypatch.setattr(SE, "SPREAD_ROWS", 100)
    seen = []
    loss = QE.M.log_loss
    monkeypatch.setattr(QE.M, "log_loss", lambda probs, *a, **k: seen.append(probs) or loss(probs, *a, **k))
    got = sorted(map(tuple, QE.q_fold_scores_by_split(spark, "/root/testdata/sf0.001").collect()))
    assert got == want and seen[0].rdd.getNumPartitions() >= 10


def test_stacker_query_fits_every_round(spark, tmp_path, monkeypatch):
    from cohortspark.plans import queries_ml as Q
    from cohortspark.plans import training as TR
    rng = np.random.default_rng(3)
    rows = [(i, f"c{i % 3}", *rng.random(2).tolist()) for i in range(60)]
    table = spark.createDataFrame(rows, "sample_id int, label string, a double, b double")
    table.selectExpr("sample_id c_custkey", "label c_mktsegment").write.parquet(str(tmp_path / "customer.parquet"))
    monkeypatch.setattr(TR, "meta_table", lambda t: (table, ["a", "b"], ["c0", "c1", "c2"]))
    asked, fit = {}, ML.fit_oof

    def one_round(*args, **params):
        asked.update(params)
        return fit(*args, **dict(params, maxIter=1))
    monkeypatch.setattr(ML, "fit_oof", one_round)
    out = Q.q_stacker(spark, str(tmp_path))
    assert asked == TR.STACKER_PARAMS and asked["maxIter"] == 100
    assert out.count() == 60


def test_linear_steps_scored_in_the_task_equal_the_models_own(spark):
    """Repeated keys, values like the background's, NaN and infinity; the order of every draw is the md5's."""
    import hashlib
    from cohortspark.operators import explain as EX
    df, X = _frame(spark, n=30, d=4)
    model = ML.make_estimator("lr", 3).fit(df)

    class Whole:
        def transform(self, rows):
            return model.transform(rows)
    bg = [X[0].tolist(), X[1].tolist(), [0.0] * 4]
    odd = [(i, Vectors.dense(v)) for i, v in enumerate(
        [X[0].tolist(), [math.nan, 1.0, 0.0, 2.0], [math.inf, 0.0, 1.0, 0.0], [1.0, -math.inf, 0.0, 0.0], [0.0] * 4])]
    rows = df.select("sample_id", "features").unionByName(spark.createDataFrame(odd, df.select("sample_id", "features").schema))

    def values(m):
        return {(r["sample_id"], r["feature"], r["class"]): r["phi"]
                for r in EX.sampled_shapley(m, rows, bg, ["0", "1", "2"], n_perm=2).collect()}
    got, want = values(model), values(Whole())
    assert len(got) == 30 * 4 * 3 and got.keys() == want.keys()
    for k, v in want.items():
        assert got[k] == pytest.approx(v, abs=1e-12, nan_ok=True), k
    plan = EX.sampled_shapley(model, rows, bg, ["0", "1", "2"], n_perm=2)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("MapInArrow") == 1  # no synthetic row leaves its task
    prefixes, suffixes = [b"42-7-", "42-\u00e9-".encode(), b"42-" + b"x" * 70], [b"0-0-1", b"10-1-123"]
    digests = EX._digests(prefixes, suffixes)
    for i, j in itertools.product(range(3), range(2)):
        assert digests[i, j].astype(">u8").tobytes() == hashlib.md5(prefixes[i] + suffixes[j]).digest()


def test_tree_walks_gather_leaves_by_matrix_products(spark):
    """Trees of uneven depth, with repeated features: the same values as the path records, from few array
    operations a leaf; outputs that are not shares of one whole keep the last one's own walk."""
    rng = np.random.default_rng(5)

    def grown(depth, value):
        nodes, todo = {}, [(0, 0, 1000)]
        while todo:
            nid, level, rows = todo.pop()
            split = level < depth and rows > 1 and (level < 2 or rng.random() < 0.85)
            cut = int(rng.integers(1, rows)) if split else 0
            nodes[nid] = {"leftChild": 2 * nid + 1 if split else -1, "rightChild": 2 * nid + 2, "rawCount": rows,
                          "featureIndex": int(rng.integers(5)), "leftCategoriesOrThreshold": [float(rng.normal())],
                          "impurityStats": value(), "prediction": float(rng.normal())}
            todo += [(2 * nid + 1, level + 1, cut), (2 * nid + 2, level + 1, rows - cut)] if split else []
        return nodes
    X = rng.normal(size=(1500, 5))  # two blocks
    X[0, 0], X[1, 1], X[2, 2] = np.nan, np.inf, -np.inf
    shares, loose = (lambda: rng.random(3).tolist()), (lambda: [0.0] * 3 if rng.random() < 0.3 else rng.random(3).tolist())
    for kind, value, walked in (("rf", shares, 2), ("rf", loose, 3), ("gbt", shares, 1)):
        trees = {t: grown(8, value) for t in range(3)}
        weights = [1.0, 0.5, 0.25]
        recs = TS.path_records(trees, weights, kind)
        evaluator, base = TS._evaluator(trees, weights, kind)
        want = TS.shap_batch(X, recs, 5, evaluator.n_out)
        assert isinstance(evaluator, TS.TreeWalks) and evaluator.walked == walked
        assert np.abs(evaluator.attributions(X) - want[:, evaluator.touched, :]).max() < 1e-12
        assert np.allclose(base, TS.expected_value(recs), atol=1e-12)
        low = TS.TreeWalks(trees := {0: grown(2, value), 1: grown(3, value)}, weights, kind)
        want = TS.shap_batch(X[:1], TS.path_records(trees, weights, kind), 5, low.n_out)[:, low.touched, :]
        for _ in range(2):  # a single row's arrays are as small as a leaf's, which a walk leaves as they are
            assert np.abs(low.attributions(X[:1]) - want).max() < 1e-12
