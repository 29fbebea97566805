import numpy as np
import pytest
from pyspark.sql import functions as F

from cohortspark.operators import joins as J
from cohortspark.operators import reshape as R
from cohortspark.operators import setops as U
from cohortspark.operators import stats as ST
from cohortspark.operators import topk as T


def test_pivot_duplicates_and_null_cell(spark):
    df = spark.createDataFrame([("a", "x", 1.0), ("a", "x", 3.0), ("b", "y", None), ("c", "z", 0.0),
                                (None, "x", 9.0)], "sample_id string, feature string, value double")
    cells = R.cell_mean(df)
    feats = R.feature_values(cells)
    assert feats == ["x", "z"]
    wide = {r["sample_id"]: r.asDict() for r in R.pivot_mean(cells, feats).collect()}
    assert set(wide) == {"a", "c"}
    assert wide["a"]["x"] == 2.0 and wide["a"]["z"] == 0.0
    assert wide["c"]["x"] == 0.0 and wide["c"]["z"] == 0.0


def test_quantile_variance_fixture(spark):
    cells = spark.createDataFrame([("s%d" % i, "f", v) for i, v in enumerate([1.0, 2.0, 4.0, 8.0])],
                                  "sample_id string, feature string, value double")
    m = ST.feature_moments(cells, None, "null").first()
    assert m["var_samp"] == pytest.approx(9.583333333, rel=1e-9)
    assert m["std_pop"] == pytest.approx(2.680951323, rel=1e-9)
    assert ST.fit_median(cells).first()["median"] == 3.0
    assert cells.agg(F.percentile("value", 0.05)).first()[0] == pytest.approx(1.15)


def test_implicit_zero_statistics_equal_dense(spark):
    rng = np.random.default_rng(1)
    n, d = 40, 6
    dense = rng.integers(0, 5, size=(n, d)).astype(float)
    dense[rng.random((n, d)) < 0.5] = 0.0
    rows = [(i, f"f{j}", float(dense[i, j])) for i in range(n) for j in range(d) if dense[i, j] != 0]
    cells = spark.createDataFrame(rows, "sample_id long, feature string, value double")
    mom = {r["feature"]: r for r in ST.feature_moments(cells, n, "zero").collect()}
    med = {r["feature"]: r["median"] for r in ST.fit_median(cells, n, "zero").collect()}
    for j in range(d):
        col = dense[:, j]
        if (col != 0).sum() == 0:
            continue
        r = mom[f"f{j}"]
        assert r["mean"] == pytest.approx(col.mean())
        assert r["var_samp"] == pytest.approx(col.var(ddof=1))
        assert r["std_pop"] == pytest.approx(col.std())
        assert med[f"f{j}"] == pytest.approx(np.median(col))


def test_low_variance_and_prevalence(spark):
    rows = [(i, "flat", 1.0) for i in range(10)] + [(i, "wide", float(i)) for i in range(10)] + \
           [(i, "mid", float(i % 2)) for i in range(10)]
    cells = spark.createDataFrame(rows, "sample_id long, feature string, value double")
    kept = {r[0] for r in ST.filter_low_variance(cells, 10, 0.05).select("feature").distinct().collect()}
    assert kept == {"wide", "mid"}
    pres = spark.createDataFrame([(i, "common", 1) for i in range(100)] + [(0, "rare", 1)],
                                 "sample_id long, feature string, value int")
    kept = {r[0] for r in ST.filter_prevalence(pres, 2.0).select("feature").distinct().collect()}
    assert kept == {"common"}


def test_union_common_and_align(spark):
    a = spark.createDataFrame([(1, 2)], "b int, a int")
    b = spark.createDataFrame([(3, 4, 5)], "a int, b int, c int")
    assert U.union_common([a, b]).columns == ["b", "a"]
    w = spark.createDataFrame([(1, None), (2, 1.0)], "k int, x double")
    out = R.align_wide(w, "k", ["x", "y"]).orderBy("k").collect()
    assert [r["x"] for r in out] == [None, 1.0] and [r["y"] for r in out] == [0.0, 0.0]


def test_top1_tie_and_argmax(spark):
    df = spark.createDataFrame([("g", "x", 1.0), ("g", "y", 2.0), ("g", "z", 2.0)],
                               "group string, feature string, importance double")
    assert [r["feature"] for r in T.top_per_group(df, "group", "importance", 1).collect()] == ["y"]
    probs = spark.createDataFrame([(1, "B", 0.4), (1, "A", 0.4), (1, "C", 0.2)],
                                  "sample_id int, class string, prob double")
    assert T.argmax_class(probs).first()["pred"] == "A"


def test_overlapping_cohort(spark):
    df = spark.createDataFrame([("first", 0, "s", "f", 1.0), ("last", 4, "s", "f", 3.0)],
                               "cohort string, ordinal int, sample_id string, feature string, value double")
    assert R.cell_mean(df).first()["value"] == 2.0
    assert J.resolve_cohort(df).first()["label"] == "last"


def test_stack_outer_union_of_ids(spark):
    a = spark.createDataFrame([(1, "pred_a_X", 0.7), (2, "pred_a_X", 0.1)], "sample_id int, column string, prob double")
    b = spark.createDataFrame([(2, "pred_b_X", 0.5), (3, "pred_b_X", 0.9)], "sample_id int, column string, prob double")
    st = J.stack_outer(a.unionByName(b), ["pred_a_X", "pred_b_X"])
    assert {r[0] for r in st.select("sample_id").collect()} == {1, 2, 3}
    filled = {r["sample_id"]: r for r in J.fill_uninformative(st, ["pred_a_X", "pred_b_X"], 4).collect()}
    assert filled[3]["pred_a_X"] == 0.25 and filled[1]["pred_b_X"] == 0.25
    with pytest.raises(ValueError):
        J.stack_outer(a.unionByName(a), ["pred_a_X"], on_duplicate="error")


def test_assemble_dense(spark):
    lp = spark.createDataFrame([(1, 0, 2.0), (1, 2, 3.0), (2, 1, 1.0)], "sample_id int, pos int, value double")
    v = {r[0]: r[1].toArray().tolist() for r in R.assemble_dense(lp, 3, [9.0, 8.0, 7.0]).collect()}
    assert v[1] == [2.0, 8.0, 3.0] and v[2] == [9.0, 1.0, 7.0]


def test_union_all_columns_and_samples(spark):
    a = spark.createDataFrame([(1, 2.0)], "sample_id int, z double")
    b = spark.createDataFrame([(2, 3.0)], "sample_id int, a double")
    u = U.union_all_columns([a, b], "sample_id")
    assert u.columns == ["sample_id", "a", "z"]
    rows = {r["sample_id"]: r for r in u.collect()}
    assert rows[1]["a"] is None and rows[2]["z"] is None
    assert sorted(r[0] for r in U.all_samples([a, b, a]).collect()) == [1, 2]
    long = spark.createDataFrame([("c1", 1, "f", 1.0), ("c2", 2, "f", 1.0), ("c1", 1, "g", 1.0)],
                                 "cohort string, sample_id int, feature string, value double")
    assert {r[0] for r in U.union_common_long(long, 2).select("feature").distinct().collect()} == {"f"}


def test_presence_and_crosstab(spark):
    ev = spark.createDataFrame([(1, "x"), (1, "x"), (2, "y"), (None, "x")], "sample_id int, feature string")
    p = R.presence(ev).collect()
    assert sorted((r[0], r[1], r[2]) for r in p) == [(1, "x", 1), (2, "y", 1)]
    w = {r["sample_id"]: r for r in R.pivot_presence(ev, ["x", "y"]).collect()}
    assert (w[1]["x"], w[1]["y"], w[2]["x"]) == (1, 0, 0)
    ct = {(r[0], r[1]): r[2] for r in R.crosstab_long(ev.where("sample_id is not null"), "sample_id", "feature").collect()}
    assert ct[(1, "x")] == 2


def test_sparse_assembly_equals_dense(spark):
    lp = spark.createDataFrame([(1, 0, 2.0), (1, 2, 3.0), (2, 1, 1.0), (2, 3, 0.0)], "sample_id int, pos int, value double")
    dense = {r[0]: r[1].toArray().tolist() for r in R.assemble_dense(lp, 4, 0.0).collect()}
    sparse = {r[0]: r[1] for r in R.assemble_sparse(lp, 4).collect()}
    for k in dense:
        assert sparse[k].toArray().tolist() == dense[k]
        assert sparse[k].size == 4
    assert len(sparse[1].indices) == 2


@pytest.mark.parametrize("scope", ["file", "pooled"])
def test_build_modality_features_matches_dense(spark, scope):
    from cohortspark.plans.features import build_modality_features
    rng = np.random.default_rng(11)
    rows, dense = [], {}
    for cat in ("normal", "cancer"):
        for s in range(15):
            for f in ("a", "b", "c", "d"):
                if rng.random() < 0.7:
                    v = float(rng.integers(1, 20)) * (3 if f == "d" else 1)
                    rows.append((cat, s, f, v))
                    dense[(cat, s, f)] = v
    df = spark.createDataFrame(rows, "category string, sample_id long, feature string, value double")
    out = build_modality_features(df, "m", log=True, var_q=None, scale=True, scope=scope)
    got = {(r["category"], r["sample_id"], r["feature"]): (r["value"], r["zero_value"])
           for r in out.where("feature IS NOT NULL").collect()}
    groups = [("normal",), ("cancer",)] if scope == "file" else [("normal", "cancer")]
    for cats in groups:
        samples = sorted({(c, s) for (c, s, _) in dense if c in cats})
        for f in ("a", "b", "c", "d"):
            col = np.array([np.log2(dense.get((c, s, f), 0.0) + 1) for c, s in samples])
            mu, sd = col.mean(), col.std()
            sd = sd if sd > 0 else 1.0
            for (c, s), x in zip(samples, col):
                if (c, s, f) in dense:
                    v, z = got[(c, s, "m_" + f)]
                    assert v == pytest.approx((x - mu) / sd)
                    assert z == pytest.approx(-mu / sd)


def test_low_variance_branches(spark):
    same = spark.createDataFrame([(i, f, float(i % 2)) for i in range(6) for f in ("x", "y")],
                                 "sample_id long, feature string, value double")
    # all variances equal -> keep variance > 0 (both kept)
    assert ST.filter_low_variance(same, 6, 0.05).select("feature").distinct().count() == 2
    flat = spark.createDataFrame([(i, f, 1.0) for i in range(6) for f in ("x", "y")],
                                 "sample_id long, feature string, value double")
    # all variances equal and zero -> nothing kept
    assert ST.filter_low_variance(flat, 6, 0.05, absent="null").count() == 0
    one = same.where("feature = 'x'")
    assert ST.filter_low_variance(one, 6, 0.05).count() == one.count()  # one feature: skipped
    assert ST.filter_low_variance(same, 6, None).count() == same.count()  # q None: skipped


def test_harmonise_binary_layouts(spark):
    a = spark.createDataFrame([(1, 0.8)], "sample_id int, pred_gene_binary double")
    r = J.harmonise_binary(a, "gene").first()
    assert (r["pred_gene_normal_prob"], r["pred_gene_cancer_prob"]) == (0.8, pytest.approx(0.2))
    b = spark.createDataFrame([(1, 0.3, 0.7)], "sample_id int, pred_0 double, pred_1 double")
    r = J.harmonise_binary(b, "cnv").first()
    assert (r["pred_cnv_normal_prob"], r["pred_cnv_cancer_prob"]) == (0.7, 0.3)
    assert J.harmonise_binary(spark.createDataFrame([(1, 0.5)], "sample_id int, other double"), "x") is None
    with pytest.raises(ValueError):
        J.require_binary(spark.createDataFrame([(1,), (2,), (3,)], "label int"))


def test_exact_percentile_edges(spark):
    from cohortspark.operators.ordered import exact_percentile
    df = spark.createDataFrame([("a", 5.0, 3), ("b", 1.0, 1), ("b", 9.0, 1)], "g string, v double, w long")
    for q, ref in ((0.0, {"a": 5.0, "b": 1.0}), (1.0, {"a": 5.0, "b": 9.0}), (0.5, {"a": 5.0, "b": 5.0})):
        got = {r[0]: r[1] for r in exact_percentile(df, ["g"], "v", "w", q).collect()}
        assert got == ref


def test_stack_outer_join_multiplies_duplicates(spark):
    a = spark.createDataFrame([(1, 0.1), (1, 0.2)], "sample_id int, pred_a_X double")
    b = spark.createDataFrame([(1, 0.5), (2, 0.6)], "sample_id int, pred_b_X double")
    out = J.stack_outer_join([a, b])
    assert out.where("sample_id = 1").count() == 2 and out.count() == 3


def test_median_impute_fit_report(spark):
    cells = spark.createDataFrame([(1, "a", 1.0), (2, "a", None), (3, "a", 5.0), (1, "b", None), (2, "b", None)],
                                  "sample_id int, feature string, value double")
    params = ST.fit_median(cells)
    assert {r["feature"]: r["median"] for r in params.collect()} == {"a": 3.0}
    rep = ST.median_fit_report(cells, params).collect()
    assert [(r["feature"], r["status"].startswith("dropped")) for r in rep] == [("b", True)]
    filled = {(r["sample_id"], r["feature"]): r["value"] for r in ST.apply_median(cells, params).collect()}
    assert filled == {(1, "a"): 1.0, (2, "a"): 3.0, (3, "a"): 5.0}


def test_expert_rollup_rule(spark):
    from cohortspark.operators import explain as EX
    two = spark.createDataFrame([("g1_expr", 1.0), ("t1_mut", 2.0)], "feature string, importance double")
    one = spark.createDataFrame([("g1_expr", 1.0), ("g2_expr", 2.0)], "feature string, importance double")
    none = spark.createDataFrame([("g1", 1.0), ("g2", 2.0)], "feature string, importance double")
    assert EX.expert_rollup_applies(two) and not EX.expert_rollup_applies(one)
    assert not EX.expert_rollup_applies(none)
    rolled = [(r[0], r[1]) for r in EX.importance_by_modality(two).collect()]
    assert rolled == [("mut", 2.0), ("expr", 1.0)]


def test_checked_broadcast_respects_bound(spark):
    small = spark.range(5).withColumnRenamed("id", "k")
    big = spark.range(50).withColumnRenamed("id", "k")
    j_small = spark.range(100).withColumnRenamed("id", "k").join(J.checked_broadcast(small, 10), "k")
    assert "broadcast" in j_small._jdf.queryExecution().analyzed().toString().lower() or \
        "ResolvedHint" in j_small._jdf.queryExecution().analyzed().toString()
    hinted = J.checked_broadcast(big, 10)
    assert "ResolvedHint" not in hinted._jdf.queryExecution().analyzed().toString()
    codes = J.registry_ordinals(spark.createDataFrame([("b",), ("a",), ("b",)], "cohort string"))
    assert sorted((r["cohort"], r["ordinal"]) for r in codes.collect()) == [("a", 0), ("b", 1), ("b", 1)]
