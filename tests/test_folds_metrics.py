import itertools
import math
import random

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from cohortspark.operators import folds as FO
from cohortspark.operators import metrics as M
from cohortspark.operators.ordered import running_totals_before


def _samples(spark, n=500):
    rng = random.Random(3)
    return spark.createDataFrame([(i, rng.choice("ABC" if i % 7 else "A")) for i in range(n)],
                                 "sample_id long, label string")


def test_folds_equal_global_window_and_balance(spark):
    df = _samples(spark)
    got = {r[0]: r[1] for r in FO.stratified_folds(df, k=5).select("sample_id", "fold").collect()}
    h = FO.hash_order("sample_id", 42)
    w = Window.partitionBy("label").orderBy(h, "sample_id")
    ref = {r[0]: r[1] for r in df.select("sample_id", ((F.row_number().over(w) - 1) % 5).alias("f")).collect()}
    assert got == ref
    again = {r[0]: r[1] for r in FO.stratified_folds(df.repartition(7), k=5).select("sample_id", "fold").collect()}
    assert again == got
    counts = FO.stratified_folds(df, k=5).groupBy("label", "fold").count().collect()
    by = {}
    for r in counts:
        by.setdefault(r["label"], []).append(r["count"])
    assert all(max(v) - min(v) <= 1 for v in by.values())


def test_holdout_fraction(spark):
    df = _samples(spark)
    h = FO.stratified_holdout(df, fraction=0.2)
    for r in h.groupBy("label").agg(F.count("*").alias("n"), F.count_if("is_holdout").alias("h")).collect():
        assert r["h"] == round(0.2 * r["n"] + 1e-9) or abs(r["h"] - 0.2 * r["n"]) <= 0.5


def test_running_totals_match_window(spark):
    rng = random.Random(5)
    rows = [(g, float(rng.randint(0, 40)) / 4, rng.randint(0, 3)) for g in range(3) for _ in range(200)]
    df = spark.createDataFrame(rows, "g int, s double, v long").groupBy("g", "s").agg(F.sum("v").alias("v"))
    got = {(r["g"], r["s"]): r["v_before"] for r in running_totals_before(df, ["g"], "s", ["v"], 8).collect()}
    w = Window.partitionBy("g").orderBy("s").rowsBetween(Window.unboundedPreceding, -1)
    ref = {(r["g"], r["s"]): r["b"] for r in df.select("g", "s", F.coalesce(F.sum("v").over(w), F.lit(0)).alias("b")).collect()}
    assert got == ref


def _auc_bruteforce(rows):
    pos = [s for y, s in rows if y == 1]
    neg = [s for y, s in rows if y == 0]
    tot = sum(1.0 if p > n else 0.5 if p == n else 0.0 for p, n in itertools.product(pos, neg))
    return tot / (len(pos) * len(neg))


def test_auc_exact_with_ties_and_monotone_invariance(spark):
    rng = random.Random(11)
    rows = [(rng.randint(0, 1), float(rng.randint(0, 9))) for _ in range(300)]
    df = spark.createDataFrame(rows, "label int, score double")
    auc = M.roc_auc(df, (), "label", "score", n_buckets=4).first()["auc"]
    assert auc == pytest.approx(_auc_bruteforce(rows))
    auc2 = M.roc_auc(df.withColumn("score", F.exp("score")), (), "label", "score").first()["auc"]
    assert auc2 == pytest.approx(auc)


def test_confusion_and_report(spark):
    preds = spark.createDataFrame([("a", "a"), ("a", "b"), ("b", "b"), ("c", "b")], "label string, pred string")
    conf = M.confusion_matrix(preds, ["a", "b", "c"])
    assert conf.count() == 9
    cells = {(r["label"], r["pred"]): r["n"] for r in conf.collect()}
    assert cells[("c", "c")] == 0 and cells[("a", "b")] == 1
    rep = {r["class"]: r for r in M.classification_report(conf).collect()}
    assert rep["b"]["precision"] == pytest.approx(1 / 3) and rep["b"]["recall"] == 1.0
    assert rep["c"]["f1"] == 0.0
    assert rep["accuracy"]["f1"] == 0.5 and rep["accuracy"]["support"] == 4
    wf = M.f1_weighted(conf).first()[0]
    f1a, f1b = 2 * 1 * 0.5 / 1.5, 2 * (1 / 3) / (4 / 3)
    assert wf == pytest.approx((2 * f1a + 1 * f1b + 0) / 4)
    assert M.accuracy(preds).first()[0] == 0.5


def test_log_loss_and_binary_f1(spark):
    probs = spark.createDataFrame([(1, "a", "a", 0.8), (1, "a", "b", 0.2), (2, "b", "a", 0.0), (2, "b", "b", 1.0)],
                                  "sample_id int, label string, class string, prob double")
    ll = M.log_loss(probs).first()[0]
    assert ll == pytest.approx(-math.log(0.8) / 2, abs=1e-12)
    b = spark.createDataFrame([(1, 1), (1, 0), (0, 1), (0, 0)], "label int, pred int")
    assert M.f1_binary(b).first()[0] == pytest.approx(0.5)


def test_exact_percentile_matches_builtin(spark):
    from cohortspark.operators.ordered import exact_percentile
    rng = random.Random(9)
    rows = [(g, float(rng.randint(0, 30)), rng.randint(1, 4)) for g in range(4) for _ in range(60)]
    df = spark.createDataFrame(rows, "g int, v double, w long").groupBy("g", "v").agg(F.sum("w").alias("w"))
    for q in (0.05, 0.5, 0.9):
        got = {r[0]: r[1] for r in exact_percentile(df, ["g"], "v", "w", q, n_buckets=4).collect()}
        ref = {r[0]: r[1] for r in df.groupBy("g").agg(F.percentile("v", q, F.col("w"))).collect()}
        for g in ref:
            assert got[g] == pytest.approx(ref[g])
    one = exact_percentile(df, [], "v", "w", 0.5).first()[0]
    assert one == pytest.approx(df.agg(F.percentile("v", 0.5, F.col("w"))).first()[0])
