import shutil

import numpy as np
import pytest
from pyspark.sql import functions as F

from cohortspark.plans import chain as C


def _data(spark, n=60, d=8, seed=0):
    rng = np.random.default_rng(seed)
    x = np.where(rng.random((n, d)) < 0.5, rng.normal(2, 1, (n, d)), 0.0)
    y = (x[:, 0] + x[:, 1] > 2).astype(int) + (x[:, 2] > 2)
    cells = [(i, f"f{j}", float(x[i, j])) for i in range(n) for j in range(d) if x[i, j]]
    cells += [(0, "f9", None), (None, "f1", 1.0), (1, None, 1.0)]
    return (spark.createDataFrame(cells, "sample_id long, feature string, value double").repartition(4),
            spark.createDataFrame([(i, f"c{y[i]}") for i in range(n)], "sample_id long, label string"), x)


def _rows(df):
    return {(r["sample_id"], r["class"]): r["prob"] for r in df.collect()}


@pytest.mark.parametrize("kind,components,params", [("lr", None, {}), ("lr", 3, {}), ("rf", 3, {"numTrees": 5}),
                                                    ("gbt", None, {"maxIter": 2})])
def test_saved_chain_scores_like_the_fitted_one(spark, tmp_path, kind, components, params):
    cells, labels, _ = _data(spark)
    chain = C.fit_chain(cells, labels, kind, components, **params)
    path = str(tmp_path / "chain")
    C.save_chain(chain, path)
    new = spark.createDataFrame([(900, "f0", 1.0), (900, "f0", 3.0), (901, "unknown", 5.0), (902, "f1", None)],
                                "sample_id long, feature string, value double")
    spine = spark.createDataFrame([(i,) for i in (900, 901, 902, 903, 903)], "sample_id long")
    want, got = _rows(chain.score(new, spine)), _rows(C.load_chain(spark, path).score(new, spine))
    assert want.keys() == got.keys() and len(got) == 12
    assert all(got[k] == pytest.approx(want[k], abs=1e-12) for k in want)
    assert all(got[901, c] == pytest.approx(got[903, c], abs=1e-12) for c in ("c0", "c1", "c2"))
    fitted = _rows(C.load_chain(spark, path).score(cells, labels))
    again = _rows(chain.score(cells, labels))
    assert len(fitted) == 180 and all(fitted[k] == pytest.approx(again[k], abs=1e-12) for k in again)


def test_chain_features_match_numpy(spark):
    cells, labels, x = _data(spark)
    wide = np.column_stack([x, np.zeros(len(x))])  # f9: one cell without a value, no median
    std = wide.std(axis=0)
    z = (wide - wide.mean(axis=0)) / np.where(std == 0, 1, std)
    chain = C.fit_chain(cells, labels, "lr")
    got = {r["sample_id"]: r["features"].toArray() for r in chain.features(cells, labels).collect()}
    assert all(np.allclose(got[i], z[i]) for i in range(len(z)))
    chain = C.fit_chain(cells, labels, "lr", 9)
    got = np.array([r["features"].toArray() for r in chain.features(cells, labels).orderBy("sample_id").collect()])
    assert np.allclose(got @ got.T, z @ z.T, atol=1e-6)  # all components keep every distance


def test_torn_save_leaves_the_earlier_version(spark, tmp_path):
    cells, labels, _ = _data(spark, n=30)
    path = str(tmp_path / "chain")
    with pytest.raises(FileNotFoundError):
        C.load_chain(spark, path)
    first = C.fit_chain(cells, labels, "lr")
    C.save_chain(first, path)
    second = C.fit_chain(cells.withColumn("value", F.col("value") * 2), labels, "rf", numTrees=3)
    folder = C.save_chain(second, path)
    assert C.load_chain(spark, path).meta["kind"] == "rf"
    shutil.rmtree(f"{folder}/manifest")
    assert C.load_chain(spark, path).meta["kind"] == "lr"
    with pytest.raises(ValueError):
        C.fit_chain(cells, labels, "svm")
    with pytest.raises(ValueError):
        C.fit_chain(cells.limit(0), labels)
