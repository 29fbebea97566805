"""Principal components on the assembled vectors.

Centring is explicit (Spark's PCA does not centre); the d x d covariance is
formed by a distributed tree aggregation, so this route is bounded by the
feature count (guarded), not by the sample count.  Signs are fixed so that
the largest-magnitude loading of each component is positive.
"""

from __future__ import annotations

import numpy as np
from pyspark.ml.feature import PCA, StandardScaler
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import materialize, spread

MAX_PCA_FEATURES = 4000


def component_cap(k: int | None, n_samples: int, n_features: int) -> int:
    if k is None:
        return 0
    return int(min(int(k), n_samples, n_features))


def fit_pca(frame: DataFrame, k: int, n_features: int, features_col: str = "features"):
    """Returns ``(scaler_model, pca_model, signs, explained_variance_ratio)``."""
    if n_features > MAX_PCA_FEATURES:
        raise ValueError("covariance PCA is limited to a bounded feature count")
    scaler = StandardScaler(inputCol=features_col, outputCol="_centred", withMean=True, withStd=False) \
        .fit(frame)
    centred = scaler.transform(frame)
    model = PCA(k=k, inputCol="_centred", outputCol="_scores").fit(centred)
    pc = model.pc.toArray()  # d x k, bounded by the feature guard
    idx = np.abs(pc).argmax(axis=0)
    signs = np.where(pc[idx, np.arange(pc.shape[1])] < 0, -1.0, 1.0)
    return scaler, model, signs, model.explainedVariance.toArray()


def apply_pca(frame: DataFrame, scaler, model, signs, modality: str, key: str = "sample_id",
              features_col: str = "features", long: bool = True) -> DataFrame:
    """Scores per sample; long ``(key, component, score)`` or a vector column."""
    x = model.transform(scaler.transform(frame))
    sg = F.array(*[F.lit(float(s)) for s in signs])
    arr = F.zip_with(vector_to_array(F.col("_scores")), sg, lambda a, b: a * b)
    if not long:
        return x.select(key, array_to_vector(arr).alias("pca_features"))
    return x.select(key, F.posexplode(arr).alias("i", "score")).select(
        key, F.format_string(f"{modality}_PCA_PC%d", F.col("i") + 1).alias("component"), "score")


def loadings(spark, model, signs, dictionary_rows: list[str], modality: str) -> DataFrame:
    pc = model.pc.toArray() * signs
    rows = [(f"{modality}_PCA_PC{j + 1}", f, float(pc[i, j]))
            for j in range(pc.shape[1]) for i, f in enumerate(dictionary_rows)]
    return spark.createDataFrame(rows, "component string, feature string, loading double")


# ---- randomized PCA for wide, sparse modalities ------------------------------------
#
# Halko, Martinsson & Tropp (2011), "Finding structure with randomness":
# range finder with power iterations on the centred matrix, never forming a
# d x d covariance or an n x n Gram matrix.  Samples stay distributed; the
# driver holds only d x l and l x l arrays (l = k + oversampling), which are
# bounded by features x components.

def sample_entries(long_pos: DataFrame, key: str = "sample_id", samples: DataFrame | None = None) -> DataFrame:
    """``(key, grp, _i array<int>, _v array<double>)``: one row per sample with its non-zero cells
    (bounded by the dictionary size).  ``samples`` (key, grp) also names those without any cell;
    without it every sample is of group 0."""
    cells = long_pos.groupBy(key).agg(F.collect_list(F.col("pos").cast("int")).alias("_i"),
                                      F.collect_list(F.col("value").cast("double")).alias("_v"))
    if samples is None:
        return cells.select(key, F.lit(0).alias("grp"), "_i", "_v")
    return samples.select(key, "grp").join(cells, key, "left").select(
        key, "grp", F.coalesce("_i", F.array().cast("array<int>")).alias("_i"),
        F.coalesce("_v", F.array().cast("array<double>")).alias("_v"))


def _project(entries: DataFrame, M: np.ndarray, offset: np.ndarray, key: str, out: str) -> DataFrame:
    """``(key, grp, out)``: per sample ``x_s @ M + offset[grp]`` (M broadcast, d x l)."""
    bM = entries.sparkSession.sparkContext.broadcast((M, offset))

    def run(batches):
        import pandas as pd
        Mv, off = bM.value
        for pdf in batches:
            ys = []
            for g, ii, vv in zip(pdf["grp"], pdf["_i"], pdf["_v"]):
                ii = np.asarray(ii, dtype=np.int64)
                ys.append((np.asarray(vv, dtype=float) @ Mv[ii] if len(ii) else 0.0) + off[g])
            yield pd.DataFrame({key: pdf[key], "grp": pdf["grp"], out: ys})
    kt = entries.schema[key].dataType.simpleString()
    return entries.mapInPandas(run, f"{key} {kt}, grp int, {out} array<double>")


def _xt_y(entries_y: DataFrame, d: int, l: int, ycol: str) -> np.ndarray:
    """``X^T Y`` (d x l): per-partition dense partials, summed by feature
    position; the result is bounded by d x l."""
    def run(batches):
        import pandas as pd
        acc = np.zeros((d, l))
        for pdf in batches:
            for ii, vv, y in zip(pdf["_i"], pdf["_v"], pdf[ycol]):
                if len(ii):
                    acc[np.asarray(ii, dtype=np.int64)] += np.outer(np.asarray(vv, dtype=float), np.asarray(y))
        rows = np.nonzero(np.any(acc != 0, axis=1))[0]
        if len(rows):
            yield pd.DataFrame({"pos": rows.astype(np.int32), "part": list(acc[rows])})
    parts = entries_y.mapInPandas(run, "pos int, part array<double>")
    summed = parts.select("pos", F.posexplode("part").alias("j", "v")).groupBy("pos", "j").agg(F.sum("v").alias("v"))
    out = np.zeros((d, l))
    for r in summed.collect():  # d x l values: bounded by features x components
        out[r["pos"], r["j"]] = r["v"]
    return out


def _gram(y: DataFrame, l: int, ycol: str) -> np.ndarray:
    """``Y^T Y``; the tasks' partials are summed by Spark, so l x l values reach the driver."""
    def run(batches):
        import pandas as pd
        acc = np.zeros((l, l))
        for pdf in batches:
            Y = np.vstack(pdf[ycol].to_numpy()) if len(pdf) else np.zeros((0, l))
            acc += Y.T @ Y
        yield pd.DataFrame({"g": [acc.ravel()]})
    parts = y.select(ycol).mapInPandas(run, "g array<double>")
    out = np.zeros(l * l)
    for r in parts.select(F.posexplode("g").alias("at", "v")).groupBy("at").agg(F.sum("v").alias("v")).collect():
        out[r["at"]] = r["v"]
    return out.reshape(l, l)


def _orthonormalise(y: DataFrame, l: int, key: str, ycol: str) -> DataFrame:
    """Cholesky QR: ``Q = Y R^-1`` with ``R^T R = Y^T Y`` (l x l on the driver)."""
    G = _gram(y, l, ycol)
    R = np.linalg.cholesky(G + 1e-12 * max(np.trace(G), 1e-300) / l * np.eye(l)).T
    bR = y.sparkSession.sparkContext.broadcast(np.linalg.inv(R))

    def run(batches):
        import pandas as pd
        Ri = bR.value
        for pdf in batches:
            Y = np.vstack(pdf[ycol].to_numpy()) if len(pdf) else np.zeros((0, l))
            yield pd.DataFrame({key: pdf[key], "grp": pdf["grp"], ycol: list(Y @ Ri)})
    kt = y.schema[key].dataType.simpleString()
    return y.mapInPandas(run, f"{key} {kt}, grp int, {ycol} array<double>")


def randomized_pca(long_pos: DataFrame, d: int, k: int, n_samples: int, oversample: int = 10,
                   power_iters: int = 2, seed: int = 42, key: str = "sample_id",
                   samples: DataFrame | None = None, bases: np.ndarray | None = None):
    """Top-``k`` principal components of the centred matrix; any width.

    A sample reads ``bases[grp]`` (groups x d; zero without it) plus its cells, so rows that are
    dense only by a few shared patterns stay sparse.  ``samples`` (key, grp) names all rows.
    Returns ``(components d x k, explained_variance k, mean d, total_variance)``;
    signs are fixed so the largest-magnitude loading is positive.
    """
    l = min(k + oversample, d, n_samples)
    bases = np.zeros((1, d)) if bases is None else np.asarray(bases, float)
    entries = materialize(spread(sample_entries(long_pos, key, samples), n_samples, key, width=l), "pca_entries")
    size = np.zeros(len(bases))
    if samples is None:
        size[0] = n_samples
    else:
        for r in entries.groupBy("grp").count().collect():
            size[r["grp"]] = r["count"]
    cells = entries.select("grp", F.explode(F.arrays_zip("_i", "_v")).alias("c")).select(
        "grp", F.col("c._i").alias("pos"), F.col("c._v").alias("value"))
    own = np.zeros((len(bases), d))
    for r in cells.groupBy("grp", "pos").agg(F.sum("value").alias("s")).collect():  # groups x d values
        own[r["grp"], r["pos"]] = r["s"]
    mu = (own.sum(axis=0) + size @ bases) / n_samples
    sq = cells.agg(F.sum(F.col("value") * F.col("value"))).first()[0] or 0.0
    sq += 2 * float((own * bases).sum()) + float(size @ (bases * bases).sum(axis=1))
    total_var = (sq - n_samples * float(mu @ mu)) / max(n_samples - 1, 1)
    shift = bases - mu

    def xt_q(q: DataFrame) -> np.ndarray:
        """Xc^T Q: that of the cells, and of every group's shift."""
        ones = np.zeros((len(bases), l))
        for r in q.select("grp", F.posexplode("_y").alias("j", "v")).groupBy("grp", "j").agg(F.sum("v").alias("s")).collect():
            ones[r["grp"], r["j"]] = r["s"]
        return _xt_y(entries.drop("grp").join(q, key), d, l, "_y") + shift.T @ ones

    Z = np.random.default_rng(seed).standard_normal((d, l))
    for it in range(power_iters + 1):
        q = materialize(_orthonormalise(_project(entries, Z, shift @ Z, key, "_y"), l, key, "_y"), "pca_q")
        B = xt_q(q)
        if it < power_iters:
            Z, _ = np.linalg.qr(B)
    _, s, vt = np.linalg.svd(B.T, full_matrices=False)  # l x d = Q^T Xc
    comps = vt[:k].T
    idx = np.abs(comps).argmax(axis=0)
    signs = np.where(comps[idx, np.arange(comps.shape[1])] < 0, -1.0, 1.0)
    return comps * signs, (s[:k] ** 2) / max(n_samples - 1, 1), mu, total_var


def randomized_scores(long_pos: DataFrame, comps: np.ndarray, mu: np.ndarray, modality: str,
                      key: str = "sample_id", samples: DataFrame | None = None, bases: np.ndarray | None = None) -> DataFrame:
    """Long scores ``(key, component, score)`` = (x - mu) @ components."""
    shift = (np.zeros((1, len(mu))) if bases is None else bases) - mu
    y = _project(sample_entries(long_pos, key, samples), comps, shift @ comps, key, "_s")
    return y.select(key, F.posexplode("_s").alias("i", "score")).select(
        key, F.format_string(f"{modality}_PCA_PC%d", F.col("i") + 1).alias("component"), "score")


def pca_long(long_pos: DataFrame, d: int, k: int, n_samples: int, modality: str,
             key: str = "sample_id", method: str = "randomized") -> tuple[DataFrame, np.ndarray]:
    """Scores ``(key, component, score)`` and explained-variance ratios: by the range finder
    (any width), or with ``method='exact'`` by the covariance (d <= 4,000)."""
    from .reshape import assemble_dense
    if method == "exact":
        vec = assemble_dense(long_pos, d, 0.0, key)
        scaler, model, signs, ev = fit_pca(vec, k, d)
        return apply_pca(vec, scaler, model, signs, modality, key), ev
    comps, var, mu, total = randomized_pca(long_pos, d, k, n_samples, key=key)
    return randomized_scores(long_pos, comps, mu, modality, key), var / total
