"""Fitted transforms and model as one artefact: impute, scale, reduce, predict.

:func:`fit_chain` fits on long cells, :meth:`Chain.score` applies the chain to any
other cells, :func:`save_chain` / :func:`load_chain` keep it as files.  A saved
version is a folder of its own whose manifest is written last; loading takes the
newest version that has one, so a save that is cut off leaves the earlier version
in force and readers never see half of a new one.

Cells are ``(sample_id, feature, value)``.  A cell without a value (NULL) reads the
feature's median, or zero if none was ever seen; an absent cell reads zero;
repeated cells are averaged; features that were not fitted are left out; a sample
without any fitted feature is scored as all zero.  Rows without a key are left out.
"""

from __future__ import annotations

import json
import os
import time
import uuid
from dataclasses import dataclass

import numpy as np
from pyspark.ml.classification import (GBTClassificationModel, LogisticRegressionModel,
                                       RandomForestClassificationModel)
from pyspark.ml.functions import array_to_vector
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import ml as ML
from ..operators import reduce as RD
from ..operators import reshape as R
from ..operators import stats as ST
from ..operators.joins import MAX_CLASSES, checked_broadcast, class_codes
from ..operators.vectors import assemble_vectors
from ..session import materialize
from ..sources.paths import child_names, path_exists

MODEL_CLASSES = {"lr": LogisticRegressionModel, "rf": RandomForestClassificationModel, "gbt": GBTClassificationModel}


@dataclass
class Chain:
    """``params``: (pos, feature, median, mean, std); ``components``: d x k and ``centre``: d, or None;
    ``codes``: (label, code)."""

    params: DataFrame
    components: np.ndarray | None
    centre: np.ndarray | None
    model: object
    codes: DataFrame
    meta: dict

    def features(self, cells: DataFrame, samples: DataFrame) -> DataFrame:
        """``(sample_id, features)`` of every row of ``samples``."""
        spine = samples.select("sample_id").where(F.col("sample_id").isNotNull()).distinct()
        d = self.meta["d"]
        absent = np.zeros(d)  # what an absent cell becomes
        for r in self.params.select("pos", (-F.col("mean") / F.col("std")).alias("z")).collect():  # d values
            absent[r["pos"]] = r["z"]
        own = averaged(cells).join(self.params, "feature").join(spine, "sample_id", "left_semi").select(
            "sample_id", "pos", "mean", "std", F.coalesce("value", "median", F.lit(0.0)).alias("x"))
        if self.components is None:
            scaled = own.select("sample_id", "pos", ((F.col("x") - F.col("mean")) / F.col("std")).alias("value"))
            return assemble_vectors(scaled, d, fill=list(absent), samples=spine)
        beyond = own.where("x <> 0").select("sample_id", "pos", (F.col("x") / F.col("std")).alias("value"))
        scores = RD._project(RD.sample_entries(beyond, "sample_id", spine.withColumn("grp", F.lit(0))), self.components,
                             (absent - self.centre)[None, :] @ self.components, "sample_id", "_s")
        return scores.select("sample_id", array_to_vector("_s").alias("features"))

    def score(self, cells: DataFrame, samples: DataFrame) -> DataFrame:
        """``(sample_id, class, prob)`` of every row of ``samples``."""
        probs = ML.probabilities(self.model, self.features(cells, samples))
        return probs.join(checked_broadcast(self.codes, MAX_CLASSES), "code").select(
            "sample_id", F.col("label").alias("class"), "prob")


def averaged(cells: DataFrame) -> DataFrame:
    """One row per sample and feature; NULL if no row has a value."""
    return cells.where(F.col("sample_id").isNotNull() & F.col("feature").isNotNull()) \
        .groupBy("sample_id", "feature").agg(F.avg("value").alias("value"))


def fit_chain(cells: DataFrame, labels: DataFrame, kind: str = "lr", components: int | None = None, **params) -> Chain:
    """Medians, z-scores, components (none, if ``components`` is not given) and the model of kind
    ``kind``, in this order, each fitted on what the ones before it give for ``labels``
    (``sample_id, label``; every sample takes part, with or without cells)."""
    if kind not in MODEL_CLASSES:
        raise ValueError(f"unknown model kind {kind!r}")
    labels = materialize(labels.where(F.col("sample_id").isNotNull()).select("sample_id", "label"), "chain_labels")
    n = labels.select("sample_id").distinct().count()
    own = materialize(averaged(cells).join(labels.select("sample_id").distinct(), "sample_id", "left_semi"), "chain_cells")
    medians = ST.fit_median(own.where(F.col("value").isNotNull())).select("feature", "median")
    filled = own.join(medians, "feature", "left").select(
        "sample_id", "feature", F.coalesce("value", "median", F.lit(0.0)).alias("value"))
    fitted = R.feature_dictionary(own).join(ST.fit_scaler(filled, n), "feature").join(medians, "feature", "left")
    table = materialize(fitted.select("pos", "feature", "median", "mean", "std"), "chain_params")
    codes = materialize(class_codes(labels, "label"), "chain_codes")
    meta = {"kind": kind, "d": table.count(), "n": n, "n_classes": codes.count(), "components": None,
            "steps": ["median", "scale", *(["components"] if components else []), "model"]}
    if not meta["d"]:
        raise ValueError("no feature to fit on")
    chain = Chain(table, None, None, None, codes, meta)
    if components:
        k = meta["components"] = RD.component_cap(components, n, meta["d"])
        absent = np.zeros((1, meta["d"]))
        for r in table.collect():  # d rows
            absent[0, r["pos"]] = -r["mean"] / r["std"]
        beyond = filled.where("value <> 0").join(table, "feature").select(
            "sample_id", "pos", (F.col("value") / F.col("std")).alias("value"))
        spine = labels.select("sample_id").distinct().withColumn("grp", F.lit(0))
        chain.components, _, chain.centre, _ = RD.randomized_pca(beyond, meta["d"], k, n, samples=spine, bases=absent)
    rows = chain.features(own, labels).join(labels, "sample_id").join(
        checked_broadcast(codes, MAX_CLASSES), "label").withColumn("y", F.col("code").cast("double")).drop("code")
    chain.model = ML.make_estimator(kind, meta["n_classes"], **params).fit(materialize(rows, "chain_rows"))
    return chain


def save_chain(chain: Chain, path: str) -> str:
    """Write ``chain`` as the newest version below ``path``; returns the version's folder."""
    spark = chain.params.sparkSession
    folder = os.path.join(path, f"v-{uuid.uuid4().hex}")
    chain.params.write.parquet(os.path.join(folder, "params"))
    chain.codes.write.parquet(os.path.join(folder, "codes"))
    if chain.components is not None:  # features x components values
        rows = [(i, float(c), [float(v) for v in w]) for i, (c, w) in enumerate(zip(chain.centre, chain.components))]
        spark.createDataFrame(rows, "pos int, centre double, weights array<double>") \
            .write.parquet(os.path.join(folder, "components"))
    inner = getattr(chain.model, "models", None)
    for c, m in enumerate(inner if inner is not None else [chain.model]):
        m.write().save(os.path.join(folder, "models", str(c)))
    manifest = dict(chain.meta, n_models=len(inner) if inner is not None else 0, saved=time.time_ns())
    spark.createDataFrame([(json.dumps(manifest, sort_keys=True),)], "value string").coalesce(1) \
        .write.text(os.path.join(folder, "manifest"))
    return folder


def load_chain(spark: SparkSession, path: str) -> Chain:
    """The newest whole version below ``path``; FileNotFoundError if there is none."""
    whole = []
    for name in child_names(spark, path):
        folder = os.path.join(path, name)
        if name.startswith("v-") and path_exists(spark, os.path.join(folder, "manifest", "_SUCCESS")):
            manifest = json.loads(spark.read.text(os.path.join(folder, "manifest")).first()[0])
            whole.append((manifest["saved"], folder, manifest))
    if not whole:
        raise FileNotFoundError(f"no whole version below {path}")
    _, folder, manifest = max(whole, key=lambda v: v[:2])
    cls = MODEL_CLASSES[manifest["kind"]]
    models = [cls.load(os.path.join(folder, "models", str(c))) for c in range(manifest["n_models"] or 1)]
    components = centre = None
    if manifest["components"]:
        rows = spark.read.parquet(os.path.join(folder, "components")).orderBy("pos").collect()
        components, centre = np.array([r["weights"] for r in rows]), np.array([r["centre"] for r in rows])
    meta = {k: v for k, v in manifest.items() if k not in ("saved", "n_models")}
    return Chain(spark.read.parquet(os.path.join(folder, "params")), components, centre,
                 ML.OneVsRestGBTModel(models) if manifest["n_models"] else models[0],
                 spark.read.parquet(os.path.join(folder, "codes")), meta)
