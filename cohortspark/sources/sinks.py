"""Sinks and run artefacts: matrices, OOF tables, feature lists, fitted models.

Everything is written by executors (``DataFrame.write``); parameter tables
(scaler, imputer, PCA loadings, class codes) are plain parquet tables so they
can be joined back at scoring time.
"""

from __future__ import annotations

import json
import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .paths import child_names, path_exists


def write_matrix(df: DataFrame, path: str, partition_by: str | None = None,
                 fmt: str = "parquet") -> None:
    w = df.write.mode("overwrite")
    if partition_by:
        w = w.partitionBy(partition_by)
    if fmt == "csv":
        w.option("header", "true").csv(path)
    else:
        w.format(fmt).save(path)


def write_oof(oof_wide: DataFrame, path: str) -> None:
    write_matrix(oof_wide, path)


def write_feature_list(features: DataFrame, path: str, fmt: str = "json") -> None:
    """``(pos, feature)`` table; ``pos`` keeps the list order for readers, so
    no single-file write is needed."""
    write_matrix(features.select(F.col("pos").cast("int"), "feature"), path, fmt=fmt)


def read_feature_table(spark: SparkSession, path: str, fmt: str = "json") -> DataFrame:
    reader = spark.read.option("header", "true") if fmt == "csv" else spark.read
    df = reader.format(fmt).load(path)
    return df.select(F.col("pos").cast("int").alias("pos"), F.col("feature").cast("string"))


def save_run(path: str, models: dict | None = None, tables: dict | None = None,
             meta: dict | None = None) -> None:
    """Persist Spark ML models (native format) and parameter tables (parquet)."""
    for name, model in (models or {}).items():
        model.write().overwrite().save(os.path.join(path, "models", name))
    for name, df in (tables or {}).items():
        df.write.mode("overwrite").parquet(os.path.join(path, "tables", name))
    if meta is not None:
        spark = SparkSession.getActiveSession()
        spark.createDataFrame([(json.dumps(meta, sort_keys=True),)], "meta string") \
            .write.mode("overwrite").json(os.path.join(path, "meta"))


def load_run(spark: SparkSession, path: str, model_classes: dict | None = None) -> dict:
    out = {"models": {}, "tables": {}, "meta": None}
    for name, cls in (model_classes or {}).items():
        out["models"][name] = cls.load(os.path.join(path, "models", name))
    tdir = os.path.join(path, "tables")
    for name in child_names(spark, tdir):
        out["tables"][name] = spark.read.parquet(os.path.join(tdir, name))
    mdir = os.path.join(path, "meta")
    if path_exists(spark, mdir):
        row = spark.read.json(mdir).first()
        out["meta"] = json.loads(row["meta"]) if row else None
    return out
