"""Bounded-result sorts: global top-n, top-n per group, row-wise argmax."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def top_features(df: DataFrame, by: str = "importance", n: int = 20,
                 tie: str = "feature") -> DataFrame:
    """Global top ``n`` by ``by`` desc (ties by ``tie``): TakeOrderedAndProject."""
    return df.orderBy(F.col(by).desc(), F.col(tie).asc()).limit(n)


def top_per_group(df: DataFrame, group: str, by: str = "importance", n: int = 10,
                  tie: str = "feature", rank_col: str | None = None) -> DataFrame:
    """Top ``n`` rows per group.  ``row_number() <= n`` is planned as a
    WindowGroupLimit, which trims every group to ``n`` rows *before* the
    shuffle, so a hot group never reaches a task whole."""
    rn = F.row_number().over(Window.partitionBy(group).orderBy(F.col(by).desc(), F.col(tie).asc()))
    out = df.withColumn("_rn", rn).where(F.col("_rn") <= n)
    return out.withColumnRenamed("_rn", rank_col) if rank_col else out.drop("_rn")


def argmax_class(long_probs: DataFrame, key: str = "sample_id", class_col: str = "class",
                 prob_col: str = "prob", out: str = "pred") -> DataFrame:
    """Row-wise argmax over class probabilities, ties -> lowest class code
    (codes are alphabetical, so the smallest class name)."""
    keys = [key] if isinstance(key, str) else list(key)
    return long_probs.groupBy(*keys).agg(
        F.min_by(class_col, F.struct((-F.col(prob_col)).alias("p"), F.col(class_col).alias("c")))
        .alias(out))


def argmax_array(arr_col: str):
    """Wide form: index of the first maximum of an array column."""
    return F.array_position(F.col(arr_col), F.array_max(F.col(arr_col))) - 1
