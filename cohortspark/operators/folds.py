"""Deterministic stratified folds and hold-outs.

The fold of a sample is ``(rank within its label by md5(seed-id), id) mod k``.
A plain ``row_number() OVER (PARTITION BY label ...)`` would put a whole label
- possibly a third of all samples - into one task.  Instead the hash order is
split into ``16**prefix`` hex buckets: each bucket is ranked on its own and a
tiny per-(label, bucket) offset table (a running sum over at most
``labels x buckets`` rows) turns local ranks into exact global ranks.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .ordered import bucketed_rank


def hash_order(id_col: str, seed: int | str = 42):
    return F.md5(F.concat(F.lit(str(seed)), F.lit("-"), F.col(id_col).cast("string")))


def stratified_folds(df: DataFrame, id_col: str = "sample_id", label_col: str = "label",
                     k: int = 5, seed: int | str = 42, fold_col: str = "fold",
                     prefix_len: int = 3) -> DataFrame:
    """Add ``fold`` in ``0..k-1``; per-label fold sizes differ by at most one."""
    h = "_h"
    ranked = bucketed_rank(df.withColumn(h, hash_order(id_col, seed)), [label_col],
                           [F.col(h), F.col(id_col)], F.substring(F.col(h), 1, prefix_len),
                           rank_col="_rank")
    return ranked.withColumn(fold_col, ((F.col("_rank") - 1) % k).cast("int")).drop(h, "_rank")


def stratified_holdout(df: DataFrame, id_col: str = "sample_id", label_col: str = "label",
                       fraction: float = 0.2, seed: int | str = 42,
                       flag_col: str = "is_holdout", prefix_len: int = 3) -> DataFrame:
    """Flag ``round(fraction * n_label)`` samples of every label as hold-out."""
    h = "_h"
    ranked = bucketed_rank(df.withColumn(h, hash_order(id_col, seed)), [label_col],
                           [F.col(h), F.col(id_col)], F.substring(F.col(h), 1, prefix_len),
                           rank_col="_rank")
    sizes = df.groupBy(label_col).agg(F.count(F.lit(1)).alias("_cnt"))
    return ranked.join(sizes, label_col) \
        .withColumn(flag_col, F.col("_rank") <= F.round(F.lit(fraction) * F.col("_cnt"))) \
        .drop(h, "_rank", "_cnt")
