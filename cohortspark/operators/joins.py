"""Key resolution, label attachment and outer stacking of prediction tables."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..session import spread

MAX_CLASSES = 1000
MAX_REGISTRY = 100_000


def checked_broadcast(df: DataFrame, max_rows: int, what: str = "table") -> DataFrame:
    """Broadcast hint only after proving the row bound (one small count of at
    most ``max_rows + 1`` rows); above it the plan keeps a shuffled join."""
    n = df.limit(max_rows + 1).count()
    if n > max_rows:
        return df
    return F.broadcast(df)


def resolve_cohort(long: DataFrame, key: str = "sample_id", cohort: str = "cohort",
                   ordinal: str = "ordinal", out: str = "label",
                   registry: DataFrame | None = None) -> DataFrame:
    """sample -> cohort, the last cohort in registry order wins.

    The largest ordinal per sample is a hash aggregate with map-side partial
    aggregation (a ``max_by`` over the raw rows would plan a sort aggregate);
    the ordinal is mapped back to its cohort through the bounded registry
    (given, or the distinct (cohort, ordinal) pairs of the input).
    """
    last = long.groupBy(key).agg(F.max(ordinal).alias(ordinal))
    codes = registry if registry is not None else long.select(cohort, ordinal).distinct()
    return last.join(checked_broadcast(codes.select(cohort, ordinal), MAX_REGISTRY, "registry"), ordinal) \
        .select(key, F.col(cohort).alias(out))


def registry_ordinals(long: DataFrame, cohort: str = "cohort") -> DataFrame:
    """Attach an alphabetical registry ordinal when cohorts come from data."""
    codes = long.select(cohort).distinct() \
        .select(cohort, (F.dense_rank().over(Window.orderBy(cohort)) - 1).alias("ordinal"))
    return long.join(checked_broadcast(codes, MAX_REGISTRY, "registry"), cohort)


def class_codes(df: DataFrame, label: str = "label") -> DataFrame:
    """``(label, code)``: alphabetical codes from 0 (label-encoder order).

    One row per class (a classification label set; :func:`class_list`
    enforces the bound where the classes reach the driver)."""
    codes = df.select(label).where(F.col(label).isNotNull()).distinct() \
        .select(label, (F.dense_rank().over(Window.orderBy(label)) - 1).cast("int").alias("code"))
    return codes


def class_list(df: DataFrame, label: str = "label", max_classes: int = MAX_CLASSES) -> list:
    vals = [r[0] for r in df.select(label).where(F.col(label).isNotNull()).distinct()
            .orderBy(label).limit(max_classes + 1).collect()]
    if len(vals) > max_classes:
        raise ValueError(f"more than {max_classes} classes")
    return vals


def encode_labels(df: DataFrame, codes: DataFrame, label: str = "label",
                  out: str = "code") -> DataFrame:
    return df.join(checked_broadcast(codes.withColumnRenamed("code", out), MAX_CLASSES, "classes"),
                   label, "left")


def decode_labels(df: DataFrame, codes: DataFrame, code: str = "code", out: str = "label") -> DataFrame:
    return df.join(checked_broadcast(codes.select(F.col("code").alias(code), F.col("label").alias(out)),
                                     MAX_CLASSES, "classes"), code, "left")


def attach_labels(meta: DataFrame, labels: DataFrame, key: str = "sample_id",
                  label: str = "label") -> DataFrame:
    """Left join then drop unlabeled rows == inner join on the key."""
    lab = labels.select(key, label).where(F.col(label).isNotNull())
    base = meta.drop(label) if label in meta.columns else meta
    return base.join(lab, key, "inner")


def stack_outer(long_preds: DataFrame, columns: list[str], key: str = "sample_id",
                name_col: str = "column", value_col: str = "prob",
                on_duplicate: str = "mean", n_rows: int = 0) -> DataFrame:
    """Full-outer stacking of many prediction tables, as union + bounded pivot.

    ``long_preds`` holds ``(key, column, prob)`` rows of every source.  One
    shuffle on the key, whatever the number of sources; a sample missing in a
    source reads NULL in that source's columns.  ``on_duplicate``: ``mean``
    averages a key repeated inside one source, ``error`` raises.  ``n_rows``
    (about) spreads the rows by key before they are grouped, see ``spread``.
    """
    if on_duplicate == "error":
        dup = long_preds.groupBy(key, name_col).count().where("count > 1").limit(1).count()
        if dup:
            raise ValueError("duplicate keys inside a prediction source")
    long_preds = spread(long_preds, n_rows, key)
    return long_preds.groupBy(key).pivot(name_col, list(columns)).agg(F.avg(value_col))


def stack_outer_join(wides: list[DataFrame], key: str = "sample_id") -> DataFrame:
    """Join-chain form (duplicate keys multiply rows, like a merge chain)."""
    def step(a, b):
        return a.join(b.drop("label") if "label" in b.columns else b, key, "full_outer")
    return reduce(step, wides)


def fill_uninformative(df: DataFrame, cols: list[str], n_classes: int) -> DataFrame:
    return df.na.fill(1.0 / n_classes, subset=list(cols))


def harmonise_binary(df: DataFrame, modality: str, key: str = "sample_id") -> DataFrame | None:
    """Two binary OOF layouts -> ``pred_<m>_normal_prob``, ``pred_<m>_cancer_prob``."""
    single = f"pred_{modality}_binary"
    if single in df.columns:
        p = F.col(single)
        normal, cancer = p, 1 - p
    elif "pred_0" in df.columns and "pred_1" in df.columns:
        cancer, normal = F.col("pred_0"), F.col("pred_1")
    else:
        return None
    return df.select(key, normal.alias(f"pred_{modality}_normal_prob"),
                     cancer.alias(f"pred_{modality}_cancer_prob"))


def require_binary(df: DataFrame, label: str = "label") -> int:
    """Binary contract: exactly two classes, else ``ValueError``."""
    n = df.select(label).where(F.col(label).isNotNull()).distinct().limit(3).count()
    if n != 2:
        raise ValueError(f"binary labels expected, found {n} classes")
    return n


def positive_code(codes: DataFrame, positive_label, label: str = "label") -> DataFrame:
    """Code of the positive class in the class-code table (one row)."""
    return codes.where(F.col(label) == F.lit(positive_label)).select(F.col("code").alias("positive_code"))
