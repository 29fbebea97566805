"""Cohort integration jobs (entry point A) and scoring-time preprocessing.

* :func:`integrate_long`   - long cohorts: roles, NULL drop, id-prefix filter,
  coercion, sample->cohort (last wins), cell mean.  Gene / copy number.
* :func:`integrate_events` - event lists: distinct pairs, presence 1.  Mutation.
* :func:`integrate_wide`   - wide cohorts: key + prefixed columns, common
  columns union.  Methylation.
* :func:`integrate_mixed`  - long cohorts pivoted + one wide cohort, common
  columns union (nothing when either side is empty).  miRNA.
* ``prepare_*``            - the same reshapes at scoring time, aligned to a
  saved feature list.

Outputs stay long (``sample_id, feature, value`` + a sample-level label
table); wide frames are produced only for bounded feature lists.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from ..functions.scalar import coerce_numeric
from ..functions.schema import keep_prefixed
from ..operators import joins as J
from ..operators import reshape as R
from ..operators import setops as U


def clean_long(long: DataFrame, prefix: str | None = None, coerce: bool = True,
               value_is_string: bool = False) -> DataFrame:
    out = long.where(F.col("feature").isNotNull() & F.col("sample_id").isNotNull())
    if prefix:
        out = R.filter_prefix(out, "feature", prefix)
    if coerce:
        out = out.withColumn("value", coerce_numeric("value", 0.0, is_string=value_is_string))
    return out


def integrate_long(long: DataFrame, prefix: str | None = None, coerce: bool = True,
                   value_is_string: bool = False,
                   registry: DataFrame | None = None) -> tuple[DataFrame, DataFrame]:
    """``(cells, labels)``: mean value per (sample, feature) and the sample's
    cohort (last in registry order).  ``long`` has cohort, ordinal, sample_id,
    feature, value.

    With the (bounded) ``registry`` table ``(cohort, ordinal)`` both outputs
    come from one aggregate of the raw rows: the cell aggregate also keeps the
    largest ordinal, the sample label is the largest ordinal over its cells,
    mapped back to its cohort name - the raw rows are read once.
    """
    clean = clean_long(long, prefix, coerce, value_is_string)
    if registry is None:
        labels = J.resolve_cohort(clean, "sample_id", "cohort", "ordinal", "label")
        return R.cell_mean(clean), labels
    agg = clean.where(F.col("value").isNotNull()).groupBy("sample_id", "feature").agg(
        F.avg("value").alias("value"), F.max("ordinal").alias("_ord"))
    last = agg.groupBy("sample_id").agg(F.max("_ord").alias("ordinal"))
    labels = last.join(J.checked_broadcast(registry.select("cohort", "ordinal"), J.MAX_REGISTRY), "ordinal") \
        .select("sample_id", F.col("cohort").alias("label"))
    return agg.select("sample_id", "feature", "value"), labels


def integrate_long_labelled(long: DataFrame, registry: DataFrame, prefix: str | None = None,
                            coerce: bool = True, value_is_string: bool = False) -> DataFrame:
    """Cells with their sample's label in one pass over the raw rows:
    ``(sample_id, feature, value, label)``.

    The cell aggregate keeps the largest registry ordinal; a window over the
    sample's cells (at most one row per feature, so bounded) takes the
    sample's largest ordinal, which the bounded registry maps to a cohort.
    """
    from pyspark.sql import Window
    clean = clean_long(long, prefix, coerce, value_is_string)
    agg = clean.where(F.col("value").isNotNull()).groupBy("sample_id", "feature").agg(
        F.avg("value").alias("value"), F.max("ordinal").alias("_ord"))
    x = agg.withColumn("ordinal", F.max("_ord").over(Window.partitionBy("sample_id")))
    return x.join(J.checked_broadcast(registry.select("cohort", "ordinal"), J.MAX_REGISTRY), "ordinal") \
        .select("sample_id", "feature", "value", F.col("cohort").alias("label"))


def integrate_events(events: DataFrame) -> tuple[DataFrame, DataFrame]:
    """``(presence cells, labels)`` from (cohort, ordinal, sample_id, feature)."""
    ev = events.where(F.col("sample_id").isNotNull() & F.col("feature").isNotNull())
    labels = J.resolve_cohort(ev.select("sample_id", "cohort", "ordinal").distinct())
    return R.presence(ev), labels


def integrate_events_labelled(events: DataFrame, registry: DataFrame) -> DataFrame:
    """Presence cells with the sample's label in one pass over the events:
    ``(sample_id, feature, value=1, label)`` (same window trick as
    :func:`integrate_long_labelled`)."""
    from pyspark.sql import Window
    ev = events.where(F.col("sample_id").isNotNull() & F.col("feature").isNotNull())
    agg = ev.groupBy("sample_id", "feature").agg(F.max("ordinal").alias("_ord"))
    x = agg.withColumn("ordinal", F.max("_ord").over(Window.partitionBy("sample_id")))
    return x.join(J.checked_broadcast(registry.select("cohort", "ordinal"), J.MAX_REGISTRY), "ordinal") \
        .select("sample_id", "feature", F.lit(1).alias("value"), F.col("cohort").alias("label"))


def integrate_wide(cohorts: list[DataFrame], key: str = "sample_id", prefix: str = "cg",
                   label: str = "label") -> DataFrame:
    """Keep key + prefixed columns (+ label) per cohort; union on common columns."""
    parts = []
    for df in cohorts:
        cols = keep_prefixed(df, key, prefix).columns + ([label] if label in df.columns else [])
        parts.append(df.select(*[F.col(f"`{c}`") for c in cols]))
    return U.union_common(parts)


def integrate_mixed(long: DataFrame, wide: DataFrame, features: list[str],
                    key: str = "sample_id", label: str = "label") -> DataFrame | None:
    """Pivot the long cohorts (mean, fill 0; no coercion, no id filter), label
    them, then union with the wide cohort on the common columns."""
    if wide is None or long is None:
        return None
    cells, labels = integrate_long(long, coerce=False)
    wide_long = R.pivot_mean(cells, features, key).join(labels, key)
    return U.union_common([wide_long, wide])


def _named(raw: DataFrame) -> DataFrame:
    return raw.where(F.col("sample_id").isNotNull() & F.col("feature").isNotNull())


def prepare_long(raw: DataFrame, dictionary: DataFrame, key: str = "sample_id") -> DataFrame:
    """Scoring time: coerce, mean per cell, keep dictionary features.  Absent
    features read 0 when the vector / pivot is built; a sample without any
    dictionary feature keeps one row with NULL feature, position and value."""
    text = isinstance(raw.schema["value"].dataType, StringType)
    cells = R.cell_mean(raw.withColumn("value", coerce_numeric("value", 0.0, is_string=text)))
    return R.restore_samples(_named(raw), R.align_long(cells, dictionary))


def prepare_events(raw: DataFrame, dictionary: DataFrame) -> DataFrame:
    """Presence of the dictionary features; samples without one are kept as in :func:`prepare_long`."""
    return R.restore_samples(_named(raw), R.align_long(R.presence(raw), dictionary))


def prepare_wide(raw: DataFrame, features: list[str], key: str = "sample_id",
                 prefix: str = "cg") -> DataFrame | None:
    if key not in raw.columns:
        return None
    return R.align_wide(keep_prefixed(raw, key, prefix), key, features, 0.0)
