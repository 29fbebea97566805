"""Long <-> wide reshapes.

The long table ``(sample_id, feature, value)`` is the canonical form: it
scales with rows, not with schema width.  Wide output is produced only for an
explicit, bounded feature list (pivot values are always passed, so Spark does
not run a hidden distinct job and never exceeds ``spark.sql.pivotMaxValues``).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

MAX_WIDE_FEATURES = 2000

_AGGS = {
    "mean": F.avg, "sum": F.sum, "min": F.min, "max": F.max, "count": F.count,
    "median": F.median, "first": lambda c: F.first(c, ignorenulls=True),
}


def to_long(df: DataFrame, sample: str, feature: str, value: str | None = None) -> DataFrame:
    cols = [F.col(sample).alias("sample_id"), F.col(feature).cast("string").alias("feature")]
    if value is not None:
        cols.append(F.col(value).alias("value"))
    return df.select(*cols)


def filter_prefix(df: DataFrame, col: str, prefix: str) -> DataFrame:
    """Rows whose ``col`` starts with ``prefix`` (pushed to parquet as StringStartsWith)."""
    return df.where(F.col(col).startswith(prefix))


def filter_in(df: DataFrame, col: str, values) -> DataFrame:
    return df.where(F.col(col).isin(*list(values)))


def cell_agg(long: DataFrame, agg: str = "mean", keys=("sample_id", "feature"),
             keep_null_cells: bool = False) -> DataFrame:
    """One value per (sample, feature); NULL keys and NULL values are dropped first,
    so an all-NULL cell disappears (it is then absent, i.e. filled later).
    ``keep_null_cells`` keeps such a cell as an explicit NULL (a missing
    measurement in a wide file)."""
    fn = _AGGS[agg]
    clean = long.where(F.col(keys[-2]).isNotNull() & F.col(keys[-1]).isNotNull())
    if not keep_null_cells:
        clean = clean.where(F.col("value").isNotNull())
    out = clean.groupBy(*keys).agg(fn("value").alias("value"))
    if agg == "count":
        out = out.withColumn("value", F.col("value").cast("double"))
    return out


def cell_mean(long: DataFrame) -> DataFrame:
    return cell_agg(long, "mean")


def feature_values(df: DataFrame, col: str = "feature", limit: int = MAX_WIDE_FEATURES) -> list:
    """Sorted distinct values of a bounded column; raises above ``limit``."""
    vals = [r[0] for r in df.select(col).where(F.col(col).isNotNull()).distinct()
            .orderBy(col).limit(limit + 1).collect()]
    if len(vals) > limit:
        raise ValueError(f"{col} has more than {limit} distinct values; keep it long")
    return vals


def pivot_agg(long: DataFrame, values: list | None = None, agg: str = "mean",
              fill: float | None = 0.0, key: str = "sample_id") -> DataFrame:
    """Wide matrix: one row per sample, one column per feature in ``values``
    (sorted).  ``key`` may be a list when extra per-sample columns (a label)
    ride along."""
    if values is None:
        values = feature_values(long)
    if len(values) > MAX_WIDE_FEATURES:
        raise ValueError("too many features for a wide pivot; keep the long form")
    keys = [key] if isinstance(key, str) else list(key)
    clean = long.where(F.col(keys[0]).isNotNull() & F.col("feature").isNotNull()
                       & F.col("value").isNotNull())
    fn = _AGGS[agg]
    wide = clean.groupBy(*keys).pivot("feature", sorted(values)).agg(fn("value"))
    if agg == "count":
        wide = wide.select(*keys, *[F.col(f"`{v}`").cast("double").alias(str(v)) for v in sorted(values)])
    if fill is not None:
        wide = wide.na.fill(fill)
    return wide


def pivot_mean(long: DataFrame, values: list | None = None, key: str = "sample_id") -> DataFrame:
    return pivot_agg(long, values, "mean", 0.0, key)


def presence(events: DataFrame) -> DataFrame:
    """Distinct (sample, feature) pairs with value 1 (long presence matrix)."""
    return events.where(F.col("sample_id").isNotNull() & F.col("feature").isNotNull()) \
        .select("sample_id", "feature").distinct().withColumn("value", F.lit(1))


def pivot_presence(events: DataFrame, values: list | None = None) -> DataFrame:
    p = presence(events)
    if values is None:
        values = feature_values(p)
    wide = p.groupBy("sample_id").pivot("feature", sorted(values)).agg(F.max("value"))
    return wide.na.fill(0)


def crosstab_long(df: DataFrame, row: str, col: str) -> DataFrame:
    """Cross-tabulation counts in long form ``(row, col, n)`` (present cells only)."""
    return df.groupBy(row, col).agg(F.count(F.lit(1)).alias("n"))


def binarise(c):
    return (F.col(c) > 0).cast("int") if isinstance(c, str) else (c > 0).cast("int")


def feature_dictionary(long: DataFrame, col: str = "feature") -> DataFrame:
    """``(pos, feature)``: features in lexical order, ``pos`` from 0.

    Bounded by the feature count (not the row count); the ordering window runs
    over the distinct feature names only.
    """
    feats = long.select(col).where(F.col(col).isNotNull()).distinct()
    return feats.select((F.row_number().over(Window.orderBy(col)) - 1).cast("int").alias("pos"),
                        F.col(col).alias("feature"))


def align_long(long: DataFrame, dictionary: DataFrame) -> DataFrame:
    """Keep rows whose feature is in the dictionary (extras dropped) and attach ``pos``.
    Absent features are filled when the vector / pivot is built."""
    return long.join(dictionary.select("feature", "pos"), "feature", "inner")


def align_wide(df: DataFrame, key: str, features: list[str], fill=0.0) -> DataFrame:
    """Reorder/complete columns to ``features``; new columns get ``fill``,
    existing NULLs are left untouched."""
    present = set(df.columns)
    cols = [F.col(f"`{f}`") if f in present else F.lit(fill).cast("double").alias(f)
            for f in features]
    return df.select(key, *[c.alias(f) for c, f in zip(cols, features)])


def restore_samples(samples: DataFrame, features: DataFrame, key: str = "sample_id") -> DataFrame:
    """Samples lost in filtering come back with NULL features (left join)."""
    return samples.select(key).distinct().join(features, key, "left")


def melt_wide(df: DataFrame, key: str, cols: list[str] | None = None) -> DataFrame:
    cols = cols or [c for c in df.columns if c != key]
    return df.unpivot([key], cols, "feature", "value")


def array_to_columns(df: DataFrame, key: str, array_col: str, names: list[str],
                     keep=()) -> DataFrame:
    return df.select(key, *keep, *[F.col(array_col)[i].cast("double").alias(n)
                                   for i, n in enumerate(names)])


def assemble(long_pos: DataFrame, d: int, fill=0.0, key: str = "sample_id",
             out: str = "features", samples: DataFrame | None = None) -> DataFrame:
    """ML vector per sample from ``(key, pos, value)``, see ``vectors.py``: one
    sorted pass, no width limit; ``fill`` (a number, or one per position) is
    what absent cells read; with ``samples`` no sample is lost."""
    from .vectors import assemble_vectors
    return assemble_vectors(long_pos, d, fill, key, out, samples)


def assemble_dense(long_pos: DataFrame, d: int, fill=0.0, key: str = "sample_id",
                   out: str = "features") -> DataFrame:
    from .vectors import assemble_vectors
    return assemble_vectors(long_pos, d, fill, key, out, form="dense")


def assemble_sparse(long_pos: DataFrame, d: int, key: str = "sample_id",
                    out: str = "features") -> DataFrame:
    from .vectors import assemble_vectors
    return assemble_vectors(long_pos, d, 0.0, key, out, form="sparse")
