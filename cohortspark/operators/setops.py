"""Unions over cohort frames."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def union_all(dfs: list[DataFrame]) -> DataFrame:
    return reduce(lambda a, b: a.unionByName(b), dfs)


def common_columns(dfs: list[DataFrame]) -> list[str]:
    """Ordered intersection of column names, in the first frame's order."""
    common = set(dfs[0].columns)
    for d in dfs[1:]:
        common &= set(d.columns)
    return [c for c in dfs[0].columns if c in common]


def union_common(dfs: list[DataFrame]) -> DataFrame:
    """Union-all over the intersection of columns (NULLs and duplicates kept)."""
    cols = common_columns(dfs)
    return union_all([d.select(*[F.col(f"`{c}`") for c in cols]) for d in dfs])


def union_common_long(long: DataFrame, n_cohorts: int | None = None,
                      cohort_col: str = "cohort") -> DataFrame:
    """Long variant of :func:`union_common`: keep features present in every cohort."""
    if n_cohorts is None:
        n_cohorts = F.lit(long.select(cohort_col).distinct().count())
    else:
        n_cohorts = F.lit(n_cohorts)
    keep = long.groupBy("feature").agg(F.countDistinct(cohort_col).alias("_nc")) \
        .where(F.col("_nc") == n_cohorts).select("feature")
    return long.join(keep, "feature", "left_semi")


def union_all_columns(dfs: list[DataFrame], key: str | None = None) -> DataFrame:
    """Union-all over the union of columns; missing -> NULL; columns sorted."""
    out = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), dfs)
    cols = sorted(c for c in out.columns if c != key)
    return out.select(*([key] if key else []), *[F.col(f"`{c}`") for c in cols])


def all_samples(dfs: list[DataFrame], key: str = "sample_id") -> DataFrame:
    return union_all([d.select(key) for d in dfs]).distinct()
