"""Schema-level helpers (driver-side metadata only, no data movement)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import NumericType


class MissingColumns(KeyError):
    pass


def require(df: DataFrame, cols) -> DataFrame:
    missing = [c for c in cols if c not in df.columns]
    if missing:
        raise MissingColumns(f"missing required columns: {missing}")
    return df


def has_columns(df: DataFrame, cols) -> bool:
    return all(c in df.columns for c in cols)


def ensure_key(df: DataFrame, key: str = "sample_id") -> DataFrame:
    """Use ``key`` when present, else rename the first column to it."""
    if key in df.columns:
        return df
    return df.withColumnRenamed(df.columns[0], key)


def prefixed_columns(df: DataFrame, prefix: str) -> list[str]:
    return [c for c in df.columns if c.startswith(prefix)]


def keep_prefixed(df: DataFrame, key: str, prefix: str) -> DataFrame:
    """Key plus the columns whose name starts with ``prefix``, in frame order."""
    return df.select(key, *[c for c in prefixed_columns(df, prefix) if c != key])


def model_inputs(df: DataFrame, prefix: str = "pred_") -> list[str]:
    cols = prefixed_columns(df, prefix)
    if not cols:
        raise ValueError(f"no input columns starting with {prefix!r}")
    return cols


def numeric_columns(df: DataFrame, exclude=()) -> list[str]:
    return [f.name for f in df.schema.fields
            if isinstance(f.dataType, NumericType) and f.name not in exclude]


def non_numeric_columns(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema.fields if not isinstance(f.dataType, NumericType)]


def drop_if_present(df: DataFrame, *cols) -> DataFrame:
    return df.drop(*[c for c in cols if c in df.columns])


def select_roles(df: DataFrame, **roles) -> DataFrame:
    """Project and rename source columns to standard roles: ``role=source``."""
    require(df, list(roles.values()))
    return df.select(*[F.col(src).alias(role) for role, src in roles.items()])
