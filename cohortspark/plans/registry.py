"""Registered queries: one Spark plan per operator family, each with the
equivalent DuckDB SQL text where one exists.

Every query reads the whole driver tables of ``sf_dir``.  Double outputs are
rounded to 6 places on both sides so that summation order does not matter.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, FloatType

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}
CHECK: dict[str, str] = {}


def _plus_zero_after_round(sql: str) -> str:
    """Append ``+ 0.0`` to every ``round(...)`` call of a SQL twin.

    DuckDB rounds a tiny negative value to ``-0.0`` where Spark yields
    ``0.0``; adding positive zero normalises the sign (IEEE: -0.0 + 0.0 = 0.0).
    """
    out, i, low = [], 0, sql.lower()
    while True:
        j = low.find("round(", i)
        if j < 0 or (j > 0 and (low[j - 1].isalnum() or low[j - 1] == "_")):
            if j < 0:
                out.append(sql[i:])
                return "".join(out)
            out.append(sql[i:j + 6])
            i = j + 6
            continue
        depth, k = 0, j + 5
        while k < len(sql):
            if sql[k] == "(":
                depth += 1
            elif sql[k] == ")":
                depth -= 1
                if depth == 0:
                    break
            k += 1
        out.append(sql[i:j])
        inner = _plus_zero_after_round(sql[j + 6:k])
        out.append(f"(round({inner}) + 0.0)")
        i = k + 1


def register(name: str, sql: str | None = None, check: str | None = None):
    def deco(fn):
        QUERIES[name] = fn
        if sql is not None:
            ORACLE[name] = _plus_zero_after_round(sql.strip())
        CHECK[name] = check or ("SQL" if sql is not None else "ROWS")
        return fn
    return deco


def rounded(df: DataFrame, places: int = 6) -> DataFrame:
    out = []
    for f in df.schema.fields:
        c = F.col(f"`{f.name}`")
        if isinstance(f.dataType, (DoubleType, FloatType)):
            c = F.round(c.cast("double"), places)
        out.append(c.alias(f.name))
    return df.select(*out)
