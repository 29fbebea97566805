"""Cohort sources: fault-tolerant multi-file scans into the long form.

A cohort registry is a list of :class:`CohortSource`; every source is scanned
lazily (CSV read all-STRING so that coercion is explicit, or parquet), tagged
with its cohort name and registry ordinal, projected to the standard roles and
unioned.  Sources with a missing file or missing columns are skipped (or raise
with ``on_error='fail'``) and recorded in an ingest report.  Only path and
schema metadata is inspected on the driver; no data passes through it.
"""

from __future__ import annotations

from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from ..functions.scalar import strip_ws
from .paths import path_exists

# Text tokens read as missing by default in CSV cohort files
# (the common default set of the pandas CSV reader).
NA_TOKENS = [
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan",
    "1.#IND", "1.#QNAN", "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a",
    "nan", "null",
]

LONG = "long"
EVENTS = "events"
WIDE = "wide"


@dataclass
class CohortSource:
    """One cohort file of one modality.

    ``layout`` is ``long`` (sample, feature, value), ``events`` (sample,
    feature[, variant class]) or ``wide`` (sample + one column per feature).
    """

    cohort: str
    path: str
    layout: str = LONG
    sample_col: str = "patient_barcode"
    feature_col: str | None = None
    value_col: str | None = None
    class_col: str | None = None
    fmt: str = "csv"
    options: dict = field(default_factory=dict)


def na_to_null(df: DataFrame, tokens=NA_TOKENS) -> DataFrame:
    """Map the missing-value tokens of every STRING column to NULL."""
    toks = [t for t in tokens if t != ""]
    out = []
    for f in df.schema.fields:
        c = F.col(f"`{f.name}`")
        if isinstance(f.dataType, StringType):
            s = strip_ws(c)
            c = F.when((s == "") | s.isin(*toks), F.lit(None).cast("string")).otherwise(c)
        out.append(c.alias(f.name))
    return df.select(*out)


def read_source(spark: SparkSession, src: CohortSource) -> DataFrame:
    if src.fmt == "csv":
        opts = {"header": "true", "inferSchema": "false", "multiLine": "false"}
        opts.update(src.options)
        return na_to_null(spark.read.options(**opts).csv(src.path))
    return spark.read.options(**src.options).format(src.fmt).load(src.path)


def _required(src: CohortSource) -> list[str]:
    if src.layout == LONG:
        return [src.sample_col, src.feature_col, src.value_col]
    if src.layout == EVENTS:
        return [src.sample_col, src.feature_col] + ([src.class_col] if src.class_col else [])
    return [src.sample_col]


def to_roles(df: DataFrame, src: CohortSource, ordinal: int) -> DataFrame:
    tag = [F.lit(src.cohort).alias("cohort"), F.lit(ordinal).alias("ordinal")]
    if src.layout == LONG:
        return df.select(*tag, F.col(src.sample_col).alias("sample_id"),
                         F.col(src.feature_col).cast("string").alias("feature"),
                         F.col(src.value_col).alias("value"))
    if src.layout == EVENTS:
        cls = F.col(src.class_col) if src.class_col else F.lit(None).cast("string")
        return df.select(*tag, F.col(src.sample_col).alias("sample_id"),
                         F.col(src.feature_col).cast("string").alias("feature"),
                         cls.alias("variant_class"))
    return df.select(*tag, F.col(src.sample_col).alias("sample_id"),
                     *[F.col(f"`{c}`") for c in df.columns if c != src.sample_col])


def scan_cohorts(spark: SparkSession, sources: list[CohortSource], on_error: str = "skip"):
    """Scan every source; return ``(union, report)``.

    ``union`` is the role-projected union of the good sources (long / events
    layouts union by name; wide sources are returned as a list because their
    column sets differ, see :func:`union_common`).  ``report`` has one row per
    source: ``(cohort, ordinal, path, status, reason)``.
    """
    good, report = [], []
    for ordinal, src in enumerate(sources):
        try:
            if not path_exists(spark, src.path):
                raise FileNotFoundError(src.path)
            df = read_source(spark, src)
            missing = [c for c in _required(src) if c not in df.columns]
            if missing:
                raise KeyError(f"missing columns {missing}")
            good.append(to_roles(df, src, ordinal))
            report.append((src.cohort, ordinal, src.path, "ok", None))
        except (FileNotFoundError, KeyError) as exc:
            if on_error == "fail":
                raise
            report.append((src.cohort, ordinal, src.path, "skipped", f"{type(exc).__name__}: {exc}"))
    schema = StructType([StructField("cohort", StringType()), StructField("ordinal", StringType()),
                         StructField("path", StringType()), StructField("status", StringType()),
                         StructField("reason", StringType())])
    rep = spark.createDataFrame([(a, str(b), c, d, e) for a, b, c, d, e in report], schema)\
        .withColumn("ordinal", F.col("ordinal").cast("int"))
    if not good:
        raise RuntimeError("no cohort source could be read")
    if sources and all(s.layout == WIDE for s in sources):
        return good, rep
    return reduce(lambda a, b: a.unionByName(b), good), rep


def read_feature_list(spark: SparkSession, path: str) -> DataFrame:
    """Ordered feature list from a text file: ``(pos INT, feature STRING)``.

    Each line is stripped of surrounding whitespace; blank lines are kept and
    the file order is preserved.  A list file is bounded by the feature count,
    so it is read as one ``wholetext`` row per file and split in place.
    """
    raw = spark.read.text(path, wholetext=True)
    lines = raw.select(F.posexplode(F.split(F.regexp_replace("value", r"\r?\n$", ""), r"\r?\n"))
                       .alias("pos", "line"))
    return lines.select(F.col("pos").cast("int").alias("pos"), strip_ws("line").alias("feature"))
