"""Small shared helpers of the corpus operators."""

from __future__ import annotations

import ctypes

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cohortspark.session import materialize  # noqa: F401  (re-exported for the operators)

#: A word is a maximal run of characters outside ASCII white space (fixed value).
WORD = "[^\\x20\\x09-\\x0D]+"
SPACES = " \t\n\x0b\x0c\r"
BATCH_BYTES = "spark.sql.execution.arrow.maxBytesPerBatch"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def id_crc(col: str = "doc_id") -> Column:
    """crc32 of the id as text; a null id reads as 0 (so it is held out of every fit)."""
    return F.coalesce(F.crc32(F.col(col).cast("string")), F.lit(0))


def shuffle_partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def bound_batches(spark: SparkSession) -> None:
    """Texts go to the Python workers in batches of a few MB, unless the session names another size.

    Spark's default (10,000 rows, 64 MB) holds a batch and its doubled buffer in every task's direct
    memory, and two batches in its worker."""
    spark.conf.set(BATCH_BYTES, spark.conf.get(BATCH_BYTES, "4m"))


def tidy(run):
    """``run`` (for mapInArrow), after which the worker process gives its free memory back: workers
    serve task after task, and the allocators would keep each task's peak."""
    def wrapped(batches):
        try:
            yield from run(batches)
        finally:
            pa.default_memory_pool().release_unused()
            trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
            if trim is not None:
                trim(0)
    return wrapped
