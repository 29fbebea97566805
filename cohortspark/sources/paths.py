"""Path checks on the file system that Spark itself resolves a path to."""

from __future__ import annotations

from pyspark.sql import SparkSession


def _resolve(spark: SparkSession, path: str):
    hpath = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return hpath.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), hpath


def path_exists(spark: SparkSession, path: str) -> bool:
    fs, hpath = _resolve(spark, path)
    return fs.exists(hpath)


def child_names(spark: SparkSession, path: str) -> list[str]:
    """Sorted names in a folder; empty if there is no such folder."""
    fs, hpath = _resolve(spark, path)
    if not fs.exists(hpath):
        return []
    return sorted(s.getPath().getName() for s in fs.listStatus(hpath))
