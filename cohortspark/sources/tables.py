"""Driver table access (parquet, lazily scanned, pruned and filtered by Catalyst)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem",
          "events", "documents", "embeddings", "pages", "benchmark", "labels",
          "conversations")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    if name not in TABLES:
        raise KeyError(name)
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


class Tables:
    """Attribute access to the driver tables of one scale-factor folder."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark = spark
        self.sf_dir = sf_dir
        self._memo: dict = {}

    def memo(self, name: str, build):
        """Build a small derived table once per ``Tables`` instance."""
        if name not in self._memo:
            self._memo[name] = build()
        return self._memo[name]

    def __getattr__(self, name: str) -> DataFrame:
        if name in TABLES:
            return table(self.spark, self.sf_dir, name)
        raise AttributeError(name)

    def register_views(self) -> None:
        for name in TABLES:
            table(self.spark, self.sf_dir, name).createOrReplaceTempView(name)
