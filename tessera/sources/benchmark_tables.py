"""Reader for the benchmark tables (one Parquet file per table)."""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession

BENCHMARK_TABLES = (
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem",
    "events", "documents", "embeddings", "pages", "benchmark", "labels", "conversations",
)


class BenchmarkTables:
    """``tables.read("orders", "o_orderkey", ...)`` -> pruned DataFrame."""

    def __init__(self, spark: SparkSession, root: str) -> None:
        self.spark = spark
        self.root = root.rstrip("/")

    def path(self, name: str) -> str:
        return os.path.join(self.root, f"{name}.parquet")

    def read(self, name: str, *cols: str) -> DataFrame:
        df = self.spark.read.parquet(self.path(name))
        return df.select(*cols) if cols else df
