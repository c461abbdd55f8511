"""Parquet tables of a data directory."""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession


def read_table(spark: SparkSession, data_dir: str, name: str) -> DataFrame:
    """One table of ``data_dir``: ``<name>.parquet`` (file or folder); column pruning and filters reach the scan."""
    return spark.read.parquet(os.path.join(data_dir, f"{name}.parquet"))


class Tables:
    """Lazy accessor: ``Tables(spark, dir).lineitem`` reads on first use and caches the (lazy) DataFrame handle."""

    def __init__(self, spark: SparkSession, data_dir: str):
        self.spark = spark
        self.data_dir = data_dir
        self._cache: dict[str, DataFrame] = {}

    def __getattr__(self, name: str) -> DataFrame:
        if name.startswith("_"):
            raise AttributeError(name)
        if name not in self._cache:
            self._cache[name] = read_table(self.spark, self.data_dir, name)
        return self._cache[name]
