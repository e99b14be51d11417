"""Scans of the driver's star-schema tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

STAR_TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem",
               "events", "documents", "embeddings", "pages", "benchmark", "labels",
               "conversations")


class Tables:
    """Lazy accessor: ``t.orders`` is ``spark.read.parquet(<dir>/orders.parquet)``.

    Nothing is read until a query needs it; Catalyst prunes columns and pushes
    filters into each scan.
    """

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark = spark
        self.sf_dir = sf_dir.rstrip("/")
        self._scans: dict[str, DataFrame] = {}

    def __getattr__(self, name: str) -> DataFrame:
        if name not in STAR_TABLES:
            raise AttributeError(name)
        # kept for this accessor only: another one lists the files anew
        df = self._scans.get(name)
        if df is None:
            df = self._scans[name] = self.spark.read.parquet(f"{self.sf_dir}/{name}.parquet")
        return df

    def __getitem__(self, name: str) -> DataFrame:
        return self.__getattr__(name)
