"""Access to the input tables (one parquet file or folder per table)."""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession

TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem",
          "events", "documents", "embeddings", "pages", "benchmark", "labels",
          "conversations")

DEFAULT_SF_DIR = "/root/testdata/sf0.01"


def load(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    from kiln.session import reachable
    reachable(spark)
    return spark.read.parquet(os.path.join(sf_dir, f"{name}.parquet"))
