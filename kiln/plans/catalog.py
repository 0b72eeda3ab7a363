"""Imports every query module so the registry is complete."""

from __future__ import annotations

from pyspark.sql import SparkSession

from kiln.plans import (q_backtest, q_eval, q_features, q_models, q_relational, q_series, q_stats,  # noqa: F401
                         q_etl, q_knn, q_streaming, q_tables)
from kiln.plans.registry import COVERS, ORACLE, QUERIES  # noqa: F401
from kiln.session import ensure_checkpoint_dir


def prepare(spark: SparkSession) -> None:
    """Settings every query relies on, applied only when unset."""
    if spark.conf.get("spark.sql.session.timeZone", None) in (None, ""):
        spark.conf.set("spark.sql.session.timeZone", "UTC")
    ensure_checkpoint_dir(spark)
