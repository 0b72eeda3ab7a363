"""Role tables derived from the input tables, with their DuckDB twins.

Each Spark builder has a SQL text producing the same rows, used inside the
oracle statements as a common table expression.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from kiln.tables import load

# Daily price series: one series per order priority; the price of a day is the
# total of its first order (exact in every engine, no float summation).
def daily_prices(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = load(spark, sf_dir, "orders")
    return (o.groupBy(F.col("o_orderpriority").alias("series"), F.col("o_orderdate").alias("ts"))
             .agg(F.min_by("o_totalprice", "o_orderkey").alias("price"),
                  F.max("o_totalprice").alias("high"),
                  F.min("o_totalprice").alias("low"),
                  F.count(F.lit(1)).alias("volume")))


DAILY_SQL = """daily AS (
  SELECT o_orderpriority AS series, o_orderdate AS ts,
         arg_min(o_totalprice, o_orderkey) AS price, max(o_totalprice) AS high,
         min(o_totalprice) AS low, count(*) AS volume
  FROM orders GROUP BY o_orderpriority, o_orderdate)"""


# Hourly OHLCV bars: one series per event type.  ``ts`` is unique, so open and
# close are unambiguous.
def hourly_bars(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = load(spark, sf_dir, "events")
    return (e.groupBy(F.col("event_type").alias("series"),
                      F.date_trunc("hour", "ts").alias("ts"))
             .agg(F.min_by("value", "ts").alias("open"),
                  F.max("value").alias("high"),
                  F.min("value").alias("low"),
                  F.max_by("value", "ts").alias("close"),
                  F.count(F.lit(1)).alias("volume")))


BARS_SQL = """bars AS (
  SELECT event_type AS series, date_trunc('hour', ts) AS ts,
         arg_min(value, ts) AS open, max(value) AS high, min(value) AS low,
         arg_max(value, ts) AS close, count(*) AS volume
  FROM events GROUP BY event_type, date_trunc('hour', ts))"""


# Bars with holes: close is removed on a fixed key rule so fills have work.
def holed_bars(spark: SparkSession, sf_dir: str) -> DataFrame:
    b = hourly_bars(spark, sf_dir)
    hole = (F.hour("ts") % 7 == 3) | (F.dayofmonth("ts") % 9 == 4)
    return b.withColumn("close", F.when(hole, F.lit(None)).otherwise(F.col("close")))


HOLED_SQL = BARS_SQL + """,
holed AS (
  SELECT series, ts, open, high, low,
         CASE WHEN hour(ts) % 7 = 3 OR day(ts) % 9 = 4 THEN NULL ELSE close END AS close,
         volume
  FROM bars)"""
