"""Sinks (K1-K7)."""

from __future__ import annotations

import json
from collections.abc import Sequence

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


# K1 -------------------------------------------------------------------------
def write_chunks(df: DataFrame, path: str, fmt: str = "parquet", rows_per_file: int = 50_000,
                 mode: str = "errorifexists") -> None:
    """Chunked output: files of at most ``rows_per_file`` rows, written by all tasks."""
    w = df.write.mode(mode).option("maxRecordsPerFile", rows_per_file)
    if fmt == "csv":
        w = w.option("header", True)
    w.format(fmt).save(path)


# K2 -------------------------------------------------------------------------
def prediction_frame(df: DataFrame, id_col: str, pred_col: str, target: str,
                     as_bool: bool = False) -> DataFrame:
    """Id + prediction; null predictions -> 0.5; optional boolean cast (non-zero = true)."""
    p = F.coalesce(F.col(pred_col).cast("double"), F.lit(0.5))
    if as_bool:
        p = p != 0
    return df.select(F.col(id_col), p.alias(target))


def write_predictions(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").option("header", True).csv(path)


# K3 -------------------------------------------------------------------------
def write_rejected(rejected: DataFrame, path: str) -> None:
    rejected.write.mode("append").json(path)


# K4 -------------------------------------------------------------------------
REGISTRY_SCHEMA = T.StructType([
    T.StructField("version", T.StringType()),
    T.StructField("version_no", T.LongType()),
    T.StructField("description", T.StringType()),
    T.StructField("target", T.StringType()),
    T.StructField("config", T.StringType()),
])


def claim(spark: SparkSession, path: str) -> bool:
    """Create an empty file unless it exists; of any number of writers exactly one is told that it did.

    The file system decides: an exclusive create of the local system, otherwise of
    the Hadoop file system (HDFS; object stores whose puts can be conditional)."""
    jvm = spark._jvm
    hadoop = jvm.org.apache.hadoop.fs.Path(path)
    fs = hadoop.getFileSystem(spark._jsc.hadoopConfiguration())
    try:
        if fs.getUri().getScheme() == "file":       # Hadoop's local create checks first and creates then
            none = spark.sparkContext._gateway.new_array(jvm.java.nio.file.attribute.FileAttribute, 0)
            file = jvm.java.nio.file.Paths.get(fs.makeQualified(hadoop).toUri())
            jvm.java.nio.file.Files.createDirectories(file.getParent(), none)
            jvm.java.nio.file.Files.createFile(file, none)
        else:
            fs.create(hadoop, False).close()
    except Py4JJavaError as e:
        if "AlreadyExists" in e.java_exception.getClass().getName():
            return False
        raise
    return True


def _claimed(spark: SparkSession, path: str) -> int:
    """The highest number claimed so far."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    fs = folder.getFileSystem(spark._jsc.hadoopConfiguration())
    if not fs.exists(folder):
        return 0
    names = (f.getPath().getName() for f in fs.listStatus(folder))
    return max((int(n) for n in names if n.isdigit()), default=0)


def register_version(spark: SparkSession, path: str, description: str, target: str,
                     config: dict | None = None) -> str:
    """Claim the next free version at ``path`` and return its name.

    A number belongs to the writer whose create of its claim file succeeded; the
    others go on to the next.  A writer that dies after its claim leaves a number
    unused, never one used twice."""
    number = max(_claimed(spark, f"{path}/_claims"), _latest(spark, path)) + 1
    while not claim(spark, f"{path}/_claims/{number}"):
        number += 1
    row = spark.createDataFrame([(f"v{number}", number, description, target, json.dumps(config or {}, sort_keys=True))], REGISTRY_SCHEMA)
    row.coalesce(1).write.mode("overwrite").parquet(f"{path}/entry={number}")
    return f"v{number}"


def _latest(spark: SparkSession, path: str) -> int:
    """The highest number of an entry; those from before there were claims have none."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    fs = folder.getFileSystem(spark._jsc.hadoopConfiguration())
    if not fs.exists(folder):
        return 0
    names = (f.getPath().getName() for f in fs.listStatus(folder))
    return max((int(n[6:]) for n in names if n.startswith("entry=") and n[6:].isdigit()), default=0)


# K5 -------------------------------------------------------------------------
def save_model(model, path: str) -> None:
    model.write().overwrite().save(path)


def load_pipeline(path: str):
    from pyspark.ml import PipelineModel
    return PipelineModel.load(path)


# K6 -------------------------------------------------------------------------
# Metric name prefixes kept from a backtest and strategies skipped.
ALLOWED_METRIC_PREFIXES = ("Win Rate", "Buy Wins", "Short Wins", "Total Return",
                           "Total Trades", "Sharpe Ratio")
BASELINE_STRATEGIES = ("Perfect Foresight", "Hold Benchmark")


def metric_rows(metrics: DataFrame, strategy: str = "strategy", metric: str = "metric",
                value: str = "value", keep: Sequence[str] = ()) -> DataFrame:
    """Long metrics table (strategy, metric, value) -> (key, value) rows to log:
    baselines dropped, only allowed prefixes, key ``{last word}.{metric_}``
    sanitised (characters other than word, space, ``- . : /`` removed)."""
    s, m = F.col(strategy), F.trim(F.col(metric))
    baseline = F.lit(False)
    for b in BASELINE_STRATEGIES:
        baseline = baseline | F.contains(s, F.lit(b))
    allowed = F.lit(False)
    for a in ALLOWED_METRIC_PREFIXES:
        allowed = allowed | F.startswith(m, F.lit(a))
    last_word = F.element_at(F.split(F.trim(s), r"\s+"), -1)
    key = F.concat(last_word, F.lit("."), F.regexp_replace(F.col(metric), " ", "_"))
    key = F.regexp_replace(key, r"[^\w\s\-.:/]", "")
    return (metrics.filter(~baseline & allowed)
                   .select(*keep, s.alias("strategy"), key.alias("key"), F.col(value).cast("double").alias("value")))


def append_metrics(rows: DataFrame, path: str, run: str, column: str = "run") -> None:
    """Append metric rows to a run log, each marked with its run."""
    rows.withColumn(column, F.lit(run)).write.mode("append").parquet(path)


# K7 -------------------------------------------------------------------------
def write_csv(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").option("header", True).csv(path)

