"""File sources."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

FORMATS = ("parquet", "csv", "json", "orc")
CHUNK_NAME = r"(?<![^/])((?:[^/=]++=[^/]++/)*+[^/]++)$"


def _has_files(spark: SparkSession, path: str) -> bool:
    """Existence check through the Hadoop file system (works for any scheme)."""
    jvm = spark.sparkContext._jvm
    hpath = jvm.org.apache.hadoop.fs.Path(path)
    fs = hpath.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return fs.exists(hpath)


# S1 -------------------------------------------------------------------------
def read_csv(spark: SparkSession, path: str, schema: T.StructType | str | None = None,
             header: bool = True) -> DataFrame:
    """CSV scan of every file under ``path`` with a header.  Types come from
    ``schema`` when given (needed for sources read twice), else are inferred."""
    if not _has_files(spark, path):
        raise FileNotFoundError(f"No CSV files found in {path}")
    r = spark.read.option("header", header).option("mode", "PERMISSIVE")
    r = r.schema(schema) if schema is not None else r.option("inferSchema", True)
    return r.csv(path)


# S2 -------------------------------------------------------------------------
def read_csv_stream(spark: SparkSession, path: str, schema: T.StructType | str,
                    files_per_batch: int = 1) -> DataFrame:
    """Chunked CSV input as a stream: one micro-batch per ``files_per_batch`` files."""
    return (spark.readStream.schema(schema).option("header", True)
            .option("maxFilesPerTrigger", files_per_batch).csv(path))


# S3 -------------------------------------------------------------------------
def read_chunks(spark: SparkSession, path: str, fmt: str = "parquet",
                pattern: str = "merged_chunk_*", schema: T.StructType | str | None = None) -> DataFrame:
    """All chunk files of one format in ``path`` with ``chunk`` (file name) and
    ``chunk_no`` (first number in the name).  Missing folder or format -> error;
    empty files contribute no rows."""
    if fmt not in FORMATS:
        raise ValueError(f"Unsupported file format: {fmt}")
    if not _has_files(spark, path):
        raise FileNotFoundError(f"Chunk directory not found: {path}")
    r = spark.read.format(fmt).option("pathGlobFilter", f"{pattern}").option("recursiveFileLookup", True)
    if fmt == "csv":
        r = r.option("header", True)
        r = r.schema(schema) if schema is not None else r.option("inferSchema", True)
    elif schema is not None:
        r = r.schema(schema)
    df = r.load(path)
    # the file, with the partition folders it lies in; tried at the start of a folder only, and nothing is tried twice
    name = F.regexp_extract(F.col("_metadata.file_path"), CHUNK_NAME, 1)
    return df.withColumns({"chunk": name,
                           "chunk_no": F.regexp_extract(name, r"(\d+)", 1).cast("long")})


def first_chunks(df: DataFrame, n: int) -> DataFrame:
    """O3: rows of the first ``n`` chunks in file-name order (small file table)."""
    files = df.select("chunk").distinct()
    first = files.orderBy("chunk").limit(n)
    return df.join(F.broadcast(first), "chunk", "left_semi")


# S4 -------------------------------------------------------------------------
# Names that mark the date column of a time-series file.
DATE_NAMES = ("date", "datetime")


def date_column(columns: Sequence[str]) -> str:
    for c in columns:
        if c.strip().lower() in DATE_NAMES:
            return c
    return columns[0]


def parse_dates(df: DataFrame, column: str | None = None, out: str = "ts") -> DataFrame:
    """Rows whose date does not parse (header junk) are dropped."""
    column = column or date_column(df.columns)
    ts = F.coalesce(F.try_to_timestamp(F.col(f"`{column}`").cast("string")),
                    F.try_to_timestamp(F.col(f"`{column}`").cast("string"), F.lit("yyyy-MM-dd")))
    d = df.withColumn("_ts", ts).filter(F.col("_ts").isNotNull())
    d = d.drop(column) if column != out else d.drop(column)
    return d.withColumnRenamed("_ts", out)


def read_timeseries_csv(spark: SparkSession, path: str) -> DataFrame:
    """CSV read as text columns, date column located and parsed, measures cast leniently."""
    raw = spark.read.option("header", True).csv(path)
    d = parse_dates(raw)
    return d.select("ts", *[F.col(f"`{c}`").try_cast("double").alias(c) for c in d.columns if c != "ts"])


# S5 -------------------------------------------------------------------------
def source_profile(df: DataFrame, ts: str = "ts") -> DataFrame:
    """Row count and date extent per input file."""
    return (df.groupBy(F.col("_metadata.file_name").alias("file"))
              .agg(F.count(F.lit(1)).alias("rows"), F.min(ts).alias("min_ts"), F.max(ts).alias("max_ts")))


# S6 -------------------------------------------------------------------------
def build_once(df: DataFrame, path: str, fmt: str = "parquet") -> DataFrame:
    """Write ``df`` only if ``path`` is absent, then read the stored copy."""
    df.write.mode("ignore").format(fmt).save(path)
    return df.sparkSession.read.format(fmt).load(path)


# S7 -------------------------------------------------------------------------
def drop_known_targets(df: DataFrame, targets: Sequence[str]) -> DataFrame:
    """Scan without a target: known target names with bool/text type are removed."""
    drop = [f.name for f in df.schema.fields
            if f.name in targets and isinstance(f.dataType, (T.BooleanType, T.StringType))]
    return df.drop(*drop)
