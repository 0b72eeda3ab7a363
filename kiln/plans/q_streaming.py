"""Streaming queries (ST1-ST5, S2, U5): ``events`` cut into four chunk files
(chunk = event_id % 4), each processed as one micro-batch (availableNow)."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from kiln.operators import features as FE
from kiln.operators import quantiles as QU
from kiln.operators import schema as P
from kiln.plans.registry import query
from kiln.session import scratch_path
from kiln.sources import chunk_source as CS
from kiln.sources import files as SRC
from kiln.sources import sinks as K
from kiln.streaming import chunked as ST
from kiln.tables import load

N_CHUNKS = 4


def chunk_folder(spark, sf_dir, fmt: str = "parquet"):
    """Input of the streams: the events dealt to chunk folders in one job, as many
    files per chunk as tasks wrote rows of it."""
    path = scratch_path(spark, f"event-chunks-{uuid.uuid4().hex}")
    e = load(spark, sf_dir, "events").withColumn("chunk", (F.col("event_id") % N_CHUNKS).cast("int"))
    w = e.write.partitionBy("chunk")
    (w.option("header", True).csv(path) if fmt == "csv" else w.parquet(path))
    return path, e.schema


@query("st01_stream_etl", """
WITH f AS (SELECT avg(value) AS m, stddev_pop(value) AS s, list(DISTINCT event_type ORDER BY event_type) AS cats
           FROM events WHERE event_id % 4 = 0)
SELECT CAST(list_position(cats, event_type) - 1 AS INTEGER) AS type_code, count(*) AS n,
       round(sum((value - m) / s), 6) + 0.0 AS scaled_sum
FROM events, f GROUP BY 1""", covers=("ST1", "F8", "F11"))
def stream_etl(spark, sf_dir):
    path, schema = chunk_folder(spark, sf_dir)
    first = spark.read.parquet(path).filter("chunk = 0")  # fit on the first chunk only
    model = FE.chain(FE.CategoryCodes(["event_type"], prefix="type_code_"),
                     FE.Scaler(["value"], "standard")).fit(first)
    out = ST.stream_transform(spark, path, schema, model)
    return out.groupBy(F.col("type_code_event_type").alias("type_code")).agg(
        F.count(F.lit(1)).alias("n"), (F.round(F.sum("value"), 6) + F.lit(0.0)).alias("scaled_sum"))


VALIDATE = {"value": "double", "k": "int"}


@query("st02_stream_validation", """
WITH t AS (SELECT CASE WHEN event_id % 17 = 0 THEN NULL ELSE CAST(value AS VARCHAR) END AS value,
                  CASE WHEN event_id % 13 = 0 THEN 'x' ELSE regexp_extract(props, '([0-9]+)', 1) END AS k FROM events),
e AS (SELECT *, CASE WHEN value IS NULL THEN 'Missing value in value'
                     WHEN TRY_CAST(trim(value) AS DOUBLE) IS NULL THEN 'could not convert string to float: ''' || value || ''''
                     WHEN k IS NULL THEN 'Missing value in k'
                     WHEN TRY_CAST(trim(k) AS DOUBLE) IS NULL THEN 'invalid literal for int() with base 10: ''' || k || ''''
                END AS error FROM t)
SELECT coalesce(error, 'valid') AS outcome, count(*) AS n FROM e GROUP BY 1""", covers=("ST2", "P14", "K3"))
def stream_validation(spark, sf_dir):
    path, schema = chunk_folder(spark, sf_dir)

    def validate(batch):
        t = batch.select(
            F.when(F.col("event_id") % 17 == 0, F.lit(None)).otherwise(F.col("value").cast("string")).alias("value"),
            F.when(F.col("event_id") % 13 == 0, F.lit("x"))
             .otherwise(F.regexp_extract("props", "([0-9]+)", 1)).alias("k"))
        return P.validate_rows(t, VALIDATE)
    valid, rejected = ST.stream_validate(spark, path, schema, validate)
    v = valid.agg(F.lit("valid").alias("outcome"), F.count(F.lit(1)).alias("n"))
    r = rejected.groupBy(F.col("error").alias("outcome")).agg(F.count(F.lit(1)).alias("n"))
    return v.unionByName(r)


@query("st03_progress_events", """
SELECT CAST(event_id % 4 AS INTEGER) AS chunk, step, count(*) AS rows,
       round(sum(CASE WHEN step = 'read' THEN value WHEN step = 'filter' AND value > 100 THEN value END), 6) + 0.0 AS value_sum
FROM events, (SELECT unnest(['read', 'filter']) AS step) WHERE step = 'read' OR value > 100 GROUP BY 1, 2""", covers=("ST3",))
def progress(spark, sf_dir):
    """One event per micro-batch and step, written by the batch itself."""
    path, schema = chunk_folder(spark, sf_dir)
    steps = {"read": lambda b: b, "filter": lambda b: b.filter(F.col("value") > 100)}
    metrics = {"chunk": F.max("chunk"), "rows": F.count(F.lit(1)), "value_sum": F.sum("value")}
    events = ST.stream_progress(spark, path, schema, steps, metrics)
    return events.groupBy(F.col("chunk").cast("int").alias("chunk"), "step").agg(
        F.sum("rows").cast("long").alias("rows"), (F.round(F.sum("value_sum"), 6) + F.lit(0.0)).alias("value_sum"))


@query("s02_csv_stream", """
SELECT CAST(event_id % 4 AS INTEGER) AS chunk, event_type, count(*) AS n, min(value) AS least, max(value) AS most
FROM events GROUP BY 1, 2""", covers=("S2", "K7"))
def csv_stream(spark, sf_dir):
    """Chunks read as a CSV stream; the per-type report goes out as CSV and is read back."""
    path, schema = chunk_folder(spark, sf_dir, "csv")
    stream = SRC.read_csv_stream(spark, path, schema)
    m = ST.run_metrics(stream, lambda b: b.groupBy("chunk", "event_type").agg(
        F.count(F.lit(1)).alias("n"), F.min("value").alias("least"), F.max("value").alias("most")), "csv-stream")
    report = scratch_path(spark, f"report-{uuid.uuid4().hex}")
    K.write_csv(m.groupBy("chunk", "event_type").agg(F.sum("n").alias("n"), F.min("least").alias("least"), F.max("most").alias("most")),
                report)
    return spark.read.schema("chunk int, event_type string, n long, least double, most double").option("header", True).csv(report)


@query("st04_chunk_evaluation", """
SELECT CAST(event_id % 4 AS INTEGER) AS chunk, count(*) AS n,
       sum(CASE WHEN (CASE WHEN value > 200 THEN 'purchase' ELSE 'view' END) = event_type THEN 1 ELSE 0 END) AS hits,
       round(avg(CASE WHEN (CASE WHEN value > 200 THEN 'purchase' ELSE 'view' END) = event_type THEN 1.0 ELSE 0.0 END), 9) AS accuracy
FROM events GROUP BY 1""", covers=("ST4", "E1"))
def chunk_evaluation(spark, sf_dir):
    path, schema = chunk_folder(spark, sf_dir)

    def per_batch(b):
        hit = (F.when(F.col("value") > 200, "purchase").otherwise("view") == F.col("event_type")).cast("long")
        return b.groupBy("chunk").agg(F.count(F.lit(1)).alias("n"), F.sum(hit).alias("hits"))
    m = ST.stream_metrics(spark, path, schema, per_batch)
    per = m.groupBy("chunk").agg(F.sum("n").alias("n"), F.sum("hits").alias("hits"))
    return per.withColumn("accuracy", F.round(F.col("hits") / F.col("n"), 9) + F.lit(0.0))


PROFILED = ["value", "user_id", "event_id"]


def _profile_sql() -> str:
    parts = [f"""SELECT CAST(event_id % 4 AS INTEGER) AS chunk, '{c}' AS "column", count({c}) AS n, round(avg({c}), 6) + 0.0 AS mean,
  round(stddev_samp({c}), 6) + 0.0 AS std, CAST(min({c}) AS DOUBLE) AS min, round(quantile_cont({c}, 0.25), 6) + 0.0 AS q25,
  round(quantile_cont({c}, 0.5), 6) + 0.0 AS q50, round(quantile_cont({c}, 0.75), 6) + 0.0 AS q75, CAST(max({c}) AS DOUBLE) AS max
FROM events GROUP BY 1""" for c in PROFILED]
    return " UNION ALL ".join(parts)


@query("st05_chunk_profile", _profile_sql(), covers=("ST5", "A1", "A3"))
def chunk_profile(spark, sf_dir):
    """Count, mean, spread, exact quartiles and ends of the first numeric columns (seven at most) of every chunk."""
    path, schema = chunk_folder(spark, sf_dir)
    out = ST.stream_table(spark, path, schema)
    cols = [c for c in P.numeric_columns(out) if c != "chunk"][:7]
    long = out.select("chunk", F.explode(F.array(*[F.struct(F.lit(c).alias("column"), F.col(c).cast("double").alias("x"))
                                                   for c in cols])).alias("s")).select("chunk", "s.*")
    base = long.groupBy("chunk", "column").agg(
        F.count("x").alias("n"), (F.round(F.avg("x"), 6) + F.lit(0.0)).alias("mean"),
        (F.round(F.stddev_samp("x"), 6) + F.lit(0.0)).alias("std"), F.min("x").alias("min"), F.max("x").alias("max"))
    q = QU.grouped_quantiles(long, ["chunk", "column"], "x", [0.25, 0.5, 0.75])
    quartiles = [(F.round(F.col("q")[i], 6) + F.lit(0.0)).alias(n) for i, n in enumerate(("q25", "q50", "q75"))]
    return base.join(q, ["chunk", "column"]).select("chunk", "column", "n", "mean", "std", "min", *quartiles, "max")


@query("u05_pluggable_source", """
SELECT chunk_no, count(*) AS n FROM (SELECT CAST(event_id % 4 AS BIGINT) AS chunk_no FROM events) GROUP BY 1""",
       covers=("U5", "S3", "O4"))
def pluggable_source(spark, sf_dir):
    """A named reader (``chunks``) over folders of chunk files; a chunk's number is part of its path."""
    path, _ = chunk_folder(spark, sf_dir)
    df = ST.read_source(spark, "chunks", path, fmt="parquet", pattern="*.parquet")
    return df.groupBy(F.col("chunk_no").cast("long").alias("chunk_no")).agg(F.count(F.lit(1)).alias("n"))


CHUNK_SUMS_SQL = """
SELECT CAST(event_id % 4 AS BIGINT) AS chunk_no, count(*) AS n, round(sum(value), 6) + 0.0 AS total, max(ts) AS last
FROM events WHERE event_id % 4 > 0 GROUP BY 1"""


def _chunk_sums(df):
    return df.filter("chunk_no > 0").groupBy("chunk_no").agg(
        F.count(F.lit(1)).alias("n"), (F.round(F.sum("value"), 6) + F.lit(0.0)).alias("total"), F.max("ts").alias("last"))


@query("u05_chunk_source", CHUNK_SUMS_SQL, covers=("U5", "S3"))
def chunk_source(spark, sf_dir):
    """The chunk files through the library's own data source: a partition per file, the chunk filter in its planner."""
    path, schema = chunk_folder(spark, sf_dir)
    return _chunk_sums(ST.read_source(spark, "kiln_chunks", path, schema=schema, pattern=r"\.parquet$"))


@query("u05_chunk_source_stream", CHUNK_SUMS_SQL, covers=("U5", "ST4"))
def chunk_source_stream(spark, sf_dir):
    """The same source as a stream."""
    path, schema = chunk_folder(spark, sf_dir)
    return _chunk_sums(ST.run_metrics(CS.stream_chunk_source(spark, path, schema, pattern=r"\.parquet$"), lambda b: b, "chunk-source"))
