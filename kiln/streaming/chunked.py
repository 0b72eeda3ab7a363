"""Chunked and streaming input through fitted pipelines (ST1-ST5, S2, U5).

The reference iterates over file chunks in one process.  Here a chunk is a
file of a folder read by the Structured Streaming file source
(``maxFilesPerTrigger``), every micro-batch goes through the same fitted
``PipelineModel``, and ``foreachBatch`` writes each batch to its own
``batch=<id>`` folder with overwrite, so a retried batch replaces itself
(idempotent sink).  Checkpoints live under the shared ``spark.checkpoint.dir``.
"""

from __future__ import annotations

import os
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from kiln.session import scratch_path


def _paths(spark: SparkSession, name: str) -> tuple[str, str]:
    base = scratch_path(spark, f"{name}-{uuid.uuid4().hex}")
    return os.path.join(base, "out"), os.path.join(base, "_checkpoint")


def batch_writer(path: str, transform: Callable[[DataFrame, int], DataFrame] | None = None):
    """foreachBatch function writing each batch to ``path/batch=<id>`` (overwrite)."""
    def fn(batch: DataFrame, batch_id: int) -> None:
        out = transform(batch, batch_id) if transform else batch
        out.write.mode("overwrite").parquet(os.path.join(path, f"batch={batch_id}"))
    return fn


def run_available(stream: DataFrame, fn, checkpoint: str):
    """Process every file available now, one trigger per chunk, then stop."""
    q = (stream.writeStream.foreachBatch(fn).option("checkpointLocation", checkpoint)
         .trigger(availableNow=True).start())
    q.awaitTermination()
    return q


# ST1 ------------------------------------------------------------------------
def stream_transform(spark: SparkSession, source: str, schema, model, files_per_batch: int = 1,
                     fmt: str = "parquet") -> DataFrame:
    """Apply a fitted (stateless) pipeline model to every chunk of ``source``;
    returns the table of all transformed batches."""
    out, ck = _paths(spark, "stream-etl")
    stream = (spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_batch)
              .format(fmt).load(source))
    run_available(stream, batch_writer(out, lambda b, _: model.transform(b)), ck)
    return spark.read.parquet(out).drop("batch")


# ST2 ------------------------------------------------------------------------
def stream_validate(spark: SparkSession, source: str, schema, validate, files_per_batch: int = 1
                    ) -> tuple[DataFrame, DataFrame]:
    """Split every chunk into valid and rejected rows written to two sinks."""
    base = scratch_path(spark, f"stream-validate-{uuid.uuid4().hex}")
    good, bad, ck = (os.path.join(base, p) for p in ("valid", "rejected", "_checkpoint"))

    def fn(batch: DataFrame, batch_id: int) -> None:
        valid, rejected = validate(batch)
        valid.write.mode("overwrite").parquet(os.path.join(good, f"batch={batch_id}"))
        rejected.write.mode("overwrite").parquet(os.path.join(bad, f"batch={batch_id}"))
    stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_batch).parquet(source)
    run_available(stream, fn, ck)
    return spark.read.parquet(good).drop("batch"), spark.read.parquet(bad).drop("batch")


# ST3 ------------------------------------------------------------------------
def stream_progress(spark: SparkSession, source: str, schema, steps: dict[str, Callable[[DataFrame], DataFrame]],
                    metrics: dict[str, F.Column], files_per_batch: int = 1) -> DataFrame:
    """One event (batch_id, step, metrics) per micro-batch and step.

    ``steps`` run one after the other on every batch and are observed on the way:
    the batch is computed once, whatever the number of steps, and each step's
    metrics are taken from the rows that pass it.  A batch writes its own events,
    so none is lost however many batches there are, and a batch that runs again
    replaces them."""
    out, ck = _paths(spark, "stream-progress")
    stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_batch).parquet(source)

    def fn(batch: DataFrame, batch_id: int) -> None:
        seen = {}
        for name, step in steps.items():
            seen[name] = Observation(f"{name}-{batch_id}")
            batch = step(batch).observe(seen[name], *[v.alias(k) for k, v in metrics.items()])
        kinds = T.StructType([T.StructField("step", T.StringType())] + [
            T.StructField(k, kind.dataType) for k, kind in zip(metrics, batch.agg(*metrics.values()).schema, strict=True)])
        batch.write.format("noop").mode("overwrite").save()
        rows = [(name, *[o.get.get(k) for k in metrics]) for name, o in seen.items()]
        events = batch.sparkSession.createDataFrame(rows, kinds).coalesce(1)
        events.withColumn("batch_id", F.lit(batch_id)).write.mode("overwrite").parquet(os.path.join(out, f"batch={batch_id}"))
    run_available(stream, fn, ck)
    return spark.read.parquet(out).drop("batch")


# ST4 / ST5 --------------------------------------------------------------------
def run_metrics(stream: DataFrame, per_batch: Callable[[DataFrame], DataFrame], name: str,
                keep_batch: bool = False) -> DataFrame:
    """Run ``per_batch`` on every micro-batch; the table of all results."""
    out, ck = _paths(stream.sparkSession, name)
    run_available(stream, batch_writer(out, lambda b, i: per_batch(b).withColumn("batch_id", F.lit(i))), ck)
    df = stream.sparkSession.read.parquet(out).drop("batch")
    return df if keep_batch else df.drop("batch_id")


def stream_metrics(spark: SparkSession, source: str, schema, per_batch: Callable[[DataFrame], DataFrame],
                   files_per_batch: int = 1) -> DataFrame:
    """Per-chunk metrics table: ``per_batch`` aggregates one micro-batch (e.g.
    evaluation or profile operators); the overall figure is an aggregate over
    this table."""
    stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_batch).parquet(source)
    return run_metrics(stream, per_batch, "stream-metrics", keep_batch=True)


def stream_table(spark: SparkSession, source: str, schema, files_per_batch: int = 1) -> DataFrame:
    """All chunks of a stream as one table."""
    stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_batch).parquet(source)
    return run_metrics(stream, lambda b: b, "stream-table")


# U5 -------------------------------------------------------------------------
SOURCES: dict[str, Callable[..., DataFrame]] = {}


def register_source(name: str):
    """Pluggable batch source: a reader function registered by name."""
    def deco(fn):
        SOURCES[name] = fn
        return fn
    return deco


@register_source("csv")
def _csv(spark, path, **kw):
    from kiln.sources.files import read_csv
    return read_csv(spark, path, **kw)


@register_source("chunks")
def _chunks(spark, path, **kw):
    from kiln.sources.files import read_chunks
    return read_chunks(spark, path, **kw)


@register_source("kiln_chunks")
def _chunk_source(spark, path, **kw):
    from kiln.sources.chunk_source import read_chunk_source
    return read_chunk_source(spark, path, **kw)


def read_source(spark: SparkSession, name: str, path: str, **kw) -> DataFrame:
    return SOURCES[name](spark, path, **kw)
