"""Helpers shared by the text operators."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterable, Iterator
from typing import Any

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from kiln.session import ensure_checkpoint_dir, reachable


def written(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` below the shared folder and read it back: cuts lineage, survives lost executors."""
    spark = df.sparkSession
    path = f"{ensure_checkpoint_dir(spark)}/kiln-llm/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def id_remainder(doc_id: str | Column, n: int) -> Column:
    """crc32 of the id as text, modulo ``n`` (null id: 0)."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string") if isinstance(doc_id, str) else doc_id.cast("string")) % n,
                      F.lit(0))


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    reachable(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def chunks(texts: Iterable[str | None], chars: int) -> Iterator[list[str]]:
    """Consecutive lists of texts (null: empty) of about ``chars`` characters each, at least one text."""
    out: list[str] = []
    size = 0
    for t in texts:
        t = t if isinstance(t, str) else ""
        out.append(t)
        size += len(t) + 16
        if size >= chars:
            yield out
            out, size = [], 0
    if out:
        yield out


_ARROW = {"long": "int64", "int": "int32", "double": "float64", "string": "string", "boolean": "bool_",
          "binary": "binary"}


def map_texts(df: DataFrame, text_col: str, carry: dict[str, str], columns: dict[str, str],
              fn: Callable[[list[str]], dict[str, Any]], chars: int = 1_000_000) -> DataFrame:
    """Apply ``fn`` to lists of whole texts (null: empty) of about ``chars`` characters.

    ``carry`` maps output names to input columns that go through unchanged;
    ``columns`` maps further output names to types.  ``fn`` returns a sequence
    per column, and under ``at`` the index of each row's text unless every text
    gives one row.
    """
    fields = {f.name: f.dataType.simpleString() for f in df.select(*[
        F.col(f"`{c}`").alias(n) for n, c in carry.items()]).schema}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column(batch.num_columns - 1)
            first = 0
            for part in chunks((t.as_py() for t in texts), chars):
                got = fn(part)
                at = got.get("at")
                own = batch.slice(first, len(part))
                first += len(part)
                arrays = [own.column(i) if at is None else own.column(i).take(pa.array(at, pa.int64()))
                          for i in range(len(fields))]
                arrays += [pa.array(got[c], getattr(pa, _ARROW[kind])()) for c, kind in columns.items()]
                yield pa.RecordBatch.from_arrays(arrays, names=[*fields, *columns])

    taken = df.select(*[F.col(f"`{c}`").alias(n) for n, c in carry.items()],
                      F.col(f"`{text_col}`").cast("string").alias("__text"))
    schema = ", ".join(f"`{n}` {kind}" for n, kind in [*fields.items(), *columns.items()])
    return taken.mapInArrow(run, schema)


def distinct_counts(df: DataFrame, label: str, text: str = "text") -> dict[Any, int]:
    """Different texts of every label, told apart by a hash (only hashes are shuffled)."""
    return {r[label]: r["n"] for r in df.select(label, F.xxhash64(text).alias("__hash")).distinct()
            .groupBy(label).agg(F.count(F.lit(1)).alias("n")).collect()}


def bounded_sample(df: DataFrame, label: str, sizes: dict[Any, float], text: str = "text") -> DataFrame:
    """(label, text): about ``sizes`` different texts of every label (all of a smaller one), chosen by their hash.

    Copies count once, in the choice and in the sample, so its size does not grow with them.
    """
    share = F.lit(0.0)
    for value, n in distinct_counts(df, label, text).items():
        share = F.when(F.col(label) == F.lit(value), F.lit(min(1.0, sizes[value] / n))).otherwise(share)
    return df.where(F.pmod(F.xxhash64(F.lit("sample"), text), F.lit(1_000_000)) < share * 1_000_000).select(
        label, text).distinct()
