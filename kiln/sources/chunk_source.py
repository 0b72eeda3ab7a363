"""Chunk files as a data source of their own (U5): ``spark.read.format("kiln_chunks")``.

A user's format is one function from a file to Arrow batches.  The source plans a
partition per chunk file, so chunks are read in parallel; comparisons on the
chunk number are pushed to the planner, so other chunks are not even opened; as
a stream, an offset is the number of chunks seen, and a trigger takes at most
``chunksPerTrigger`` of them.

Options: ``path`` (a folder that all executors reach, plain or as a URI),
``chunkFormat`` (a registered format), ``pattern`` (of file names, whose first
number is the chunk's).  Columns: those of the schema that the reader is given,
and ``chunk_no``.  Defined results: chunks come in order of number, then path; a
file without a number has the number null and is read unless a filter excludes
nulls; columns that a file lacks are null; an empty folder has no rows; a chunk
that arrives after its stream has passed its place is not seen.
"""

from __future__ import annotations

import io
import json
import re
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from itertools import islice

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import datasource as D
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from kiln.session import reachable

NUMBER = "chunk_no"
Reader = Callable[..., Iterator[pa.RecordBatch]]
FORMATS: dict[str, Reader] = {}


def register_format(name: str):
    """Register ``fn(file, columns)``, which yields Arrow batches of an open binary file; the module that does so must be
    importable where tasks run."""
    def deco(fn: Reader) -> Reader:
        FORMATS[name] = fn
        return fn
    return deco


@register_format("csv")
def _csv(file, columns: list[str]) -> Iterator[pa.RecordBatch]:
    from pyarrow import csv
    yield from csv.open_csv(file)


@register_format("parquet")
def _parquet(file, columns: list[str]) -> Iterator[pa.RecordBatch]:
    from pyarrow import parquet
    table = parquet.ParquetFile(file)
    yield from table.iter_batches(columns=[c for c in columns if c in table.schema_arrow.names])


@register_format("jsonl")
def _jsonl(file, columns: list[str]) -> Iterator[pa.RecordBatch]:
    lines = (json.loads(line) for line in io.BufferedReader(file) if line.strip())
    while rows := list(islice(lines, 10_000)):
        names = dict.fromkeys(name for row in rows for name in row)
        yield pa.RecordBatch.from_pydict({name: [row.get(name) for row in rows] for name in names})


@dataclass
class Chunk(D.InputPartition):
    path: str
    number: int | None

    def __init__(self, path: str, number: int | None):
        super().__init__((path, number))
        self.path, self.number = path, number


def _store(path: str):
    from pyarrow import fs
    return fs.FileSystem.from_uri(path) if "://" in path or path.startswith("file:") else (fs.LocalFileSystem(), path)


def list_chunks(path: str, pattern: str) -> list[Chunk]:
    """Chunk files below a folder; hidden files and folders are not chunks."""
    from pyarrow import fs
    store, root = _store(path)
    found = []
    for info in store.get_file_info(fs.FileSelector(root, recursive=True, allow_not_found=True)):
        name = info.path[len(root):].lstrip("/")
        if info.type == fs.FileType.File and re.search(pattern, name) and not re.search(r"(^|/)[._]", name):
            number = re.search(r"\d+", name)
            found.append(Chunk(info.path, int(number.group()) if number else None))
    return sorted(found, key=lambda c: (c.number is None, c.number or 0, c.path))


_TESTS = {D.EqualTo: lambda a, b: a == b, D.GreaterThan: lambda a, b: a > b, D.GreaterThanOrEqual: lambda a, b: a >= b,
          D.LessThan: lambda a, b: a < b, D.LessThanOrEqual: lambda a, b: a <= b, D.In: lambda a, b: a in b}


class _Reading:
    """What the batch and the stream reader share: a chunk as Arrow batches of the asked schema."""

    def __init__(self, schema: T.StructType, options: dict):
        self.schema, self.path = schema, options["path"]
        self.format, self.pattern = options.get("chunkFormat", "parquet"), options.get("pattern", ".")
        if self.format not in FORMATS:
            raise ValueError(f"unknown chunk format {self.format}; known: {sorted(FORMATS)}")

    def read(self, partition: Chunk | None) -> Iterator[pa.RecordBatch]:
        if partition is None:       # what Spark plans where there are no chunks
            return
        target = to_arrow_schema(self.schema)
        with _store(self.path)[0].open_input_file(partition.path) as file:
            for batch in FORMATS[self.format](file, target.names):
                columns = []
                for field in target:
                    if field.name == NUMBER:
                        columns.append(pa.array([partition.number] * batch.num_rows, field.type))
                    elif field.name in batch.schema.names:
                        columns.append(batch.column(field.name).cast(field.type))
                    else:
                        columns.append(pa.nulls(batch.num_rows, field.type))
                yield pa.RecordBatch.from_arrays(columns, schema=target)


class ChunkReader(_Reading, D.DataSourceReader):
    def __init__(self, schema: T.StructType, options: dict):
        super().__init__(schema, options)
        self.filters: list = []

    def pushFilters(self, filters: list) -> Iterator:
        """Keeps comparisons on the chunk number; the rest is Spark's."""
        for f in filters:
            if getattr(f, "attribute", None) == (NUMBER,) and type(f) in _TESTS:
                self.filters.append(f)
            elif isinstance(f, D.IsNotNull) and f.attribute == (NUMBER,):
                self.filters.append(f)
            else:
                yield f

    def _wanted(self, chunk: Chunk) -> bool:
        return all(chunk.number is not None and (isinstance(f, D.IsNotNull) or _TESTS[type(f)](chunk.number, f.value))
                   for f in self.filters)

    def partitions(self) -> list[Chunk]:
        return [c for c in list_chunks(self.path, self.pattern) if self._wanted(c)]


class ChunkStreamReader(_Reading, D.DataSourceStreamReader):
    """Offsets count chunks in order; a restart reads the same chunks for the same offsets."""

    def __init__(self, schema: T.StructType, options: dict):
        super().__init__(schema, options)
        self.each = int(options.get("chunksPerTrigger", "0"))      # 0: all
        self.seen: int | None = None

    def initialOffset(self) -> dict:
        return {"chunks": 0}

    def latestOffset(self) -> dict:
        """One trigger further than the last offset, as far as there are chunks."""
        total = len(list_chunks(self.path, self.pattern))
        self.seen = min(total, (self.seen or 0) + (self.each or total))
        return {"chunks": self.seen}

    def partitions(self, start: dict, end: dict) -> list[Chunk]:
        self.seen = max(self.seen or 0, end["chunks"])
        return list_chunks(self.path, self.pattern)[start["chunks"]:end["chunks"]]

    def commit(self, end: dict) -> None:
        self.seen = max(self.seen or 0, end["chunks"])


class ChunkSource(D.DataSource):
    @classmethod
    def name(cls) -> str:
        return "kiln_chunks"

    def schema(self) -> str:
        raise ValueError("kiln_chunks needs a schema: spark.read.format(...).schema(...)")

    def reader(self, schema: T.StructType) -> ChunkReader:
        return ChunkReader(schema, self.options)

    def streamReader(self, schema: T.StructType) -> ChunkStreamReader:
        return ChunkStreamReader(schema, self.options)


def register(spark: SparkSession) -> None:
    reachable(spark)
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")
    spark.dataSource.register(ChunkSource)


def _with_number(schema: str | T.StructType) -> T.StructType:
    schema = T.StructType.fromDDL(schema) if isinstance(schema, str) else T.StructType(list(schema.fields))
    return schema if NUMBER in schema.names else schema.add(NUMBER, T.LongType())


def read_chunk_source(spark: SparkSession, path: str, schema: str | T.StructType, chunk_format: str = "parquet", pattern: str = ".") -> DataFrame:
    """All chunks below ``path``; one partition each."""
    register(spark)
    return spark.read.format("kiln_chunks").schema(_with_number(schema)).option("chunkFormat", chunk_format).option(
        "pattern", pattern).load(path)


def stream_chunk_source(spark: SparkSession, path: str, schema: str | T.StructType, chunk_format: str = "parquet", pattern: str = ".",
                        per_trigger: int = 0) -> DataFrame:
    """The same as a stream, at most ``per_trigger`` chunks a batch (0: all that are there)."""
    register(spark)
    return spark.readStream.format("kiln_chunks").schema(_with_number(schema)).option("chunkFormat", chunk_format).option(
        "pattern", pattern).option("chunksPerTrigger", per_trigger).load(path)
