"""One pass over a table that leaves one array.

Iterative fits need the same thing of every pass: each task adds up its own
statistics as one flat array, the arrays of all tasks are added in slices (so no
task and no shuffle row holds more than a slice of each), and only the sum
reaches the driver, whose size is that of the model and not of the table.
Slices are added in the order of the tasks, so a pass that runs again gives the
same sum.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

SLICE = 8192            # numbers of an array that are added by one task


def vectors(column: pa.Array) -> np.ndarray:
    """A column of equally long arrays as rows."""
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.float64, copy=False).reshape(len(column), -1)


def array_sum(df: DataFrame, task: Callable[[Iterator[pa.RecordBatch]], np.ndarray | None]) -> np.ndarray | None:
    """The sum over all tasks of the array that ``task`` makes of its batches (None: nothing to add)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = task(batches)
        if own is None:
            return
        own = np.ascontiguousarray(own, dtype="<f8")
        number = TaskContext.get().partitionId()
        for at, low in enumerate(range(0, len(own), SLICE)):
            yield pa.RecordBatch.from_arrays([pa.array([at], pa.int32()), pa.array([number], pa.int32()),
                                              pa.array([own[low:low + SLICE].tobytes()], pa.binary())], names=["at", "task", "v"])

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[int, np.ndarray] = {}
        for b in batches:
            for at, v in zip(b.column("at").to_pylist(), b.column("v"), strict=True):
                v = np.frombuffer(v.as_buffer(), dtype="<f8")
                sums[at] = sums[at] + v if at in sums else v.copy()
        yield pa.RecordBatch.from_arrays([pa.array(list(sums), pa.int32()), pa.array([v.tobytes() for v in sums.values()], pa.binary())],
                                         names=["at", "v"])

    parts = df.mapInArrow(run, "at int, task int, v binary").repartition("at").sortWithinPartitions("at", "task")
    rows = sorted(parts.mapInArrow(add, "at int, v binary").collect())      # one row per slice
    return np.concatenate([np.frombuffer(r["v"], dtype="<f8") for r in rows]) if rows else None


def added(batches: Iterator[pa.RecordBatch], fn: Callable[[pa.RecordBatch], np.ndarray]) -> np.ndarray | None:
    """The sum of ``fn`` over the batches of a task that hold rows."""
    total = None
    for b in batches:
        if b.num_rows:
            own = fn(b)
            total = own if total is None else total + own
    return total


def moments(df: DataFrame, vec: str) -> tuple[int, np.ndarray, np.ndarray]:
    """(rows, mean, population covariance) of an array column.

    Sums are of differences from one row of the table, so that a mean far from
    zero cancels nothing."""
    x = df.select(F.col(vec).cast("array<double>").alias("v"))
    first = x.head()
    if first is None:
        return 0, np.zeros(0), np.zeros((0, 0))
    origin = np.array(first["v"], dtype=float)

    def own(b: pa.RecordBatch) -> np.ndarray:
        y = vectors(b.column(0)) - origin
        return np.concatenate(([len(y)], y.sum(axis=0), (y.T @ y).ravel()))

    sums, d = array_sum(x, lambda batches: added(batches, own)), len(origin)
    n = sums[0]
    mean = sums[1:d + 1] / n
    return int(n), origin + mean, sums[d + 1:].reshape(d, d) / n - np.outer(mean, mean)
