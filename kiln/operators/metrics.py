"""Named metrics (U4) and metrics of the user's own.

A metric is a function from the truth and prediction columns to an aggregate
expression; all asked-for metrics of a group are one Spark aggregate.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

Metric = Callable[[Column, Column], Column]

METRICS: dict[str, Metric] = {}


def metric(name: str) -> Callable[[Metric], Metric]:
    """Register an aggregate under ``name``; a later registration replaces an earlier one."""
    def deco(fn: Metric) -> Metric:
        METRICS[name] = fn
        return fn
    return deco


@metric("accuracy")
def accuracy(y: Column, p: Column) -> Column:
    return F.avg((y == p).cast("double"))


@metric("mean_absolute_error")
def mean_absolute_error(y: Column, p: Column) -> Column:
    return F.avg(F.abs(p - y))


@metric("root_mean_squared_error")
def root_mean_squared_error(y: Column, p: Column) -> Column:
    return F.sqrt(F.avg((p - y) * (p - y)))


@metric("r2")
def r2(y: Column, p: Column) -> Column:
    return 1 - F.try_divide(F.avg((p - y) * (p - y)), F.var_pop(y))


def evaluate(df: DataFrame, y: str, prediction: str, names: Sequence[str], group: Sequence[str] = (),
             own: dict[str, Metric] | None = None) -> DataFrame:
    """(group columns, metric, value): registered metrics by name and the caller's ``own``."""
    chosen = {n: METRICS[n] for n in names} | (own or {})
    row = df.groupBy(*group).agg(*[f(F.col(y), F.col(prediction)).cast("double").alias(n) for n, f in chosen.items()])
    return row.unpivot(list(group), list(chosen), "metric", "value")
