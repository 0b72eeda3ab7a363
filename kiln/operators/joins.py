"""Join operators (J1-J10).  J11 lives with the text features, J12 with k-NN."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from kiln.operators import series as S


def lookup_join(fact: DataFrame, dim: DataFrame, on: Sequence[str] | str, how: str = "left") -> DataFrame:
    """Fact joined with a dimension.  No hint: the optimizer broadcasts
    the dimension when its measured bytes allow it, and splits hot keys otherwise."""
    return fact.join(dim, on, how)


def outer_align(frames: dict[str, DataFrame], on: str = "ts", value: str = "value") -> DataFrame:
    """N series (on, value) side by side on ``on`` (full outer on all).

    One shuffle: union in long form, then one aggregate with a column per name
    (instead of N-1 chained full outer joins).  A series that repeats a key has
    no single row to align and is refused."""
    parts = [df.select(F.col(on), F.lit(name).alias("_name"), F.col(value).cast("double").alias("_v"))
             for name, df in frames.items()]
    long = parts[0]
    for p in parts[1:]:
        long = long.unionByName(p)
    cols = []
    for n in frames:
        own = F.col("_name") == n
        twice = F.raise_error(F.concat(F.lit(f"series {n} repeats "), F.col(on).cast("string"))).cast("double")
        cols.append(F.when(F.count_if(own) > 1, twice).otherwise(F.max(F.when(own, F.col("_v")))).alias(n))
    return long.groupBy(on).agg(*cols)


def full_join(a: DataFrame, b: DataFrame, on: Sequence[str] | str) -> DataFrame:
    """Full outer join on the key columns."""
    return a.join(b, on, "full")


def asof_join(left: DataFrame, right: DataFrame, keys: Sequence[str], ts: str,
              right_cols: Sequence[str]) -> DataFrame:
    """Every left row gets the last right values at or before its ``ts``
    (per key).  Both sides are tagged and unioned, then a forward fill runs in
    (key, ts) order with right rows first on equal ts; only left rows are kept.
    Runs on the series machinery, so one key never lands in one task."""
    keys = list(keys)
    lcols = [c for c in left.columns]
    l_ = left.select(*[F.col(c) for c in lcols], *[F.lit(None).cast(right.schema[c].dataType).alias(c)
                                                   for c in right_cols],
                     F.lit(1).alias("_side"))
    r_cols = []
    for c in lcols:
        if c in keys or c == ts:
            r_cols.append(F.col(c))
        else:
            r_cols.append(F.lit(None).cast(left.schema[c].dataType).alias(c))
    r_ = right.select(*r_cols, *[F.col(c) for c in right_cols], F.lit(0).alias("_side"))
    u = l_.unionByName(r_)
    seq = S.sequence(u, keys, [ts, "_side"])
    filled = S.scan_fill(seq, keys, {c: c for c in right_cols})
    return filled.filter(F.col("_side") == 1).drop("_side", S.SEQ, S.CNT)


def semi_join(df: DataFrame, kept: DataFrame, on: Sequence[str] | str) -> DataFrame:
    """Rows of ``df`` whose key survives in ``kept``."""
    return df.join(kept, on, "left_semi")


def common_groups(a: DataFrame, b: DataFrame, on: Sequence[str] | str,
                  suffixes: tuple[str, str] = ("_a", "_b")) -> DataFrame:
    """Inner join of two grouped results on the groups they share."""
    on = [on] if isinstance(on, str) else list(on)
    ra = a.select(*on, *[F.col(c).alias(c + suffixes[0]) for c in a.columns if c not in on])
    rb = b.select(*on, *[F.col(c).alias(c + suffixes[1]) for c in b.columns if c not in on])
    return ra.join(rb, on, "inner")


def align_counts(a: DataFrame, b: DataFrame, on: Sequence[str] | str, count_a: str, count_b: str
                 ) -> DataFrame:
    """Outer-align two frequency tables; a missing count is 0."""
    on = [on] if isinstance(on, str) else list(on)
    return (a.join(b, on, "full")
             .withColumn(count_a, F.coalesce(F.col(count_a), F.lit(0)))
             .withColumn(count_b, F.coalesce(F.col(count_b), F.lit(0))))


# levels of intervals without length, and of those without end
POINT, ENDLESS = -2000, 2000


def _number(df: DataFrame, name: str) -> Column:
    """Position of a value on the line (dates and times in seconds); keeps the order."""
    col = F.col(name)
    return (col.cast("timestamp") if isinstance(df.schema[name].dataType, (T.DateType, T.TimestampNTZType)) else col).cast("double")


def _node(x: Column, level: Column) -> Column:
    """Number of the dyadic node of 2^level that holds ``x``; rises with ``x``."""
    at = x / F.pow(F.lit(2.0), level)
    whole = F.when(F.abs(at) < F.lit(2.0 ** 52), F.floor(at).cast("double")).otherwise(at)
    return F.when(level == POINT, x).when(level == ENDLESS, F.lit(0.0)).otherwise(whole)


def dyadic_nodes(intervals: DataFrame, start: str, end: str) -> DataFrame:
    """Intervals with ``_level`` and ``_node``: the two or so nodes that cover each, on the level of its own length."""
    lo, hi = _number(intervals, start), _number(intervals, end)
    length = hi - lo
    level = F.when(length == 0, F.lit(POINT)).when(F.abs(length) == F.lit(float("inf")), F.lit(ENDLESS)).otherwise(
        F.greatest(F.lit(-1000), F.ceil(F.log2(length)).cast("int")))
    rows = intervals.filter(length >= 0).withColumn("_level", level)
    first, last = _node(lo, F.col("_level")), _node(hi, F.col("_level"))
    nodes = F.transform(F.sequence(F.lit(0), (last - first).cast("int")), lambda i: first + i)
    return rows.withColumn("_node", F.explode(nodes))


def interval_join(points: DataFrame, intervals: DataFrame, keys: Sequence[str], at: str,
                  start: str, end: str) -> DataFrame:
    """Points falling in [start, end] of an interval with the same key.

    Range join as an equi-join on a dyadic index: an interval lies in the two or
    so neighbouring nodes whose size is the power of two above its length, so it
    is copied a few times however long it is; a point is copied once to every
    level on which intervals exist (at most one per power of two).  The join is
    on (key, level, node) plus the range filter, and a point meets no interval
    that is not within a few interval lengths of it.  Null ends, and ends before
    their start, match nothing.
    """
    keys = list(keys)
    i = dyadic_nodes(intervals, start, end)
    levels = sorted(r[0] for r in i.select("_level").distinct().collect())     # powers of two: some thousand at most
    p = points.withColumn("_level", F.explode(F.lit(levels or [POINT]))) \
              .withColumn("_node", _node(_number(points, at), F.col("_level")))
    j = p.join(i, [*keys, "_level", "_node"], "inner").filter((F.col(at) >= F.col(start)) & (F.col(at) <= F.col(end)))
    return j.drop("_level", "_node")
