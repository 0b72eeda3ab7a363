"""Sort, limit, top-k, set and split operators."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kiln.operators import series as S


# O1 / O2 --------------------------------------------------------------------
def top_k(df: DataFrame, score: Column, k: int, tie: Sequence[str]) -> DataFrame:
    """The k rows with the largest ``score`` (ties broken by ``tie`` columns).
    Spark plans this as TakeOrderedAndProject: per-partition top-k, then merge."""
    return df.orderBy(score.desc_nulls_last(), *[F.col(t) for t in tie]).limit(k)


def rank_by(df: DataFrame, score: Column, tie: Sequence[str], out: str = "rank") -> DataFrame:
    """O2: rank column, 1 for the largest score (nulls last), ties by ``tie``.
    Numbered on the series machinery: parts of a range-partitioned order, no
    single-task window."""
    d = df.withColumns({"_all": F.lit(0), "_low": score.isNull(), "_neg": -score})
    seq = S.sequence(d, ["_all"], ["_low", "_neg", *tie])
    return seq.withColumn(out, F.col(S.SEQ)).drop("_all", "_low", "_neg", S.SEQ, S.CNT)


# O3 -------------------------------------------------------------------------
def last_rows(df: DataFrame, keys: Sequence[str], order: Sequence[str], n: int) -> DataFrame:
    """Last ``n`` rows of each key by ``order`` (row number from the end)."""
    seq = S.sequence(df, keys, order)
    return seq.filter(F.col(S.SEQ) > F.col(S.CNT) - n).drop(S.SEQ, S.CNT)


# O5 -------------------------------------------------------------------------
def set_ops(a: DataFrame, b: DataFrame) -> dict[str, DataFrame]:
    """Intersection, union and difference of two row sets (distinct)."""
    return {"intersect": a.intersect(b), "union": a.union(b).distinct(), "except": a.subtract(b)}


# O6 -------------------------------------------------------------------------
def hash_bucket(key: Column, seed: int = 42) -> Column:
    """0..99 from md5(key || seed): identical in every engine that has md5."""
    h = F.substring(F.md5(F.concat(key.cast("string"), F.lit(str(seed)))), 1, 8)
    return (F.conv(h, 16, 10).cast("long") % 100).cast("int")


def random_split(df: DataFrame, key: str, test_pct: int = 20, seed: int = 42,
                 out: str = "split") -> DataFrame:
    """Row-level split by a hash of the key: ``test`` when bucket < test_pct."""
    b = hash_bucket(F.col(key), seed)
    return df.withColumn(out, F.when(b < test_pct, F.lit("test")).otherwise(F.lit("train")))


# O7 -------------------------------------------------------------------------
def stratified_split(df: DataFrame, key: str, label: str, test_frac: float = 0.2, seed: int = 42,
                     out: str = "split") -> DataFrame:
    """Per class, the ceil(n * frac) rows with the smallest key hash go to test.
    Null labels are removed first; with one class, or a class under 2 rows,
    falls back to the plain hash split (as the reference does)."""
    d = df.filter(F.col(label).isNotNull())
    # numeric prefix of md5(key || seed): same order as the hex string itself
    h = F.conv(F.substring(F.md5(F.concat(F.col(key).cast("string"), F.lit(str(seed)))), 1, 15), 16, 10) \
        .cast("long")
    stats = d.groupBy(label).agg(F.count(F.lit(1)).alias("_n"))
    row = stats.agg(F.count(F.lit(1)).alias("k"), F.min("_n").alias("m")).first()
    if row["k"] is None or row["k"] < 2 or row["m"] < 2:
        return random_split(d, key, int(test_frac * 100), seed, out)
    seq = S.sequence(d.withColumn("_h", h), [label], ["_h", key])
    n_test = F.ceil(F.col(S.CNT) * F.lit(test_frac))
    return seq.withColumn(out, F.when(F.col(S.SEQ) <= n_test, F.lit("test")).otherwise(F.lit("train"))) \
              .drop("_h", S.SEQ, S.CNT)


# O8 -------------------------------------------------------------------------
def chronological_split(df: DataFrame, keys: Sequence[str], ts: str, test_frac: float = 0.2,
                        val_frac: float | None = 0.2, out: str = "split") -> DataFrame:
    """Last ceil(test_frac * n) rows of each key are test; of the remaining rows
    the last ceil(val_frac * m) are validation (when ``val_frac``)."""
    seq = S.sequence(df, keys, [ts])
    n = F.col(S.CNT)
    n_test = F.ceil(n * F.lit(test_frac))
    m = n - n_test
    is_test = F.col(S.SEQ) > m
    expr = F.when(is_test, F.lit("test"))
    if val_frac:
        n_val = F.ceil(m * F.lit(val_frac))
        expr = expr.when(F.col(S.SEQ) > m - n_val, F.lit("val"))
    return seq.withColumn(out, expr.otherwise(F.lit("train"))).drop(S.SEQ, S.CNT)
