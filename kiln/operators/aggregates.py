"""Aggregation operators.

Wide profiles (many columns) are computed in one aggregate and unpivoted, not
one job per column.  Global quantiles go through the exact distributed
``quantiles`` helper.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from kiln.operators import quantiles as Q


# A1 -------------------------------------------------------------------------
def value_counts(df: DataFrame, col: str) -> DataFrame:
    """Absolute and relative frequency per value (total from a one-row aggregate)."""
    counts = df.groupBy(col).agg(F.count(F.lit(1)).alias("count"))
    total = df.agg(F.count(F.lit(1)).alias("_total"))
    return (counts.crossJoin(F.broadcast(total))
                  .withColumn("share", F.col("count") / F.col("_total")).drop("_total"))


# A2 -------------------------------------------------------------------------
def distinct_profile(df: DataFrame, cols: Sequence[str], list_below: int = 30,
                     approximate: bool = False) -> DataFrame:
    """Distinct count per column and the sorted value list when below ``list_below``.

    Lists are built only for columns with fewer than ``list_below`` distinct
    values, so no unbounded set is ever gathered."""
    rows = []
    for c in cols:
        v = F.col(c).cast("string")
        n = F.approx_count_distinct(v) if approximate else F.countDistinct(v)
        rows.append((c, n))
    agg = df.agg(*[n.alias(f"n_{c}") for c, n in rows])
    long = agg.select(F.explode(F.array(*[F.struct(F.lit(c).alias("column"), F.col(f"n_{c}").alias("n_distinct"))
                                         for c in cols])).alias("x")).select("x.*")
    # value lists only for columns under the bound: distinct values of those
    # columns are at most ``list_below`` each, so the lists stay small
    short = long.filter(F.col("n_distinct") < list_below).select("column")
    vals = df.select(F.explode(F.array(*[F.struct(F.lit(c).alias("column"), F.col(c).cast("string").alias("v"))
                                         for c in cols])).alias("x")).select("x.*").filter(F.col("v").isNotNull())
    vals = vals.join(F.broadcast(short), "column", "left_semi").distinct()
    lists = vals.groupBy("column").agg(F.array_sort(F.collect_list("v")).alias("values"))
    return long.join(lists, "column", "left")


# A3 -------------------------------------------------------------------------
def describe(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """count, mean, std (sample), min, exact quartiles, max per column."""
    q = Q.multi_quantiles(df, {c: [0.25, 0.5, 0.75] for c in cols})
    agg = df.agg(*[e for c in cols for e in (
        F.count(c).alias(f"count_{c}"), F.avg(c).alias(f"mean_{c}"), F.stddev_samp(c).alias(f"std_{c}"),
        F.min(F.col(c).cast("double")).alias(f"min_{c}"), F.max(F.col(c).cast("double")).alias(f"max_{c}"))])
    return agg.select(F.explode(F.array(*[F.struct(
        F.lit(c).alias("column"), F.col(f"count_{c}").alias("count"), F.col(f"mean_{c}").alias("mean"),
        F.col(f"std_{c}").alias("std"), F.col(f"min_{c}").alias("min"),
        F.lit(q[c][0]).cast("double").alias("q25"), F.lit(q[c][1]).cast("double").alias("q50"),
        F.lit(q[c][2]).cast("double").alias("q75"), F.col(f"max_{c}").alias("max")) for c in cols])).alias("x")
    ).select("x.*")


# A4 -------------------------------------------------------------------------
def group_center(df: DataFrame, by: str, col: str, how: str = "mean") -> DataFrame:
    """Group mean or (exact) median."""
    if how == "mean":
        return df.groupBy(by).agg(F.avg(col).alias(col))
    if how == "median":
        q = Q.grouped_quantiles(df, [by], col, [0.5])
        return q.select(by, F.col("q")[0].alias(col))
    raise ValueError(f"unknown centre {how!r}")


# A5 -------------------------------------------------------------------------
def bin_rates(df: DataFrame, bin_col: str, target: str) -> DataFrame:
    """count, sum, rate and deviation = rate*100 - 100 per bin."""
    return (df.groupBy(bin_col).agg(F.count(F.lit(1)).alias("count"), F.sum(target).alias("sum"))
              .withColumn("rate", F.col("sum") / F.col("count"))
              .withColumn("deviation", F.col("rate") * 100 - 100))


# A6 -------------------------------------------------------------------------
def crosstab(df: DataFrame, row: str, col: str, values: Sequence | None = None) -> DataFrame:
    """Contingency table; the column values can be given to avoid a discovery job."""
    g = df.groupBy(row).pivot(col, list(values) if values is not None else None).count()
    return g.na.fill(0)


# A7 -------------------------------------------------------------------------
def modes(df: DataFrame, cols: Sequence[str]) -> dict[str, object]:
    """Most frequent value per column (smallest on ties, None when all are null).

    Counts per value over grouping sets in one scan, then one small aggregate;
    no task holds all values of a column."""
    cols = list(cols)
    if not cols:
        return {}
    counts = df.groupingSets([[F.col(f"`{c}`")] for c in cols], *[F.col(f"`{c}`") for c in cols]).agg(
        F.grouping_id().alias("__set"), F.count(F.lit(1)).alias("__n"))
    every = (1 << len(cols)) - 1
    best = []
    for i, c in enumerate(cols):
        own = (F.col("__set") == every ^ 1 << len(cols) - 1 - i) & F.col(f"`{c}`").isNotNull()
        best.append(F.min_by(F.col(f"`{c}`"), F.when(own, F.struct(-F.col("__n"), F.col(f"`{c}`")))).alias(c))
    row = counts.agg(*best).first()
    return {c: row[i] for i, c in enumerate(cols)}


def medians_and_modes(df: DataFrame, numeric: Sequence[str], other: Sequence[str],
                      missing: str = "missing") -> dict[str, object]:
    """Median per numeric column (exact), mode per other column (``missing`` when
    the column is all null)."""
    q = Q.multi_quantiles(df, {c: [0.5] for c in numeric}) if numeric else {}
    out: dict[str, object] = {c: q[c][0] for c in numeric}
    out.update({c: missing if v is None else v for c, v in modes(df, other).items()})
    return out


# A9 -------------------------------------------------------------------------
def mean_drift(a: DataFrame, b: DataFrame, cols: Sequence[str], threshold: float = 0.1) -> DataFrame:
    """Columns whose mean moved by more than ``threshold`` between two tables."""
    ma = a.agg(*[F.avg(c).alias(c) for c in cols])
    mb = b.agg(*[F.avg(c).alias(c) for c in cols])
    la = ma.unpivot([], list(cols), "column", "mean_a")
    lb = mb.unpivot([], list(cols), "column", "mean_b")
    j = la.join(lb, "column")
    return j.withColumn("delta", F.abs(F.col("mean_a") - F.col("mean_b"))).filter(F.col("delta") > threshold)


# A10 ------------------------------------------------------------------------
def class_support(df: DataFrame, split: str, label: str) -> tuple[DataFrame, DataFrame]:
    """Counts and percent per (split, label); per split imbalance ratio
    (max/min count) and Gini impurity 1 - sum p^2 rounded to 3."""
    counts = df.groupBy(split, label).agg(F.count(F.lit(1)).alias("count"))
    tot = Window.partitionBy(split)
    counts = counts.withColumn("percent", F.col("count") * 100.0 / F.sum("count").over(tot))
    summary = counts.groupBy(split).agg(
        (F.max("count") / F.min("count")).alias("imbalance_ratio"),
        F.round(1 - F.sum(F.pow(F.col("percent") / 100.0, 2)), 3).alias("gini"))
    return counts, summary


# A11 ------------------------------------------------------------------------
def moments(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """mean, sample std, population skew and excess kurtosis, min, max, zero
    variance flag per column; one aggregate, then unpivot."""
    aggs = []
    for c in cols:
        x = F.col(c).cast("double")
        aggs += [F.avg(x).alias(f"mean_{c}"), F.stddev_samp(x).alias(f"std_{c}"),
                 F.skewness(x).alias(f"skew_{c}"), F.kurtosis(x).alias(f"kurt_{c}"),
                 F.min(x).alias(f"min_{c}"), F.max(x).alias(f"max_{c}")]
    row = df.agg(*aggs)
    return row.select(F.explode(F.array(*[F.struct(
        F.lit(c).alias("column"), F.col(f"mean_{c}").alias("mean"), F.col(f"std_{c}").alias("std"),
        F.col(f"skew_{c}").alias("skew"), F.col(f"kurt_{c}").alias("kurtosis"),
        F.col(f"min_{c}").alias("min"), F.col(f"max_{c}").alias("max"),
        (F.abs(F.coalesce(F.col(f"std_{c}"), F.lit(0.0))) <= 1e-8).alias("zero_variance"))
        for c in cols])).alias("x")).select("x.*")


# A12 ------------------------------------------------------------------------
def correlations(df: DataFrame, cols: Sequence[str], target: str | None = None) -> DataFrame:
    """Pearson correlation for every column pair (long form, both orders) in one
    aggregate pass; with ``target`` only column-target pairs."""
    pairs = [(a, target) for a in cols] if target else [(a, b) for i, a in enumerate(cols) for b in cols[i + 1:]]
    row = df.agg(*[F.corr(F.col(a).cast("double"), F.col(b).cast("double")).alias(f"{a}||{b}") for a, b in pairs])
    structs = []
    for a, b in pairs:
        structs.append(F.struct(F.lit(a).alias("a"), F.lit(b).alias("b"), F.col(f"`{a}||{b}`").alias("corr")))
        if not target:
            structs.append(F.struct(F.lit(b).alias("a"), F.lit(a).alias("b"), F.col(f"`{a}||{b}`").alias("corr")))
    return row.select(F.explode(F.array(*structs)).alias("x")).select("x.*")


def strongest_partner(corr_long: DataFrame) -> DataFrame:
    """For each column its partner with the largest |corr| (first name on ties)."""
    w = Window.partitionBy("a").orderBy(F.abs(F.col("corr")).desc_nulls_last(), F.col("b"))
    return corr_long.withColumn("_r", F.row_number().over(w)).filter("_r = 1").drop("_r")


# A13 ------------------------------------------------------------------------
def null_profile(df: DataFrame, key: str, threshold_pct: float = 5.0, sample: int = 100) -> DataFrame:
    """Per column: null count and share; flagged above ``threshold_pct``; a
    sample of the smallest keys of null rows (at most ``sample``, bounded)."""
    cols = [c for c in df.columns if c != key]
    n = df.agg(F.count(F.lit(1)).alias("rows"), *[F.sum(F.col(c).isNull().cast("long")).alias(c) for c in cols])
    long = n.unpivot(["rows"], cols, "column", "nulls")
    long = long.withColumn("share_pct", F.col("nulls") * 100.0 / F.col("rows")) \
               .withColumn("flagged", F.col("nulls") > F.col("rows") * threshold_pct / 100.0)
    nulls = df.select(F.col(key), F.explode(F.array(*[F.when(F.col(c).isNull(), F.lit(c)) for c in cols])).alias("column")) \
              .filter(F.col("column").isNotNull())
    # smallest keys per column on the series layer (a mostly-null column is
    # numbered across many tasks), then a bounded list
    from kiln.operators import series as S
    seq = S.sequence(nulls, ["column"], [key])
    samp = (seq.filter(F.col(S.SEQ) <= sample)
               .groupBy("column").agg(F.array_sort(F.collect_list(key)).alias("sample_keys")))
    return long.join(samp, "column", "left")


# A14 / A15 / A16 ---------------------------------------------------------------
def equal_width_bin(x: Column, lo: float, hi: float, bins: int = 10) -> Column:
    """Bin index 0..bins-1 of right-closed equal-width bins over [lo, hi]
    (the first bin also takes ``lo``, like pandas' extended lower edge)."""
    w = (hi - lo) / bins if hi > lo else 1.0
    idx = F.ceil((x - F.lit(lo)) / F.lit(w)) - 1
    return F.when(x.isNull(), F.lit(None)).otherwise(F.least(F.greatest(idx, F.lit(0)), F.lit(bins - 1))).cast("int")


def equal_width_bins(df: DataFrame, col: str, bins: int = 10, out: str = "bin") -> DataFrame:
    r = df.agg(F.min(col).alias("lo"), F.max(col).alias("hi")).first()
    return df.withColumn(out, equal_width_bin(F.col(col).cast("double"), float(r["lo"]), float(r["hi"]), bins))


def quantile_edges(df: DataFrame, col: str, q: int = 5) -> list[float]:
    """Distinct exact quantile edges (duplicates dropped)."""
    edges = Q.column_quantiles(df, col, [i / q for i in range(q + 1)])
    out = []
    for e in edges:
        if e is not None and (not out or e != out[-1]):
            out.append(e)
    return out


def edge_bin(x: Column, edges: Sequence[float]) -> Column:
    """Right-closed bins over ``edges``; the first bin includes its left edge."""
    if len(edges) < 2:
        return F.lit(0)
    expr = F.when(x.isNull(), F.lit(None))
    for i, e in enumerate(edges[1:]):
        expr = expr.when(x <= F.lit(e), F.lit(i))
    return expr.otherwise(F.lit(None)).cast("int")


def quantile_bins(df: DataFrame, col: str, q: int = 5, out: str = "bin") -> DataFrame:
    """Quantile bins; with fewer than 2 distinct edges falls back to A14."""
    edges = quantile_edges(df, col, q)
    if len(edges) < 2:
        return equal_width_bins(df, col, q, out)
    return df.withColumn(out, edge_bin(F.col(col).cast("double"), edges))


# A17 / A18 -----------------------------------------------------------------------
def density_difference(df: DataFrame, col: str, label: str, bins: int = 10) -> DataFrame:
    """Density histogram of class 1 minus class 0 over shared equal-width bins."""
    r = df.agg(F.min(col).alias("lo"), F.max(col).alias("hi")).first()
    lo, hi = float(r["lo"]), float(r["hi"])
    w = (hi - lo) / bins if hi > lo else 1.0
    b = F.least(F.floor((F.col(col) - F.lit(lo)) / F.lit(w)), F.lit(bins - 1)).cast("int")
    d = df.filter(F.col(col).isNotNull()).withColumn("bin", b)
    counts = d.groupBy("bin").agg(F.sum(F.when(F.col(label) == 1, 1).otherwise(0)).alias("n1"),
                                  F.sum(F.when(F.col(label) == 0, 1).otherwise(0)).alias("n0"))
    tot = d.agg(F.sum(F.when(F.col(label) == 1, 1).otherwise(0)).alias("t1"),
                F.sum(F.when(F.col(label) == 0, 1).otherwise(0)).alias("t0"))
    return (counts.crossJoin(F.broadcast(tot))
                  .withColumn("density_diff", F.try_divide("n1", F.col("t1") * w) - F.try_divide("n0", F.col("t0") * w))
                  .select("bin", "density_diff"))


def proportion_difference(df: DataFrame, col: str, label: str) -> DataFrame:
    """P(cat | 1) - P(cat | 0) with categories outer-aligned (missing -> 0); null for an absent class."""
    ones, zeros = F.count_if(F.col(label) == 1), F.count_if(F.col(label) == 0)
    g = df.groupBy(col).agg(ones.alias("n1"), zeros.alias("n0"))
    totals = df.agg(ones.alias("t1"), zeros.alias("t0"))     # one row
    return g.crossJoin(F.broadcast(totals)).select(
        col, (F.try_divide("n1", "t1") - F.try_divide("n0", "t0")).alias("prop_diff"))


# A19 ------------------------------------------------------------------------
def tumbling_profile(df: DataFrame, keys: Sequence[str], seq: str, vec: str, centers: Sequence[float],
                     step: int = 7, first_rows: int = 150) -> DataFrame:
    """Mean probability vector and its expected value per block of ``step`` rows
    of the first ``first_rows`` rows of each key (``seq`` is a 1-based row number)."""
    from kiln.functions import arrays as A
    d = df.filter(F.col(seq) <= first_rows).withColumn("block", F.floor((F.col(seq) - 1) / step).cast("int"))
    n = len(centers)
    mean = d.groupBy(*keys, "block").agg(*[F.avg(F.element_at(vec, i + 1)).alias(f"_m{i}") for i in range(n)])
    vecc = F.array(*[F.col(f"_m{i}") for i in range(n)])
    return mean.select(*keys, "block", vecc.alias("mean_vec"), A.dot(vecc, centers).alias("ev"))


# A20 ------------------------------------------------------------------------
def binned_mutual_information(df: DataFrame, x_bin: str, y: str) -> DataFrame:
    """Plug-in MI (nats) of two discrete columns: sum p(x,y) log(p(x,y)/(p(x)p(y)))."""
    joint = df.groupBy(F.col(x_bin).alias("x"), F.col(y).alias("y")).agg(F.count(F.lit(1)).alias("nxy"))
    per_x = joint.groupBy(F.col("x").alias("x_")).agg(F.sum("nxy").alias("nx"))
    per_y = joint.groupBy(F.col("y").alias("y_")).agg(F.sum("nxy").alias("ny"))
    total = df.agg(F.count(F.lit(1)).alias("n"))             # one row
    j = (joint.join(per_x, F.col("x").eqNullSafe(F.col("x_"))).join(per_y, F.col("y").eqNullSafe(F.col("y_")))
         .crossJoin(F.broadcast(total)))
    return j.agg(F.sum(F.col("nxy") / F.col("n") * F.log(F.col("nxy") * F.col("n") / (F.col("nx") * F.col("ny"))))
                 .alias("mutual_info"))


# A21 ------------------------------------------------------------------------
def first_per_key(df: DataFrame, key: Sequence[str], order: Sequence[str]) -> DataFrame:
    """Distinct rows by key keeping the first by ``order`` (deterministic).

    A partial aggregate (``min_by`` of the whole row by the order columns), so a
    hot key is reduced on the map side instead of sorted in one task."""
    key, order = list(key), list(order)
    rest = [c for c in df.columns if c not in key]
    best = df.groupBy(*key).agg(F.min_by(F.struct(*rest), F.struct(*order)).alias("_row"))
    return best.select(*key, *[F.col(f"_row.{c}").alias(c) for c in rest])


# A22 ------------------------------------------------------------------------
# Measure, comparison and threshold of each suggestion.
SUGGESTION_RULES = [
    ("constant", "abs_std", "<=", 1e-8),
    ("wide_scale", "std", ">", 50.0),
    ("wide_scale", "abs_mean", ">", 100.0),
    ("wide_scale", "range", ">", 100.0),
    ("odd_shape", "abs_skew", ">", 1.0),
    ("odd_shape", "abs_kurtosis", ">", 3.0),
    ("few_values", "n_distinct", "<", 10.0),
    ("weak_target_link", "abs_target_corr", "<", 0.05),
]


def feature_suggestions(mom: DataFrame, distinct: DataFrame, target_corr: DataFrame) -> DataFrame:
    """(column, suggestions) per numeric column, the names sorted.

    The measures of A11 (moments), A2 (distinct counts) and A12 (correlation with
    the target) are put in long form and joined with the rule table; a constant
    column needs no rescaling."""
    wide = mom.select("column", F.coalesce(F.abs("std"), F.lit(0.0)).alias("abs_std"), "std", F.abs("mean").alias("abs_mean"),
                      (F.col("max") - F.col("min")).alias("range"), F.abs("skew").alias("abs_skew"),
                      F.abs("kurtosis").alias("abs_kurtosis"))
    names = [c for c in wide.columns if c != "column"]
    measures = wide.unpivot("column", names, "measure", "value").union(
        distinct.select("column", F.lit("n_distinct"), F.col("n_distinct").cast("double"))).union(
        target_corr.select("a", F.lit("abs_target_corr"), F.abs("corr")))
    rules = mom.sparkSession.createDataFrame(SUGGESTION_RULES, "rule string, measure string, comparison string, threshold double")
    holds = F.when(F.col("comparison") == ">", F.col("value") > F.col("threshold")) \
             .when(F.col("comparison") == "<", F.col("value") < F.col("threshold")) \
             .otherwise(F.col("value") <= F.col("threshold"))
    met = measures.join(rules, "measure").where(holds).groupBy("column").agg(F.collect_set("rule").alias("met"))
    met = met.withColumn("met", F.when(F.array_contains("met", "constant"), F.array_except("met", F.array(F.lit("wide_scale"))))
                         .otherwise(F.col("met")))
    none = F.array().cast("array<string>")
    return mom.join(met, "column", "left").withColumn("suggestions", F.array_sort(F.coalesce("met", none))).drop("met")
