"""Statistical tests and outliers.

Counts, sums, ranks and medians are Spark aggregates; only the final scalars
get a p-value through the Arrow UDFs in ``functions.special``.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kiln.functions import special as SP
from kiln.operators import passes as P
from kiln.operators import quantiles as Q
from kiln.operators import series as S

Z95 = 1.959963984540054  # fixed value: two-sided 95 % normal quantile


# T1 -------------------------------------------------------------------------
def contingency_cells(df: DataFrame, row: str, col: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Observed cells (r, c, o) and both marginals (r, rt), (c, ct); categories as text, nulls left out."""
    d = df.select(F.col(row).cast("string").alias("r"), F.col(col).cast("string").alias("c")).na.drop()
    cells = d.groupBy("r", "c").agg(F.count(F.lit(1)).cast("double").alias("o"))
    return (cells, cells.groupBy("r").agg(F.sum("o").alias("rt")), cells.groupBy("c").agg(F.sum("o").alias("ct")))


def chi_square(df: DataFrame, row: str, col: str, correction: bool = True) -> DataFrame:
    """Chi-square independence: statistic, dof (Yates correction when dof = 1).
    Needs at least 2 categories and 2 outcomes, else one row of nulls.

    Empty cells are not built: each adds its expected count, and all expected
    counts sum to n.  Only a 2 x 2 table, whose four cells need the correction
    one by one, is completed from its marginals."""
    cells, rt, ct = contingency_cells(df, row, col)
    totals = rt.agg(F.sum("rt").alias("n"), F.count(F.lit(1)).alias("nr")).crossJoin(
        ct.agg(F.count(F.lit(1)).alias("nc")))                          # one row
    cells = cells.join(rt, "r").join(ct, "c").crossJoin(F.broadcast(totals)).withColumn("e", F.col("rt") * F.col("ct") / F.col("n"))
    plain = cells.agg(F.sum(F.pow(F.col("o") - F.col("e"), 2) / F.col("e")).alias("s"), F.sum("e").alias("e"))
    four = (F.col("nr") == 2) & (F.col("nc") == 2)
    r2 = rt.crossJoin(F.broadcast(totals)).where(four)                  # two rows or none
    grid = r2.crossJoin(F.broadcast(ct.crossJoin(F.broadcast(totals)).where(four).select("c", "ct")))
    grid = grid.join(cells.where(four).select("r", "c", "o"), ["r", "c"], "left")
    e = F.col("rt") * F.col("ct") / F.col("n")
    diff = F.abs(F.coalesce("o", F.lit(0.0)) - e)
    diff = diff - F.least(F.lit(0.5), diff) if correction else diff
    yates = grid.agg(F.sum(diff * diff / e).alias("y"))
    dof = (F.col("nr") - 1) * (F.col("nc") - 1)
    ok = (F.col("nr") >= 2) & (F.col("nc") >= 2)
    statistic = F.when(dof == 1, F.col("y")).otherwise(F.col("s") + F.col("n") - F.col("e"))
    return totals.crossJoin(plain).crossJoin(yates).select(
        F.when(ok, statistic).alias("statistic"), F.when(ok, dof).cast("long").alias("dof"))


def with_chi2_p(stat: DataFrame) -> DataFrame:
    return stat.withColumn("p_value", F.when(F.col("dof").isNotNull(),
                                             SP.chi2_sf_udf(F.col("statistic"), F.col("dof").cast("double"))))


# T2 -------------------------------------------------------------------------
def wilson(k: Column, n: Column, z: float = Z95) -> dict[str, Column]:
    """Wilson score interval; zero n gives 0 for all three values."""
    p = k / n
    z2 = z * z
    denom = 1 + z2 / n
    center = (p + z2 / (2 * n)) / denom
    half = z * F.sqrt(p * (1 - p) / n + z2 / (4 * n * n)) / denom
    zero = n == 0
    return {"proportion": F.when(zero, F.lit(0.0)).otherwise(p),
            "ci_low": F.when(zero, F.lit(0.0)).otherwise(center - half),
            "ci_high": F.when(zero, F.lit(0.0)).otherwise(center + half)}


def proportion_intervals(df: DataFrame, category: str, target: str) -> DataFrame:
    g = df.groupBy(F.col(category).cast("string").alias(category)).agg(
        F.sum(F.when(F.col(target) == 1, 1).otherwise(0)).cast("double").alias("k"),
        F.count(F.lit(1)).cast("double").alias("n"))
    return g.withColumns(wilson(F.col("k"), F.col("n")))


# T3 / T4 / T6 ----------------------------------------------------------------
def group_stats(df: DataFrame, value: str, group: str) -> DataFrame:
    """Per group: n, mean, sample variance, population skew / kurtosis."""
    return df.filter(F.col(value).isNotNull()).groupBy(group).agg(
        F.count(F.lit(1)).alias("n"), F.avg(value).alias("mean"), F.var_samp(value).alias("var"),
        F.skewness(value).alias("skew"), F.kurtosis(value).alias("kurt"))


def levene(df: DataFrame, value: str, group: str) -> DataFrame:
    """Median-centred Levene W with (k-1, N-k) degrees of freedom."""
    d = df.filter(F.col(value).isNotNull())
    med = Q.grouped_quantiles(d, [group], value, [0.5]).select(group, F.col("q")[0].alias("_med"))
    z = d.join(med, group).withColumn("_z", F.abs(F.col(value) - F.col("_med")))
    # sums, sums of squares: sum (z - mean)^2 = sum z^2 - n mean^2, about each group's own mean by var_pop
    per = z.groupBy(group).agg(F.count(F.lit(1)).alias("ni"), F.avg("_z").alias("zi"), F.sum("_z").alias("_sz"),
                               (F.var_pop("_z") * F.count(F.lit(1))).alias("_sw"))
    tot = per.agg(F.sum("ni").alias("N"), F.count(F.lit(1)).alias("k"), (F.sum("_sz") / F.sum("ni")).alias("zbar"),
                  F.sum("_sw").alias("sw"))                             # one row
    j = per.crossJoin(F.broadcast(tot)).agg(F.sum(F.col("ni") * F.pow(F.col("zi") - F.col("zbar"), 2)).alias("sb"),
                                            F.first("N").alias("N"), F.first("k").alias("k"), F.first("sw").alias("sw"))
    return j.select(F.try_divide((F.col("N") - F.col("k")) * F.col("sb"), (F.col("k") - 1) * F.col("sw")).alias("W"),
                    (F.col("k") - 1).cast("double").alias("df1"), (F.col("N") - F.col("k")).cast("double").alias("df2"))


def t_test(stats: DataFrame, group: str, a, b, equal_var: bool | Column) -> DataFrame:
    """Two-sample t statistic and df from the per-group aggregate of ``group_stats``."""
    s0 = stats.filter(F.col(group) == a).select(*[F.col(c).alias(c + "0") for c in ("n", "mean", "var")])
    s1 = stats.filter(F.col(group) == b).select(*[F.col(c).alias(c + "1") for c in ("n", "mean", "var")])
    j = s0.crossJoin(s1)
    n0, n1, m0, m1, v0, v1 = (F.col(c) for c in ("n0", "n1", "mean0", "mean1", "var0", "var1"))
    sp2 = ((n0 - 1) * v0 + (n1 - 1) * v1) / (n0 + n1 - 2)
    t_pooled = (m0 - m1) / F.sqrt(sp2 * (1 / n0 + 1 / n1))
    se = v0 / n0 + v1 / n1
    t_welch = (m0 - m1) / F.sqrt(se)
    df_welch = se * se / (F.pow(v0 / n0, 2) / (n0 - 1) + F.pow(v1 / n1, 2) / (n1 - 1))
    eq = equal_var if isinstance(equal_var, Column) else F.lit(bool(equal_var))
    return j.select(F.when(eq, t_pooled).otherwise(t_welch).alias("t"),
                    F.when(eq, (n0 + n1 - 2).cast("double")).otherwise(df_welch).alias("df"))


# T5 -------------------------------------------------------------------------
def mann_whitney(df: DataFrame, value: str, group: str, a, b) -> DataFrame:
    """U of group ``a``, tie-corrected normal approximation with continuity (two-sided).

    Average ranks come from counts per distinct value and their running sums
    (sequence + block scan over the distinct values, no single-task window)."""
    d = df.filter(F.col(value).isNotNull() & F.col(group).isin(a, b))
    per_val = d.groupBy(value).agg(F.count(F.lit(1)).alias("t"),
                                   F.sum(F.when(F.col(group) == a, 1).otherwise(0)).alias("ta"))
    per_val = per_val.withColumn("_k", F.lit(0))
    seq = S.sequence(per_val, ["_k"], [value])
    cum = S.scan_sum(seq, ["_k"], {"_cum": F.col("t").cast("double")})
    # average rank of a tie group: rows before it + (t + 1) / 2
    cum = cum.withColumn("avg_rank", F.col("_cum") - F.col("t") + (F.col("t") + 1) / 2.0)
    agg = cum.agg(F.sum(F.col("ta") * F.col("avg_rank")).alias("Ra"), F.sum("ta").alias("na"),
                  (F.sum("t") - F.sum("ta")).alias("nb"), F.sum("t").alias("N"),
                  F.sum(F.pow(F.col("t").cast("double"), 3) - F.col("t")).alias("ties"))
    na, nb, N = F.col("na").cast("double"), F.col("nb").cast("double"), F.col("N").cast("double")
    u1 = F.col("Ra") - na * (na + 1) / 2
    u2 = na * nb - u1
    mu = na * nb / 2
    sd = F.sqrt(na * nb / 12 * ((N + 1) - F.col("ties") / (N * (N - 1))))
    z = (F.greatest(u1, u2) - mu - 0.5) / sd
    return agg.select(u1.alias("U"), z.alias("z"))


# T6 -------------------------------------------------------------------------
def jarque_bera(n: Column, skew: Column, kurt: Column) -> Column:
    """JB statistic; its chi-square(2) p-value is exp(-JB/2)."""
    return n / 6.0 * (skew * skew + kurt * kurt / 4.0)


def choose_test(df: DataFrame, value: str, group: str, a, b) -> DataFrame:
    """Normality gate (Jarque-Bera p > 0.05, or n < 3) -> Levene -> t test
    (pooled when Levene p > 0.05); else Mann-Whitney U.  One row: test, statistic, p."""
    st = group_stats(df, value, group)
    s = st.filter(F.col(group).isin(a, b)).withColumn(
        "normal_p", F.exp(-jarque_bera(F.col("n"), F.col("skew"), F.col("kurt")) / 2.0))
    gate = s.agg(F.min(F.when((F.col("normal_p") > 0.05) | (F.col("n") < 3), 1).otherwise(0)).alias("normal"),
                 F.min("n").alias("min_n"), F.count(F.lit(1)).alias("groups")).first()
    if gate["groups"] == 2 and gate["normal"] == 1 and gate["min_n"] > 1:
        lev = levene(df.filter(F.col(group).isin(a, b)), value, group)
        lev = lev.withColumn("levene_p", SP.f_sf_udf("W", "df1", "df2"))
        eq = lev.select((F.col("levene_p") > 0.05).alias("eq")).first()["eq"]
        t = t_test(st, group, a, b, bool(eq))
        return t.select(F.lit("t_test" if eq else "welch_t_test").alias("test"), F.col("t").alias("statistic"),
                        SP.t_two_sided_udf("t", "df").alias("p_value"))
    mw = mann_whitney(df, value, group, a, b)
    return mw.select(F.lit("mann_whitney").alias("test"), F.col("U").alias("statistic"),
                     F.least(F.lit(1.0), 2 * SP.norm_sf_udf("z")).alias("p_value"))


# T8 -------------------------------------------------------------------------
def segment_shift(train: DataFrame, val: DataFrame, cluster: str, ev: str,
                  band: callable) -> DataFrame:
    """Per cluster present in both splits: n (non-null EV), mean EV, its band in
    each split, and whether the band shifted (Yes / No / N/A on a null mean)."""
    def side(d, sfx):
        return d.groupBy(cluster).agg(F.count(ev).alias(f"n_{sfx}"), F.avg(ev).alias(f"mean_ev_{sfx}"))
    j = side(train, "train").join(side(val, "val"), cluster, "inner")
    bt, bv = band(F.col("mean_ev_train")), band(F.col("mean_ev_val"))
    unknown = "Unknown (NaN EV)"
    shifted = (F.when((bt == unknown) | (bv == unknown), F.lit("N/A (due to NaN mean EV)"))
                .when(bt != bv, F.lit("Yes")).otherwise(F.lit("No")))
    return j.select(cluster, "n_train", "n_val", "mean_ev_train", "mean_ev_val",
                    bt.alias("category_train"), bv.alias("category_val"), shifted.alias("shifted"))


def segment_band_test(train: DataFrame, val: DataFrame, cluster: str, ev: str, band: callable,
                      least: int = 5, level: float = 0.05) -> DataFrame:
    """T8, inside a segment: chi-square test that train and val spread alike over
    the EV bands.  Per cluster with at least ``least`` EVs on either side and two
    bands in use: statistic (corrected for two bands), degrees of freedom, p and
    whether the spread shifted; nulls where it cannot be tested."""
    both = train.select(cluster, ev, F.lit(1).alias("s")).unionByName(val.select(cluster, ev, F.lit(0).alias("s"))).where(
        F.col(ev).isNotNull())
    cells = both.groupBy(cluster, band(F.col(ev)).alias("b")).agg(
        F.sum("s").cast("double").alias("o1"), F.sum(1 - F.col("s")).cast("double").alias("o0"))
    sizes = cells.groupBy(cluster).agg(F.sum("o1").alias("n1"), F.sum("o0").alias("n0"), (F.count(F.lit(1)) - 1).alias("dof"))
    j = cells.join(sizes, cluster)
    total, parts = F.col("n1") + F.col("n0"), []
    for o, n in (("o1", "n1"), ("o0", "n0")):
        e = (F.col("o1") + F.col("o0")) * F.col(n) / total
        d = F.abs(F.col(o) - e)
        d = F.when(F.col("dof") == 1, d - F.least(F.lit(0.5), d)).otherwise(d)
        parts.append(F.try_divide(d * d, e))
    out = j.groupBy(cluster, "n1", "n0", "dof").agg(F.sum(parts[0] + parts[1]).alias("s"))
    ok = (F.col("n1") >= least) & (F.col("n0") >= least) & (F.col("dof") >= 1)
    out = out.select(cluster, F.when(ok, F.col("s")).alias("statistic"), F.when(ok, F.col("dof")).cast("long").alias("dof"))
    return with_chi2_p(out).withColumn("shifted", F.col("p_value") <= level)


# T9 -------------------------------------------------------------------------
FEW = 8                 # coordinates up to which sums of products are Spark expressions


def _mahalanobis(mean: np.ndarray, inverse: np.ndarray):
    """Squared distance of an array column from ``mean``: an expression, or an Arrow function in many coordinates."""
    def expression(v: str) -> Column:
        z = [F.col(v)[i] - F.lit(float(m)) for i, m in enumerate(mean)]
        total = F.lit(0.0)
        for i, a in enumerate(z):
            for j, b in enumerate(z):
                total = total + a * F.lit(float(inverse[i, j])) * b
        return total

    @F.arrow_udf("double")
    def distance(v: pa.Array) -> pa.Array:
        z = P.vectors(v) - mean if len(v) else np.zeros((0, len(mean)))
        return pa.array(((z @ inverse) * z).sum(axis=1))
    return expression if len(mean) <= FEW else distance


def _moments(df: DataFrame, vec: str) -> tuple[int, np.ndarray, np.ndarray]:
    """``passes.moments``; in few coordinates by Spark's sums."""
    first = df.select(vec).head()
    if first is None or len(first[0]) > FEW:
        return P.moments(df, vec)
    origin = np.array(first[0], dtype=float)
    d = len(origin)
    y = [F.col(vec)[i] - F.lit(float(a)) for i, a in enumerate(origin)]
    pairs = [(i, j) for i in range(d) for j in range(i, d)]
    r = df.agg(F.count(F.lit(1)), *[F.sum(a) for a in y], *[F.sum(y[i] * y[j]) for i, j in pairs]).first()
    n, mean, products = r[0], np.array(r[1:1 + d], dtype=float) / r[0], np.empty((d, d))
    for (i, j), s in zip(pairs, r[1 + d:], strict=True):
        products[i, j] = products[j, i] = s / n
    return n, origin + mean, products - np.outer(mean, mean)


def robust_outliers(df: DataFrame, vec: str, contamination: float = 0.01, passes: int = 4, keep: float = 0.75) -> DataFrame:
    """Multivariate outlier flag: covariance on the kept rows (a d x d matrix to
    the driver per pass), Mahalanobis distance, keep the ``keep`` share closest;
    after the last pass flag the ``contamination`` share with the largest
    distance.  Missing coordinates count as 0."""
    x = df.withColumn("_x", F.transform(vec, lambda v: F.coalesce(v.cast("double"), F.lit(0.0))))
    kept, scored = x, None
    for _ in range(passes):
        n, mean, cov = _moments(kept, "_x")
        inv = np.linalg.pinv(cov * n / max(1, n - 1))

        scored = x.withColumn("mahalanobis", _mahalanobis(mean, inv)("_x"))
        cut = Q.column_quantiles(scored, "mahalanobis", [keep])[0]
        kept = scored.filter(F.col("mahalanobis") <= cut)
    cut = Q.column_quantiles(scored, "mahalanobis", [1 - contamination])[0]
    return scored.withColumn("outlier", F.col("mahalanobis") > cut).drop("_x")
