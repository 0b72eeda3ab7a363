"""Window and time-series operators (W1-W19), per series key, ordered by ts.

All functions take a DataFrame that already carries ``_seq`` (see
``series.sequence``) and return it with new columns.  Row frames are evaluated
per (key, block) with halo rows; running frames use block scans.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from kiln.functions import arrays as A
from kiln.operators import series as S

EPS = 1e-9


def _frame(w: Window, k: int) -> Window:
    return w.rowsBetween(-(k - 1), 0)


# W1 -------------------------------------------------------------------------
def window_mean(c: str, w: Window, scale: int | None = None) -> Column:
    """Mean over frame ``w`` skipping nulls.  With ``scale`` the input is fixed-point
    (``scale`` decimals), so the sum is rounded back to that scale before dividing:
    the result is then independent of summation order."""
    if scale is None:
        return F.avg(c).over(w)
    return F.round(F.sum(c).over(w), scale) / F.count(c).over(w)


def rolling_mean(df: DataFrame, keys: Sequence[str], cols: dict[str, tuple[str, int]],
                 scale: int | None = None) -> DataFrame:
    """``cols``: output -> (input, k).  Mean of the last k rows, min_periods=1."""
    reach = max(k for _, k in cols.values()) - 1
    return S.rolling(df, keys, lambda w: {o: window_mean(c, _frame(w, k), scale) for o, (c, k) in cols.items()},
                     before=reach)


# W2 -------------------------------------------------------------------------
def macro_ma_features(df: DataFrame, keys: Sequence[str], cols: Sequence[str],
                      windows: Sequence[int] = (5, 30, 200), scale: int | None = None) -> DataFrame:
    """Difference and relative difference of each column to its k-row means."""
    def build(w):
        out = {}
        for c in cols:
            x = F.col(c)
            for k in windows:
                ma = window_mean(c, _frame(w, k), scale)
                out[f"{c}_diff_to_{k}d_ma"] = x - ma
                out[f"{c}_ratio_to_{k}d_ma"] = F.try_divide(x - ma, F.nullif(x, F.lit(0.0)))
        return out
    return S.rolling(df, keys, build, before=max(windows) - 1)


# W3 -------------------------------------------------------------------------
def fill(df: DataFrame, keys: Sequence[str], cols: Sequence[str], how: str = "ffill") -> DataFrame:
    """``ffill``, ``bfill`` or ``ffill_bfill_zero`` (ffill, then bfill, then 0)."""
    if how == "ffill":
        return S.scan_fill(df, keys, {c: c for c in cols})
    if how == "bfill":
        return S.scan_fill(df, keys, {c: c for c in cols}, backward=True)
    if how == "ffill_bfill_zero":
        out = S.scan_fill(df, keys, {c: c for c in cols})
        out = S.scan_fill(out, keys, {c: c for c in cols}, backward=True)
        return out.na.fill(0, subset=list(cols))
    raise ValueError(how)


# W4 -------------------------------------------------------------------------
def interpolate_linear(df: DataFrame, keys: Sequence[str], cols: Sequence[str]) -> DataFrame:
    """Linear interpolation by row position; edges take the nearest known value."""
    pre = {}
    for c in cols:
        pre[f"{c}__ps"] = F.when(F.col(c).isNotNull(), F.col(S.SEQ))
    d = df.withColumns(pre)
    fwd = {f"{c}__pv": c for c in cols} | {f"{c}__pp": f"{c}__ps" for c in cols}
    d = S.scan_fill(d, keys, fwd)
    bwd = {f"{c}__nv": c for c in cols} | {f"{c}__np": f"{c}__ps" for c in cols}
    d = S.scan_fill(d, keys, bwd, backward=True)
    outs = {}
    for c in cols:
        pv, pp, nv, np_ = (F.col(f"{c}__{s}") for s in ("pv", "pp", "nv", "np"))
        frac = (F.col(S.SEQ) - pp) / (np_ - pp)
        mid = F.when(np_ == pp, pv).otherwise(pv + (nv - pv) * frac)
        outs[c] = F.coalesce(F.col(c), F.when(pv.isNotNull() & nv.isNotNull(), mid), pv, nv)
    d = d.withColumns(outs)
    return d.drop(*[f"{c}__{s}" for c in cols for s in ("ps", "pv", "pp", "nv", "np")])


# W5 -------------------------------------------------------------------------
def span_alpha(span: float) -> float:
    return 2.0 / (span + 1.0)


def ema(df: DataFrame, keys: Sequence[str], specs: dict[str, tuple[str, float]]) -> DataFrame:
    """``specs``: output -> (input, alpha); adjust=False recursion."""
    return S.ewm(df, keys, specs)


# W6-W15 ----------------------------------------------------------------------
def technical_indicators(df: DataFrame, keys: Sequence[str], price: str = "price",
                         high: str | None = "high", low: str | None = "low",
                         volume: str | None = "volume",
                         short_ma: int = 10, long_ma: int = 50, roc: int = 10,
                         momentum: int = 10, volatility: int = 10, atr: int = 14,
                         rsi: int = 14, ppo_short: int = 12, ppo_long: int = 26,
                         ppo_signal: int = 9, bb: int = 20, bb_k: float = 2.0,
                         volume_z: int = 20) -> DataFrame:
    """All relative indicators; columns missing from ``df`` skip their part."""
    cols = set(df.columns)
    p = F.col(price)
    has_hl = high in cols and low in cols if high and low else False
    has_vol = volume in cols if volume else False
    reach = max(short_ma, long_ma, roc + 1, momentum + 1, volatility, atr + 1, bb, volume_z)

    def first_pass(w):
        out = {}
        prev = F.lag(p, 1).over(w)
        out["_delta"] = p - prev
        out[f"sma_{short_ma}_rel"] = p / (F.avg(p).over(_frame(w, short_ma)) + EPS) - 1
        out[f"sma_{long_ma}_rel"] = p / (F.avg(p).over(_frame(w, long_ma)) + EPS) - 1
        out[f"roc_{roc}"] = F.try_divide(p, F.lag(p, roc).over(w)) - 1
        out[f"momentum_{momentum}_norm"] = (p - F.lag(p, momentum).over(w)) / (p + EPS)
        out[f"volatility_{volatility}_norm"] = F.stddev_samp(p).over(_frame(w, volatility)) / (p + EPS)
        # Bollinger bands, eps 1e-8 from here on
        mid = F.avg(p).over(_frame(w, bb))
        sd = F.coalesce(F.stddev_samp(p).over(_frame(w, bb)), F.lit(0.0))
        out["_bb_mid"] = mid
        out["_bb_sd"] = sd
        if has_hl:
            # previous close; the first row uses its own close (shift then bfill)
            pc = F.coalesce(prev, p)
            h, lo = F.col(high), F.col(low)
            parts = [h - lo, F.abs(h - pc), F.abs(lo - pc)]
            any_null = h.isNull() | lo.isNull() | pc.isNull()
            out["_tr"] = F.when(any_null, F.lit(None)).otherwise(F.greatest(*parts))
        if has_vol:
            v = F.col(volume)
            out["_vmean"] = F.avg(v).over(_frame(w, volume_z))
            out["_vsd"] = F.coalesce(F.stddev_samp(v).over(_frame(w, volume_z)), F.lit(0.0))
        return out

    d = S.rolling(df, keys, first_pass, before=reach)
    if has_hl:
        d = S.rolling(d, keys, lambda w: {f"_atr": F.avg("_tr").over(_frame(w, atr))}, before=atr - 1)
    gain = F.when(F.col("_delta") > 0, F.col("_delta")).otherwise(F.lit(0.0))
    loss = -F.when(F.col("_delta") < 0, F.col("_delta")).otherwise(F.lit(0.0))
    d = d.withColumns({"_gain": gain, "_loss": loss})
    d = S.ewm(d, keys, {
        "_ema_s": (price, span_alpha(short_ma)), "_ema_l": (price, span_alpha(long_ma)),
        "_ppo_s": (price, span_alpha(ppo_short)), "_ppo_l": (price, span_alpha(ppo_long)),
        "_avg_gain": ("_gain", 1.0 / rsi), "_avg_loss": ("_loss", 1.0 / rsi)})
    d = d.withColumn("ppo", (F.col("_ppo_s") - F.col("_ppo_l")) / (F.col("_ppo_l") + EPS) * 100)
    d = S.ewm(d, keys, {"ppo_signal": ("ppo", span_alpha(ppo_signal))})
    ag, al = F.col("_avg_gain"), F.col("_avg_loss")
    rsi_raw = 100.0 - 100.0 / (1.0 + ag / (al + EPS))
    rsi_col = (F.when((ag < EPS) & (al < EPS), F.lit(50.0))
                .when((ag < EPS) & (al >= EPS), F.lit(0.0))
                .when(al < EPS, F.lit(100.0))
                .otherwise(rsi_raw))
    eps8 = 1e-8
    mid, sd = F.col("_bb_mid"), F.col("_bb_sd")
    upper, lower = mid + bb_k * sd, mid - bb_k * sd
    rng = upper - lower
    pct_b = A.clip((p - lower) / (rng + eps8), 0.0, 1.0)
    collapsed = (F.when(F.abs(p - mid) < eps8, F.lit(0.5))
                  .when(p > mid, F.lit(1.0)).otherwise(F.lit(0.0)))
    pct_b = F.when(rng < eps8, collapsed).otherwise(pct_b)
    out = {
        f"ema_{short_ma}_rel": p / (F.col("_ema_s") + EPS) - 1,
        f"ema_{long_ma}_rel": p / (F.col("_ema_l") + EPS) - 1,
        f"rsi_{rsi}": F.coalesce(rsi_col, F.lit(50.0)),
        "ppo_hist": F.col("ppo") - F.col("ppo_signal"),
        f"bb_bandwidth_{bb}": rng / (mid + eps8),
        f"bb_percent_b_{bb}": A.clip(F.coalesce(pct_b, F.lit(0.5)), 0.0, 1.0),
    }
    if has_hl:
        out[f"atr_{atr}_norm"] = F.col("_atr") / (p + EPS)
    if has_vol:
        v = F.col(volume)
        out[f"volume_z_{volume_z}"] = F.coalesce((v - F.col("_vmean")) / (F.col("_vsd") + eps8), F.lit(0.0))
    d = d.withColumns(out)
    return d.drop(*[c for c in d.columns if c.startswith("_") and c not in (S.SEQ, S.CNT)])


def _return(x, p):
    """(x - p) / p as floating point has it: infinite or NaN from a price of zero."""
    rise = x - p
    return F.when(p != 0, F.try_divide(rise, p)).when(rise > 0, F.lit(float("inf"))).when(
        rise < 0, F.lit(float("-inf"))).when(rise == 0, F.lit(float("nan")))


# W16 ------------------------------------------------------------------------
def forward_return_hist(df: DataFrame, keys: Sequence[str], price: str, edges: Sequence[float],
                        horizon: int = 30, out: str = "y_bins") -> DataFrame:
    """Histogram of (p[i+1..i+h] - p[i]) / p[i] over ``edges``, normalised to 1.

    Null vector when fewer than ``horizon`` rows follow or no return lands in a bin;
    from a price of zero a rise is infinite and 0 to 0 no return.
    Bins are [a, b) except the last, which is closed."""
    def build(w):
        ahead = w.rowsBetween(1, horizon)
        return {"_fut": F.collect_list(price).over(ahead),
                "_ahead": F.count(F.lit(1)).over(ahead)}
    d = S.rolling(df, keys, build, after=horizon)
    p = F.col(price)
    # staged projections: each array is computed once and referenced by name
    d = d.withColumn("_cnt", A.histogram(F.transform("_fut", lambda x: _return(x, p)), edges))
    d = d.withColumn("_tot", F.aggregate("_cnt", F.lit(0).cast("long"), lambda a, x: a + x))
    ok = (F.col("_ahead") == horizon) & (F.col("_tot") > 0)
    vec = F.transform("_cnt", lambda c: c / F.col("_tot"))
    return d.withColumn(out, F.when(ok, vec)).drop("_fut", "_ahead", "_cnt", "_tot")


# W17 ------------------------------------------------------------------------
def lagged_moments(df: DataFrame, keys: Sequence[str], vec: str, centers: Sequence[float],
                   windows: Sequence[int] = (30, 45, 60)) -> DataFrame:
    """Moments of the distribution ``vec`` of row i-w (exact, not sampled):
    mean (dot product), median (first centre with cdf >= 0.5), population skew
    and excess kurtosis.  Each intermediate array is its own projection, so no
    higher-order subtree is evaluated twice."""
    d = S.rolling(df, keys, lambda w: {f"_lag{k}": F.lag(vec, k).over(w) for k in windows},
                  before=max(windows))
    c = A.lit_array(centers)
    for k in windows:
        v = F.col(f"_lag{k}")
        d = d.withColumn(f"_s{k}", F.aggregate(v, F.lit(0.0), lambda a, x: a + x))
        d = d.withColumn(f"_mu{k}", A.dot(F.transform(v, lambda x: x / F.col(f"_s{k}")), centers))
        d = d.withColumn(f"_cm{k}", F.aggregate(
            F.zip_with(v, c, lambda p, x: F.struct((p / F.col(f"_s{k}")).alias("q"), (x - F.col(f"_mu{k}")).alias("d"))),
            F.struct(F.lit(0.0).alias("m2"), F.lit(0.0).alias("m3"), F.lit(0.0).alias("m4")),
            lambda acc, z: F.struct((acc["m2"] + z["q"] * F.pow(z["d"], 2)).alias("m2"),
                                    (acc["m3"] + z["q"] * F.pow(z["d"], 3)).alias("m3"),
                                    (acc["m4"] + z["q"] * F.pow(z["d"], 4)).alias("m4"))))
        cdf = F.aggregate(v, F.array().cast("array<double>"),
                          lambda acc, x: F.concat(acc, F.array(F.coalesce(F.try_element_at(acc, F.lit(-1)),
                                                                          F.lit(0.0)) + x)))
        idx = F.array_position(F.transform(cdf, lambda x: x >= 0.5), True)
        m2, m3, m4 = (F.col(f"_cm{k}")[m] for m in ("m2", "m3", "m4"))
        ok = v.isNotNull() & (F.col(f"_s{k}") > 0) & (m2 > 0)
        d = d.withColumns({
            f"y_mean_prev{k}d": F.when(v.isNotNull(), A.dot(v, centers)),
            f"y_median_prev{k}d": F.when(v.isNotNull() & (idx > 0),
                                         F.element_at(c, F.greatest(idx, F.lit(1)).cast("int"))),
            f"y_skew_prev{k}d": F.when(ok, m3 / F.pow(m2, 1.5)),
            f"y_kurtosis_prev{k}d": F.when(ok, m4 / (m2 * m2) - 3.0)})
    return d.drop(*[f"_{p}{k}" for k in windows for p in ("lag", "s", "mu", "cm")])
