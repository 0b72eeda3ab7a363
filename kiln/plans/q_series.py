"""Time-series queries: W1-W19 on the daily price series and the hourly bars."""

from __future__ import annotations

from pyspark.sql import functions as F

from kiln.functions import arrays as A
from kiln.operators import indicators as I
from kiln.operators import series as S
from kiln.plans.inputs import BARS_SQL, DAILY_SQL, HOLED_SQL, daily_prices, holed_bars, hourly_bars
from kiln.plans.registry import query
from kiln.plans.sqlkit import ema_cte, unsign

KEYS = ["series"]

IND_COLS = ["sma_10_rel", "sma_50_rel", "ema_10_rel", "ema_50_rel", "roc_10", "momentum_10_norm",
            "volatility_10_norm", "atr_14_norm", "rsi_14", "ppo", "ppo_signal", "ppo_hist",
            "bb_bandwidth_20", "bb_percent_b_20", "volume_z_20"]


def _r(cols, digits=6):
    # "+ 0.0" turns a rounded -0.0 into 0.0 in both engines
    return [(F.round(c, digits) + F.lit(0.0)).alias(c) for c in cols]


def _win(frame: str = "") -> str:
    return f"OVER (PARTITION BY series ORDER BY rn {frame})"


def _rows(k: int) -> str:
    return _win(f"ROWS BETWEEN {k - 1} PRECEDING AND CURRENT ROW")


INDICATORS_SQL = """WITH RECURSIVE """ + HOLED_SQL + """,
f AS (
  SELECT series, ts, high, low, volume,
         row_number() OVER (PARTITION BY series ORDER BY ts) AS rn,
         coalesce(last_value(close IGNORE NULLS) OVER (PARTITION BY series ORDER BY ts
                    ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW),
                  first_value(close IGNORE NULLS) OVER (PARTITION BY series ORDER BY ts
                    ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING), 0) AS p
  FROM holed),
g AS (
  SELECT *, p - lag(p) """ + _win() + """ AS delta, coalesce(lag(p) """ + _win() + """, p) AS pc FROM f),
h AS (
  SELECT *, CASE WHEN delta > 0 THEN delta ELSE 0.0 END AS gain,
            CASE WHEN delta < 0 THEN -delta ELSE 0.0 END AS loss FROM g),
""" + ema_cte("e1", "h", "series", {
    "ema_s": ("p", 2 / 11), "ema_l": ("p", 2 / 51), "ppo_s": ("p", 2 / 13), "ppo_l": ("p", 2 / 27),
    "ag": ("gain", 1 / 14), "al": ("loss", 1 / 14)}) + """,
j AS (
  SELECT h.*, e1.ema_s, e1.ema_l, e1.ag, e1.al,
         (e1.ppo_s - e1.ppo_l) / (e1.ppo_l + 1e-9) * 100 AS ppo
  FROM h JOIN e1 USING (series, rn)),
""" + ema_cte("e2", "j", "series", {"ppo_signal": ("ppo", 2 / 10)}) + """,
k AS (
  SELECT j.*, e2.ppo_signal,
         avg(p) """ + _rows(10) + """ AS sma_s,
         avg(p) """ + _rows(50) + """ AS sma_l,
         lag(p, 10) """ + _win() + """ AS p10,
         stddev_samp(p) """ + _rows(10) + """ AS vol10,
         avg(greatest(high - low, abs(high - pc), abs(low - pc))) """ + _rows(14) + """ AS atr,
         avg(p) """ + _rows(20) + """ AS bb_mid,
         coalesce(stddev_samp(p) """ + _rows(20) + """, 0) AS bb_sd,
         avg(volume) """ + _rows(20) + """ AS vmean,
         coalesce(stddev_samp(volume) """ + _rows(20) + """, 0) AS vsd
  FROM j JOIN e2 USING (series, rn)),
m AS (
  SELECT *, 4 * bb_sd AS bb_rng, bb_mid - 2 * bb_sd AS bb_lo FROM k)
SELECT series, ts, round(p, 6) AS close,
  round(p / (sma_s + 1e-9) - 1, 6) AS sma_10_rel,
  round(p / (sma_l + 1e-9) - 1, 6) AS sma_50_rel,
  round(p / (ema_s + 1e-9) - 1, 6) AS ema_10_rel,
  round(p / (ema_l + 1e-9) - 1, 6) AS ema_50_rel,
  round(p / p10 - 1, 6) AS roc_10,
  round((p - p10) / (p + 1e-9), 6) AS momentum_10_norm,
  round(vol10 / (p + 1e-9), 6) AS volatility_10_norm,
  round(atr / (p + 1e-9), 6) AS atr_14_norm,
  round(CASE WHEN ag < 1e-9 AND al < 1e-9 THEN 50.0
             WHEN ag < 1e-9 AND al >= 1e-9 THEN 0.0
             WHEN al < 1e-9 THEN 100.0
             ELSE 100.0 - 100.0 / (1.0 + ag / (al + 1e-9)) END, 6) AS rsi_14,
  round(ppo, 6) AS ppo, round(ppo_signal, 6) AS ppo_signal, round(ppo - ppo_signal, 6) AS ppo_hist,
  round(bb_rng / (bb_mid + 1e-8), 6) AS bb_bandwidth_20,
  round(CASE WHEN bb_rng < 1e-8 THEN
               CASE WHEN abs(p - bb_mid) < 1e-8 THEN 0.5 WHEN p > bb_mid THEN 1.0 ELSE 0.0 END
             ELSE least(greatest((p - bb_lo) / (bb_rng + 1e-8), 0.0), 1.0) END, 6) AS bb_percent_b_20,
  round(coalesce((volume - vmean) / (vsd + 1e-8), 0), 6) AS volume_z_20
FROM m"""


def bar_indicators_frame(spark, sf_dir):
    bars = holed_bars(spark, sf_dir)
    s = S.sequence(bars, KEYS, ["ts"])
    s = I.fill(s, KEYS, ["close"], "ffill_bfill_zero")
    return I.technical_indicators(s, KEYS, price="close", high="high", low="low", volume="volume")


@query("w15_bar_indicators", unsign(INDICATORS_SQL, ["close"] + IND_COLS),
       covers=("W3", "W5", "W6", "W7", "W8", "W9", "W10", "W11", "W12", "W13", "W14", "W15"))
def bar_indicators(spark, sf_dir):
    d = bar_indicators_frame(spark, sf_dir)
    return d.select("series", "ts", *_r(["close"] + IND_COLS))


# W1 + W2: moving averages and macro-style differences on the daily series --------
def _ma_sql(k: int) -> str:
    return f"(round(sum(price) {_rows(k)}, 2) / count(price) {_rows(k)})"


MA_COLS = ["ma_5", "ma_30", "ma_200"] + [f"price_{k}_to_{w}d_ma" for k in ("diff", "ratio") for w in (5, 30, 200)]
MA_SQL = "WITH " + DAILY_SQL + """,
d AS (SELECT *, row_number() OVER (PARTITION BY series ORDER BY ts) AS rn FROM daily)
SELECT series, ts, """ + ",\n  ".join(
    [f"{_ma_sql(k)} AS ma_{k}" for k in (5, 30, 200)]
    + [f"price - {_ma_sql(k)} AS price_diff_to_{k}d_ma" for k in (5, 30, 200)]
    + [f"(price - {_ma_sql(k)}) / nullif(price, 0) AS price_ratio_to_{k}d_ma" for k in (5, 30, 200)]) + """
FROM d"""


@query("w01_moving_average", MA_SQL, covers=("W1", "W2", "P21"))
def moving_average(spark, sf_dir):
    # prices carry 2 decimals: sums are rounded back to 2 decimals (order independent)
    s = S.sequence(daily_prices(spark, sf_dir), KEYS, ["ts"])
    s = I.rolling_mean(s, KEYS, {"ma_5": ("price", 5), "ma_30": ("price", 30), "ma_200": ("price", 200)},
                       scale=2)
    s = I.macro_ma_features(s, KEYS, ["price"], scale=2)
    return s.select("series", "ts", *MA_COLS)


# Fills on holed bars ------------------------------------------------------
FILL_SQL = "WITH " + HOLED_SQL + """
SELECT series, ts,
  last_value(close IGNORE NULLS) OVER (PARTITION BY series ORDER BY ts
     ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS close_ffill,
  first_value(close IGNORE NULLS) OVER (PARTITION BY series ORDER BY ts
     ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS close_bfill,
  coalesce(last_value(close IGNORE NULLS) OVER (PARTITION BY series ORDER BY ts
     ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW),
     first_value(close IGNORE NULLS) OVER (PARTITION BY series ORDER BY ts
     ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING), 0) AS close_filled
FROM holed"""


@query("w03_fill", FILL_SQL, covers=("W3",))
def fills(spark, sf_dir):
    s = S.sequence(holed_bars(spark, sf_dir), KEYS, ["ts"])
    s = s.withColumns({"close_ffill": F.col("close"), "close_bfill": F.col("close"),
                       "close_filled": F.col("close")})
    s = I.fill(s, KEYS, ["close_ffill"], "ffill")
    s = I.fill(s, KEYS, ["close_bfill"], "bfill")
    s = I.fill(s, KEYS, ["close_filled"], "ffill_bfill_zero")
    return s.select("series", "ts", "close_ffill", "close_bfill", "close_filled")


# Linear interpolation by row position ---------------------------------------
INTERP_SQL = "WITH " + HOLED_SQL + """,
r AS (SELECT *, row_number() OVER (PARTITION BY series ORDER BY ts) AS rn FROM holed),
k AS (
  SELECT *,
    last_value(CASE WHEN close IS NOT NULL THEN rn END IGNORE NULLS) OVER (PARTITION BY series ORDER BY rn
        ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS pp,
    last_value(close IGNORE NULLS) OVER (PARTITION BY series ORDER BY rn
        ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS pv,
    first_value(CASE WHEN close IS NOT NULL THEN rn END IGNORE NULLS) OVER (PARTITION BY series ORDER BY rn
        ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS np,
    first_value(close IGNORE NULLS) OVER (PARTITION BY series ORDER BY rn
        ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS nv
  FROM r)
SELECT series, ts, round(coalesce(close,
    CASE WHEN pv IS NOT NULL AND nv IS NOT NULL THEN
      CASE WHEN np = pp THEN pv ELSE pv + (nv - pv) * ((rn - pp) / (np - pp)) END END,
    pv, nv), 6) AS close_interp
FROM k"""


@query("w04_interpolate", unsign(INTERP_SQL, ["close_interp"]), covers=("W4",))
def interpolate(spark, sf_dir):
    s = S.sequence(holed_bars(spark, sf_dir), KEYS, ["ts"])
    s = I.interpolate_linear(s.withColumn("close_interp", F.col("close")), KEYS, ["close_interp"])
    return s.select("series", "ts", *_r(["close_interp"]))


# EWMA by span and by alpha ---------------------------------------------------
EMA_SQL = "WITH RECURSIVE " + DAILY_SQL + """,
d AS (SELECT series, ts, price, row_number() OVER (PARTITION BY series ORDER BY ts) AS rn FROM daily),
""" + ema_cte("e", "d", "series", {"ema_10": ("price", 2 / 11), "ema_50": ("price", 2 / 51),
                                     "ema_a14": ("price", 1 / 14)}, carry=("ts",)) + """
SELECT series, ts, round(ema_10, 6) AS ema_10, round(ema_50, 6) AS ema_50, round(ema_a14, 6) AS ema_a14
FROM e"""


@query("w05_ema", unsign(EMA_SQL, ["ema_10", "ema_50", "ema_a14"]), covers=("W5",))
def ema(spark, sf_dir):
    s = S.sequence(daily_prices(spark, sf_dir), KEYS, ["ts"])
    s = I.ema(s, KEYS, {"ema_10": ("price", I.span_alpha(10)), "ema_50": ("price", I.span_alpha(50)),
                        "ema_a14": ("price", 1 / 14)})
    return s.select("series", "ts", *_r(["ema_10", "ema_50", "ema_a14"]))


# W16 + W18: forward return distribution and its expected value -------------------
def _hist_sql(arr: str, edges) -> str:
    n = len(edges) - 1
    parts = []
    for i in range(n):
        lo, hi = edges[i], edges[i + 1]
        cond = ["NOT isnan(x)"]
        if lo != float("-inf"):
            cond.append(f"x >= {lo!r}")
        if hi != float("inf"):
            cond.append(f"x <= {hi!r}" if i == n - 1 else f"x < {hi!r}")
        parts.append(f"len(list_filter({arr}, lambda x: {' AND '.join(cond)}))")
    return "[" + ", ".join(parts) + "]"


def _vec_round_sql(v: str) -> str:
    return f"list_transform({v}, lambda x: round(x, 6) + 0.0)"


HORIZON = 30
FWD_CTES = DAILY_SQL + """,
d AS (SELECT series, ts, price, row_number() OVER (PARTITION BY series ORDER BY ts) AS rn,
             count(*) OVER (PARTITION BY series) AS n FROM daily),
f AS (
  SELECT series, ts, price, rn, n,
         list(price) OVER (PARTITION BY series ORDER BY rn ROWS BETWEEN 1 FOLLOWING AND """ + str(HORIZON) + """ FOLLOWING) AS fut
  FROM d),
h AS (
  SELECT series, ts, rn, n, """ + _hist_sql("list_transform(fut, lambda q: (q - price) / price)", A.BIN_EDGES) + """ AS cnt
  FROM f),
v AS (
  SELECT series, ts,
    CASE WHEN rn + """ + str(HORIZON) + """ <= n AND list_sum(cnt) > 0
         THEN list_transform(cnt, lambda c: c / list_sum(cnt)) END AS y_bins
  FROM h)"""
FWD_SQL = "WITH " + FWD_CTES + """
SELECT series, ts, """ + _vec_round_sql("y_bins") + """ AS y_bins,
  round(CASE WHEN y_bins IS NOT NULL AND list_sum(y_bins) <> 0 THEN
    list_sum(list_transform(list_zip(y_bins, """ + repr(A.bin_midpoints()) + """), lambda z: z[1] * z[2])) / list_sum(y_bins) END, 6) AS ev
FROM v"""


def forward_frame(spark, sf_dir):
    s = S.sequence(daily_prices(spark, sf_dir), KEYS, ["ts"])
    return I.forward_return_hist(s, KEYS, "price", A.BIN_EDGES, horizon=HORIZON)


@query("w16_forward_hist", unsign(FWD_SQL, ["ev"]), covers=("W16", "W18", "A16"))
def forward_hist(spark, sf_dir):
    s = forward_frame(spark, sf_dir)
    return s.select("series", "ts",
                    F.transform("y_bins", lambda x: F.round(x, 6) + F.lit(0.0)).alias("y_bins"),
                    (F.round(A.expected_value(F.col("y_bins"), A.bin_midpoints()), 6) + F.lit(0.0)).alias("ev"))


# Moments of the distribution w rows back ---------------------------------------
def _moments_sql() -> str:
    c = repr(A.bin_centers())
    parts = []
    for k in (30, 45, 60):
        v = f"lag{k}"
        s = f"list_sum({v})"
        mu = f"list_sum(list_transform(list_zip({v}, {c}), lambda z: z[1] / {s} * z[2]))"

        def central(p, v=v, s=s, mu=mu):
            return f"list_sum(list_transform(list_zip({v}, {c}), lambda z: z[1] / {s} * power(z[2] - {mu}, {p})))"
        cdf = f"list_transform(range(1, 19), lambda i: list_sum({v}[1:i]))"
        med = f"{c}[list_position(list_transform({cdf}, lambda x: x >= 0.5), true)]"
        ok = f"{v} IS NOT NULL AND {s} > 0 AND {central(2)} > 0"
        parts += [f"round(CASE WHEN {v} IS NOT NULL THEN list_sum(list_transform(list_zip({v}, {c}), lambda z: z[1] * z[2])) END, 9) AS y_mean_prev{k}d",
                  f"CASE WHEN {v} IS NOT NULL THEN {med} END AS y_median_prev{k}d",
                  f"round(CASE WHEN {ok} THEN {central(3)} / power({central(2)}, 1.5) END, 6) AS y_skew_prev{k}d",
                  f"round(CASE WHEN {ok} THEN {central(4)} / ({central(2)} * {central(2)}) - 3.0 END, 6) AS y_kurtosis_prev{k}d"]
    lags = ", ".join(f"lag(y_bins, {k}) OVER (PARTITION BY series ORDER BY ts) AS lag{k}" for k in (30, 45, 60))
    return ("WITH " + FWD_CTES + f""",
l AS (SELECT series, ts, {lags} FROM v)
SELECT series, ts, """ + ",\n  ".join(parts) + "\nFROM l")


MOMENT_COLS = [f"y_{m}_prev{k}d" for k in (30, 45, 60) for m in ("mean", "median", "skew", "kurtosis")]


@query("w17_lagged_moments", unsign(_moments_sql(), MOMENT_COLS), covers=("W17", "W18"))
def lagged_moments(spark, sf_dir):
    s = forward_frame(spark, sf_dir)
    m = I.lagged_moments(s, KEYS, "y_bins", A.bin_centers())
    out = []
    for k in (30, 45, 60):
        out += [_r([f"y_mean_prev{k}d"], 9)[0], (F.col(f"y_median_prev{k}d") + F.lit(0.0)).alias(f"y_median_prev{k}d"),
                *_r([f"y_skew_prev{k}d", f"y_kurtosis_prev{k}d"])]
    return m.select("series", "ts", *out)
