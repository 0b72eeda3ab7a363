"""Trading backtest as window queries.

Strategies are rows, so many models, strategies and series run in one job.
A position opened on row t (after that row's P&L) with direction d and entry
price p_t unwinds u = trade_size / p_t / hold shares per row over rows
t+1 .. t+hold; a null-price row pays nothing but still counts.  Hence

* daily P&L(t') = p_t' * sum(u d) - sum(u d p) over the previous ``hold`` rows,
* equity = V0 + running sum of daily P&L,
* trade P&L = u d (sum p - count(p) * p_t) over the next ``hold`` rows,
  closed on row t+hold when that row exists.

Everything runs on the series machinery (row sequence, blocked windows, block
scans), so no series key is ever gathered into one task.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kiln.functions import arrays as A
from kiln.operators import series as S

PERFECT = "Perfect Foresight"
BENCHMARK = "Hold Benchmark"
WIN_EPS = 1e-6


@dataclass(frozen=True)
class Params:
    initial: float = 100_000.0
    trade_size: float = 3_000.0
    hold_apr: float = 0.05
    threshold: float = 0.005
    hold: int = 30
    periods: int = 252
    window: int = 62


def strategy_names(model: str) -> list[str]:
    return [f"{model} (Top-1)", f"{model} (Top-2 Consensus)", f"{model} (Cum@90)",
            f"{model} (Cum@75)", f"{model} (Cum@60)"]


# B1 / B2 / B3 / B4 ---------------------------------------------------------------
def signals(seq: DataFrame, keys: Sequence[str], price: str, probs: str, class_ev: Sequence[float],
            p: Params, model: str) -> DataFrame:
    """Long table of (keys, strategy, row) with ``dir`` in {-1, 0, 1}.

    ``class_ev[i]`` is the mean EV of class i (B1-B3 through J7); the perfect
    foresight signal (B4) needs the next ``hold`` prices all present."""
    th = p.threshold
    evs = A.lit_array(class_ev)
    pr = F.col(probs)
    # B1: arg-max class (first on ties)
    ev1 = F.element_at(evs, A.argmax(pr) + 1)
    top1 = F.when(ev1 > th, 1).when(ev1 < -th, -1).otherwise(0)
    # B2: the two largest classes (ties: higher index first), both profitable / both loss
    order = F.array_sort(F.transform(pr, lambda x, i: F.struct((-x).alias("a"), (-i).alias("b"))))
    i1, i2 = -F.element_at(order, 1)["b"], -F.element_at(order, 2)["b"]
    e1, e2 = F.element_at(evs, i1 + 1), F.element_at(evs, i2 + 1)
    top2 = F.when((e1 > th) & (e2 > th), 1).when((e1 < -th) & (e2 < -th), -1).otherwise(0)
    # Probability mass of profitable / loss classes
    pos_mass = F.aggregate(F.zip_with(pr, evs, lambda x, e: F.when(e > th, x).otherwise(F.lit(0.0))),
                           F.lit(0.0), lambda a, x: a + x)
    neg_mass = F.aggregate(F.zip_with(pr, evs, lambda x, e: F.when(e < -th, x).otherwise(F.lit(0.0))),
                           F.lit(0.0), lambda a, x: a + x)

    def cum(level):
        return F.when(F.col("_pm") > level, 1).when(F.col("_nm") > level, -1).otherwise(0)

    def build(w):
        ahead = w.rowsBetween(1, p.hold)
        return {"_fcnt": F.count(price).over(ahead), "_fsum": F.sum(price).over(ahead)}
    d = S.rolling(seq, keys, build, after=p.hold)
    # Full horizon (row t+hold exists and every price present)
    full = (F.col(S.SEQ) + p.hold <= F.col(S.CNT)) & (F.col("_fcnt") == p.hold)
    factor = F.col("_fsum") / p.hold / F.col(price)
    perfect = F.when(full & (factor > 1 + th), 1).when(full & (factor < 1 - th), -1).otherwise(0)
    d = d.withColumns({"_pm": pos_mass, "_nm": neg_mass})
    names = strategy_names(model)
    strat = F.array(*[F.struct(F.lit(n).alias("strategy"), e.cast("int").alias("dir"))
                      for n, e in zip(names + [PERFECT], [top1, top2, cum(0.90), cum(0.75), cum(0.60), perfect])])
    valid = F.col(price).isNotNull() & (F.col(price) != 0) & F.col(probs).isNotNull()
    d = d.select(*keys, "ts", price, S.SEQ, S.CNT, F.explode(strat).alias("_s"), valid.alias("_valid"))
    return d.select(*keys, F.col("_s.strategy").alias("strategy"), "ts", price, S.SEQ, S.CNT,
                    F.when(F.col("_valid"), F.col("_s.dir")).otherwise(F.lit(0)).alias("dir"))


# B5 / B6 / B8 -------------------------------------------------------------------
def positions(sig: DataFrame, keys: Sequence[str], price: str, p: Params) -> DataFrame:
    """Per row: daily P&L, equity, and for opening rows the trade outcome."""
    k = list(keys) + ["strategy"]
    u = F.when(F.col("dir") != 0, F.col("dir") * (p.trade_size / F.col(price)) / p.hold).otherwise(F.lit(0.0))
    d = sig.withColumns({"_ud": u, "_udp": u * F.col(price)})

    def build(w):
        back = w.rowsBetween(-p.hold, -1)
        ahead = w.rowsBetween(1, p.hold)
        return {"_a": F.sum("_ud").over(back), "_b": F.sum("_udp").over(back),
                "_sp": F.sum(price).over(ahead), "_cp": F.count(price).over(ahead),
                "close_ts": F.lead("ts", p.hold).over(w), "exit_price": F.lead(price, p.hold).over(w)}
    d = S.rolling(d, k, build, before=p.hold, after=p.hold)
    pnl = F.when(F.col(price).isNotNull(), F.col(price) * F.coalesce("_a", F.lit(0.0)) - F.coalesce("_b", F.lit(0.0))) \
        .otherwise(F.lit(0.0))
    d = d.withColumn("daily_pnl", pnl)
    d = S.scan_sum(d, k, {"_cum": F.col("daily_pnl")})
    d = d.withColumn("value", F.lit(p.initial) + F.col("_cum"))
    trade = F.col("_ud") * (F.coalesce("_sp", F.lit(0.0)) - F.col("_cp") * F.col(price))
    closed = F.col(S.SEQ) + p.hold <= F.col(S.CNT)
    d = d.withColumns({"trade_pnl": F.when(F.col("dir") != 0, trade),
                       "closed": (F.col("dir") != 0) & closed,
                       "close_seq": F.when((F.col("dir") != 0) & closed, F.col(S.SEQ) + p.hold)})
    return d.drop("_ud", "_udp", "_a", "_b", "_sp", "_cp", "_cum")


# B7 -------------------------------------------------------------------------
def benchmark(seq: DataFrame, keys: Sequence[str], p: Params) -> DataFrame:
    """Hold benchmark: V0 (1 + r)^(t+1), r = (1 + apr)^(1/periods) - 1."""
    r = (1.0 + p.hold_apr) ** (1.0 / p.periods) - 1.0
    return seq.select(*keys, F.lit(BENCHMARK).alias("strategy"), "ts", S.SEQ, S.CNT,
                      (F.lit(p.initial) * F.pow(F.lit(1.0 + r), F.col(S.SEQ).cast("double"))).alias("value"),
                      F.lit(None).cast("double").alias("daily_pnl"))


def equity(pos: DataFrame, bench: DataFrame, keys: Sequence[str]) -> DataFrame:
    """B6 + B7: one long equity table for every strategy."""
    cols = [*keys, "strategy", "ts", S.SEQ, S.CNT, "value", "daily_pnl"]
    return pos.select(*cols).unionByName(bench.select(*cols))


# B8 -------------------------------------------------------------------------
def trade_log(pos: DataFrame, keys: Sequence[str], price: str, p: Params) -> DataFrame:
    """Open events for every signal row and close events for closed trades."""
    o = pos.filter(F.col("dir") != 0)
    side = F.when(F.col("dir") == 1, F.lit("long")).otherwise(F.lit("short"))
    opens = o.select(*keys, "strategy", F.lit("open").alias("type"), F.col("ts").alias("open_ts"),
                     F.lit(None).cast(pos.schema["ts"].dataType).alias("close_ts"), side.alias("side"),
                     F.col(price).alias("entry_price"), F.lit(None).cast("double").alias("exit_price"),
                     F.lit(None).cast("double").alias("pnl"), F.lit(p.trade_size).alias("amount"))
    closes = o.filter("closed").select(
        *keys, "strategy", F.lit("close").alias("type"), F.col("ts").alias("open_ts"), "close_ts",
        side.alias("side"), F.col(price).alias("entry_price"), "exit_price", F.col("trade_pnl").alias("pnl"),
        (F.lit(p.trade_size / p.hold) * p.hold).alias("amount"))
    return opens.unionByName(closes)


# B9 - B12 --------------------------------------------------------------------------
def _sharpe(mean: Column, std: Column, n: Column, periods: int) -> Column:
    return (F.when(n < 2, F.when((n == 1) & (mean == 0), F.lit(0.0)))
             .when(std > 1e-9, mean / std * F.sqrt(F.lit(float(periods))))
             .when(mean == 0, F.lit(0.0)))


def kpis(eq: DataFrame, pos: DataFrame, keys: Sequence[str], p: Params) -> DataFrame:
    """Long KPI table (keys, strategy, metric, value) from three passes:
    conditional aggregates over the daily returns (all-time and last-N
    metrics), tumbling-window metrics, and trade statistics over the closes."""
    k = list(keys) + ["strategy"]
    # daily returns: previous value, V0 before the first row
    r = S.rolling(eq, k, lambda w: {"_prev": F.lag("value", 1).over(w)}, before=1)
    # a day without P&L has a return of exactly 0 (no summation noise from the running sum)
    ret = F.when(F.col("daily_pnl") == 0, F.lit(0.0)).otherwise(
        F.coalesce(F.col("value") / F.coalesce("_prev", F.lit(p.initial)) - 1, F.lit(0.0)))
    r = r.withColumn("ret", ret)
    seq, n = F.col(S.SEQ), F.col(S.CNT)
    aggs = [F.max_by("value", S.SEQ).alias("final"), F.avg("ret").alias("mean"),
            F.stddev_samp("ret").alias("std"), F.count(F.lit(1)).alias("cnt")]
    for nd in (10, 30, 60):
        tail = seq >= F.greatest(n - nd + 1, F.lit(1))
        aggs += [F.avg(F.when(tail, F.col("ret"))).alias(f"m{nd}"),
                 F.stddev_samp(F.when(tail, F.col("ret"))).alias(f"s{nd}"),
                 F.count(F.when(tail, 1)).alias(f"c{nd}"),
                 F.max(F.when(seq == n - nd, F.col("value"))).alias(f"v{nd}")]
    base = r.groupBy(*k).agg(*aggs)
    m = {
        "Final Portfolio Value": F.col("final"),
        "Total Return (%)": (F.col("final") / p.initial - 1) * 100,
        "Sharpe Ratio (Annualized, All-Time)": _sharpe(F.col("mean"), F.col("std"), F.col("cnt"), p.periods),
        "Avg Daily Return (%)": F.col("mean") * 100,
        "Std Dev Daily Return (%)": F.when(F.col("cnt") > 1, F.col("std") * 100).otherwise(F.lit(0.0)),
    }
    for nd in (10, 30, 60):
        m[f"sharpe_ratio_last_{nd}_trading_days"] = _sharpe(F.col(f"m{nd}"), F.col(f"s{nd}"), F.col(f"c{nd}"),
                                                            p.periods)
        m[f"running_total_returns_last_{nd}_trading_days"] = \
            (F.col("final") / F.coalesce(F.col(f"v{nd}"), F.lit(p.initial)) - 1) * 100
    out = [base.select(*k, F.explode(F.array(*[F.struct(F.lit(name).alias("metric"), e.cast("double").alias("value"))
                                                for name, e in m.items()])).alias("x")).select(*k, "x.*")]
    closes = pos.filter("closed").select(*k, "close_seq", "trade_pnl", "dir", S.CNT)
    out += rolling_window_kpis(r, closes, k, p)
    out += trade_stats(closes, endv_keys(r, k), k)
    res = out[0]
    for o in out[1:]:
        res = res.unionByName(o)
    return res


def endv_keys(r: DataFrame, k: Sequence[str]) -> DataFrame:
    return r.filter((F.col(S.SEQ) == F.col(S.CNT)) & (F.col("strategy") != BENCHMARK)).select(*k)


# B11 ------------------------------------------------------------------------
def rolling_window_kpis(r: DataFrame, closes: DataFrame, k: Sequence[str], p: Params) -> list[DataFrame]:
    """Tumbling ``window``-row blocks (full blocks only): Sharpe and long/short
    win rates of the closes inside each block, averaged over blocks."""
    wid = F.floor((F.col(S.SEQ) - 1) / p.window).cast("long")
    full = F.floor(F.col(S.CNT) / p.window)
    rr = r.withColumn("_w", wid).filter(F.col("_w") < full)
    per = rr.groupBy(*k, "_w").agg(F.avg("ret").alias("mean"), F.stddev_samp("ret").alias("std"),
                                   F.count(F.lit(1)).alias("n"))
    per = per.withColumn("sharpe", F.when(F.col("n") >= 2, _sharpe(F.col("mean"), F.col("std"), F.col("n"),
                                                                      p.periods)))
    cw = closes.withColumn("_w", F.floor((F.col("close_seq") - 1) / p.window).cast("long"))
    wins = cw.groupBy(*k, "_w").agg(
        F.sum(F.when(F.col("dir") == 1, 1).otherwise(0)).alias("lt"),
        F.sum(F.when((F.col("dir") == 1) & (F.col("trade_pnl") > WIN_EPS), 1).otherwise(0)).alias("lw"),
        F.sum(F.when(F.col("dir") == -1, 1).otherwise(0)).alias("st"),
        F.sum(F.when((F.col("dir") == -1) & (F.col("trade_pnl") > WIN_EPS), 1).otherwise(0)).alias("sw"))
    j = per.join(wins, [*k, "_w"], "left").na.fill(0, ["lt", "lw", "st", "sw"])
    j = j.withColumns({"lwr": F.when(F.col("lt") > 0, F.col("lw") / F.col("lt") * 100).otherwise(F.lit(0.0)),
                       "swr": F.when(F.col("st") > 0, F.col("sw") / F.col("st") * 100).otherwise(F.lit(0.0))})
    avg = j.groupBy(*k).agg(F.avg("sharpe").alias("s"), F.avg("lwr").alias("l"), F.avg("swr").alias("w"))
    return [avg.select(*k, F.explode(F.array(
        F.struct(F.lit(f"Avg Rolling {p.window}-Day Sharpe").alias("metric"), F.col("s").alias("value")),
        F.struct(F.lit(f"Avg Rolling {p.window}-Day Long Win Rate (%)").alias("metric"), F.col("l").alias("value")),
        F.struct(F.lit(f"Avg Rolling {p.window}-Day Short Win Rate (%)").alias("metric"), F.col("w").alias("value"))
    )).alias("x")).select(*k, "x.*")]


# B12 ------------------------------------------------------------------------
def trade_stats(closes: DataFrame, strategies: DataFrame, k: Sequence[str]) -> list[DataFrame]:
    """Totals, win / loss / breakeven %, long and short win %, and win rate of
    the closes in the last 10 / 30 / 60 rows, per strategy (one aggregate)."""
    win = F.col("trade_pnl") > WIN_EPS
    loss = F.col("trade_pnl") < -WIN_EPS
    aggs = [F.count(F.lit(1)).alias("t"), F.sum(win.cast("int")).alias("w"), F.sum(loss.cast("int")).alias("l"),
            F.sum((F.col("dir") == 1).cast("int")).alias("bt"), F.sum(((F.col("dir") == 1) & win).cast("int")).alias("bw"),
            F.sum((F.col("dir") == -1).cast("int")).alias("st"), F.sum(((F.col("dir") == -1) & win).cast("int")).alias("sw")]
    for nd in (10, 30, 60):
        recent = F.col("close_seq") >= F.greatest(F.col(S.CNT) - nd + 1, F.lit(1))
        aggs.append(F.avg(F.when(recent, F.when(win, 100.0).otherwise(0.0))).alias(f"wr{nd}"))
    g = closes.groupBy(*k).agg(*aggs)
    g = strategies.join(g, k, "left").na.fill(0, ["t", "w", "l", "bt", "bw", "st", "sw"])

    def pct(a, b):
        return F.when(F.col(b) > 0, F.col(a) / F.col(b) * 100).otherwise(F.lit(0.0))
    m = {"Total Trades": F.col("t").cast("double"), "Win Rate (%)": pct("w", "t"),
         "Loss Rate (%)": pct("l", "t"),
         "Breakeven Rate (%)": F.when(F.col("t") > 0, (F.col("t") - F.col("w") - F.col("l")) / F.col("t") * 100)
         .otherwise(F.lit(0.0)),
         "Buy Wins (%)": pct("bw", "bt"), "Total Buy Trades": F.col("bt").cast("double"),
         "Short Wins (%)": pct("sw", "st"), "Total Short Trades": F.col("st").cast("double")}
    for nd in (10, 30, 60):
        m[f"win_rate_last_{nd}_trading_days"] = F.coalesce(F.col(f"wr{nd}"), F.lit(0.0))
    return [g.select(*k, F.explode(F.array(*[F.struct(F.lit(n).alias("metric"), e.cast("double").alias("value"))
                                            for n, e in m.items()])).alias("x")).select(*k, "x.*")]


# B13 ------------------------------------------------------------------------
def apr(kpi: DataFrame, eq: DataFrame, k: Sequence[str], periods: int = 252) -> DataFrame:
    """Calculated APR (%): (1 + R)^(1 / years) - 1 with years = rows / periods,
    only when the total return R is above -100 % (benchmark excluded)."""
    n = eq.groupBy(*k).agg(F.first(S.CNT).alias("_n"))
    tr = kpi.filter((F.col("metric") == "Total Return (%)") & (F.col("strategy") != BENCHMARK)) \
        .select(*k, F.col("value").alias("_tr"))
    j = tr.join(n, list(k), "inner")
    years = F.col("_n") / F.lit(float(periods))
    base = 1 + F.col("_tr") / 100
    ok = (F.col("_n") > 0) & F.col("_tr").isNotNull() & (F.col("_tr") > -100) & (base > 1e-9)
    return j.select(*k, F.when(ok, (F.pow(base, 1 / years) - 1) * 100).alias("apr_pct"))


# B15 ------------------------------------------------------------------------
def recent_actions(log: DataFrame, pos: DataFrame, k: Sequence[str], last: int = 90) -> DataFrame:
    """Open signals in the last ``last`` rows of each series."""
    rows = pos.select(*k, F.col("ts").alias("open_ts"), S.SEQ, S.CNT)
    o = log.filter(F.col("type") == "open").join(rows, [*k, "open_ts"], "inner")
    return o.filter(F.col(S.SEQ) > F.col(S.CNT) - last).select(*k, "open_ts", "side", "entry_price")
