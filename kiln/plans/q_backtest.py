"""Backtest queries (B1-B15, K6) on the daily price series.

Inputs: the daily price series (prices removed on a fixed calendar rule so the
null-price path is exercised) and a deterministic 9-class probability row per
(series, day) from an md5 scorer; class mean EVs are fixed parameters.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from kiln.operators import backtest as B
from kiln.operators import series as S
from kiln.plans.inputs import DAILY_SQL, daily_prices
from kiln.plans.registry import query
from kiln.plans.sqlkit import unsign
from kiln.session import cut_lineage
from kiln.sources import sinks as K

KEYS = ["series"]
N_CLASSES = 9
# Mean EV per predicted class (classes 0..8) used by the signals.
CLASS_EV = [-0.016, -0.012, -0.008, -0.004, 0.0, 0.004, 0.008, 0.012, 0.016]
PARAMS = B.Params(initial=100_000.0, trade_size=3_000.0, hold_apr=0.05, threshold=0.005, hold=30,
                  periods=252, window=62)
MODEL = "Model"


def scored_prices(spark, sf_dir):
    d = daily_prices(spark, sf_dir)
    price = F.when(F.dayofyear("ts") % 17 == 0, F.lit(None)).otherwise(F.col("price"))
    day = F.date_format("ts", "yyyy-MM-dd")
    w = [(F.conv(F.substring(F.md5(F.concat_ws("|", F.col("series"), day, F.lit(str(i)))), 1, 6), 16, 10)
          .cast("long") % 1000 + 1).alias(f"_w{i}") for i in range(N_CLASSES)]
    # staged: weights, their total, then the probability row (each computed once)
    d = d.select("series", "ts", price.alias("price"), *w)
    tot = F.col("_w0")
    for i in range(1, N_CLASSES):
        tot = tot + F.col(f"_w{i}")
    d = d.withColumn("_tot", tot)
    probs = F.array(*[F.col(f"_w{i}") / F.col("_tot") for i in range(N_CLASSES)])
    return d.select("series", "ts", "price", probs.alias("probs"))


def _run(spark, sf_dir, materialize: bool = False):
    d = scored_prices(spark, sf_dir)
    seq = S.sequence(d, KEYS, ["ts"])
    sig = B.signals(seq, KEYS, "price", "probs", CLASS_EV, PARAMS, MODEL)
    pos = B.positions(sig, KEYS, "price", PARAMS)
    if materialize:
        # positions feed several KPI passes: written once to the shared checkpoint folder
        pos = cut_lineage(pos)
    eq = B.equity(pos, B.benchmark(seq, KEYS, PARAMS), KEYS)
    return seq, pos, eq


# ------------------------------------------------------------------ SQL twins
TH = PARAMS.threshold
H = PARAMS.hold
EVS = "[" + ", ".join(repr(x) for x in CLASS_EV) + "]"
NAMES = B.strategy_names(MODEL)

BASE_SQL = "WITH " + DAILY_SQL + """,
px AS (SELECT series, ts, CASE WHEN dayofyear(ts) % 17 = 0 THEN NULL ELSE price END AS price FROM daily),
wt AS (SELECT series, ts, price, list_transform(range(""" + str(N_CLASSES) + """), lambda i:
         CAST(('0x' || substr(md5(series || '|' || strftime(ts, '%Y-%m-%d') || '|' || CAST(i AS VARCHAR)), 1, 6)) AS BIGINT) % 1000 + 1) AS w
       FROM px),
sc AS (SELECT series, ts, price, list_transform(w, lambda x: x / list_sum(w)) AS probs,
              row_number() OVER (PARTITION BY series ORDER BY ts) AS rn, count(*) OVER (PARTITION BY series) AS n
       FROM wt),
f AS (SELECT *, count(price) OVER fw AS fcnt, sum(price) OVER fw AS fsum,
             """ + EVS + """[list_position(probs, list_max(probs))] AS ev1,
             list_sort(list_transform(probs, lambda x, i: {'a': -x, 'b': -i})) AS ord,
             list_sum(list_transform(list_zip(probs, """ + EVS + """), lambda z: CASE WHEN z[2] > """ + repr(TH) + """ THEN z[1] ELSE 0.0 END)) AS pm,
             list_sum(list_transform(list_zip(probs, """ + EVS + """), lambda z: CASE WHEN z[2] < -""" + repr(TH) + """ THEN z[1] ELSE 0.0 END)) AS nm
      FROM sc WINDOW fw AS (PARTITION BY series ORDER BY rn ROWS BETWEEN 1 FOLLOWING AND """ + str(H) + """ FOLLOWING)),
g AS (SELECT *, """ + EVS + """[-(ord[1].b)] AS e1, """ + EVS + """[-(ord[2].b)] AS e2,
             fsum / """ + str(H) + """ / price AS factor,
             price IS NOT NULL AND price <> 0 AS valid FROM f),
dirs AS (SELECT series, ts, price, rn, n, valid,
  CASE WHEN ev1 > {th} THEN 1 WHEN ev1 < -{th} THEN -1 ELSE 0 END AS d_top1,
  CASE WHEN e1 > {th} AND e2 > {th} THEN 1 WHEN e1 < -{th} AND e2 < -{th} THEN -1 ELSE 0 END AS d_top2,
  CASE WHEN pm > 0.9 THEN 1 WHEN nm > 0.9 THEN -1 ELSE 0 END AS d_c90,
  CASE WHEN pm > 0.75 THEN 1 WHEN nm > 0.75 THEN -1 ELSE 0 END AS d_c75,
  CASE WHEN pm > 0.6 THEN 1 WHEN nm > 0.6 THEN -1 ELSE 0 END AS d_c60,
  CASE WHEN rn + {h} <= n AND fcnt = {h} AND factor > 1 + {th} THEN 1
       WHEN rn + {h} <= n AND fcnt = {h} AND factor < 1 - {th} THEN -1 ELSE 0 END AS d_perf
  FROM g),
sig AS (
  SELECT series, ts, price, rn, n, s.strategy, CASE WHEN valid THEN s.dir ELSE 0 END AS dir
  FROM dirs, LATERAL (SELECT unnest([{{'strategy': '{n0}', 'dir': d_top1}}, {{'strategy': '{n1}', 'dir': d_top2}},
                                     {{'strategy': '{n2}', 'dir': d_c90}}, {{'strategy': '{n3}', 'dir': d_c75}},
                                     {{'strategy': '{n4}', 'dir': d_c60}}, {{'strategy': 'Perfect Foresight', 'dir': d_perf}}], recursive := true)) s),
u AS (SELECT *, CASE WHEN dir <> 0 THEN dir * ({ts} / price) / {h} ELSE 0.0 END AS ud FROM sig),
w AS (SELECT *, ud * price AS udp FROM u),
pw AS (SELECT *,
         sum(ud) OVER (PARTITION BY series, strategy ORDER BY rn ROWS BETWEEN {h} PRECEDING AND 1 PRECEDING) AS a,
         sum(udp) OVER (PARTITION BY series, strategy ORDER BY rn ROWS BETWEEN {h} PRECEDING AND 1 PRECEDING) AS b,
         sum(price) OVER (PARTITION BY series, strategy ORDER BY rn ROWS BETWEEN 1 FOLLOWING AND {h} FOLLOWING) AS sp,
         count(price) OVER (PARTITION BY series, strategy ORDER BY rn ROWS BETWEEN 1 FOLLOWING AND {h} FOLLOWING) AS cp,
         lead(ts, {h}) OVER (PARTITION BY series, strategy ORDER BY rn) AS close_ts,
         lead(price, {h}) OVER (PARTITION BY series, strategy ORDER BY rn) AS exit_price
       FROM w),
dp AS (SELECT *, CASE WHEN price IS NOT NULL THEN price * coalesce(a, 0.0) - coalesce(b, 0.0) ELSE 0.0 END AS daily_pnl,
              CASE WHEN dir <> 0 THEN ud * (coalesce(sp, 0.0) - cp * price) END AS trade_pnl,
              dir <> 0 AND rn + {h} <= n AS closed FROM pw),
pos AS (SELECT *, {v0} + sum(daily_pnl) OVER (PARTITION BY series, strategy ORDER BY rn
                  ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS value,
               CASE WHEN closed THEN rn + {h} END AS close_seq FROM dp),
eq AS (SELECT series, strategy, ts, rn, n, value, daily_pnl FROM pos
       UNION ALL
       SELECT series, 'Hold Benchmark', ts, rn, n, {v0} * power(1.0 + {r}, CAST(rn AS DOUBLE)), NULL FROM sc)""".format(
    th=repr(TH), h=H, n0=NAMES[0], n1=NAMES[1], n2=NAMES[2], n3=NAMES[3], n4=NAMES[4],
    ts=repr(PARAMS.trade_size), v0=repr(PARAMS.initial),
    r=repr((1.0 + PARAMS.hold_apr) ** (1.0 / PARAMS.periods) - 1.0))


# Equity curves -------------------------------------------------------------
@query("b06_equity_curves", unsign(BASE_SQL + """
SELECT series, strategy, ts, round(value, 4) AS value FROM eq""", ["value"]),
       covers=("B1", "B2", "B3", "B4", "B5", "B6", "B7", "W19", "J7"))
def equity_curves(spark, sf_dir):
    _, _, eq = _run(spark, sf_dir)
    return eq.select("series", "strategy", "ts", (F.round("value", 4) + F.lit(0.0)).alias("value"))


# Trade log --------------------------------------------------------------------
@query("b08_trade_log", unsign(BASE_SQL + """
SELECT series, strategy, 'open' AS type, ts AS open_ts, CAST(NULL AS TIMESTAMP) AS close_ts,
       CASE WHEN dir = 1 THEN 'long' ELSE 'short' END AS side, price AS entry_price,
       CAST(NULL AS DOUBLE) AS exit_price, CAST(NULL AS DOUBLE) AS pnl
FROM pos WHERE dir <> 0
UNION ALL
SELECT series, strategy, 'close', ts, close_ts, CASE WHEN dir = 1 THEN 'long' ELSE 'short' END, price,
       exit_price, round(trade_pnl, 6)
FROM pos WHERE closed""", ["pnl"]), covers=("B8",))
def trade_log(spark, sf_dir):
    _, pos, _ = _run(spark, sf_dir)
    log = B.trade_log(pos, KEYS, "price", PARAMS)
    return log.select("series", "strategy", "type", "open_ts", "close_ts", "side", "entry_price", "exit_price",
                      (F.round("pnl", 6) + F.lit(0.0)).alias("pnl"))


# B9-B12 + B14: KPI table -------------------------------------------------------------
def _sharpe_sql(m: str, s: str, n: str) -> str:
    return (f"CASE WHEN {n} < 2 THEN CASE WHEN {n} = 1 AND {m} = 0 THEN 0.0 END "
            f"WHEN {s} > 1e-9 THEN {m} / {s} * sqrt({float(PARAMS.periods)!r}) WHEN {m} = 0 THEN 0.0 END")


def _kpi_sql() -> str:
    win = PARAMS.window
    parts = [f"""
SELECT series, strategy, 'Final Portfolio Value' AS metric, max_by(value, rn) AS value FROM r GROUP BY 1, 2
UNION ALL SELECT series, strategy, 'Total Return (%)', (max_by(value, rn) / {PARAMS.initial!r} - 1) * 100 FROM r GROUP BY 1, 2
UNION ALL SELECT series, strategy, 'Sharpe Ratio (Annualized, All-Time)', {_sharpe_sql('avg(ret)', 'stddev_samp(ret)', 'count(*)')} FROM r GROUP BY 1, 2
UNION ALL SELECT series, strategy, 'Avg Daily Return (%)', avg(ret) * 100 FROM r GROUP BY 1, 2
UNION ALL SELECT series, strategy, 'Std Dev Daily Return (%)', CASE WHEN count(*) > 1 THEN stddev_samp(ret) * 100 ELSE 0.0 END FROM r GROUP BY 1, 2"""]
    for nd in (10, 30, 60):
        parts.append(f"""
UNION ALL SELECT series, strategy, 'sharpe_ratio_last_{nd}_trading_days', {_sharpe_sql('avg(ret)', 'stddev_samp(ret)', 'count(*)')}
  FROM r WHERE rn >= greatest(n - {nd} + 1, 1) GROUP BY 1, 2
UNION ALL SELECT e.series, e.strategy, 'running_total_returns_last_{nd}_trading_days',
  (e.value / coalesce(s.value, {PARAMS.initial!r}) - 1) * 100
  FROM (SELECT * FROM r WHERE rn = n) e LEFT JOIN (SELECT * FROM r WHERE rn = n - {nd}) s USING (series, strategy)
UNION ALL SELECT t.series, t.strategy, 'win_rate_last_{nd}_trading_days', coalesce(c.v, 0.0)
  FROM (SELECT series, strategy, n FROM r WHERE rn = n AND strategy <> 'Hold Benchmark') t
  LEFT JOIN (SELECT p.series, p.strategy, avg(CASE WHEN trade_pnl > 1e-6 THEN 100.0 ELSE 0.0 END) AS v
             FROM pos p JOIN (SELECT series, max(n) AS n FROM sc GROUP BY 1) m USING (series)
             WHERE closed AND close_seq >= greatest(m.n - {nd} + 1, 1) GROUP BY 1, 2) c USING (series, strategy)""")
    parts.append(f"""
UNION ALL SELECT series, strategy, 'Avg Rolling {win}-Day Sharpe', avg(sharpe) FROM rw GROUP BY 1, 2
UNION ALL SELECT series, strategy, 'Avg Rolling {win}-Day Long Win Rate (%)', avg(lwr) FROM rw GROUP BY 1, 2
UNION ALL SELECT series, strategy, 'Avg Rolling {win}-Day Short Win Rate (%)', avg(swr) FROM rw GROUP BY 1, 2""")
    stats = {"Total Trades": "CAST(t AS DOUBLE)", "Win Rate (%)": "CASE WHEN t > 0 THEN w / t * 100 ELSE 0.0 END",
             "Loss Rate (%)": "CASE WHEN t > 0 THEN l / t * 100 ELSE 0.0 END",
             "Breakeven Rate (%)": "CASE WHEN t > 0 THEN (t - w - l) / t * 100 ELSE 0.0 END",
             "Buy Wins (%)": "CASE WHEN bt > 0 THEN bw / bt * 100 ELSE 0.0 END",
             "Total Buy Trades": "CAST(bt AS DOUBLE)",
             "Short Wins (%)": "CASE WHEN st > 0 THEN sw / st * 100 ELSE 0.0 END",
             "Total Short Trades": "CAST(st AS DOUBLE)"}
    for name, e in stats.items():
        parts.append(f"\nUNION ALL SELECT series, strategy, '{name}', {e} FROM ts_")
    body = "".join(parts)
    return BASE_SQL + f""",
r AS (SELECT *, CASE WHEN daily_pnl = 0 THEN 0.0 ELSE coalesce(value / coalesce(lag(value) OVER (PARTITION BY series, strategy ORDER BY rn), {PARAMS.initial!r}) - 1, 0.0) END AS ret FROM eq),
rwin AS (SELECT series, strategy, CAST(floor((rn - 1) / {win}) AS BIGINT) AS wid, avg(ret) AS m, stddev_samp(ret) AS s, count(*) AS c
         FROM r WHERE floor((rn - 1) / {win}) < floor(n / {win}) GROUP BY 1, 2, 3),
cw AS (SELECT series, strategy, CAST(floor((close_seq - 1) / {win}) AS BIGINT) AS wid,
              sum(CASE WHEN dir = 1 THEN 1 ELSE 0 END) AS lt, sum(CASE WHEN dir = 1 AND trade_pnl > 1e-6 THEN 1 ELSE 0 END) AS lw,
              sum(CASE WHEN dir = -1 THEN 1 ELSE 0 END) AS st, sum(CASE WHEN dir = -1 AND trade_pnl > 1e-6 THEN 1 ELSE 0 END) AS sw
       FROM pos WHERE closed GROUP BY 1, 2, 3),
rw AS (SELECT rwin.series, rwin.strategy, CASE WHEN c >= 2 THEN {_sharpe_sql('m', 's', 'c')} END AS sharpe,
              CASE WHEN coalesce(lt, 0) > 0 THEN lw / lt * 100 ELSE 0.0 END AS lwr,
              CASE WHEN coalesce(st, 0) > 0 THEN sw / st * 100 ELSE 0.0 END AS swr
       FROM rwin LEFT JOIN cw USING (series, strategy, wid)),
tc AS (SELECT series, strategy, count(*) AS t, sum(CASE WHEN trade_pnl > 1e-6 THEN 1 ELSE 0 END) AS w,
              sum(CASE WHEN trade_pnl < -1e-6 THEN 1 ELSE 0 END) AS l,
              sum(CASE WHEN dir = 1 THEN 1 ELSE 0 END) AS bt, sum(CASE WHEN dir = 1 AND trade_pnl > 1e-6 THEN 1 ELSE 0 END) AS bw,
              sum(CASE WHEN dir = -1 THEN 1 ELSE 0 END) AS st, sum(CASE WHEN dir = -1 AND trade_pnl > 1e-6 THEN 1 ELSE 0 END) AS sw
       FROM pos WHERE closed GROUP BY 1, 2),
ts_ AS (SELECT k.series, k.strategy, coalesce(t, 0) AS t, coalesce(w, 0) AS w, coalesce(l, 0) AS l, coalesce(bt, 0) AS bt,
               coalesce(bw, 0) AS bw, coalesce(st, 0) AS st, coalesce(sw, 0) AS sw
        FROM (SELECT DISTINCT series, strategy FROM pos) k LEFT JOIN tc USING (series, strategy)),
kpi AS ({body})"""


KPI_SQL = _kpi_sql()


@query("b14_backtest_kpis", unsign(KPI_SQL + "\nSELECT series, strategy, metric, round(value, 6) AS value FROM kpi",
                                   ["value"]), covers=("B9", "B10", "B11", "B12", "B14"))
def backtest_kpis(spark, sf_dir):
    _, pos, eq = _run(spark, sf_dir, materialize=True)
    k = B.kpis(eq, pos, KEYS, PARAMS)
    return k.select("series", "strategy", "metric", (F.round("value", 6) + F.lit(0.0)).alias("value"))


# B13 ------------------------------------------------------------------------------
@query("b13_apr", unsign(KPI_SQL + f"""
SELECT k.series, k.strategy,
  CASE WHEN value IS NOT NULL AND value > -100 AND 1 + value / 100 > 1e-9
       THEN round((power(1 + value / 100, 1.0 / (n / {float(PARAMS.periods)!r})) - 1) * 100, 6) END AS apr_pct
FROM kpi k JOIN (SELECT series, max(n) AS n FROM sc GROUP BY 1) m USING (series)
WHERE metric = 'Total Return (%)' AND strategy <> 'Hold Benchmark'""", ["apr_pct"]), covers=("B13",))
def apr(spark, sf_dir):
    _, pos, eq = _run(spark, sf_dir, materialize=True)
    k = B.kpis(eq, pos, KEYS, PARAMS)
    a = B.apr(k, eq, KEYS + ["strategy"], PARAMS.periods)
    return a.select("series", "strategy", (F.round("apr_pct", 6) + F.lit(0.0)).alias("apr_pct"))


# B15 ------------------------------------------------------------------------------
@query("b15_recent_actions", BASE_SQL + """
SELECT series, strategy, ts AS open_ts, CASE WHEN dir = 1 THEN 'long' ELSE 'short' END AS side, price AS entry_price
FROM pos WHERE dir <> 0 AND rn > n - 90""", covers=("B15", "O3"))
def recent_actions(spark, sf_dir):
    _, pos, _ = _run(spark, sf_dir)
    log = B.trade_log(pos, KEYS, "price", PARAMS)
    return B.recent_actions(log, pos, KEYS + ["strategy"])


# K6: metrics sink rows ----------------------------------------------------------------
def _metric_sql() -> str:
    allowed = " OR ".join(f"starts_with(trim(metric), '{a}')" for a in K.ALLOWED_METRIC_PREFIXES)
    return KPI_SQL + f"""
SELECT series, strategy, regexp_replace(string_split(trim(strategy), ' ')[-1] || '.' || replace(metric, ' ', '_'),
       '[^\\w\\s\\-.:/]', '', 'g') AS key, round(value, 6) AS value
FROM kpi WHERE strategy NOT LIKE '%Perfect Foresight%' AND strategy NOT LIKE '%Hold Benchmark%' AND ({allowed})"""


@query("k06_metrics_sink", unsign(_metric_sql(), ["value"]), covers=("K6",))
def metrics_sink(spark, sf_dir):
    _, pos, eq = _run(spark, sf_dir, materialize=True)
    rows = K.metric_rows(B.kpis(eq, pos, KEYS, PARAMS), keep=["series"])
    return rows.withColumn("value", F.round("value", 6) + F.lit(0.0))
