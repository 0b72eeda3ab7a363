from pyspark.sql import functions as F

from kiln.operators import backtest as B
from kiln.operators import series as S


def _run(spark):
    rows = []
    for t in range(120):
        price = None if t % 17 == 5 else 100.0 + (t % 9) - 4 + t * 0.05
        probs = [0.05] * 9
        probs[(t * 7) % 9] = 0.6
        rows.append(("s", t, price, probs))
    df = spark.createDataFrame(rows, "series string, ts long, price double, probs array<double>")
    p = B.Params(hold=5, window=20)
    seq = S.sequence(df, ["series"], ["ts"])
    ev = [-0.02, -0.01, -0.006, 0.0, 0.0, 0.0, 0.006, 0.01, 0.02]
    sig = B.signals(seq, ["series"], "price", "probs", ev, p, "M")
    pos = B.positions(sig, ["series"], "price", p)
    return pos, p


def test_equity_is_initial_plus_pnl(spark):
    pos, p = _run(spark)
    agg = pos.groupBy("strategy").agg(F.max_by("value", "_seq").alias("final"), F.sum("daily_pnl").alias("pnl"))
    for r in agg.collect():
        assert abs(r["final"] - (p.initial + r["pnl"])) < 1e-6


def test_closed_trades_close_hold_rows_later(spark):
    pos, p = _run(spark)
    closed = pos.filter("closed")
    assert closed.filter(F.col("close_seq") != F.col("_seq") + p.hold).count() == 0
    assert pos.filter("closed AND _seq + 5 > _n").count() == 0


def test_multi_block_backtest_equals_single_block(spark):
    """Positions, equity and trade P&L are identical when every series is cut
    into 7-row blocks (halo rows + block scans) and when it is one block."""
    def collect():
        pos, _ = _run(spark)
        return sorted((r["strategy"], r["_seq"], round(r["value"], 6), r["dir"],
                       None if r["trade_pnl"] is None else round(r["trade_pnl"], 6), r["closed"])
                      for r in pos.collect())
    single = collect()
    spark.conf.set("kiln.series.blockRows", "7")
    try:
        multi = collect()
    finally:
        spark.conf.unset("kiln.series.blockRows")
    assert single == multi
