"""Series machinery: the multi-block path must equal plain per-key windows."""

import numpy as np
import pytest
import pandas as pd
from pyspark.sql import Window
from pyspark.sql import functions as F

from kiln.operators import indicators as I
from kiln.operators import series as S


def _frame(spark):
    rows = []
    rng = np.random.default_rng(7)
    # one hot key with most rows, a few small keys, nulls sprinkled in
    for key, n in (("hot", 60), ("a", 9), ("b", 3), ("c", 1)):
        for t in range(n):
            v = None if (t % 5 == 3) else float(rng.integers(1, 100))
            rows.append((key, t * 10 + (3 if key == "hot" else 0), v))
    return spark.createDataFrame(rows, "k string, ts long, x double")


def test_sequence_matches_row_number(spark, small_blocks):
    df = _frame(spark)
    s = S.sequence(df, ["k"], ["ts"])
    assert not S.single_block(s)
    w = Window.partitionBy("k").orderBy("ts")
    chk = s.withColumn("rn", F.row_number().over(w)).withColumn("n", F.count("*").over(Window.partitionBy("k")))
    assert chk.filter("rn != _seq OR n != _n").count() == 0


def test_single_block_fast_path(spark):
    s = S.sequence(_frame(spark), ["k"], ["ts"])
    assert S.single_block(s)


def test_rolling_and_scans_match_pandas(spark, small_blocks):
    df = _frame(spark)
    s = S.sequence(df, ["k"], ["ts"])
    r = I.rolling_mean(s, ["k"], {"m5": ("x", 5)})
    r = I.fill(r.withColumn("ff", F.col("x")), ["k"], ["ff"], "ffill")
    r = I.fill(r.withColumn("bf", F.col("x")), ["k"], ["bf"], "bfill")
    r = S.scan_sum(r, ["k"], {"cs": F.col("x")})
    r = S.ewm(r.withColumn("xf", F.coalesce("ff", "bf")), ["k"], {"e": ("xf", 0.3)})
    got = r.select("k", "ts", "m5", "ff", "bf", "cs", "e").toPandas().sort_values(["k", "ts"])
    pdf = df.toPandas().sort_values(["k", "ts"])
    for key, g in pdf.groupby("k"):
        mine = got[got.k == key].reset_index(drop=True)
        x = g["x"].reset_index(drop=True)
        np.testing.assert_allclose(mine["m5"], x.rolling(5, min_periods=1).mean(), rtol=1e-12, equal_nan=True)
        np.testing.assert_allclose(mine["ff"], x.ffill(), equal_nan=True)
        np.testing.assert_allclose(mine["bf"], x.bfill(), equal_nan=True)
        np.testing.assert_allclose(mine["cs"], x.fillna(0).cumsum(), rtol=1e-12)
        xf = x.ffill().bfill()
        np.testing.assert_allclose(mine["e"], xf.ewm(alpha=0.3, adjust=False).mean(), rtol=1e-10)


@pytest.mark.parametrize("size,run,width", [(1 << 20, 1 << 15, 256), (1 << 20, 5, 3), (7, 4, 2), (7, 1, 2), (50, 1000, 4)])
def test_ewm_is_the_same_at_every_run_and_block_size(spark, monkeypatch, size, run, width):
    monkeypatch.setattr(S, "RUN_ROWS", run)
    monkeypatch.setattr(S, "SCAN_CHUNK", 3)
    monkeypatch.setattr(S, "SCAN_WIDTH", width)
    rng = np.random.default_rng(2)
    rows = [(k, i, None if i < 3 or rng.random() < 0.2 else float("nan") if rng.random() < 0.05 else float(rng.normal() * 10 ** rng.integers(0, 6)))
            for k, n in (("a", 120), (None, 40), ("one", 1), ("none", 3)) for i in range(n)]
    df = spark.createDataFrame(rows, "k string, ts int, x double")
    spark.conf.set("kiln.series.blockRows", str(size))
    try:
        got = S.ewm(S.sequence(df, ["k"], ["ts"]), ["k"], {"e": ("x", 0.3), "s": ("x", 0.01), "q": ("x", 0.97), "h": ("x", 1.0)})
        plan = got._jdf.queryExecution().toString()
        got = {(r["k"], r["ts"]): r for r in got.collect()}
    finally:
        spark.conf.unset("kiln.series.blockRows")
    assert "Pandas" not in plan and "Python" not in plan and "Arrow" not in plan
    assert len(got) == len(rows)
    for k in ("a", None, "one", "none"):
        x = [v for key, _, v in rows if key == k]
        for name, alpha in (("e", 0.3), ("s", 0.01), ("q", 0.97), ("h", 1.0)):
            y = None
            for t, v in enumerate(x):
                if v is not None and v == v:
                    y = v if y is None else (1 - alpha) * y + alpha * v
                mine = got[k, t][name]
                assert (mine is None) == (y is None) and (y is None or abs(mine - y) <= 1e-9 * max(1, abs(y), max(map(abs, filter(None, x))) * 1e-3))


def test_interpolate_matches_pandas(spark, small_blocks):
    df = _frame(spark)
    s = S.sequence(df, ["k"], ["ts"])
    r = I.interpolate_linear(s.withColumn("xi", F.col("x")), ["k"], ["xi"]).toPandas().sort_values(["k", "ts"])
    pdf = df.toPandas().sort_values(["k", "ts"])
    for key, g in pdf.groupby("k"):
        exp = g["x"].reset_index(drop=True).interpolate(method="linear", limit_direction="both")
        np.testing.assert_allclose(r[r.k == key]["xi"].reset_index(drop=True), exp, rtol=1e-12, equal_nan=True)


def test_forward_hist_rows_sum_to_one(spark):
    from kiln.functions import arrays as A
    df = spark.range(80).select(F.lit("s").alias("k"), F.col("id").alias("ts"),
                                (100 + F.sin(F.col("id")) * 5).alias("p"))
    s = S.sequence(df, ["k"], ["ts"])
    h = I.forward_return_hist(s, ["k"], "p", A.BIN_EDGES, horizon=10)
    rows = h.orderBy("ts").collect()
    assert all(r["y_bins"] is None for r in rows[-10:])
    for r in rows[:-10]:
        assert abs(sum(r["y_bins"]) - 1.0) < 1e-12


def test_indicators_multi_block_equal_single_block(spark):
    """The full indicator pipeline (fills, 50-row frames, nested EWMAs) gives
    the same numbers when each series is cut into 60-row blocks."""
    from kiln.plans import q_series
    sf = "/root/testdata/sf0.001"

    def run():
        d = q_series.bar_indicators(spark, sf)
        return sorted(tuple(None if v is None else (round(v, 6) if isinstance(v, float) else v) for v in r)
                      for r in d.collect())
    single = run()
    spark.conf.set("kiln.series.blockRows", "60")
    try:
        multi = run()
    finally:
        spark.conf.unset("kiln.series.blockRows")
    assert len(single) == len(multi) > 0
    diffs = [(a, b) for a, b in zip(single, multi) if a != b]
    assert not diffs, diffs[:3]
