"""Edge cases that must not change a result: nulls, uneven orders, repeated and infinite values, many chunks."""

import math
import uuid

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from kiln.functions import special as SP
from kiln.operators import aggregates as AG
from kiln.operators import indicators as I
from kiln.operators import joins as J
from kiln.operators import quantiles as Q
from kiln.operators import series as S
from kiln.operators import stats as ST
from kiln.session import ensure_checkpoint_dir, scratch_path
from kiln.sources import sinks as K
from kiln.streaming import chunked


def _odd(spark, order: str, n: int = 900):
    rng = np.random.default_rng(3)
    rows = []
    for i in range(n):
        key = None if i % 9 == 0 else ("hot" if i % 3 else "cold")
        if order == "text":
            o = None if i == 5 else f"{'a' * (i % 4)}{i:05d}"
        elif order == "narrow":
            o = None if i == 5 else 0.03 + 0.06 * float(rng.random()) + i * 1e-9
        else:
            o = None if i == 5 else float(i) if i < n - 3 else 1e12 + i
        rows.append((key, o, None if i % 5 == 3 else float(rng.integers(1, 100)), i))
    kind = "string" if order == "text" else "double"
    return spark.createDataFrame(rows, f"k string, o {kind}, x double, id long")


@pytest.mark.parametrize("order", ["text", "narrow", "skewed"])
def test_both_paths_give_the_same_rows(spark, order):
    df = _odd(spark, order)

    def run(size):
        spark.conf.set("kiln.series.blockRows", str(size))
        try:
            s = S.sequence(df, ["k"], ["o"])
            r = I.rolling_mean(s, ["k"], {"m": ("x", 40)})
            r = S.scan_fill(r, ["k"], {"f": "x"})
            r = S.scan_sum(r, ["k"], {"c": F.col("x")})
            r = S.ewm(r, ["k"], {"e": ("x", 0.2)})
            return S.single_block(s), {row["id"]: row.asDict() for row in r.select("k", "id", S.SEQ, S.CNT, "m", "f", "c", "e").collect()}
        finally:
            spark.conf.unset("kiln.series.blockRows")

    one, plain = run(1 << 20)
    many, cut = run(16)             # the frame of 40 rows reaches over several blocks
    assert one and not many and plain.keys() == cut.keys() and len(plain) == 900
    for i, a in plain.items():
        for c, v in a.items():
            w = cut[i][c]
            assert (v is None and w is None) or (math.isclose(v, w, rel_tol=1e-9) if isinstance(v, float) else v == w), (i, c)


@pytest.mark.parametrize("order", ["text", "narrow", "skewed"])
def test_parts_are_even(spark, order):
    df = _odd(spark, order)
    parts = df.repartitionByRange(15, "k", "o").groupBy(F.spark_partition_id()).count().collect()
    assert max(r["count"] for r in parts) < 2 * 900 / 15


def test_grouped_quantiles_with_repeats_and_null_groups(spark):
    rng = np.random.default_rng(1)
    rows = [(None if i % 4 == 0 else "g", float(rng.choice([1.0, 1.0, 1.0, 2.5, 7.0, float(i)]))) for i in range(700)]
    df = spark.createDataFrame(rows, "g string, v double")
    spark.conf.set("kiln.series.blockRows", "20")
    try:
        got = {r["g"]: r["q"] for r in Q.grouped_quantiles(df, ["g"], "v", [0.0, 0.1, 0.5, 0.77, 1.0]).collect()}
    finally:
        spark.conf.unset("kiln.series.blockRows")
    for g in (None, "g"):
        want = np.quantile([v for k, v in rows if k == g], [0.0, 0.1, 0.5, 0.77, 1.0])
        np.testing.assert_allclose(got[g], want)


def test_column_quantiles_with_infinite_values(spark):
    inf = float("inf")
    v = [-inf, -inf, *map(float, range(50)), inf, float("nan"), None]
    df = spark.createDataFrame([(x,) for x in v], "v double")
    got = Q.column_quantiles(df, "v", [0.0, 0.5, 1.0])
    assert got[0] == -inf and got[2] == inf and got[1] == 24.0


def test_modes(spark):
    df = spark.createDataFrame([("b", 2, None), ("a", 2, None), ("a", 1, None), ("b", 1, None), (None, 3, None)],
                               "s string, n int, z string")
    assert AG.modes(df, ["s", "n", "z"]) == {"s": "a", "n": 1, "z": None}


def test_chi_square_degrees_are_exact(spark):
    df = spark.range(9_000).select((F.col("id") % 3_000).alias("r"), (F.col("id") % 2).alias("c"))
    row = ST.chi_square(df, "r", "c").first()
    assert row["dof"] == 2_999
    table = np.array([[12, 0], [3, 9]])
    rows = [(i, j) for i in range(2) for j in range(2) for _ in range(table[i, j])]
    got = ST.chi_square(spark.createDataFrame(rows, "r int, c int"), "r", "c").first()["statistic"]
    e = np.outer(table.sum(1), table.sum(0)) / table.sum()
    d = np.abs(table - e)
    assert math.isclose(got, float((np.maximum(d - np.minimum(0.5, d), 0) ** 2 / e).sum()), rel_tol=1e-12)


def test_fisher_tails_equal_the_full_sum():
    rng = np.random.default_rng(2)
    for _ in range(300):
        a, b, c, d = (int(x) for x in rng.integers(0, 40, 4))
        n, r1, c1 = a + b + c + d, a + b, a + c
        ks = range(max(0, r1 - (n - c1)), min(r1, c1) + 1)
        p = {k: math.comb(c1, k) * math.comb(n - c1, r1 - k) / math.comb(n, r1) for k in ks}
        want = min(1.0, sum(v for v in p.values() if v <= p[a] * (1 + 1e-7)))
        assert abs(SP.fisher_two_sided(a, b, c, d) - want) < 1e-9
    assert 0 <= SP.fisher_two_sided(400_000_000, 600_000_000, 400_100_000, 599_900_000) <= 1


def test_p_values_stay_below_one(spark):
    df = spark.createDataFrame([(float(i % 50), g) for i in range(200) for g in ("a", "b")], "v double, g string")
    assert ST.choose_test(df, "v", "g", "a", "b").first()["p_value"] <= 1.0


def test_forward_histogram_from_a_zero_price(spark):
    df = spark.createDataFrame([("s", i, 0.0 if i == 0 else float(i)) for i in range(5)], "k string, ts long, p double")
    s = S.sequence(df, ["k"], ["ts"])
    rows = I.forward_return_hist(s, ["k"], "p", [float("-inf"), 0.0, 0.5, float("inf")], horizon=2).orderBy("ts").collect()
    assert rows[0]["y_bins"] == [0.0, 0.0, 1.0]


def test_outer_align_refuses_repeated_keys(spark):
    a = spark.createDataFrame([(1, 1.0), (1, 2.0)], "ts long, value double")
    with pytest.raises(Exception, match="repeats"):
        J.outer_align({"a": a}).collect()


def test_versions_are_claimed_once(spark):
    path = scratch_path(spark, f"registry-{uuid.uuid4().hex}")
    assert [K.register_version(spark, path, "d", "t") for _ in range(3)] == ["v1", "v2", "v3"]
    # a writer that read an old maximum goes on to the next free number
    import kiln.sources.sinks as sinks
    seen = sinks._claimed, sinks._latest
    sinks._claimed = sinks._latest = lambda *_: 0
    try:
        assert K.register_version(spark, path, "d", "t") == "v4"
    finally:
        sinks._claimed, sinks._latest = seen


def test_progress_of_more_than_a_hundred_chunks(spark):
    path = scratch_path(spark, f"many-chunks-{uuid.uuid4().hex}")
    df = spark.range(1_060).select("id", (F.col("id") % 106).cast("int").alias("chunk"))
    df.repartition(1).write.partitionBy("chunk").parquet(path)
    out = chunked.stream_progress(spark, path, df.schema, {"read": lambda b: b}, {"chunk": F.max("chunk"), "rows": F.count(F.lit(1))})
    rows = out.collect()
    assert len(rows) == 106 and {r["chunk"] for r in rows} == set(range(106)) and all(r["rows"] == 10 for r in rows)


def test_a_cluster_must_name_a_shared_folder(spark):
    class Conf:
        def get(self, *_):
            return None

    class Context:
        master = "spark://host:7077"

    class Session:
        conf, sparkContext = Conf(), Context()

    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        ensure_checkpoint_dir(Session())


def test_sequence_numbers_null_orders_first(spark):
    df = spark.createDataFrame([("a", None), ("a", 2), ("a", 1)], "k string, o int")
    w = Window.partitionBy("k").orderBy("o")
    got = S.sequence(df, ["k"], ["o"], target_rows=1).withColumn("rn", F.row_number().over(w)).collect()
    assert all(r[S.SEQ] == r["rn"] for r in got) and pd.isna(min(got, key=lambda r: r[S.SEQ])["o"])


def test_long_category_lists_are_joined_and_saved_with_the_model(spark):
    import shutil

    from pyspark.ml import PipelineModel

    from kiln.operators import features as FE
    from kiln.operators import text as TX
    rows = [(i, f"v{i % 1500:05d}", "x y" if i % 2 else "x z", i % 2) for i in range(3_000)]
    df = spark.createDataFrame(rows, "id long, c string, Name string, label int")
    model = FE.chain(FE.CategoryCodes(["c"], prefix="code_"), TX.WordFeatures(key="id", drop_text=False)).fit(df)
    assert "c" in model.stages[0].st["tables"]
    path = scratch_path(spark, f"saved-model-{uuid.uuid4().hex}")
    model.write().overwrite().save(path)
    before = sorted(map(tuple, model.transform(df).collect()))
    assert all(r[-5] == r[0] % 1500 for r in before)
    for stage in model.stages:
        for at in stage.st["tables"].values():
            shutil.rmtree(at.removeprefix("file:"))
    assert sorted(map(tuple, PipelineModel.load(path).transform(df).collect())) == before
    unseen = spark.createDataFrame([(0, "none", "x", 0), (1, None, None, 0)], df.schema)
    assert {r["code_c"] for r in PipelineModel.load(path).transform(unseen).collect()} == {-1}
