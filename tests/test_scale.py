"""What keeps queries in proportion to their tables; rows are made here."""

import datetime as dt

import numpy as np
import pytest
from pyspark.sql import functions as F

from kiln.operators import stats as ST
from kiln.plans import q_etl, q_models


def _plan(df):
    return df._jdf.queryExecution().toString()


@pytest.fixture()
def shop(spark, tmp_path):
    """Customers and orders; order numbers of seven digits, so that passenger numbers of six repeat."""
    rng = np.random.default_rng(3)
    segments = ["AUTOMOBILE", "BUILDING", "FURNITURE", "HOUSEHOLD", "MACHINERY"]
    spark.createDataFrame([(i, f"Customer#{i:09d}", segments[i % 5], float(rng.uniform(-900, 9000))) for i in range(40)],
                          "c_custkey long, c_name string, c_mktsegment string, c_acctbal double").write.parquet(f"{tmp_path}/customer.parquet")
    spark.createDataFrame([(1_000_000 + i, int(rng.integers(40)), "FO"[i % 2], float(rng.uniform(1000, 400_000)),
                            f"{i % 5 + 1}-X", dt.date(1995, 1, 1 + i % 28)) for i in range(300)],
                          "o_orderkey long, o_custkey long, o_orderstatus string, o_totalprice double, o_orderpriority string, "
                          "o_orderdate date").write.parquet(f"{tmp_path}/orders.parquet")
    return str(tmp_path)


def test_distance_in_few_coordinates_is_an_expression(spark):
    rng = np.random.default_rng(1)
    x = rng.normal(size=(400, 3)) * (1, 50, 0.1) + (5, 1000, 0)
    df = spark.createDataFrame([(i, [float(a) for a in v]) for i, v in enumerate(x)], "id long, v array<double>")
    out = ST.robust_outliers(df, "v", contamination=0.05)
    assert "ArrowEval" not in _plan(out)
    kept = x
    for _ in range(4):
        inverse = np.linalg.pinv(np.cov(kept.T))
        z = x - kept.mean(axis=0)
        d = np.einsum("ij,jk,ik->i", z, inverse, z)
        kept = x[d <= np.quantile(d, 0.75)]
    got = {r["id"]: (r["mahalanobis"], r["outlier"]) for r in out.collect()}
    assert np.allclose([got[i][0] for i in range(400)], d, rtol=1e-7)
    assert [got[i][1] for i in range(400)] == (d > np.quantile(d, 0.95)).tolist()


@pytest.mark.parametrize("run", [q_etl.recommend, q_etl.recommended_pipeline])
def test_recommendations_read_a_joined_table_that_was_written(spark, shop, monkeypatch, run):
    seen, plain = [], q_etl.recommendations

    def recommendations(df, *args):
        seen.append(_plan(df))
        return plain(df, *args)
    monkeypatch.setattr(q_etl, "recommendations", recommendations)
    run(spark, shop)
    assert len(seen) == 1 and "Join" not in seen[0]


def test_custom_etl_takes_repeated_passenger_numbers(spark, shop):
    out = q_etl.custom_etl_query(spark, shop).persist()
    d = q_etl.O.random_split(q_etl.passengers(spark, shop), "PassengerId", 20)
    assert d.select("PassengerId").distinct().count() < 100
    assert sorted(r[0] for r in out.select("PassengerId").collect()) == sorted(
        r[0] for r in d.filter("split = 'test'").select("PassengerId").collect())
    assert out.filter(~(F.col("complete") & F.col("nearest") & F.col("sums") & F.col("finite"))).count() == 0
    out.unpersist()


def test_passing_tables_are_deleted_but_those_kept(spark):
    import os

    from kiln import session as S

    def there(df):
        return os.path.isdir(S._paths[df])
    before = spark.conf.get(S.RELEASE)
    with S.passing(spark) as keep:
        a, b = S.written(spark.range(3), "a"), keep(S.written(spark.range(4), "b"))
        c = S.settled(spark, lambda: S.written(spark.range(5), "inner").filter("id > 1"), "c")
        assert there(a) and there(b) and c.count() == 3
        with pytest.raises(InterruptedError), S.passing(spark):
            d = S.written(spark.range(6), "d")
            raise InterruptedError
        assert not there(d) and there(a) and spark.conf.get(S.RELEASE) == "true"
    assert not there(a) and there(b) and not there(c) and b.count() == 4
    assert spark.conf.get(S.RELEASE) == before and there(S.written(spark.range(2), "e"))


def test_custom_etl_leaves_the_passengers_and_its_result(spark, shop):
    import os

    at = q_etl.scratch_path(spark, "")
    before = set(os.listdir(at)) if os.path.isdir(at) else set()
    out = q_etl.custom_etl_features(spark, shop)
    left = sorted(n.rpartition("-")[0] for n in set(os.listdir(at)) - before)
    assert left == ["passengers", "registry", "test-filled", "word-stats"]
    assert out.filter("x IS NULL OR gmm_cluster IS NULL").count() == 0 < out.count()


def test_chunk_names_take_no_longer_in_long_folders(spark):
    import time

    from kiln.sources.files import CHUNK_NAME
    paths = ["file:///a/b=1/c=x=y/part-3.parquet", "/data/p=1/q/part-7=z.parquet", "one.csv", "/x/y/", "file:/d/k=/a_1.csv"]
    old = r"((?:[^/=]+=[^/]+/)*[^/]+)$"
    df = spark.createDataFrame([(p,) for p in paths], "p string")
    for r in df.select("p", F.regexp_extract("p", CHUNK_NAME, 1).alias("n"), F.regexp_extract("p", old, 1).alias("o")).collect():
        assert r["n"] == r["o"], r["p"]
    spent = []
    for n in (20, 2000):
        path = F.concat(F.lit("/" + "d" * n + "/part=0/"), (F.col("id") % 4).cast("string"))
        start = time.time()
        assert spark.range(2000).select(F.regexp_extract(path, CHUNK_NAME, 1).alias("n")).distinct().count() == 4
        spent.append(time.time() - start)
    assert spent[1] < spent[0] + 4


def test_custom_etl_reads_passengers_that_were_written(spark, shop, monkeypatch):
    seen = []

    def stopped(spark, train, test, registry):
        seen.extend([_plan(train), _plan(test)])
        raise InterruptedError
    monkeypatch.setattr(q_etl, "custom_etl", stopped)
    with pytest.raises(InterruptedError):
        q_etl.custom_etl_features(spark, shop)
    assert len(seen) == 2 and not any("Join" in p for p in seen)


def test_document_features_are_made_once(spark, tmp_path):
    spark.createDataFrame([(i, "red blue " * (i + 1)) for i in range(8)], "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([(i, i % 2) for i in range(8)], "doc_id long, quality int").write.parquet(f"{tmp_path}/labels.parquet")
    d = q_models._doc_features(spark, str(tmp_path))
    plan = _plan(d)
    assert "Join" not in plan and "regexp" not in plan
    assert [r["features"][256] for r in d.orderBy("doc_id").collect()] == [9.0 * (i + 1) for i in range(8)]
