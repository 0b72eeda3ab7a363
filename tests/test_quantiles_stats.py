import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from kiln.functions import special as SP
from kiln.operators import quantiles as Q


PROBS = [0.0, 0.001, 0.1, 0.25, 0.5, 0.75, 0.99, 1.0]


@pytest.mark.parametrize("inside", [20_000, 100])
def test_exact_quantiles_of_few_rows(spark, inside):
    rng = np.random.default_rng(3)
    vals = np.concatenate([rng.normal(size=3000), np.full(500, 1.25), [np.nan] * 10])
    df = spark.createDataFrame([(float(v), 7.0, None) for v in vals], "v double, `a.b` double, z double").repartition(3)
    got = Q.multi_quantiles(df, {"v": PROBS, "a.b": [0.5], "z": [0.5, 1.0]}, inside=inside)
    np.testing.assert_allclose(got["v"], np.quantile(vals[~np.isnan(vals)], PROBS), rtol=0, atol=1e-12)
    assert got["a.b"] == [7.0] and got["z"] == [None, None]
    assert Q.multi_quantiles(df.limit(0), {"v": PROBS})["v"] == [None] * len(PROBS)


@pytest.mark.parametrize("inside", [20_000, 30])
def test_exact_quantiles_of_many_rows_in_two_scans(spark, inside):
    df = spark.range(60_000).select(
        F.pow((F.col("id") * 7919) % 60_000, 3).cast("double").alias("u"),
        F.when(F.col("id") % 3 == 0, 5.0).otherwise(F.sin("id")).alias("w"), (F.col("id") % 2).cast("double").alias("b")).persist()
    rows = df.toPandas()
    got = Q.multi_quantiles(df, {c: PROBS for c in "uwb"}, inside=inside)
    for c in "uwb":
        np.testing.assert_allclose(got[c], np.quantile(rows[c], PROBS), rtol=1e-12)


def test_infinite_values_of_many_rows(spark):
    df = spark.range(30_000).select(F.when(F.col("id") < 6_000, float("-inf")).when(F.col("id") >= 27_000, float("inf")).otherwise(
        F.col("id").cast("double")).alias("v"))
    got = Q.column_quantiles(df, "v", [0.0, 0.1, 0.5, 0.85, 1.0])
    np.testing.assert_allclose(got, [-np.inf, -np.inf, 14999.5, 25499.15, np.inf])


def test_special_functions():
    assert abs(SP.chi2_sf(3.841458820694124, 1) - 0.05) < 1e-9
    assert abs(SP.t_two_sided(2.0, 10) - 0.07338803477074) < 1e-9
    assert abs(SP.f_sf(3.0, 2, 20) - 1.3 ** -10) < 1e-12  # closed form for d1 = 2
    assert abs(SP.norm_sf(1.959963984540054) - 0.025) < 1e-12
    # Fisher exact two-sided on a classic table
    assert abs(SP.fisher_two_sided(8, 2, 1, 5) - 0.034965034965) < 1e-9
    assert SP.fisher_two_sided(1, 1, 1, 1) == 1.0
