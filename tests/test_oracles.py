"""Every query that has a SQL statement equals it at sf0.001."""

import math
from decimal import Decimal

import duckdb
import pytest

import __spark_entry__ as entry
from kiln.plans import catalog
from kiln.tables import TABLES

SF = "/root/testdata/sf0.001"


def _norm(v):
    if isinstance(v, Decimal):
        v = float(v)
    if isinstance(v, float):
        return "NaN" if math.isnan(v) else v
    if isinstance(v, (list, tuple)):
        return tuple(_norm(x) for x in v)
    if hasattr(v, "isoformat"):
        return v.isoformat()
    return v


def _digest(cols, rows):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    return sorted(repr(tuple(_norm(r[i]) for i in order)) for r in rows)


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    return c


def _close(a, b):
    """Equal but for the last of six decimals, which engines may round apart at a tie."""
    if isinstance(a, float) and isinstance(b, float):
        return a == b or abs(a - b) <= 1.1e-6 + 1e-12 * abs(a)
    if isinstance(a, tuple) and isinstance(b, tuple):
        return len(a) == len(b) and all(map(_close, a, b))
    return a == b


@pytest.mark.parametrize("name", sorted(catalog.ORACLE))
def test_query_matches_its_statement(spark, con, name):
    df = entry.queries()[name](spark, SF)
    cur = con.execute(catalog.ORACLE[name])
    names = [d[0] for d in cur.description]
    got, want = [tuple(r) for r in df.collect()], cur.fetchall()
    assert sorted(df.columns) == sorted(names)
    got, want = _digest(df.columns, got), _digest(names, want)
    assert len(got) == len(want)
    if got != want:
        pairs = [(eval(a.replace("inf", "1e999")), eval(b.replace("inf", "1e999"))) for a, b in zip(got, want)]
        assert all(_close(a, b) for a, b in pairs)


# Fits have no SQL form; test_models.py, test_trees.py and test_clustering.py compare them with plain versions.
FITS = {"m01_decision_tree", "m02_random_forest_weighted", "m03_logistic_regression", "m03_linear_regression", "m04_linear_svc",
        "m07_boosted_trees", "m08_multilayer_perceptron", "m09_multi_output_regression", "m11_parameter_sweep", "m12_feature_feedback",
        "m12_threshold_scores", "m13_first_chunk_scoring", "m14_chunk_ensemble", "f16_kmeans_features", "f17_gmm_features",
        "f18_ica_components", "f19_pca_projection", "f22_distribution_clusters", "f24_custom_etl_features", "t09_robust_outliers"}


def test_every_other_query_has_a_statement():
    assert set(catalog.QUERIES) - set(catalog.ORACLE) == FITS


def test_entry(spark):
    df = entry.entry(spark)
    rows = df.collect()
    assert len(rows) > 500 and "rsi_14" in df.columns
    assert all(0 <= r["rsi_14"] <= 100 for r in rows if r["rsi_14"] is not None)
