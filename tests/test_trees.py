"""Histogram trees against plain growing on the same bins."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from kiln.operators import trees as T


def _plain_tree(bins, mass, sums, depth, penalty, least, features):
    """Nested (feature, cut, left, right) or a leaf value; all cuts tried one by one."""
    m, s = mass.sum(), sums.sum(axis=0)
    value = s / (m + penalty) if m + penalty > 0 else s * 0
    best = None
    if depth:
        for f in features:
            for cut in range(int(bins[:, f].max()) if len(bins) else 0):
                left = bins[:, f] <= cut
                ml, mr, sl, sr = mass[left].sum(), mass[~left].sum(), sums[left].sum(axis=0), sums[~left].sum(axis=0)
                if ml < least or mr < least:
                    continue
                gain = (sl @ sl) / (ml + penalty) + (sr @ sr) / (mr + penalty) - (s @ s) / (m + penalty)
                if gain > 1e-9 and (best is None or gain > best[0] + 1e-9 * max(1, best[0])):
                    best = (gain, f, cut, left)
    if best is None:
        return value
    _, f, cut, left = best
    return (f, cut, *[_plain_tree(bins[k], mass[k], sums[k], depth - 1, penalty, least, features) for k in (left, ~left)])


def _plain_value(tree, row):
    while isinstance(tree, tuple):
        tree = tree[2] if row[tree[0]] <= tree[1] else tree[3]
    return tree


@pytest.fixture(scope="module")
def table(spark):
    rng = np.random.default_rng(8)
    x = rng.normal(size=(300, 4))
    x[rng.random(300) < 0.05, 1] = np.nan
    y = (x[:, 0] > 0).astype(int) + (np.nan_to_num(x[:, 1]) + x[:, 2] > 0.5)
    target = np.exp(np.c_[x[:, 0], x[:, 2] ** 2, x[:, 3], np.zeros(300)])
    target /= target.sum(axis=1, keepdims=True)
    rows = [(i, [None if np.isnan(v) else float(v) for v in x[i]], float(y[i]), [float(v) for v in target[i]], 1.0 + (i % 3))
            for i in range(300)]
    df = spark.createDataFrame(rows, "id long, features array<double>, label double, target array<double>, weight double")
    return df.repartition(5).persist(), x, y, target


@pytest.mark.parametrize("weighted", [False, True])
def test_boosting_equals_a_plain_version(table, weighted):
    df, x, y, _ = table
    est = T.Boosting(maxIter=4, maxDepth=3, bins=8, stepSize=0.3, weightCol="weight" if weighted else None)
    model = est.fit(df)
    bins = T.binned(x, model.edges)
    w = 1.0 + (np.arange(300) % 3) if weighted else np.ones(300)
    margin = np.tile(np.log([w[y == c].sum() / w.sum() for c in range(3)]), (300, 1))
    for _ in range(4):
        p = np.exp(margin) / np.exp(margin).sum(axis=1, keepdims=True)
        step = np.zeros_like(margin)
        for c in range(3):
            tree = _plain_tree(bins, w * p[:, c] * (1 - p[:, c]), (w * ((y == c) - p[:, c]))[:, None], 3, 1.0, 1e-3, range(4))
            step[:, c] = [_plain_value(tree, b)[0] for b in bins]
        margin = margin + 0.3 * step
    want = np.exp(margin) / np.exp(margin).sum(axis=1, keepdims=True)
    got = {r["id"]: (r["prediction"], r["probability"].toArray()) for r in model.transform(df).collect()}
    np.testing.assert_allclose([got[i][1] for i in range(300)], want, rtol=1e-9)
    assert [got[i][0] for i in range(300)] == want.argmax(axis=1).tolist()
    assert np.mean(want.argmax(axis=1) == y) > 0.9


def test_vector_forest_equals_a_plain_version(table):
    df, x, _, target = table
    model = T.VectorForest(numTrees=3, maxDepth=3, bins=8, share=1.0, bootstrap=False, targetCol="target").fit(df)
    bins = T.binned(x, model.edges)
    tree = _plain_tree(bins, np.ones(300), target, 3, 0.0, 1.0, range(4))
    got = {r["id"]: r["probability"].toArray() for r in model.transform(df).collect()}
    np.testing.assert_allclose([got[i] for i in range(300)], [_plain_value(tree, b) for b in bins], rtol=1e-9)
    assert all(abs(v.sum() - 1) < 1e-9 for v in got.values())


def test_forest_weights_features_groups_and_waves(table, monkeypatch):
    df, x, _, target = table
    df = df.withColumn("part", (F.col("id") % 2).cast("int"))
    est = T.VectorForest(numTrees=4, maxDepth=3, bins=8, share=0.5, targetCol="target", groupCol="part", groups=(0, 1))
    model = est.fit(df)
    assert model.trees.feature.shape[0] == 8 and model.group.tolist() == [0] * 4 + [1] * 4
    keys = dict(df.select("id", F.xxhash64("id")).collect())
    keys = np.array([keys[i] for i in range(300)], dtype=np.int64)
    bins = T.binned(x, model.edges)
    for t in range(8):
        w = T._poisson(keys, t, 42) * (np.arange(300) % 2 == model.group[t])
        used = sorted(set(model.trees.feature[t][model.trees.feature[t] >= 0].tolist()))
        assert 1 <= len(used) <= 2
        rng = np.random.default_rng(42)
        own = [np.sort(rng.permutation(4)[:2]) for _ in range(8)][t]
        kept = w > 0
        tree = _plain_tree(bins[kept], w[kept], w[kept, None] * target[kept], 3, 0.0, 1.0, own)
        np.testing.assert_allclose(model.trees.values(bins)[:, t], [_plain_value(tree, b) for b in bins], rtol=1e-9, atol=1e-12)
    monkeypatch.setattr(T, "WAVE", 1)
    again = est.fit(df)
    np.testing.assert_allclose(again.trees.value, model.trees.value)
    weights = T._poisson(np.arange(200_000), 3, 1)
    assert abs(weights.mean() - 1) < 0.01 and abs(weights.var() - 1) < 0.02


def test_empty_and_constant_tables(spark, table):
    df, *_ = table
    with pytest.raises(ValueError):
        T.Boosting().fit(df.limit(0))
    same = spark.createDataFrame([(i, [1.0, None], float(i % 2)) for i in range(10)], "id long, features array<double>, label double")
    model = T.Boosting(maxIter=2).fit(same)
    assert all(abs(r["probability"][0] - 0.5) < 1e-12 for r in model.transform(same).collect())
