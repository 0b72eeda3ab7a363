"""Fitted models against plain numpy: what they predict follows from what they learnt, and that is optimal."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from kiln.operators import models as M
from kiln.plans import q_models as Q

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def split(spark):
    train, test = Q.embedding_split(spark, SF)
    return train.persist(), test.persist()


def _matrix(df, label="label"):
    rows = df.select("vec_id", label, "features").orderBy("vec_id").collect()
    return np.array([r["features"].toArray() for r in rows]), np.array([r[label] for r in rows])


def _by_key(df, key="vec_id"):
    return [r.asDict() for r in df.orderBy(key).collect()]


def test_linear_regression_is_least_squares(spark, split):
    (x, y), (z, _) = map(_matrix, split)
    w, *_ = np.linalg.lstsq(np.c_[np.ones(len(x)), x], y, rcond=None)
    got = [r["prediction"] for r in _by_key(Q.linear(spark, SF))]
    np.testing.assert_allclose(got, np.c_[np.ones(len(z)), z] @ w, atol=1e-5)


def _softmax(a):
    e = np.exp(a - a.max(axis=1, keepdims=True))
    return e / e.sum(axis=1, keepdims=True)


def test_logistic_regression_is_stationary(split):
    train, test = split
    model = M.estimator("logistic_regression", "classification", n_classes=10, maxIter=200, tol=1e-10, regParam=0.05).fit(train)
    w, b = model.coefficientMatrix.toArray(), model.interceptVector.toArray()
    (x, y), (z, _) = map(_matrix, split)
    left = _softmax(x @ w.T + b) - np.eye(10)[y.astype(int)]
    spread = x.std(axis=0, ddof=1)
    gradient = left.T @ x / len(x) + 0.05 * w * spread ** 2         # the penalty is on standardised coefficients
    assert np.abs(gradient).max() < 1e-4 and np.abs(left.mean(axis=0)).max() < 1e-4
    got = _by_key(M.predictions(model, test, ["vec_id"]))
    np.testing.assert_allclose([r["probs"] for r in got], _softmax(z @ w.T + b), atol=1e-9)


def _share_of_equal_rows(model, train, y_of):
    """Rows of one leaf have one probability vector, and it is the share of the classes among them."""
    rows = _by_key(M.predictions(model, train, ["vec_id", "label"]))
    groups = {}
    for r in rows:
        groups.setdefault(tuple(np.round(r["probs"], 9)), []).append(int(r["label"]))
    for p, labels in groups.items():
        np.testing.assert_allclose(np.bincount(labels, minlength=10) / len(labels), p, atol=1e-6)
    return len(groups)


def test_decision_tree_predicts_the_shares_of_its_leaves(spark, split):
    model = M.estimator("decision_tree", "classification", maxDepth=4).fit(split[0])
    assert _share_of_equal_rows(model, split[0], None) > 4
    rows = _by_key(Q.decision_tree(spark, SF))
    assert len(rows) == split[1].count()
    assert all(r["prediction"] == int(np.argmax(r["probs"])) and abs(sum(r["probs"]) - 1) < 1e-6 for r in rows)


def test_random_forest_is_the_mean_of_its_trees(split):
    train, test = split
    train = M.class_weights(train, "label", "balanced")
    model = M.estimator("random_forest", "classification", weight="weight", numTrees=7, maxDepth=4).fit(train)
    got = np.array([r["probs"] for r in _by_key(M.predictions(model, test, ["vec_id"]))])
    trees = np.array([[r["probs"] for r in _by_key(M.predictions(t, test, ["vec_id"]))] for t in model.trees])
    np.testing.assert_allclose(got, trees.mean(axis=0), atol=1e-9)


def test_linear_svc_names_the_class_of_the_largest_margin(split):
    train, test = split
    model = M.estimator("svm", "classification", n_classes=10, maxIter=50, tol=1e-3, regParam=0.01).fit(train)
    z, _ = _matrix(test)
    margin = np.array([z @ m.coefficients.toArray() + m.intercept for m in model.models]).T
    assert [r["prediction"] for r in _by_key(M.predictions(model, test, ["vec_id"]))] == margin.argmax(axis=1).tolist()


def test_perceptron_is_its_layers(split):
    train, test = split
    model = M.estimator("mlp", "classification", n_features=64, n_classes=10, hidden=6, num_layers=1, maxIter=30).fit(train)
    w = model.weights.toArray()
    z, _ = _matrix(test)
    first, w = w[:64 * 6].reshape(6, 64, order="F"), w[64 * 6:]
    a, w = 1 / (1 + np.exp(-(z @ first.T + w[:6]))), w[6:]
    second, w = w[:60].reshape(10, 6, order="F"), w[60:]
    np.testing.assert_allclose([r["probs"] for r in _by_key(M.predictions(model, test, ["vec_id"]))], _softmax(a @ second.T + w), atol=1e-6)


def test_multi_output_rows_sum_to_one(spark):
    rows = Q.multi_output(spark, SF).collect()
    p = np.array([r["probs"] for r in rows])
    assert p.shape[1] == 18 and (p >= 0).all()
    np.testing.assert_allclose(p.sum(axis=1), 1, atol=1e-6)
    assert np.unique(p.round(6), axis=0).shape[0] > 10


def test_boosting_learns_more_with_every_round(split):
    train, _ = split
    x, y = _matrix(train)
    hits = []
    for n in (1, 6):
        model = M.estimator("xgboost", "classification", n_classes=10, maxIter=n, maxDepth=3).fit(train)
        hits.append(np.mean([r["prediction"] for r in _by_key(M.predictions(model, train, ["vec_id"]))] == y))
    assert hits[1] > hits[0] > np.bincount(y.astype(int)).max() / len(y)


def test_sweep_logs_the_accuracy_it_returns(spark, split):
    rows = Q.sweep(spark, SF).collect()
    assert [r["run"] for r in sorted(rows, key=lambda r: r["run"])] == [0, 1, 2, 3]
    assert all(r["accuracy"] == r["logged"] and 0 <= r["accuracy"] <= 1 for r in rows)
    train, test = split
    y = _matrix(test)[1]
    first = min(rows, key=lambda r: r["run"])
    assert first["setting"] == "[('maxDepth', 5), ('numTrees', 20)]"
    model = M.estimator("random_forest", "classification", numTrees=20, maxDepth=5).fit(train)
    assert abs(first["accuracy"] - np.mean([r["prediction"] for r in _by_key(M.predictions(model, test, ["vec_id"]))] == y)) < 0.1


def test_feature_feedback_values(spark, split):
    fb, scores = Q._feedback(spark, SF)
    fb, scores = {r["feature"]: r for r in fb.collect()}, scores.collect()
    x, y = _matrix(split[0])
    assert abs(sum(r["importance"] for r in fb.values()) - 1) < 1e-9
    assert sorted(r["rank"] for r in fb.values()) == list(range(1, 65))
    for i in range(0, 64, 9):
        r = fb[f"e{i}"]
        assert abs(r["corr"] - np.corrcoef(x[:, i], y)[0, 1]) < 1e-9
        edges = np.unique(np.quantile(x[:, i], [k / 10 for k in range(1, 10)]))
        joint = np.histogram2d((x[:, i, None] > edges).sum(axis=1), y, bins=[range(11), range(11)])[0] / len(y)
        part = joint[joint > 0] * np.log(joint[joint > 0] / (joint.sum(1, keepdims=True) * joint.sum(0, keepdims=True))[joint > 0])
        assert abs(r["mutual_info"] - part.sum()) < 1e-9
    assert [s["threshold"] for s in scores] == [0.0, 0.01, 0.02] and all(0 <= s["score"] <= 1 for s in scores)
    best = max(scores, key=lambda s: (s["score"], -s["features"]))
    assert sum(r["kept"] for r in fb.values()) == best["features"]


def test_chunk_scores_run_over_the_chunks(spark):
    rows = sorted(Q.first_chunk(spark, SF).collect(), key=lambda r: r["chunk"])
    hits = np.array([r["accuracy"] * r["n"] for r in rows])
    n = np.array([r["n"] for r in rows])
    assert [r["seen"] for r in rows] == np.cumsum(n).tolist()
    np.testing.assert_allclose([r["running_accuracy"] for r in rows], np.cumsum(hits) / np.cumsum(n))
    assert rows[-1]["running_accuracy"] > 0.6


def test_chunk_ensemble(spark):
    d = Q._doc_features(spark, SF).persist()
    truth = {r["doc_id"]: r["label"] for r in d.select("doc_id", "label").collect()}
    rows = Q.ensemble(spark, SF).collect()
    assert {r["doc_id"] % 4 for r in rows} == {3}
    assert np.mean([(r["probability"] >= 0.5) == (truth[r["doc_id"]] == 1) for r in rows]) > 0.6
    blank = d.filter("chunk = 3").limit(3).withColumn("features", F.when(F.lit(False), F.col("features")))
    out = M.ensemble_scores(d.filter("chunk < 3"), blank, "chunk", "doc_id", numTrees=2, maxDepth=2).collect()
    assert [r["probability"] for r in out] == [0.5] * 3
