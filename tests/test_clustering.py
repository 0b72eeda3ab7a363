"""Passes, mixtures, components and clusters against plain numpy."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from kiln.operators import clustering as CL
from kiln.operators import passes as P
from kiln.operators import stats as ST


def _frame(spark, x, parts=5):
    return spark.createDataFrame([(i, [float(a) for a in v]) for i, v in enumerate(x)], "id long, v array<double>").repartition(parts)


def test_array_sum_adds_every_slice(spark, monkeypatch):
    monkeypatch.setattr(P, "SLICE", 3)
    df = spark.range(100).repartition(7)

    def task(batches):
        total = None
        for b in batches:
            v = b.column(0).to_numpy().astype(float)
            own = np.concatenate(([v.sum()], np.bincount(b.column(0).to_numpy() % 10, minlength=10)))
            total = own if total is None else total + own
        return total
    assert P.array_sum(df, task).tolist() == [4950.0, *[10.0] * 10]
    assert P.array_sum(df.limit(0), task) is None


def test_moments_far_from_zero(spark):
    x = np.random.default_rng(1).normal(size=(500, 3)) + 1e9
    n, mean, cov = P.moments(_frame(spark, x), "v")
    assert n == 500
    np.testing.assert_allclose(mean, x.mean(axis=0), rtol=1e-14)
    np.testing.assert_allclose(cov, np.cov((x - 1e9).T, bias=True), atol=1e-6)
    assert P.moments(_frame(spark, x).limit(0), "v")[0] == 0


def _plain_em(x, mixture, steps, shrink, ridge):
    w, m, c = mixture.weights, mixture.means, mixture.covariances
    d = x.shape[1]
    for step in range(steps):
        log = np.array([np.log(w[j]) - 0.5 * (d * np.log(2 * np.pi) + np.linalg.slogdet(c[j])[1]
                        + np.einsum("ij,jk,ik->i", x - m[j], np.linalg.inv(c[j]), x - m[j])) for j in range(len(w))]).T
        total = np.log(np.exp(log - log.max(axis=1, keepdims=True)).sum(axis=1)) + log.max(axis=1)
        r = np.exp(log - total[:, None])
        if step == steps - 1:
            return total.mean(), r, total
        n = r.sum(axis=0)
        w, m = n / len(x), (r.T @ x) / n[:, None]
        c = np.array([CL.shrunk(((r[:, j, None] * (x - m[j])).T @ (x - m[j])) / n[j], shrink, ridge) for j in range(len(n))])


@pytest.mark.parametrize("dims,rows", [(3, 600), (64, 90)])
def test_mixture_equals_plain_em_from_the_same_start(spark, dims, rows):
    rng = np.random.default_rng(3)
    centres = rng.normal(size=(3, dims)) * 4
    x = centres[rng.integers(0, 3, rows)] + rng.normal(size=(rows, dims)) + 50
    df = _frame(spark, x)
    start = CL.Mixture(np.full(3, 1 / 3), x[:3], np.array([np.cov(x.T, bias=True) + 0.1 * np.eye(dims)] * 3))
    model = CL.fit_mixture(df, "v", start=start, shrink=0.2, tol=1e-9, max_iter=8)
    ll, r, by_row = _plain_em(x, start, model.passes, 0.2, 1e-6)
    assert abs(model.log_likelihood - ll) < 1e-8 * abs(ll)
    got = {g["id"]: g for g in CL.mixture_features(df, "v", model).collect()}
    np.testing.assert_allclose([got[i]["gmm_probs"] for i in range(rows)], r, atol=1e-7)
    np.testing.assert_allclose([got[i]["gmm_loglik"] for i in range(rows)], by_row, rtol=1e-7)
    assert [got[i]["gmm_cluster"] for i in range(rows)] == r.argmax(axis=1).tolist()


def test_mixture_gains_with_every_pass_and_finds_groups(spark):
    rng = np.random.default_rng(4)
    of = rng.integers(0, 3, 900)
    x = np.array([[0, 0], [9, 0], [0, 9]])[of] + rng.normal(size=(900, 2))
    df = _frame(spark, x)
    gains = [CL.fit_mixture(df, "v", 3, max_iter=n, shrink=0.0, tol=0).log_likelihood for n in (1, 2, 4)]
    assert gains == sorted(gains)
    rows = CL.gmm_features(df, df, "v", 3).collect()
    assert {len({r["gmm_cluster"] for r in rows if of[r["id"]] == g}) for g in range(3)} <= {1, 2}
    same = _frame(spark, np.ones((20, 2)))
    model = CL.fit_mixture(same, "v", 4)
    assert len(model.weights) == 1 and np.isfinite(model.log_likelihood)
    with pytest.raises(ValueError):
        CL.fit_mixture(df.limit(0), "v", 2)


def _plain_ica(x, k, start, tol=1e-10, most=20_000):
    """Gradient steps on the same contrast from the rotation ``start``, until nothing turns any more."""
    z = (x - x.mean(axis=0)) @ start[0].T
    w = start[1]
    for _ in range(most):
        y = z @ w.T
        g = np.tanh(y).T @ y / len(z)
        sign = np.where((1 - np.tanh(y) ** 2).mean(axis=0) >= np.diag(g), 1.0, -1.0)
        own = sign[:, None] * g
        skew = (own - own.T) / 2
        if np.abs(skew).max() < tol:
            break
        w = CL.turned(-0.5 * skew) @ w
    return z @ w.T


def test_components_in_few_passes_equal_a_plain_run(spark):
    rng = np.random.default_rng(5)
    s = np.c_[rng.laplace(size=(3000, 2)), rng.uniform(-1, 1, (3000, 2)), rng.exponential(size=3000)]
    x = s @ rng.normal(size=(5, 5)) + 7
    df = _frame(spark, x)
    model = CL.fast_ica(df, "v", 5, tol=1e-6)
    assert model.passes < 30 and model.gradient < 1e-6
    out = CL.ica_features(df, "v", model).orderBy("id").collect()
    got = np.array([[r[f"ica_{i + 1}"] for i in range(5)] for r in out])
    np.testing.assert_allclose(np.cov(got.T, bias=True), np.eye(5), atol=1e-8)
    start = np.linalg.svd(np.random.default_rng(42).normal(size=(5, 5)))
    want = _plain_ica(x, 5, (model.whiten, start[0] @ start[2]))
    match = np.abs(want.T @ got) / len(x)                       # up to sign and order
    assert sorted(match.argmax(axis=1).tolist()) == list(range(5))
    np.testing.assert_allclose(match.max(axis=1), 1, atol=1e-6)
    sources = (s - s.mean(axis=0)) / s.std(axis=0)
    assert (np.abs(sources.T @ got / len(x)).max(axis=1) > 0.98).all()


def test_components_of_noise_reach_the_tolerance(spark):
    x = np.random.default_rng(6).normal(size=(400, 20))
    model = CL.fast_ica(_frame(spark, x), "v", 7, tol=1e-3)
    assert model.passes < 60 and model.gradient < 1e-3


def test_kmeans_distances_and_pca(spark):
    rng = np.random.default_rng(7)
    x = np.array([[0, 0, 0], [8, 0, 1], [0, 8, 2]])[rng.integers(0, 3, 400)] + rng.normal(size=(400, 3))
    df = _frame(spark, x)
    rows = CL.kmeans_features(df, df, "v", k=3).orderBy("id").collect()
    dist = np.array([[r[f"kmeans_dist_{i}"] for i in range(3)] for r in rows])
    cluster = np.array([r["kmeans_cluster"] for r in rows])
    assert (dist.argmin(axis=1) == cluster).all()
    centres = np.array([x[cluster == c].mean(axis=0) for c in range(3)])            # a fixed point of the iteration
    np.testing.assert_allclose(dist, np.linalg.norm(x[:, None] - centres, axis=2), atol=0.05)
    got = np.array([r["pca"] for r in CL.pca_projection(df, df, "v", k=2).orderBy("id").collect()])
    _, _, axes = np.linalg.svd(x - x.mean(axis=0), full_matrices=False)
    want = (x - x.mean(axis=0)) @ axes[:2].T
    np.testing.assert_allclose(np.abs(got), np.abs(want), atol=1e-8)


def test_robust_outliers_equal_a_plain_version(spark):
    rng = np.random.default_rng(8)
    x = rng.normal(size=(300, 6))
    x[::50] += 12
    df = spark.createDataFrame([(i, [None if i == 7 and j == 2 else float(a) for j, a in enumerate(v)]) for i, v in enumerate(x)],
                               "id long, v array<double>")
    x[7, 2] = 0
    kept = np.ones(300, dtype=bool)
    for _ in range(4):
        c = np.cov(x[kept].T)
        y = x - x[kept].mean(axis=0)
        d = np.einsum("ij,jk,ik->i", y, np.linalg.inv(c), y)
        kept = d <= np.quantile(d, 0.75)
    rows = ST.robust_outliers(df, "v", contamination=0.02).orderBy("id").collect()
    np.testing.assert_allclose([r["mahalanobis"] for r in rows], d, rtol=1e-8)
    assert [r["outlier"] for r in rows] == (d > np.quantile(d, 0.98)).tolist()
    assert all(rows[i]["outlier"] for i in range(0, 300, 50))
