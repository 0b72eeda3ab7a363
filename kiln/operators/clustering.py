"""Unsupervised feature generators.

K-means and PCA are MLlib jobs; distances to centres are array expressions.
Mixtures (full covariances in all coordinates) and independent components are
fitted in passes that each leave one array of statistics (``passes``), so a pass
is one job whatever the rows, and the driver holds the model only.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.ml.clustering import KMeans
from pyspark.ml.feature import PCA
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kiln.functions import arrays as A
from kiln.operators import passes as P


def minmax_arrays(train: DataFrame, cols: Sequence[str]) -> tuple[list[float], list[float]]:
    r = train.agg(*[F.min(c).alias(f"lo{i}") for i, c in enumerate(cols)],
                  *[F.max(c).alias(f"hi{i}") for i, c in enumerate(cols)]).first()
    return [float(r[f"lo{i}"]) for i in range(len(cols))], [float(r[f"hi{i}"]) for i in range(len(cols))]


def scaled_vector(cols: Sequence[str], lo: Sequence[float], hi: Sequence[float]):
    """Min-max scaled feature array (constant column -> 0)."""
    return F.array(*[((F.col(c) - F.lit(a)) / F.lit(b - a)) if b > a else F.lit(0.0)
                     for c, a, b in zip(cols, lo, hi)])


# F16 ------------------------------------------------------------------------
def kmeans_features(train: DataFrame, data: DataFrame, vec: str, k: int = 5, seed: int = 42) -> DataFrame:
    """Cluster id and euclidean distance to every centre (k capped by row count)."""
    n = train.count()
    k = max(1, min(k, n))
    model = KMeans(k=k, seed=seed, featuresCol="_fv").fit(train.withColumn("_fv", array_to_vector(vec)))
    centres = [list(map(float, c)) for c in model.clusterCenters()]
    out = model.transform(data.withColumn("_fv", array_to_vector(vec))).withColumnRenamed("prediction", "kmeans_cluster")
    dists = {f"kmeans_dist_{i}": F.sqrt(F.aggregate(F.zip_with(F.col(vec), A.lit_array(c), lambda x, y: (x - y) * (x - y)),
                                                   F.lit(0.0), lambda a, v: a + v)) for i, c in enumerate(centres)}
    return out.withColumns(dists).drop("_fv")


# F17 / F22 --------------------------------------------------------------------
@dataclass
class Mixture:
    """Gaussian mixture with full covariances."""

    weights: np.ndarray
    means: np.ndarray
    covariances: np.ndarray
    log_likelihood: float = -np.inf     # mean per row of the fit
    passes: int = 0

    def __post_init__(self):
        self.roots = np.linalg.inv(np.linalg.cholesky(self.covariances))

    def log_densities(self, x: np.ndarray) -> np.ndarray:
        """Log of weight times density, by row and component."""
        d = x.shape[1]
        out = np.empty((len(x), len(self.weights)))
        with np.errstate(divide="ignore"):
            scale = np.log(self.weights)
        for j, (mean, root) in enumerate(zip(self.means, self.roots, strict=True)):
            y = (x - mean) @ root.T
            out[:, j] = scale[j] + np.log(np.diag(root)).sum() - 0.5 * (d * np.log(2 * np.pi) + (y * y).sum(axis=1))
        return out

    def responsibilities(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(log likelihood, probability of every component) by row."""
        own = self.log_densities(x)
        top = own.max(axis=1)
        e = np.exp(own - top[:, None])
        total = e.sum(axis=1)
        return top + np.log(total), e / total[:, None]


def shrunk(covariance: np.ndarray, shrink: float, ridge: float) -> np.ndarray:
    """Drawn to the sphere of the same trace, so that few rows in many dimensions stay invertible."""
    d = len(covariance)
    return (1 - shrink) * covariance + (shrink * np.trace(covariance) / d + ridge) * np.eye(d)


def maximised(sums: np.ndarray, k: int, origin: np.ndarray, shrink: float, ridge: float) -> tuple[float, Mixture]:
    """(log likelihood, next mixture) of the sums over all rows of (1, log likelihood, responsibilities, weighted differences
    from ``origin`` and their products)."""
    d = len(origin)
    n, ll = sums[:2]
    r = np.maximum(sums[2:2 + k], 1e-12)
    s = sums[2 + k:2 + k + k * d].reshape(k, d) / r[:, None]
    q = sums[2 + k + k * d:].reshape(k, d, d) / r[:, None, None]
    covariances = np.array([shrunk(q[j] - np.outer(s[j], s[j]), shrink, ridge) for j in range(k)])
    return ll / n, Mixture(r / r.sum(), origin + s, covariances)


def fit_mixture(train: DataFrame, vec: str, k: int = 5, seed: int = 42, shrink: float = 0.1, ridge: float = 1e-6,
                tol: float = 1e-3, max_iter: int = 100, start: Mixture | None = None) -> Mixture:
    """Expectation maximisation; a pass gathers the responsibility-weighted sums of all rows as one array.

    Starts at ``start``, or at ``k`` different rows chosen by their hash, with the
    covariance of all rows.  Ends when the mean log likelihood of a row gains less
    than ``tol``."""
    x = train.select(F.col(vec).cast("array<double>").alias("v")).persist()
    try:
        n, origin, covariance = P.moments(x, "v")
        if not n:
            raise ValueError("a mixture needs at least one row")
        if start is None:
            rows = x.distinct().orderBy(F.xxhash64(F.lit(seed), "v"), "v").limit(k).collect()       # k rows
            means = np.array([r["v"] for r in rows], dtype=float)
            start = Mixture(np.full(len(means), 1 / len(means)), means, np.array([shrunk(covariance, shrink, ridge)] * len(means)))
        model, last = start, -np.inf
        for passes in range(1, max_iter + 1):
            def own(b: pa.RecordBatch, model: Mixture = model) -> np.ndarray:
                rows = P.vectors(b.column(0))
                ll, r = model.responsibilities(rows)
                y = rows - origin
                products = [((r[:, j, None] * y).T @ y).ravel() for j in range(r.shape[1])]
                return np.concatenate(([len(rows), ll.sum()], r.sum(axis=0), (r.T @ y).ravel(), *products))

            ll, following = maximised(P.array_sum(x, lambda batches, own=own: P.added(batches, own)), len(model.weights), origin,
                                      shrink, ridge)
            model.log_likelihood, model.passes = ll, passes
            if ll - last < tol or passes == max_iter:
                break
            model, last = following, ll
        return model
    finally:
        x.unpersist()


def mixture_features(data: DataFrame, vec: str, model: Mixture, prefix: str = "gmm") -> DataFrame:
    """Probabilities of the components, the likeliest one and the log likelihood of every row."""
    k = len(model.weights)

    @F.arrow_udf("array<double>")
    def scored(v: pa.Array) -> pa.Array:
        if not len(v):
            return pa.array([], pa.list_(pa.float64()))
        ll, r = model.responsibilities(P.vectors(v))
        flat = np.concatenate((r, ll[:, None]), axis=1).ravel()
        return pa.ListArray.from_arrays(pa.array(np.arange(0, len(flat) + 1, k + 1), pa.int32()), pa.array(flat))

    out = data.withColumn("_mix", scored(F.col(vec).cast("array<double>")))
    probs = F.slice("_mix", 1, k)
    return out.withColumn(f"{prefix}_probs", probs).withColumn(f"{prefix}_loglik", F.element_at("_mix", k + 1)).withColumn(
        f"{prefix}_cluster", (F.array_position(F.col(f"{prefix}_probs"), F.array_max(f"{prefix}_probs")) - 1).cast("int")).drop("_mix")


def gmm_features(train: DataFrame, data: DataFrame, vec: str, k: int = 5, seed: int = 42, prefix: str = "gmm") -> DataFrame:
    """Fit on ``train``, score ``data``."""
    return mixture_features(data, vec, fit_mixture(train, vec, k, seed), prefix)


# F18 ------------------------------------------------------------------------
@dataclass
class Components:
    """Independent components: those of a row x are ``unmix`` (x - ``mean``)."""

    mean: np.ndarray
    whiten: np.ndarray
    rotation: np.ndarray
    passes: int
    gradient: float             # largest entry of the relative gradient at the end

    @property
    def unmix(self) -> np.ndarray:
        return self.rotation @ self.whiten


ICA_STEPS = (1.0, 0.5, 0.25, 2.0, 0.1)     # step lengths that a pass compares
ICA_MEMORY, ICA_LEAST = 10, 1e-2            # remembered steps; least curvature


def turned(skew: np.ndarray) -> np.ndarray:
    """Rotation that a skew-symmetric matrix generates."""
    values, basis = np.linalg.eigh(1j * skew)
    return np.real(basis @ np.diag(np.exp(-1j * values)) @ basis.conj().T)


def contrast(z: np.ndarray, rotations: list[np.ndarray]) -> np.ndarray:
    """Sums over rows, for every rotation: tanh(y) y', 1 - tanh(y)^2 and log cosh(y) of its components y."""
    out = []
    for rotation in rotations:
        y = z @ rotation.T
        t, a = np.tanh(y), np.abs(y)
        out += [(t.T @ y).ravel(), (1 - t * t).sum(axis=0), (a + np.log1p(np.exp(-2 * a)) - np.log(2)).sum(axis=0)]
    return np.concatenate(out)


def ica_direction(g: np.ndarray, slope: np.ndarray, sign: np.ndarray, memory: list) -> tuple[np.ndarray, np.ndarray]:
    """(relative gradient, quasi-Newton step): the curvature of every pair of components as if they were independent,
    corrected by the remembered steps."""
    own = sign[:, None] * g
    gradient = (own - own.T) / 2
    curve = sign * (slope - np.diag(g))
    q, back = gradient, []
    for step, change, rho in reversed(memory):
        back.append(rho * (step * q).sum())
        q = q - back[-1] * change
    q = q / np.maximum((curve[:, None] + curve) / 2, ICA_LEAST)
    for (step, change, rho), a in zip(memory, reversed(back), strict=True):
        q = q + step * (a - rho * (change * q).sum())
    return gradient, -q


def fit_ica(statistics: Callable[[list[np.ndarray]], np.ndarray], k: int, max_iter: int, tol: float, seed: int
            ) -> tuple[np.ndarray, int, float]:
    """(rotation, passes, gradient): maximal non-Gaussianity (log cosh) under orthogonality.

    ``statistics`` gives the means of ``contrast`` for some rotations, in one
    pass.  Each pass compares several lengths of one step, so no pass is spent on
    a line search; the sign of a component's contrast follows its kurtosis."""
    def read(values: np.ndarray) -> list:
        return [(v[:k * k].reshape(k, k), v[k * k:k * k + k], v[k * k + k:]) for v in values.reshape(-1, k * k + 2 * k)]

    def signs(g: np.ndarray, slope: np.ndarray) -> np.ndarray:
        return np.where(slope >= np.diag(g), 1.0, -1.0)

    u, _, v = np.linalg.svd(np.random.default_rng(seed).normal(size=(k, k)))
    rotation, memory = u @ v, []
    g, slope, loss = read(statistics([rotation]))[0]
    passes = 1
    while True:
        sign = signs(g, slope)
        gradient, step = ica_direction(g, slope, sign, memory)
        size = float(np.abs(gradient).max())
        if size < tol or passes >= max_iter:
            return rotation, passes, size
        if (gradient * step).sum() >= 0:
            memory = []
            gradient, step = ica_direction(g, slope, sign, memory)
        tried = [turned(a * step) @ rotation for a in ICA_STEPS]
        found = read(statistics(tried))
        passes += 1
        best = min(range(len(tried)), key=lambda i: (sign @ found[i][2], i))
        rotation, (g, slope, loss) = tried[best], found[best]
        taken, change = ICA_STEPS[best] * step, ica_direction(g, slope, sign, [])[0] - gradient
        curvature = float((taken * change).sum())
        kept = curvature > 1e-12 and (signs(g, slope) == sign).all()
        memory = [*memory, (taken, change, 1 / curvature)][-ICA_MEMORY:] if kept else []


def fast_ica(train: DataFrame, vec: str, n_components: int, max_iter: int = 300, tol: float = 1e-3, seed: int = 42) -> Components:
    """Independent components of an array column; one pass for the moments, then those of ``fit_ica``."""
    x = train.select(F.col(vec).cast("array<double>").alias("v")).persist()
    try:
        n, mean, covariance = P.moments(x, "v")
        values, basis = np.linalg.eigh(covariance)
        order = np.argsort(values)[::-1][:n_components]
        whiten = (basis[:, order] / np.sqrt(np.maximum(values[order], 1e-12))).T

        def statistics(rotations: list[np.ndarray]) -> np.ndarray:
            def own(b: pa.RecordBatch) -> np.ndarray:
                return contrast((P.vectors(b.column(0)) - mean) @ whiten.T, rotations)
            return P.array_sum(x, lambda batches: P.added(batches, own)) / n
        return Components(mean, whiten, *fit_ica(statistics, len(whiten), max_iter, tol, seed))
    finally:
        x.unpersist()


def ica_features(data: DataFrame, vec: str, model: Components, prefix: str = "ica") -> DataFrame:
    unmix = model.unmix
    out = {}
    for i in range(unmix.shape[0]):
        out[f"{prefix}_{i + 1}"] = sum(F.lit(float(unmix[i, j])) * (F.col(vec)[j] - F.lit(float(model.mean[j])))
                                       for j in range(len(model.mean)))
    return data.withColumns(out)


# F19 ------------------------------------------------------------------------
def pca_projection(train: DataFrame, data: DataFrame, vec: str, k: int = 2) -> DataFrame:
    """Project centred rows on the first k principal axes (MLlib PCA)."""
    dims = train.select(F.max(F.size(vec))).first()[0]
    mean = train.agg(*[F.avg(F.col(vec)[i]).alias(f"m{i}") for i in range(dims)]).first()
    centred = F.array(*[F.col(vec)[i] - F.lit(float(mean[f"m{i}"])) for i in range(dims)])
    tr = train.withColumn("_cv", array_to_vector(centred))
    model = PCA(k=k, inputCol="_cv", outputCol="_pc").fit(tr)
    out = model.transform(data.withColumn("_cv", array_to_vector(centred)))
    return out.withColumn("pca", vector_to_array("_pc")).drop("_cv", "_pc")
