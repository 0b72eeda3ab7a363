"""Histogram trees: multi-class boosting (M7) and forests with vector leaves.

Features are binned once at exact quantiles.  All trees of a step grow together,
level by level; a level is one pass over the binned rows that leaves one array of
sums by (tree, node, feature, bin), from which the driver picks the splits.  What
a tree learns is given by two statistics of a row, a mass m and sums s: a node is
worth |s|^2 / (m + penalty) and predicts s / (m + penalty).  For boosting they
are the Hessian and the negative gradient of the softmax loss, for a forest the
row's weight and its weighted target vector, so that a split lowers the summed
variance of all outputs at once.

Defined results: null and NaN features share a lowest bin of their own; rows
without a label or a vector are not learnt from, and score as if all features were
missing; rows of weight zero count nowhere; equal gains go to the first feature and the lowest
cut; an empty table is refused.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kiln.operators import passes as P
from kiln.operators import quantiles as Q
from kiln.session import written

BINS = 32
WAVE = 1 << 22          # numbers of one level's array; more trees than fit grow in turns


# ------------------------------------------------------------------------ bins
def bin_edges(df: DataFrame, vec: str, bins: int = BINS) -> list[np.ndarray]:
    """Inner edges of at most ``bins`` bins per coordinate, at exact quantiles."""
    dims = df.agg(F.max(F.size(vec))).first()[0]
    if not dims or dims < 1:
        raise ValueError("trees need at least one row and one feature")
    x = df.select(*[F.nanvl(F.col(vec)[i].cast("double"), F.lit(None)).alias(f"x{i}") for i in range(dims)])
    cuts = Q.multi_quantiles(x, {f"x{i}": [j / bins for j in range(1, bins)] for i in range(dims)})
    return [np.unique([c for c in cuts[f"x{i}"] if c is not None]) for i in range(dims)]


def binned(x: np.ndarray, edges: Sequence[np.ndarray]) -> np.ndarray:
    """Bin numbers of rows: 0 for missing, then 1 and one more for every edge below the value."""
    out = np.empty(x.shape, dtype=np.uint8)
    for i, e in enumerate(edges):
        out[:, i] = np.where(np.isnan(x[:, i]), 0, 1 + np.searchsorted(e, x[:, i], side="left"))
    return out


def _bins_of(column: pa.Array, n: int) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), dtype=np.uint8).reshape(-1, n)


def bin_table(df: DataFrame, vec: str, edges: Sequence[np.ndarray], keep: Sequence[Column], name: str) -> DataFrame:
    """(``keep``, bins): written to the shared folder, since every pass reads it."""
    @F.arrow_udf("binary")
    def to_bins(v: pa.Array) -> pa.Array:
        return pa.array([r.tobytes() for r in binned(P.vectors(v), edges)], pa.binary()) if len(v) else pa.array([], pa.binary())
    return written(df.select(*keep, to_bins(F.col(vec).cast("array<double>")).alias("bins")), name)


# ----------------------------------------------------------------------- trees
@dataclass
class Trees:
    """Binary trees in heap order: the children of node i are 2i + 1 and 2i + 2."""

    feature: np.ndarray         # (trees, nodes), -1 at a leaf
    cut: np.ndarray             # bins above it go right
    value: np.ndarray           # (trees, nodes, outputs)

    @classmethod
    def stumps(cls, trees: int, depth: int, outputs: int) -> Trees:
        nodes = (1 << (depth + 1)) - 1
        return cls(np.full((trees, nodes), -1, dtype=np.int32), np.zeros((trees, nodes), dtype=np.int32),
                   np.zeros((trees, nodes, outputs)))

    @classmethod
    def joined(cls, parts: Sequence[Trees]) -> Trees:
        return cls(*[np.concatenate([getattr(p, c) for p in parts]) for c in ("feature", "cut", "value")])

    def leaves(self, bins: np.ndarray) -> np.ndarray:
        """(rows, trees): the node where each row ends."""
        node = np.zeros((len(bins), len(self.feature)), dtype=np.int64)
        tree, row = np.arange(len(self.feature)), np.arange(len(bins))[:, None]
        for _ in range(int(self.feature.shape[1]).bit_length() - 1):
            f = self.feature[tree, node]
            if (f < 0).all():
                break
            right = bins[row, np.maximum(f, 0)] > self.cut[tree, node]
            node = np.where(f >= 0, 2 * node + 1 + right, node)
        return node

    def values(self, bins: np.ndarray) -> np.ndarray:
        """(rows, trees, outputs)."""
        return self.value[np.arange(len(self.feature)), self.leaves(bins)]


#: of a batch and its bins: masses (trees, rows) and sums (trees, rows, outputs)
Statistics = Callable[[pa.RecordBatch, np.ndarray], tuple[np.ndarray, np.ndarray]]


def level_sums(bins: np.ndarray, trees: Trees, features: np.ndarray, level: int, width: int, mass: np.ndarray,
               sums: np.ndarray) -> np.ndarray:
    """(trees, nodes of the level, features, bins, 1 + outputs) of some rows."""
    first, nodes = (1 << level) - 1, 1 << level
    at = trees.leaves(bins) - first
    stats = np.concatenate((mass[:, :, None], sums), axis=2)
    used = features.shape[1]
    out = np.zeros((len(features), nodes * used * width, stats.shape[2]))
    for t, own in enumerate(features):
        rows = np.flatnonzero((at[:, t] >= 0) & (mass[t] > 0))
        cell = ((at[rows, t, None] * used + np.arange(used)) * width + bins[rows[:, None], own]).ravel()
        for c in range(stats.shape[2]):
            out[t, :, c] = np.bincount(cell, weights=np.repeat(stats[t, rows, c], used), minlength=out.shape[1])
    return out.reshape(len(features), nodes, used, width, -1)


def worth(stats: np.ndarray, penalty: float) -> np.ndarray:
    mass = stats[..., 0] + penalty
    return np.divide((stats[..., 1:] ** 2).sum(axis=-1), mass, out=np.zeros(mass.shape), where=mass > 0)


def leaf_value(stats: np.ndarray, penalty: float) -> np.ndarray:
    mass = stats[..., :1] + penalty
    return np.divide(stats[..., 1:], mass, out=np.zeros(stats[..., 1:].shape), where=mass > 0)


def split(trees: Trees, level: int, sums: np.ndarray, features: np.ndarray, penalty: float, least: float) -> bool:
    """Split the nodes of a level where that gains; whether any was."""
    total = sums[:, :, :1].sum(axis=3, keepdims=True)                       # the same by any feature
    left = np.cumsum(sums, axis=3)[..., :-1, :]
    right = total - left
    gain = worth(left, penalty) + worth(right, penalty) - worth(total, penalty)
    gain[(left[..., 0] < least) | (right[..., 0] < least)] = -np.inf
    first, any_split = (1 << level) - 1, False
    for t in range(len(features)):
        for n in range(1 << level):
            node, own = first + n, gain[t, n]
            if level == 0:
                trees.value[t, 0] = leaf_value(total[t, 0, 0, 0], penalty)
            top = own.max()
            if not top > 1e-9:
                continue
            # sums come in any rounding: gains that differ by it are equal, and the first one wins
            at, cut = np.unravel_index(int(np.argmax(own >= top - 1e-9 * max(1.0, top))), own.shape)
            trees.feature[t, node], trees.cut[t, node] = features[t, at], cut
            trees.value[t, 2 * node + 1] = leaf_value(left[t, n, at, cut], penalty)
            trees.value[t, 2 * node + 2] = leaf_value(right[t, n, at, cut], penalty)
            any_split = True
    return any_split


def grow(rows: DataFrame, statistics: Statistics, features: np.ndarray, dims: int, outputs: int, depth: int, width: int,
         penalty: float, least: float) -> Trees:
    """As many trees as ``features`` has rows, each on its own features; one pass a level."""
    trees = Trees.stumps(len(features), depth, outputs)
    for level in range(depth):
        def own(b: pa.RecordBatch, level: int = level, trees: Trees = trees) -> np.ndarray:
            bins = _bins_of(b.column("bins"), dims)
            return level_sums(bins, trees, features, level, width, *statistics(b, bins)).ravel()

        sums = P.array_sum(rows, lambda batches, own=own: P.added(batches, own))
        if sums is None:
            raise ValueError("trees need at least one row")
        if not split(trees, level, sums.reshape(len(features), 1 << level, features.shape[1], width, 1 + outputs), features,
                     penalty, least):
            break
    return trees


# -------------------------------------------------------------------- boosting
def softmax(margin: np.ndarray) -> np.ndarray:
    e = np.exp(margin - margin.max(axis=1, keepdims=True))
    return e / e.sum(axis=1, keepdims=True)


@dataclass
class BoostedModel:
    """Margins of the classes: a base and the sum of the trees of every round."""

    edges: list[np.ndarray]
    base: np.ndarray
    trees: Trees
    rate: float
    features: str = "features"

    def margins(self, bins: np.ndarray) -> np.ndarray:
        k = len(self.base)
        return self.base + self.rate * self.trees.values(bins)[:, :, 0].reshape(len(bins), -1, k).sum(axis=1)

    def transform(self, data: DataFrame) -> DataFrame:
        """``data`` with the columns prediction (class number) and probability (vector)."""
        return _scored(data, self.features, self.edges, lambda bins: softmax(self.margins(bins)))


def _scored(data: DataFrame, features: str, edges: list[np.ndarray], probabilities: Callable[[np.ndarray], np.ndarray]) -> DataFrame:
    @F.arrow_udf("array<double>")
    def score(v: pa.Array) -> pa.Array:
        if not len(v):
            return pa.array([], pa.list_(pa.float64()))
        p = probabilities(binned(P.vectors(v), edges))
        return pa.ListArray.from_arrays(pa.array(np.arange(0, p.size + 1, p.shape[1]), pa.int32()), pa.array(p.ravel()))
    missing = F.array_repeat(F.lit(None).cast("double"), len(edges))
    out = data.withColumn("_p", score(F.coalesce(_as_array(data, features), missing)))
    best = (F.array_position("_p", F.array_max("_p")) - 1).cast("double")
    return out.withColumn("prediction", best).withColumn("probability", array_to_vector("_p")).drop("_p")


def _as_array(df: DataFrame, name: str) -> Column:
    return F.col(name).cast("array<double>") if df.schema[name].dataType.typeName() == "array" else vector_to_array(name)


@dataclass
class Boosting:
    """Multi-class boosting: in every round one tree per class on the softmax gradients, all grown together."""

    maxIter: int = 20
    maxDepth: int = 3
    stepSize: float = 0.1
    penalty: float = 1.0
    least: float = 1e-3             # Hessian of a child, at least
    bins: int = BINS
    featuresCol: str = "features"
    labelCol: str = "label"
    weightCol: str | None = None

    def fit(self, train: DataFrame) -> BoostedModel:
        x = train.withColumn("_x", _as_array(train, self.featuresCol))
        edges = bin_edges(x, "_x", self.bins)
        weight = F.col(self.weightCol).cast("double") if self.weightCol else F.lit(1.0)
        rows = bin_table(x.filter(F.col(self.labelCol).isNotNull() & F.col("_x").isNotNull()), "_x", edges,
                         [F.col(self.labelCol).cast("int").alias("y"), weight.alias("w")], "boosting")
        share = {r["y"]: r["w"] for r in rows.groupBy("y").agg(F.sum("w").alias("w")).collect()}       # a row per class
        k, total = max(share) + 1, sum(share.values())
        base = np.log(np.array([max(share.get(c, 0.0), 1e-9 * total) for c in range(k)]) / total)
        model = BoostedModel(edges, base, Trees.stumps(0, self.maxDepth, 1), self.stepSize, self.featuresCol)
        features = np.tile(np.arange(len(edges)), (k, 1))
        width = max(len(e) for e in edges) + 2
        for _ in range(self.maxIter):
            def statistics(b: pa.RecordBatch, bins: np.ndarray, model: BoostedModel = model) -> tuple[np.ndarray, np.ndarray]:
                return softmax_statistics(model.margins(bins), b.column("y").to_numpy(), b.column("w").to_numpy())
            found = grow(rows, statistics, features, len(edges), 1, self.maxDepth, width, self.penalty, self.least)
            model = BoostedModel(edges, base, Trees.joined([model.trees, found]), self.stepSize, self.featuresCol)
        return model


def softmax_statistics(margins: np.ndarray, y: np.ndarray, w: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hessians and negative gradients of the softmax loss, by class and row."""
    p = softmax(margins)
    left = -p
    left[np.arange(len(y)), y] += 1
    return (w[:, None] * np.maximum(p * (1 - p), 1e-16)).T, (w[:, None] * left).T[:, :, None]


# --------------------------------------------------------------------- forests
def _poisson(key: np.ndarray, tree: int, seed: int) -> np.ndarray:
    """Bootstrap weights (Poisson, mean 1) of row keys in a tree; the same wherever and whenever they are drawn."""
    with np.errstate(over="ignore"):
        h = key.astype(np.uint64) + np.uint64((seed * 1_000_003 + tree + 1) * 0x9E3779B97F4A7C15 & (1 << 64) - 1)
        for shift, factor in ((30, 0xBF58476D1CE4E5B9), (27, 0x94D049BB133111EB)):      # fixed values: a 64-bit mixer
            h = (h ^ (h >> np.uint64(shift))) * np.uint64(factor)
        h ^= h >> np.uint64(31)
    return np.searchsorted(_POISSON, h.astype(np.float64) / 2.0 ** 64, side="right").astype(float)


_POISSON = np.cumsum(np.exp(-1) / np.cumprod(np.concatenate(([1.0], np.arange(1, 16)))))


@dataclass
class ForestModel:
    """Mean of the leaf vectors of every group of trees (one group unless asked otherwise)."""

    edges: list[np.ndarray]
    trees: Trees
    group: np.ndarray               # of every tree
    features: str = "features"

    def means(self, bins: np.ndarray) -> np.ndarray:
        """(rows, groups, outputs)."""
        own = self.trees.values(bins)
        return np.stack([own[:, self.group == g].mean(axis=1) for g in np.unique(self.group)], axis=1)

    def transform(self, data: DataFrame) -> DataFrame:
        """``data`` with the columns prediction (largest output) and probability (mean leaf vector over the groups)."""
        return _scored(data, self.features, self.edges, lambda bins: self.means(bins).mean(axis=1))


@dataclass
class VectorForest:
    """Forest whose leaves hold vectors; ``targetCol`` is an array of one length.

    Every tree sees bootstrap weights drawn from the row's key and a share of the
    features.  With ``groupCol`` (an int column) and ``groups`` there are
    ``numTrees`` trees for every group, which learn from its rows alone but grow
    in the same passes."""

    numTrees: int = 20
    maxDepth: int = 6
    share: float = 1 / 3
    least: float = 1.0
    bins: int = BINS
    seed: int = 42
    bootstrap: bool = True
    featuresCol: str = "features"
    targetCol: str = "target"
    keyCol: str = "id"
    groupCol: str | None = None
    groups: Sequence[int] = (0,)

    def fit(self, train: DataFrame) -> ForestModel:
        x = train.withColumn("_x", _as_array(train, self.featuresCol))
        edges = bin_edges(x, "_x", self.bins)
        group = F.col(self.groupCol).cast("int") if self.groupCol else F.lit(0)
        rows = bin_table(x.filter(F.col(self.targetCol).isNotNull() & F.col("_x").isNotNull()), "_x", edges, [
            F.xxhash64(self.keyCol).alias("key"), group.alias("part"),
            F.col(self.targetCol).cast("array<double>").alias("target")], "forest")
        head = rows.select(F.size("target").alias("n")).head()
        if head is None:
            raise ValueError("trees need at least one row")
        dims, outputs, width = len(edges), head["n"], max(len(e) for e in edges) + 2
        rng = np.random.default_rng(self.seed)
        used = max(1, int(np.ceil(self.share * dims)))
        part = np.repeat(np.array(self.groups), self.numTrees)
        features = np.array([np.sort(rng.permutation(dims)[:used]) for _ in part])
        each = max(1, WAVE // ((1 << max(0, self.maxDepth - 1)) * used * width * (1 + outputs)))
        found = []
        for low in range(0, len(part), each):
            own = range(low, min(low + each, len(part)))

            def statistics(b: pa.RecordBatch, bins: np.ndarray, own: range = own) -> tuple[np.ndarray, np.ndarray]:
                key, of, y = b.column("key").to_numpy(), b.column("part").to_numpy(zero_copy_only=False), P.vectors(b.column("target"))
                w = np.array([(of == part[t]) * (_poisson(key, t, self.seed) if self.bootstrap else 1.0) for t in own])
                return w, w[:, :, None] * y
            found.append(grow(rows, statistics, features[own.start:own.stop], dims, outputs, self.maxDepth, width, 0.0, self.least))
        return ForestModel(edges, Trees.joined(found), part, self.featuresCol)
