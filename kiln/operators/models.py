"""Models as Spark jobs.

MLlib estimators behind one factory (distributed training), a Gaussian naive
Bayes written as a plain aggregate + join (exact, SQL-checkable), class
weights as window counts, multi-output regression as one forest of vector
leaves, chunk-wise training / scoring and per-chunk ensembles whose models grow
in the same passes.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from concurrent.futures import ThreadPoolExecutor

from pyspark.ml.classification import (DecisionTreeClassifier, GBTClassifier, LinearSVC, LogisticRegression,
                                       MultilayerPerceptronClassifier, OneVsRest, RandomForestClassifier)
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.ml.regression import (DecisionTreeRegressor, GBTRegressor, LinearRegression, RandomForestRegressor)
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kiln.functions import arrays as A
from kiln.operators import trees as TR

FEATURES = "features"


def assemble(df: DataFrame, cols: Sequence[str], out: str = FEATURES) -> DataFrame:
    return VectorAssembler(inputCols=list(cols), outputCol=out, handleInvalid="keep").transform(df)


# M1 / M2 / M3 / M4 / M7 / M8 --------------------------------------------------------
def estimator(name: str, task: str, n_features: int = 0, n_classes: int = 2, label: str = "label",
              weight: str | None = None, seed: int = 42, **kw):
    """Model factory; ``task`` is ``classification`` or ``regression``.

    xgboost / lightgbm both map to gradient-boosted trees (MLlib's for two classes
    and regression, softmax boosting of all classes together otherwise); svm is the linear SVC (one-vs-rest); mlp is the
    multilayer perceptron (hidden layers = hidden x num_layers)."""
    common = {"featuresCol": FEATURES, "labelCol": label}
    wc = {"weightCol": weight} if weight else {}
    if task == "classification":
        if name == "decision_tree":
            return DecisionTreeClassifier(seed=seed, **common, **wc, **kw)
        if name == "random_forest":
            return RandomForestClassifier(seed=seed, **common, **wc, **kw)
        if name == "logistic_regression":
            return LogisticRegression(**common, **wc, **kw)
        if name == "svm":
            return OneVsRest(classifier=LinearSVC(**kw), **common, **wc)
        if name in ("xgboost", "lightgbm", "gbt"):
            return GBTClassifier(seed=seed, **common, **wc, **kw) if n_classes <= 2 else TR.Boosting(**common, **wc, **kw)
        if name == "mlp":
            hidden = kw.pop("hidden", 32)
            layers = kw.pop("num_layers", 2)
            return MultilayerPerceptronClassifier(layers=[n_features] + [hidden] * layers + [n_classes], seed=seed,
                                                  **common, **kw)
    if task == "regression":
        if name == "decision_tree":
            return DecisionTreeRegressor(seed=seed, **common, **wc, **kw)
        if name == "random_forest":
            return RandomForestRegressor(seed=seed, **common, **wc, **kw)
        if name in ("logistic_regression", "linear_regression"):
            return LinearRegression(**common, **wc, **kw)
        if name in ("xgboost", "lightgbm", "gbt"):
            return GBTRegressor(seed=seed, **common, **wc, **kw)
    raise ValueError(f"Unknown model {name} for {task}")


# M2 / M15 --------------------------------------------------------------------
def class_weights(df: DataFrame, label: str, how: str = "balanced", out: str = "weight") -> DataFrame:
    """``balanced``: n / (k * count_c); ``inverse``: 1 / count_c.  Class counts
    are a small aggregate joined back (no window over a class or over all rows)."""
    counts = df.groupBy(label).agg(F.count(F.lit(1)).alias("_cnt"))
    if how == "inverse":
        w = counts.select(label, (1.0 / F.col("_cnt")).alias(out))
    else:
        tot = counts.agg(F.sum("_cnt").alias("_n"), F.count(F.lit(1)).alias("_k"))
        w = counts.crossJoin(tot).select(label, (F.col("_n") / (F.col("_k") * F.col("_cnt"))).alias(out))
    return df.join(w, label, "left")


# M10 ------------------------------------------------------------------------
def predictions(model, data: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
    """Predictions of a fitted model, with the class-probability array where it has one."""
    out = model.transform(data)
    cols = [*keep, F.col("prediction")]
    if "probability" in out.columns:
        cols.append(vector_to_array("probability").alias("probs"))
    return out.select(*cols)


def fit_predict(est, train: DataFrame, test: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
    """Fit on train, score test."""
    return predictions(est.fit(train), test, keep)


# M5 -------------------------------------------------------------------------
def gaussian_nb(train: DataFrame, test: DataFrame, cols: Sequence[str], label: str, key: str,
                var_smoothing: float = 1e-9) -> DataFrame:
    """Gaussian naive Bayes: class priors, per-class mean / population variance
    (+ var_smoothing x largest feature variance), arg-max log density (first
    class on ties).  Fit = two aggregates; scoring reads the class table as one
    broadcast value."""
    cols = list(cols)
    stats = train.groupBy(label).agg(F.count(F.lit(1)).alias("_n"),
                                     *[F.avg(c).alias(f"_m{i}") for i, c in enumerate(cols)],
                                     *[F.var_pop(c).alias(f"_v{i}") for i, c in enumerate(cols)])
    eps = train.agg(F.greatest(*[F.var_pop(c) for c in cols]).alias("_e") if len(cols) > 1
                    else F.var_pop(cols[0]).alias("_e"))
    # one row per class, kept as one array value: scoring is a projection of each
    # test row over it, not a row per pair
    model = stats.crossJoin(eps).agg(F.sort_array(F.collect_list(F.struct(
        F.col(label).alias("c"), F.col("_n").alias("n"),
        F.array(*[F.col(f"_m{i}") for i in range(len(cols))]).alias("m"),
        F.array(*[F.col(f"_v{i}") + F.lit(var_smoothing) * F.col("_e") for i in range(len(cols))]).alias("v")))).alias("_model"))
    total = F.aggregate("_model", F.lit(0).cast("long"), lambda a, x: a + x["n"])
    x = F.array(*[F.col(c) for c in cols])

    def density(k):
        terms = F.zip_with(F.zip_with(x, k["m"], lambda a, b: a - b), k["v"],
                           lambda d, v: F.log(2 * math.pi * v) + d * d / v)
        return F.log(k["n"] / F.col("_total")) - 0.5 * F.aggregate(terms, F.lit(0.0), lambda a, t: a + t)
    scored = test.select(key, *cols).crossJoin(F.broadcast(model)).withColumn("_total", total)
    best = F.array_min(F.transform("_model", lambda k: F.struct((-density(k)).alias("l"), k["c"].alias("c"))))
    return scored.select(key, best["c"].alias("prediction"))


# M9 -------------------------------------------------------------------------
def multi_output(train: DataFrame, test: DataFrame, target: str, key: str, **kw) -> DataFrame:
    """(key, probs): one forest whose leaves hold vectors, fitted on the array column ``target``, then the P22
    normaliser on the predicted row."""
    model = TR.VectorForest(targetCol=target, keyCol=key, featuresCol=FEATURES, **kw).fit(train)
    return model.transform(test).select(key, A.normalize_probs(vector_to_array("probability")).alias("probs"))


# M11 ------------------------------------------------------------------------
def fitted(estimators: Sequence, train: DataFrame, at_once: int = 4) -> list:
    """Fits of several estimators on the same rows, ``at_once`` of them at a time."""
    with ThreadPoolExecutor(max(1, at_once)) as pool:
        return list(pool.map(lambda est: est.fit(train), estimators))


def sweep(build, grid: Sequence[dict], train: DataFrame, test: DataFrame, score, at_once: int = 4) -> DataFrame:
    """Cartesian settings -> one metrics row each: ``build(**setting)`` gives an
    estimator, ``score(pred_df)`` a one-row metrics DataFrame."""
    out = None
    for i, (setting, model) in enumerate(zip(grid, fitted([build(**g) for g in grid], train, at_once), strict=True)):
        m = score(model.transform(test)).withColumn("run", F.lit(i)).withColumn("setting", F.lit(str(sorted(setting.items()))))
        out = m if out is None else out.unionByName(m)
    return out


def grid(**axes) -> list[dict]:
    keys = list(axes)
    out = [{}]
    for k in keys:
        out = [dict(o, **{k: v}) for o in out for v in axes[k]]
    return out


# M12 ------------------------------------------------------------------------
def feature_feedback(train: DataFrame, test: DataFrame, cols: Sequence[str], label: str,
                     thresholds: Sequence[float], bins: int = 10) -> tuple[DataFrame, DataFrame]:
    """Feedback on features, and a score per importance threshold.

    (feature, importance, corr, mutual_info, rank, kept): forest importance,
    correlation and binned mutual information with the label, rank by importance,
    kept under the best threshold.  (threshold, features, score): accuracy on
    ``test`` of boosted trees on the features at or above each threshold."""
    from kiln.operators import aggregates as AG
    from kiln.operators import evaluation as E
    from kiln.operators import quantiles as Q
    cols = list(cols)
    forest = estimator("random_forest", "classification", numTrees=50, maxDepth=8, label=label).fit(train)
    imp = dict(zip(cols, map(float, forest.featureImportances.toArray())))
    corr = {r["a"]: r["corr"] for r in AG.correlations(train, cols, target=label).collect()}    # one row per feature
    edges = Q.multi_quantiles(train, {c: [i / bins for i in range(1, bins)] for c in cols})
    # all features binned in one projection, all joint counts in one aggregate
    binned = train.select(label, F.explode(F.array(*[
        F.struct(F.lit(c).alias("feature"),
                 sum(((F.col(c) > F.lit(e)).cast("int") for e in sorted(set(edges[c]))), F.lit(0)).alias("bin"))
        for c in cols])).alias("x")).select(label, "x.*")
    joint = binned.groupBy("feature", "bin", label).agg(F.count(F.lit(1)).alias("nxy"))
    per_bin = joint.groupBy("feature", "bin").agg(F.sum("nxy").alias("nx"))
    per_label = joint.groupBy("feature", label).agg(F.sum("nxy").alias("ny"))
    total = joint.groupBy("feature").agg(F.sum("nxy").alias("n"))
    mi = joint.join(per_bin, ["feature", "bin"]).join(per_label, ["feature", label]).join(total, "feature")
    mi = mi.groupBy("feature").agg(F.sum(F.col("nxy") / F.col("n") * F.log(
        F.col("nxy") * F.col("n") / (F.col("nx") * F.col("ny")))).alias("mi"))
    mi = {r["feature"]: max(0.0, r["mi"]) for r in mi.collect()}
    n_classes = train.select(label).distinct().count()
    keeps = [[c for c in cols if imp[c] >= t] or cols for t in thresholds]

    def scored(keep: list[str]) -> float:
        tr, te = (assemble(d.drop(FEATURES), keep) for d in (train, test))
        model = estimator("gbt", "classification", n_classes=n_classes, label=label, maxIter=5, maxDepth=3).fit(tr)
        return float(E.accuracy(model.transform(te).withColumnRenamed("prediction", "pred"), label, "pred").first()[0])

    with ThreadPoolExecutor(max(1, len(keeps))) as pool:
        scores = [(float(t), keep, s) for t, keep, s in zip(thresholds, keeps, pool.map(scored, keeps), strict=True)]
    best = max(scores, key=lambda s: (s[2], -len(s[1])))
    order = sorted(cols, key=lambda c: -imp[c])
    rows = [(c, imp[c], float(corr.get(c) or 0.0), mi.get(c, 0.0), order.index(c) + 1, c in best[1]) for c in cols]
    spark = train.sparkSession
    return (spark.createDataFrame(rows, "feature string, importance double, corr double, mutual_info double, rank int, kept boolean"),
            spark.createDataFrame([(t, len(k), s) for t, k, s in scores], "threshold double, features int, score double"))


# M13 / M14 --------------------------------------------------------------------
def first_chunk_model(df: DataFrame, chunk: str, est):
    """Fit on the first chunk (smallest chunk id) only."""
    first = df.agg(F.min(chunk).alias("c")).first()["c"]
    return est.fit(df.filter(F.col(chunk) == first)), first


def ensemble_scores(train: DataFrame, test: DataFrame, chunk: str, key: str, label: str = "label", n_classes: int = 2,
                    positive_index: int = 1, **kw) -> DataFrame:
    """(key, probability): a forest per chunk, all grown in the same passes, each learning from its chunk alone; the
    positive-class probabilities are averaged over the chunks, 0.5 for rows without features."""
    chunks = [r[0] for r in train.select(chunk).distinct().orderBy(chunk).collect()]        # as many as there are models
    number = F.coalesce(*[F.when(F.col(chunk).eqNullSafe(F.lit(c)), F.lit(i)) for i, c in enumerate(chunks)])
    rows = train.withColumn("_part", number).withColumn(
        "_target", F.array(*[(F.col(label) == c).cast("double") for c in range(n_classes)]))
    model = TR.VectorForest(targetCol="_target", keyCol=key, groupCol="_part", groups=tuple(range(len(chunks))),
                            featuresCol=FEATURES, **kw).fit(rows)
    p = F.when(F.col(FEATURES).isNotNull(), vector_to_array("probability")[positive_index])
    return model.transform(test).select(key, F.coalesce(p, F.lit(0.5)).alias("probability"))
