"""Model queries (M1-M15) on ``embeddings`` (all 64 dimensions, 10 classes),
split 80/20 by the md5 hash of ``vec_id``; binary tasks on documents + labels."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from kiln.functions import arrays as A
from kiln.operators import evaluation as E
from kiln.operators import models as M
from kiln.operators import series as S
from kiln.operators import splits as O
from kiln.operators import text as TX
from kiln.plans.registry import query
from kiln.session import scratch_path, written
from kiln.sources import sinks as K
from kiln.tables import load

DIMS = 64
COLS = [f"e{i}" for i in range(DIMS)]


def embedding_split(spark, sf_dir):
    e = load(spark, sf_dir, "embeddings")
    d = e.select("vec_id", F.col("label").cast("double").alias("label"),
                 *[F.col("embedding")[i].cast("double").alias(c) for i, c in enumerate(COLS)])
    d = O.random_split(d, "vec_id", 20)
    d = M.assemble(d, COLS)
    return d.filter("split = 'train'"), d.filter("split = 'test'")


# A fitted model has no SQL form: tests/test_models.py holds each against a plain version.


def _r(c, digits: int = 9):
    return F.round(c, digits) + F.lit(0.0)


def _rounded(name: str, digits: int = 9):
    return F.transform(name, lambda x: F.round(x, digits) + F.lit(0.0)).alias(name)


def scored(est, train, test):
    """(vec_id, label, prediction[, probs]) of the test rows."""
    pred = M.predictions(est.fit(train), test, keep=["vec_id", "label"])
    return pred.select("vec_id", "label", "prediction", *([_rounded("probs")] if "probs" in pred.columns else []))


def _classify(spark, sf_dir, name, **kw):
    train, test = embedding_split(spark, sf_dir)
    return scored(M.estimator(name, "classification", n_features=DIMS, n_classes=10, **kw), train, test)


@query("m01_decision_tree", covers=("M1", "M10"))
def decision_tree(spark, sf_dir):
    return _classify(spark, sf_dir, "decision_tree", maxDepth=10)


@query("m02_random_forest_weighted", covers=("M2", "M15"))
def random_forest(spark, sf_dir):
    train, test = embedding_split(spark, sf_dir)
    train = M.class_weights(train, "label", "balanced")
    est = M.estimator("random_forest", "classification", weight="weight", numTrees=100, maxDepth=8)
    return scored(est, train, test)


@query("m03_logistic_regression", covers=("M3",))
def logistic(spark, sf_dir):
    return _classify(spark, sf_dir, "logistic_regression", maxIter=100)


@query("m03_linear_regression", covers=("M3",))
def linear(spark, sf_dir):
    """Least squares with intercept on all 64 coordinates."""
    train, test = embedding_split(spark, sf_dir)
    return M.fit_predict(M.estimator("linear_regression", "regression"), train, test, ["vec_id", "label"]).select(
        "vec_id", "label", _r("prediction").alias("prediction"))


@query("m03_least_squares", """
WITH d AS (SELECT l_orderkey, l_linenumber, l_quantity AS a, l_discount AS b, l_extendedprice AS y,
             CAST(('0x' || substr(md5(CAST(l_orderkey AS VARCHAR) || '42'), 1, 8)) AS BIGINT) % 100 < 20 AS is_test FROM lineitem),
s AS (SELECT avg(a) AS ma, avg(b) AS mb, avg(y) AS my, var_pop(a) AS aa, var_pop(b) AS bb, covar_pop(a, b) AS ab,
             covar_pop(a, y) AS ay, covar_pop(b, y) AS byy FROM d WHERE NOT is_test),
c AS (SELECT *, (ay * bb - byy * ab) / (aa * bb - ab * ab) AS wa, (byy * aa - ay * ab) / (aa * bb - ab * ab) AS wb FROM s)
SELECT l_orderkey, l_linenumber, round(my + wa * (a - ma) + wb * (b - mb), 3) + 0.0 AS prediction FROM d, c WHERE is_test""",
       covers=("M3", "M10"))
def least_squares(spark, sf_dir):
    """Price of a line by its quantity and discount; two features have a closed form."""
    d = load(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_quantity", "l_discount",
                                               F.col("l_extendedprice").alias("label"))
    d = M.assemble(O.random_split(d, "l_orderkey", 20), ["l_quantity", "l_discount"])
    train, test = d.filter("split = 'train'"), d.filter("split = 'test'")
    return M.fit_predict(M.estimator("linear_regression", "regression"), train, test, ["l_orderkey", "l_linenumber"]).select(
        "l_orderkey", "l_linenumber", _r("prediction", 3).alias("prediction"))


@query("m04_linear_svc", covers=("M4",))
def svc(spark, sf_dir):
    return _classify(spark, sf_dir, "svm", maxIter=100, tol=1e-3, regParam=0.01)


@query("m07_boosted_trees", covers=("M7",))
def gbt(spark, sf_dir):
    return _classify(spark, sf_dir, "xgboost", maxIter=20, maxDepth=3)


@query("m08_multilayer_perceptron", covers=("M8",))
def mlp(spark, sf_dir):
    return _classify(spark, sf_dir, "mlp", maxIter=100)


# M5: exact Gaussian naive Bayes ----------------------------------------------------------
def _nb_sql() -> str:
    feats = ", ".join(f"CAST(embedding[{i + 1}] AS DOUBLE) AS e{i}" for i in range(DIMS))
    means = ", ".join(f"avg(e{i}) AS m{i}, var_pop(e{i}) AS v{i}" for i in range(DIMS))
    eps = "greatest(" + ", ".join(f"var_pop(e{i})" for i in range(DIMS)) + ")"
    ll = " - ".join(["ln(n / nn)"] + [f"0.5 * (ln(2 * pi() * (v{i} + 1e-9 * eps)) + power(t.e{i} - m{i}, 2) / (v{i} + 1e-9 * eps))"
                                      for i in range(DIMS)])
    return f"""
WITH d AS (SELECT vec_id, CAST(label AS DOUBLE) AS label, {feats},
                  CAST(('0x' || substr(md5(CAST(vec_id AS VARCHAR) || '42'), 1, 8)) AS BIGINT) % 100 < 20 AS is_test
           FROM embeddings),
tr AS (SELECT * FROM d WHERE NOT is_test),
st AS (SELECT label AS c, count(*) AS n, {means} FROM tr GROUP BY label),
g AS (SELECT {eps} AS eps, count(*) AS nn FROM tr),
s AS (SELECT t.vec_id, st.c, {ll} AS ll FROM (SELECT * FROM d WHERE is_test) t, st, g)
SELECT vec_id, arg_min(c, (-ll, c)) AS prediction FROM s GROUP BY vec_id"""


@query("m05_gaussian_naive_bayes", _nb_sql(), covers=("M5",))
def naive_bayes(spark, sf_dir):
    train, test = embedding_split(spark, sf_dir)
    return M.gaussian_nb(train, test, COLS, "label", "vec_id")


# Inverse-count class weights ------------------------------------------------------
@query("m15_class_weights", """
SELECT vec_id, label, 1.0 / count(*) OVER (PARTITION BY label) AS weight FROM embeddings""", covers=("M15",))
def weights(spark, sf_dir):
    e = load(spark, sf_dir, "embeddings").select("vec_id", "label")
    return M.class_weights(e, "label", "inverse")


# M9 ------------------------------------------------------------------------------------
@query("m09_multi_output_regression", covers=("M9", "P22"))
def multi_output(spark, sf_dir):
    """Shares of 18 bins per row, by one forest with vector leaves; a row sums to one."""
    train, test = embedding_split(spark, sf_dir)
    e = load(spark, sf_dir, "embeddings").select("vec_id", F.slice("embedding", 1, len(A.BIN_EDGES) - 1).alias("_t"))
    raw = F.transform("_t", lambda x: F.exp(x.cast("double")))
    tr = train.join(e, "vec_id").withColumn("target", A.normalize_probs(raw))
    return M.multi_output(tr, test, "target", "vec_id", numTrees=10, maxDepth=5).select("vec_id", _rounded("probs"))


# M11 + K6 -----------------------------------------------------------------------------
@query("m11_parameter_sweep", covers=("M11", "K6"))
def sweep(spark, sf_dir):
    """One row per setting with its accuracy; the metrics are appended to the run log and read back."""
    train, test = embedding_split(spark, sf_dir)

    def build(numTrees, maxDepth):
        return M.estimator("random_forest", "classification", numTrees=numTrees, maxDepth=maxDepth)

    def score(pred):
        return E.accuracy(pred.withColumn("pred", F.col("prediction")), "label", "pred")
    out = written(M.sweep(build, M.grid(numTrees=[20, 50], maxDepth=[5, 8]), train, test, score), "sweep")
    log = scratch_path(spark, f"runs-{uuid.uuid4().hex}")
    K.append_metrics(out.select("run", F.lit("accuracy").alias("key"), F.col("accuracy").alias("value")), log, "sweep", "run_id")
    back = spark.read.parquet(log).where("run_id = 'sweep'").groupBy("run").agg(F.max("value").alias("logged"))
    return out.join(back, "run").select(F.col("run").cast("int").alias("run"), "setting", "accuracy", "logged")


# M12 ----------------------------------------------------------------------------------
def _feedback(spark, sf_dir):
    train, test = embedding_split(spark, sf_dir)
    return M.feature_feedback(train, test, COLS, "label", thresholds=[0.0, 0.01, 0.02])


@query("m12_feature_feedback", covers=("M12", "A12", "A20"))
def feature_feedback(spark, sf_dir):
    """Per feature: forest importance, correlation and binned mutual information
    with the label, its rank, and whether the chosen threshold keeps it."""
    return _feedback(spark, sf_dir)[0]


@query("m12_threshold_scores", covers=("M12",))
def threshold_scores(spark, sf_dir):
    """Per importance threshold: the kept features and the score of boosted trees on them."""
    return _feedback(spark, sf_dir)[1]


# M13 + M14 -----------------------------------------------------------------------------
def _doc_features(spark, sf_dir):
    """Hashed word counts of the whole text and its length, written once: every pass of a fit reads them."""
    from pyspark.ml.feature import HashingTF
    d = load(spark, sf_dir, "documents").join(load(spark, sf_dir, "labels"), "doc_id")
    d = d.select("doc_id", F.col("quality").cast("double").alias("label"), (F.col("doc_id") % 4).alias("chunk"),
                 TX.tokens(F.col("text")).alias("words"), F.length("text").cast("double").alias("length"),
                 (F.length(F.regexp_replace("text", r"[^#*$%&|<>]", "")) / (F.length("text") + 1)).alias("symbols"))
    d = HashingTF(numFeatures=256, inputCol="words", outputCol="counts").transform(d)
    return written(M.assemble(d, ["counts", "length", "symbols"]).drop("words", "counts"), "doc-features")


@query("m13_first_chunk_scoring", covers=("M13", "ST4"))
def first_chunk(spark, sf_dir):
    """Fit on the first chunk, score every later chunk: accuracy per chunk and the
    running overall accuracy."""
    d = _doc_features(spark, sf_dir)
    model, first = M.first_chunk_model(d, "chunk", M.estimator("random_forest", "classification", numTrees=100))
    pred = model.transform(d.filter(F.col("chunk") > first))
    per = pred.groupBy("chunk").agg(F.count(F.lit(1)).alias("n"),
                                    F.sum((F.col("prediction") == F.col("label")).cast("long")).alias("hits"))
    run = S.sequence(per.withColumn("_k", F.lit(0)), ["_k"], ["chunk"])
    run = S.scan_sum(run, ["_k"], {"_h": F.col("hits").cast("double"), "_s": F.col("n").cast("double")})
    return run.select("chunk", "n", F.col("_s").cast("long").alias("seen"), (F.col("hits") / F.col("n")).alias("accuracy"),
                      (F.col("_h") / F.col("_s")).alias("running_accuracy"))


@query("m14_chunk_ensemble", covers=("M14",))
def ensemble(spark, sf_dir):
    """Positive probability of the last chunk's rows, the mean of one model for each earlier chunk."""
    d = _doc_features(spark, sf_dir)
    out = M.ensemble_scores(d.filter(F.col("chunk") < 3), d.filter(F.col("chunk") == 3), "chunk", "doc_id",
                            numTrees=50, maxDepth=5, share=0.2)
    return out.select("doc_id", _r("probability").alias("probability"))
