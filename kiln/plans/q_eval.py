"""Evaluation queries (E1-E14) on a deterministic two-model scorer over
``embeddings`` (10 classes), ``labels`` (binary) and the forward-return vectors."""

from __future__ import annotations

from pyspark.sql import functions as F

from kiln.functions import arrays as A
from kiln.operators import evaluation as E
from kiln.operators import metrics as ME
from kiln.plans import q_series
from kiln.plans.registry import query
from kiln.plans.sqlkit import unsign
from kiln.session import written
from kiln.tables import load

N_CLASSES = 10
# Scorer names and the rule that gives each a signal on the true class.
MODELS = {"model_a": "vec_id % 3 <> 0", "model_b": "vec_id % 2 = 0"}


def _r(c, d=6):
    return F.round(c, d) + F.lit(0.0)


def predictions(spark, sf_dir):
    e = load(spark, sf_dir, "embeddings").select("vec_id", "label")
    out = None
    for name, rule in MODELS.items():
        boost = F.expr(rule)
        w = {f"_w{i}": (F.conv(F.substring(F.md5(F.concat_ws("|", F.lit(name), F.col("vec_id").cast("string"),
                                                              F.lit(str(i)))), 1, 6), 16, 10).cast("long") % 1000 + 1
                        + F.when(boost & (F.col("label") == i), F.lit(3000)).otherwise(F.lit(0)))
             for i in range(N_CLASSES)}
        # staged: weights, then their total, then the row (each computed once)
        d = e.select(F.lit(name).alias("model"), "vec_id", "label", *[v.alias(k) for k, v in w.items()])
        tot = F.col("_w0")
        for i in range(1, N_CLASSES):
            tot = tot + F.col(f"_w{i}")
        d = d.withColumn("_tot", tot)
        d = d.select("model", "vec_id", "label",
                     F.array(*[F.col(f"_w{i}") / F.col("_tot") for i in range(N_CLASSES)]).alias("probs"))
        out = d if out is None else out.unionByName(d)
    return out.withColumn("pred", A.argmax(F.col("probs")))


def _pred_sql() -> str:
    parts = []
    for name, rule in MODELS.items():
        parts.append(f"""SELECT '{name}' AS model, vec_id, label, list_transform(range({N_CLASSES}), lambda i:
    CAST(('0x' || substr(md5('{name}' || '|' || CAST(vec_id AS VARCHAR) || '|' || CAST(i AS VARCHAR)), 1, 6)) AS BIGINT) % 1000 + 1
    + CASE WHEN ({rule}) AND label = i THEN 3000 ELSE 0 END) AS w FROM embeddings""")
    return ("preds AS (SELECT model, vec_id, label, list_transform(w, lambda x: x / list_sum(w)) AS probs, "
            "CAST(list_position(w, list_max(w)) - 1 AS INTEGER) AS pred FROM (" + " UNION ALL ".join(parts) + "))")


PRED_SQL = _pred_sql()
CM_SQL = PRED_SQL + """,
cls AS (SELECT DISTINCT model, c FROM (SELECT model, label AS c FROM preds UNION ALL SELECT model, pred FROM preds)),
cnt AS (SELECT model, label AS true_label, pred AS pred_label, count(*) AS count FROM preds GROUP BY 1, 2, 3),
cm AS (SELECT a.model, a.c AS true_label, b.c AS pred_label, coalesce(count, 0) AS count
       FROM cls a JOIN cls b USING (model) LEFT JOIN cnt ON cnt.model = a.model AND cnt.true_label = a.c AND cnt.pred_label = b.c),
pc AS (SELECT model, true_label AS class,
         sum(CASE WHEN true_label = pred_label THEN count ELSE 0 END) AS tp, sum(count) AS support FROM cm GROUP BY 1, 2),
pp AS (SELECT model, pred_label AS class, sum(count) AS pn FROM cm GROUP BY 1, 2),
m AS (SELECT pc.model, pc.class, support,
        CASE WHEN pn > 0 THEN tp / pn ELSE 0.0 END AS precision, CASE WHEN support > 0 THEN tp / support ELSE 0.0 END AS recall
      FROM pc JOIN pp USING (model, class)),
f AS (SELECT *, CASE WHEN precision + recall > 0 THEN 2 * precision * recall / (precision + recall) ELSE 0.0 END AS f1 FROM m)"""


@query("e01_classification_summary", unsign("WITH " + CM_SQL + """
SELECT f.model, round(acc, 9) AS accuracy,
       round(sum(precision * support) / sum(support), 9) AS precision_weighted,
       round(sum(recall * support) / sum(support), 9) AS recall_weighted,
       round(sum(f1 * support) / sum(support), 9) AS f1_weighted, round(avg(f1), 9) AS f1_macro
FROM f JOIN (SELECT model, avg(CASE WHEN label = pred THEN 1.0 ELSE 0.0 END) AS acc FROM preds GROUP BY 1) a USING (model)
GROUP BY f.model, acc""", ["accuracy", "precision_weighted", "recall_weighted", "f1_weighted", "f1_macro"]),
       covers=("E1", "E2"))
def classification_summary(spark, sf_dir):
    j = E.summary(E.per_class(predictions(spark, sf_dir), model="model"), model="model")
    return j.select("model", *[_r(F.col(c), 9).alias(c) for c in
                               ("accuracy", "precision_weighted", "recall_weighted", "f1_weighted", "f1_macro")])


@query("e04_per_class_report", unsign("WITH " + CM_SQL + """
SELECT model, class, round(precision, 3) AS precision, round(recall, 3) AS recall, round(f1, 3) AS f1,
       CAST(support AS BIGINT) AS support FROM f""", ["precision", "recall", "f1"]), covers=("E4",))
def per_class_report(spark, sf_dir):
    pc = E.per_class(predictions(spark, sf_dir), model="model")
    return pc.select("model", "class", *[_r(F.col(c), 3).alias(c) for c in ("precision", "recall", "f1")], "support")


@query("e03_confusion_matrix", "WITH " + CM_SQL + "\nSELECT model, true_label, pred_label, count FROM cm",
       covers=("E3", "A6"))
def confusion_matrix(spark, sf_dir):
    return E.confusion(predictions(spark, sf_dir), model="model")


# E5 ------------------------------------------------------------------------------
def _auc_sql(src: str, score: str, pos: str, group: str) -> str:
    gsel = f"{group}, " if group else ""
    part = f"PARTITION BY {group} " if group else ""
    gby = f"GROUP BY {group}" if group else ""
    return f"""
v AS (SELECT {gsel}{score} AS s, count(*) AS t, sum(CASE WHEN {pos} THEN 1 ELSE 0 END) AS tp FROM {src} GROUP BY ALL),
c AS (SELECT *, sum(t) OVER ({part}ORDER BY s ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) - t + (t + 1) / 2.0 AS r FROM v),
a AS (SELECT {gsel}sum(tp * r) AS rp, CAST(sum(tp) AS DOUBLE) AS np, CAST(sum(t) - sum(tp) AS DOUBLE) AS nn FROM c {gby})"""


OVR_SQL = "WITH " + PRED_SQL + """,
long AS (SELECT model, label, unnest(range(10)) AS class, unnest(probs) AS p FROM preds),
lg AS (SELECT model || '#' || class AS g, model, class, label, p FROM long),""" + _auc_sql("lg", "p", "label = class", "g") + """,
auc AS (SELECT g, (rp - np * (np + 1) / 2) / (np * nn) AS auc FROM a WHERE np > 0 AND nn > 0),
sup AS (SELECT model, label AS class, count(*) AS support FROM preds GROUP BY 1, 2),
j AS (SELECT model, class, auc, support FROM auc JOIN (SELECT DISTINCT g, model, class FROM lg) USING (g)
      JOIN sup USING (model, class))
SELECT model, round(avg(auc), 9) AS auc_macro, round(sum(auc * support) / sum(support), 9) AS auc_weighted
FROM j GROUP BY model"""


@query("e05_ovr_auc", unsign(OVR_SQL, ["auc_macro", "auc_weighted"]), covers=("E5",))
def ovr_auc(spark, sf_dir):
    a = E.ovr_auc(predictions(spark, sf_dir), "label", "probs", N_CLASSES, model="model")
    return a.select("model", _r(F.col("auc_macro"), 9).alias("auc_macro"),
                    _r(F.col("auc_weighted"), 9).alias("auc_weighted"))


BIN_SRC = """(SELECT quality, ((doc_id * 7919) % 1000) / 1000.0 + quality * 0.3 + (n_chars % 7) / 10.0 AS score
  FROM documents JOIN labels USING (doc_id))"""


def _binary_scores(spark, sf_dir):
    d = load(spark, sf_dir, "documents").join(load(spark, sf_dir, "labels"), "doc_id")
    return d.select("quality", ((F.col("doc_id") * 7919) % 1000 / 1000.0 + F.col("quality") * 0.3
                                + (F.col("n_chars") % 7) / 10.0).alias("score"))


@query("e05_binary_auc", unsign("WITH " + _auc_sql(BIN_SRC, "score", "quality = 1", "").lstrip() + """
SELECT round((rp - np * (np + 1) / 2) / (np * nn), 9) AS auc FROM a""", ["auc"]), covers=("E5",))
def binary_auc(spark, sf_dir):
    a = E.binary_auc(_binary_scores(spark, sf_dir), "score", F.col("quality") == 1)
    return a.select(_r(F.col("auc"), 9).alias("auc"))


ROC_SQL = f"""
WITH d AS {BIN_SRC},
v AS (SELECT score, sum(quality) AS tp, count(*) - sum(quality) AS fp FROM d GROUP BY score),
c AS (SELECT score, sum(tp) OVER (ORDER BY score DESC ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS ctp,
             sum(fp) OVER (ORDER BY score DESC ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS cfp FROM v),
t AS (SELECT CAST(sum(quality) AS DOUBLE) AS P, CAST(count(*) - sum(quality) AS DOUBLE) AS N FROM d)
SELECT score AS threshold, round(cfp / N, 9) AS fpr, round(ctp / P, 9) AS tpr FROM c, t"""


@query("e06_roc_curve", unsign(ROC_SQL, ["fpr", "tpr"]), covers=("E6",))
def roc_curve(spark, sf_dir):
    pts = E.roc_points(_binary_scores(spark, sf_dir), "score", F.col("quality") == 1)
    return pts.select("threshold", _r(F.col("fpr"), 9).alias("fpr"), _r(F.col("tpr"), 9).alias("tpr"))


@query("e06_roc_trapezoid_auc", unsign("WITH p AS (" + ROC_SQL + """),
l AS (SELECT fpr, tpr, lag(fpr, 1, 0.0) OVER w AS pf, lag(tpr, 1, 0.0) OVER w AS pt FROM p WINDOW w AS (ORDER BY threshold DESC))
SELECT round(sum((fpr - pf) * (tpr + pt) / 2), 6) AS auc FROM l""", ["auc"]), covers=("E6",))
def roc_area(spark, sf_dir):
    """Trapezoid area under the ROC points."""
    pts = E.roc_points(_binary_scores(spark, sf_dir), "score", F.col("quality") == 1)
    return E.trapezoid_auc(pts).select(_r(F.col("auc")).alias("auc"))


# E7 + E8 ---------------------------------------------------------------------------
REG_SRC = "(SELECT o_totalprice / 1000.0 AS y, (o_custkey % 500) + o_totalprice / 1500.0 AS yhat FROM orders)"


@query("e07_regression_metrics", unsign(f"""
WITH d AS {REG_SRC}
SELECT round(avg(abs(yhat - y)), 6) AS mae, round(avg(power(yhat - y, 2)), 4) AS mse,
       round(sqrt(avg(power(yhat - y, 2))), 6) AS rmse,
       round(1 - sum(power(yhat - y, 2)) / (var_pop(y) * count(*)), 9) AS r2 FROM d""", ["mae", "mse", "rmse", "r2"]),
       covers=("E7",))
def regression(spark, sf_dir):
    o = load(spark, sf_dir, "orders").select((F.col("o_totalprice") / 1000.0).alias("y"),
                                             ((F.col("o_custkey") % 500) + F.col("o_totalprice") / 1500.0).alias("yhat"))
    m = E.regression_metrics(o, "y", "yhat")
    return m.select(_r(F.col("mae")).alias("mae"), _r(F.col("mse"), 4).alias("mse"), _r(F.col("rmse")).alias("rmse"),
                    _r(F.col("r2"), 9).alias("r2"))


@query("e08_error_by_quintile", unsign(f"""
WITH d AS {REG_SRC},
q AS (SELECT quantile_cont(y, [0.2, 0.4, 0.6, 0.8]) AS e FROM d),
b AS (SELECT CASE WHEN y <= e[1] THEN 0 WHEN y <= e[2] THEN 1 WHEN y <= e[3] THEN 2 WHEN y <= e[4] THEN 3 ELSE 4 END AS bin,
             y, yhat FROM d, q)
SELECT CAST(bin AS INTEGER) AS bin, round(avg(abs(yhat - y)), 6) AS mae, round(sqrt(avg(power(yhat - y, 2))), 6) AS rmse,
       count(*) AS count FROM b GROUP BY bin""", ["mae", "rmse"]), covers=("E8", "A15"))
def error_by_quintile(spark, sf_dir):
    from kiln.operators import aggregates as AG
    o = load(spark, sf_dir, "orders").select((F.col("o_totalprice") / 1000.0).alias("y"),
                                             ((F.col("o_custkey") % 500) + F.col("o_totalprice") / 1500.0).alias("yhat"))
    b = AG.quantile_bins(o, "y", 5)
    m = E.regression_metrics(b, "y", "yhat", ["bin"]).join(b.groupBy("bin").agg(F.count(F.lit(1)).alias("count")), "bin")
    return m.select("bin", _r(F.col("mae")).alias("mae"), _r(F.col("rmse")).alias("rmse"), "count")


# E9 / E10 --------------------------------------------------------------------------
def _vectors(spark, sf_dir):
    v = q_series.forward_frame(spark, sf_dir).filter(F.col("y_bins").isNotNull())
    pred = F.transform("y_bins", lambda x: 0.7 * x + 0.3 / 18)
    return v.select("series", "ts", F.col("y_bins").alias("p_true"), pred.alias("p_pred"))


def _losses_sql(normalize: bool) -> str:
    """Row losses by list functions; ``t`` and ``q`` are the true and predicted vectors."""
    def norm(v):
        return f"list_transform({v}, lambda x: x / list_sum({v}))"

    def clip(v, hi):
        return f"list_transform({v}, lambda x: least(greatest(x, 1e-9), {hi}))"

    def zsum(a, b, f):
        return f"list_sum(list_transform(list_zip({a}, {b}), lambda z: {f}))"

    tc, qc = ("tn0", "qn0") if normalize else ("t", "q")
    hi = "1 - 1e-9" if normalize else "1.0"
    a, b = ("tc", "qc") if normalize else ("t", "q")
    rel = "CASE WHEN z[1] > 0 THEN z[1] * ln(z[1] / z[2]) WHEN z[1] = 0 THEN 0.0 END"
    gaps = [y - x for x, y in zip(A.bin_centers()[:-1], A.bin_centers()[1:])]
    return f"""SELECT series, {str(normalize).lower()} AS normalized, {zsum('tk', 'qk', 'z[1] * ln(z[1] / z[2])')} AS kl,
  0.5 * {zsum('a', 'm', rel)} + 0.5 * {zsum('b', 'm', rel)} AS js, -{zsum('t', 'qc', 'z[1] * ln(z[2])')} AS cross_entropy,
  {zsum('t', 'q', 'abs(z[1] - z[2])')} AS l1, {zsum('t', 'q', '(z[1] - z[2]) * (z[1] - z[2])')} AS l2,
  list_sum(list_transform(range(1, {len(gaps) + 1}), lambda i: abs(list_sum(diff[1:i])) * {gaps!r}[i])) AS emd
FROM (SELECT *, list_transform(list_zip(a, b), lambda z: 0.5 * (z[1] + z[2])) AS m FROM (
  SELECT *, {norm('tc')} AS tk, {norm('qc')} AS qk, {norm(a)} AS a, {norm(b)} AS b,
    list_transform(list_zip(tn0, qn0), lambda z: z[1] - z[2]) AS diff FROM (
    SELECT *, {clip(tc, hi)} AS tc, {clip(qc, hi)} AS qc FROM (
      SELECT series, t, q, {norm('t')} AS tn0, {norm('q')} AS qn0 FROM pq))))"""


PQ_SQL = "WITH " + q_series.FWD_CTES + """,
pq AS (SELECT series, y_bins AS t, list_transform(y_bins, lambda x: 0.7 * x + 0.3 / 18) AS q FROM v WHERE y_bins IS NOT NULL)"""
LOSSES = ("kl", "js", "cross_entropy", "l1", "l2", "emd")


@query("e09_distribution_losses", unsign(PQ_SQL + ", x AS (" + _losses_sql(True) + " UNION ALL " + _losses_sql(False) + """)
SELECT series, normalized, """ + ", ".join(f"round(avg({c}), 6) AS {c}" for c in LOSSES) + " FROM x GROUP BY 1, 2", LOSSES),
       covers=("E9",))
def distribution_losses(spark, sf_dir):
    """Row-mean KL / JS / CE / L1 / L2 / EMD per series, both normalisation modes."""
    v = written(_vectors(spark, sf_dir), "vectors")     # read by both modes
    c = A.bin_centers()
    both = [E.distribution_losses(v, "p_true", "p_pred", c, n, ["series"]).withColumn("normalized", F.lit(n))
            for n in (True, False)]
    return both[0].unionByName(both[1]).select("series", "normalized", *[_r(F.col(k), 6).alias(k) for k in LOSSES])


@query("e10_directional_loss", unsign(PQ_SQL + f""",
e AS (SELECT series, q, list_position(t, list_max(t)) AS i,
             list_sum(list_transform(list_zip(q, {A.bin_centers()!r}), lambda z: z[1] * z[2])) AS ev FROM pq)
SELECT series, round(avg((1 - sqrt(q[i])) * CASE WHEN ev > {A.bin_centers()!r}[i] THEN 1.2 ELSE 1.0 END), 6) AS directional_loss
FROM e GROUP BY 1""", ["directional_loss"]), covers=("E10",))
def directional(spark, sf_dir):
    """Mean asymmetric Hellinger-style loss per series, true bin = arg-max of the realised distribution."""
    v = _vectors(spark, sf_dir).withColumn("true_bin", A.argmax(F.col("p_true")))
    loss = E.directional_loss(F.col("p_pred"), F.col("true_bin"), A.bin_centers())
    return v.groupBy("series").agg(_r(F.avg(loss), 6).alias("directional_loss"))


# E11 / E12 / E13 ----------------------------------------------------------------------
@query("e11_label_losses", unsign("WITH " + PRED_SQL + """
SELECT model, label, round(avg(-ln(probs[label + 1])), 9) AS nll, round(avg(probs[label + 1]), 9) AS mean_p_true,
       round(avg(ln(probs[label + 1])), 9) AS mean_log_p_true FROM preds GROUP BY 1, 2""",
                                    ["nll", "mean_p_true", "mean_log_p_true"]), covers=("E11",))
def label_losses(spark, sf_dir):
    l = E.label_losses(predictions(spark, sf_dir), "label", "probs", ["model"])
    return l.select("model", "label", *[_r(F.col(c), 9).alias(c) for c in ("nll", "mean_p_true", "mean_log_p_true")])


@query("e12_true_class_probability", "WITH " + PRED_SQL + """
SELECT model, label, count(*) AS n,
       list_transform(quantile_cont(probs[label + 1], [0.25, 0.5, 0.75]), lambda x: round(x, 9) + 0.0) AS q
FROM preds GROUP BY 1, 2""", covers=("E12",))
def true_class_prob(spark, sf_dir):
    t = E.true_class_probability(predictions(spark, sf_dir), "label", "probs", ["model"])
    return t.withColumn("q", F.transform("q", lambda x: F.round(x, 9) + F.lit(0.0)))


@query("e13_top_n_mass", "WITH " + PRED_SQL + """,
s AS (SELECT model, list_reverse(list_sort(probs)) AS sp FROM preds),
c AS (SELECT model, unnest(range(1, 11)) AS top_n,
             unnest(list_transform(range(1, 11), lambda k: list_sum(sp[1:k]))) AS mass FROM s)
SELECT model, CAST(top_n AS INTEGER) AS top_n,
       list_transform(quantile_cont(mass, [0.25, 0.5, 0.75]), lambda x: round(x, 6) + 0.0) AS q
FROM c GROUP BY 1, 2""", covers=("E13", "W19"))
def top_n(spark, sf_dir):
    t = E.top_n_mass(predictions(spark, sf_dir), "probs", N_CLASSES, ["model"])
    return t.select("model", F.col("top_n").cast("int").alias("top_n"),
                    F.transform("q", lambda x: F.round(x, 6) + F.lit(0.0)).alias("q"))


# U4 + U6 --------------------------------------------------------------------------------
@query("u04_metric_registry", unsign(f"""
WITH d AS {REG_SRC}, m AS (SELECT CAST(floor(y) AS INTEGER) % 2 AS part, avg(abs(yhat - y)) AS mean_absolute_error,
  sqrt(avg((yhat - y) * (yhat - y))) AS root_mean_squared_error, avg(CAST(yhat > y AS DOUBLE)) AS overshoot FROM d GROUP BY 1)
SELECT part, metric, round(value, 6) AS value FROM (UNPIVOT m ON mean_absolute_error, root_mean_squared_error, overshoot
  INTO NAME metric VALUE value)""", ["value"]), covers=("U4", "U6"))
def metric_registry(spark, sf_dir):
    """Registered metrics beside one that the caller brings, per group, in one aggregate."""
    d = load(spark, sf_dir, "orders").select((F.col("o_totalprice") / 1000.0).alias("y"),
                                             ((F.col("o_custkey") % 500) + F.col("o_totalprice") / 1500.0).alias("yhat"))
    d = d.withColumn("part", (F.floor("y").cast("int") % 2).cast("int"))
    out = ME.evaluate(d, "y", "yhat", ["mean_absolute_error", "root_mean_squared_error"], ["part"],
                      {"overshoot": lambda y, p: F.avg((p > y).cast("double"))})
    return out.select("part", "metric", _r(F.col("value")).alias("value"))


# E14 ------------------------------------------------------------------------------------
CLASS_EV = [-0.02, -0.01, 0.0, 0.01, 0.02, 0.03, 0.04, 0.05, 0.06, 0.07]
REPORT = ("accuracy", "f1_macro", "mean_p_true", "confidence", "top_2_mass", "ev_predicted", "ev_true")


def _report_sql() -> str:
    return "WITH " + CM_SQL + f""",
s AS (SELECT model, round(sum(recall * support) / sum(support), 9) AS accuracy, round(avg(f1), 9) AS f1_macro FROM f GROUP BY 1),
r AS (SELECT model, count(*) AS n, round(avg(probs[label + 1]), 9) AS mean_p_true, round(avg(list_max(probs)), 9) AS confidence,
  round(avg(list_sum(list_reverse(list_sort(probs))[1:2])), 9) AS top_2_mass,
  round(avg(CAST({CLASS_EV!r}[pred + 1] AS DOUBLE)), 9) AS ev_predicted,
  round(avg(CAST({CLASS_EV!r}[label + 1] AS DOUBLE)), 9) AS ev_true FROM preds GROUP BY 1)
SELECT model, n, accuracy, f1_macro, mean_p_true, confidence, top_2_mass, ev_predicted, ev_true FROM s JOIN r USING (model)"""


@query("e14_model_report", unsign(_report_sql(), REPORT), covers=("E14", "E12", "E13"))
def model_report(spark, sf_dir):
    r = E.model_report(predictions(spark, sf_dir), "label", "pred", "probs", CLASS_EV)
    return r.select("model", "n", *[_r(F.col(c), 9).alias(c) for c in REPORT])
