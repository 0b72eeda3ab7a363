"""Evaluation operators (E1-E14) over a predictions table.

Predictions are one long table: (model, key, label, pred, probs[]) with classes
0..K-1, so many models are evaluated in one grouped job (E14).  Ranks for AUC
come from counts per distinct score and running sums on the series machinery,
never from an un-partitioned window.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kiln.functions import arrays as A
from kiln.operators import quantiles as Q
from kiln.operators import series as S
from kiln.session import written


def _grp(model: str | None) -> list[str]:
    return [model] if model else []


# E1 / E3 --------------------------------------------------------------------
def accuracy(df: DataFrame, label: str = "label", pred: str = "pred", model: str | None = None) -> DataFrame:
    return df.groupBy(*_grp(model)).agg(F.avg((F.col(label) == F.col(pred)).cast("double")).alias("accuracy"))


def confusion(df: DataFrame, label: str = "label", pred: str = "pred", model: str | None = None) -> DataFrame:
    """Long confusion matrix over the union of true and predicted classes, zeros
    included.  The predictions are read once: their counts, a few rows, are written
    and read by what follows."""
    g = _grp(model)
    counts = written(df.groupBy(*g, F.col(label).alias("true_label"), F.col(pred).alias("pred_label")).agg(
        F.count(F.lit(1)).alias("count")), "confusion")
    classes = (counts.select(*g, F.col("true_label").alias("c"))
               .union(counts.select(*g, F.col("pred_label").alias("c"))).distinct())
    grid = classes.withColumnRenamed("c", "true_label").join(classes.withColumnRenamed("c", "pred_label"), g or None,
                                                             "inner" if g else "cross")
    return grid.join(counts, [*g, "true_label", "pred_label"], "left").na.fill(0, ["count"])


# E2 / E4 --------------------------------------------------------------------
def per_class(df: DataFrame, label: str = "label", pred: str = "pred", model: str | None = None) -> DataFrame:
    """Precision, recall, F1 (zero division -> 0) and support per class, over one
    count per (true, predicted) pair that counts once for either class."""
    g = _grp(model)
    counts = df.groupBy(*g, F.col(label).alias("t"), F.col(pred).alias("p")).agg(F.count(F.lit(1)).alias("n"))
    none = F.lit(0).cast("long")
    sides = F.array(F.struct(F.col("t").alias("class"), F.col("n").alias("support"), none.alias("predicted"),
                             F.when(F.col("t") == F.col("p"), F.col("n")).otherwise(none).alias("tp")),
                    F.struct(F.col("p").alias("class"), none.alias("support"), F.col("n").alias("predicted"), none.alias("tp")))
    j = counts.select(*g, F.explode(sides).alias("s")).select(*g, "s.*").groupBy(*g, "class").agg(
        *[F.sum(c).alias(c) for c in ("support", "predicted", "tp")])
    j = j.withColumns({"precision": F.coalesce(F.try_divide("tp", "predicted"), F.lit(0.0)),
                       "recall": F.coalesce(F.try_divide("tp", "support"), F.lit(0.0))})
    f1 = F.coalesce(F.try_divide(2 * F.col("precision") * F.col("recall"), F.col("precision") + F.col("recall")), F.lit(0.0))
    return j.withColumn("f1", f1).select(*g, "class", "precision", "recall", "f1", "support", "tp")


def summary(pc: DataFrame, model: str | None = None) -> DataFrame:
    """Weighted precision / recall / F1 and macro F1 from the per-class table."""
    g = _grp(model)
    n = F.sum("support")
    return pc.groupBy(*g).agg(
        (F.sum("tp") / n).alias("accuracy"), (F.sum(F.col("precision") * F.col("support")) / n).alias("precision_weighted"),
        (F.sum(F.col("recall") * F.col("support")) / n).alias("recall_weighted"),
        (F.sum(F.col("f1") * F.col("support")) / n).alias("f1_weighted"),
        F.avg("f1").alias("f1_macro"))


# E5 / E6 --------------------------------------------------------------------
def binary_auc(df: DataFrame, score: str, positive: Column, group: Sequence[str] = ()) -> DataFrame:
    """ROC AUC by the rank formula with average ranks for ties; one row per group.

    Counts per (group, distinct score) are prefix-summed with the block scan."""
    g = list(group)
    d = df.select(*g, F.col(score).cast("double").alias("_s"), positive.cast("int").alias("_y"))
    per = d.groupBy(*g, "_s").agg(F.count(F.lit(1)).alias("t"), F.sum("_y").alias("tp"))
    keys = g or ["_k"]
    if not g:
        per = per.withColumn("_k", F.lit(0))
    seq = S.sequence(per, keys, ["_s"])
    cum = S.scan_sum(seq, keys, {"_c": F.col("t").cast("double")})
    cum = cum.withColumn("_rank", F.col("_c") - F.col("t") + (F.col("t") + 1) / 2.0)
    a = cum.groupBy(*keys).agg(F.sum(F.col("tp") * F.col("_rank")).alias("rp"),
                               F.sum("tp").cast("double").alias("np"),
                               (F.sum("t") - F.sum("tp")).cast("double").alias("nn"))
    auc = (F.col("rp") - F.col("np") * (F.col("np") + 1) / 2) / (F.col("np") * F.col("nn"))
    out = a.select(*keys, F.when((F.col("np") > 0) & (F.col("nn") > 0), auc).alias("auc"))
    return out.drop("_k") if not g else out


def ovr_auc(df: DataFrame, label: str, probs: str, n_classes: int, model: str | None = None) -> DataFrame:
    """One-vs-rest AUC per class; macro and support-weighted averages."""
    g = _grp(model)
    long = df.select(*g, F.col(label).alias("_l"),
                     F.posexplode(F.col(probs)).alias("class", "_p"))
    long = long.filter(F.col("class") < n_classes)
    per = binary_auc(long, "_p", F.col("_l") == F.col("class"), [*g, "class"])
    sup = df.groupBy(*g, F.col(label).alias("class")).agg(F.count(F.lit(1)).alias("support"))
    j = per.join(sup, [*g, "class"], "inner")
    return j.groupBy(*g).agg(F.avg("auc").alias("auc_macro"),
                             (F.sum(F.col("auc") * F.col("support")) / F.sum("support")).alias("auc_weighted"))


def roc_points(df: DataFrame, score: str, positive: Column) -> DataFrame:
    """(threshold, fpr, tpr) for every distinct score, descending, plus the
    trapezoid area; threshold table is one row per distinct score."""
    d = df.select(F.col(score).cast("double").alias("_s"), positive.cast("int").alias("_y"))
    per = d.groupBy((-F.col("_s")).alias("_ns")).agg(F.sum("_y").alias("tp"),
                                                      (F.count(F.lit(1)) - F.sum("_y")).alias("fp"))
    per = per.withColumn("_k", F.lit(0))
    seq = S.sequence(per, ["_k"], ["_ns"])
    cum = S.scan_sum(seq, ["_k"], {"ctp": F.col("tp").cast("double"), "cfp": F.col("fp").cast("double")})
    tot = d.agg(F.sum("_y").cast("double").alias("P"), (F.count(F.lit(1)) - F.sum("_y")).cast("double").alias("N"))
    return cum.crossJoin(F.broadcast(tot)).select(
        (-F.col("_ns")).alias("threshold"), (F.col("cfp") / F.col("N")).alias("fpr"),
        (F.col("ctp") / F.col("P")).alias("tpr"), S.SEQ)


def trapezoid_auc(points: DataFrame) -> DataFrame:
    """Area under (fpr, tpr) from (0, 0) through the points (ordered by threshold)."""
    p = S.rolling(points.withColumn("_k", F.lit(0)).withColumn(S.CNT, F.lit(0)), ["_k"],
                  lambda w: {"_pf": F.lag("fpr", 1, 0.0).over(w), "_pt": F.lag("tpr", 1, 0.0).over(w)}, before=1)
    return p.agg(F.sum((F.col("fpr") - F.col("_pf")) * (F.col("tpr") + F.col("_pt")) / 2).alias("auc"))


# E7 / E8 --------------------------------------------------------------------
def regression_metrics(df: DataFrame, y: str, yhat: str, group: Sequence[str] = ()) -> DataFrame:
    e = F.col(yhat) - F.col(y)
    g = df.groupBy(*group).agg(F.avg(F.abs(e)).alias("mae"), F.avg(e * e).alias("mse"),
                               F.sum(e * e).alias("_sse"), F.var_pop(y).alias("_var"), F.count(F.lit(1)).alias("_n"))
    return g.select(*group, "mae", "mse", F.sqrt("mse").alias("rmse"),
                    (1 - F.try_divide("_sse", F.col("_var") * F.col("_n"))).alias("r2"))


# E9 / E10 / E11 --------------------------------------------------------------
def distribution_losses(df: DataFrame, p_true: str, p_pred: str, centers: Sequence[float],
                        normalize: bool = True, group: Sequence[str] = ()) -> DataFrame:
    """Row means of KL, JS, cross-entropy, L1, L2 and earth mover's distance.

    ``normalize=True``: rows are normalised, then clipped to [1e-9, 1-1e-9] (KL,
    JS, cross-entropy); ``False``: only clipped at 1e-9, JS on the raw rows.  KL and
    JS normalise their inputs again; JS is the squared Jensen-Shannon distance; L1
    and L2 are sums over the bins of the raw rows; earth mover's distance sums
    |cdf difference| x centre gap.  Every intermediate array is its own projection
    so no lambda subtree is evaluated twice."""
    eps = 1e-9
    t, q = F.col(p_true), F.col(p_pred)
    d = df.select(*group, t.alias("_t"), q.alias("_q"))
    if normalize:
        d = d.withColumns({"_tc": A._clip_arr(A._norm(F.col("_t")), eps, 1 - eps),
                           "_qc": A._clip_arr(A._norm(F.col("_q")), eps, 1 - eps)})
        ja, jb = "_tc", "_qc"
    else:
        d = d.withColumns({"_tc": A._clip_arr(F.col("_t"), eps, 1.0), "_qc": A._clip_arr(F.col("_q"), eps, 1.0)})
        ja, jb = "_t", "_q"
    d = d.withColumns({"_tn": A._norm(F.col("_tc")), "_qn": A._norm(F.col("_qc")),
                       "_a": A._norm(F.col(ja)), "_b": A._norm(F.col(jb)),
                       "_tt": A._norm(F.col("_t")), "_qq": A._norm(F.col("_q"))})
    d = d.withColumns({"_m": F.zip_with("_a", "_b", lambda x, y: 0.5 * (x + y)),
                       "_diff": F.zip_with("_tt", "_qq", lambda x, y: x - y)})
    d = d.withColumn("_cum", F.aggregate("_diff", F.array().cast("array<double>"),
                                         lambda acc, x: F.concat(acc, F.array(
                                             F.coalesce(F.try_element_at(acc, F.lit(-1)), F.lit(0.0)) + x))))
    gaps = [b_ - a_ for a_, b_ in zip(centers[:-1], centers[1:])]
    m = {
        "kl": A._zsum(F.col("_tn"), F.col("_qn"), lambda x, y: x * F.log(x / y)),
        "js": 0.5 * A._zsum(F.col("_a"), F.col("_m"), A._rel_entr) + 0.5 * A._zsum(F.col("_b"), F.col("_m"), A._rel_entr),
        "cross_entropy": -A._zsum(F.col("_t"), F.col("_qc"), lambda x, y: x * F.log(y)),
        "l1": A._zsum(F.col("_t"), F.col("_q"), lambda x, y: F.abs(x - y)),
        "l2": A._zsum(F.col("_t"), F.col("_q"), lambda x, y: (x - y) * (x - y)),
        "emd": F.aggregate(F.zip_with(F.slice("_cum", 1, len(gaps)), A.lit_array(gaps), lambda x, g: F.abs(x) * g),
                           F.lit(0.0), lambda acc, x: acc + x),
    }
    return d.groupBy(*group).agg(*[F.avg(v).alias(k) for k, v in m.items()])


def directional_loss(probs: Column, label: Column, centers: Sequence[float], right: float = 1.2) -> Column:
    """E10 per row: (1 - sqrt(p[true])) times ``right`` when the predicted mean
    lies right of the true bin centre."""
    c = A.lit_array(centers)
    p_true = F.element_at(probs, (label + 1).cast("int"))
    ev = A.dot(probs, centers)
    mult = F.when(ev > F.element_at(c, (label + 1).cast("int")), F.lit(right)).otherwise(F.lit(1.0))
    return (1 - F.sqrt(p_true)) * mult


def label_losses(df: DataFrame, label: str, probs: str, group: Sequence[str] = ()) -> DataFrame:
    """Mean negative log probability of the true class, and mean
    probability / log probability of the true class, per true label."""
    p = F.element_at(F.col(probs), (F.col(label) + 1).cast("int"))
    return df.groupBy(*group, label).agg(F.avg(-F.log(p)).alias("nll"), F.avg(p).alias("mean_p_true"),
                                         F.avg(F.log(p)).alias("mean_log_p_true"))


# E12 / E13 ------------------------------------------------------------------
def true_class_probability(df: DataFrame, label: str, probs: str, group: Sequence[str] = ()) -> DataFrame:
    p = F.element_at(F.col(probs), (F.col(label) + 1).cast("int"))
    d = df.select(*group, label, p.alias("_p"))
    n = d.groupBy(*group, label).agg(F.count(F.lit(1)).alias("n"))
    q = Q.grouped_quantiles(d, [*group, label], "_p", [0.25, 0.5, 0.75])
    return n.join(q, [*group, label])


def top_n_mass(df: DataFrame, probs: str, n_classes: int, group: Sequence[str] = ()) -> DataFrame:
    """Distribution (quartiles) of the cumulative probability of the top-N classes."""
    sorted_desc = F.reverse(F.array_sort(F.col(probs)))
    cum = F.aggregate(sorted_desc, F.array().cast("array<double>"),
                      lambda acc, x: F.concat(acc, F.array(F.coalesce(F.try_element_at(acc, F.lit(-1)), F.lit(0.0)) + x)))
    d = df.select(*group, F.posexplode(cum).alias("top_n", "mass")).withColumn("top_n", F.col("top_n") + 1)
    return Q.grouped_quantiles(d, [*group, "top_n"], "mass", [0.25, 0.5, 0.75])


# E14 ------------------------------------------------------------------------
def model_report(df: DataFrame, label: str, pred: str, probs: str, class_ev: Sequence[float], model: str = "model",
                 top: Sequence[int] = (1, 2, 3)) -> DataFrame:
    """One row per model: rows, accuracy, weighted and macro scores, mean
    probability of the true class, confidence, mass of the top-N classes and the
    expected value of the predicted and of the true classes."""
    ev = A.lit_array(class_ev)
    ranked = F.reverse(F.array_sort(F.col(probs)))
    mass = [F.avg(F.aggregate(F.slice(ranked, 1, n), F.lit(0.0), lambda a, x: a + x)).alias(f"top_{n}_mass") for n in top]
    parts = df.groupBy(model).agg(
        F.count(F.lit(1)).alias("n"), F.avg(F.element_at(F.col(probs), (F.col(label) + 1).cast("int"))).alias("mean_p_true"),
        F.avg(F.array_max(probs)).alias("confidence"), *mass,
        F.avg(F.element_at(ev, (F.col(pred) + 1).cast("int"))).alias("ev_predicted"),
        F.avg(F.element_at(ev, (F.col(label) + 1).cast("int"))).alias("ev_true"))
    scores = summary(per_class(df, label, pred, model), model)
    return scores.join(parts, model)
