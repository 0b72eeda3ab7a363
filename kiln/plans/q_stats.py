"""Queries for statistical tests (T1-T9) and word statistics."""

from __future__ import annotations

from pyspark.sql import functions as F

from kiln.functions import scalar as X
from kiln.operators import stats as ST
from kiln.operators import text as TX
from kiln.plans.registry import query
from kiln.plans.sqlkit import robust_sql, unsign
from kiln.tables import load


def _r(c, d=6):
    return F.round(c, d) + F.lit(0.0)


# T1 ---------------------------------------------------------------------------
def _chi_sql(src: str, row: str, col: str, digits: int = 6) -> str:
    return f"""
WITH d AS (SELECT CAST({row} AS VARCHAR) AS r, CAST({col} AS VARCHAR) AS c FROM {src}),
o AS (SELECT r, c, count(*) AS o FROM d GROUP BY 1, 2),
g AS (SELECT rr.r, cc.c, CAST(coalesce(o.o, 0) AS DOUBLE) AS o
      FROM (SELECT DISTINCT r FROM o) rr CROSS JOIN (SELECT DISTINCT c FROM o) cc LEFT JOIN o USING (r, c)),
e AS (SELECT *, sum(o) OVER (PARTITION BY r) * sum(o) OVER (PARTITION BY c) / sum(o) OVER () AS e,
             (count(DISTINCT r) OVER () - 1) * (count(DISTINCT c) OVER () - 1) AS dof FROM g)
SELECT round(sum(CASE WHEN dof = 1 THEN power(abs(o - e) - least(0.5, abs(o - e)), 2)
                      ELSE power(o - e, 2) END / e), {digits}) + 0.0 AS statistic,
       CAST(any_value(dof) AS BIGINT) AS dof
FROM e"""


@query("t01_chi_square", _chi_sql("orders", "o_orderpriority", "o_orderstatus"), covers=("T1", "A6"))
def chi_square(spark, sf_dir):
    s = ST.chi_square(load(spark, sf_dir, "orders"), "o_orderpriority", "o_orderstatus")
    return s.select(_r(F.col("statistic")).alias("statistic"), "dof")


@query("t01_chi_square_yates", _chi_sql("labels", "quality", "toxic"), covers=("T1",))
def chi_square_yates(spark, sf_dir):
    s = ST.chi_square(load(spark, sf_dir, "labels"), "quality", "toxic")
    return s.select(_r(F.col("statistic")).alias("statistic"), "dof")


# erfc by its Taylor series: exact to some 1e-12 for the moderate arguments here
ERFC_SQL = """(1 - 2 / sqrt(pi()) * (SELECT sum(power(-1.0, i) * power({z}, 2 * i + 1) / (exp(lgamma(i + 1)) * (2 * i + 1)))
                           FROM range(120) AS r(i)))"""


@query("t01_chi_square_pvalue", "WITH s AS (" + _chi_sql("labels", "quality", "toxic", 15) + """)
SELECT round(statistic, 6) AS statistic, dof, round(""" + ERFC_SQL.format(z="sqrt(statistic / 2)") + """, 6) + 0.0 AS p_value FROM s""", covers=("T1",))
def chi_square_p(spark, sf_dir):
    """Statistic, dof and the chi-square tail probability."""
    s = ST.with_chi2_p(ST.chi_square(load(spark, sf_dir, "labels"), "quality", "toxic"))
    return s.select(_r(F.col("statistic")).alias("statistic"), "dof", _r(F.col("p_value")).alias("p_value"))


@query("t01_chi_square_many", _chi_sql("orders", "o_custkey", "o_orderstatus"), covers=("T1",))
def chi_square_many(spark, sf_dir):
    """Thousands of categories: empty cells are never built."""
    s = ST.chi_square(load(spark, sf_dir, "orders"), "o_custkey", "o_orderstatus")
    return s.select(_r(F.col("statistic")).alias("statistic"), "dof")


# T2 ---------------------------------------------------------------------------
@query("t02_wilson_intervals", unsign("""
WITH g AS (SELECT lang, CAST(sum(CASE WHEN quality = 1 THEN 1 ELSE 0 END) AS DOUBLE) AS k,
                  CAST(count(*) AS DOUBLE) AS n
           FROM documents JOIN labels USING (doc_id) GROUP BY lang),
z AS (SELECT *, k / n AS p, 1.959963984540054 AS z FROM g)
SELECT lang, k, n, round(p, 9) AS proportion,
  round((p + z * z / (2 * n)) / (1 + z * z / n) - z * sqrt(p * (1 - p) / n + z * z / (4 * n * n)) / (1 + z * z / n), 9) AS ci_low,
  round((p + z * z / (2 * n)) / (1 + z * z / n) + z * sqrt(p * (1 - p) / n + z * z / (4 * n * n)) / (1 + z * z / n), 9) AS ci_high
FROM z""", ["proportion", "ci_low", "ci_high"]), covers=("T2",))
def wilson(spark, sf_dir):
    d = load(spark, sf_dir, "documents").join(load(spark, sf_dir, "labels"), "doc_id")
    w = ST.proportion_intervals(d, "lang", "quality")
    return w.select("lang", "k", "n", *[_r(F.col(c), 9).alias(c) for c in ("proportion", "ci_low", "ci_high")])


# T3 ---------------------------------------------------------------------------
LEVENE_SQL = """
WITH d AS (SELECT event_type AS g, value FROM events WHERE event_type IN ('click', 'view')),
m AS (SELECT g, quantile_cont(value, 0.5) AS med FROM d GROUP BY g),
z AS (SELECT d.g, abs(value - med) AS z FROM d JOIN m USING (g)),
per AS (SELECT g, count(*) AS ni, avg(z) AS zi, sum(z) AS sz FROM z GROUP BY g),
tot AS (SELECT sum(ni) AS nn, count(*) AS k, sum(sz) / sum(ni) AS zbar FROM per),
w AS (SELECT sum(power(z.z - per.zi, 2)) AS sw FROM z JOIN per USING (g)),
b AS (SELECT sum(ni * power(zi - zbar, 2)) AS sb, any_value(nn) AS nn, any_value(k) AS k FROM per, tot)
SELECT round((nn - k) / (k - 1) * sb / sw, 6) AS W, CAST(k - 1 AS DOUBLE) AS df1, CAST(nn - k AS DOUBLE) AS df2 FROM b, w"""


@query("t03_levene", unsign(LEVENE_SQL, ["W"]), covers=("T3",))
def levene(spark, sf_dir):
    e = load(spark, sf_dir, "events").filter(F.col("event_type").isin("click", "view"))
    lv = ST.levene(e, "value", "event_type")
    return lv.select(_r(F.col("W")).alias("W"), "df1", "df2")


# T4 ---------------------------------------------------------------------------
TTEST_SQL = """
WITH s AS (SELECT event_type AS g, count(*) AS n, avg(value) AS m, var_samp(value) AS v
           FROM events WHERE event_type IN ('click', 'view') GROUP BY 1),
a AS (SELECT n AS n0, m AS m0, v AS v0 FROM s WHERE g = 'click'),
b AS (SELECT n AS n1, m AS m1, v AS v1 FROM s WHERE g = 'view')
SELECT round((m0 - m1) / sqrt(((n0 - 1) * v0 + (n1 - 1) * v1) / (n0 + n1 - 2) * (1.0 / n0 + 1.0 / n1)), 6) AS t_pooled,
       CAST(n0 + n1 - 2 AS DOUBLE) AS df_pooled,
       round((m0 - m1) / sqrt(v0 / n0 + v1 / n1), 6) AS t_welch,
       round(power(v0 / n0 + v1 / n1, 2) / (power(v0 / n0, 2) / (n0 - 1) + power(v1 / n1, 2) / (n1 - 1)), 6) AS df_welch
FROM a, b"""


@query("t04_t_tests", unsign(TTEST_SQL, ["t_pooled", "t_welch", "df_welch"]), covers=("T4",))
def t_tests(spark, sf_dir):
    e = load(spark, sf_dir, "events")
    st = ST.group_stats(e, "value", "event_type")
    p = ST.t_test(st, "event_type", "click", "view", True).select(
        _r(F.col("t")).alias("t_pooled"), F.col("df").alias("df_pooled"))
    w = ST.t_test(st, "event_type", "click", "view", False).select(
        _r(F.col("t")).alias("t_welch"), _r(F.col("df")).alias("df_welch"))
    return p.crossJoin(w)


# T5 ---------------------------------------------------------------------------
MWU_CTES = """
WITH d AS (SELECT event_type AS g, value FROM events WHERE event_type IN ('click', 'view')),
v AS (SELECT value, count(*) AS t, sum(CASE WHEN g = 'click' THEN 1 ELSE 0 END) AS ta FROM d GROUP BY value),
c AS (SELECT *, sum(t) OVER (ORDER BY value ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) - t + (t + 1) / 2.0 AS r FROM v),
a AS (SELECT sum(ta * r) AS ra, CAST(sum(ta) AS DOUBLE) AS na, CAST(sum(t) - sum(ta) AS DOUBLE) AS nb,
             CAST(sum(t) AS DOUBLE) AS nn, sum(power(CAST(t AS DOUBLE), 3) - t) AS ties FROM c),
u AS (SELECT *, ra - na * (na + 1) / 2 AS u1 FROM a),
mw AS (SELECT u1, (greatest(u1, na * nb - u1) - na * nb / 2 - 0.5) / sqrt(na * nb / 12 * ((nn + 1) - ties / (nn * (nn - 1)))) AS z0
       FROM u)"""
MWU_SQL = MWU_CTES + """
SELECT round(u1, 6) AS U, round(z0, 6) AS z FROM mw"""


@query("t05_mann_whitney", unsign(MWU_SQL, ["U", "z"]), covers=("T5",))
def mann_whitney(spark, sf_dir):
    e = load(spark, sf_dir, "events")
    m = ST.mann_whitney(e, "value", "event_type", "click", "view")
    return m.select(_r(F.col("U")).alias("U"), _r(F.col("z")).alias("z"))


# T6 ---------------------------------------------------------------------------
@query("t06_test_selection", MWU_CTES + """
SELECT 'mann_whitney' AS test, round(u1, 6) AS statistic,
       round(least(1.0, """ + ERFC_SQL.format(z="(z0 / sqrt(2.0))") + """), 6) + 0.0 AS p_value FROM mw""",
       covers=("T6", "T3", "T4", "T5"))
def test_selection(spark, sf_dir):
    """Normality gate, then t test or Mann-Whitney with p-values (these values are far from normal)."""
    e = load(spark, sf_dir, "events")
    t = ST.choose_test(e, "value", "event_type", "click", "view")
    return t.select("test", _r(F.col("statistic")).alias("statistic"), _r(F.col("p_value"), 6).alias("p_value"))


# T7 + F14 --------------------------------------------------------------------------
TOKENS_SQL = r"regexp_extract_all(lower(coalesce(text, 'nan')), '[\p{L}\p{N}_]+')"

FISHER_SQL = r"""
WITH d AS (SELECT list_distinct(""" + TOKENS_SQL + r""") AS toks, quality AS y
           FROM documents JOIN labels USING (doc_id)),
tot AS (SELECT sum(CASE WHEN y = 0 THEN 1 ELSE 0 END) AS t0, sum(CASE WHEN y = 1 THEN 1 ELSE 0 END) AS t1 FROM d),
per AS (SELECT token, sum(CASE WHEN y = 0 THEN 1 ELSE 0 END) AS c0, sum(CASE WHEN y = 1 THEN 1 ELSE 0 END) AS c1
        FROM (SELECT unnest(toks) AS token, y FROM d) GROUP BY token HAVING count(*) >= 5),
tab AS (SELECT token, c0, c1, CAST(c1 AS BIGINT) AS a, CAST(c1 + c0 AS BIGINT) AS r1, CAST(t1 AS BIGINT) AS cc1,
                CAST(t0 + t1 AS BIGINT) AS n FROM per, tot),
grid AS (SELECT token, a, r1, cc1, n, unnest(range(greatest(0, r1 - (n - cc1)), least(r1, cc1) + 1)) AS k FROM tab),
lp AS (SELECT token, k, a,
         lgamma(cc1 + 1) - lgamma(k + 1) - lgamma(cc1 - k + 1)
       + lgamma(n - cc1 + 1) - lgamma(r1 - k + 1) - lgamma(n - cc1 - r1 + k + 1)
       - (lgamma(n + 1) - lgamma(r1 + 1) - lgamma(n - r1 + 1)) AS l FROM grid),
obs AS (SELECT token, l AS lo FROM lp WHERE k = a),
p AS (SELECT lp.token, round(least(1.0, sum(CASE WHEN l <= lo + ln(1 + 1e-7) THEN exp(l) ELSE 0 END)), 12) AS p_value
      FROM lp JOIN obs USING (token) GROUP BY lp.token)"""

STATS_SQL = FISHER_SQL + """
SELECT token, CAST(c0 AS BIGINT) AS count_0, CAST(c1 AS BIGINT) AS count_1, round(c1 / (c0 + c1), 9) AS class1_rate,
       round(p_value, 6) AS p_value
FROM per JOIN p USING (token)"""


def _word_stats(spark, sf_dir):
    d = load(spark, sf_dir, "documents").join(load(spark, sf_dir, "labels"), "doc_id")
    return d, TX.word_stats(d, "text", "quality", 5)


@query("f14_word_stats", unsign(STATS_SQL, ["class1_rate", "p_value"]), covers=("F14", "T7"))
def word_stats(spark, sf_dir):
    _, st = _word_stats(spark, sf_dir)
    return st.select("token", "count_0", "count_1", _r(F.col("class1_rate"), 9).alias("class1_rate"),
                     _r(F.col("p_value")).alias("p_value"))


FEATURES_SQL = FISHER_SQL + r""",
st AS (SELECT token, c1 / (c0 + c1) AS rate, p_value FROM per JOIN p USING (token)),
docs AS (SELECT doc_id, """ + TOKENS_SQL + r""" AS toks FROM documents),
tp AS (SELECT doc_id, unnest(toks) AS token, unnest(range(len(toks))) AS pos FROM docs),
j AS (SELECT tp.doc_id, pos, rate, p_value FROM tp JOIN st USING (token) WHERE p_value < 1.0),
bp AS (SELECT doc_id, arg_min(p_value, (p_value, pos)) AS pp, arg_min(rate, (p_value, pos)) AS pr FROM j WHERE rate > 0.5 GROUP BY 1),
bn AS (SELECT doc_id, arg_min(p_value, (p_value, pos)) AS np, arg_min(rate, (p_value, pos)) AS nr FROM j WHERE rate < 0.5 GROUP BY 1)
SELECT doc_id, round(coalesce(pp, 1.0), 6) AS name_corr_pos_p_value, round(coalesce(pr, 0.5), 9) AS name_corr_pos_prob,
       round(coalesce(np, 1.0), 6) AS name_corr_neg_p_value, round(coalesce(nr, 0.5), 9) AS name_corr_neg_prob
FROM documents LEFT JOIN bp USING (doc_id) LEFT JOIN bn USING (doc_id)"""

FEATURE_COLS = ["name_corr_pos_p_value", "name_corr_pos_prob", "name_corr_neg_p_value", "name_corr_neg_prob"]


@query("f15_word_features", unsign(FEATURES_SQL, FEATURE_COLS), covers=("F15", "J11"))
def word_features(spark, sf_dir):
    _, st = _word_stats(spark, sf_dir)
    docs = load(spark, sf_dir, "documents").select("doc_id", "text")
    f = TX.word_features(docs, st, "text", "doc_id")
    return f.select("doc_id", *[_r(F.col(c), 6 if "p_value" in c else 9).alias(c) for c in FEATURE_COLS])


# T8 ---------------------------------------------------------------------------
SHIFT_SQL = """
WITH e AS (SELECT user_id % 9 AS cluster, CASE WHEN event_id % 13 = 0 THEN NULL ELSE (value - 250) / 5000 END AS ev,
                  CASE WHEN event_id % 5 = 0 THEN 'val' ELSE 'train' END AS split FROM events),
t AS (SELECT cluster, count(ev) AS n_train, avg(ev) AS m FROM e WHERE split = 'train' GROUP BY 1),
v AS (SELECT cluster, count(ev) AS n_val, avg(ev) AS m FROM e WHERE split = 'val' GROUP BY 1),
j AS (SELECT t.cluster, n_train, n_val, t.m AS mt, v.m AS mv FROM t JOIN v USING (cluster)),
b AS (SELECT *, CASE WHEN mt IS NULL THEN 'Unknown (NaN EV)' WHEN mt < -0.03 THEN 'Deep Loss' WHEN mt < -0.005 THEN 'Loss'
                     WHEN mt <= 0.005 THEN 'Neutral' WHEN mt <= 0.03 THEN 'Profit' ELSE 'Deep Profit' END AS category_train,
                CASE WHEN mv IS NULL THEN 'Unknown (NaN EV)' WHEN mv < -0.03 THEN 'Deep Loss' WHEN mv < -0.005 THEN 'Loss'
                     WHEN mv <= 0.005 THEN 'Neutral' WHEN mv <= 0.03 THEN 'Profit' ELSE 'Deep Profit' END AS category_val FROM j)
SELECT cluster, n_train, n_val, round(mt, 9) AS mean_ev_train, round(mv, 9) AS mean_ev_val, category_train, category_val,
       CASE WHEN category_train = 'Unknown (NaN EV)' OR category_val = 'Unknown (NaN EV)' THEN 'N/A (due to NaN mean EV)'
            WHEN category_train <> category_val THEN 'Yes' ELSE 'No' END AS shifted
FROM b"""


@query("t08_segment_shift", unsign(SHIFT_SQL, ["mean_ev_train", "mean_ev_val"]), covers=("T8", "J8", "P19"))
def segment_shift(spark, sf_dir):
    e = load(spark, sf_dir, "events").select(
        (F.col("user_id") % 9).alias("cluster"),
        F.when(F.col("event_id") % 13 == 0, F.lit(None)).otherwise((F.col("value") - 250) / 5000).alias("ev"),
        F.when(F.col("event_id") % 5 == 0, "val").otherwise("train").alias("split"))
    r = ST.segment_shift(e.filter("split = 'train'"), e.filter("split = 'val'"), "cluster", "ev", X.ev_band)
    return r.withColumn("mean_ev_train", _r(F.col("mean_ev_train"), 9)) \
            .withColumn("mean_ev_val", _r(F.col("mean_ev_val"), 9))


# T9 ---------------------------------------------------------------------------
@query("t09_robust_outliers", covers=("T9",))
def outliers(spark, sf_dir):
    """All 64 coordinates; the rows above the exact 99 % quantile are flagged."""
    r = ST.robust_outliers(load(spark, sf_dir, "embeddings").select("vec_id", "embedding"), "embedding", contamination=0.01)
    return r.select("vec_id", _r(F.col("mahalanobis")).alias("mahalanobis"), "outlier")


@query("t09_line_outliers", "WITH " + robust_sql("lineitem", ["l_quantity", "l_extendedprice", "l_discount"]) + """
SELECT l_orderkey, l_linenumber, round(mahalanobis, 6) + 0.0 AS mahalanobis, outlier FROM robust""", covers=("T9",))
def line_outliers(spark, sf_dir):
    """The same on three columns, whose inverse covariance has a closed form."""
    line = load(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", F.array(
        "l_quantity", "l_extendedprice", "l_discount").alias("v"))
    r = ST.robust_outliers(line, "v", contamination=0.01)
    return r.select("l_orderkey", "l_linenumber", _r(F.col("mahalanobis")).alias("mahalanobis"), "outlier")


# T8, the test inside a segment; critical values of chi-square at 5 % for 1 to 4 degrees ---------
CHI2_95 = [3.841458820694124, 5.991464547107979, 7.814727903251179, 9.487729036781154]  # fixed values


@query("t08_segment_bands", unsign(f"""
WITH e AS (SELECT user_id % 9 AS cluster, event_id % 5 = 0 AS val, (value - 250) / 5000 AS ev FROM events WHERE event_id % 13 <> 0),
b AS (SELECT cluster, CASE WHEN ev < -0.03 THEN 0 WHEN ev < -0.005 THEN 1 WHEN ev <= 0.005 THEN 2 WHEN ev <= 0.03 THEN 3 ELSE 4 END AS band,
             CAST(count(*) FILTER (WHERE NOT val) AS DOUBLE) AS o1, CAST(count(*) FILTER (WHERE val) AS DOUBLE) AS o0 FROM e GROUP BY 1, 2),
n AS (SELECT *, sum(o1) OVER w AS n1, sum(o0) OVER w AS n0, count(*) OVER w - 1 AS dof FROM b WINDOW w AS (PARTITION BY cluster)),
x AS (SELECT *, (o1 + o0) * n1 / (n1 + n0) AS e1, (o1 + o0) * n0 / (n1 + n0) AS e0 FROM n),
d AS (SELECT *, abs(o1 - e1) - CASE WHEN dof = 1 THEN least(0.5, abs(o1 - e1)) ELSE 0 END AS d1,
                abs(o0 - e0) - CASE WHEN dof = 1 THEN least(0.5, abs(o0 - e0)) ELSE 0 END AS d0 FROM x),
s AS (SELECT cluster, n1, n0, dof, sum(d1 * d1 / e1 + d0 * d0 / e0) AS st FROM d GROUP BY ALL)
SELECT cluster, CASE WHEN n1 >= 5 AND n0 >= 5 AND dof >= 1 THEN round(st, 6) END AS statistic,
       CAST(CASE WHEN n1 >= 5 AND n0 >= 5 AND dof >= 1 THEN dof END AS BIGINT) AS dof,
       CASE WHEN n1 >= 5 AND n0 >= 5 AND dof >= 1 THEN st >= {CHI2_95!r}[dof] END AS shifted FROM s""", ["statistic"]), covers=("T8",))
def segment_bands(spark, sf_dir):
    e = load(spark, sf_dir, "events").where(F.col("event_id") % 13 != 0).select(
        (F.col("user_id") % 9).alias("cluster"), ((F.col("value") - 250) / 5000).alias("ev"),
        (F.col("event_id") % 5 == 0).alias("val"))
    r = ST.segment_band_test(e.filter(~F.col("val")), e.filter("val"), "cluster", "ev", X.ev_band)
    return r.select("cluster", _r(F.col("statistic")).alias("statistic"), "dof", "shifted")
