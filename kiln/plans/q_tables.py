"""Queries for joins (J1-J10), aggregations (A1-A22) and splits."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from kiln.functions import arrays as A
from kiln.operators import aggregates as AG
from kiln.operators import joins as J
from kiln.operators import series as S
from kiln.operators import splits as O
from kiln.plans import q_series
from kiln.plans.inputs import DAILY_SQL, daily_prices
from kiln.plans.registry import query
from kiln.plans.sqlkit import unsign
from kiln.session import scratch_path
from kiln.sources import files as SRC
from kiln.tables import load


def _r(c, d=6):
    return (F.round(c, d) + F.lit(0.0))


# J1 ---------------------------------------------------------------------------
@query("j01_lookup_join", """
SELECT o_orderkey, o_custkey, c_name, c_mktsegment
FROM orders LEFT JOIN (SELECT * FROM customer WHERE c_custkey % 3 <> 0) c ON o_custkey = c_custkey""",
       covers=("J1", "J5"))
def lookup_join(spark, sf_dir):
    o = load(spark, sf_dir, "orders").select("o_orderkey", "o_custkey")
    c = load(spark, sf_dir, "customer").filter(F.col("c_custkey") % 3 != 0) \
        .select(F.col("c_custkey").alias("o_custkey"), "c_name", "c_mktsegment")
    return J.lookup_join(o, c, "o_custkey", "left")


# J2 + J3 ------------------------------------------------------------------------
ALIGN_SQL = """
WITH c AS (SELECT date_trunc('day', ts) AS day, count(*) AS v FROM events WHERE event_type = 'click' GROUP BY 1),
     v AS (SELECT date_trunc('day', ts) AS day, count(*) AS v FROM events WHERE event_type = 'view' GROUP BY 1),
     p AS (SELECT date_trunc('day', ts) AS day, count(*) AS v FROM events WHERE event_type = 'purchase' AND user_id % 3 = 0 GROUP BY 1),
     o AS (SELECT date_trunc('day', o_orderdate) + INTERVAL 29 YEAR AS day, count(*) AS orders FROM orders GROUP BY 1),
     aligned AS (
       SELECT coalesce(c.day, v.day, p.day) AS day, CAST(c.v AS DOUBLE) AS click, CAST(v.v AS DOUBLE) AS view,
              CAST(p.v AS DOUBLE) AS purchase
       FROM c FULL JOIN v ON c.day = v.day FULL JOIN p ON coalesce(c.day, v.day) = p.day)
SELECT coalesce(aligned.day, o.day) AS day, click, view, purchase, orders
FROM aligned FULL JOIN o ON aligned.day = o.day"""


@query("j02_outer_align", ALIGN_SQL, covers=("J2", "J3"))
def outer_align(spark, sf_dir):
    e = load(spark, sf_dir, "events").withColumn("day", F.date_trunc("day", "ts"))

    def daily(t, extra=None):
        d = e.filter(F.col("event_type") == t)
        if extra is not None:
            d = d.filter(extra)
        return d.groupBy(F.col("day").alias("ts")).agg(F.count(F.lit(1)).alias("value"))
    wide = J.outer_align({"click": daily("click"), "view": daily("view"),
                          "purchase": daily("purchase", F.col("user_id") % 3 == 0)})
    o = load(spark, sf_dir, "orders").groupBy(
        (F.date_trunc("day", "o_orderdate") + F.expr("INTERVAL 29 YEARS")).alias("ts")
    ).agg(F.count(F.lit(1)).alias("orders"))
    return J.full_join(wide, o, "ts").withColumnRenamed("ts", "day")


# As-of join of the daily series with monthly macro aggregates --------------------
ASOF_SQL = "WITH " + DAILY_SQL + """,
macro AS (
  SELECT date_trunc('month', l_shipdate) + INTERVAL 14 DAY AS ts,
         sum(l_quantity) AS m_qty, count(*) AS m_lines
  FROM lineitem GROUP BY 1),
keyed AS (SELECT s.series, m.* FROM (SELECT DISTINCT series FROM daily) s, macro m)
SELECT d.series, d.ts, d.price, k.m_qty, k.m_lines
FROM daily d ASOF LEFT JOIN keyed k ON d.series = k.series AND d.ts >= k.ts"""


@query("j04_asof_macro", ASOF_SQL, covers=("J4", "W3"))
def asof_macro(spark, sf_dir):
    d = daily_prices(spark, sf_dir).select("series", "ts", "price")
    li = load(spark, sf_dir, "lineitem")
    macro = li.groupBy((F.date_trunc("month", "l_shipdate") + F.expr("INTERVAL 14 DAYS")).alias("ts")) \
        .agg(F.sum("l_quantity").alias("m_qty"), F.count(F.lit(1)).alias("m_lines"))
    # the macro table holds for every series: one shared key, whose rows the series machinery spreads
    d, macro = d.withColumn("_all", F.lit(0)), macro.withColumn("_all", F.lit(0))
    return J.asof_join(d, macro, ["_all"], "ts", ["m_qty", "m_lines"]).drop("_all")


# J6 ---------------------------------------------------------------------------
@query("j06_semi_join", """
SELECT l_orderkey, l_linenumber, l_quantity FROM lineitem
WHERE l_orderkey IN (SELECT o_orderkey FROM orders WHERE o_totalprice > 300000)""", covers=("J6",))
def semi(spark, sf_dir):
    li = load(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_quantity")
    kept = load(spark, sf_dir, "orders").filter(F.col("o_totalprice") > 300000) \
        .select(F.col("o_orderkey").alias("l_orderkey"))
    return J.semi_join(li, kept, "l_orderkey")


# J7 + A4 ------------------------------------------------------------------------
@query("j07_label_lookup", unsign("""
WITH m AS (SELECT user_id % 9 AS cluster, avg(value) AS ev FROM events GROUP BY 1 HAVING user_id % 9 <> 8)
SELECT event_id, e.user_id % 9 AS cluster, round(m.ev, 6) AS ev
FROM events e LEFT JOIN m ON e.user_id % 9 = m.cluster""", ["ev"]), covers=("J7", "A4"))
def label_lookup(spark, sf_dir):
    e = load(spark, sf_dir, "events").withColumn("cluster", (F.col("user_id") % 9).cast("long"))
    m = AG.group_center(e, "cluster", "value", "mean").filter(F.col("cluster") != 8) \
        .withColumnRenamed("value", "ev")
    j = J.lookup_join(e.select("event_id", "cluster"), m, "cluster", "left")
    return j.select("event_id", "cluster", _r(F.col("ev")).alias("ev"))


# J8 + A4 (median) ----------------------------------------------------------------
@query("j08_common_groups", """
WITH a AS (SELECT user_id % 10 AS g, quantile_cont(value, 0.5) AS med, count(*) AS n
           FROM events WHERE event_id % 2 = 0 GROUP BY 1),
     b AS (SELECT user_id % 10 AS g, quantile_cont(value, 0.5) AS med, count(*) AS n
           FROM events WHERE event_id % 2 = 1 AND user_id % 10 NOT IN (3, 7) GROUP BY 1)
SELECT a.g, a.med AS med_a, a.n AS n_a, b.med AS med_b, b.n AS n_b FROM a JOIN b ON a.g = b.g""",
       covers=("J8", "A4"))
def common_groups(spark, sf_dir):
    e = load(spark, sf_dir, "events").withColumn("g", (F.col("user_id") % 10).cast("long"))
    a = e.filter(F.col("event_id") % 2 == 0)
    b = e.filter((F.col("event_id") % 2 == 1) & ~F.col("g").isin(3, 7))

    def side(d):
        med = AG.group_center(d, "g", "value", "median").withColumnRenamed("value", "med")
        return med.join(d.groupBy("g").agg(F.count(F.lit(1)).alias("n")), "g")
    return J.common_groups(side(a), side(b), "g")


# J9 + A18 -------------------------------------------------------------------------
@query("j09_align_counts", unsign("""
WITH a AS (SELECT c_mktsegment, count(*) AS n_pos FROM customer WHERE c_acctbal > 0 AND c_nationkey < 20 GROUP BY 1),
     b AS (SELECT c_mktsegment, count(*) AS n_neg FROM customer WHERE c_acctbal <= 0 AND c_mktsegment <> 'BUILDING' GROUP BY 1),
     j AS (SELECT coalesce(a.c_mktsegment, b.c_mktsegment) AS c_mktsegment, coalesce(n_pos, 0) AS n_pos,
                  coalesce(n_neg, 0) AS n_neg FROM a FULL JOIN b ON a.c_mktsegment = b.c_mktsegment)
SELECT c_mktsegment, n_pos, n_neg,
       round(n_pos / sum(n_pos) OVER () - n_neg / sum(n_neg) OVER (), 9) AS prop_diff FROM j""", ["prop_diff"]),
       covers=("J9", "A18"))
def align_counts(spark, sf_dir):
    c = load(spark, sf_dir, "customer")
    a = c.filter((F.col("c_acctbal") > 0) & (F.col("c_nationkey") < 20)).groupBy("c_mktsegment") \
        .agg(F.count(F.lit(1)).alias("n_pos"))
    b = c.filter((F.col("c_acctbal") <= 0) & (F.col("c_mktsegment") != "BUILDING")).groupBy("c_mktsegment") \
        .agg(F.count(F.lit(1)).alias("n_neg"))
    j = J.align_counts(a, b, "c_mktsegment", "n_pos", "n_neg")
    totals = j.agg(F.sum("n_pos").alias("_p"), F.sum("n_neg").alias("_n"))     # one row
    return j.crossJoin(F.broadcast(totals)).withColumn(
        "prop_diff", _r(F.try_divide("n_pos", "_p") - F.try_divide("n_neg", "_n"), 9)).drop("_p", "_n")


# J10 --------------------------------------------------------------------------
@query("j10_interval_join", """
WITH w AS (SELECT DISTINCT event_type, date_trunc('day', ts) + INTERVAL 9 HOUR AS w_start,
                  date_trunc('day', ts) + INTERVAL 17 HOUR AS w_end FROM events)
SELECT w.event_type, w.w_start, count(*) AS n, round(sum(e.value), 2) AS total
FROM w JOIN events e ON e.event_type = w.event_type AND e.ts BETWEEN w.w_start AND w.w_end
GROUP BY w.event_type, w.w_start""", covers=("J10",))
def interval(spark, sf_dir):
    e = load(spark, sf_dir, "events")
    day = F.date_trunc("day", "ts")
    w = e.select("event_type", (day + F.expr("INTERVAL 9 HOURS")).alias("w_start"),
                 (day + F.expr("INTERVAL 17 HOURS")).alias("w_end")).distinct()
    pts = e.select("event_type", F.unix_micros(F.col("ts").cast("timestamp")).alias("t"), "value")
    iv = w.select("event_type", "w_start", F.unix_micros(F.col("w_start").cast("timestamp")).alias("s"),
                  F.unix_micros(F.col("w_end").cast("timestamp")).alias("e"))
    j = J.interval_join(pts, iv, ["event_type"], "t", "s", "e")
    return j.groupBy("event_type", "w_start").agg(F.count(F.lit(1)).alias("n"),
                                                  F.round(F.sum("value"), 2).alias("total"))


# A1 ---------------------------------------------------------------------------
@query("a01_value_counts", """
SELECT l_returnflag, count(*) AS count, count(*) / sum(count(*)) OVER () AS share
FROM lineitem GROUP BY l_returnflag""", covers=("A1",))
def value_counts(spark, sf_dir):
    return AG.value_counts(load(spark, sf_dir, "lineitem"), "l_returnflag")


# A2 ---------------------------------------------------------------------------
@query("a02_distinct_profile", """
SELECT 'c_mktsegment' AS column, count(DISTINCT c_mktsegment) AS n_distinct,
       list(DISTINCT c_mktsegment ORDER BY c_mktsegment) AS "values" FROM customer
UNION ALL
SELECT 'c_nationkey', count(DISTINCT c_nationkey),
       list(DISTINCT CAST(c_nationkey AS VARCHAR) ORDER BY CAST(c_nationkey AS VARCHAR)) FROM customer
UNION ALL
SELECT 'c_name', count(DISTINCT c_name), NULL FROM customer""", covers=("A2",))
def distinct_profile(spark, sf_dir):
    return AG.distinct_profile(load(spark, sf_dir, "customer"), ["c_mktsegment", "c_nationkey", "c_name"])


# A3 ---------------------------------------------------------------------------
DESC_COLS = ["l_quantity", "l_extendedprice", "l_discount"]


@query("a03_describe", unsign(" UNION ALL ".join(f"""
SELECT '{c}' AS column, count({c}) AS count, round(avg({c}), 4) AS mean, round(stddev_samp({c}), 4) AS std,
       min({c}) AS min, quantile_cont({c}, 0.25) AS q25, quantile_cont({c}, 0.5) AS q50,
       quantile_cont({c}, 0.75) AS q75, max({c}) AS max FROM lineitem""" for c in DESC_COLS), ["mean", "std"]),
       covers=("A3", "A8"))
def describe(spark, sf_dir):
    d = AG.describe(load(spark, sf_dir, "lineitem"), DESC_COLS)
    return d.withColumn("mean", _r(F.col("mean"), 4)).withColumn("std", _r(F.col("std"), 4))


# A5 + A14 ------------------------------------------------------------------------
@query("a05_bin_rates", unsign("""
WITH m AS (SELECT min(value) AS lo, max(value) AS hi FROM events),
b AS (SELECT least(greatest(ceil((value - lo) / ((hi - lo) / 10)) - 1, 0), 9) AS bin,
             CASE WHEN event_type = 'purchase' THEN 1 ELSE 0 END AS y FROM events, m)
SELECT CAST(bin AS INTEGER) AS bin, count(*) AS count, sum(y) AS sum, round(sum(y) / count(*), 9) AS rate,
       round(sum(y) / count(*) * 100 - 100, 6) AS deviation
FROM b GROUP BY bin""", ["rate", "deviation"]), covers=("A5", "A14"))
def bin_rates(spark, sf_dir):
    e = load(spark, sf_dir, "events").withColumn("y", F.when(F.col("event_type") == "purchase", 1).otherwise(0))
    b = AG.equal_width_bins(e, "value", 10)
    r = AG.bin_rates(b, "bin", "y")
    return r.select("bin", "count", "sum", _r(F.col("rate"), 9).alias("rate"), _r(F.col("deviation")).alias("deviation"))


# A6 ---------------------------------------------------------------------------
PRIORITIES = ["1-URGENT", "2-HIGH", "3-MEDIUM", "4-NOT SPECIFIED", "5-LOW"]


@query("a06_crosstab", "SELECT o_orderstatus, " + ", ".join(
    f"count(*) FILTER (WHERE o_orderpriority = '{p}') AS \"{p}\"" for p in PRIORITIES)
    + " FROM orders GROUP BY o_orderstatus", covers=("A6",))
def crosstab(spark, sf_dir):
    return AG.crosstab(load(spark, sf_dir, "orders"), "o_orderstatus", "o_orderpriority", PRIORITIES)


# A7 ---------------------------------------------------------------------------
@query("a07_median_mode", """
SELECT 'c_acctbal' AS column, CAST(quantile_cont(c_acctbal, 0.5) AS VARCHAR) AS value FROM customer
UNION ALL SELECT 'c_nationkey', CAST(CAST(quantile_cont(c_nationkey, 0.5) AS DOUBLE) AS VARCHAR) FROM customer
UNION ALL SELECT 'c_mktsegment', (SELECT c_mktsegment FROM customer GROUP BY 1 ORDER BY count(*) DESC, 1 LIMIT 1)
UNION ALL SELECT 'empty_text', 'missing'""", covers=("A7",))
def median_mode(spark, sf_dir):
    c = load(spark, sf_dir, "customer").withColumn("empty_text", F.lit(None).cast("string"))
    vals = AG.medians_and_modes(c, ["c_acctbal", "c_nationkey"], ["c_mktsegment", "empty_text"])
    rows = [(k, None if v is None else (repr(float(v)) if isinstance(v, float) else str(v))) for k, v in vals.items()]
    return spark.createDataFrame(rows, "column string, value string")


# A9 ---------------------------------------------------------------------------
@query("a09_mean_drift", unsign("""
WITH a AS (SELECT avg(l_quantity / 10) AS q, avg(l_discount) AS d, avg(l_tax * 10) AS t FROM lineitem WHERE l_returnflag = 'R'),
     b AS (SELECT avg(l_quantity / 10) AS q, avg(l_discount) AS d, avg(l_tax * 10) AS t FROM lineitem WHERE l_returnflag = 'N'),
     l AS (SELECT 'qty10' AS column, a.q AS mean_a, b.q AS mean_b FROM a, b
           UNION ALL SELECT 'l_discount', a.d, b.d FROM a, b
           UNION ALL SELECT 'tax10', a.t, b.t FROM a, b)
SELECT "column", round(mean_a, 6) AS mean_a, round(mean_b, 6) AS mean_b, round(abs(mean_a - mean_b), 6) AS delta
FROM l WHERE abs(mean_a - mean_b) > 0.001""", ["mean_a", "mean_b", "delta"]), covers=("A9",))
def mean_drift(spark, sf_dir):
    li = load(spark, sf_dir, "lineitem").select("l_returnflag", (F.col("l_quantity") / 10).alias("qty10"),
                                                "l_discount", (F.col("l_tax") * 10).alias("tax10"))
    cols = ["qty10", "l_discount", "tax10"]
    d = AG.mean_drift(li.filter("l_returnflag = 'R'"), li.filter("l_returnflag = 'N'"), cols, threshold=0.001)
    return d.select("column", *[_r(F.col(c)).alias(c) for c in ("mean_a", "mean_b", "delta")])


# A10 + O6 -------------------------------------------------------------------------
SPLIT_SQL = """CASE WHEN CAST(('0x' || substr(md5(CAST(o_orderkey AS VARCHAR) || '42'), 1, 8)) AS BIGINT) % 100 < 20
                    THEN 'test' ELSE 'train' END"""


@query("a10_class_support", unsign("""
WITH s AS (SELECT """ + SPLIT_SQL + """ AS split, o_orderstatus FROM orders),
c AS (SELECT split, o_orderstatus, count(*) AS count FROM s GROUP BY 1, 2),
p AS (SELECT *, count * 100.0 / sum(count) OVER (PARTITION BY split) AS percent FROM c)
SELECT p.split, o_orderstatus, count, round(percent, 6) AS percent,
       round(max(count) OVER (PARTITION BY split) / min(count) OVER (PARTITION BY split), 6) AS imbalance_ratio,
       round(1 - sum(pow(percent / 100.0, 2)) OVER (PARTITION BY split), 3) AS gini
FROM p""", ["percent", "imbalance_ratio", "gini"]), covers=("A10", "O6"))
def class_support(spark, sf_dir):
    o = O.random_split(load(spark, sf_dir, "orders"), "o_orderkey", 20)
    counts, summary = AG.class_support(o, "split", "o_orderstatus")
    return counts.join(summary, "split").select(
        "split", "o_orderstatus", "count", _r(F.col("percent")).alias("percent"),
        _r(F.col("imbalance_ratio")).alias("imbalance_ratio"), _r(F.col("gini"), 3).alias("gini"))


# A11 ------------------------------------------------------------------------------
MOM_COLS = ["l_quantity", "l_discount", "l_tax"]


def _moments_sql(c: str) -> str:
    return f"""
SELECT '{c}' AS column, round(avg({c}), 6) AS mean, round(stddev_samp({c}), 6) AS std,
  round(avg(power({c} - m, 3)) / power(avg(power({c} - m, 2)), 1.5), 6) AS skew,
  round(kurtosis_pop({c}), 6) AS kurtosis, min({c}) AS min, max({c}) AS max,
  abs(coalesce(stddev_samp({c}), 0)) <= 1e-8 AS zero_variance
FROM lineitem, (SELECT avg({c}) AS m FROM lineitem)"""


@query("a11_moments", unsign(" UNION ALL ".join(_moments_sql(c) for c in MOM_COLS),
                             ["mean", "std", "skew", "kurtosis"]), covers=("A11",))
def moments(spark, sf_dir):
    m = AG.moments(load(spark, sf_dir, "lineitem"), MOM_COLS)
    return m.select("column", *[_r(F.col(c)).alias(c) for c in ("mean", "std", "skew", "kurtosis")],
                    "min", "max", "zero_variance")


# A12 + O1 + O2 --------------------------------------------------------------------
CORR_COLS = ["l_quantity", "l_extendedprice", "l_discount", "l_tax", "l_linenumber"]


@query("a12_top_correlations", unsign("SELECT * FROM (" + " UNION ALL ".join(
    f"SELECT '{a}' AS a, 'l_partkey' AS b, round(corr({a}, l_partkey), 9) AS corr FROM lineitem" for a in CORR_COLS)
    + ") ORDER BY abs(corr) DESC, a LIMIT 3", ["corr"]), covers=("A12", "O1"))
def top_correlations(spark, sf_dir):
    c = AG.correlations(load(spark, sf_dir, "lineitem"), CORR_COLS, target="l_partkey")
    c = c.withColumn("corr", _r(F.col("corr"), 9))
    return O.top_k(c, F.abs(F.col("corr")), 3, ["a"])


@query("a12_strongest_partner", unsign("""
WITH p AS (""" + " UNION ALL ".join(
    f"SELECT '{a}' AS a, '{b}' AS b, round(corr({a}, {b}), 9) AS corr FROM lineitem"
    for a in CORR_COLS for b in CORR_COLS if a != b) + """)
SELECT a, b, corr FROM (SELECT *, row_number() OVER (PARTITION BY a ORDER BY abs(corr) DESC NULLS LAST, b) AS r FROM p)
WHERE r = 1""", ["corr"]), covers=("A12",))
def strongest_partner(spark, sf_dir):
    c = AG.correlations(load(spark, sf_dir, "lineitem"), CORR_COLS).withColumn("corr", _r(F.col("corr"), 9))
    return AG.strongest_partner(c)


# A13 ------------------------------------------------------------------------------
@query("a13_null_profile", unsign("""
WITH n AS (
  SELECT o_orderkey,
         CASE WHEN o_orderkey % 7 = 0 THEN NULL ELSE o_totalprice END AS o_totalprice,
         CASE WHEN o_orderkey % 11 = 0 THEN NULL ELSE o_orderpriority END AS o_orderpriority,
         CASE WHEN o_orderkey % 50 = 0 THEN NULL ELSE o_orderstatus END AS o_orderstatus
  FROM orders),
c AS (SELECT count(*) AS rows, count(*) - count(o_totalprice) AS a, count(*) - count(o_orderpriority) AS b,
             count(*) - count(o_orderstatus) AS c FROM n),
l AS (SELECT rows, 'o_totalprice' AS column, a AS nulls FROM c UNION ALL SELECT rows, 'o_orderpriority', b FROM c
      UNION ALL SELECT rows, 'o_orderstatus', c FROM c),
s AS (SELECT 'o_totalprice' AS column, list(o_orderkey ORDER BY o_orderkey)[1:5] AS sample_keys FROM n WHERE o_totalprice IS NULL
      UNION ALL SELECT 'o_orderpriority', list(o_orderkey ORDER BY o_orderkey)[1:5] FROM n WHERE o_orderpriority IS NULL
      UNION ALL SELECT 'o_orderstatus', list(o_orderkey ORDER BY o_orderkey)[1:5] FROM n WHERE o_orderstatus IS NULL)
SELECT rows, l.column, nulls, round(nulls * 100.0 / rows, 6) AS share_pct, nulls > rows * 5.0 / 100.0 AS flagged, sample_keys
FROM l LEFT JOIN s ON l.column = s.column""", ["share_pct"]), covers=("A13",))
def null_profile(spark, sf_dir):
    o = load(spark, sf_dir, "orders")
    k = F.col("o_orderkey")
    n = o.select("o_orderkey",
                 F.when(k % 7 == 0, F.lit(None)).otherwise(F.col("o_totalprice")).alias("o_totalprice"),
                 F.when(k % 11 == 0, F.lit(None)).otherwise(F.col("o_orderpriority")).alias("o_orderpriority"),
                 F.when(k % 50 == 0, F.lit(None)).otherwise(F.col("o_orderstatus")).alias("o_orderstatus"))
    p = AG.null_profile(n, "o_orderkey", 5.0, sample=5)
    return p.withColumn("share_pct", _r(F.col("share_pct")))


# A15 ------------------------------------------------------------------------------
@query("a15_quantile_bins", """
WITH q AS (SELECT quantile_cont(o_totalprice, [0.2, 0.4, 0.6, 0.8]) AS e FROM orders)
SELECT CAST(CASE WHEN o_totalprice <= e[1] THEN 0 WHEN o_totalprice <= e[2] THEN 1 WHEN o_totalprice <= e[3] THEN 2
                 WHEN o_totalprice <= e[4] THEN 3 ELSE 4 END AS INTEGER) AS bin,
       count(*) AS n, min(o_totalprice) AS lo, max(o_totalprice) AS hi
FROM orders, q GROUP BY 1""", covers=("A15",))
def quantile_bins(spark, sf_dir):
    b = AG.quantile_bins(load(spark, sf_dir, "orders"), "o_totalprice", 5)
    return b.groupBy("bin").agg(F.count(F.lit(1)).alias("n"), F.min("o_totalprice").alias("lo"),
                                F.max("o_totalprice").alias("hi"))


# A17 ------------------------------------------------------------------------------
@query("a17_density_difference", unsign("""
WITH d AS (SELECT n_chars, quality FROM documents JOIN labels USING (doc_id)),
m AS (SELECT min(n_chars) AS lo, max(n_chars) AS hi FROM d),
b AS (SELECT CAST(least(floor((n_chars - lo) / ((hi - lo) / 10.0)), 9) AS INTEGER) AS bin, quality,
             (hi - lo) / 10.0 AS w FROM d, m),
c AS (SELECT bin, any_value(w) AS w, sum(CASE WHEN quality = 1 THEN 1 ELSE 0 END) AS n1,
             sum(CASE WHEN quality = 0 THEN 1 ELSE 0 END) AS n0 FROM b GROUP BY bin),
t AS (SELECT sum(n1) AS t1, sum(n0) AS t0 FROM c)
SELECT bin, round(n1 / (t1 * w) - n0 / (t0 * w), 12) AS density_diff FROM c, t""", ["density_diff"]),
       covers=("A17",))
def density_difference(spark, sf_dir):
    d = load(spark, sf_dir, "documents").join(load(spark, sf_dir, "labels"), "doc_id")
    r = AG.density_difference(d, "n_chars", "quality")
    return r.withColumn("density_diff", _r(F.col("density_diff"), 12))


# A19 ------------------------------------------------------------------------------
def _tumbling_sql() -> str:
    mids = A.bin_midpoints()
    means = ", ".join(f"avg(y_bins[{i + 1}]) AS m{i}" for i in range(len(mids)))
    ev = " + ".join(f"m{i} * {m!r}" for i, m in enumerate(mids))
    return f"""WITH {q_series.FWD_CTES},
g AS (SELECT series, ts, y_bins, row_number() OVER (PARTITION BY series ORDER BY ts) AS rn FROM v),
b AS (SELECT series, CAST(floor((rn - 1) / 7) AS INTEGER) AS block, {means}
      FROM g WHERE rn <= 150 AND y_bins IS NOT NULL GROUP BY 1, 2)
SELECT series, block, round({ev}, 6) + 0.0 AS ev FROM b"""


@query("a19_tumbling_profile", _tumbling_sql(), covers=("A19",))
def tumbling(spark, sf_dir):
    # blocks by row position in the series; rows without a full horizon are skipped
    s = q_series.forward_frame(spark, sf_dir).filter(F.col("y_bins").isNotNull())
    t = AG.tumbling_profile(s, ["series"], S.SEQ, "y_bins", A.bin_midpoints())
    return t.select("series", "block", _r(F.col("ev")).alias("ev"))


# A20 ------------------------------------------------------------------------------
@query("a20_mutual_information", unsign("""
WITH d AS (SELECT n_chars, quality FROM documents JOIN labels USING (doc_id)),
q AS (SELECT quantile_cont(n_chars, [0.2, 0.4, 0.6, 0.8]) AS e FROM d),
b AS (SELECT CASE WHEN n_chars <= e[1] THEN 0 WHEN n_chars <= e[2] THEN 1 WHEN n_chars <= e[3] THEN 2
                  WHEN n_chars <= e[4] THEN 3 ELSE 4 END AS bin, quality FROM d, q),
j AS (SELECT bin, quality, count(*) AS nxy FROM b GROUP BY 1, 2),
k AS (SELECT nxy, sum(nxy) OVER () AS n, sum(nxy) OVER (PARTITION BY bin) AS nx,
             sum(nxy) OVER (PARTITION BY quality) AS ny FROM j)
SELECT round(sum(nxy / n * ln(nxy * n / (nx * ny))), 9) AS mutual_info FROM k""", ["mutual_info"]),
       covers=("A20",))
def mutual_information(spark, sf_dir):
    d = load(spark, sf_dir, "documents").join(load(spark, sf_dir, "labels"), "doc_id")
    b = AG.quantile_bins(d, "n_chars", 5)
    return AG.binned_mutual_information(b, "bin", "quality").select(_r(F.col("mutual_info"), 9).alias("mutual_info"))


# A21 ------------------------------------------------------------------------------
@query("a21_first_per_key", """
SELECT o_custkey, o_orderkey, o_orderdate FROM (
  SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey) AS r FROM orders)
WHERE r = 1""", covers=("A21",))
def first_per_key(spark, sf_dir):
    o = load(spark, sf_dir, "orders").select("o_custkey", "o_orderkey", "o_orderdate")
    return AG.first_per_key(o, ["o_custkey"], ["o_orderdate", "o_orderkey"])


# O3 -------------------------------------------------------------------------------
@query("o03_last_rows", "WITH " + DAILY_SQL + """
SELECT series, ts, price FROM (
  SELECT *, row_number() OVER (PARTITION BY series ORDER BY ts DESC) AS r FROM daily) WHERE r <= 30""",
       covers=("O3",))
def last_rows(spark, sf_dir):
    return O.last_rows(daily_prices(spark, sf_dir).select("series", "ts", "price"), ["series"], ["ts"], 30)


# O5 -------------------------------------------------------------------------------
@query("o05_set_ops", """
WITH a AS (SELECT c_nationkey FROM customer WHERE c_mktsegment = 'BUILDING'),
     b AS (SELECT c_nationkey FROM customer WHERE c_acctbal < 0)
SELECT 'intersect' AS op, c_nationkey FROM (SELECT * FROM a INTERSECT SELECT * FROM b)
UNION ALL SELECT 'union', c_nationkey FROM (SELECT * FROM a UNION SELECT * FROM b)
UNION ALL SELECT 'except', c_nationkey FROM (SELECT * FROM a EXCEPT SELECT * FROM b)""", covers=("O5",))
def set_ops(spark, sf_dir):
    c = load(spark, sf_dir, "customer")
    a = c.filter("c_mktsegment = 'BUILDING'").select("c_nationkey")
    b = c.filter("c_acctbal < 0").select("c_nationkey")
    r = O.set_ops(a, b)
    out = None
    for name in ("intersect", "union", "except"):
        t = r[name].select(F.lit(name).alias("op"), "c_nationkey")
        out = t if out is None else out.unionByName(t)
    return out


# O7 -------------------------------------------------------------------------------
@query("o07_stratified_split", """
WITH h AS (SELECT doc_id, quality, md5(CAST(doc_id AS VARCHAR) || '42') AS hh FROM labels WHERE quality IS NOT NULL),
r AS (SELECT *, row_number() OVER (PARTITION BY quality ORDER BY hh, doc_id) AS rn,
             count(*) OVER (PARTITION BY quality) AS n FROM h)
SELECT doc_id, quality, CASE WHEN rn <= ceil(n * 0.2) THEN 'test' ELSE 'train' END AS split FROM r""",
       covers=("O7",))
def stratified(spark, sf_dir):
    lab = load(spark, sf_dir, "labels").select("doc_id", "quality")
    return O.stratified_split(lab, "doc_id", "quality", 0.2)


# O8 -------------------------------------------------------------------------------
@query("o08_chronological_split", "WITH " + DAILY_SQL + """,
r AS (SELECT series, ts, row_number() OVER (PARTITION BY series ORDER BY ts) AS rn,
             count(*) OVER (PARTITION BY series) AS n FROM daily),
s AS (SELECT *, n - ceil(n * 0.2) AS m FROM r)
SELECT series, CASE WHEN rn > m THEN 'test' WHEN rn > m - ceil(m * 0.2) THEN 'val' ELSE 'train' END AS split,
       count(*) AS n, min(ts) AS first_ts, max(ts) AS last_ts
FROM s GROUP BY 1, 2""", covers=("O8",))
def chronological(spark, sf_dir):
    d = O.chronological_split(daily_prices(spark, sf_dir), ["series"], "ts", 0.2, 0.2)
    return d.groupBy("series", "split").agg(F.count(F.lit(1)).alias("n"), F.min("ts").alias("first_ts"),
                                            F.max("ts").alias("last_ts"))


# Names of a wide aligned table by role: side series, and what a model may see ---------
@query("p08_macro_columns", """
WITH d AS (SELECT date_trunc('day', ts) AS day, event_type, count(*) AS n FROM events GROUP BY 1, 2)
SELECT day, 'CLICK_price' AS name, CAST(n AS DOUBLE) AS value, false AS is_feature FROM d WHERE event_type = 'click'
UNION ALL SELECT day, 'VIEWS', CAST(n AS DOUBLE), false FROM d WHERE event_type = 'view'
UNION ALL SELECT day, 'VIEWS_ma', CAST(n AS DOUBLE) / 2, true FROM d WHERE event_type = 'view'""", covers=("P8",))
def macro_columns(spark, sf_dir):
    from kiln.operators import schema as P
    e = load(spark, sf_dir, "events").withColumn("ts", F.date_trunc("day", "ts"))
    per = e.groupBy("ts", "event_type").agg(F.count(F.lit(1)).alias("value"))
    views = per.filter("event_type = 'view'")
    wide = J.outer_align({"CLICK_price": per.filter("event_type = 'click'"), "Close": per.filter("event_type = 'purchase'"),
                          "VIEWS": views, "VIEWS_ma": views.withColumn("value", F.col("value") / 2),
                          "- -": views})
    names = [c for c in wide.columns if c != "ts"]
    macro, features = P.macro_columns(names), P.feature_columns(names)
    long = wide.select(F.col("ts").alias("day"), *macro).unpivot("day", macro, "name", "value").na.drop(subset=["value"])
    return long.withColumn("is_feature", F.col("name").isin(features))


# Per-column suggestions from moments, distinct counts and target correlation ---------
SUG_COLS = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]


def _sugg_sql() -> str:
    parts = []
    for c in SUG_COLS:
        parts.append(f"""SELECT '{c}' AS column, avg({c}) AS mean, stddev_samp({c}) AS std, min({c}) AS mn, max({c}) AS mx,
  avg(power({c} - (SELECT avg({c}) FROM lineitem), 3)) / power(var_pop({c}), 1.5) AS skew, kurtosis_pop({c}) AS kurt,
  count(DISTINCT {c}) AS nd, corr({c}, l_linenumber) AS tc FROM lineitem""")
    return "WITH m AS (" + " UNION ALL ".join(parts) + """)
SELECT "column", list_sort(list_filter([CASE WHEN abs(coalesce(std, 0)) <= 1e-8 THEN 'constant'
                                 WHEN std > 50 OR abs(mean) > 100 OR mx - mn > 100 THEN 'wide_scale' END,
                            CASE WHEN abs(skew) > 1 OR abs(kurt) > 3 THEN 'odd_shape' END,
                            CASE WHEN nd < 10 THEN 'few_values' END,
                            CASE WHEN abs(tc) < 0.05 THEN 'weak_target_link' END], lambda x: x IS NOT NULL)) AS suggestions
FROM m"""


@query("a22_feature_suggestions", _sugg_sql(), covers=("A22", "A11", "A2", "A12"))
def feature_suggestions(spark, sf_dir):
    li = load(spark, sf_dir, "lineitem")
    mom = AG.moments(li, SUG_COLS)
    dist = AG.distinct_profile(li, SUG_COLS)
    corr = AG.correlations(li, SUG_COLS, target="l_linenumber")
    return AG.feature_suggestions(mom, dist, corr).select("column", "suggestions")


# O2 + O3: explicit ranks; the first chunks of a folder ---------------------------------
@query("o02_ranked_orders", """
SELECT o_orderkey, o_totalprice, row_number() OVER (ORDER BY o_totalprice DESC, o_orderkey) AS rank FROM orders""", covers=("O2",))
def ranked_orders(spark, sf_dir):
    o = load(spark, sf_dir, "orders").select("o_orderkey", "o_totalprice")
    return O.rank_by(o, F.col("o_totalprice"), ["o_orderkey"])


@query("o03_first_chunks", """
SELECT CAST(event_id % 4 AS BIGINT) AS chunk_no, count(*) AS n, round(sum(value), 4) + 0.0 AS total FROM events
WHERE event_id % 4 < 2 GROUP BY 1""", covers=("O3", "S3"))
def first_chunk_rows(spark, sf_dir):
    path = scratch_path(spark, f"first-chunks-{uuid.uuid4().hex}")
    load(spark, sf_dir, "events").withColumn("part", (F.col("event_id") % 4).cast("int")).repartition("part").write.partitionBy(
        "part").parquet(path)
    d = SRC.first_chunks(SRC.read_chunks(spark, path, pattern="*.parquet"), 2)
    return d.groupBy("chunk_no").agg(F.count(F.lit(1)).alias("n"), (F.round(F.sum("value"), 4) + F.lit(0.0)).alias("total"))
