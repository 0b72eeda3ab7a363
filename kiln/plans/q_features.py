"""Fit-on-train / apply-on-test feature queries.

Input: orders joined with customer, nulls injected on fixed key rules, split
80/20 by the md5 hash of the order key (O6); every stage is fitted on the train
side and applied to the test side.
"""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from kiln.operators import features as FE
from kiln.operators import splits as O
from kiln.plans.registry import query
from kiln.plans.sqlkit import unsign
from kiln.session import scratch_path
from kiln.sources import sinks as K
from kiln.tables import load

SEGMENTS = ["AUTOMOBILE", "BUILDING", "FURNITURE", "HOUSEHOLD", "MACHINERY"]


def _r(c, d=6):
    return F.round(c, d) + F.lit(0.0)


def split_frame(spark, sf_dir):
    o = load(spark, sf_dir, "orders")
    c = load(spark, sf_dir, "customer")
    k = F.col("o_orderkey")
    d = o.join(c, o.o_custkey == c.c_custkey, "inner").select(
        "o_orderkey", "o_custkey",
        F.when(k % 7 == 0, F.lit(None)).otherwise(F.col("o_totalprice")).alias("o_totalprice"),
        F.when(k % 11 == 0, F.lit(None)).otherwise(F.col("c_acctbal")).alias("c_acctbal"),
        F.when(k % 13 == 0, F.lit(None)).otherwise(F.col("o_orderpriority")).alias("o_orderpriority"),
        "c_mktsegment", "o_orderstatus")
    d = O.random_split(d, "o_orderkey", 20)
    return d.filter("split = 'train'").drop("split"), d.filter("split = 'test'").drop("split")


SPLIT_SQL = """base AS (
  SELECT o_orderkey, o_custkey,
         CASE WHEN o_orderkey % 7 = 0 THEN NULL ELSE o_totalprice END AS o_totalprice,
         CASE WHEN o_orderkey % 11 = 0 THEN NULL ELSE c_acctbal END AS c_acctbal,
         CASE WHEN o_orderkey % 13 = 0 THEN NULL ELSE o_orderpriority END AS o_orderpriority,
         c_mktsegment, o_orderstatus,
         CAST(('0x' || substr(md5(CAST(o_orderkey AS VARCHAR) || '42'), 1, 8)) AS BIGINT) % 100 < 20 AS is_test
  FROM orders JOIN customer ON o_custkey = c_custkey),
train AS (SELECT * FROM base WHERE NOT is_test),
test AS (SELECT * FROM base WHERE is_test)"""


# F1 + F2 + F3 ----------------------------------------------------------------------
@query("f01_imputers", unsign("WITH " + SPLIT_SQL + """,
st AS (SELECT avg(o_totalprice) AS m, quantile_cont(c_acctbal, 0.5) AS med,
              (SELECT o_orderpriority FROM train WHERE o_orderpriority IS NOT NULL GROUP BY 1
               ORDER BY count(*) DESC, 1 LIMIT 1) AS mode FROM train)
SELECT o_orderkey, round(coalesce(o_totalprice, m), 4) AS price_mean, round(coalesce(c_acctbal, med), 6) AS acct_median,
       coalesce(o_orderpriority, mode) AS priority_mode, coalesce(o_totalprice, 0) AS price_zero
FROM test, st""", ["price_mean", "acct_median", "price_zero"]), covers=("F1", "F2", "F3", "U1", "U2"))
def imputers(spark, sf_dir):
    train, test = split_frame(spark, sf_dir)
    d = test.withColumns({"price_mean": F.col("o_totalprice"), "acct_median": F.col("c_acctbal"),
                          "priority_mode": F.col("o_orderpriority"), "price_zero": F.col("o_totalprice")})
    tr = train.withColumns({"price_mean": F.col("o_totalprice"), "acct_median": F.col("c_acctbal"),
                            "priority_mode": F.col("o_orderpriority"), "price_zero": F.col("o_totalprice")})
    pipe = FE.chain(FE.Imputer(["price_mean"], "mean"), FE.Imputer(["acct_median"], "median", fallback=30.0),
                    FE.Imputer(["priority_mode"], "most_frequent"), FE.Imputer(["price_zero"], "constant", value=0.0))
    model = pipe.fit(tr)
    out = model.transform(d)
    return out.select("o_orderkey", _r(F.col("price_mean"), 4).alias("price_mean"),
                      _r(F.col("acct_median")).alias("acct_median"), "priority_mode",
                      (F.col("price_zero") + F.lit(0.0)).alias("price_zero"))


# F4 ---------------------------------------------------------------------------------
RAW_SQL = "WITH " + SPLIT_SQL + """,
st AS (SELECT quantile_cont(o_totalprice, 0.5) AS m_price, quantile_cont(c_acctbal, 0.5) AS m_acct,
              (SELECT o_orderpriority FROM train WHERE o_orderpriority IS NOT NULL GROUP BY 1 ORDER BY count(*) DESC, 1 LIMIT 1) AS mo_pri,
              (SELECT c_mktsegment FROM train GROUP BY 1 ORDER BY count(*) DESC, 1 LIMIT 1) AS mo_seg,
              (SELECT list(DISTINCT coalesce(o_orderpriority, 'NaN_placeholder_fit') ORDER BY coalesce(o_orderpriority, 'NaN_placeholder_fit')) FROM train) AS c_pri,
              (SELECT list(DISTINCT c_mktsegment ORDER BY c_mktsegment) FROM train) AS c_seg
       FROM train),
t AS (SELECT *, CASE WHEN o_orderkey % 5 = 0 THEN NULL ELSE CAST(o_custkey % 100 AS DOUBLE) END AS new_num,
             coalesce(o_orderstatus, 'missing_new_col') AS new_text FROM test),
codes AS (SELECT new_text, CAST(row_number() OVER (ORDER BY new_text) - 1 AS INTEGER) AS code
          FROM (SELECT DISTINCT new_text FROM t))
SELECT o_orderkey, CAST(o_custkey AS DOUBLE) AS o_custkey, coalesce(o_totalprice, m_price) AS o_totalprice,
       coalesce(c_acctbal, m_acct) AS c_acctbal,
       CAST(list_position(c_pri, coalesce(o_orderpriority, mo_pri)) - 1 AS INTEGER) AS o_orderpriority,
       CAST(list_position(c_seg, coalesce(c_mktsegment, mo_seg)) - 1 AS INTEGER) AS c_mktsegment,
       coalesce(new_num, 0) AS new_num, codes.code AS new_text
FROM t JOIN codes USING (new_text), st"""


@query("f04_raw_transformer", RAW_SQL, covers=("F4", "A7"))
def raw_transformer(spark, sf_dir):
    train, test = split_frame(spark, sf_dir)
    cols = ["o_orderkey", "o_custkey", "o_totalprice", "c_acctbal", "o_orderpriority", "c_mktsegment"]
    model = FE.RawTransformer().fit(train.select(*[c for c in cols if c != "o_orderkey"]))
    # K5: the fitted step round-trips through the ML writer / reader
    path = scratch_path(spark, f"raw-model-{uuid.uuid4().hex}")
    K.save_model(FE.chain(model).fit(train.limit(0)), path)
    model = K.load_pipeline(path)
    t = test.select(*cols, F.when(F.col("o_orderkey") % 5 == 0, F.lit(None))
                    .otherwise((F.col("o_custkey") % 100).cast("double")).alias("new_num"),
                    F.col("o_orderstatus").alias("new_text"))
    # the order key was not seen at fit: it passes through as a number column
    out = model.transform(t.withColumnRenamed("o_orderkey", "_ok"))
    return out.select(F.col("_ok").alias("o_orderkey"), "o_custkey", "o_totalprice", "c_acctbal",
                      "o_orderpriority", "c_mktsegment", "new_num", "new_text")


# F7 + F8 + F9 + F10 -------------------------------------------------------------------
ENC_SQL = "WITH " + SPLIT_SQL + """,
cats AS (SELECT (SELECT list(DISTINCT o_orderpriority ORDER BY o_orderpriority) FROM train WHERE o_orderpriority IS NOT NULL) AS pri,
                (SELECT list(DISTINCT o_orderstatus ORDER BY o_orderstatus) FROM train) AS st,
                (SELECT list(DISTINCT c_mktsegment ORDER BY c_mktsegment) FROM train) AS seg)
SELECT o_orderkey, """ + ", ".join(
    f"CASE WHEN c_mktsegment = '{s}' THEN 1.0 ELSE 0.0 END AS \"c_mktsegment_{s}\"" for s in SEGMENTS) + """,
       CAST(coalesce(list_position(pri, o_orderpriority), 0) - 1 AS INTEGER) AS pri_code,
       CAST(list_position(st, o_orderstatus) - 1 AS INTEGER) AS status_code,
       CAST(list_position(seg, c_mktsegment) - 1 AS INTEGER) AS seg_ordinal
FROM test, cats"""


@query("f07_encoders", ENC_SQL, covers=("F7", "F8", "F9", "F10"))
def encoders(spark, sf_dir):
    train, test = split_frame(spark, sf_dir)
    d = test.withColumns({"pri_code": F.col("o_orderpriority"), "status_code": F.col("o_orderstatus"),
                          "seg_ordinal": F.col("c_mktsegment")})
    tr = train.withColumns({"pri_code": F.col("o_orderpriority"), "status_code": F.col("o_orderstatus"),
                            "seg_ordinal": F.col("c_mktsegment")})
    pipe = FE.chain(FE.OneHot(["c_mktsegment"]), FE.CategoryCodes(["pri_code"]),
                    FE.LabelCodes("status_code"), FE.CategoryCodes(["seg_ordinal"], on_unseen="error"))
    out = pipe.fit(tr).transform(d)
    return out.select("o_orderkey", *[f"c_mktsegment_{s}" for s in SEGMENTS], "pri_code", "status_code",
                      "seg_ordinal")


# F11 + F12 + F13 ------------------------------------------------------------------------
SCALE_SQL = "WITH " + SPLIT_SQL + """,
st AS (SELECT avg(c_acctbal) AS a_m, stddev_pop(c_acctbal) AS a_s, min(o_totalprice) AS p_lo, max(o_totalprice) AS p_hi,
              avg(ln(1 + o_totalprice)) AS l_m, stddev_pop(ln(1 + o_totalprice)) AS l_s FROM train)
SELECT o_orderkey, round((c_acctbal - a_m) / a_s, 9) AS acct_std, round((o_totalprice - p_lo) / (p_hi - p_lo), 9) AS price_minmax,
       round((ln(1 + o_totalprice) - l_m) / l_s, 9) AS price_log_std
FROM test, st"""


@query("f11_scalers", unsign(SCALE_SQL, ["acct_std", "price_minmax", "price_log_std"]), covers=("F11", "F12", "F13", "U3"))
def scalers(spark, sf_dir):
    train, test = split_frame(spark, sf_dir)

    def prep(d):
        return d.withColumns({"acct_std": F.col("c_acctbal"), "price_minmax": F.col("o_totalprice"),
                              "price_log_std": F.col("o_totalprice")})
    pipe = FE.chain(FE.Scaler(["acct_std"], "standard"), FE.Scaler(["price_minmax"], "minmax"),
                    FE.Scaler(["price_log_std"], "standard", log1p=True))
    out = pipe.fit(prep(train)).transform(prep(test))
    return out.select("o_orderkey", *[_r(F.col(c), 9).alias(c) for c in ("acct_std", "price_minmax", "price_log_std")])


# F10 and its inverse -----------------------------------------------------------------
@query("f10_label_roundtrip", """
WITH c AS (SELECT list_sort(list_distinct(list(o_orderpriority))) AS cats FROM orders)
SELECT o_orderkey, CAST(list_position(cats, o_orderpriority) - 1 AS INTEGER) AS code, o_orderpriority AS label FROM orders, c""",
       covers=("F10",))
def label_roundtrip(spark, sf_dir):
    d = load(spark, sf_dir, "orders").select("o_orderkey", "o_orderpriority")
    model = FE.LabelCodes("o_orderpriority").fit(d)
    coded = model.transform(d)
    back = FE.decode_labels(coded.withColumn("code", F.col("o_orderpriority")), model, "o_orderpriority")
    return back.select("o_orderkey", "code", F.col("o_orderpriority").alias("label"))


# K5: states saved as rows and put back on the steps by name and position ------------------
@query("k05_restored_steps", unsign("WITH " + SPLIT_SQL + """,
f AS (SELECT list_sort(list_distinct(list(o_orderpriority))) AS cats, min(o_totalprice) AS lo, max(o_totalprice) AS hi FROM train)
SELECT o_orderkey, CAST(coalesce(list_position(cats, o_orderpriority), 0) - 1 AS INTEGER) AS o_orderpriority,
       round((o_totalprice - lo) / (hi - lo), 9) AS o_totalprice FROM test, f""", ["o_totalprice"]), covers=("K5", "U1"))
def restored_steps(spark, sf_dir):
    train, test = split_frame(spark, sf_dir)
    steps = [FE.CategoryCodes(["o_orderpriority"]), FE.Scaler(["o_totalprice"], "minmax")]
    path = scratch_path(spark, f"states-{uuid.uuid4().hex}")
    states = FE.fitted_states(FE.chain(*steps).fit(train))
    spark.createDataFrame([(i, *s) for i, s in enumerate(states)], "position int, step string, state string, config string").write.parquet(path)
    saved = [tuple(r)[1:] for r in spark.read.parquet(path).orderBy("position").collect()]
    out = FE.restored(steps, saved).transform(test)
    return out.select("o_orderkey", "o_orderpriority", _r(F.col("o_totalprice"), 9).alias("o_totalprice"))
