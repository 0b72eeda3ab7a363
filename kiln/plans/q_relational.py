"""Queries for sources, sinks and projection/schema operators (S*, K*, P*)."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from kiln.functions import arrays as A
from kiln.functions import scalar as X
from kiln.operators import schema as P
from kiln.plans.registry import query
from kiln.session import scratch_path, written
from kiln.sources import files as SRC
from kiln.sources import sinks as K
from kiln.tables import load

ORDERS_DDL = ("o_orderkey BIGINT, o_custkey BIGINT, o_orderstatus STRING, o_totalprice DOUBLE, "
              "o_orderdate TIMESTAMP_NTZ, o_orderpriority STRING")


def _fresh(spark, name: str) -> str:
    return scratch_path(spark, f"{name}-{uuid.uuid4().hex}")


# S1 + K1: chunked CSV write, full-directory CSV read ---------------------------------
@query("s01_csv_roundtrip", """
SELECT o_orderstatus, count(*) AS n, round(sum(o_totalprice), 2) AS total,
       min(o_orderdate) AS first_date, max(o_orderdate) AS last_date
FROM orders GROUP BY o_orderstatus""", covers=("S1", "K1", "O4"))
def csv_roundtrip(spark, sf_dir):
    path = _fresh(spark, "orders-csv")
    K.write_chunks(load(spark, sf_dir, "orders"), path, fmt="csv", rows_per_file=4000)
    back = SRC.read_csv(spark, path, schema=ORDERS_DDL)
    return back.groupBy("o_orderstatus").agg(
        F.count(F.lit(1)).alias("n"), F.round(F.sum("o_totalprice"), 2).alias("total"),
        F.min("o_orderdate").alias("first_date"), F.max("o_orderdate").alias("last_date"))


# S3: chunk directory scan with a name filter --------------------------------------
@query("s03_chunk_scan", """
SELECT l_returnflag, l_linestatus, count(*) AS n, round(sum(l_extendedprice), 2) AS revenue,
       sum(l_quantity) AS qty
FROM lineitem GROUP BY l_returnflag, l_linestatus""", covers=("S3", "K1"))
def chunk_scan(spark, sf_dir):
    path = _fresh(spark, "lineitem-chunks")
    K.write_chunks(load(spark, sf_dir, "lineitem"), path, fmt="parquet", rows_per_file=10_000)
    back = SRC.read_chunks(spark, path, fmt="parquet", pattern="part-*")
    return back.groupBy("l_returnflag", "l_linestatus").agg(
        F.count(F.lit(1)).alias("n"), F.round(F.sum("l_extendedprice"), 2).alias("revenue"),
        F.sum("l_quantity").alias("qty"))


# S4 + S5: time-series CSV with junk header rows, located date column, file profile ------
@query("s04_timeseries_csv", """
SELECT count(*) AS rows, min(o_orderdate) AS min_ts, max(o_orderdate) AS max_ts,
       round(sum(o_totalprice), 2) AS total
FROM orders""", covers=("S4", "S5", "P10"))
def timeseries_csv(spark, sf_dir):
    path = _fresh(spark, "series-csv")
    o = load(spark, sf_dir, "orders")
    body = o.select(F.date_format("o_orderdate", "yyyy-MM-dd").alias("Date"),
                    F.col("o_totalprice").cast("string").alias("Close"))
    junk = spark.createDataFrame([("Ticker", "XYZ"), ("Date", "")], "Date string, Close string")
    junk.unionByName(body).write.option("header", True).csv(path)
    ts = SRC.read_timeseries_csv(spark, path)
    prof = SRC.source_profile(ts.withColumn("_v", F.col("Close")), "ts")
    totals = ts.agg(F.round(F.sum("Close"), 2).alias("total"))
    return prof.agg(F.sum("rows").alias("rows"), F.min("min_ts").alias("min_ts"),
                    F.max("max_ts").alias("max_ts")).crossJoin(totals)


# Build-once materialised table ---------------------------------------------------
@query("s06_build_once", """
SELECT o_orderpriority, count(*) AS n FROM orders GROUP BY o_orderpriority""", covers=("S6",))
def build_once(spark, sf_dir):
    path = _fresh(spark, "orders-once")
    o = load(spark, sf_dir, "orders")
    SRC.build_once(o, path)
    again = SRC.build_once(o.limit(0), path)  # second call must keep the first copy
    return again.groupBy("o_orderpriority").agg(F.count(F.lit(1)).alias("n"))


# S7 + P2: placeholder scan drops known text targets, ignores absent ones ---------------
@query("s07_placeholder_scan", """
SELECT o_orderkey, o_custkey, o_totalprice, o_orderdate, o_orderpriority FROM orders""",
       covers=("S7", "P2"))
def placeholder_scan(spark, sf_dir):
    o = load(spark, sf_dir, "orders")
    o = SRC.drop_known_targets(o, ["o_orderstatus", "Transported", "isFraud"])
    return P.drop_columns(o, ["PassengerId", "Name"])


# K2: prediction file ----------------------------------------------------------------
PRED_SQL = """
SELECT o_orderkey,
       coalesce(CASE WHEN o_orderkey % 5 = 0 THEN NULL
                     WHEN o_totalprice > 200000 THEN 1.0 ELSE 0.0 END, 0.5) AS o_flag,
       coalesce(CASE WHEN o_orderkey % 5 = 0 THEN NULL
                     WHEN o_totalprice > 200000 THEN 1.0 ELSE 0.0 END, 0.5) <> 0 AS o_flag_bool
FROM orders"""


@query("k02_prediction_file", PRED_SQL, covers=("K2",))
def prediction_file(spark, sf_dir):
    o = load(spark, sf_dir, "orders")
    scored = o.withColumn("p", F.when(F.col("o_orderkey") % 5 == 0, F.lit(None))
                          .when(F.col("o_totalprice") > 200000, F.lit(1.0)).otherwise(F.lit(0.0)))
    sub = K.prediction_frame(scored, "o_orderkey", "p", "o_flag")
    path = _fresh(spark, "predictions")
    K.write_predictions(sub, path)
    back = spark.read.schema("o_orderkey BIGINT, o_flag DOUBLE").option("header", True).csv(path)
    return back.withColumn("o_flag_bool", F.col("o_flag") != 0)


# K4: version registry -----------------------------------------------------------------
@query("k04_version_registry", """
SELECT 'v' || i AS version, CAST(i AS BIGINT) AS version_no, 'orders by ' || s AS description,
       'o_orderstatus' AS target
FROM (SELECT row_number() OVER (ORDER BY o_orderstatus) AS i, o_orderstatus AS s
      FROM (SELECT DISTINCT o_orderstatus FROM orders))""", covers=("K4",))
def version_registry(spark, sf_dir):
    path = _fresh(spark, "registry")
    statuses = [r[0] for r in load(spark, sf_dir, "orders").select("o_orderstatus").distinct()
                .orderBy("o_orderstatus").collect()]  # a handful of category values
    for s in statuses:
        K.register_version(spark, path, f"orders by {s}", "o_orderstatus", {"status": s})
    return spark.read.parquet(path).select("version", "version_no", "description", "target")


# P1 + P6 + P7 + P9: names normalised, aligned to a train column list -------------------
@query("p07_align_schema", """
SELECT o_orderkey, o_totalprice, 0 AS c_acctbal, o_orderstatus FROM orders""",
       covers=("P1", "P6", "P7", "P9"))
def align_schema(spark, sf_dir):
    o = load(spark, sf_dir, "orders").withColumnsRenamed({"o_orderkey": "o-orderkey",
                                                          "o_totalprice": "o-totalprice"})
    o = P.normalise_names(o)
    o, target = P.split_target(o, "o_orderstatus")
    numeric = P.numeric_columns(o)
    cols = [c for c in ("o_orderkey", "o_totalprice", "c_acctbal") if c in numeric or c == "c_acctbal"]
    return P.align_to(o, cols + [target], fill=0)


# P3 + P4 + P5: null reports and drops ----------------------------------------------
NULLED_SQL = """nulled AS (
  SELECT o_orderkey, o_orderstatus,
         CASE WHEN o_orderkey % 7 = 0 THEN NULL ELSE o_totalprice END AS o_totalprice,
         CASE WHEN o_orderkey % 11 = 0 THEN NULL ELSE o_orderpriority END AS o_orderpriority,
         CASE WHEN o_orderkey % 13 = 0 THEN NULL ELSE o_orderstatus END AS target
  FROM orders)"""


def nulled_orders(spark, sf_dir):
    o = load(spark, sf_dir, "orders")
    k = F.col("o_orderkey")
    return o.select("o_orderkey", "o_orderstatus",
                    F.when(k % 7 == 0, F.lit(None)).otherwise(F.col("o_totalprice")).alias("o_totalprice"),
                    F.when(k % 11 == 0, F.lit(None)).otherwise(F.col("o_orderpriority")).alias("o_orderpriority"),
                    F.when(k % 13 == 0, F.lit(None)).otherwise(F.col("o_orderstatus")).alias("target"))


@query("p03_null_drops", "WITH " + NULLED_SQL + """
SELECT count(*) AS total,
       CAST(sum(CASE WHEN o_totalprice IS NOT NULL AND o_orderpriority IS NOT NULL
                      AND target IS NOT NULL THEN 1 ELSE 0 END) AS BIGINT) AS kept,
       round(sum(CASE WHEN o_totalprice IS NOT NULL AND o_orderpriority IS NOT NULL
                      AND target IS NOT NULL THEN 1 ELSE 0 END) * 100.0 / count(*), 2) AS percent_kept,
       count(target) AS kept_target,
       count(*) FILTER (WHERE o_totalprice IS NOT NULL AND o_orderpriority IS NOT NULL) AS kept_features
FROM nulled""", covers=("P3", "P4", "P5"))
def null_drops(spark, sf_dir):
    d = nulled_orders(spark, sf_dir)
    rep = P.null_drop_report(d)
    t = P.drop_null_target(d, "target").agg(F.count(F.lit(1)).alias("kept_target"))
    f = P.drop_null_rows(d, ["o_totalprice", "o_orderpriority"]).agg(F.count(F.lit(1)).alias("kept_features"))
    return rep.crossJoin(t).crossJoin(f)


# P10 + P11 + P12: lenient casts, text booleans, delimited codes -----------------------
CASTS_SQL = """
WITH t AS (
  SELECT event_id,
         CASE WHEN event_id % 11 = 0 THEN 'x' || event_id ELSE CAST(value AS VARCHAR) END AS value_text,
         CASE event_id % 6 WHEN 0 THEN ' True' WHEN 1 THEN '0' WHEN 2 THEN 'FALSE'
                           WHEN 3 THEN '1' WHEN 4 THEN 'yes' ELSE NULL END AS flag_text,
         CASE WHEN event_id % 4 = 0 THEN event_type || '/' || user_id
              ELSE event_type || '/' || user_id || '/' || CASE WHEN user_id % 2 = 0 THEN 'P' ELSE 'S' END
         END AS code
  FROM events)
SELECT event_id,
       TRY_CAST(trim(value_text) AS DOUBLE) AS value_num,
       CASE WHEN lower(trim(flag_text)) IN ('true', '1') THEN true
            WHEN lower(trim(flag_text)) IN ('false', '0') THEN false END AS flag,
       coalesce(CASE WHEN lower(trim(flag_text)) IN ('true', '1') THEN true
            WHEN lower(trim(flag_text)) IN ('false', '0') THEN false END, false) AS flag_or_false,
       CASE WHEN len(string_split(code, '/')) = 3 THEN string_split(code, '/')[1] END AS deck,
       TRY_CAST(CASE WHEN len(string_split(code, '/')) = 3 THEN string_split(code, '/')[2] END AS DOUBLE) AS num,
       CASE WHEN len(string_split(code, '/')) = 3 THEN string_split(code, '/')[3] END AS side
FROM t"""


@query("p10_casts", CASTS_SQL, covers=("P10", "P11", "P12"))
def casts(spark, sf_dir):
    e = load(spark, sf_dir, "events")
    i = F.col("event_id")
    t = e.select("event_id",
                 F.when(i % 11 == 0, F.concat(F.lit("x"), i.cast("string")))
                  .otherwise(F.col("value").cast("string")).alias("value_text"),
                 F.when(i % 6 == 0, " True").when(i % 6 == 1, "0").when(i % 6 == 2, "FALSE")
                  .when(i % 6 == 3, "1").when(i % 6 == 4, "yes").alias("flag_text"),
                 F.when(i % 4 == 0, F.concat_ws("/", "event_type", "user_id"))
                  .otherwise(F.concat_ws("/", "event_type", "user_id",
                                         F.when(F.col("user_id") % 2 == 0, "P").otherwise("S"))).alias("code"))
    deck, num, side = X.split_code("code")
    return t.select("event_id", X.lenient_double("value_text").alias("value_num"),
                    X.text_to_bool("flag_text").alias("flag"),
                    X.text_to_bool("flag_text", null_as_false=True).alias("flag_or_false"),
                    deck.alias("deck"), num.alias("num"), side.alias("side"))


# P13 + P14 + K3: contract check and row validation into valid / rejected ------------------
# The validated table's columns and types (wine-quality schema).
WINE_SCHEMA = {"fixed acidity": "double", "volatile acidity": "double", "citric acid": "double",
               "residual sugar": "double", "chlorides": "double", "free sulfur dioxide": "double",
               "total sulfur dioxide": "double", "density": "double", "pH": "double",
               "sulphates": "double", "alcohol": "double", "quality": "int"}

WINE_SOURCE = {  # driver-table column feeding each field
    "fixed acidity": "l_quantity", "volatile acidity": "l_discount", "citric acid": "l_tax",
    "residual sugar": "l_extendedprice", "chlorides": "l_discount", "free sulfur dioxide": "l_quantity",
    "total sulfur dioxide": "l_extendedprice", "density": "l_tax", "pH": "l_quantity",
    "sulphates": "l_discount", "alcohol": "l_tax", "quality": "l_linenumber"}


def _wine_rows_spark(spark, sf_dir):
    li = load(spark, sf_dir, "lineitem")
    key = F.col("l_orderkey") * 10 + F.col("l_linenumber")
    cols = [key.alias("row_id")]
    for i, (name, src) in enumerate(WINE_SOURCE.items()):
        v = F.col(src).cast("string")
        v = F.when(key % 97 == i, F.lit(None)).when(key % 89 == i, F.lit("n/a")).otherwise(v)
        cols.append(v.alias(name))
    return li.select(*cols)


def _wine_rows_sql() -> str:
    parts = ["l_orderkey * 10 + l_linenumber AS row_id"]
    for i, (name, src) in enumerate(WINE_SOURCE.items()):
        k = "(l_orderkey * 10 + l_linenumber)"
        parts.append(f"CASE WHEN {k} % 97 = {i} THEN NULL WHEN {k} % 89 = {i} THEN 'n/a' "
                     f"ELSE CAST({src} AS VARCHAR) END AS \"{name}\"")
    return "wine AS (SELECT " + ", ".join(parts) + " FROM lineitem)"


def _wine_error_sql() -> str:
    whens = []
    for name, kind in WINE_SCHEMA.items():
        q = f'"{name}"'
        whens.append(f"WHEN {q} IS NULL THEN 'Missing value in {name}'")
        msg = ("'could not convert string to float: ''' || " if kind == "double"
               else "'invalid literal for int() with base 10: ''' || ")
        whens.append(f"WHEN TRY_CAST(trim({q}) AS DOUBLE) IS NULL THEN {msg}{q} || ''''")
    return "CASE " + " ".join(whens) + " END"


VALIDATE_SQL = "WITH " + _wine_rows_sql() + """,
tagged AS (SELECT *, """ + _wine_error_sql() + """ AS error FROM wine)
SELECT coalesce(error, 'valid') AS outcome, count(*) AS n,
       CAST(sum(CASE WHEN error IS NULL THEN TRY_CAST(CAST(TRY_CAST(trim(quality) AS DOUBLE) AS INTEGER) AS BIGINT) END) AS BIGINT) AS quality_sum
FROM tagged GROUP BY coalesce(error, 'valid')"""


@query("p14_validate_rows", VALIDATE_SQL, covers=("P13", "P14", "K3"))
def validate(spark, sf_dir):
    rows = _wine_rows_spark(spark, sf_dir)
    P.check_contract(rows, dict.fromkeys(WINE_SCHEMA, "string"), not_null=["row_id"])
    # the text table is read once; the sink and the counts read what is written of it
    tagged = written(P.tagged_rows(rows, WINE_SCHEMA, index="row_id", keep=["quality"]), "validated")
    K.write_rejected(tagged.where("outcome <> 'valid'").select("row_id", F.col("outcome").alias("error"), "row"),
                     _fresh(spark, "rejected"))
    return tagged.groupBy("outcome").agg(F.count(F.lit(1)).alias("n"), F.sum(F.col("quality").cast("long")).alias("quality_sum"))


# Task-type inference over several candidate targets ---------------------------
TASK_SQL = """
SELECT 'l_linestatus' AS target, count(DISTINCT l_linestatus) AS n_distinct, 'unknown' AS task_type FROM lineitem
UNION ALL
SELECT 'l_linenumber', count(DISTINCT l_linenumber),
       CASE WHEN count(DISTINCT l_linenumber) <= 2 THEN 'binary'
            WHEN count(DISTINCT l_linenumber) < 15 THEN 'multinomial' ELSE 'regression' END FROM lineitem
UNION ALL
SELECT 'l_quantity', count(DISTINCT l_quantity),
       CASE WHEN count(DISTINCT l_quantity) <= 2 THEN 'binary'
            WHEN count(DISTINCT l_quantity) < 15 THEN 'multinomial' ELSE 'regression' END FROM lineitem
UNION ALL
SELECT 'quality', count(DISTINCT quality),
       CASE WHEN count(DISTINCT quality) <= 2 THEN 'binary'
            WHEN count(DISTINCT quality) < 15 THEN 'multinomial' ELSE 'regression' END FROM labels"""


@query("p15_task_type", TASK_SQL, covers=("P15",))
def task_types(spark, sf_dir):
    li = load(spark, sf_dir, "lineitem")
    lab = load(spark, sf_dir, "labels")
    agg = li.agg(*[F.countDistinct(c).alias(c) for c in ("l_linestatus", "l_linenumber", "l_quantity")])
    rows = agg.select(F.explode(F.array(*[
        F.struct(F.lit(c).alias("target"), F.col(c).alias("n_distinct"),
                 P.task_type_column(F.col(c), numeric=(c != "l_linestatus")).alias("task_type"))
        for c in ("l_linestatus", "l_linenumber", "l_quantity")])).alias("r")).select("r.*")
    q = lab.agg(F.countDistinct("quality").alias("n")).select(
        F.lit("quality").alias("target"), F.col("n").alias("n_distinct"),
        P.task_type_column(F.col("n")).alias("task_type"))
    return rows.unionByName(q)


# P16 + P17 + P18: spend total, arg-max category, quartile threshold flags ------------------
SPEND = ["l_tax", "l_discount", "l_fee"]
SPEND_SQL = """
WITH s AS (
  SELECT l_orderkey, l_linenumber,
         CASE WHEN l_orderkey % 7 = 0 THEN NULL ELSE l_tax END AS l_tax,
         CASE WHEN l_orderkey % 5 = 1 THEN NULL ELSE l_discount END AS l_discount,
         CASE WHEN l_linenumber = 3 THEN 0.0 ELSE l_quantity / 500 END AS l_fee
  FROM lineitem),
f AS (SELECT l_orderkey, l_linenumber, coalesce(l_tax, 0) AS l_tax, coalesce(l_discount, 0) AS l_discount,
             coalesce(l_fee, 0) AS l_fee FROM s),
q AS (SELECT quantile_cont(l_tax, [0.25, 0.5, 0.75]) AS qt, quantile_cont(l_discount, [0.25, 0.5, 0.75]) AS qd,
             quantile_cont(l_fee, [0.25, 0.5, 0.75]) AS qf FROM f),
a AS (SELECT *, CASE WHEN l_tax >= l_discount AND l_tax >= l_fee THEN 'l_tax'
                     WHEN l_discount >= l_fee THEN 'l_discount' ELSE 'l_fee' END AS top FROM f),
cats AS (SELECT list(DISTINCT top ORDER BY top) AS cl FROM a)
SELECT l_orderkey, l_linenumber, round(l_tax + l_discount + l_fee, 6) + 0.0 AS total_spent,
       CAST(list_position(cl, top) - 1 AS INTEGER) AS max_spend_category,
       l_tax > 0 AS l_tax_used, l_tax > qt[1] AS l_tax_above_q25, l_tax > qt[2] AS l_tax_above_q50, l_tax > qt[3] AS l_tax_above_q75,
       l_discount > 0 AS l_discount_used, l_discount > qd[1] AS l_discount_above_q25,
       l_discount > qd[2] AS l_discount_above_q50, l_discount > qd[3] AS l_discount_above_q75,
       l_fee > 0 AS l_fee_used, l_fee > qf[1] AS l_fee_above_q25, l_fee > qf[2] AS l_fee_above_q50, l_fee > qf[3] AS l_fee_above_q75
FROM a, q, cats"""


@query("p16_spend_features", SPEND_SQL, covers=("P16", "P17", "P18", "A8"))
def spend_features(spark, sf_dir):
    li = load(spark, sf_dir, "lineitem")
    k = F.col("l_orderkey")
    d = li.select("l_orderkey", "l_linenumber",
                  F.when(k % 7 == 0, F.lit(None)).otherwise(F.col("l_tax")).alias("l_tax"),
                  F.when(k % 5 == 1, F.lit(None)).otherwise(F.col("l_discount")).alias("l_discount"),
                  F.when(F.col("l_linenumber") == 3, F.lit(0.0))
                   .otherwise(F.col("l_quantity") / 500).alias("l_fee"))
    from kiln.operators import features as FE
    model = FE.SpendFeatures(SPEND).fit(d)
    out = model.transform(d)
    return out.select("l_orderkey", "l_linenumber",
                      (F.round("total_spent", 6) + F.lit(0.0)).alias("total_spent"),
                      "max_spend_category", *[f"{c}_{s}" for c in SPEND
                                              for s in ("used", "above_q25", "above_q50", "above_q75")])


# P19 + P20 + P21 + P22: bands, clipping, safe ratios, probability rows ---------------------
BANDS_SQL = """
WITH e AS (
  SELECT event_id, (value - 250) / 5000 AS ev, value, user_id,
         [value, CASE WHEN event_id % 9 = 0 THEN 0.0 ELSE 100 - value END, -1.0 * (event_id % 3)] AS raw
  FROM events)
SELECT event_id,
  CASE WHEN ev IS NULL OR isnan(ev) THEN 'Unknown (NaN EV)' WHEN ev < -0.03 THEN 'Deep Loss'
       WHEN ev < -0.005 THEN 'Loss' WHEN ev <= 0.005 THEN 'Neutral' WHEN ev <= 0.03 THEN 'Profit'
       ELSE 'Deep Profit' END AS ev_band,
  CASE WHEN ev IS NULL OR isnan(ev) THEN 'Neutral' WHEN ev > 0.005 THEN 'Profitable'
       WHEN ev < -0.005 THEN 'Loss' ELSE 'Neutral' END AS ev_category,
  CASE WHEN ev IS NULL OR isnan(ev) THEN 'grey' WHEN ev < -0.05 THEN 'darkred' WHEN ev < -0.01 THEN 'lightcoral'
       WHEN ev <= 0.01 THEN 'yellow' WHEN ev <= 0.05 THEN 'lightgreen' ELSE 'darkgreen' END AS ev_colour,
  least(greatest(ev * 10, 0.0), 1.0) AS ev_clipped,
  round(value / nullif(user_id % 4, 0), 6) + 0.0 AS ratio,
  list_transform(raw, lambda p: round(CASE
      WHEN list_sum(list_transform(raw, lambda x: greatest(x, 0.0))) = 0 THEN
        CASE WHEN len(raw) > 1 THEN 1.0 / len(raw) ELSE 0.0 END
      ELSE greatest(p, 0.0) / (list_sum(list_transform(raw, lambda x: greatest(x, 0.0))) + 1e-9) END, 9) + 0.0) AS probs
FROM e"""


@query("p19_bands_and_rows", BANDS_SQL, covers=("P19", "P20", "P21", "P22"))
def bands(spark, sf_dir):
    e = load(spark, sf_dir, "events")
    ev = (F.col("value") - 250) / 5000
    raw = F.array(F.col("value"),
                  F.when(F.col("event_id") % 9 == 0, F.lit(0.0)).otherwise(100 - F.col("value")),
                  (-1.0 * (F.col("event_id") % 3)).cast("double"))
    d = e.select("event_id", ev.alias("ev"), "value", "user_id", raw.alias("raw"))
    return d.select("event_id", X.ev_band(F.col("ev")).alias("ev_band"),
                    X.ev_category(F.col("ev")).alias("ev_category"),
                    X.ev_colour(F.col("ev")).alias("ev_colour"),
                    A.clip(F.col("ev") * 10, 0.0, 1.0).alias("ev_clipped"),
                    (F.round(X.safe_ratio(F.col("value"), (F.col("user_id") % 4).cast("double")), 6)
                     + F.lit(0.0)).alias("ratio"),
                    F.transform(A.normalize_probs(F.col("raw")), lambda p: F.round(p, 9) + F.lit(0.0)).alias("probs"))
