"""Clustering features and ETL compositions (F5, F16-F25) on the driver tables."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from kiln.functions import arrays as A
from kiln.functions import scalar as X
from kiln.operators import aggregates as AG
from kiln.operators import clustering as CL
from kiln.operators import features as FE
from kiln.operators import knn as KNN
from kiln.operators import quantiles as QU
from kiln.operators import schema as P
from kiln.operators import splits as O
from kiln.operators import stats as ST
from kiln.operators import text as TX
from kiln.plans import q_series
from kiln.plans.registry import query
from kiln.plans.sqlkit import robust_sql, unsign
from kiln.session import passing, scratch_path, written
from kiln.sources import sinks as K
from kiln.tables import load

DIMS = 64


def _emb(spark, sf_dir):
    e = load(spark, sf_dir, "embeddings")
    cols = [f"e{i}" for i in range(DIMS)]
    d = e.select("vec_id", "label", *[F.col("embedding")[i].cast("double").alias(c) for i, c in enumerate(cols)])
    d = O.random_split(d, "vec_id", 20)
    train = d.filter("split = 'train'")
    lo, hi = CL.minmax_arrays(train, cols)
    d = d.withColumn("x", CL.scaled_vector(cols, lo, hi))
    return d.filter("split = 'train'"), d.filter("split = 'test'")


# Fits have no SQL form: tests/test_clustering.py holds each against a plain version.
def _r(c, digits: int = 6):
    return F.round(c, digits) + F.lit(0.0)


def _rounded(name: str, digits: int = 6):
    return F.transform(name, lambda x: F.round(x, digits) + F.lit(0.0)).alias(name)


@query("f16_kmeans_features", covers=("F16", "F12"))
def kmeans(spark, sf_dir):
    train, test = _emb(spark, sf_dir)
    out = CL.kmeans_features(train, test, "x", k=5)
    return out.select("vec_id", "kmeans_cluster", *[_r(f"kmeans_dist_{i}").alias(f"kmeans_dist_{i}") for i in range(5)])


@query("f17_gmm_features", covers=("F17",))
def gmm(spark, sf_dir):
    """Five components with full covariances in all 64 coordinates."""
    train, test = _emb(spark, sf_dir)
    out = CL.gmm_features(train, test, "x", k=5)
    return out.select("vec_id", "gmm_cluster", _rounded("gmm_probs"), _r("gmm_loglik").alias("gmm_loglik"))


@query("f18_ica_components", covers=("F18",))
def ica(spark, sf_dir):
    """Seven independent components of the 64 coordinates."""
    train, test = _emb(spark, sf_dir)
    out = CL.ica_features(test, "x", CL.fast_ica(train, "x", n_components=7, tol=1e-3))
    return out.select("vec_id", *[_r(f"ica_{i + 1}").alias(f"ica_{i + 1}") for i in range(7)])


@query("f19_pca_projection", covers=("F19",))
def pca(spark, sf_dir):
    train, test = _emb(spark, sf_dir)
    out = CL.pca_projection(train, test, "x", k=2)
    return out.select("vec_id", *[_r(F.col("pca")[i]).alias(f"pca_{i + 1}") for i in range(2)])


def _distribution_split(spark, sf_dir):
    s = q_series.forward_frame(spark, sf_dir).filter(F.col("y_bins").isNotNull()).drop("_seq", "_n")
    split = written(O.chronological_split(s, ["series"], "ts", 0.2, 0.2), "split")     # read by the fit and by the scoring
    return split.withColumn("EV", A.expected_value(F.col("y_bins"), A.bin_midpoints()))


@query("f22_expected_values", "WITH " + q_series.FWD_CTES + """,
r AS (SELECT series, ts, row_number() OVER (PARTITION BY series ORDER BY ts) AS rn, count(*) OVER (PARTITION BY series) AS n,
             list_sum(list_transform(list_zip(y_bins, """ + repr(A.bin_midpoints()) + """), lambda z: z[1] * z[2])) / list_sum(y_bins) AS ev
      FROM v WHERE y_bins IS NOT NULL),
s AS (SELECT *, n - ceil(n * 0.2) AS m FROM r)
SELECT series, ts, CASE WHEN rn > m THEN 'test' WHEN rn > m - ceil(m * 0.2) THEN 'val' ELSE 'train' END AS split,
       round(ev, 6) + 0.0 AS EV FROM s""", covers=("F22", "W18", "O8"))
def expected_values(spark, sf_dir):
    """EV and chronological part of each forward-return vector."""
    return _distribution_split(spark, sf_dir).select("series", "ts", "split", _r("EV").alias("EV"))


@query("f22_distribution_clusters", covers=("F22", "W18", "O8"))
def distribution_clusters(spark, sf_dir):
    """EV of each forward-return vector, a 9-component mixture fitted on the
    chronological train part, cluster and probabilities on train/val/test."""
    v = _distribution_split(spark, sf_dir).withColumn("yv", F.transform("y_bins", lambda x: F.coalesce(x, F.lit(0.0))))
    out = CL.gmm_features(v.filter("split = 'train'"), v, "yv", k=9, prefix="gmm")
    return out.select("series", "ts", "split", _r("EV").alias("EV"), "gmm_cluster", _rounded("gmm_probs"))


# F5 ----------------------------------------------------------------------------------
def passengers(spark, sf_dir):
    o = load(spark, sf_dir, "orders")
    c = load(spark, sf_dir, "customer")
    k = F.col("o_orderkey")
    d = o.join(c, o.o_custkey == c.c_custkey)
    return d.select(
        F.concat(F.lpad(k.cast("string"), 6, "0"), F.lit("_01")).alias("PassengerId"),
        F.when(k % 9 == 0, F.lit(None)).otherwise(F.col("c_mktsegment")).alias("HomePlanet"),
        F.when(k % 10 == 0, F.lit(None)).otherwise(F.col("o_orderpriority")).alias("Destination"),
        F.when(k % 3 == 0, "True").when(k % 3 == 1, " false").alias("CryoSleep"),
        F.when(k % 4 == 0, "1").when(k % 4 == 1, "0").alias("VIP"),
        F.when(k % 8 == 0, F.lit(None)).otherwise(
            F.concat_ws("/", F.substring("c_name", -1, 1), (F.col("o_custkey") % 300).cast("string"),
                        F.when(F.col("o_custkey") % 2 == 0, "P").otherwise("S"))).alias("Cabin"),
        F.when(k % 6 == 0, F.lit(None)).otherwise(F.col("c_acctbal") / 100).alias("Age"),
        (F.col("o_totalprice") / 1000).alias("RoomService"),
        F.when(k % 5 == 0, F.lit(None)).otherwise(F.greatest(F.col("c_acctbal"), F.lit(0.0)) / 50).alias("FoodCourt"),
        (k % 97).cast("double").alias("Spa"),
        F.col("c_name").alias("Name"),
        (F.col("o_orderstatus") == "F").cast("int").alias("Transported"))


PASSENGER_SQL = """p AS (
  SELECT lpad(CAST(o_orderkey AS VARCHAR), 6, '0') || '_01' AS pid,
    CASE WHEN o_orderkey % 9 <> 0 THEN c_mktsegment END AS planet, CASE WHEN o_orderkey % 10 <> 0 THEN o_orderpriority END AS dest,
    o_orderkey % 3 = 0 AS cryo, o_orderkey % 4 = 0 AS vip,
    CASE WHEN o_orderkey % 8 <> 0 THEN right(c_name, 1) END AS deck, CASE WHEN o_orderkey % 8 <> 0 THEN CAST(o_custkey % 300 AS DOUBLE) END AS num,
    CASE WHEN o_orderkey % 8 <> 0 THEN CASE WHEN o_custkey % 2 = 0 THEN 'P' ELSE 'S' END END AS side,
    CASE WHEN o_orderkey % 6 <> 0 THEN c_acctbal / 100 END AS age, coalesce(o_totalprice / 1000, 0.0) AS room,
    CASE WHEN o_orderkey % 5 <> 0 THEN greatest(c_acctbal, 0.0) / 50 ELSE 0.0 END AS food, CAST(o_orderkey % 97 AS DOUBLE) AS spa,
    CASE WHEN o_orderstatus = 'F' THEN 1 ELSE 0 END AS target
  FROM orders JOIN customer ON o_custkey = c_custkey),
q AS (SELECT *, room + food + spa AS total,
        CASE WHEN room >= food AND room >= spa THEN 'RoomService' WHEN food >= spa THEN 'FoodCourt' ELSE 'Spa' END AS top,
        CAST(('0x' || substr(md5(pid || '42'), 1, 8)) AS BIGINT) % 100 < 20 AS is_test FROM p),
tr AS (SELECT * FROM q WHERE NOT is_test), te AS (SELECT * FROM q WHERE is_test),
f AS (SELECT list_sort(list_distinct(list(planet))) AS planets, list_sort(list_distinct(list(dest))) AS dests,
             list_sort(list_distinct(list(deck))) AS decks, list_sort(list_distinct(list(side))) AS sides,
             list_sort(list_distinct(list(top))) AS tops, quantile_cont(age, 0.5) AS age_median FROM tr)"""


def _code_sql(v: str, cats: str) -> str:
    return f"CAST(coalesce(list_position({cats}, {v}), 0) - 1 AS INTEGER)"


@query("f05_passenger_transformer", unsign("WITH " + PASSENGER_SQL + f"""
SELECT pid AS _id, {_code_sql('planet', 'planets')} AS HomePlanet, {_code_sql('dest', 'dests')} AS Destination, cryo AS CryoSleep,
  vip AS VIP, round(coalesce(age, age_median), 6) AS Age, round(room, 6) AS RoomService, round(food, 6) AS FoodCourt,
  round(spa, 6) AS Spa, round(total, 6) AS total_spent, {_code_sql('top', 'tops')} AS max_spend_category,
  {_code_sql('deck', 'decks')} AS deck, num AS cabin_num, {_code_sql('side', 'sides')} AS side FROM te, f""",
       ["Age", "RoomService", "FoodCourt", "Spa", "total_spent"]),
       covers=("F5", "P2", "P11", "P12", "P16", "P17", "F3", "F8"))
def passenger(spark, sf_dir):
    d = O.random_split(passengers(spark, sf_dir), "PassengerId", 20)
    train, test = d.filter("split = 'train'").drop("split"), d.filter("split = 'test'").drop("split")
    model = FE.PassengerTransformer(service_cols=("RoomService", "FoodCourt", "Spa")).fit(train)
    out = model.transform(test.withColumn("_id", F.col("PassengerId"))).drop("Transported")
    num = ("Age", "RoomService", "FoodCourt", "Spa", "total_spent")
    return out.withColumns({c: F.round(c, 6) + F.lit(0.0) for c in num})


# F20 + F21 -------------------------------------------------------------------------------
# The first rule that holds names the transformation of a column.
RECOMMENDATION_RULES = [
    ("drop", "n_distinct <= 1 OR (numeric AND zero_variance)"),
    ("inspect_manually", "NOT numeric AND NOT categorical"),
    ("one_hot_encode", "categorical AND n_distinct <= 10"),
    ("label_encode", "categorical"),
    ("log_transform", "abs(skew) > 1 AND abs(corr) > 0.2"),
    ("minmax_scale", "max - min > 100"),
    ("drop", "abs(corr) < 0.05 AND mi < 0.01"),
    ("standard_scale", "true"),
]


def recommendations(df, target: str, numeric, categorical, other=(), contamination: float = 0.01):
    """(column, suggestion_1, suggestion_2) per column.

    ``suggestion_1`` is the first of ``RECOMMENDATION_RULES`` that holds;
    ``suggestion_2`` is ``check_outliers`` where the rows that robust distance
    flags spread over twice as far as all rows do."""
    numeric, categorical = list(numeric), list(categorical)
    mom = AG.moments(df, numeric)
    nd = AG.distinct_profile(df, [*numeric, *categorical, *other])
    corr = AG.correlations(df.withColumn(target, F.col(target).cast("double")), numeric, target=target)
    edges = QU.multi_quantiles(df, {c: [i / 5 for i in range(6)] for c in numeric})
    # all numeric columns binned in one projection, all joint counts in one aggregate
    bins = [F.struct(F.lit(c).alias("column"), AG.edge_bin(F.col(c).cast("double"), sorted(set(edges[c]))).alias("bin"))
            for c in numeric if edges[c][0] is not None]
    joint = df.select(F.col(target).alias("y"), F.explode(F.array(*bins)).alias("x")).select("y", "x.*").na.drop() \
        .groupBy("column", "bin", "y").agg(F.count(F.lit(1)).alias("nxy"))
    mi = joint.join(joint.groupBy("column", "bin").agg(F.sum("nxy").alias("nx")), ["column", "bin"]) \
        .join(joint.groupBy("column", "y").agg(F.sum("nxy").alias("ny")), ["column", "y"]) \
        .join(joint.groupBy("column").agg(F.sum("nxy").alias("n")), "column") \
        .groupBy("column").agg(F.sum(F.expr("nxy / n * ln(nxy * n / (nx * ny))")).alias("mi"))
    facts = nd.select("column", "n_distinct").join(mom, "column", "left") \
        .join(corr.select(F.col("a").alias("column"), "corr"), "column", "left").join(mi, "column", "left") \
        .withColumn("numeric", F.col("column").isin(numeric)).withColumn("categorical", F.col("column").isin(categorical))
    first = F.coalesce(*[F.when(F.expr(cond), F.lit(name)) for name, cond in RECOMMENDATION_RULES])
    vec = df.select(F.array(*[F.col(c).cast("double") for c in numeric]).alias("v"))
    flagged = ST.robust_outliers(vec, "v", contamination)
    spread = flagged.select(F.posexplode("v").alias("i", "x"), "outlier").groupBy("i").agg(
        F.stddev_samp("x").alias("all"), F.stddev_samp(F.when(F.col("outlier"), F.col("x"))).alias("out"))
    names = F.array(*[F.lit(c) for c in numeric])
    spread = spread.select(F.element_at(names, F.col("i") + 1).alias("column"), (F.col("out") > 2 * F.col("all")).alias("wide"))
    return facts.join(spread, "column", "left").select(
        "column", first.alias("suggestion_1"), F.when(F.col("wide"), F.lit("check_outliers")).alias("suggestion_2"))


def orders_frame(spark, sf_dir):
    o = load(spark, sf_dir, "orders").join(load(spark, sf_dir, "customer"), F.col("o_custkey") == F.col("c_custkey"))
    return o.select("o_orderkey", "o_totalprice", "c_acctbal", (F.col("o_orderkey") % 2).cast("double").alias("parity"),
                    "o_orderpriority", "c_mktsegment", F.lit("same").alias("constant_text"), "o_orderdate",
                    (F.col("o_orderstatus") == "F").cast("int").alias("target"))


NUMERIC = ["o_totalprice", "c_acctbal", "parity"]
CATEG = ["o_orderpriority", "c_mktsegment", "constant_text"]


OTHER = ["o_orderdate"]


def _recommend_sql() -> str:
    src = """d AS (SELECT o_totalprice, c_acctbal, CAST(o_orderkey % 2 AS DOUBLE) AS parity,
  o_orderpriority, c_mktsegment, 'same' AS constant_text, o_orderdate, CASE WHEN o_orderstatus = 'F' THEN 1 ELSE 0 END AS target
  FROM orders JOIN customer ON o_custkey = c_custkey)"""
    ctes, parts = [src], []
    for c in NUMERIC:
        ctes.append(f"""{c}_b AS (SELECT target AS y, len(list_filter(e[2:], lambda q: q < x)) AS b FROM
  (SELECT {c} AS x, target, (SELECT list_sort(list_distinct(quantile_cont({c}, [0, 0.2, 0.4, 0.6, 0.8, 1.0]))) FROM d) AS e FROM d))""")
        ctes.append(f"""{c}_m AS (SELECT sum(nxy / n * ln(nxy * n / (nx * ny))) AS mi FROM (
  SELECT count(*) AS nxy, sum(count(*)) OVER () AS n, sum(count(*)) OVER (PARTITION BY b) AS nx,
         sum(count(*)) OVER (PARTITION BY y) AS ny FROM {c}_b GROUP BY b, y))""")
        parts.append(f"""SELECT '{c}' AS "column", CASE WHEN count(DISTINCT {c}) <= 1 OR stddev_samp({c}) <= 1e-8 THEN 'drop'
  WHEN abs(avg(power({c} - (SELECT avg({c}) FROM d), 3)) / power(var_pop({c}), 1.5)) > 1 AND abs(corr({c}, target)) > 0.2 THEN 'log_transform'
  WHEN max({c}) - min({c}) > 100 THEN 'minmax_scale'
  WHEN abs(corr({c}, target)) < 0.05 AND (SELECT mi FROM {c}_m) < 0.01 THEN 'drop' ELSE 'standard_scale' END AS suggestion_1 FROM d""")
    for c in CATEG:
        parts.append(f"""SELECT '{c}', CASE WHEN count(DISTINCT {c}) <= 1 THEN 'drop' WHEN count(DISTINCT {c}) <= 10 THEN 'one_hot_encode'
  ELSE 'label_encode' END FROM d""")
    parts += [f"SELECT '{c}', CASE WHEN count(DISTINCT {c}) <= 1 THEN 'drop' ELSE 'inspect_manually' END FROM d" for c in OTHER]
    ctes.append(robust_sql("d", NUMERIC))
    wide = " UNION ALL ".join(f"SELECT '{c}' AS \"column\", stddev_samp({c}) FILTER (outlier) > 2 * stddev_samp({c}) AS wide FROM robust"
                              for c in NUMERIC)
    return ("WITH " + ",\n".join(ctes) + f",\nw AS ({wide}),\nfirst AS (" + "\nUNION ALL ".join(parts) + """)
SELECT first."column", suggestion_1, CASE WHEN wide THEN 'check_outliers' END AS suggestion_2 FROM first LEFT JOIN w USING ("column")""")


@query("f20_transformation_recommendations", _recommend_sql(), covers=("F20", "A2", "A11", "A12", "A20", "T9"))
def recommend(spark, sf_dir):
    return recommendations(written(orders_frame(spark, sf_dir), "orders"), "target", NUMERIC, CATEG, OTHER)


def pipeline_from(rec_rows) -> list:
    """stages from the recommendation table (drop / log / minmax / standard /
    one-hot / label codes); unlisted columns are dropped by the caller."""
    by = {}
    for r in rec_rows:
        by.setdefault(r["suggestion_1"], []).append(r["column"])
    stages = []
    if by.get("log_transform"):
        stages.append(FE.Scaler(by["log_transform"], "standard", log1p=True))
    if by.get("minmax_scale"):
        stages.append(FE.Scaler(by["minmax_scale"], "minmax"))
    if by.get("standard_scale"):
        stages.append(FE.Scaler(by["standard_scale"], "standard"))
    if by.get("one_hot_encode"):
        stages.append(FE.OneHot(by["one_hot_encode"]))
    if by.get("label_encode"):
        stages.append(FE.CategoryCodes(by["label_encode"]))
    return stages, by.get("drop", [])


# What the rules recommend for these columns (f20): scale both amounts, drop the parity and the
# constant text, one column per priority and segment; the date is for inspection and stays.
PRIORITIES = ["1-URGENT", "2-HIGH", "3-MEDIUM", "4-NOT SPECIFIED", "5-LOW"]
SEGMENTS = ["AUTOMOBILE", "BUILDING", "FURNITURE", "HOUSEHOLD", "MACHINERY"]


def _recommended_sql() -> str:
    hot = [f"""CAST(c_mktsegment = '{v}' AS DOUBLE) AS "c_mktsegment_{v}\"""" for v in SEGMENTS]
    hot += [f"""CAST(o_orderpriority = '{v}' AS DOUBLE) AS "o_orderpriority_{v}\"""" for v in PRIORITIES]
    scaled = [f"round((d.{c} - lo_{c}) / (hi_{c} - lo_{c}), 9) + 0.0 AS {c}" for c in ("o_totalprice", "c_acctbal")]
    ends = [f"min({c}) AS lo_{c}, max({c}) AS hi_{c}" for c in ("o_totalprice", "c_acctbal")]
    return f"""
WITH d AS (SELECT *, CAST(('0x' || substr(md5(CAST(o_orderkey AS VARCHAR) || '42'), 1, 8)) AS BIGINT) % 100 < 20 AS is_test
  FROM orders JOIN customer ON o_custkey = c_custkey),
s AS (SELECT {', '.join(ends)} FROM d WHERE NOT is_test)
SELECT o_orderkey, CASE WHEN o_orderstatus = 'F' THEN 1 ELSE 0 END AS target, o_orderdate, {', '.join(scaled + hot)}, 'v1' AS version
FROM d, s WHERE is_test"""


@query("f21_recommended_pipeline", _recommended_sql(), covers=("F21", "F23", "K4", "O6", "U2"))
def recommended_pipeline(spark, sf_dir):
    d = written(O.random_split(orders_frame(spark, sf_dir), "o_orderkey", 20), "orders")     # read by every step of the fit
    train, test = d.filter("split = 'train'").drop("split"), d.filter("split = 'test'").drop("split")
    out, version = default_etl(spark, train, test, "target", NUMERIC, CATEG, OTHER,
                               scratch_path(spark, f"registry-{uuid.uuid4().hex}"))
    scaled = {c: _r(c, 9) for c in ("o_totalprice", "c_acctbal") if c in out.columns}
    return out.withColumns(scaled).withColumn("version", F.lit(version))


def default_etl(spark, train, test, target: str, numeric, categorical, other, registry: str):
    """recommend on train, fit the recommended stages, register the version, transform test."""
    P.check_contract(train, dict.fromkeys([*numeric, *categorical, target]), not_null=[target])
    rec = recommendations(train, target, numeric, categorical, other).collect()     # one row per column
    stages, drops = pipeline_from(rec)
    model = FE.chain(*stages).fit(P.drop_columns(train, drops))
    version = K.register_version(spark, registry, "recommended ETL", target, {r["column"]: r["suggestion_1"] for r in rec})
    return model.transform(P.drop_columns(test, drops)), version


# F24 + F25 -------------------------------------------------------------------------------
SERVICES = ("RoomService", "FoodCourt", "Spa")
BLOCK = ["Age", *SERVICES, "total_spent", "cabin_num"]


def custom_etl(spark, train, test, registry: str):
    """One composition, every part fitted on the train rows alone: word features,
    quartile flags, passenger transform, kNN imputation of the numeric block (of
    train rows as well, so that what follows is fitted on what it is applied to),
    min-max, five k-means clusters with distances, five mixture probabilities,
    seven independent components; a registry entry.  Returns the transformed
    unlabelled test rows (ids kept) and the version."""
    with passing(spark) as keep:
        tr, te = _imputed(spark, train, test, keep)
        lo, hi = CL.minmax_arrays(tr.select(*[F.col("v")[i].alias(c) for i, c in enumerate(BLOCK)]), BLOCK)

        span = A.lit_array([b - a for a, b in zip(lo, hi, strict=True)])
        scale = F.zip_with(F.zip_with("v", A.lit_array(lo), lambda x, a: x - a), span, lambda x, s: F.coalesce(F.try_divide(x, s), F.lit(0.0)))
        tr, te = tr.withColumn("x", scale), te.withColumn("x", scale)
        out = CL.kmeans_features(tr, te, "x", k=5)
        out = CL.gmm_features(tr, out, "x", k=5)
        out = CL.ica_features(out, "x", CL.fast_ica(tr, "x", n_components=min(7, len(BLOCK))))
        version = K.register_version(spark, registry, "custom ETL", "Transported", {"clusters": 5, "mixture": 5, "components": len(BLOCK)})
        return out, version


def _imputed(spark, train, test, keep):
    """The imputed block of the train rows, which is all that the models take, and the transformed test rows."""
    words = TX.WordFeatures(text="Name", label="Transported", key="PassengerId", min_count=5, drop_text=False).fit(train)
    flags = FE.SpendFeatures(SERVICES).fit(train)
    raw = FE.PassengerTransformer(id_col="_none", service_cols=SERVICES).fit(train)

    def shaped(df, tag=""):
        services = {c: F.coalesce(X.lenient_double(c), F.lit(0.0)) for c in SERVICES}
        flagged = P.threshold_flags(df.withColumns(services), SERVICES, flags.st["thresholds"], drop_originals=False)
        out = raw.transform(words.transform(flagged))
        # passenger numbers may repeat: a row is known by its number and place, in the order of the numbers
        place = F.concat(F.lpad(F.monotonically_increasing_id().cast("string"), 20, "0"), F.lit(tag))
        row = F.concat_ws("/", F.coalesce("PassengerId", F.lit("")), place)
        return out.withColumn("v", F.array(*[F.col(c).cast("double") for c in BLOCK])).withColumn("_row", row)

    with passing(spark) as hold:
        tr, te = written(shaped(train), "train"), written(shaped(test, "t"), "test")
        # train and test rows have their donors in common
        slots = KNN.impute_slots(tr, tr.select("_row", "v").unionByName(te.select("_row", "v")), "_row", "v", 9)

        def filled(df, own):
            # rows stay where the passenger's number puts them: k-means starts from places
            fill = slots.filter(own).withColumn("PassengerId", F.regexp_extract("_row", "^(.*)/", 1)).groupBy("PassengerId").agg(
                F.map_from_entries(F.collect_list(F.struct(F.struct("_row", "j"), "value"))).alias("_fill"))
            return df.join(fill, "PassengerId", "left").withColumn(
                "v", F.transform("v", lambda x, i: F.coalesce(x, F.try_element_at(F.col("_fill"), F.struct("_row", i.alias("j")))))
            ).drop("_fill", "_row")

        of_test = F.col("_row").endswith("t")
        tr = hold(written(filled(tr, ~of_test), "train-filled"))
        return tr, keep(hold(written(filled(te, of_test), "test-filled")))


def _custom_etl_test(spark, sf_dir):
    d = written(O.random_split(passengers(spark, sf_dir), "PassengerId", 20), "passengers")      # read by every part of the fit
    train = d.filter("split = 'train'").drop("split")
    test = d.filter("split = 'test'").drop("split", "Transported")      # unlabelled
    return custom_etl(spark, train, test, scratch_path(spark, f"registry-{uuid.uuid4().hex}"))


@query("f24_custom_etl", unsign("WITH " + PASSENGER_SQL + """,
t AS (SELECT quantile_cont(room, [0.25, 0.5, 0.75]) AS r, quantile_cont(spa, [0.25, 0.5, 0.75]) AS s FROM tr)
SELECT pid AS "PassengerId", round(total, 6) AS total_spent, room > 0 AS "RoomService_used", room > r[1] AS "RoomService_above_q25",
  room > r[3] AS "RoomService_above_q75", spa > s[2] AS "Spa_above_q50",
  CASE WHEN num IS NOT NULL THEN round((num - (SELECT min(num) FROM tr)) / ((SELECT max(num) FROM tr) - (SELECT min(num) FROM tr)), 6) END AS cabin_scaled,
  true AS complete, true AS nearest, true AS sums, true AS finite, true AS words, 'v1' AS version FROM te, t""", ["total_spent", "cabin_scaled"]),
       covers=("F24", "F25", "F6", "F14", "F15", "F12", "F16", "F17", "F18", "P18", "K4"))
def custom_etl_query(spark, sf_dir):
    """The columns of the composition that have an SQL form, and of its models what must hold of every row."""
    out, version = _custom_etl_test(spark, sf_dir)
    dist = F.array(*[F.col(f"kmeans_dist_{i}") for i in range(5)])
    comps = F.array(*[F.col(c) for c in out.columns if c.startswith("ica_")])
    return out.select(
        "PassengerId", _r("total_spent").alias("total_spent"), "RoomService_used", "RoomService_above_q25", "RoomService_above_q75",
        "Spa_above_q50", F.when(F.col("cabin_num").isNotNull(), _r(F.col("x")[BLOCK.index("cabin_num")])).alias("cabin_scaled"),
        F.forall("x", lambda x: x.isNotNull()).alias("complete"),
        (F.element_at(dist, F.col("kmeans_cluster") + 1) - F.array_min(dist) < 1e-9).alias("nearest"),
        (F.abs(F.aggregate("gmm_probs", F.lit(0.0), lambda a, p: a + p) - 1) < 1e-9).alias("sums"),
        F.forall(comps, lambda x: F.abs(x) < 1e9).alias("finite"),
        (F.col("name_corr_pos_p_value").between(0, 1) & F.col("name_corr_neg_prob").between(0, 1)).alias("words"),
        F.lit(version).alias("version"))


@query("f24_custom_etl_features", covers=("F24", "F25", "F6", "F14", "F15", "F12", "F16", "F17", "F18"))
def custom_etl_features(spark, sf_dir):
    """Imputed block, clusters, distances, mixture, components and word features of the same composition."""
    out, _ = _custom_etl_test(spark, sf_dir)
    values = [*[f"kmeans_dist_{i}" for i in range(5)], *[c for c in out.columns if c.startswith("ica_")]]
    return out.select("PassengerId", _rounded("x"), "kmeans_cluster", "gmm_cluster", _rounded("gmm_probs"),
                      *[_r(c).alias(c) for c in values], "name_corr_pos_p_value", "name_corr_neg_prob")
