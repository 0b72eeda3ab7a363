"""k-nearest-neighbour queries (J12, M6, F6) on ``embeddings`` (all 64
dimensions), donors = hash-split train rows, queries = test rows."""

from __future__ import annotations

from pyspark.sql import functions as F

from kiln.operators import knn as KNN
from kiln.operators import splits as O
from kiln.plans.registry import query
from kiln.plans.sqlkit import unsign
from kiln.tables import load

DIMS = 64
K = 5


def _split(spark, sf_dir, holes: bool = False):
    e = load(spark, sf_dir, "embeddings")
    vals = []
    for i in range(DIMS):
        v = F.col("embedding")[i].cast("double")
        if holes:
            v = F.when((F.col("vec_id") + i) % 11 == 0, F.lit(None)).otherwise(v)
        vals.append(v)
    d = e.select("vec_id", "label", F.array(*vals).alias("v"))
    d = O.random_split(d, "vec_id", 20)
    return d.filter("split = 'train'").drop("split"), d.filter("split = 'test'").drop("split")


def _base_sql(holes: bool) -> str:
    vals = []
    for i in range(DIMS):
        v = f"CAST(embedding[{i + 1}] AS DOUBLE)"
        if holes:
            v = f"CASE WHEN (vec_id + {i}) % 11 = 0 THEN NULL ELSE {v} END"
        vals.append(v)
    return f"""d AS (SELECT vec_id, label, [{', '.join(vals)}] AS v,
       CAST(('0x' || substr(md5(CAST(vec_id AS VARCHAR) || '42'), 1, 8)) AS BIGINT) % 100 < 20 AS is_test FROM embeddings),
tr AS (SELECT * FROM d WHERE NOT is_test), te AS (SELECT * FROM d WHERE is_test)"""


PAIRS_SQL = "WITH " + _base_sql(False) + f""",
p AS (SELECT te.vec_id AS q, tr.vec_id AS donor, tr.label AS y,
             sqrt(list_sum(list_transform(list_zip(te.v, tr.v), lambda z: (z[1] - z[2]) * (z[1] - z[2])))) AS dist
      FROM te, tr),
r AS (SELECT *, row_number() OVER (PARTITION BY q ORDER BY dist, donor) AS rank FROM p)"""


@query("j12_knn_join", unsign(PAIRS_SQL + f"""
SELECT q AS vec_id, donor, round(dist, 9) AS dist, CAST(rank AS INTEGER) AS rank FROM r WHERE rank <= {K}""",
                              ["dist"]), covers=("J12",))
def knn_join(spark, sf_dir):
    train, test = _split(spark, sf_dir)
    nb = KNN.neighbours(test, train.withColumnRenamed("vec_id", "donor"), "vec_id", "donor", "v", K)
    return nb.select("vec_id", "donor", (F.round("dist", 9) + F.lit(0.0)).alias("dist"),
                     F.col("rank").cast("int").alias("rank"))


@query("m06_knn_classifier", PAIRS_SQL + f""",
v AS (SELECT q, y, count(*) AS votes FROM r WHERE rank <= {K} GROUP BY 1, 2)
SELECT q AS vec_id, arg_min(y, (-votes, y)) AS prediction FROM v GROUP BY q""", covers=("M6",))
def knn_classifier(spark, sf_dir):
    train, test = _split(spark, sf_dir)
    return KNN.knn_predict(train, test, "vec_id", "v", "label", K)


@query("m06_knn_distance_weights", PAIRS_SQL + f""",
w AS (SELECT q, y, CASE WHEN min(dist) OVER (PARTITION BY q) = 0 THEN CAST(dist = 0 AS DOUBLE) ELSE 1 / dist END AS w
      FROM r WHERE rank <= {K}),
v AS (SELECT q, y, sum(w) AS votes FROM w GROUP BY 1, 2)
SELECT q AS vec_id, arg_min(y, (-votes, y)) AS prediction FROM v GROUP BY q""", covers=("M6",))
def knn_distance_weights(spark, sf_dir):
    train, test = _split(spark, sf_dir)
    return KNN.knn_predict(train, test, "vec_id", "v", "label", K, weights="distance")


@query("m06_knn_regression", unsign(PAIRS_SQL + f"""
SELECT q AS vec_id, round(avg(y), 9) AS prediction FROM r WHERE rank <= {K} GROUP BY q""", ["prediction"]), covers=("M6",))
def knn_regression(spark, sf_dir):
    train, test = _split(spark, sf_dir)
    return KNN.knn_predict(train, test, "vec_id", "v", "label", K, regression=True).select(
        "vec_id", (F.round("prediction", 9) + F.lit(0.0)).alias("prediction"))


IMPUTE_K = 9


@query("f06_knn_imputation", unsign("WITH " + _base_sql(True) + f""",
m AS (SELECT [{', '.join(f'avg(v[{i + 1}])' for i in range(DIMS))}] AS means FROM tr),
miss AS (SELECT vec_id, v, unnest(list_filter(range({DIMS}), lambda i: v[i + 1] IS NULL)) AS j FROM te),
pr AS (SELECT miss.vec_id, miss.j, tr.vec_id AS donor, tr.v[miss.j + 1] AS y,
              list_filter(list_zip(miss.v, tr.v), lambda z: z[1] IS NOT NULL AND z[2] IS NOT NULL) AS pb
       FROM miss, tr WHERE tr.v[miss.j + 1] IS NOT NULL),
ds AS (SELECT vec_id, j, donor, y, sqrt({DIMS}.0 / len(pb) * list_sum(list_transform(pb, lambda z: (z[1] - z[2]) * (z[1] - z[2])))) AS dist
       FROM pr WHERE len(pb) > 0),
rk AS (SELECT *, row_number() OVER (PARTITION BY vec_id, j ORDER BY dist, donor) AS rank FROM ds),
f AS (SELECT vec_id, j, avg(y) AS value FROM rk WHERE rank <= {IMPUTE_K} GROUP BY 1, 2)
SELECT miss.vec_id, CAST(miss.j AS INTEGER) AS j, round(coalesce(f.value, means[miss.j + 1]), 9) AS value
FROM miss LEFT JOIN f USING (vec_id, j), m""", ["value"]), covers=("F6", "J12"))
def knn_imputation(spark, sf_dir):
    train, test = _split(spark, sf_dir, holes=True)
    out = KNN.impute_slots(train, test, "vec_id", "v", IMPUTE_K)
    return out.select("vec_id", F.col("j").cast("int").alias("j"), (F.round("value", 9) + F.lit(0.0)).alias("value"))
