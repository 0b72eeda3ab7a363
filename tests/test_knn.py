"""Exact k-NN under heavy pruning (many buckets, round two and edge cases)."""

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from kiln.operators import knn as KNN

spark_schema = StructType.fromDDL


def _data(spark, n=300, dims=4, holes=False, seed=5):
    rng = np.random.default_rng(seed)
    x = rng.normal(size=(n, dims))
    x[: n // 10, 0] *= 8  # a spread-out tail on the anchor axis
    rows = []
    for i in range(n):
        v = [float(a) for a in x[i]]
        if holes and i % 7 == 3:
            v[(i // 7) % dims] = None
        rows.append((i, v))
    return spark.createDataFrame(rows, "id long, v array<double>"), x


def test_neighbours_exact_with_small_buckets(spark):
    df, x = _data(spark)
    q = df.filter("id % 5 = 0")
    d = df.filter("id % 5 != 0").withColumnRenamed("id", "donor")
    got = KNN.neighbours(q, d, "id", "donor", "v", k=4, cells=12, block=8)
    got = {(r["id"], r["rank"]): r["donor"] for r in got.collect()}
    donors = [i for i in range(len(x)) if i % 5 != 0]
    for qi in range(0, len(x), 5):
        dist = sorted((float(np.sqrt(((x[qi] - x[j]) ** 2).sum())), j) for j in donors)
        for rank, (_, j) in enumerate(dist[:4], start=1):
            assert got[(qi, rank)] == j


def test_imputation_matches_brute_force(spark):
    df, _ = _data(spark, holes=True)
    train = df.filter("id % 3 != 0")
    data = df.filter("id % 3 = 0")
    got = {(r["id"], r["j"]): r["value"] for r in KNN.impute_slots(train, data, "id", "v", k=3, cells=12, block=8).collect()}
    tr = [(r["id"], r["v"]) for r in train.collect()]
    dims = 4
    means = [np.mean([v[j] for _, v in tr if v[j] is not None]) for j in range(dims)]
    for qid, qv in [(r["id"], r["v"]) for r in data.collect()]:
        for j in [j for j in range(dims) if qv[j] is None]:
            cands = []
            for did, dv in tr:
                if dv[j] is None:
                    continue
                both = [(a, b) for a, b in zip(qv, dv) if a is not None and b is not None]
                if not both:
                    continue
                dd = np.sqrt(dims / len(both) * sum((a - b) ** 2 for a, b in both))
                cands.append((dd, did, dv[j]))
            cands.sort()
            exp = np.mean([c[2] for c in cands[:3]]) if cands else means[j]
            assert abs(got[(qid, j)] - exp) < 1e-9


def test_donors_are_copied_to_the_blocks_that_visit_them(spark):
    rng = np.random.default_rng(9)
    centres = rng.uniform(-100, 100, (40, 3))
    x = centres[rng.integers(0, 40, 3000)] + rng.normal(0, 0.5, (3000, 3))
    df = spark.createDataFrame([(i, [float(a) for a in v]) for i, v in enumerate(x)], "id long, v array<double>")
    donors = df.filter("id % 3 != 0").select(F.col("id").alias("_dk"), F.col("v").alias("_v"))
    placed, tree = KNN._deal(donors, 3, 45, 40)
    q = KNN.deal_queries(df.filter("id % 3 = 0"), ["id"], "v", tree, 40)
    blocks = q.select("_qb", "_part").distinct().count()
    assert blocks >= 20
    sizes = {(r["_cell"], r["_block"]): r["count"] for r in placed.groupBy("_cell", "_block").count().collect()}
    assert sum(sizes.values()) == 2000 and max(sizes.values()) < 120
    for visits in (KNN._visits(q, tree), KNN._visits(q.withColumn("_kth", F.lit(2.0)), tree)):
        triples = {tuple(r) for r in visits.select(*KNN.TRIPLE).collect()}
        copied = KNN.visited_donors(placed, visits).count()
        assert copied == sum(sizes.get(t[2:], 0) for t in triples)
        assert copied < 2000 * blocks / 5               # every donor to every block would be five times as many


def test_neighbours_of_missing_empty_and_repeated_rows(spark):
    df, _ = _data(spark, n=40)
    donors = df.withColumnRenamed("id", "donor")
    assert KNN.neighbours(df, donors.limit(0), "id", "donor", "v", k=2).count() == 0
    assert KNN.neighbours(df.limit(0), donors, "id", "donor", "v", k=2).count() == 0
    same = spark.createDataFrame([(i, [1.0, 2.0]) for i in range(30)], "donor long, v array<double>")
    got = KNN.neighbours(spark.createDataFrame([(7, [1.0, 2.0])], "id long, v array<double>"), same, "id", "donor", "v", k=3, block=4)
    assert sorted((r["donor"], r["dist"], r["rank"]) for r in got.collect()) == [(0, 0.0, 1), (1, 0.0, 2), (2, 0.0, 3)]


def test_tree_bounds_never_exceed_the_distance():
    rng = np.random.default_rng(3)
    x = rng.normal(size=(400, 5))
    x[::9, 2] = np.nan
    tree = KNN.Cells(rng.normal(size=(30, 5)))
    cell = tree.nearest(x)
    stats = [{"_cell": c, "n": int((cell == c).sum()), "low": np.nanmin(x[cell == c], axis=0), "high": np.nanmax(x[cell == c], axis=0),
              "have": (~np.isnan(x[cell == c])).sum(axis=0),
              "far": float(np.nanmax(np.nan_to_num(KNN._distance(x[cell == c], np.repeat(tree.pivots[c:c + 1], (cell == c).sum(), 0)))))}
             for c in np.unique(cell)]
    tree.fill(stats, 7)
    q = np.vstack([rng.normal(size=(60, 5)) * 3, np.where(rng.random((60, 5)) < 0.3, np.nan, rng.normal(size=(60, 5)))])
    q = q[~np.isnan(q).all(axis=1)]
    dist = np.sqrt(KNN._squares(q, x))
    own = tree.number[cell]
    assert all(b.sum() >= 1 for b in tree.blocks)
    for limit in (0.5, 2.0, 5.0):
        row, at = tree.within(q, np.full(len(q), limit))
        seen = set(zip(row.tolist(), at.tolist()))
        near_row, near_donor = np.nonzero(dist <= limit)
        assert {(r, int(own[d])) for r, d in zip(near_row.tolist(), near_donor.tolist())} <= seen
    assert len(tree.within(q, np.full(len(q), 0.5))[0]) < len(q) * len(tree.blocks)


def test_visits_leave_in_small_batches_whatever_the_blocks(spark):
    rng = np.random.default_rng(4)
    pivots = rng.normal(size=(60, 16))
    tree = KNN.Cells(pivots)
    tree.fill([{"_cell": c, "n": 50, "low": [-5.0] * 16, "high": [5.0] * 16, "have": [50] * 16, "far": 9.0} for c in range(60)], 50)

    class Rows:
        schema = spark_schema("id long, _v array<double>, _near int, _qb int, _part int, _kth double")
        columns = schema.names

        def mapInArrow(self, run, ddl):
            return run

    x = rng.normal(size=(2000, 16))
    batch = pa.RecordBatch.from_arrays(
        [pa.array(range(2000)), pa.array(list(x)), pa.array(tree.nearest(x), pa.int32()), pa.array([0] * 2000, pa.int32()),
         pa.array([0] * 2000, pa.int32()), pa.array([99.0] * 2000)], names=["id", "_v", "_near", "_qb", "_part", "_kth"])
    sizes = [b.num_rows for b in KNN._visits(Rows(), tree)([batch])]
    assert sum(sizes) == 2000 * 59 and max(sizes) <= KNN.SENT


def test_scores_hold_few_distances_at_once(monkeypatch):
    rng = np.random.default_rng(8)
    x, y = rng.integers(0, 2, (300, 3)).astype(float), rng.integers(0, 2, (500, 3)).astype(float)     # many equal distances
    x[rng.random(x.shape) < 0.2] = y[rng.random(y.shape) < 0.2] = np.nan
    sizes, squares = [], KNN._squares

    def counted(a, b):
        sizes.append(len(a) * len(b))
        return squares(a, b)
    monkeypatch.setattr(KNN, "_squares", counted)
    monkeypatch.setattr(KNN, "PAIRS", 10_000)
    left = pa.table({"id": range(300), "_v": pa.array([[None if np.isnan(a) else a for a in v] for v in x], pa.list_(pa.float64())),
                     "_j": pa.array([[int(j) for j in np.flatnonzero(np.isnan(v))] for v in x], pa.list_(pa.int32()))})
    right = pa.table({"_dk": range(500), "_v": pa.array([[None if np.isnan(a) else a for a in v] for v in y], pa.list_(pa.float64()))})
    plain = {}
    for q in range(300):
        for j in np.flatnonzero(np.isnan(x[q])):
            d = squares(x[q:q + 1], y)[0]
            near = sorted((round(float(np.sqrt(d[i])), 9), i) for i in range(500) if np.isfinite(d[i]) and not np.isnan(y[i, j]))[:4]
            if near:
                plain[q, int(j)] = near
    far = {q: max(n[-1][0] for (p, _), n in plain.items() if p == q) for q, _ in plain}
    limits = pa.array([far.get(q, np.inf) if q % 3 else np.inf for q in range(300)])
    for table in (left, left.append_column("_kth", limits)):
        got = {}
        for r in KNN._score(4, "id", "_j")(table, right).to_pylist():
            got.setdefault((r["id"], r["_j"]), []).append((round(r["dist"], 9), r["_dk"]))
        assert got == plain
    assert sizes and max(sizes) <= 10_000


def test_cells_lie_apart_in_what_queries_have(spark, monkeypatch):
    """Queries without a widely spread coordinate visit the few blocks that are near in the others."""
    rng = np.random.default_rng(8)
    x = rng.uniform(size=(3000, 3)) * [1, 1, 1000]
    train = spark.createDataFrame([(i, [*map(float, v[:2]), None if i % 9 == 0 else float(v[2])]) for i, v in enumerate(x)],
                                  "id long, v array<double>")
    queries = rng.uniform(size=(100, 2))
    data = spark.createDataFrame([(i, [float(a), float(b), None]) for i, (a, b) in enumerate(queries)], "id long, v array<double>")
    visits, real = [], KNN.written

    def counted(df, name):
        out = real(df, name)
        if name == "visits":
            visits.append(out.count())
        return out
    monkeypatch.setattr(KNN, "written", counted)
    got = {r["id"]: r["value"] for r in KNN.impute_slots(train, data, "id", "v", k=3, block=40).collect()}
    assert sum(visits) < 1500           # of 7,500 pairs of a query and a block
    own = np.array([i for i in range(3000) if i % 9])
    for i, q in enumerate(queries):
        near = own[np.lexsort((own, ((x[own, :2] - q) ** 2).sum(axis=1)))[:3]]
        assert abs(got[i] - x[near, 2].mean()) < 1e-9


def test_imputation_where_no_donor_has_the_coordinate(spark):
    train = spark.createDataFrame([(i, [float(i), None]) for i in range(9)], "id long, v array<double>")
    data = spark.createDataFrame([(1, [0.5, None])], "id long, v array<double>")
    assert [tuple(r) for r in KNN.impute_slots(train, data, "id", "v", k=3).collect()] == [(1, 1, None)]


def test_squares_leave_out_coordinates_that_a_side_lacks():
    rng = np.random.default_rng(4)
    x, y = rng.normal(size=(20, 5)), rng.normal(size=(30, 5))
    x[:, 1], y[:, 3] = np.nan, np.nan
    for holes in (False, True):
        if holes:
            x[3, 0] = y[4, 2] = np.nan
        d = (x[:, None] - y) ** 2
        expected = np.nansum(d, axis=2) * 5 / (~np.isnan(d)).sum(axis=2)
        assert np.allclose(KNN._squares(x, y), expected)
    assert np.isinf(KNN._squares(np.full((2, 5), np.nan), y)).all()


def _tables(spark):
    from kiln.session import scratch_path
    import os
    at = scratch_path(spark, "")
    return {n for n in os.listdir(at)} if os.path.isdir(at) else set()


def test_waves_give_the_same_answers_and_leave_only_these(spark, monkeypatch):
    df, _ = _data(spark, holes=True)
    train = df.filter("id % 3 != 0")
    data = df.filter("id % 3 = 0").withColumn("id", F.when(F.col("id") % 30 == 3, 3).otherwise(F.col("id")))      # a key that repeats

    def rows():
        before = _tables(spark)
        near = KNN.neighbours(data.filter(F.forall("v", lambda x: x.isNotNull())), train.withColumnRenamed("id", "donor"),
                              "id", "donor", "v", k=4, cells=12, block=8)
        slots = KNN.impute_slots(train, data, "id", "v", k=3, cells=12, block=8)
        out = sorted(map(str, near.collect())), sorted((r["id"], r["j"], round(r["value"], 12)) for r in slots.collect())
        return out, {n.rpartition("-")[0] for n in _tables(spark) - before}, len(_tables(spark) - before)
    one, left, count = rows()
    assert left == {"neighbours"} and count == 2
    monkeypatch.setattr(KNN, "WAVE", 16)
    many, left, count = rows()
    assert many == one and left == {"neighbours"} and count > 6


def test_a_donor_block_is_copied_once_for_few_queries(spark, monkeypatch):
    """Queries of many blocks that visit the same donors are scored against one copy."""
    rng = np.random.default_rng(11)
    x = rng.uniform(size=(4020, 2))
    df = spark.createDataFrame([(i, [float(a) for a in v]) for i, v in enumerate(x)], "id long, v array<double>")
    copies, real = [], KNN.visited_donors

    def counted(placed, v):
        out = real(placed, v)
        copies.append(out.count())
        return out
    monkeypatch.setattr(KNN, "visited_donors", counted)
    got = KNN.neighbours(df.filter("id < 20"), df.filter("id >= 20").withColumnRenamed("id", "donor"), "id", "donor", "v", k=200, block=20)
    near = {}
    for r in got.collect():
        near.setdefault(r["id"], set()).add(r["donor"])
    for i in range(20):
        assert near[i] == set((20 + np.argsort(((x[20:] - x[i]) ** 2).sum(axis=1))[:200]).tolist())
    assert len(copies) == 2 and 0 < max(copies) <= 4000


def test_imputation_counts_neighbours_with_all_rows_of_their_key(spark):
    train = spark.createDataFrame([(1, [0.0, 10.0]), (1, [9.0, 30.0]), (2, [0.5, 5.0]), (None, [0.1, 99.0]), (3, [50.0, 70.0])],
                                  "id long, v array<double>")
    data = spark.createDataFrame([(8, [0.0, None]), (9, [50.0, None])], "id long, v array<double>")
    got = {r["id"]: r["value"] for r in KNN.impute_slots(train, data, "id", "v", k=3).collect()}
    # 8: row 1 with both rows of its key, row 2, the row without a key not; 9: rows 3, 1 (the second) and 2
    assert abs(got[8] - (10 + 30 + 5) / 3) < 1e-12 and abs(got[9] - (70 + 10 + 30 + 5) / 4) < 1e-12
