"""The interval join against a plain one."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from kiln.operators import joins as J


def _plain(points, intervals):
    return sorted((p[1], i[1]) for p in points for i in intervals
                  if p[0] == i[0] and None not in (p[0], p[2], i[2], i[3]) and i[2] <= p[2] <= i[3])


@pytest.mark.parametrize("scale", [1.0, 1e-9, 1e15])
def test_interval_join_equals_a_plain_join(spark, scale):
    rng = random.Random(4)
    points = [(rng.choice(["a", "b", None]), i, rng.choice([None, 0.0, rng.uniform(-50, 50) * scale, float(rng.randint(-5, 5))]))
              for i in range(300)]
    intervals = [("a", 1000 + i, x, x + rng.choice([0.0, 0.5, 3.0, 40.0, 1000.0]) * scale)
                 for i, x in enumerate(rng.uniform(-60, 60) * scale for _ in range(60))]
    inf = float("inf")
    intervals += [("b", 2000, -inf, inf), ("b", 2001, 0.0, inf), ("b", 2002, -inf, 0.0), ("a", 2003, 1.0, 1.0), ("a", 2004, 5.0, 1.0),
                  ("a", 2005, None, 3.0), (None, 2006, -1.0, 1.0), ("a", 2007, -0.0, 0.0), ("b", 2008, -1e18, 1e18)]
    p = spark.createDataFrame(points, "k string, pid int, x double")
    i = spark.createDataFrame(intervals, "k string, iid int, s double, e double")
    got = sorted((r["pid"], r["iid"]) for r in J.interval_join(p, i, ["k"], "x", "s", "e").collect())
    assert got == _plain(points, intervals)
    assert J.interval_join(p, i.limit(0), ["k"], "x", "s", "e").count() == 0
    assert J.interval_join(p.limit(0), i, ["k"], "x", "s", "e").count() == 0


def test_a_long_interval_makes_few_rows(spark):
    i = spark.createDataFrame([("a", float(x), float(x + n)) for x in (0.3, 7.0, -1e6) for n in (1e-6, 1.0, 1e6, 1e12)],
                              "k string, s double, e double")
    assert max(r["count"] for r in J.dyadic_nodes(i, "s", "e").groupBy("s", "e").count().collect()) <= 3
    p = spark.range(2_000).select(F.lit("a").alias("k"), F.col("id").cast("double").alias("x"))
    long = spark.createDataFrame([("a", 500.0, 1_000_500.0)], "k string, s double, e double")
    assert J.interval_join(p, long, ["k"], "x", "s", "e").count() == 1_500


def test_interval_join_of_times(spark):
    day = dt.datetime(2024, 1, 1)
    p = spark.createDataFrame([(1, day + dt.timedelta(hours=h)) for h in range(48)], "k int, t timestamp")
    i = spark.createDataFrame([(1, day + dt.timedelta(hours=9), day + dt.timedelta(hours=17))], "k int, s timestamp, e timestamp")
    assert J.interval_join(p, i, ["k"], "t", "s", "e").count() == 9
    d = spark.createDataFrame([(1, dt.date(2024, 1, n)) for n in range(1, 20)], "k int, t date")
    i = spark.createDataFrame([(1, dt.date(2024, 1, 3), dt.date(2024, 1, 5))], "k int, s date, e date")
    assert J.interval_join(d, i, ["k"], "t", "s", "e").count() == 3
