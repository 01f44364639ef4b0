"""Pairs of near points by cells equal a plain test of every pair, and their join is not broadcast."""

import random

from pyspark.sql import functions as F

from cartoscope.operators import spatial

KIND = "id int, section int, x double, y double"


def some_points(seed):
    rng = random.Random(seed)
    rows = [(i, rng.randint(0, 2), float(rng.randint(-70, 70)), float(rng.randint(-70, 70))) for i in range(250)]
    rows += [(250 + i, rng.randint(0, 2), rng.uniform(-70, 70), rng.uniform(-70, 70)) for i in range(100)]
    return [*rows, (400, 0, 20.0, 20.0), (401, 0, 20.0, 20.0), (402, 0, 40.0, 20.0), (403, 1, None, 1.0), (404, 1, float("nan"), 1.0), (405, 1, 1e18, 1.0), (406, 1, 1e18, 2.0)]


def near(p, q):
    return p[2] is not None and q[2] is not None and (p[2] - q[2]) ** 2 + (p[3] - q[3]) ** 2


def test_equal_to_every_pair(spark):
    rows, reach = some_points(1), 10
    points = spark.createDataFrame(rows, KIND)
    got = [(r.a, r.b) for r in spatial.proximity_pairs(points, reach).collect()]
    wanted = {(p[0], q[0]) for p in rows for q in rows if p[0] < q[0] and p[1] == q[1] and near(p, q) is not False and near(p, q) < reach**2}
    assert len(got) == len(set(got)) and set(got) == wanted and (400, 401) in wanted and (405, 406) in wanted
    others = some_points(2)
    for step in (0, 1):
        found = [(r.a, r.b) for r in spatial.candidate_pairs(points, spark.createDataFrame(others, KIND), reach, step).collect()]
        assert len(found) == len(set(found)) and set(found) == {(p[0], q[0]) for p in rows for q in others if p[1] + step == q[1] and near(p, q) is not False and near(p, q) <= reach**2}


def test_exploded_points_are_not_broadcast(spark, tmp_path):
    """The planner takes points for as small as their file."""
    spark.range(1000).select("id", F.lit(1).alias("section"), (F.col("id") % 100).alias("x"), F.floor(F.col("id") / 100).alias("y")).write.parquet(f"{tmp_path}/p")
    points = spark.read.parquet(f"{tmp_path}/p")
    for pairs in (spatial.proximity_pairs(points, 2), spatial.candidate_pairs(points, points, 2)):
        assert "Broadcast" not in pairs._jdf.queryExecution().executedPlan().toString()
    assert spatial._touched(points, 30).count() < 5 * 1000  # nine cells a point before
