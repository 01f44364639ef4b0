"""Greedy matching equals the sorted loop over all pairs, in components and in rounds."""

import random

import pytest
from pyspark.sql import functions as F

from cartoscope.operators import groups
from cartoscope.operators.groups import greedy_match


def looped(pairs):
    used_a, used_b, out = set(), set(), set()
    for d, a, b in sorted((d, a, b) for a, b, d in pairs):
        if a not in used_a and b not in used_b:
            used_a.add(a)
            used_b.add(b)
            out.add((a, b, d))
    return out


@pytest.mark.parametrize("most", [1, 8, 10**6])
def test_equal_to_the_sorted_loop(spark, most):
    rng = random.Random(9)
    pairs = list({(rng.randint(0, 60), rng.randint(0, 60)): rng.randint(0, 9) / 2 for _ in range(90)}.items())
    pairs = [(a, b, d) for (a, b), d in pairs]  # many ties, several components
    df = spark.createDataFrame(pairs, "t long, p long, far double").repartition(5)
    got = greedy_match(df, "t", "p", "far", most=most)
    assert got.columns == ["t", "p", "far"]
    assert {tuple(r) for r in got.collect()} == looped(pairs)


def test_a_long_chain_takes_no_rounds(spark, monkeypatch):
    def never(pairs):
        raise AssertionError("rounds on a small component")

    monkeypatch.setattr(groups, "_rounds", never)
    n = 10_000  # every pair is closer than the one before, so only the last is best on both sides at first
    ids = spark.range(n)
    steps = ids.select(F.floor((F.col("id") + 1) / 2).alias("a"), F.floor(F.col("id") / 2).alias("b"), (n - F.col("id")).cast("double").alias("d2"))
    got = {(r.a, r.b) for r in greedy_match(steps).collect()}
    assert got == {(a, b) for a, b, _ in looped([((k + 1) // 2, k // 2, float(n - k)) for k in range(n)])}
    assert len(got) == n // 2


def test_nulls_repeats_strings_and_empty(spark):
    rows = [("x", "x", 2.0), ("x", "x", 1.0), ("x", "y", 1.5), ("z", "y", 3.0), (None, "y", 0.0), ("z", None, 0.0), ("q", "r", None)]
    df = spark.createDataFrame(rows, "a string, b string, d2 double")
    assert {tuple(r) for r in greedy_match(df).collect()} == {("x", "x", 1.0), ("z", "y", 3.0)}
    assert greedy_match(df.where("false")).collect() == []
