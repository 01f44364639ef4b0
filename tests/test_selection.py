"""Percentiles by counted refinement equal those of one sorted buffer."""

import math
import random

import pytest
from pyspark.sql import functions as F

from cartoscope.operators import selection
from cartoscope.operators.selection import percentiles

SHARES = [0.0, 0.1, 0.25, 0.5, 0.9, 0.95, 1.0]


def table(spark):
    """Groups with a hot value, wide exponents, ties, one row, nulls only, and a null key."""
    rng = random.Random(5)
    rows = [("hot", 7.0 if rng.random() < 0.4 else rng.gauss(0, 1)) for _ in range(3000)]
    rows += [("wide", rng.choice([-1, 1]) * 10.0 ** rng.randint(-300, 300)) for _ in range(2000)]
    rows += [("ties", float(rng.randint(0, 3))) for _ in range(1500)]
    rows += [("one", 4.5), ("same", 2.0)] + [("same", 2.0)] * 900 + [("nulls", None)] * 5
    rows += [(None, float(k)) for k in range(700)] + [("hot", None)] * 50
    rng.shuffle(rows)
    return spark.createDataFrame(rows, "name string, v double").repartition(6)


def plain(df, keys):
    return {r[0]: r[1] for r in df.groupBy(*keys).agg(F.percentile("v", F.array(*[F.lit(p) for p in SHARES])).alias("p")).collect()}


@pytest.mark.parametrize("bound", [1, 40, 10**6])
def test_equal_to_sorting_whatever_the_bound(spark, bound):
    df = table(spark)
    got = {r.name: r.p for r in percentiles(df, ["name"], "v", SHARES, bound=bound).collect()}
    assert got == plain(df, ["name"])
    assert got["nulls"] is None


def test_no_range_above_the_bound_is_sorted(spark, monkeypatch):
    sizes = []
    kept = selection._sorted

    def watched(values, wanted):
        inside = wanted.select("g", "part").distinct()
        sizes.extend(r["count"] for r in values.where("v is not null").join(inside, ["g", "part"]).groupBy("g", "part").count().collect())
        return kept(values, wanted)

    monkeypatch.setattr(selection, "_sorted", watched)
    percentiles(table(spark), ["name"], "v", SHARES, bound=64).collect()
    assert sizes and max(sizes) <= 64


def test_without_keys_and_without_rows(spark):
    df = table(spark)
    (row,) = percentiles(df, [], "v", [0.5], bound=100).collect()
    assert row.p[0] == df.agg(F.percentile("v", F.lit(0.5))).first()[0]
    assert [r.p for r in percentiles(df.where("false"), [], "v", [0.5]).collect()] == [None]
    assert percentiles(df.where("false"), ["name"], "v", [0.5]).collect() == []


def test_nan_is_above_all_numbers(spark):
    df = spark.createDataFrame([(1, float(k) if k < 90 else math.nan) for k in range(100)], "name int, v double")
    p = percentiles(df, ["name"], "v", [0.5, 0.95], bound=8).first().p
    assert p[0] == 49.5 and math.isnan(p[1])


def test_clashing_names(spark):
    df = spark.createDataFrame([(1, 2, 3.0), (1, 2, 5.0)], "g int, part int, v double")
    assert [tuple(r) for r in percentiles(df, ["g", "part"], "v", [0.5], bound=1).collect()] == [(1, 2, [4.0])]
