"""Interval numbers of trees against a walk in Python."""

import collections

import numpy as np
import pytest
from pyspark.sql import functions as F

from cartoscope.operators import tree

SCHEMA = "id string, parent_id string"


def descendants(rows):
    """Depth below each ancestor: {ancestor: {id: depth}}."""
    parent = {i: p for i, p in rows if i is not None}
    out = collections.defaultdict(dict)
    for i in parent:
        at, depth = i, 0
        while at in parent:
            out[at][i] = depth
            at, depth = parent[at], depth + 1
    return out


def random_tree(rng, n):
    """A deep branch, a node with many children, and two roots, one without a row for its parent."""
    rows = [("r", None), ("s", "gone"), ("t", None)] + [("deep0", "r")] + [(f"deep{i}", f"deep{i - 1}") for i in range(1, 40)]
    rows += [(f"wide{i}", "deep7") for i in range(90)]
    names = [i for i, _ in rows]
    for i in range(n):
        names.append(f"x{i}")
        rows.append((f"x{i}", names[int(rng.integers(0, len(names) - 1))]))
    return rows


@pytest.fixture(scope="module")
def given():
    return random_tree(np.random.default_rng(10), 150)


def test_ranges_are_the_descendants(spark, given):
    df = spark.createDataFrame([*given, (None, "r")], SCHEMA).repartition(3)
    got = {r.id: r for r in tree.intervals(df).collect()}
    under = descendants(given)
    assert sorted(r.first for r in got.values()) == list(range(len(given)))
    for a, r in got.items():
        assert {i for i, x in got.items() if r.first <= x.first <= r.last} == set(under[a]), a
        assert all(got[i].depth == r.depth + d for i, d in under[a].items())
    assert {got[i].depth for i in ("r", "s", "t")} == {0}


def test_levels_sums_and_nearest(spark, given):
    rng = np.random.default_rng(1)
    df = spark.createDataFrame(given, SCHEMA)
    under = descendants(given)
    numbered = tree.intervals(df)
    assert {(r.id, r.depth) for r in tree.within_levels(numbered, "deep5", 3).collect()} == {(i, d) for i, d in under["deep5"].items() if 1 <= d <= 3}
    assert tree.within_levels(numbered, "nobody", 3).collect() == []
    some = [(given[int(k)][0], int(v), float(v) / 4) for k, v in zip(rng.integers(0, len(given), 300), rng.integers(-5, 50, 300))] + [("gone", 7, 1.0), (None, 7, 1.0)]
    values = spark.createDataFrame(some, "id string, n long, w double")
    got = {r.id: (r.n, r.w) for r in tree.subtree_sums(numbered, values, ["n", "w"]).collect()}
    assert got == {a: (sum(n for i, n, _ in some if i in below), sum(w for i, _, w in some if i in below)) for a, below in under.items() if a in dict(given)}
    chosen = {"r", "deep3", "deep20", "x1", "x7", "t", "nobody"}
    near = {r.id: r.chosen for r in tree.nearest_chosen(df, spark.createDataFrame([(c,) for c in chosen], "id string")).collect()}
    expected = {}
    for i, _ in given:
        above = [(below[i], a) for a, below in under.items() if i in below and a in chosen]
        expected[i] = min(above)[1] if above else None
    assert near == expected


def test_sums_cross_blocks(spark, given, monkeypatch):
    monkeypatch.setattr(tree, "BLOCK", 7)
    monkeypatch.setattr(tree, "SALTS", 3)
    numbered = tree.intervals(spark.createDataFrame(given, SCHEMA))
    ones = spark.createDataFrame([(i, 1) for i, _ in given], "id string, n long")
    assert {r.id: r.n for r in tree.subtree_sums(numbered, ones, ["n"]).collect()} == {r.id: r.last - r.first + 1 for r in numbered.collect()}


@pytest.mark.parametrize("rows", [[("a", "b"), ("b", "a")], [("a", "b"), ("b", "c"), ("c", "a"), ("d", "a"), ("r", None)], [("a", "a")]])
def test_circles(spark, rows):
    df = spark.createDataFrame(rows, SCHEMA)
    with pytest.raises(ValueError):
        tree.intervals(df)
    with pytest.raises(ValueError):
        tree.nearest_chosen(df, df.limit(0).select("id"))


def test_small_trees(spark):
    none = spark.createDataFrame([], SCHEMA)
    assert tree.intervals(none).collect() == []
    assert tree.nearest_chosen(none, none.select("id")).collect() == []
    assert [tuple(r) for r in tree.intervals(spark.createDataFrame([("a", None)], SCHEMA)).collect()] == [("a", 0, 0, 0)]
    with pytest.raises(ValueError):
        tree.intervals(spark.createDataFrame([("a", None), ("a", None)], SCHEMA))
    numbers = spark.createDataFrame([(3, 0), (1, 3), (2, 3)], "id long, parent_id long")
    assert [(r.id, r.first, r.last) for r in tree.intervals(numbers).orderBy("first").collect()][0] == (3, 0, 2)
    assert numbers.where(F.col("id") > 0).count() == 3
