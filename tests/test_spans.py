"""Discs and erosion by runs equal a pixel-by-pixel count."""

import math
import random

import pyarrow as pa
import pytest

from cartoscope.operators.pixels import border_band, draw_discs, united


@pytest.mark.parametrize("radius", [0, 1, 4, 9])
def test_discs(spark, radius):
    rng = random.Random(radius)
    points = [(rng.randint(1, 2), rng.randint(-20, 20), rng.randint(-20, 20)) for _ in range(60)]
    got = [tuple(r) for r in draw_discs(spark.createDataFrame(points, "section int, x long, y long"), radius).collect()]
    assert len(got) == len(set(got))
    around = range(-radius, radius + 1)
    assert set(got) == {(s, y + i, x + j) for s, x, y in points for i in around for j in around if i * i + j * j <= radius * radius}


@pytest.mark.parametrize("radius", [1, 2, 5])
def test_border_band(spark, radius):
    rng = random.Random(radius)
    mask = {(i, r, c) for i in (1, 2) for r in range(25) for c in range(30) if rng.random() > 0.01 * i}
    got = {tuple(r) for r in border_band(spark.createDataFrame(sorted(mask), "image int, row int, col int"), radius).collect()}
    around = range(-radius, radius + 1)
    inner = {(i, r, c) for i, r, c in mask if all((i, r + a, c + b) in mask for a in around for b in around)}
    assert inner and got == mask - inner


def test_united_runs(spark):
    runs = [(1, 0, 9), (1, 2, 3), (1, 10, 12), (1, 14, 14), (1, 0, 9), (2, 5, 5)]
    got = {tuple(r) for r in united(spark.createDataFrame(runs, "k int, first int, last int"), ["k"]).collect()}
    assert got == {(1, 0, 12), (1, 14, 14), (2, 5, 5)}
    empty = spark.createDataFrame([], "section int, x long, y long")
    assert draw_discs(empty, 3).collect() == []


def test_runs_of_polygons(spark, monkeypatch):
    from cartoscope.operators import pixels as X
    from cartoscope.operators.spatial import polygon_edges

    rng = random.Random(5)
    corners = {k: [(rng.randint(-30, 60), rng.randint(-30, 60)) for _ in range(rng.randint(1, 9))] for k in range(40)}
    edges = polygon_edges(spark.createDataFrame([(k, 1, i, x, y) for k, c in corners.items() for i, (x, y) in enumerate(c)], "polygon long, section int, point_order int, x long, y long"))
    want = set()
    for k, c in corners.items():
        for row in range(-40, 70):
            at = row + 0.5
            cuts = sorted(x + (at - y) * (x2 - x) / (y2 - y) for (x, y), (x2, y2) in zip(c, c[1:] + c[:1]) if min(y, y2) < at <= max(y, y2))
            want |= {(k, 1, row, col) for a, b in zip(cuts[::2], cuts[1::2]) for col in range(math.ceil(a - 0.5), math.ceil(b - 0.5))}
    plan = X.fill_runs(edges)._jdf.queryExecution().optimizedPlan().toString()
    assert "Generate" not in plan  # neither crossings nor pixels are rows of a sort
    assert {tuple(r) for r in X.fill_polygons(edges).collect()} == want
    batch = edges.where("y <> y2").toPandas()
    lists = batch.groupby(["polygon", "section"])[["x", "y", "x2", "y2"]].apply(lambda g: g.astype(float).to_dict("records")).reset_index(name="e")
    monkeypatch.setattr(X, "CROSSINGS", 50)  # chunks, and bands of one polygon
    small = [r for b in X._runs(iter([pa.RecordBatch.from_pandas(lists)])) for r in b.to_pylist()]
    assert {(r["polygon"], 1, r["row"], col) for r in small for col in range(r["first"], r["last"] + 1)} == want
