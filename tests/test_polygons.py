"""Points in polygons by cells equal a plain even-odd test of every point and edge."""

import random
import re

import pytest

from cartoscope.operators import spatial


def inside(x, y, corners):
    odd = False
    for (ax, ay), (bx, by) in zip(corners, corners[1:] + corners[:1]):
        cross = (x - ax) * (by - ay) - (y - ay) * (bx - ax)
        if cross == 0 and min(ax, bx) <= x <= max(ax, bx) and min(ay, by) <= y <= max(ay, by):
            return False
        if (ay > y) != (by > y) and ((cross < 0) if by > ay else (cross > 0)):
            odd = not odd
    return odd


def shapes():
    rng = random.Random(3)
    out = {k: [(rng.randint(-40, 90), rng.randint(-40, 90)) for _ in range(rng.randint(3, 12))] for k in range(1, 25)}
    out[30] = [(0, 0), (64, 0), (64, 64), (0, 64)]  # edges on the borders of cells
    out[31] = [(-64, -64), (128, -64), (128, 128), (-64, 128)]
    out[32] = [(0, 0), (50, 50)]  # encloses nothing
    out[33] = [(5, 5)]
    out[34] = [(0, 0), (60, 0), (60, 60), (0, 60), (0, 0), (20, 20), (40, 20), (40, 40), (20, 40), (20, 20)]  # a hole
    out[35] = [(10.5, 3.25), (70.125, 3.25), (70.125, 3.25), (33.3, 88.8)]  # a repeated vertex
    return out


@pytest.mark.parametrize("cell", [64, 7.5, 16])
def test_equal_to_every_point_and_edge(spark, cell):
    polygons = shapes()
    vertices = spark.createDataFrame([(k, k % 2, i, float(x), float(y)) for k, c in polygons.items() for i, (x, y) in enumerate(c)], "polygon int, section int, point_order int, x double, y double")
    rng = random.Random(4)
    points = [(i, i % 2, float(rng.randint(-45, 95)), float(rng.randint(-45, 95))) for i in range(300)]
    points += [(300 + i, i % 2, rng.uniform(-45, 95), rng.uniform(-45, 95)) for i in range(200)]
    got = {(r.id, r.polygon) for r in spatial.in_polygons(spark.createDataFrame([*points, (900, 0, None, 3.0)], "id int, section int, x double, y double"), vertices, cell).collect()}
    assert got == {(i, k) for i, s, x, y in points for k, c in polygons.items() if k % 2 == s and inside(x, y, c)}


def test_cells_inside_hold_no_edges(spark):
    square = spark.createDataFrame([(1, 1, i, x, y) for i, (x, y) in enumerate([(0.0, 0.0), (1000.0, 0.0), (1000.0, 1000.0), (0.0, 1000.0)])], "polygon int, section int, point_order int, x double, y double")
    cells = spatial.polygon_cells(square, 100).collect()
    within = [c for c in cells if 0 < c["__cx"] < 9 and 0 < c["__cy"] < 9]
    assert len(within) == 64 and all(c.times == 1 and c.x is None for c in within)


def test_empty_tables(spark):
    vertices = spark.createDataFrame([], "polygon int, section int, point_order int, x double, y double")
    points = spark.createDataFrame([(1, 1, 2.0, 3.0)], "id int, section int, x double, y double")
    assert spatial.in_polygons(points, vertices).collect() == []


def test_in_all_polygons_asks_only_points_of_shared_cells(spark, monkeypatch):
    square = lambda a, b: [(a, a), (b, a), (b, b), (a, b)]
    corners = {1: square(0, 200), 2: square(100, 300), 3: [(150, 150), (160, 160)]}
    vertices = spark.createDataFrame([(k, 1, i, float(x), float(y)) for k, c in corners.items() for i, (x, y) in enumerate(c)], "polygon int, section int, point_order int, x double, y double")
    points = spark.createDataFrame([(i, 1, float(i), float(i)) for i in range(1, 300)] + [(900, 2, 150.0, 150.0), (901, 1, None, 1.0)], "id int, section int, x double, y double")
    asked, plain = [], spatial.in_polygons
    monkeypatch.setattr(spatial, "in_polygons", lambda p, *more: asked.append(p.count()) or plain(p, *more))
    got = sorted(r.id for r in spatial.polygon_intersection(points, vertices, 20).collect())
    assert got == list(range(101, 200)) and asked[0] <= 121


def test_no_pair_of_a_point_and_a_polygon_is_shuffled(spark):
    corners = shapes()
    vertices = spark.createDataFrame([(k, k % 2, i, float(x), float(y)) for k, c in corners.items() for i, (x, y) in enumerate(c)], "polygon int, section int, point_order int, x double, y double")
    points = spark.createDataFrame([(i, i % 2, float(i % 97 - 20), float(i % 89 - 20)) for i in range(400)], "id int, section int, x double, y double")
    pairs = spatial.in_polygons(points, vertices)
    some = spatial.polygon_union(points, vertices)
    for df in (pairs, some):
        plan = df._jdf.queryExecution().optimizedPlan().toString()
        assert plan.index("Join") < plan.index("Aggregate")  # nothing is grouped behind the join
    want = {(r.id, k) for r in points.collect() for k, c in corners.items() if k % 2 == r.section and inside(r.x, r.y, c)}
    assert {(r.id, r.polygon) for r in pairs.collect()} == want
    assert sorted(r.id for r in some.collect()) == sorted({i for i, _ in want})


def test_no_polygon_is_cut_where_no_point_is_in_all_boxes(spark, monkeypatch):
    square = lambda a, b: [(a, a), (b, a), (b, b), (a, b)]
    corners = {1: square(0, 100), 2: square(100, 300), 3: [(500, 500), (600, 600)]}
    vertices = spark.createDataFrame([(k, 1, i, float(x), float(y)) for k, c in corners.items() for i, (x, y) in enumerate(c)], "polygon int, section int, point_order int, x double, y double")
    points = spark.createDataFrame([(i, 1, float(i), float(i)) for i in range(300)] + [(900, 2, 150.0, 150.0), (901, 1, None, 1.0)], "id int, section int, x double, y double")

    def cut(*_, **__):
        raise AssertionError("a polygon was cut")

    monkeypatch.setattr(spatial, "_parts", cut)
    assert spatial.polygon_intersection(points, vertices, 20).collect() == []


def test_a_place_is_asked_once_and_in_compiled_code(spark, monkeypatch, capsys):
    """Points of one place share its answer; the join with its test is one method that the virtual machine compiles."""
    monkeypatch.setattr(spatial, "IDS", 7)
    rng = random.Random(5)
    corners = {**shapes(), 50: [(rng.randint(-40, 90), rng.randint(-40, 90)) for _ in range(60)], 51: [(0, 0), (50, 50), None, (60, 0), (10, 80)]}  # many edges in a cell, and a gap
    vertices = spark.createDataFrame([(k, k % 2, i, float(c[0]) if c else None, float(c[1]) if c else None) for k, v in corners.items() for i, c in enumerate(v)], "polygon int, section int, point_order int, x double, y double")
    points = [(i, i % 2, float(i % 10 * 9 - 10), float(i % 7 * 12 - 10)) for i in range(700)]
    pairs = spatial.in_polygons(spark.createDataFrame(points, "id int, section int, x double, y double"), vertices, 32)
    closed = {k: v for k, v in corners.items() if None not in v}
    got = {(r.id, r.polygon) for r in pairs.where("polygon <> 51").collect()}
    assert got == {(i, k) for i, s, x, y in points for k, c in closed.items() if k % 2 == s and inside(x, y, c)}
    assert "explode(ids" in pairs._jdf.queryExecution().optimizedPlan().toString()
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        capsys.readouterr()
        spatial.in_polygons(spark.createDataFrame(points, "id int, section int, x double, y double"), vertices).explain("codegen")
        code = capsys.readouterr().out
    finally:
        spark.conf.unset("spark.sql.adaptive.enabled")
    assert re.search(r"\*\(\d+\) SortMergeJoin", code)
    assert max(int(n) for n in re.findall(r"maxMethodCodeSize:(\d+)", code)) < 8000


def test_polygons_are_cut_only_into_cells_of_places_that_are_left(spark, monkeypatch):
    monkeypatch.setattr(spatial, "FIRST", 2, raising=False)
    corners = {k: [(0, 0), (100, 0), (100, 100), (0, 100)] for k in range(40)} | {k: [(90, 90), (130, 90), (130, 130)] for k in range(40, 80)}
    vertices = spark.createDataFrame([(k, 1, i, float(x), float(y)) for k, c in corners.items() for i, (x, y) in enumerate(c)], "polygon int, section int, point_order int, x double, y double")
    points = spark.createDataFrame([(i, 1, float(i % 140), float(i // 140 * 7)) for i in range(2800)] + [(9000, 1, None, 1.0), (9001, None, 5.0, 5.0)], "id int, section int, x double, y double")
    parts, plain = [], spatial._parts
    monkeypatch.setattr(spatial, "_parts", lambda *a, **k: parts.append(plain(*a, **k)) or parts[-1])
    got = sorted(r.id for r in spatial.polygon_union(points, vertices, 20).collect())
    assert got == sorted({r.id for r in points.collect() for c in corners.values() if r.section and r.x is not None and inside(r.x, r.y, c)})
    places = {(int(r.x // 5), int(r.y // 5)) for r in points.collect() if r.section and r.x is not None and not inside(r.x, r.y, corners[0])}
    asked = {(r["__pcx"], r["__pcy"]) for p in parts[2:] for r in p.collect()}
    assert asked and asked <= places
