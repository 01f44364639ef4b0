"""Hand-made cases and properties."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from cartoscope.operators import contours, detect, groups, landmarks, pixels, spatial, stats
from cartoscope.operators.graph import connected_components
from cartoscope.functions import scalars


def test_threshold_edges(spark):
    df = spark.createDataFrame([(1.5,), (-1.5,), (1.5000001,), (-1.5000001,), (None,)], "m double")
    assert [r[0] for r in df.select(detect.threshold_class(F.col("m"))).collect()] == [0, 0, 2, -2, None]


def test_section_shift_and_rounding(spark):
    df = spark.createDataFrame([(57, 1, 1, 2)], "section int, x int, y int, predictions int")
    assert detect.positive_points(df).first()["section"] == 57
    z = spark.createDataFrame([(2.5,), (3.5,)], "z double")
    assert [r[0] for r in z.select(scalars.to_pixels(F.col("z"), F.lit(1.0))).collect()] == [2, 4]


def test_proximity_is_strict_and_chains_make_one_group(spark):
    p = spark.createDataFrame([(1, 0, 0, 0), (2, 0, 30, 0), (3, 0, 59, 0), (4, 1, 0, 0)], "id long, section int, x long, y long")
    assert [(r.a, r.b) for r in spatial.proximity_pairs(p, 30).collect()] == [(2, 3)]
    chain = spark.createDataFrame([(1, 0, 0, 0), (2, 0, 20, 0), (3, 0, 40, 0)], "id long, section int, x long, y long")
    assert {r.group_id for r in groups.point_groups(chain, 30).collect()} == {1}


def test_points_on_edges_and_two_vertices(spark):
    v = spark.createDataFrame([(1, 0, 1, 0, 0), (1, 0, 2, 10, 0), (1, 0, 3, 10, 10), (1, 0, 4, 0, 10), (2, 0, 1, 0, 0), (2, 0, 2, 20, 20)], "polygon long, section int, point_order long, x long, y long")
    p = spark.createDataFrame([(1, 0, 5, 5), (2, 0, 10, 5), (3, 0, 0, 0), (4, 0, 15, 15)], "id long, section int, x long, y long")
    assert [(r.id, r.polygon) for r in spatial.in_polygons(p, v).collect()] == [(1, 1)]


def test_square_in_twenty_points(spark):
    v = spark.createDataFrame([(1, 0, i + 1, x, y) for i, (x, y) in enumerate([(0, 0), (10, 0), (10, 10), (0, 10)])], "polygon long, section int, point_order long, x long, y long")
    rows = sorted(contours.resample_even(v, 20).collect(), key=lambda r: r.point_order)
    assert len(rows) == 20 and (rows[0].x, rows[0].y) == (0, 0)
    assert all(math.isclose(math.dist((a.x, a.y), (b.x, b.y)), 2, abs_tol=1e-9) for a, b in zip(rows, rows[1:]))


@pytest.mark.parametrize("mirror", [False, True])
def test_similarity_is_recovered(spark, mirror):
    rng = np.random.default_rng(1)
    a = math.radians(30)
    r = np.array([[math.cos(a), -math.sin(a), 0], [math.sin(a), math.cos(a), 0], [0, 0, 1]])
    x = rng.normal(size=(5, 3))
    y = 2 * x @ r.T + [1, 2, 3]
    if mirror:
        y[:, 0] *= -1
    rows = [("b", i, *map(float, p), *map(float, q)) for i, (p, q) in enumerate(zip(x, y))]
    df = spark.createDataFrame(rows, "brain string, structure int, x1 double, y1 double, z1 double, x2 double, y2 double, z2 double")
    m = landmarks.similarity_fit(df, ["brain"]).first()
    found = np.array([[m[f"m{i}{j}"] for j in range(3)] for i in range(3)])
    assert np.linalg.det(found) > 0
    if not mirror:
        assert np.allclose(found, 2 * r, atol=1e-9) and math.isclose(m["scale"], 2, abs_tol=1e-9)
        fit = landmarks.affine_fit(df, ["brain"])
        assert landmarks.registration_error(df, fit, ["brain"]).first()["rms"] < 1e-6
        pts = spark.createDataFrame([("b", i, *map(float, q)) for i, q in enumerate(y)], "brain string, id int, x double, y double, z double")
        back = [[r.x, r.y, r.z] for r in sorted(landmarks.map_points(pts, fit, "brain", inverse=True).collect(), key=lambda r: r.id)]
        assert np.allclose(back, x, atol=1e-6)


def test_composed_transforms(spark):
    rng = np.random.default_rng(2)
    rows = [(i, float(rng.normal() / 10), float(rng.normal()), float(rng.normal())) for i in range(5)]
    df = spark.createDataFrame(rows, "section long, rotation double, xshift double, yshift double")
    c = (3.0, 4.0)

    def matrix(r, dx, dy):
        a, b = math.cos(r), math.sin(r)
        return np.array([[a, -b, dx + c[0] - c[0] * a + c[1] * b], [b, a, dy + c[1] - c[0] * b - c[1] * a], [0, 0, 1]])

    t = {s: matrix(r, dx, dy) for s, r, dx, dy in rows}
    for r in landmarks.compose_sections(df, 2, c).collect():
        expected = np.eye(3)
        if r.section > 2:
            for i in range(3, r.section + 1):
                expected = t[i] @ expected
        else:
            for i in range(2, r.section, -1):
                expected = np.linalg.inv(t[i]) @ expected
        assert np.allclose([[r.m00, r.m01, r.m02], [r.m10, r.m11, r.m12]], expected[:2], atol=1e-9), r.section


def test_tree_rollup(spark):
    tree = spark.createDataFrame([("root", None), ("a", "root"), ("b", "a")], "id string, parent_id string")
    counts = spark.createDataFrame([("root", 1), ("a", 2), ("b", 3)], "id string, n long")
    assert {r.id: r.total for r in groups.rollup(tree, counts).collect()} == {"root": 6, "a": 5, "b": 3}


def test_dice(spark):
    a, b = spark.range(4), spark.range(10, 14)
    assert stats.dice(a, a, ["id"]).first()["dice"] == 1
    assert stats.dice(a, b, ["id"]).first()["dice"] == 0


def test_greedy_match_equals_sorted_order(spark):
    rng = np.random.default_rng(3)
    pairs = [(int(a), int(b), float(rng.integers(1, 12))) for a in range(12) for b in range(12) if rng.random() < 0.4]
    used_a, used_b, expected = set(), set(), set()
    for d, a, b in sorted((d, a, b) for a, b, d in pairs):
        if a not in used_a and b not in used_b:
            used_a.add(a)
            used_b.add(b)
            expected.add((a, b))
    got = groups.greedy_match(spark.createDataFrame(pairs, "a long, b long, d2 double"))
    assert {(r.a, r.b) for r in got.collect()} == expected


def test_zero_counts(spark):
    none = spark.createDataFrame([], "a long, b long, d2 double")
    one = spark.createDataFrame([(1, 1, 4.0)], "a long, b long, d2 double")
    assert stats.precision_recall(none, 0, 0, [1]).collect() == []
    row = stats.precision_recall(one, 0, 0, [1]).first()
    assert (row.tp, row.precision, row.recall, row.f1) == (0, 0, 0, 0)


def test_components(spark):
    edges = [(i, i + 1) for i in range(40)] + [(100, 101), (7, 7), (None, 3)]
    got = {r.node: r.component for r in connected_components(spark.createDataFrame(edges, "src long, dst long")).collect()}
    assert got == {**dict.fromkeys(range(41), 0), 100: 100, 101: 100}


def test_json_without_children(spark):
    from cartoscope.operators import annotations

    df = spark.createDataFrame([(1, '{"type":"volume"}'), (2, "not json"), (3, None)], "id long, a string")
    assert annotations.volume_points(df, "id", "a", (1.0, 1.0, 1.0)).collect() == []
    assert annotations.cloud_points(df, "id", "a", (1.0, 1.0, 1.0)).collect() == []


def test_a_circle_of_parents_is_an_error(spark):
    from cartoscope.operators import groups

    tree = spark.createDataFrame([("a", "b"), ("b", "c"), ("c", "a"), ("d", "a"), ("r", None)], "id string, parent_id string")
    with pytest.raises(ValueError):
        groups.closure(tree)
    with pytest.raises(ValueError):
        groups.rollup(tree, spark.createDataFrame([("d", 1)], "id string, n long"))
    fine = tree.where("id in ('d', 'r')").unionByName(spark.createDataFrame([("a", "r")], "id string, parent_id string"))
    got = {r.id: r.total for r in groups.rollup(fine, spark.createDataFrame([("d", 1), ("d", 2), ("a", 5), ("gone", 9)], "id string, n long")).collect()}
    assert got == {"d": 3, "a": 8, "r": 8}


def test_running_sums_cross_ranges(spark):
    from pyspark.sql import functions as F

    from cartoscope.operators import stats

    rng = np.random.default_rng(3)
    values = rng.permutation(500).tolist()
    df = spark.createDataFrame([(v, v % 7) for v in values], "v int, n long").repartition(5)
    got = {r.v: r.upto_n for r in stats.running_sums(df, -F.col("v"), ["n"]).collect()}
    assert got == {v: sum(u % 7 for u in range(v, 500)) for v in range(500)}
    assert stats.running_sums(df.limit(0), F.col("v"), ["n"]).collect() == []


def test_cell_measures(spark):
    from cartoscope.operators import pixels

    cube = [(0, z, y, x, 9) for z in (1, 2) for y in (1, 2) for x in (1, 2)]
    rows = [*cube, (0, 3, 3, 3, 20), (0, 9, 9, 9, 8), (1, 1, 1, 1, 7), (0, 1, 1, 0, 30), (0, 9, 9, 8, 2)]
    df = spark.createDataFrame(rows, "volume int, z int, y int, x int, value int")
    got = sorted(tuple(r) for r in pixels.cell_measures(df.where("value < 25").unionByName(df.where("value = 30").withColumn("value", df["value"] - 29)), 5, 1).collect())
    # the cube and the voxel at its corner are one cell; its centre is cut to (1, 1, 1)
    assert got == [(0, 1, 1, 1, 9, 3, 9), (0, 9, 9, 9, 1, 1, 8), (1, 1, 1, 1, 1, 1, 7)]


def test_positions_of_a_group_are_numbered_by_ranges(spark, monkeypatch):
    from cartoscope.operators import ordering

    monkeypatch.setattr(ordering, "RANGE_ROWS", 40)
    rows = [(k % 3 if k % 10 else None, k * 7 % 50, k % 4) for k in range(300)] * 2
    got = [tuple(r) for r in ordering.distinct_positions(spark.createDataFrame(rows, "g int, a int, b int"), "g", ["a", "b"], "n").collect()]
    want = {(g, a, b, i) for key in (None, 0, 1, 2) for i, (g, a, b) in enumerate(sorted({r for r in rows if r[0] == key}, key=lambda r: r[1:]))}
    assert len(got) == len(want) and set(got) == want


def test_angle_sort_sorts_a_polygon_in_its_row(spark):
    from cartoscope.operators.contours import angle_sorted

    square = [(0, 0), (4, 4), (0, 4), (4, 0), (4, 0)]
    out = angle_sorted(spark.createDataFrame([(1, 1, x, y) for x, y in square] + [(2, 1, 5, 5)], "polygon int, section int, x long, y long"))
    assert "Window" not in out._jdf.queryExecution().optimizedPlan().toString()
    assert sorted((r.polygon, r.point_order, r.x, r.y) for r in out.collect()) == [(1, 1, 0, 4), (1, 2, 4, 4), (1, 3, 4, 0), (1, 4, 0, 0), (2, 1, 5, 5)]


def test_blur_deals_lines_before_they_multiply(spark):
    """Both passes of the blur deal pixels to a named number of tasks before a pixel becomes 2 * radius + 1 rows; values stay."""
    frame = spark.createDataFrame([(1, 0, 0, 8), (1, 0, 1, 0), (1, 2, 0, 4)], "image long, row int, col int, value long").coalesce(1)
    out = pixels.blur_subtract(frame, 1, 1.0)
    assert out._jdf.queryExecution().executedPlan().toString().count("REPARTITION_BY_NUM") == 2
    w = math.exp(-0.5)
    blurred = {(0, 0): 8 / (1 + w), (0, 1): 8 * w / (1 + w), (2, 0): 4.0}
    assert {(r.row, r.col) for r in out.collect()} == set(blurred)
    assert {(r.row, r.col): round(r.value, 9) for r in out.collect()} == {k: round(max(v - b, 0.0), 9) for (k, v), b in zip({(0, 0): 8, (0, 1): 0, (2, 0): 4}.items(), blurred.values())}


def test_annotation_texts_are_parsed_once(spark):
    """A filter on a parsed text does not parse it again, and the result stays."""
    from cartoscope.operators import annotations

    text = '{"type":"volume","childJsons":[{"type":"polygon","childJsons":[{"type":"line","pointA":[1e-6,2e-6,3.5e-6],"pointB":[0,0,0]}]}]}'
    df = spark.createDataFrame([(1, text), (2, text.replace("volume", "cloud"))], "id long, a string")
    for read, n in ((annotations.volume_points, 1), (annotations.cloud_points, 0)):
        out = read(df, "id", "a", (1.0, 1.0, 1.0))
        assert out._jdf.queryExecution().executedPlan().toString().count("from_json(") == 1
        assert out.count() == n
    point = annotations.com_points(df, "id", "a")
    assert point._jdf.queryExecution().executedPlan().toString().count("from_json(") == 1 and point.count() == 0
    assert tuple(annotations.volume_points(df, "id", "a", (1.0, 1.0, 1.0)).first()) == (1, 0, 0, 1.0, 2.0, 3)
