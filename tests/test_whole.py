"""Queries cover every row of their tables."""

import collections
import inspect
import itertools
import math

import numpy as np
import pytest

from cartoscope.operators import ensemble, landmarks
from cartoscope.plans import all_queries
from cartoscope.plans import tables as T
from cartoscope.plans.registry import Tables
from tests import oracle

QUERIES, TRAIN = all_queries(), ensemble.train


def filled(corners):
    """Pixels of a polygon by scan lines, one row at a time."""
    out = set()
    edges = list(zip(corners, corners[1:] + corners[:1]))
    for row in range(min(y for _, y in corners), max(y for _, y in corners)):
        at = row + 0.5
        cuts = sorted(x + (at - y) * (x2 - x) / (y2 - y) for (x, y), (x2, y2) in edges if min(y, y2) < at <= max(y, y2))
        for a, b in zip(cuts[::2], cuts[1::2]):
            out |= {(row, col) for col in range(math.ceil(a - 0.5), math.ceil(b - 0.5))}
    return out


def test_every_polygon_is_filled(spark):
    corners = collections.defaultdict(list)
    for r in T.polygons(Tables(spark, oracle.SF)).orderBy("polygon", "point_order").collect():
        corners[r.polygon, r.section].append((r.x, r.y))
    expected = {k: filled(v) for k, v in corners.items()}
    got = {(r.polygon, r.section): tuple(r)[2:] for r in QUERIES["pix_fill_polygon"](spark, oracle.SF).collect()}
    wanted = {k: [list(c) for c in zip(*v)] for k, v in expected.items() if v}
    assert got == {k: (len(c), min(c), max(c), sum(r), sum(c)) for k, (r, c) in wanted.items()}


def test_points_meet_every_polygon(spark):
    polygons = {r.polygon for r in QUERIES["join_point_in_polygon"](spark, oracle.SF).select("polygon").distinct().collect()}
    assert any(p % 20 for p in polygons)
    assert QUERIES["src_skip_tiny_csv"](spark, oracle.SF).count() == spark.read.parquet(f"{oracle.SF}/documents.parquet").select("doc_id").distinct().count()


def test_all_combinations_of_all_brains(spark):
    """Against a loop over every subset, for lists of unlike length."""
    rng = np.random.default_rng(4)
    rows = [(b, i, *map(float, rng.normal(size=6))) for b, n in (("p", 11), ("q", 6), ("r", 4)) for i in range(n)]
    pairs = spark.createDataFrame(rows, "brain string, structure int, x1 double, y1 double, z1 double, x2 double, y2 double, z2 double")
    got = {(r.brain, r.combo): (r.mean_dist, r.rms) for r in landmarks.rank_combinations(pairs, 5, ["brain"]).collect()}
    expected = {}
    for brain in "pq":
        p = np.array([r[2:] for r in rows if r[0] == brain])
        one = np.c_[p[:, :3], np.ones(len(p))]
        for some in itertools.combinations(range(len(p)), 5):
            m = np.linalg.lstsq(one[list(some)], p[list(some), 3:], rcond=None)[0]
            d = np.linalg.norm(one @ m - p[:, 3:], axis=1)
            expected[brain, ",".join(map(str, some))] = (d.mean(), math.sqrt((d * d).mean()))
    assert got.keys() == expected.keys()
    assert all(np.allclose(got[k], expected[k], rtol=1e-6) for k in got)


def test_too_many_structures_are_an_error(spark, monkeypatch):
    monkeypatch.setattr(landmarks, "COMBINATIONS", 5)
    pairs = spark.createDataFrame([("b", i) for i in range(6)], "brain string, structure int")
    with pytest.raises(ValueError):
        landmarks.combinations(pairs, 5, ["brain"])


def test_queries_rank_every_subset(spark):
    """All subsets that span the space, so that they have a fit."""
    t = Tables(spark, oracle.SF)
    points = {(r.brain, r.structure): (r.x, r.y, r.z) for r in T.landmarks(t).collect()}
    expected = collections.Counter()
    for brain in {b for b, _ in points} - {"BUILDING"}:
        names = [s for b, s in points if b == brain and ("BUILDING", s) in points]
        x = np.array([points["BUILDING", s] for s in names])
        expected[brain] = sum(np.linalg.matrix_rank(x[list(c)] - x[list(c)].mean(0), tol=1e-6) == 3 for c in itertools.combinations(range(len(names)), 5))
    rows = QUERIES["iter_combinations"](spark, oracle.SF).groupBy("brain").count().collect()
    assert {r["brain"]: r["count"] for r in rows} == expected


def test_ensembles_have_the_default_size(spark, monkeypatch):
    asked = []
    monkeypatch.setattr(ensemble, "train", lambda *a, **k: asked.append(inspect.signature(TRAIN).bind(*a, **k)) or [])
    monkeypatch.setattr(ensemble, "describe", lambda models: None)
    QUERIES["ml_train_ensemble"](spark, oracle.SF)
    monkeypatch.setattr(ensemble, "score", lambda rows, *a: rows.withColumn("predictions", rows["label"]))
    QUERIES["ml_score_ensemble"](spark, oracle.SF)
    for call in asked:
        call.apply_defaults()
    assert [(c.arguments["models"], c.arguments["rounds"]) for c in asked] == [(30, 50)] * 2
