"""Fits of many groups at once equal numpy's of each group."""

import numpy as np

from cartoscope.operators import landmarks, stats


def groups():
    rng = np.random.default_rng(8)
    out = {}
    for g in range(12):
        n = [2, 3, 4, 5, 9, 30][g % 6]
        x = rng.normal(size=(n, 3)) * 10
        if g == 5:
            x[:, 2] = 0  # in one plane
        y = x @ (np.eye(3) + rng.normal(size=(3, 3)) / 5) + rng.normal(size=3) + rng.normal(size=(n, 3)) / 50
        out[g] = (x, y)
    return out


def table(spark, sets):
    rows = [(g, i, *map(float, x[i]), *map(float, y[i])) for g, (x, y) in sets.items() for i in range(len(x))]
    return spark.createDataFrame(rows, "g int, structure int, x1 double, y1 double, z1 double, x2 double, y2 double, z2 double")


def matrix(row):
    return np.array([row[c] for c in landmarks.MATRIX], float).reshape(3, 4)


def test_affine_of_every_group(spark):
    sets = groups()
    got = {r.g: r for r in landmarks.affine_fit(table(spark, sets), ["g"]).collect()}
    assert len(got) == len(sets)
    for g, (x, y) in sets.items():
        if len(x) < 4 or g == 5:
            assert got[g].m00 is None and got[g].n == len(x)
            continue
        expected = np.linalg.lstsq(np.hstack([x, np.ones((len(x), 1))]), y, rcond=None)[0].T
        assert np.allclose(matrix(got[g]), expected, atol=1e-6)


def test_similarity_of_every_group(spark):
    sets = groups()
    got = {r.g: r for r in landmarks.similarity_fit(table(spark, sets), ["g"]).collect()}
    for g, (x, y) in sets.items():
        if len(x) < 3:
            assert got[g].m00 is None and got[g]["scale"] is None
            continue
        p, q = x - x.mean(0), y - y.mean(0)
        u, d, vt = np.linalg.svd(q.T @ p)
        sign = np.array([1, 1, np.sign(np.linalg.det(u @ vt))])
        r, s = (u * sign) @ vt, (d * sign).sum() / (p * p).sum()
        expected = np.hstack([s * r, (y.mean(0) - s * r @ x.mean(0))[:, None]])
        if len(x) > 3:  # three pairs leave the turn about their plane's normal to rounding
            assert np.allclose(matrix(got[g]), expected, atol=1e-6) and np.isclose(got[g]["scale"], s)


def test_principal_axes_of_every_group(spark):
    sets = {g: v for g, v in groups().items() if len(v[0]) > 3}
    rows = [(g, *map(float, p)) for g, (x, _) in sets.items() for p in x]
    got = stats.principal_axes(spark.createDataFrame(rows, "g int, x double, y double, z double"), ["g"]).collect()
    assert len(got) == len(sets)
    for r in got:
        x = sets[r.g][0]
        values, vectors = np.linalg.eigh(np.cov(x.T, bias=True))
        first = vectors[:, -1] * np.sign(vectors[np.abs(vectors[:, -1]).argmax(), -1])
        assert np.allclose([r.mean_x, r.mean_y, r.mean_z], x.mean(0)) and np.allclose([r.v1, r.v2, r.v3], values[::-1], atol=1e-8)
        assert np.allclose([r.a_x, r.a_y, r.a_z], first, atol=1e-6)
