"""Products of affine chains, means of rotations, and correlation with a template, against numpy."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from cartoscope.operators import chains, correlation, rotations


def matrices(rng, n):
    m = np.tile(np.eye(3), (n, 1, 1))
    m[:, :2, :] += rng.normal(size=(n, 2, 3)) / 6  # sheared, scaled and shifted
    return m


@pytest.mark.parametrize("parts", [1, 7])
def test_chains_to_the_middle(spark, parts):
    """One animal has most sections, so it lies in many ranges."""
    rng = np.random.default_rng(3)
    steps = {animal: matrices(rng, n) for animal, n in (("a", 300), ("b", 1), ("c", 2), ("d", 37))}
    rows = [(a, 3 * i - 5, *map(float, m[:2].ravel())) for a, some in steps.items() for i, m in enumerate(some)]
    rows += [(None, 1, *[1.0] * 6), ("d", None, *[1.0] * 6)]
    df = spark.createDataFrame(rows, f"animal string, section long, {', '.join(f'{c} double' for c in chains.ENTRIES)}").repartition(4)
    got = {(r.animal, r.section): np.array(r[2:]) for r in chains.to_middle(df, "animal", "section", parts).collect()}
    upto = {(r.animal, r.section): (r.place, r.n, np.array([r[c] for c in chains.ENTRIES])) for r in chains.running_products(df, "animal", "section", parts).collect()}
    assert len(got) == len(upto) == sum(map(len, steps.values()))
    for a, some in steps.items():
        mid = len(some) // 2
        run = np.eye(3)
        for i, m in enumerate(some):
            run = m @ run
            place, n, found = upto[a, 3 * i - 5]
            assert (place, n) == (i, len(some)) and np.allclose(found, run[:2].ravel(), rtol=1e-8, atol=1e-8)
            if len(some) < 100:  # long chains of this kind are ill-conditioned
                wanted = np.eye(3)
                for k in range(mid + 1, i + 1):
                    wanted = some[k] @ wanted
                for k in range(mid, i, -1):
                    wanted = np.linalg.inv(some[k]) @ wanted
                assert np.allclose(got[a, 3 * i - 5], wanted[:2].ravel(), rtol=1e-6, atol=1e-6), (a, i)


def test_long_rigid_chain(spark):
    rng = np.random.default_rng(5)
    angle = rng.normal(size=400) / 5
    some = np.array([[[math.cos(t), -math.sin(t), x], [math.sin(t), math.cos(t), y], [0, 0, 1]] for t, (x, y) in zip(angle, rng.normal(size=(400, 2)))])
    df = spark.createDataFrame([(1, i, *map(float, m[:2].ravel())) for i, m in enumerate(some)], f"animal int, section int, {', '.join(f'{c} double' for c in chains.ENTRIES)}")
    wanted = np.eye(3)
    for m in some[201:400]:
        wanted = m @ wanted
    last = {r.section: r for r in chains.to_middle(df, "animal", "section", 5).collect()}
    assert np.allclose(last[399][2:], wanted[:2].ravel(), atol=1e-9) and np.allclose(last[200][2:], [1, 0, 0, 0, 1, 0], atol=1e-12)


def test_batches_within_a_range(spark):
    rng = np.random.default_rng(4)
    some = matrices(rng, 50)
    df = spark.createDataFrame([(7, i, *map(float, m[:2].ravel())) for i, m in enumerate(some)], f"k int, section int, {', '.join(f'{c} double' for c in chains.ENTRIES)}")
    before = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", 8)
    try:
        got = {r.section: [r[c] for c in chains.ENTRIES] for r in chains.running_products(df, "k", "section", 1).collect()}
    finally:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", before)
    run = np.eye(3)
    for i, m in enumerate(some):
        run = m @ run
        assert np.allclose(got[i], run[:2].ravel())


def test_singular_middle_and_no_rows(spark):
    schema = f"k int, section int, {', '.join(f'{c} double' for c in chains.ENTRIES)}"
    flat = spark.createDataFrame([(1, 0, *[0.0] * 6), (1, 1, *[0.0] * 6)], schema)
    assert all(v is None for r in chains.to_middle(flat, "k", "section").collect() for v in r[2:])
    assert chains.to_middle(flat.limit(0), "k", "section").collect() == []


def turned(rng, n):
    q, r = np.linalg.qr(rng.normal(size=(n, 3, 3)))
    q = q * np.sign(np.einsum("nii->ni", r))[:, None, :]
    return q * np.linalg.det(q)[:, None, None]


def as_quaternion(m):
    """From the null space: q such that m = R(q), by the eigenvector of the symmetric 4 x 4 form."""
    a, b, c, d, e, f, g, h, i = m.ravel()
    k = np.array([[a - e - i, b + d, c + g, h - f], [b + d, e - a - i, f + h, c - g], [c + g, f + h, i - a - e, d - b], [h - f, c - g, d - b, a + e + i]]) / 3
    return np.linalg.eigh(k)[1][:, 3]


def from_quaternion(q):
    x, y, z, w = q / np.linalg.norm(q)
    return np.array([[1 - 2 * (y * y + z * z), 2 * (x * y - z * w), 2 * (x * z + y * w)], [2 * (x * y + z * w), 1 - 2 * (x * x + z * z), 2 * (y * z - x * w)], [2 * (x * z - y * w), 2 * (y * z + x * w), 1 - 2 * (x * x + y * y)]])


def test_mean_rotations(spark):
    rng = np.random.default_rng(7)
    m = turned(rng, 60)
    m[:3] = [np.diag([1, -1, -1]), np.diag([-1, 1, -1]), np.diag([-1, -1, 1])]  # half turns have no scalar part
    df = spark.createDataFrame([(i % 3, i, *map(float, v.ravel())) for i, v in enumerate(m)] + [(0, 99, None, *[0.0] * 8)], f"k int, id int, {', '.join(f'{c} double' for c in rotations.ENTRIES)}").repartition(4)
    aligned = {r.k: r for r in rotations.aligned_mean(df, ["k"], "id").collect()}
    main = {r.k: r for r in rotations.main_rotation(df, ["k"]).collect()}
    for k in range(3):
        q = np.array([as_quaternion(v) for v in m[k::3]])
        q[(q @ q[0]) < 0] *= -1
        assert aligned[k].n == 20 and np.allclose(aligned[k][2:], from_quaternion(q.mean(0)).ravel(), atol=1e-9)
        values, vectors = np.linalg.eigh(q.T @ q / len(q))
        assert np.isclose(main[k].agreement, values[3]) and np.allclose(main[k][3:], from_quaternion(vectors[:, 3]).ravel(), atol=1e-9)
    quaternions = {r.id: [r[c] for c in rotations.PARTS] for r in rotations.with_quaternions(df.where("id < 99")).collect()}
    assert all(np.allclose(from_quaternion(np.array(quaternions[i])), v) for i, v in enumerate(m))


def test_a_rotation_and_its_copies(spark):
    m = turned(np.random.default_rng(8), 1)[0]
    df = spark.createDataFrame([("x", i, *map(float, m.ravel())) for i in range(5)], f"k string, id int, {', '.join(f'{c} double' for c in rotations.ENTRIES)}")
    row = rotations.main_rotation(df, ["k"]).first()
    assert np.isclose(row.agreement, 1) and np.allclose(row[3:], m.ravel())
    assert np.allclose(rotations.aligned_mean(df, ["k"], "id").first()[2:], m.ravel())


def gradient(img):
    padded = np.pad(img, 2, mode="reflect") if min(img.shape) > 2 else np.array([[img[_mirror(r, img.shape[0]), _mirror(c, img.shape[1])] for c in range(-2, img.shape[1] + 2)] for r in range(-2, img.shape[0] + 2)])
    d, s = np.array([-1, -2, 0, 2, 1]), np.array([1, 4, 6, 4, 1])
    h, w = img.shape
    x = sum(s[i] * d[j] * padded[i : i + h, j : j + w] for i in range(5) for j in range(5))
    y = sum(d[i] * s[j] * padded[i : i + h, j : j + w] for i in range(5) for j in range(5))
    mean, std = (x.mean() + y.mean()) / 2, math.sqrt((x.var() + y.var()) / 2) + 1e-8
    return (x - mean) / std, (y - mean) / std


def _mirror(i, n):
    i = abs(i) % max(1, 2 * (n - 1))
    return min(i, 2 * (n - 1) - i)


def middle(img, h, w):
    for axis, size in enumerate((h, w)):
        if img.shape[axis] > size:
            at = (img.shape[axis] - size) // 2
            img = np.take(img, range(at, at + size), axis)
    return img


def cells(key, img, top=0):
    return [(*key, r + top, c - 3, float(v)) for r, line in enumerate(img) for c, v in enumerate(line)]


def test_correlation_and_energy(spark):
    """Windows larger and smaller than their template, of one line, and with holes."""
    rng = np.random.default_rng(9)
    shapes = [(9, 9), (12, 7), (5, 14), (20, 20), (3, 3), (2, 6), (1, 5), (1, 1)]
    found = {(i, c): rng.normal(size=s) * 50 for i, s in enumerate(shapes) for c in (1, 3)}
    masks = {1: rng.normal(size=(9, 9)), 3: rng.normal(size=(6, 11))}
    rows = [r for k, img in found.items() for r in cells(k, img, k[0])]
    rows += cells((50, 1), rng.normal(size=(4, 4)))[:-3] + cells((51, 1), np.ones((3, 3))) + [(51, 1, 0, -3, 1.0)] + [(52, 1, 0, 0, None)] + cells((53, 9), np.ones((2, 2)))
    df = spark.createDataFrame(rows, "id int, channel int, row int, col int, value double").repartition(3)
    template = spark.createDataFrame([r for c, img in masks.items() for r in cells((c,), img)], "channel int, row int, col int, value double")
    got = {(r.id, r.channel): (r.corr, r.energy) for r in correlation.correlation_energy(df, template).collect()}
    assert set(got) == {*found, (50, 1), (51, 1), (52, 1), (53, 9)}
    for k in ((50, 1), (51, 1), (52, 1), (53, 9)):
        assert got[k] == (None, None)
    for (i, c), img in found.items():
        h, w = (min(a, b) for a, b in zip(img.shape, masks[c].shape))
        img, mask = middle(img, h, w), middle(masks[c], h, w)
        (x, y), (tx, ty) = gradient(img), gradient(mask)
        wanted = np.mean(x * tx + y * ty), np.mean(np.sqrt(x * x + y * y) * mask)
        assert np.allclose(got[i, c], wanted, rtol=1e-6, atol=1e-5), (i, c)  # a flat window has only rounding


def test_a_large_image_is_no_window(spark, monkeypatch):
    monkeypatch.setattr(correlation, "WINDOW_PIXELS", 8)
    df = spark.createDataFrame(cells((1, 1), np.ones((3, 3))), "id int, channel int, row int, col int, value double")
    with pytest.raises(ValueError):
        correlation.windows(df, ["id", "channel"])
    assert correlation.windows(df.where(F.col("row") < 0), ["id", "channel"]).collect() == []


def test_long_chains_keep_their_digits(spark):
    n, mid = 1501, 750
    m = {k: np.array([[1 + (k % 7 - 3) / 64, (k % 5 - 2) / 32, k % 11 - 5], [(k % 3 - 1) / 16, 1 - (k % 4) / 64, k % 13], [0, 0, 1]], float) for k in range(n)}
    df = spark.createDataFrame([("a", k, *map(float, v[:2].ravel())) for k, v in m.items()], ["animal", "section", *chains.ENTRIES])
    want = {mid: np.eye(3)}
    for k in range(mid + 1, n):
        want[k] = m[k] @ want[k - 1]
    for k in range(mid, 0, -1):
        want[k - 1] = np.linalg.inv(m[k]) @ want[k]
    got = {r.section: np.array(r[2:]) for r in chains.to_middle(df, "animal", "section", 5).collect()}
    assert len(got) == n
    for k, v in want.items():
        assert np.abs(got[k] - v[:2].ravel()).max() <= 1e-8 * np.abs(v).max()
