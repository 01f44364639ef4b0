"""Boosted trees against a row-by-row numpy version, and training that goes on from stored trees."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from cartoscope.operators import ensemble

FEATURES = ["a", "b", "c"]
SCHEMA = "id long, a double, b double, c double, label double, mean_score double"


@pytest.fixture(scope="module")
def rows():
    rng = np.random.default_rng(6)
    x = rng.normal(size=(400, 3)).round(1)
    x[rng.random(400) < 0.1, 1] = np.nan
    y = ((x[:, 0] + np.nan_to_num(x[:, 1], nan=1.5) * x[:, 2] + rng.normal(size=400) / 4) > 0.3).astype(float)
    return x, y


def frame(spark, rows, parts=3):
    x, y = rows
    data = [(i, *[None if np.isnan(v) and i % 2 else float(v) for v in r], float(t), 9.0) for i, (r, t) in enumerate(zip(x, y))]
    return spark.createDataFrame(data, SCHEMA).repartition(parts)


def grown(x, g, h, rows, edges, depth, node=0):
    """A tree as {node: (feature, cut, missing left) or value} by trying every split of every node."""
    unit = ensemble.UNIT
    total = (g[rows].sum() / unit, h[rows].sum() / unit)
    best = (1e-6, None)
    if node < (1 << depth) - 1:
        for f, cuts in enumerate(edges):
            for cut in cuts:
                for left in (False, True):
                    side = np.where(np.isnan(x[rows, f]), left, x[rows, f] < cut)
                    gl, hl = g[rows][side].sum() / unit, h[rows][side].sum() / unit
                    gr, hr = g[rows][~side].sum() / unit, h[rows][~side].sum() / unit
                    gain = gl * gl / (hl + 1) + gr * gr / (hr + 1) - total[0] * total[0] / (total[1] + 1)
                    if hl >= 1 and hr >= 1 and gain > best[0] + 1e-9 * max(1, best[0]):
                        best = (gain, (f, cut, left, side))
    if best[1] is None:
        return {node: -0.3 * total[0] / (total[1] + 1)}
    f, cut, left, side = best[1]
    return {node: (f, cut, left), **grown(x, g, h, rows[side], edges, depth, 2 * node + 1), **grown(x, g, h, rows[~side], edges, depth, 2 * node + 2)}


def answer(tree, r):
    node = 0
    while isinstance(tree[node], tuple):
        f, cut, left = tree[node]
        node = 2 * node + (1 if (left if np.isnan(r[f]) else r[f] < cut) else 2)
    return tree[node]


def as_dict(trees, r, m):
    out, todo = {}, [0]
    while todo:
        n = todo.pop()
        f = trees.feature[r, m, n]
        out[n] = trees.value[r, m, n] if f < 0 else (f, trees.cut[r, m, n], bool(trees.missing_left[r, m, n]))
        todo += [] if f < 0 else [2 * n + 1, 2 * n + 2]
    return out


def same(a, b):
    return a.keys() == b.keys() and all(type(a[k]) is tuple and a[k] == b[k] or np.isclose(a[k], b[k], atol=1e-12) for k in a)


def test_tree_by_tree(spark, rows):
    x, y = rows
    df = frame(spark, rows)
    trees = ensemble.train(df, FEATURES, "label", "id", models=3, depth=3, rounds=4, percent=70, bins=9)
    learns = np.array(df.orderBy("id").select(*[F.pmod(F.xxhash64("id", F.lit(m)), F.lit(100)) < 70 for m in range(3)]).collect())
    for m in range(3):
        margin = np.zeros(len(x))
        for r in range(4):
            g, h = (v[:, 0] for v in ensemble.gradients(margin[:, None], y))
            tree = grown(x, g, h, np.flatnonzero(learns[:, m]), trees.edges, 3)
            assert same(as_dict(trees, r, m), tree), (m, r)
            margin += [answer(tree, v) for v in x]
        assert np.allclose(trees.margins(x)[:, m], margin)
    assert [tuple(r) for r in ensemble.describe(trees).collect()] == [(m, 4, sum(len(as_dict(trees, r, m)) for r in range(4))) for m in range(3)]


def test_resumed_equals_uninterrupted(spark, rows, monkeypatch):
    """Whatever the partitions, when margins are refreshed, how many models fit, and where training stopped."""
    whole = ensemble.train(frame(spark, rows, 1), FEATURES, "label", "id", models=4, rounds=5, bins=16)
    half = ensemble.train(frame(spark, rows), FEATURES, "label", "id", models=4, rounds=2, bins=16)
    half = ensemble.from_table(ensemble.to_table(half))
    monkeypatch.setattr(ensemble, "REFRESH", 2)
    monkeypatch.setattr(ensemble, "CELLS", 500)
    done = ensemble.train(frame(spark, rows, 5), FEATURES, "label", "id", models=4, rounds=3, bins=16, start=half)
    for k in ("feature", "cut", "missing_left", "value"):
        assert np.array_equal(getattr(whole, k), getattr(done, k), equal_nan=k != "missing_left" and k != "feature"), k
    with pytest.raises(ValueError):
        ensemble.train(frame(spark, rows), FEATURES[:2], "label", "id", models=4, start=half)


def test_scores(spark, rows):
    x, y = rows
    df = frame(spark, rows)
    trees = ensemble.train(df, FEATURES, "label", "id", models=5, rounds=20)
    got = sorted(ensemble.score(df, FEATURES, trees).collect(), key=lambda r: r.id)
    m = trees.margins(x)
    assert np.allclose([(r.mean_score, r.std_score) for r in got], np.c_[m.mean(1), m.std(1)])
    assert [r.predictions for r in got] == [2 if v > 1.5 else -2 if v < -1.5 else 0 for v in m.mean(1)]
    assert np.mean((m.mean(1) > 0) == (y > 0)) > 0.9


def test_nothing_to_learn_from(spark):
    none = spark.createDataFrame([], SCHEMA)
    trees = ensemble.train(none, FEATURES, "label", "id", models=2, rounds=2)
    assert (trees.feature < 0).all() and not trees.value.any()
    assert ensemble.score(none, FEATURES, trees).collect() == []
    blank = spark.createDataFrame([(1, None, None, None, 1.0, 0.0), (2, None, None, None, None, 0.0)], SCHEMA)
    trees = ensemble.train(blank, FEATURES, "label", "id", models=2, rounds=2, percent=100)
    assert (trees.feature < 0).all() and (trees.value[:, :, 0] > 0).all()
    assert len(ensemble.score(blank, FEATURES, trees).collect()) == 2


def test_rows_of_one_file_are_dealt_to_all_cores(spark, rows, tmp_path, monkeypatch):
    """A file of one row group is one task, however many rows it has."""
    frame(spark, rows, 1).write.parquet(f"{tmp_path}/one")
    seen, kept = [], ensemble.durable
    monkeypatch.setattr(ensemble, "durable", lambda df, label: seen.append(df.rdd.getNumPartitions()) or kept(df, label))
    ensemble.train(spark.read.parquet(f"{tmp_path}/one"), FEATURES, "label", "id", models=2, rounds=1)
    assert min(seen) >= spark.sparkContext.defaultParallelism


def test_rows_are_kept_in_blocks(spark, rows, monkeypatch):
    """A row of the state is many rows, so what is moved to Python at each level is bytes and not rows; what fills a block up teaches nothing."""
    seen, kept = [], ensemble.durable
    monkeypatch.setattr(ensemble, "durable", lambda df, label: seen.append(kept(df, label)) or seen[-1])
    monkeypatch.setattr(ensemble, "release", lambda df: None)
    trees = ensemble.train(frame(spark, rows, 1).coalesce(1), FEATURES, "label", "id", models=3, rounds=2, percent=70, bins=9)
    assert seen[0].count() <= 400 // 64 + spark.sparkContext.defaultParallelism + 1
    x, _ = rows
    m = trees.margins(x)
    nodes = [list(trees.leaves(trees.codes(x), r)) for r in range(2)]
    plain = sum(np.array([trees.value[r, k][n] * np.ones(len(x)) for k, n in enumerate(nodes[r])]) for r in range(2))
    assert np.allclose(m, plain.T)
