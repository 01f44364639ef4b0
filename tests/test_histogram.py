"""Histogram matching equals numpy, whatever ranges the shares are dealt into."""

import random

import numpy as np
import pytest

from cartoscope.operators.pixels import match_histogram


def table(spark, rows):
    return spark.createDataFrame(rows, "image int, row int, col int, value long")


def quantiles(values):
    at, n = np.unique(values, return_counts=True)
    return at, np.cumsum(n) / len(values)


@pytest.mark.parametrize("parts", [1, 7, 40])
def test_equal_to_numpy(spark, parts):
    rng = random.Random(2)
    images = {i: [rng.randint(0, 4 + 60 * i) for _ in range(40 + 7 * i)] for i in range(6)}
    images[6] = [5] * 30
    ref = [rng.choice([0, 0, 3, 9, 200, rng.randint(50, 90)]) for _ in range(150)]
    df = table(spark, [(i, k, 0, v) for i, vs in images.items() for k, v in enumerate(vs)])
    old = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", parts)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        reference = table(spark, [(0, k, 0, v) for k, v in enumerate(ref)])
        plain = {(r.image, r.row): r.value for r in match_histogram(df, reference).collect()}
        linear = {(r.image, r.row): r.value for r in match_histogram(df, reference, linear=True).collect()}
        bits = {(r.image, r.row): r.value for r in match_histogram(df, reference, linear=True, top=65535).collect()}
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", old)
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    ref_values, ref_shares = quantiles(ref)
    for i, values in images.items():
        own, shares = quantiles(values)
        first = dict(zip(own.tolist(), ref_values[np.searchsorted(ref_shares, shares)].tolist()))
        between = dict(zip(own.tolist(), np.interp(shares, ref_shares, ref_values).tolist()))
        assert [plain[i, k] for k in range(len(values))] == [first[v] for v in values]
        assert np.allclose([linear[i, k] for k in range(len(values))], [between[v] for v in values], rtol=1e-12)
        scaled = np.array([linear[i, k] for k in range(len(values))])
        assert [bits[i, k] for k in range(len(values))] == (65535 * (scaled / scaled.max())).astype(np.uint16).tolist()


def test_flat_zero_and_empty(spark):
    df = table(spark, [(1, 0, 0, 4), (1, 0, 1, 6)])
    zero = table(spark, [(9, 0, 0, 0), (9, 0, 1, 0)])
    assert {r.value for r in match_histogram(df, zero, linear=True, top=65535).collect()} == {0}
    assert {r.value for r in match_histogram(df, zero.where("false"), linear=True).collect()} == {None}
    assert match_histogram(df.where("false"), zero).collect() == []
