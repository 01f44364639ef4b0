"""Means of rotations and of Euler transforms, as one aggregate a group."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Entries of a rotation matrix, line by line, and the parts of a quaternion, the scalar one last.
ENTRIES = tuple(f"r{i}{j}" for i in range(3) for j in range(3))
PARTS = ("qx", "qy", "qz", "qw")


def quaternion(m: Sequence[Column]) -> dict[str, Column]:
    """Unit quaternion (PARTS) of a rotation matrix of nine columns. The largest of the four parts is taken as divisor."""
    a, b, c, d, e, f, g, h, i = m
    trace = a + e + i
    # four times each squared part
    w, x, y, z = 1 + trace, 1 + 2 * a - trace, 1 + 2 * e - trace, 1 + 2 * i - trace
    raw = {"w": (h - f, c - g, d - b, w), "x": (x, b + d, c + g, h - f), "y": (b + d, y, f + h, c - g), "z": (c + g, f + h, z, d - b)}
    most = F.greatest(w, x, y, z)
    out = {}
    for k, part in enumerate(PARTS):
        v = F.when(w == most, raw["w"][k]).when(x == most, raw["x"][k]).when(y == most, raw["y"][k]).otherwise(raw["z"][k])
        out[part] = v / (2 * F.sqrt(most))
    return out


def matrix(q: Sequence[Column]) -> dict[str, Column]:
    """The rotation matrix (ENTRIES) of a quaternion of any length but 0, for which it is null."""
    x, y, z, w = q
    n = F.nullif(x * x + y * y + z * z + w * w, F.lit(0.0))
    s = 2.0 / n
    lines = ((1 - s * (y * y + z * z), s * (x * y - z * w), s * (x * z + y * w)), (s * (x * y + z * w), 1 - s * (x * x + z * z), s * (y * z - x * w)), (s * (x * z - y * w), s * (y * z + x * w), 1 - s * (x * x + y * y)))
    return dict(zip(ENTRIES, (v for line in lines for v in line), strict=True))


def with_quaternions(rows: DataFrame) -> DataFrame:
    """rows with a rotation (ENTRIES) as PARTS instead. Rows with a null entry have null parts."""
    return rows.withColumns(quaternion([F.col(c) for c in ENTRIES])).drop(*ENTRIES)


def aligned_mean(rows: DataFrame, keys: Sequence[str], order: str) -> DataFrame:
    """Mean rotation of each group: keys, n, ENTRIES.

    A quaternion and its negative are the same rotation, so all are turned to the side of the group's reference, its first by
    order, and averaged. The reference comes from an aggregate that is joined back, so a large group is not gathered.
    Rotations that cancel out have a null mean; rows with nulls are left out.
    """
    q = with_quaternions(rows.select(*keys, order, *ENTRIES)).where(" and ".join(f"{c} is not null" for c in PARTS))
    first = q.groupBy(*keys).agg(F.min_by(F.struct(*PARTS), F.struct(order, *PARTS)).alias("__q"))
    q = q.join(first, list(keys))
    side = F.when(sum((F.col(c) * F.col(f"__q.{c}") for c in PARTS[1:]), F.col("qx") * F.col("__q.qx")) < 0, -1.0).otherwise(1.0)
    mean = q.groupBy(*keys).agg(F.count("*").alias("n"), *[F.avg(side * F.col(c)).alias(c) for c in PARTS])
    return mean.select(*keys, "n", *[v.alias(k) for k, v in matrix([F.col(c) for c in PARTS]).items()])


def _main_axis(keys: Sequence[str]):
    """Sums of products of the parts (a batch of groups) to the rotation of the main eigenvector of each."""

    def run(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for part in parts:
            table = np.empty((len(part), 4, 4))
            for i in range(4):
                for j in range(4):
                    table[:, i, j] = part[f"p{min(i, j)}{max(i, j)}"]
            values, vectors = np.linalg.eigh(table)
            x, y, z, w = vectors[:, :, 3].T
            lines = [1 - 2 * (y * y + z * z), 2 * (x * y - z * w), 2 * (x * z + y * w), 2 * (x * y + z * w), 1 - 2 * (x * x + z * z), 2 * (y * z - x * w), 2 * (x * z - y * w), 2 * (y * z + x * w), 1 - 2 * (x * x + y * y)]
            agreed = values[:, 3] / part["n"].to_numpy()
            yield pd.DataFrame({**{k: part[k] for k in [*keys, "n"]}, "agreement": agreed, **dict(zip(ENTRIES, lines, strict=True))})

    return run


def main_rotation(rows: DataFrame, keys: Sequence[str]) -> DataFrame:
    """The rotation closest to all of a group: keys, n, agreement, ENTRIES; it needs no reference.

    It is the main eigenvector of the sum of the quaternions' outer products, one aggregate of ten sums a group. agreement is 1 if all
    rotations are the same. Rows with nulls are left out.
    """
    q = with_quaternions(rows.select(*keys, *ENTRIES)).where(" and ".join(f"{c} is not null" for c in PARTS))
    sums = q.groupBy(*keys).agg(F.count("*").alias("n"), *[F.sum(F.col(PARTS[i]) * F.col(PARTS[j])).alias(f"p{i}{j}") for i in range(4) for j in range(i, 4)])
    kinds = {c: rows.schema[c].dataType.simpleString() for c in keys}
    schema = ", ".join([*(f"{c} {k}" for c, k in kinds.items()), "n long", "agreement double", *(f"{c} double" for c in ENTRIES)])
    return sums.mapInPandas(_main_axis(keys), schema)


def euler_matrix(x: Column, y: Column, z: Column) -> dict[str, Column]:
    """Rotation by the angles x, then y, then z about these axes (ENTRIES)."""
    a, b, c = F.cos(x), F.cos(y), F.cos(z)
    d, e, f = F.sin(x), F.sin(y), F.sin(z)
    lines = ((c * b, c * e * d - f * a, c * e * a + f * d), (f * b, f * e * d + c * a, f * e * a - c * d), (-e, b * d, b * a))
    return dict(zip(ENTRIES, (v for line in lines for v in line), strict=True))
