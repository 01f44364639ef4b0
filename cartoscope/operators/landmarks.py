"""Landmark sets: common structures, offsets, fits from one-pass sums, errors, compositions."""

from __future__ import annotations

import math
from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window as W


def common(first: DataFrame, second: DataFrame, deny: Sequence[object] = ()) -> DataFrame:
    """Structures that both sets have, without a deny list: structure, x1, y1, z1, x2, y2, z2."""
    a = first.select("structure", *[F.col(c).alias(f"{c}1") for c in "xyz"])
    b = second.select("structure", *[F.col(c).alias(f"{c}2") for c in "xyz"])
    out = a.join(b, "structure")
    return out.where(~F.col("structure").isin(list(deny))) if deny else out


def shared(landmarks: DataFrame, n_brains: int) -> DataFrame:
    """Structures with the number of brains that have them, and whether all do."""
    n = F.count_distinct("brain")
    return landmarks.groupBy("structure").agg(n.alias("n_brains"), (n == n_brains).alias("in_all"))


def offsets(reference: DataFrame, landmarks: DataFrame, brains: DataFrame) -> DataFrame:
    """Offsets of every brain's structures from the reference's; nulls where a brain lacks one. brains: one small column."""
    ref = reference.select("structure", *[F.col(c).alias(f"r{c}") for c in "xyz"])
    spine = ref.crossJoin(brains.select(F.col("brain").alias("__brain")))
    m = landmarks.select("brain", F.col("structure").alias("__s"), "x", "y", "z")
    rows = spine.join(m, (F.col("__brain") == F.col("brain")) & (F.col("structure") == F.col("__s")), "left")
    d = {f"d{c}": F.col(c) - F.col(f"r{c}") for c in "xyz"}
    dist = F.sqrt(sum((F.pow(v, F.lit(2)) for v in d.values()), F.lit(0.0)))
    return rows.select(F.col("__brain").alias("brain"), "structure", *[v.alias(k) for k, v in d.items()], dist.alias("dist"))


def left_right(landmarks: DataFrame, midline: float) -> DataFrame:
    """Pairs `X_L`, `X_R`: both x, the midpoint, and the left one mirrored about the midline."""
    base = F.regexp_replace("structure", "_[LR]$", "")
    left = landmarks.where(F.col("structure").endswith("_L")).select(base.alias("base"), F.col("x").alias("left_x"))
    right = landmarks.where(F.col("structure").endswith("_R")).select(base.alias("base"), F.col("x").alias("right_x"))
    return left.join(right, "base").withColumns({"mid_x": (F.col("left_x") + F.col("right_x")) / 2, "mirrored_x": 2 * midline - F.col("left_x")})


AXES = "xyz"


def _sums(pairs: DataFrame, keys: Sequence[str]) -> DataFrame:
    """n, sums of all coordinates and of the products x_i x_j and x_i y_j: all that a linear fit needs, in one aggregate."""
    one, two = [f"{c}1" for c in AXES], [f"{c}2" for c in AXES]
    sums = [F.sum(c).alias(f"s_{c}") for c in one + two]
    sums += [F.sum(F.col(a) * F.col(b)).alias(f"p_{a}_{b}") for a in one for b in one + two]
    sums += [F.sum(F.col(b) * F.col(b)).alias(f"p_{b}_{b}") for b in two]
    return pairs.groupBy(*keys).agg(F.count("*").alias("n"), *sums)


def _moments(rows: pd.DataFrame) -> tuple[np.ndarray, ...]:
    """n, sums a and b, products xx and xy, and the sum of squares of x, one entry a row."""
    one, two = [f"{c}1" for c in AXES], [f"{c}2" for c in AXES]
    table = lambda names: np.stack([rows[c].to_numpy(float) for c in names], 1)
    xx = table([f"p_{p}_{q}" for p in one for q in one]).reshape(-1, 3, 3)
    xy = table([f"p_{p}_{q}" for p in one for q in two]).reshape(-1, 3, 3)
    return rows["n"].to_numpy(float), table([f"s_{c}" for c in one]), table([f"s_{c}" for c in two]), xx, xy, np.trace(xx, axis1=1, axis2=2)


def _solved(keys: Sequence[str], columns: Sequence[str], solve):
    """mapInPandas function: the last small step of a fit for all rows of sums of a batch at once. solve: one row of results each, NaN without one."""

    def run(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for part in parts:
            found = pd.DataFrame(solve(part), columns=list(columns), index=part.index)
            yield pd.concat([part[[*keys, "n"]], found.astype(object).where(found.notna(), None)], axis=1)

    return run


MATRIX = [f"m{i}{j}" for i in range(3) for j in range(4)]


def affine_fit(pairs: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Least-squares affine of each group of paired landmarks: keys, n, m00..m23 (3 x 4). Null with fewer than four pairs or a singular set."""

    def solve(rows: pd.DataFrame) -> np.ndarray:
        n, a, b, xx, xy, _ = _moments(rows)
        left = np.block([[xx, a[:, :, None]], [a[:, None, :], n[:, None, None]]])
        right = np.concatenate([xy, b[:, None, :]], 1)
        out = np.full((len(n), 12), np.nan)
        finite = np.isfinite(left).all((1, 2)) & np.isfinite(right).all((1, 2)) & (n >= 4)
        fit = finite.copy()
        fit[finite] = np.linalg.matrix_rank(left[finite]) == 4
        out[fit] = np.linalg.solve(left[fit], right[fit]).transpose(0, 2, 1).reshape(-1, 12)
        return out

    kinds = {c: pairs.schema[c].dataType.simpleString() for c in keys}
    schema = ", ".join([*(f"{c} {k}" for c, k in kinds.items()), "n long", *(f"{c} double" for c in MATRIX)])
    return _sums(pairs, keys).mapInPandas(_solved(keys, MATRIX, solve), schema)


def similarity_fit(pairs: DataFrame, keys: Sequence[str], scale: bool = True) -> DataFrame:
    """Rotation, translation and scale (1 for a rigid fit) of each group: keys, n, m00..m23, scale. Reflections are turned into rotations."""

    def solve(rows: pd.DataFrame) -> np.ndarray:
        moments = _moments(rows)
        out = np.full((len(rows), 13), np.nan)
        fit = (moments[0] >= 3) & np.all([np.isfinite(m.reshape(len(rows), -1)).all(1) for m in moments], 0)
        n, a, b, _, xy, xx = (m[fit] for m in moments)
        c = (xy - a[:, :, None] * b[:, None, :] / n[:, None, None]) / n[:, None, None]
        u, d, vt = np.linalg.svd(c.transpose(0, 2, 1))
        sign = np.ones((len(n), 3))
        sign[:, 2] = np.sign(np.linalg.det(u) * np.linalg.det(vt))
        r = (u * sign[:, None, :]) @ vt
        variance = (xx - (a * a).sum(1) / n) / n
        scaled = scale & (variance > 0)
        s = np.where(scaled, (d * sign).sum(1) / np.where(scaled, variance, 1.0), 1.0)
        t = b / n[:, None] - s[:, None] * np.einsum("kij,kj->ki", r, a / n[:, None])
        out[fit] = np.hstack([np.concatenate([s[:, None, None] * r, t[:, :, None]], 2).reshape(-1, 12), s[:, None]])
        return out

    kinds = {c: pairs.schema[c].dataType.simpleString() for c in keys}
    schema = ", ".join([*(f"{c} {k}" for c, k in kinds.items()), "n long", *(f"{c} double" for c in [*MATRIX, "scale"])])
    return _sums(pairs, keys).mapInPandas(_solved(keys, [*MATRIX, "scale"], solve), schema)


def apply_matrix(x: Column, y: Column, z: Column, m: Sequence[Column]) -> list[Column]:
    """A 3 x 4 matrix applied to a point."""
    return [m[4 * i] * x + m[4 * i + 1] * y + m[4 * i + 2] * z + m[4 * i + 3] for i in range(3)]


def apply_inverse(x: Column, y: Column, z: Column, m: Sequence[Column]) -> list[Column]:
    """The inverse of a 3 x 4 matrix applied to a point, by the adjugate."""
    a, b, c, d, e, f, g, h, i = (m[k] for k in (0, 1, 2, 4, 5, 6, 8, 9, 10))
    det = a * (e * i - f * h) - b * (d * i - f * g) + c * (d * h - e * g)
    p, q, r = x - m[3], y - m[7], z - m[11]
    rows = (((e * i - f * h), (c * h - b * i), (b * f - c * e)), ((f * g - d * i), (a * i - c * g), (c * d - a * f)), ((d * h - e * g), (b * g - a * h), (a * e - b * d)))
    return [(u * p + v * q + w * r) / det for u, v, w in rows]


def map_points(points: DataFrame, matrices: DataFrame, key: str, inverse: bool = False) -> DataFrame:
    """points with x, y, z transformed by the matrix of their key."""
    f = apply_inverse if inverse else apply_matrix
    rows = points.join(matrices.select(key, *MATRIX), key)
    new = f(F.col("x"), F.col("y"), F.col("z"), [F.col(c) for c in MATRIX])
    return rows.withColumns({f"__{c}": v for c, v in zip(AXES, new, strict=True)}).select(*[c for c in points.columns if c not in AXES], *[F.col(f"__{c}").alias(c) for c in AXES])


def residuals(pairs: DataFrame, fits: DataFrame, keys: Sequence[str], more: Sequence[str] = ()) -> DataFrame:
    """Distance of each transformed landmark from its partner, by every fit of its keys; more: columns of the fits to keep."""
    rows = pairs.join(fits.drop("n"), list(keys))
    new = apply_matrix(F.col("x1"), F.col("y1"), F.col("z1"), [F.col(c) for c in MATRIX])
    square = sum(((v - F.col(f"{c}2")) * (v - F.col(f"{c}2")) for v, c in zip(new, AXES, strict=True)), F.lit(0.0))
    return rows.select(*pairs.columns, *more, F.sqrt(square).alias("residual"))


def registration_error(pairs: DataFrame, fits: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Mean distance and root mean square of the residuals of each group."""
    r = residuals(pairs, fits, keys)
    return r.groupBy(*keys).agg(F.count("*").alias("n"), F.avg("residual").alias("mean_dist"), F.sqrt(F.avg(F.col("residual") * F.col("residual"))).alias("rms"))


def compose_sections(transforms: DataFrame, middle: int, centre: tuple[float, float]) -> DataFrame:
    """3 x 3 transform of every section to the middle one: products of section-to-previous transforms outward, inverses below.

    A rigid transform is a rotation by an angle and a shift, and its product is a running sum: angles add, and
    the shift of each step is turned by the angles that follow it. So a window sum composes any number
    of sections without folding matrices row by row.
    """
    from cartoscope.functions.scalars import rigid_matrix

    m = rigid_matrix(F.col("rotation"), F.col("xshift"), F.col("yshift"), centre)
    steps = transforms.select("section", "rotation", m[2].alias("tx"), m[5].alias("ty"))
    # Above the middle, section s maps by T_s ... T_(m+1): angle A_s = sum of rotations, and with B_i the angle up to i
    # the product's shift is R(A_s) * sum over i of R(-B_i) t_i.
    w = W.orderBy("section").rowsBetween(W.unboundedPreceding, W.currentRow)
    up = steps.where(F.col("section") > middle).withColumn("angle", F.sum("rotation").over(w))
    c, s = F.cos("angle"), F.sin("angle")
    up = up.withColumns({"u": F.sum(c * F.col("tx") + s * F.col("ty")).over(w), "v": F.sum(-s * F.col("tx") + c * F.col("ty")).over(w)})
    up = up.select("section", c.alias("cos"), s.alias("sin"), (c * F.col("u") - s * F.col("v")).alias("dx"), (s * F.col("u") + c * F.col("v")).alias("dy"))
    # Below it, section s < middle maps by inv(T_(s+1)) ... inv(T_middle): the inverse of T_middle ... T_(s+1), built downwards.
    w = W.orderBy(F.desc("section")).rowsBetween(W.unboundedPreceding, W.currentRow)
    down = steps.where(F.col("section") <= middle).withColumn("angle", F.sum("rotation").over(w))
    before = F.col("angle") - F.col("rotation")  # of the factors to the left
    c, s = F.cos(before), F.sin(before)
    down = down.withColumns({"dx": F.sum(c * F.col("tx") - s * F.col("ty")).over(w), "dy": F.sum(s * F.col("tx") + c * F.col("ty")).over(w)})
    c, s = F.cos("angle"), F.sin("angle")
    down = down.select((F.col("section") - 1).alias("section"), c.alias("cos"), (-s).alias("sin"), (-c * F.col("dx") - s * F.col("dy")).alias("dx"), (s * F.col("dx") - c * F.col("dy")).alias("dy"))
    one = transforms.where(F.col("section") == middle).select("section", F.lit(1.0).alias("cos"), F.lit(0.0).alias("sin"), F.lit(0.0).alias("dx"), F.lit(0.0).alias("dy"))
    out = up.unionByName(down).unionByName(one)
    return out.select("section", F.col("cos").alias("m00"), (-F.col("sin")).alias("m01"), F.col("dx").alias("m02"), F.col("sin").alias("m10"), F.col("cos").alias("m11"), F.col("dy").alias("m12"))


#: Combinations of one group at most; a longer list of structures is an error, never cut.
COMBINATIONS = 20_000_000


def combinations(pairs: DataFrame, k: int, keys: Sequence[str]) -> DataFrame:
    """Rows (keys, combo, structure, coordinates): every k-subset of each group's structures; one row a member.

    A group's structures are one sorted list, whose size is checked; a subset grows by exploding the rest of its list.
    """
    lists = pairs.where("structure is not null").groupBy(*keys).agg(F.sort_array(F.collect_set("structure")).alias("names"))
    most = lists.agg(F.max(F.size("names"))).first()[0] or 0
    if math.comb(most, k) > COMBINATIONS:
        raise ValueError(f"{most} structures have {math.comb(most, k)} subsets of {k}, more than {COMBINATIONS}")
    combos = lists.where(F.size("names") >= k).select(*keys, "names", F.lit(0).alias("at"), F.array().cast(lists.schema["names"].dataType).alias("combo"))
    for i in range(k):
        # a member at a place that leaves enough behind it for the others
        place = F.explode(F.sequence(F.col("at") + 1, F.size("names") - (k - 1 - i))).alias("next")
        combos = combos.select(*keys, "names", "combo", place)
        combos = combos.select(*keys, "names", F.col("next").alias("at"), F.concat("combo", F.array(F.element_at("names", F.col("next")))).alias("combo"))
    return combos.select(*keys, "combo", F.explode("combo").alias("structure")).join(pairs, [*keys, "structure"])


def rank_combinations(pairs: DataFrame, k: int, keys: Sequence[str]) -> DataFrame:
    """Each k-subset's affine fit judged on all landmarks of its group: keys, combo, mean_dist, rms. Subsets in one plane have no fit."""
    members = combinations(pairs, k, keys).withColumn("combo", F.array_join(F.transform("combo", lambda c: c.cast("string")), ","))
    fits = affine_fit(members, [*keys, "combo"]).where("m00 is not null")
    rows = residuals(pairs, fits, keys, ["combo"])
    return rows.groupBy(*keys, "combo").agg(F.avg("residual").alias("mean_dist"), F.sqrt(F.avg(F.col("residual") * F.col("residual"))).alias("rms"))
