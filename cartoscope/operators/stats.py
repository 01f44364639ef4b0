"""Aggregates and statistics over points, scores, voxels and images."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window as W

from cartoscope.functions.durable import durable
from cartoscope.operators.selection import percentiles


def filtered_sum(rows: DataFrame, condition: str, sums: Sequence[str], keys: Sequence[str]) -> DataFrame:
    """Sums of columns by keys over the rows that meet a condition."""
    return rows.where(condition).groupBy(*keys).agg(*[F.sum(c).alias(c) for c in sums])


def mean_points(points: DataFrame, keys: Sequence[str], axes: Sequence[str] = ("x", "y", "z")) -> DataFrame:
    """Mean of each axis by keys, with the number of points."""
    return points.groupBy(*keys).agg(*[F.avg(c).alias(c) for c in axes], F.count("*").alias("n"))


def nested_centroid(vertices: DataFrame, inner: Sequence[str], outer: Sequence[str], axes: Sequence[str] = ("x", "y")) -> DataFrame:
    """Mean of the inner groups' means: every polygon weighs alike, however many vertices it has."""
    return mean_points(mean_points(vertices, inner, axes).drop("n"), outer, axes)


def bounding_box(points: DataFrame, keys: Sequence[str], axes: Sequence[str]) -> DataFrame:
    """Smallest, largest and mean value of each axis."""
    return points.groupBy(*keys).agg(*[f(c).alias(f"{n}_{c}") for c in axes for n, f in (("min", F.min), ("max", F.max), ("mean", F.avg))])


def origin_and_size(points: DataFrame, keys: Sequence[str], axes: Sequence[str]) -> DataFrame:
    """Origin (smallest values, truncated) and size (spans plus one) of each group."""
    return points.groupBy(*keys).agg(*[F.min(c).cast("long").alias(f"origin_{c}") for c in axes], *[(F.max(c).cast("long") - F.min(c).cast("long") + 1).alias(f"size_{c}") for c in axes])


def weighted_centre(voxels: DataFrame, keys: Sequence[str], weight: str, axes: Sequence[str]) -> DataFrame:
    """Centre of mass with weights; null where they sum to 0."""
    return voxels.groupBy(*keys).agg(*[(F.sum(F.col(weight) * F.col(c)) / F.nullif(F.sum(weight), F.lit(0))).alias(c) for c in axes])


def precision_recall(matches: DataFrame, n_truth: int, n_found: int, cutoffs: Sequence[float], dist2: str = "d2") -> DataFrame:
    """tp, fp, fn, precision, recall and F1 at each distance cutoff (inclusive); 0 where a denominator is 0."""
    each = matches.select(dist2, F.explode(F.array(*[F.lit(float(c)) for c in cutoffs])).alias("cutoff"))
    tp = each.groupBy("cutoff").agg(F.count_if(F.col(dist2) <= F.col("cutoff") * F.col("cutoff")).alias("tp"))
    ratio = lambda a, b: F.when(b == 0, 0.0).otherwise(a / b)
    out = tp.withColumns({"fp": F.lit(n_found) - F.col("tp"), "fn": F.lit(n_truth) - F.col("tp")})
    out = out.withColumns({"precision": ratio(F.col("tp"), F.col("tp") + F.col("fp")), "recall": ratio(F.col("tp"), F.col("tp") + F.col("fn"))})
    return out.withColumn("f1", ratio(2 * F.col("precision") * F.col("recall"), F.col("precision") + F.col("recall")))


def structure_counts(points: DataFrame, structures: DataFrame) -> DataFrame:
    """Points of each structure, 0 where there are none."""
    n = points.groupBy("structure").agg(F.count("*").alias("n"))
    return structures.join(n, "structure", "left").select("structure", F.coalesce("n", F.lit(0).cast("long")).alias("n"))


def scaled(rows: DataFrame, column: str, name: str, top: float) -> DataFrame:
    """rows with a column scaled from its range to [0, top]; the range is one aggregate row."""
    ends = rows.agg(F.min(column).alias("__lo"), F.max(column).alias("__hi"))
    out = rows.crossJoin(F.broadcast(ends)).withColumn(name, (F.col(column) - F.col("__lo")) * F.lit(top) / F.nullif(F.col("__hi") - F.col("__lo"), F.lit(0)))
    return out.drop("__lo", "__hi")


def error_pivot(rows: DataFrame, metrics: Sequence[str], brains: Sequence[str]) -> DataFrame:
    """Wide table: one row a structure and metric, one column a brain."""
    long = rows.unpivot(["brain", "structure"], list(metrics), "metric", "v")
    long = long.select("brain", F.concat_ws("_", F.col("structure").cast("string"), "metric").alias("name"), "v")
    return long.groupBy("name").pivot("brain", list(brains)).agg(F.max("v"))


def box_quantiles(rows: DataFrame, keys: Sequence[str], value: str, fewest: int) -> DataFrame:
    """Quartiles of a value in groups of at least so many rows."""
    enough = rows.groupBy(*keys).agg(F.count("*").alias("n")).where(F.col("n") >= fewest)
    p = enough.join(percentiles(rows, keys, value, (0.25, 0.5, 0.75)), list(keys))
    return p.select(*keys, "n", F.col("p")[0].alias("q1"), F.col("p")[1].alias("median"), F.col("p")[2].alias("q3"))


def density_grid(points: DataFrame, origin: Sequence[float], size: Sequence[float], axes: Sequence[str]) -> DataFrame:
    """Points in each cell of a grid."""
    cells = [F.floor((F.col(c) - o) / s).cast("long").alias(f"{c}_bin") for c, o, s in zip(axes, origin, size, strict=True)]
    return points.groupBy(*cells).agg(F.count("*").alias("n"))


def histogram(values: DataFrame, keys: Sequence[str], value: str, low: float, high: float, bins: int) -> DataFrame:
    """Counts in equal bins over [low, high], the last one closed; values outside are dropped, as are empty bins."""
    v = F.col(value)
    b = F.least(F.floor((v - low) * bins / (high - low)), F.lit(bins - 1)).cast("long")
    return values.where(v.between(low, high)).groupBy(*keys, b.alias("bin")).agg(F.count("*").alias("n"))


def combined_histogram(pixels: DataFrame, skip_zero: bool = True, fewest: int = 10) -> DataFrame:
    """Counts of each value over all images divided by their number; nothing with fewer than `fewest` images."""
    n = pixels.agg(F.count_distinct("image").alias("images")).where(F.col("images") >= fewest)
    rows = pixels.where("value <> 0") if skip_zero else pixels
    return rows.groupBy("value").agg(F.count("*").alias("n")).crossJoin(F.broadcast(n)).select("value", (F.col("n") / F.col("images")).alias("n"))


def pooled_voxels(voxels: DataFrame, keys: Sequence[str], brain: str) -> DataFrame:
    """Number of brains that are positive at each voxel."""
    return voxels.groupBy(*keys).agg(F.count_distinct(brain).alias("n_brains"))


def dice(left: DataFrame, right: DataFrame, keys: Sequence[str]) -> DataFrame:
    """2 n(A and B) / (n(A) + n(B)) of two masks of distinct voxels; null for two empty ones."""
    a, b = left.select(*keys, F.lit(1).alias("a")), right.select(*keys, F.lit(1).alias("b"))
    n = a.join(b, list(keys), "full").agg(F.count("a").alias("na"), F.count("b").alias("nb"), F.count_if(F.col("a").isNotNull() & F.col("b").isNotNull()).alias("n_both"))
    return n.select("na", "nb", "n_both", (2 * F.col("n_both") / F.nullif(F.col("na") + F.col("nb"), F.lit(0))).alias("dice"))


def running_sums(rows: DataFrame, by: Column, columns: Sequence[str]) -> DataFrame:
    """rows with upto_<column>: sums of all rows up to and including each in the order of by (distinct values).

    The rows are dealt by range; each range sums its own rows, and the totals of the ranges before it, one row a range, are
    added. No task holds more than a range.
    """
    dealt = durable(rows.withColumn("__by", by).repartitionByRange("__by").withColumn("__part", F.spark_partition_id()), "ranges")
    totals = dealt.groupBy("__part").agg(*[F.sum(c).alias(f"__{c}") for c in columns])
    before = W.orderBy("__part").rowsBetween(W.unboundedPreceding, -1)
    offsets = totals.select("__part", *[F.coalesce(F.sum(f"__{c}").over(before), F.lit(0)).alias(f"__{c}") for c in columns])
    inside = W.partitionBy("__part").orderBy("__by").rowsBetween(W.unboundedPreceding, W.currentRow)
    own = dealt.select("*", *[F.sum(c).over(inside).alias(f"upto_{c}") for c in columns])
    out = own.join(F.broadcast(offsets), "__part")  # as many rows as the session has shuffle partitions
    return out.select(*rows.columns, *[(F.col(f"upto_{c}") + F.col(f"__{c}")).alias(f"upto_{c}") for c in columns])


def roc_curve(rows: DataFrame, score: str, label: str) -> DataFrame:
    """True and false positives (tp, fp) at each distinct score, from above, and those of the score alone (p, n); ties are one step."""
    each = rows.groupBy(F.col(score).alias("threshold")).agg(F.sum(label).alias("p"), F.sum(1 - F.col(label)).alias("n"))
    return running_sums(each, -F.col("threshold"), ["p", "n"]).withColumnsRenamed({"upto_p": "tp", "upto_n": "fp"})


def auc(rows: DataFrame, score: str, label: str) -> DataFrame:
    """Area under the ROC curve by the trapezoid rule, with the confusion counts at a threshold of 0.5."""
    curve = roc_curve(rows, score, label)
    area = curve.agg((F.sum(F.col("n") * (2 * F.col("tp") - F.col("p"))) / 2 / (F.max("tp") * F.max("fp"))).alias("auc"))
    s, y = F.col(score) >= 0.5, F.col(label) == 1
    counts = rows.agg(F.count_if(s & y).alias("tp"), F.count_if(s & ~y).alias("fp"), F.count_if(~s & y).alias("fn"), F.count_if(~s & ~y).alias("tn"))
    return area.crossJoin(counts)


def error_curve(rows: DataFrame, score: str, label: str, thresholds: Sequence[float]) -> DataFrame:
    """Error rate of each class at each threshold, and the share of rows between minus and plus the threshold."""
    each = rows.select(score, label, F.explode(F.array(*[F.lit(float(v)) for v in thresholds])).alias("threshold"))
    s, y = F.col(score), F.col(label) == 1
    rate = lambda c, total: F.count_if(c) / F.nullif(F.count_if(total), F.lit(0))
    return each.groupBy("threshold").agg(rate((s <= F.col("threshold")) & y, y).alias("miss_rate"), rate((s > F.col("threshold")) & ~y, ~y).alias("false_rate"), (F.count_if(F.abs(s) < F.abs("threshold")) / F.count("*")).alias("abstain_rate"))


def effect_size(rows: DataFrame, group: str, value: str, first: str, second: str, log: bool = False) -> DataFrame:
    """Cohen's d of two groups with the pooled standard deviation. log: of log10, without zeros."""
    v = F.log10(F.when(F.col(value) != 0, F.col(value))) if log else F.col(value)
    s = {g: F.when(F.col(group) == g, v) for g in (first, second)}
    a = rows.agg(*[f(s[g]).alias(f"{n}{i}") for i, g in enumerate((first, second)) for n, f in (("m", F.avg), ("v", F.var_samp), ("n", F.count))])
    pooled = F.sqrt(((F.col("n0") - 1) * F.col("v0") + (F.col("n1") - 1) * F.col("v1")) / (F.col("n0") + F.col("n1") - 2))
    return a.select(((F.col("m0") - F.col("m1")) / pooled).alias("d"), F.col("n0").alias("n_first"), F.col("n1").alias("n_second"))


def linear_fit(rows: DataFrame, x: str, y: str) -> DataFrame:
    """Slope, intercept, and the 95th percentile of absolute residuals above and below the line with their counts."""
    fit = durable(rows.agg(F.regr_slope(y, x).alias("slope"), F.regr_intercept(y, x).alias("intercept")), "fit")  # one line for all passes
    r = rows.crossJoin(F.broadcast(fit)).withColumn("r", F.col(y) - F.col("slope") * F.col(x) - F.col("intercept"))
    up, down = F.when(F.col("r") > 0, F.col("r")), F.when(F.col("r") < 0, -F.col("r"))
    total = r.agg(F.first("slope").alias("slope"), F.first("intercept").alias("intercept"), F.count(up).alias("n_above"), F.count(down).alias("n_below"))
    sides = percentiles(r.where("r <> 0").select((F.col("r") > 0).alias("above"), F.abs("r").alias("r")), ["above"], "r", [0.95])
    ends = sides.agg(*[F.max(F.when(F.col("above") == side, F.col("p")[0])).alias(n) for side, n in ((True, "p95_above"), (False, "p95_below"))])
    return total.crossJoin(ends)


def ks_two_sample(sample: DataFrame, background: DataFrame, key: str, value: str) -> DataFrame:
    """Kolmogorov-Smirnov statistic of each group against the background, where it is attained (smallest such value), and the asymptotic p-value.

    The background's counts per distinct value are shared: each group joins only the cumulative share at its own
    values and just below them, where the largest gap must lie.
    """
    total = background.count()
    ref = running_sums(background.groupBy(F.col(value).alias("v")).agg(F.count("*").alias("c")), F.col("v"), ["c"])
    ref = ref.select("v", (F.col("upto_c") / total).alias("upto"), ((F.col("upto_c") - F.col("c")) / total).alias("before"))
    own = sample.groupBy(key, F.col(value).alias("v")).agg(F.count("*").alias("c"))
    g = W.partitionBy(key).orderBy("v").rowsBetween(W.unboundedPreceding, W.currentRow)
    whole = W.partitionBy(key)
    own = own.withColumns({"n": F.sum("c").over(whole), "s": F.sum("c").over(g)})
    both = own.join(ref, "v")
    gaps = both.select(key, "n", "v", F.greatest(F.abs(F.col("s") / F.col("n") - F.col("upto")), F.abs((F.col("s") - F.col("c")) / F.col("n") - F.col("before"))).alias("gap"))
    best = gaps.groupBy(key, "n").agg(F.max(F.struct("gap", (-F.col("v")).alias("v"))).alias("m"))
    root = F.sqrt(F.col("n") * total / (F.col("n") + total))
    lam = (root + 0.12 + 0.11 / root) * F.col("m.gap")
    p = sum((F.lit(2.0 * (-1) ** (k - 1)) * F.exp(-2.0 * k * k * lam * lam) for k in range(1, 11)), F.lit(0.0))
    return best.select(key, "n", F.col("m.gap").alias("ks"), (-F.col("m.v")).alias("at"), F.least(F.greatest(p, F.lit(0.0)), F.lit(1.0)).alias("p_value"))


def box_relation(pairs: DataFrame, cut: float = 0.05) -> DataFrame:
    """Relation of neighbouring boxes by whether each differs from the background: both, first, second, none."""
    a, b = F.col("p_value") < cut, F.col("p_value2") < cut
    return pairs.withColumn("relation", F.when(a & b, "both").when(a, "first").when(b, "second").otherwise("none"))


def covariance(rows: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Means and covariances that ignore missing values pairwise: rows (a, b, n, mean_a, mean_b, cov), in one aggregate."""
    aggs = []
    for i, a in enumerate(columns):
        for b in columns[i:]:
            both = F.col(a).isNotNull() & F.col(b).isNotNull()
            aggs.append(F.struct(F.lit(a).alias("a"), F.lit(b).alias("b"), F.count_if(both).alias("n"), F.avg(F.when(both, F.col(a))).alias("mean_a"), F.avg(F.when(both, F.col(b))).alias("mean_b"), F.covar_pop(F.when(both, F.col(a)), F.when(both, F.col(b))).alias("cov")))
    return rows.agg(F.array(*aggs).alias("x")).select(F.explode("x").alias("x")).select("x.*")


def principal_axes(voxels: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Centroid, variances along the principal axes (largest first) and the first axis (largest component positive)."""
    axes = "xyz"
    sums = [F.avg(c).alias(f"mean_{c}") for c in axes] + [F.covar_pop(a, b).alias(f"c_{a}{b}") for a in axes for b in axes]
    rows = voxels.groupBy(*keys).agg(*sums)

    def run(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for part in parts:
            products = np.stack([part[f"c_{a}{b}"].to_numpy(float) for a in axes for b in axes], 1).reshape(-1, 3, 3)
            values, vectors = np.linalg.eigh(products)
            first = vectors[:, :, -1]
            largest = np.take_along_axis(first, np.abs(first).argmax(1)[:, None], 1)
            found = pd.DataFrame(np.hstack([values[:, ::-1], first * np.sign(largest)]), columns=["v1", "v2", "v3", "a_x", "a_y", "a_z"], index=part.index)
            yield pd.concat([part[[*keys, *(f"mean_{c}" for c in axes)]], found], axis=1)

    kinds = {c: voxels.schema[c].dataType.simpleString() for c in keys}
    return rows.mapInPandas(run, ", ".join([*(f"{c} {k}" for c, k in kinds.items()), *(f"{c} double" for c in ("mean_x", "mean_y", "mean_z", "v1", "v2", "v3", "a_x", "a_y", "a_z"))]))


def ecdf(rows: DataFrame, keys: Sequence[str], value: str) -> DataFrame:
    """Empirical distribution of each group at its distinct values."""
    each = rows.groupBy(*keys, value).agg(F.count("*").alias("c"))
    upto = F.sum("c").over(W.partitionBy(*keys).orderBy(value).rowsBetween(W.unboundedPreceding, W.currentRow))
    return each.select(*keys, value, (upto / F.sum("c").over(W.partitionBy(*keys))).alias("share"))


def mode(rows: DataFrame, keys: Sequence[str], value: str) -> DataFrame:
    """Most frequent value of each group; ties go to the smaller value."""
    n = rows.groupBy(*keys, value).agg(F.count("*").alias("n"))
    top = n.groupBy(*keys).agg(F.max(F.struct("n", (-F.col(value)).alias("v"))).alias("m"))
    return top.select(*keys, (-F.col("m.v")).alias(value), F.col("m.n").alias("n"))


def contrast(value: Column, in_mask: Column) -> Column:
    """Aggregate: (mean in the mask - mean of all) / (their sum); 1 for 0/0 and 0 for an empty mask."""
    inner, outer = F.avg(F.when(in_mask, value)), F.avg(value)
    return F.when(F.count_if(in_mask) == 0, 0.0).when(inner + outer == 0, 1.0).otherwise((inner - outer) / (inner + outer))
