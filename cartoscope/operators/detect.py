"""Scored detections: classes, filters, projections and score summaries."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cartoscope.operators.selection import percentiles

#: Corners of the regions in the (mean, std) plane, and the two corners of each of the six lines.
CORNERS = ((0.0, 3.0), (3.0, 4.5), (1.0, 6.0), (-3.0, 4.0), (-10.0, 7.0), (10.0, 7.0))
LINES = ((0, 1), (1, 2), (2, 3), (3, 0), (1, 5), (3, 4))


def threshold_class(mean: Column, cut: float = 1.5) -> Column:
    """2 above cut, 0 from -cut to cut (both ends), -2 below; null for a null mean."""
    return F.when(mean > cut, 2).when(mean >= -cut, 0).when(mean < -cut, -2)


def mean_std_class(mean: Column, std: Column) -> Column:
    """-2 for a negative mean, 0 if the mean is within one std of zero, 2 beyond; null on the borders between."""
    return F.when(mean < 0, -2).when((mean - std < 0) & (mean > 0), 0).when(mean - std > 0, 2)


def region_class(mean: Column, std: Column) -> Column:
    """Class by six lines of the (mean, std) plane: 0 inside the quadrilateral, else by side and line; null in the gaps."""
    above = []
    for i, j in LINES:
        (x1, y1), (x2, y2) = CORNERS[i], CORNERS[j]
        slope = (y1 - y2) / (x1 - x2)
        above.append(F.lit(slope) * mean + F.lit(y1 - slope * x1) < std)
    unsure = above[0] & ~above[1] & ~above[2] & above[3]
    negative = ((mean < 0) & ~above[5]) | ((mean > 0) & above[4])
    positive = ((mean > 0) & ~above[4]) | ((mean < 0) & above[5])
    return F.when(unsure, 0).when(negative, -2).when(positive, 2)


def class_name(prediction: Column) -> Column:
    return F.when(prediction == 2, "sure").when(prediction == 0, "unsure").when(prediction == -2, "not_cell")


def positive_points(detections: DataFrame, shift: float = 0.5) -> DataFrame:
    """Positive detections as (x, y, section), the section shifted and truncated."""
    return detections.where("predictions > 0").select(F.col("x").cast("int").alias("x"), F.col("y").cast("int").alias("y"), (F.col("section") + F.lit(shift)).cast("int").alias("section"))


def inside(points: DataFrame, low: Mapping[str, float], high: Mapping[str, float]) -> Column:
    """low <= column < high in every named column."""
    out = F.lit(True)
    for c in low:
        out = out & (F.col(c) >= low[c]) & (F.col(c) < high[c])
    return F.coalesce(out, F.lit(False))


def within_bounds(points: DataFrame, shape: Mapping[str, float]) -> DataFrame:
    """Points inside [0, size) of every named column."""
    return points.where(inside(points, dict.fromkeys(shape, 0), shape))


def bounds_report(points: DataFrame, shape: Mapping[str, float]) -> DataFrame:
    """One row: points inside the shape and points rejected."""
    ok = inside(points, dict.fromkeys(shape, 0), shape)
    return points.agg(F.count_if(ok).alias("n_inside"), F.count_if(~ok).alias("n_rejected"))


def in_box(points: DataFrame, low: Mapping[str, float], high: Mapping[str, float]) -> DataFrame:
    """Points in a half-open box."""
    return points.where(inside(points, low, high))


def by_area(segments: DataFrame, smallest: float, largest: float, area: str = "area") -> DataFrame:
    """Segments of an area from smallest to largest, both included."""
    return segments.where(F.col(area).between(smallest, largest))


def off_edges(segments: DataFrame, radius: float, width: float, height: float) -> DataFrame:
    """Segments whose box of +-radius lies within [0, width] x [0, height]."""
    x, y = F.col("x"), F.col("y")
    return segments.where((x - radius >= 0) & (y - radius >= 0) & (x + radius <= width) & (y + radius <= height))


def prune(segments: DataFrame, x: tuple[float, float] | None = None, y: tuple[float, float] | None = None, area: tuple[float, float] | None = None) -> DataFrame:
    """Keep segments within the ranges that are given, ends included."""
    for c, r in (("x", x), ("y", y), ("area", area)):
        if r is not None:
            segments = segments.where(F.col(c).between(*r))
    return segments


def tile_core(candidates: DataFrame, size: int, overlap: int) -> DataFrame:
    """Candidates of overlapping square tiles whose centre is in their tile's core: rows (id, tile_x, tile_y, x, y).

    Tiles start every size pixels and reach overlap pixels beyond; a candidate near a border is seen by several tiles and kept by one.
    """
    seen = candidates.select("*", F.explode(F.sequence(F.floor((F.col("x") - overlap) / size), F.floor((F.col("x") + overlap) / size))).alias("tile_x"))
    seen = seen.select("*", F.explode(F.sequence(F.floor((F.col("y") - overlap) / size), F.floor((F.col("y") + overlap) / size))).alias("tile_y"))
    core = (F.col("x") >= F.col("tile_x") * size) & (F.col("x") < (F.col("tile_x") + 1) * size) & (F.col("y") >= F.col("tile_y") * size) & (F.col("y") < (F.col("tile_y") + 1) * size)
    return seen.where(core)


def slab_core(centres: DataFrame, slab: int, overlap: int, z: str = "section") -> DataFrame:
    """Centres of overlapping slabs that lie in their slab's middle part, with z relative to the slab and shifted back."""
    first = F.floor((F.col(z) - overlap) / slab)
    seen = centres.select("*", F.explode(F.sequence(first, F.floor((F.col(z) + overlap) / slab))).alias("slab"))
    local = F.col(z) - F.col("slab") * slab
    return seen.withColumn("local_z", local).where((F.col("local_z") >= 0) & (F.col("local_z") < slab)).withColumn("global_z", F.col("local_z") + F.col("slab") * slab)


def search(table: DataFrame, wanted: Mapping[str, object], one: bool = False) -> DataFrame:
    """Rows that equal all wanted values. one: it must be exactly one row, or ValueError (two rows are read at most)."""
    for k, v in wanted.items():
        table = table.where(F.col(k) == F.lit(v))
    if one and table.limit(2).count() != 1:
        raise ValueError("not exactly one row")
    return table


def not_listed(table: DataFrame, column: str, values: Sequence[object] | DataFrame) -> DataFrame:
    """Rows whose column is none of the values; a DataFrame of one column is joined, a sequence becomes a predicate."""
    if isinstance(values, DataFrame):
        return table.join(values.select(F.col(values.columns[0]).alias(column)).distinct(), column, "left_anti")
    return table.where(~F.col(column).isin(list(values)))


def select_features(table: DataFrame, wanted: Sequence[str]) -> DataFrame:
    """The model's columns in the model's order; ValueError names those that are missing."""
    missing = [c for c in wanted if c not in table.columns]
    if missing:
        raise ValueError(f"missing features: {', '.join(missing)}")
    return table.select(list(wanted))


def binary_label(prediction: Column) -> Column:
    return F.when(prediction > 0, 1).otherwise(0)


def most_frequent_values(values: DataFrame, column: str, n: int, set_to: int) -> DataFrame:
    """Rows whose value is one of the n most frequent that are not 0 (ties: the smaller value), with the value set to a constant."""
    top = values.where(F.col(column) != 0).groupBy(column).count().orderBy(F.desc("count"), column).limit(n).select(column)
    return values.join(F.broadcast(top), column, "left_semi").withColumn(column, F.lit(set_to))


def ensemble_stats(scores: DataFrame, keys: Sequence[str], score: str = "score") -> DataFrame:
    """Mean and population standard deviation of several models' scores, from long rows."""
    return scores.groupBy(*keys).agg(F.avg(score).alias("mean_score"), F.stddev_pop(score).alias("std_score"))


def score_spread(scores: DataFrame, keys: Sequence[str], score: str) -> DataFrame:
    """Median, and the distance from the 10th to the 90th percentile (linear interpolation)."""
    p = percentiles(scores, keys, score, (0.1, 0.5, 0.9))
    return p.select(*keys, F.col("p")[1].alias("median"), (F.col("p")[2] - F.col("p")[0]).alias("spread"))


def by_shape(contours: DataFrame, area: tuple[float, float], circularity: float, percentile: float, image: str = "image") -> DataFrame:
    """Contours by area range, circularity above a bound and intensity above a percentile of their own image."""
    cut = percentiles(contours, [image], "intensity", [percentile]).select(image, F.col("p")[0].alias("__cut"))
    rows = contours.join(cut, image)
    return rows.where(F.col("area").between(*area) & (F.col("circularity") > circularity) & (F.col("intensity") > F.col("__cut"))).drop("__cut")
