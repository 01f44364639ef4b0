"""Polygons as vertex rows: edges, lengths, resampling, filling of gaps, shape measures."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window as W

from cartoscope.operators.spatial import polygon_edges

KEYS = ("polygon", "section")


def edge_lengths(vertices: DataFrame, keys: Sequence[str] = KEYS) -> DataFrame:
    """Edges with their length and where they begin along the outline (arc)."""
    e = polygon_edges(vertices, keys)
    dx, dy = F.col("x2") - F.col("x"), F.col("y2") - F.col("y")
    e = e.withColumn("length", F.sqrt((dx * dx + dy * dy).cast("double")))
    before = W.partitionBy(*keys).orderBy("point_order").rowsBetween(W.unboundedPreceding, -1)
    return e.withColumn("arc", F.coalesce(F.sum("length").over(before), F.lit(0.0)))


def resample_even(vertices: DataFrame, n: int | None = None, keys: Sequence[str] = KEYS) -> DataFrame:
    """n evenly spaced points along each closed outline, the first one at its first vertex.

    Without n it follows from the perimeter: 4 up to 50, 10 up to 200, 20 up to 1000, else 30. Outlines of no length give nothing.
    """
    e = edge_lengths(vertices, keys)
    total = e.groupBy(*keys).agg(F.sum("length").alias("perimeter")).where("perimeter > 0")
    count = F.lit(n) if n else F.when(F.col("perimeter") <= 50, 4).when(F.col("perimeter") <= 200, 10).when(F.col("perimeter") <= 1000, 20).otherwise(30)
    e = e.join(total.withColumn("count", count), list(keys)).where("length > 0")
    step = F.col("perimeter") / F.col("count")
    # each edge makes the points that fall on it: targets k * step with arc <= target < arc + length
    first, last = F.ceil(F.col("arc") / step), F.ceil((F.col("arc") + F.col("length")) / step) - 1
    e = e.withColumns({"step": step, "first": first, "last": F.least(last, F.col("count") - 1)}).where("first <= last")
    e = e.select("*", F.explode(F.sequence("first", "last")).alias("k"))
    share = (F.col("k") * F.col("step") - F.col("arc")) / F.col("length")
    return e.select(*keys, F.col("k").cast("long").alias("point_order"), (F.col("x") + share * (F.col("x2") - F.col("x"))).alias("x"), (F.col("y") + share * (F.col("y2") - F.col("y"))).alias("y"))


def densify(vertices: DataFrame, keys: Sequence[str] = KEYS) -> DataFrame:
    """Each vertex and the midpoint of the edge behind it, numbered anew."""
    e = polygon_edges(vertices, keys)
    both = F.array(
        F.struct((2 * F.col("point_order") - 1).cast("long").alias("point_order"), F.col("x").cast("double").alias("x"), F.col("y").cast("double").alias("y")),
        F.struct((2 * F.col("point_order")).cast("long").alias("point_order"), ((F.col("x") + F.col("x2")) / 2).alias("x"), ((F.col("y") + F.col("y2")) / 2).alias("y")),
    )
    return e.select(*keys, F.explode(both).alias("v")).select(*keys, "v.*")


def angle_sorted(vertices: DataFrame, keys: Sequence[str] = KEYS) -> DataFrame:
    """Distinct vertices ordered by the negative angle about their centroid (ties by x, y). A polygon is sorted in its own row."""
    v = vertices.groupBy(*keys).agg(F.collect_set(F.struct("x", "y")).alias("v"))
    total = lambda some: F.aggregate(some, F.lit(0.0), lambda s, x: s + x)
    given = {c: F.filter(F.transform(f"v.{c}", lambda x: x.cast("double")), lambda x: x.isNotNull()) for c in "xy"}
    v = v.withColumns({f"c{c}": total(some) / F.nullif(F.size(some), F.lit(0)) for c, some in given.items()})
    turned = F.transform("v", lambda e: F.struct(F.round(-F.atan2(e["y"] - F.col("cy"), e["x"] - F.col("cx")), 9).alias("a"), e["x"].alias("x"), e["y"].alias("y")))
    return v.select(*keys, F.posexplode(F.array_sort(turned)).alias("k", "e")).select(*keys, (F.col("k") + 1).cast("long").alias("point_order"), "e.x", "e.y")


def fill_sections(polygons: DataFrame, keys: Sequence[str], value: str) -> DataFrame:
    """Every section between a structure's first and last one; those without a polygon reuse the one before."""
    ends = polygons.groupBy(*keys).agg(F.min("section").alias("a"), F.max("section").alias("b"))
    spine = ends.select(*keys, F.explode(F.sequence("a", "b")).alias("section"))
    rows = spine.join(polygons.select(*keys, "section", value), [*keys, "section"], "left")
    upto = W.partitionBy(*keys).orderBy("section").rowsBetween(W.unboundedPreceding, W.currentRow)
    return rows.withColumn(value, F.last(value, ignorenulls=True).over(upto))


def interpolate_slices(matches: DataFrame, points: DataFrame, k: int) -> DataFrame:
    """k slices between matched points of consecutive slices, linearly: rows (a, b, step, x, y, z). matches: a, b, z, next_z."""
    p = points.select("id", F.col("x").cast("double").alias("x"), F.col("y").cast("double").alias("y"))
    rows = matches.join(p.select(F.col("id").alias("a"), F.col("x").alias("ax"), F.col("y").alias("ay")), "a").join(p.select(F.col("id").alias("b"), F.col("x").alias("bx"), F.col("y").alias("by")), "b")
    rows = rows.select("*", F.explode(F.sequence(F.lit(1), F.lit(k))).alias("step"))
    t = F.col("step") / F.lit(k + 1.0)
    return rows.select("a", "b", "step", (F.col("ax") + t * (F.col("bx") - F.col("ax"))).alias("x"), (F.col("ay") + t * (F.col("by") - F.col("ay"))).alias("y"), (F.col("z") + t * (F.col("next_z") - F.col("z"))).alias("z"))


def circularity(vertices: DataFrame, keys: Sequence[str] = KEYS) -> DataFrame:
    """Area (shoelace), perimeter and 4 pi area / perimeter^2 of each outline; null without length."""
    e = edge_lengths(vertices, keys)
    area = F.abs(F.sum(F.col("x") * F.col("y2") - F.col("x2") * F.col("y"))) / 2
    out = e.groupBy(*keys).agg(area.cast("double").alias("area"), F.sum("length").alias("perimeter"))
    return out.withColumn("circularity", 4 * F.pi() * F.col("area") / F.nullif(F.col("perimeter") * F.col("perimeter"), F.lit(0.0)))
