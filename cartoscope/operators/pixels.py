"""Images as pixel rows (image, row, col, value): masks, normalisation, pyramids, geometry, moments."""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window as W

from cartoscope.functions.durable import durable
from cartoscope.operators.graph import connected_components
from cartoscope.operators.selection import percentiles

RC = ("row", "col")


def foreground(pixels: DataFrame, threshold: float) -> DataFrame:
    return pixels.where(F.col("value") > threshold)


def apply_mask(pixels: DataFrame, mask: DataFrame, outside: int | None = None) -> DataFrame:
    """Pixels on the mask; with outside, the others stay with that value."""
    keys = ["image", *RC]
    if outside is None:
        return pixels.join(mask.select(keys), keys, "left_semi")
    m = mask.select(*keys, F.lit(True).alias("__on"))
    return pixels.join(m, keys, "left").withColumn("value", F.when(F.col("__on"), F.col("value")).otherwise(F.lit(outside))).drop("__on")


def _per_image(pixels: DataFrame, **aggs: Column) -> DataFrame:
    """pixels beside aggregates of their image (aggregated map-side and joined back)."""
    return pixels.join(pixels.groupBy("image").agg(*[a.alias(n) for n, a in aggs.items()]), "image")


def minmax(pixels: DataFrame, top: int) -> DataFrame:
    """Each image scaled from its range to [0, top], truncated; a flat image becomes 0."""
    rows = _per_image(pixels, lo=F.min("value"), hi=F.max("value"))
    v = F.when(F.col("hi") > F.col("lo"), F.floor((F.col("value") - F.col("lo")) * top / (F.col("hi") - F.col("lo")))).otherwise(0)
    return rows.withColumn("value", v.cast("long")).drop("lo", "hi")


def quantile_scale(pixels: DataFrame, target: float, quantile: float = 0.99) -> DataFrame:
    """Values times target / the image's quantile of positive values."""
    q = percentiles(pixels, ["image"], F.when(F.col("value") > 0, F.col("value")), [quantile], "q")
    return pixels.join(q, "image").withColumn("value", F.col("value") * target / F.col("q")[0]).drop("q")


def percentile_stretch(pixels: DataFrame, low: float, high: float, top: float) -> DataFrame:
    """Values clipped to two percentiles of the image and scaled to [0, top]."""
    rows = pixels.join(percentiles(pixels, ["image"], "value", (low, high)), "image")
    a, b = F.col("p")[0], F.col("p")[1]
    v = F.when(b > a, (F.least(F.greatest(F.col("value"), a), b) - a) * top / (b - a)).otherwise(0.0)
    return rows.withColumn("value", v).drop("p")


def place(pixels: DataFrame, height: int, width: int) -> DataFrame:
    """Images centred in a larger canvas; what is not covered is background and has no row."""
    rows = _per_image(pixels, h=F.max("row") + 1, w=F.max("col") + 1)
    return rows.withColumns({"row": F.col("row") + F.floor((F.lit(height) - F.col("h")) / 2), "col": F.col("col") + F.floor((F.lit(width) - F.col("w")) / 2)}).drop("h", "w")


def rotate90(pixels: DataFrame, k: int, height: int, width: int) -> DataFrame:
    """Images turned k times by 90 degrees counter-clockwise."""
    r, c = F.col("row"), F.col("col")
    row, col = [(r, c), (F.lit(width - 1) - c, r), (F.lit(height - 1) - r, F.lit(width - 1) - c), (c, F.lit(height - 1) - r)][k % 4]
    return pixels.withColumns({"__r": row, "__c": col}).withColumns({"row": F.col("__r"), "col": F.col("__c")}).drop("__r", "__c")


def crop_windows(candidates: DataFrame, pixels: DataFrame, radius: int, tile: int = 64) -> DataFrame:
    """Pixels of the square of +-radius (end excluded) around each candidate (id, image, row, col): relative places and values."""
    c = candidates.select("id", "image", F.col("row").alias("r0"), F.col("col").alias("c0"))
    c = c.select("*", F.explode(F.sequence(F.floor((F.col("r0") - radius) / tile), F.floor((F.col("r0") + radius - 1) / tile))).alias("tr"))
    c = c.select("*", F.explode(F.sequence(F.floor((F.col("c0") - radius) / tile), F.floor((F.col("c0") + radius - 1) / tile))).alias("tc"))
    p = pixels.withColumns({"tr": F.floor(F.col("row") / tile), "tc": F.floor(F.col("col") / tile)})
    rows = c.join(p, ["image", "tr", "tc"])
    dr, dc = F.col("row") - F.col("r0") + radius, F.col("col") - F.col("c0") + radius
    return rows.withColumns({"dr": dr, "dc": dc}).where(F.col("dr").between(0, 2 * radius - 1) & F.col("dc").between(0, 2 * radius - 1)).select("id", "dr", "dc", "value")


def components(pixels: DataFrame) -> DataFrame:
    """pixels (image, row, col: the foreground) with component: 8-connected, named by its first run.

    Pixels are first joined to horizontal runs, so the graph has an edge for touching runs of neighbouring lines only.
    """
    line = W.partitionBy("image", "row").orderBy("col")
    starts = pixels.withColumn("new", (F.coalesce(F.col("col") - F.lag("col").over(line), F.lit(2)) > 1).cast("int"))
    first = F.max(F.when(F.col("new") == 1, F.col("col"))).over(line.rowsBetween(W.unboundedPreceding, W.currentRow))
    named = starts.withColumn("run", F.concat_ws(":", F.col("image").cast("string"), F.lpad(F.col("row").cast("string"), 9, "0"), F.lpad(first.cast("string"), 9, "0"))).drop("new")
    touch = F.explode(F.array(*[F.lit(d) for d in (-1, 0, 1)])).alias("d")
    below = named.select("image", (F.col("row") - 1).alias("row"), F.col("col"), F.col("run").alias("other"), touch)
    below = below.select("image", "row", (F.col("col") + F.col("d")).alias("col"), "other")
    edges = named.join(below, ["image", "row", "col"]).select(F.col("run").alias("src"), F.col("other").alias("dst")).distinct()
    comps = connected_components(edges)
    return named.join(comps, F.col("run") == F.col("node"), "left").select(*pixels.columns, F.coalesce("component", "run").alias("component"))


def component_stats(labelled: DataFrame) -> DataFrame:
    """Per component: area, bounding box and truncated centroid."""
    return labelled.groupBy("image", "component").agg(
        F.count("*").alias("area"), *[f(c).cast("long").alias(f"{n}_{c}") for c in RC for n, f in (("min", F.min), ("max", F.max))], *[F.avg(c).cast("int").alias(f"centre_{c}") for c in RC]
    )


#: Offsets of the lines (z, y) behind a line that its voxels can touch: half of the eight around it.
LINES = ((0, 1), (1, -1), (1, 0), (1, 1))


def components_3d(voxels: DataFrame) -> DataFrame:
    """voxels (volume, z, y, x: the foreground) with component: 26-connected, named by its first run along x."""
    keys = ["volume", "z", "y"]
    line = W.partitionBy(*keys).orderBy("x")
    starts = voxels.withColumn("new", (F.coalesce(F.col("x") - F.lag("x").over(line), F.lit(2)) > 1).cast("int"))
    first = F.max(F.when(F.col("new") == 1, F.col("x"))).over(line.rowsBetween(W.unboundedPreceding, W.currentRow))
    place = [F.lpad(c.cast("string"), 9, "0") for c in (F.col("z"), F.col("y"), first)]
    named = starts.withColumn("run", F.concat_ws(":", F.col("volume").cast("string"), *place)).drop("new")
    steps = F.array(*[F.struct(F.lit(z).alias("z"), F.lit(y).alias("y"), F.lit(x).alias("x")) for z, y in LINES for x in (-1, 0, 1)])
    behind = named.select("volume", *"zyx", F.col("run").alias("other"), F.explode(steps).alias("o"))
    behind = behind.select("volume", *[(F.col(c) + F.col(f"o.{c}")).alias(c) for c in "zyx"], "other")
    edges = named.join(behind, ["volume", *"zyx"]).select(F.col("run").alias("src"), F.col("other").alias("dst")).distinct()
    comps = connected_components(edges)
    return named.join(comps, F.col("run") == F.col("node"), "left").select(*voxels.columns, F.coalesce("component", "run").alias("component"))


def cell_measures(voxels: DataFrame, threshold: float, radius: int) -> DataFrame:
    """Per 26-connected component of voxels (volume, z, y, x, value) above the threshold: truncated centre (z, y, x), n_voxels,
    z_depth, and intensity, the largest value of any voxel within radius of the centre on every axis; null without one."""
    labelled = components_3d(voxels.where(F.col("value") > threshold))
    cells = labelled.groupBy("volume", "component").agg(*[F.avg(c).cast("long").alias(c) for c in "zyx"], F.count("*").alias("n_voxels"), (F.max("z") - F.min("z") + 1).cast("long").alias("z_depth"))
    cells = durable(cells, "cells")
    around = range(-radius, radius + 1)
    steps = F.array(*[F.struct(F.lit(i).alias("z"), F.lit(j).alias("y"), F.lit(k).alias("x")) for i in around for j in around for k in around])
    near = cells.select("component", "volume", *"zyx", F.explode(steps).alias("o")).select("component", "volume", *[(F.col(c) + F.col(f"o.{c}")).alias(c) for c in "zyx"])
    bright = near.join(voxels, ["volume", *"zyx"]).groupBy("component").agg(F.max("value").alias("intensity"))
    return cells.join(bright, "component", "left").select("volume", *"zyx", "n_voxels", "z_depth", "intensity")


def remove_small(labelled: DataFrame, smallest: int) -> DataFrame:
    """Pixels of components of at least so many pixels."""
    keep = labelled.groupBy("component").agg(F.count("*").alias("__n")).where(F.col("__n") >= smallest).select("component")
    return labelled.join(keep, "component", "left_semi")


def find_site(pixels: DataFrame, k: float, n: int) -> DataFrame:
    """Pixels above mean + k std of their image, in the n largest components of it (ties: the first component)."""
    rows = _per_image(pixels, m=F.avg("value"), s=F.stddev_pop("value"))
    labelled = components(rows.where(F.col("value") > F.col("m") + k * F.col("s")).drop("m", "s"))
    size = labelled.groupBy("image", "component").agg(F.count("*").alias("__n"))
    top = size.withColumn("__r", F.row_number().over(W.partitionBy("image").orderBy(F.desc("__n"), "component"))).where(F.col("__r") <= n)
    return labelled.join(top.select("image", "component"), ["image", "component"], "left_semi")


def edge(mask: DataFrame) -> DataFrame:
    """Mask pixels that have fewer than eight mask pixels around them."""
    around = [(i, j) for i in (-1, 0, 1) for j in (-1, 0, 1)]
    each = mask.select("image", *RC, F.explode(F.array(*[F.struct(F.lit(i).alias("i"), F.lit(j).alias("j")) for i, j in around])).alias("o"))
    each = each.select("image", (F.col("row") + F.col("o.i")).alias("row"), (F.col("col") + F.col("o.j")).alias("col"))
    full = each.groupBy("image", *RC).agg(F.count("*").alias("n")).where("n = 9").select("image", *RC)
    return mask.join(full, ["image", *RC], "left_anti")


def spans(pixels: DataFrame, along: str) -> DataFrame:
    """Runs of consecutive pixels (image, row, col) along a coordinate: (image, the other coordinate, first, last)."""
    other = RC[1 - RC.index(along)]
    line = W.partitionBy("image", other).orderBy(along)
    starts = pixels.withColumn("__new", F.coalesce(F.col(along) - F.lag(along).over(line) > 1, F.lit(True)))
    named = starts.withColumn("first", F.max(F.when(F.col("__new"), F.col(along))).over(line.rowsBetween(W.unboundedPreceding, W.currentRow)))
    return named.groupBy("image", other, "first").agg(F.max(along).alias("last"))


def border_band(mask: DataFrame, radius: int) -> DataFrame:
    """Mask pixels with a pixel outside the mask within a square of +-radius (what erosion takes away)."""
    full = mask.select("image", *RC)
    for c in ("col", "row"):  # a square is full if its lines are, and then its columns of full lines: runs lose radius at both ends
        runs = spans(full, c).where(F.col("last") - F.col("first") >= 2 * radius)
        full = runs.select("image", RC[1 - RC.index(c)], F.explode(F.sequence(F.col("first") + radius, F.col("last") - radius)).alias(c))
    return mask.join(full, ["image", *RC], "left_anti")


def symmetrize(voxels: DataFrame, axis: str, size: int) -> DataFrame:
    """Mean of each voxel and its mirror image along an axis."""
    mirrored = voxels.withColumn(axis, F.lit(size - 1) - F.col(axis)).withColumnRenamed("value", "__m")
    keys = [c for c in voxels.columns if c != "value"]
    return voxels.join(mirrored, keys, "full").select(*keys, ((F.coalesce("value", F.lit(0)) + F.coalesce("__m", F.lit(0))) / 2).alias("value"))


def united(runs: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Disjoint runs (keys, first, last) that cover what runs cover, in each group of keys; runs that touch become one."""
    line = W.partitionBy(*keys).orderBy("first", "last")
    reach = F.max("last").over(line.rowsBetween(W.unboundedPreceding, -1))
    opened = runs.select(*keys, "first", "last").distinct().withColumn("__new", F.coalesce(F.col("first") > reach + 1, F.lit(True)))
    named = opened.withColumn("__start", F.max(F.when(F.col("__new"), F.col("first"))).over(line.rowsBetween(W.unboundedPreceding, W.currentRow)))
    return named.groupBy(*keys, F.col("__start").alias("first")).agg(F.max("last").alias("last"))


def draw_discs(points: DataFrame, radius: int) -> DataFrame:
    """Distinct pixels (section, row, col) within radius of a point (whole coordinates).

    A point is one run a row, 2 radius + 1 in all; runs are united before they become pixels.
    """
    rows = [(i, math.isqrt(radius * radius - i * i)) for i in range(-radius, radius + 1)]
    each = points.select("section", "x", "y", F.explode(F.array(*[F.struct(F.lit(i).alias("i"), F.lit(w).alias("w")) for i, w in rows])).alias("o"))
    runs = each.select("section", (F.col("y") + F.col("o.i")).alias("row"), (F.col("x") - F.col("o.w")).alias("first"), (F.col("x") + F.col("o.w")).alias("last"))
    return united(runs, ["section", "row"]).select("section", "row", F.explode(F.sequence("first", "last")).alias("col"))


#: Crossings of polygons and rows that a task holds at once.
CROSSINGS = 2_000_000


def _runs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Polygons (polygon, section, edges) to their runs (polygon, section, row, first, last), a bounded number of crossings at once."""

    def runs(owner: np.ndarray, e: np.ndarray, a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, ...]:
        many = np.maximum(b - a + 1, 0)
        at = np.repeat(np.arange(len(a)), many)
        row = np.arange(len(at)) - np.repeat(np.cumsum(many) - many, many) + a[at]
        x, y, x2, y2 = e[:, at]
        middle = row + 0.5
        on = np.flatnonzero((middle > np.minimum(y, y2)) & (middle <= np.maximum(y, y2)))
        x, y, x2, y2, middle = (v[on] for v in (x, y, x2, y2, middle))
        cut, row, of = x + (middle - y) * (x2 - x) / (y2 - y), row[on], owner[at[on]]
        order = np.lexsort((cut, row, of))
        cut, row, of = cut[order], row[order], of[order]
        new = np.r_[True, (row[1:] != row[:-1]) | (of[1:] != of[:-1])][: len(cut)]
        place = np.arange(len(cut)) - np.maximum.accumulate(np.where(new, np.arange(len(cut)), 0))
        k = np.flatnonzero((place[:-1] % 2 == 0) & ~new[1:])
        first, last = np.ceil(cut[k] - 0.5), np.ceil(cut[k + 1] - 0.5) - 1
        keep = first <= last
        return of[k][keep], row[k][keep], first[keep].astype(np.int64), last[keep].astype(np.int64)

    for batch in batches:
        lists = batch.column(2)
        sizes = np.diff(lists.offsets.to_numpy())
        flat = lists.flatten()
        parts = flat.flatten()
        e = np.array([parts[flat.type.get_field_index(c)].to_numpy(zero_copy_only=False) for c in ("x", "y", "x2", "y2")]).reshape(4, -1)
        owner = np.repeat(np.arange(len(batch)), sizes)
        a, b = (np.ceil(f(e[1], e[3]) - 0.5).astype(np.int64) for f in (np.minimum, np.maximum))
        upto = np.r_[0, np.cumsum(b - a + 1)][np.r_[0, np.cumsum(sizes)]]  # crossings of the polygons before each
        start = 0
        while start < len(batch):
            end = max(start + 1, int(np.searchsorted(upto, upto[start] + CROSSINGS, "right")) - 1)
            here = slice(*np.searchsorted(owner, (start, end)))
            low, high = a[here], b[here]
            top = int(high.max(initial=0))
            bottom = int(low.min(initial=0))
            # one polygon of more crossings is taken in bands of rows
            step = max(1, CROSSINGS // max(1, len(low))) if upto[end] - upto[start] > CROSSINGS else top - bottom + 1
            for band in range(bottom, top + 1, step):
                of, row, first, last = runs(owner[here], e[:, here], np.maximum(low, band), np.minimum(high, band + step - 1))
                of = pa.array(of)
                yield pa.RecordBatch.from_arrays([batch.column(0).take(of), batch.column(1).take(of), pa.array(row), pa.array(first), pa.array(last)], ["polygon", "section", "row", "first", "last"])
            start = end


def fill_runs(edges: DataFrame) -> DataFrame:
    """Runs (polygon, section, row, first, last) of pixels whose centre row crosses a polygon between pairs of crossings (even-odd scan lines).

    edges: polygon, section, x, y, x2, y2. Rows are sampled at row + 0.5, columns from the ceiling of one crossing to before the next.
    Crossings are made and sorted inside the task, so only edges are shuffled or sorted by Spark. Runs of a line are disjoint.
    """
    rows = edges.where("y <> y2").groupBy("polygon", "section").agg(F.collect_list(F.struct(*[F.col(c).cast("double").alias(c) for c in ("x", "y", "x2", "y2")])).alias("e"))
    kinds = {c: edges.schema[c].dataType.simpleString() for c in ("polygon", "section")}
    return rows.mapInArrow(_runs, f"polygon {kinds['polygon']}, section {kinds['section']}, row long, first long, last long")


def fill_polygons(edges: DataFrame) -> DataFrame:
    """Pixels (polygon, section, row, col) of the runs of fill_runs; no pixel comes twice."""
    return fill_runs(edges).select("polygon", "section", "row", F.explode(F.sequence("first", "last")).alias("col"))


def downsample(pixels: DataFrame, factor: int = 2, how: Callable[[str], Column] = F.avg) -> DataFrame:
    """Local means (or maxima) of factor x factor pixels; odd edges, which fill no whole cell, are trimmed."""
    keys = [F.floor(F.col(c) / factor).alias(c) for c in RC]
    cells = pixels.groupBy("image", *keys).agg(how("value").alias("value"), F.count("*").alias("__n"))
    return cells.where(F.col("__n") == factor * factor).drop("__n")


def pyramid(pixels: DataFrame, levels: int, how: Callable[[str], Column] = F.avg) -> DataFrame:
    """Levels 1.. of the pyramid, each from the one before."""
    out, now = None, pixels
    for level in range(1, levels + 1):
        now = downsample(now, 2, how)
        part = now.withColumn("level", F.lit(level))
        out = part if out is None else out.unionByName(part)
    return out


def blur_subtract(pixels: DataFrame, radius: int, sigma: float) -> DataFrame:
    """Value minus the Gaussian-blurred value, clipped at 0. The kernel is separable: rows, then columns; missing pixels don't count.

    A pixel becomes 2 * radius + 1 rows, so lines of pixels are dealt to a named number of tasks before, not their many sums after.
    """
    parts = int(pixels.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    steps = [(d, math.exp(-d * d / (2 * sigma * sigma))) for d in range(-radius, radius + 1)]
    out = pixels.select("image", *RC, F.col("value").cast("double").alias("b"))
    for c in RC:
        other = RC[1 - RC.index(c)]
        spread = out.repartition(parts, "image", other).select("image", other, c, "b", F.explode(F.array(*[F.struct(F.lit(d).alias("d"), F.lit(w).alias("w")) for d, w in steps])).alias("k"))
        spread = spread.select("image", other, (F.col(c) + F.col("k.d")).alias(c), (F.col("b") * F.col("k.w")).alias("v"), F.col("k.w").alias("w"))
        out = spread.groupBy("image", *RC).agg((F.sum("v") / F.sum("w")).alias("b"))
    return pixels.join(out, ["image", *RC]).withColumn("value", F.greatest(F.col("value") - F.col("b"), F.lit(0.0))).drop("b")


def mean_image(pixels: DataFrame, keys: Sequence[str] = ()) -> DataFrame:
    """Mean of all images (of each of the keys) at each place, then (mean - mean of means) / population std."""
    mean = pixels.groupBy(*keys, *RC).agg(F.avg("value").alias("m"))
    ends = mean.groupBy(*keys).agg(F.avg("m").alias("a"), F.stddev_pop("m").alias("s"))
    rows = mean.join(ends, list(keys)) if keys else mean.crossJoin(F.broadcast(ends))
    return rows.select(*keys, *RC, ((F.col("m") - F.col("a")) / F.col("s")).alias("z"))


def mean_mask(pixels: DataFrame, quantile: float) -> DataFrame:
    """Mean over images at each place, and whether it is above a quantile of the means."""
    mean = durable(pixels.groupBy(*RC).agg(F.avg("value").alias("mean")), "mean")
    cut = percentiles(mean, [], "mean", [quantile])
    return mean.crossJoin(F.broadcast(cut)).select(*RC, "mean", (F.col("mean") > F.col("p")[0]).alias("kept"))


def assemble(pixels: DataFrame, row_origin: Column, col_origin: Column, how: Callable[[str], Column]) -> DataFrame:
    """Images shifted by their origins and combined into one by sum or maximum."""
    shifted = pixels.select((F.col("row") + row_origin).cast("long").alias("row"), (F.col("col") + col_origin).cast("long").alias("col"), "value")
    return shifted.groupBy(*RC).agg(how("value").cast("long").alias("value"))


def moments(mask: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Raw moments m, central moments mu, normalised moments nu up to order three and seven Hu invariants of weighted pixels."""
    x, y, v = F.col("col").cast("double"), F.col("row").cast("double"), F.col("value").cast("double")
    orders = [(p, q) for p in range(4) for q in range(4 - p)]
    raw = mask.groupBy(*keys).agg(*[F.sum(v * F.pow(x, F.lit(p)) * F.pow(y, F.lit(q))).alias(f"m{p}{q}") for p, q in orders])
    m = {o: F.col(f"m{o[0]}{o[1]}") for o in orders}
    cx, cy = m[1, 0] / m[0, 0], m[0, 1] / m[0, 0]
    mu = {
        (2, 0): m[2, 0] - cx * m[1, 0],
        (1, 1): m[1, 1] - cx * m[0, 1],
        (0, 2): m[0, 2] - cy * m[0, 1],
        (3, 0): m[3, 0] - 3 * cx * m[2, 0] + 2 * cx * cx * m[1, 0],
        (2, 1): m[2, 1] - 2 * cx * m[1, 1] - cy * m[2, 0] + 2 * cx * cx * m[0, 1],
        (1, 2): m[1, 2] - 2 * cy * m[1, 1] - cx * m[0, 2] + 2 * cy * cy * m[1, 0],
        (0, 3): m[0, 3] - 3 * cy * m[0, 2] + 2 * cy * cy * m[0, 1],
    }
    rows = raw.withColumns({f"mu{p}{q}": c for (p, q), c in mu.items()})
    rows = rows.withColumns({f"nu{p}{q}": F.col(f"mu{p}{q}") / F.pow(F.col("m00"), F.lit((p + q) / 2 + 1)) for p, q in mu})
    n = {o: F.col(f"nu{o[0]}{o[1]}") for o in mu}
    a, b = n[3, 0] + n[1, 2], n[2, 1] + n[0, 3]
    c, d = n[3, 0] - 3 * n[1, 2], 3 * n[2, 1] - n[0, 3]
    s, t = n[2, 0] - n[0, 2], n[1, 1]
    hu = [n[2, 0] + n[0, 2], s * s + 4 * t * t, c * c + d * d, a * a + b * b, c * a * (a * a - 3 * b * b) + d * b * (3 * a * a - b * b), s * (a * a - b * b) + 4 * t * a * b, d * a * (a * a - 3 * b * b) - c * b * (3 * a * a - b * b)]
    return rows.withColumns({f"h{i}": e for i, e in enumerate(hu)})


def _around_shares(shares: DataFrame, reference: DataFrame) -> DataFrame:
    """For each share the reference rows next to it: (share, below, above), structs of share and ref; null beyond the ends.

    reference: distinct share and ref. Shares and reference are dealt by range together, so no range meets another's rows; of what lies
    before and behind a range its neighbours need one row each.
    """
    rows = shares.select("share", F.lit(None).cast(reference.schema["ref"].dataType).alias("ref")).unionByName(reference.select("share", "ref"))
    dealt = durable(rows.repartitionByRange("share").withColumn("__part", F.spark_partition_id()), "ranges")
    here = F.when(F.col("ref").isNotNull(), F.struct("share", "ref"))
    ends = dealt.groupBy("__part").agg(F.min(here).alias("lo"), F.max(here).alias("hi"))  # as many rows as the session has shuffle partitions
    before = F.last("hi", True).over(W.orderBy("__part").rowsBetween(W.unboundedPreceding, -1))
    behind = F.last("lo", True).over(W.orderBy(F.desc("__part")).rowsBetween(W.unboundedPreceding, -1))
    ends = ends.select("__part", before.alias("before"), behind.alias("behind"))
    inside = W.partitionBy("__part")
    up, down = (F.last(here, True).over(inside.orderBy(o, F.col("ref").isNull()).rowsBetween(W.unboundedPreceding, W.currentRow)) for o in (F.asc("share"), F.desc("share")))
    found = dealt.withColumns({"below": up, "above": down}).where("ref is null").join(F.broadcast(ends), "__part")
    return found.select("share", F.coalesce("below", "before").alias("below"), F.coalesce("above", "behind").alias("above"))


def match_histogram(pixels: DataFrame, reference: DataFrame, linear: bool = False, top: int | None = None) -> DataFrame:
    """Values mapped so that an image's distribution follows the reference's.

    To the smallest reference value whose share reaches the pixel value's; linear: interpolated between the reference
    values around the share, and the smallest one below all. top: the result divided by its image's largest
    value, times top, truncated (65535 for 16 bits); 0 where the largest value is 0. An empty reference gives null values.
    """
    from cartoscope.operators.stats import ecdf, running_sums

    own = durable(ecdf(pixels, ["image"], "value"), "shares")
    counts = running_sums(reference.where("value is not null").groupBy("value").agg(F.count("*").alias("n")), F.col("value"), ["n"])
    total = reference.where("value is not null").agg(F.count("*").alias("total"))
    ref = counts.crossJoin(F.broadcast(total)).select(F.col("value").alias("ref"), (F.col("upto_n") / F.col("total")).alias("share"))
    near = _around_shares(own.select("share").distinct(), ref)
    a, b = F.col("below"), F.col("above")
    if linear:
        slope = (b["ref"] - a["ref"]) / F.nullif(b["share"] - a["share"], F.lit(0.0))
        to = F.when(a.isNull(), b["ref"]).when(b.isNull() | (a["share"] == b["share"]), a["ref"]).otherwise(slope * (F.col("share") - a["share"]) + a["ref"]).cast("double")
    else:
        to = b["ref"]
    found = own.join(near.select("share", to.alias("to")), "share").select("image", "value", "to")
    if top is not None:
        largest = found.groupBy("image").agg(F.max("to").alias("largest"))
        scaled = F.when(F.col("largest") == 0, 0).otherwise(F.floor(F.lit(top) * (F.col("to") / F.nullif(F.col("largest"), F.lit(0)))))
        found = found.join(largest, "image").select("image", "value", scaled.cast("long").alias("to"))
    return pixels.join(found, ["image", "value"]).withColumn("value", F.col("to")).drop("to")


def sobel_energy(pixels: DataFrame) -> DataFrame:
    """Mean gradient magnitude of each image by 3 x 3 differences over a neighbour join (inner pixels only)."""
    kernel = [(-1, -1, -1, -1), (-1, 1, 1, -1), (0, -1, -2, 0), (0, 1, 2, 0), (1, -1, -1, 1), (1, 1, 1, 1), (-1, 0, 0, -2), (1, 0, 0, 2)]
    each = pixels.select("image", *RC, "value", F.explode(F.array(*[F.struct(F.lit(i).alias("i"), F.lit(j).alias("j"), F.lit(a).alias("a"), F.lit(b).alias("b")) for i, j, a, b in kernel])).alias("k"))
    each = each.select("image", (F.col("row") - F.col("k.i")).alias("row"), (F.col("col") - F.col("k.j")).alias("col"), (F.col("value") * F.col("k.a")).alias("gx"), (F.col("value") * F.col("k.b")).alias("gy"))
    g = each.groupBy("image", *RC).agg(F.sum("gx").alias("gx"), F.sum("gy").alias("gy"), F.count("*").alias("n")).where("n = 8")
    return g.groupBy("image").agg(F.avg(F.sqrt((F.col("gx") * F.col("gx") + F.col("gy") * F.col("gy")).cast("double"))).alias("energy"))
