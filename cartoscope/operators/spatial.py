"""Spatial joins by grid keys: a distance predicate becomes an equi-join on cells, so nothing is a nested loop.

Cells are twice as wide as the distance, so the square around a point touches about four. A dense cell is one
key of the join; the skew join of the adaptive planner splits it. These joins are never broadcast: the planner takes a
table of points for as large as its files, whatever it was exploded to.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from functools import reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window as W

from cartoscope.functions.durable import durable
from cartoscope.sources.writers import changes


def _cell(c: Column, size: float) -> Column:
    return F.floor(c / size)


#: Cells are so many times as wide as the reach of a join.
WIDTH = 2


def _touched(points: DataFrame, reach: float) -> DataFrame:
    """points once for each cell (__cx, __cy) that the square of reach around them touches."""
    for c in "xy":
        room = F.lit(reach * (1 + 1e-6)) + F.abs(c) * 1e-15  # for rounding: more cells than needed
        points = points.withColumn(f"__c{c}", F.explode(F.sequence(_cell(F.col(c) - room, WIDTH * reach), _cell(F.col(c) + room, WIDTH * reach))))
    return points


def _located(points: DataFrame, name: str, section: Column) -> DataFrame:
    return points.select(F.col("id").alias(name), section.alias("section"), F.col("x").cast("double").alias("x"), F.col("y").cast("double").alias("y"))


def _own(c: str, reach: float) -> Column:
    return _cell(F.col(c), WIDTH * reach)


def _met(a: DataFrame, right: DataFrame, reach: float, section: Column) -> DataFrame:
    """Rows (a, b, section, ax, ay, __cx, __cy, d2, dist) of touched points and points of the cells within reach."""
    b = _located(right, "b", section).withColumns({f"__c{c}": _own(c, reach) for c in "xy"}).withColumnsRenamed({"x": "bx", "y": "by"})
    square = (F.col("ax") - F.col("bx")) * (F.col("ax") - F.col("bx")) + (F.col("ay") - F.col("by")) * (F.col("ay") - F.col("by"))
    pairs = a.withColumnsRenamed({"x": "ax", "y": "ay"}).join(b.hint("merge"), ["section", "__cx", "__cy"]).withColumn("d2", square)
    return pairs.where(F.col("d2") <= reach * reach).withColumn("dist", F.sqrt("d2"))


def candidate_pairs(left: DataFrame, right: DataFrame, reach: float, section_step: int = 0) -> DataFrame:
    """Pairs (a, b, section, dist) of ids of left and right in one section (right: section + step) within reach."""
    a = _touched(_located(left, "a", F.col("section")), reach)
    return _met(a, right, reach, (F.col("section") - section_step).cast(left.schema["section"].dataType)).select("a", "b", "section", "d2", "dist")


def proximity_pairs(points: DataFrame, pair_distance: float = 30) -> DataFrame:
    """Unordered pairs of points of one section that are strictly closer than pair_distance.

    A point looks into its own cell and the touched ones behind it (by row, then column), so a pair meets once.
    """
    reach = pair_distance
    behind = (F.col("__cy") > _own("y", reach)) | ((F.col("__cy") == _own("y", reach)) & (F.col("__cx") >= _own("x", reach)))
    a = _touched(_located(points, "a", F.col("section")), reach).where(behind)
    same = (F.col("__cx") == _own("ax", reach)) & (F.col("__cy") == _own("ay", reach))
    pairs = _met(a, points, reach, F.col("section")).where((F.col("a") < F.col("b")) | ((F.col("a") > F.col("b")) & ~same))
    return pairs.where(F.col("d2") < pair_distance**2).select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"), "section", "dist")


def across_sections(points: DataFrame, pair_distance: float = 30) -> DataFrame:
    """Pairs of a point and one of the next section, strictly closer than pair_distance in the plane."""
    return candidate_pairs(points, points, pair_distance, 1).where(F.col("d2") < pair_distance**2).select("a", "b", "section", "dist")


def nearest_within(points: DataFrame, reference: DataFrame, most: float, inclusive: bool = False) -> DataFrame:
    """For each point its nearest reference point of the section, closer than most (or at distance 0); ties: smaller id."""
    pairs = candidate_pairs(points, reference, most)
    pairs = pairs if inclusive else pairs.where((F.col("d2") < most * most) | (F.col("d2") == 0))
    best = pairs.groupBy("a", "section").agg(F.min(F.struct("d2", "b", "dist")).alias("m"))
    return best.select("a", F.col("m.b").alias("b"), "section", F.col("m.dist").alias("dist"))


def labelled_segments(labels: DataFrame, segments: DataFrame, most: float) -> DataFrame:
    """Segments (distinct ids) that are the nearest one of some label."""
    return nearest_within(labels, segments, most, inclusive=True).select(F.col("b").alias("id"), "section").distinct()


def without_annotated(detections: DataFrame, annotated: DataFrame, most: float) -> DataFrame:
    """Detections that have no annotated point within most."""
    near = nearest_within(detections, annotated, most).select(F.col("a").alias("id"))
    return detections.join(near, "id", "left_anti")


def next_slice(points: DataFrame, most: float, z: str = "section") -> DataFrame:
    """For each point the nearest one of the next slice that has points, within most: rows (a, b, z, next_z, dist)."""
    slices = points.select(z).distinct()
    after = slices.withColumn("next_z", F.lead(z).over(W.orderBy(z))).where("next_z is not null")  # one row a slice
    here = points.join(F.broadcast(after) if after.count() < 100_000 else after, z).withColumnRenamed(z, "__z").withColumn("section", F.col("next_z"))
    pairs = nearest_within(here, points.withColumnRenamed(z, "section") if z != "section" else points, most, inclusive=True)
    back = after.select(F.col("next_z").alias("section"), F.col(z).alias("z"))
    return pairs.join(back, "section").select("a", "b", "z", F.col("section").alias("next_z"), "dist")


def to_tiles(points: DataFrame, width: float, height: float) -> DataFrame:
    """points with their tile and the coordinates within it."""
    tx, ty = F.floor(F.col("x") / width), F.floor(F.col("y") / height)
    return points.withColumns({"tile_x": tx, "tile_y": ty, "local_x": F.col("x") - tx * width, "local_y": F.col("y") - ty * height})


def polygon_edges(vertices: DataFrame, keys: Sequence[str] = ("polygon", "section")) -> DataFrame:
    """Edges (keys, point_order, x, y, x2, y2): each vertex with the next one, the last with the first."""
    w = W.partitionBy(*keys).orderBy("point_order")
    whole = w.rowsBetween(W.unboundedPreceding, W.unboundedFollowing)
    nxt = {f"{c}2": F.coalesce(F.lead(c).over(w), F.first(c).over(whole)) for c in "xy"}
    return vertices.withColumns(nxt).select(*keys, "point_order", "x", "y", "x2", "y2")


#: Edges of a cell that are columns and tested without a loop.
COMPILED = 8
#: Rows of an edge and a cell that are made at once, unless one polygon has more.
AT_ONCE = 1 << 19
#: An edge, and the columns of all edges of a part.
EDGE = ("x", "y", "x2", "y2")
BOX = ("__west", "__south", "__east", "__north")
COLUMNS = [f"__{c}_{i}" for i in range(COMPILED) for c in EDGE]


def _spread(counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Each index as often as counts says, and the number of the repetition."""
    index = np.repeat(np.arange(len(counts)), counts)
    return index, np.arange(len(index)) - np.repeat(np.cumsum(counts) - counts, counts)


class _Cutter:
    """Cuts polygons, whose vertices come in order, into the parts of their cells that have at most COMPILED edges, or (long) more.

    only: (section, cx, cy) of the cells that are asked for.
    """

    def __init__(self, cell: float, only: pa.Table | None = None, long: bool = False):
        self.cell, self.only, self.long = float(cell), only, long

    def __call__(self, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Rows (section, polygon, x, y) to (section, polygon, cx, cy, box, odd, size, edges). A polygon may reach over batches."""
        if self.only is not None:
            self.sections = self.only["section"].combine_chunks().unique()
            at = pc.index_in(self.only["section"].combine_chunks(), self.sections).to_numpy(zero_copy_only=False).astype(np.int64)
            cx, cy = (self.only[c].to_numpy() for c in ("cx", "cy"))
            self.x0, self.y0 = (int(v.min()) if len(v) else 0 for v in (cx, cy))
            self.nx, self.ny = (int(v.max()) - v0 + 1 if len(v) else 1 for v, v0 in ((cx, self.x0), (cy, self.y0)))
            self.codes = np.unique((at * self.ny + cy - self.y0) * self.nx + cx - self.x0)
        held: list[pa.RecordBatch] = []  # of the polygon that the last batch ended with
        for batch in batches:
            if not len(batch):
                continue
            if held and all(held[-1].column(i).slice(len(held[-1]) - 1).equals(batch.column(i).slice(0, 1)) for i in (0, 1)):
                starts = np.flatnonzero(changes(batch.column(0)) | changes(batch.column(1)))
                if len(starts) == 1:
                    held.append(batch)
                    continue
            table = pa.Table.from_batches([*held, batch]).combine_chunks()
            batch = table.to_batches()[0]
            last = int(np.flatnonzero(changes(batch.column(0)) | changes(batch.column(1)))[-1])
            held = [batch.slice(last)]
            yield from self.cut(batch.slice(0, last))
        if held:
            yield from self.cut(pa.Table.from_batches(held).combine_chunks().to_batches()[0])

    def cut(self, rows: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        """Parts of whole polygons."""
        if not len(rows):
            return
        cell = self.cell
        x, y = (rows.column(i).to_numpy(zero_copy_only=False) for i in (2, 3))
        if np.isinf(x).any() or np.isinf(y).any():
            raise ValueError("a polygon has a vertex at infinity")
        new = changes(rows.column(0)) | changes(rows.column(1))
        starts, polygon = np.flatnonzero(new), np.cumsum(new) - 1
        after = np.arange(1, len(x) + 1)
        after[np.append(starts[1:], len(x)) - 1] = starts
        x2, y2 = x[after], y[after]
        some = ~(np.isnan(x) | np.isnan(y) | np.isnan(x2) | np.isnan(y2))  # an edge without an end counts for nothing
        with np.errstate(invalid="ignore"):
            box = np.stack([f.reduceat(v, starts) for f in (np.minimum, np.maximum) for v in (x, y)])
        open_ = np.isnan(box).any(0)  # without its unknown edges a polygon is not closed
        box[:2, open_], box[2:, open_] = -np.inf, np.inf
        if self.long:  # a polygon of a few edges has no cell of more
            some &= np.diff(np.append(starts, len(x)))[polygon] > COMPILED
            if not some.any():
                return
        if self.only is not None:
            section = pc.index_in(rows.column(0), self.sections)
            some &= section.is_valid().to_numpy(zero_copy_only=False)
            section = pc.fill_null(section, 0).to_numpy(zero_copy_only=False).astype(np.int64)
        x, y, x2, y2, polygon, first = x[some], y[some], x2[some], y2[some], polygon[some], starts[polygon[some]]
        low, high = np.minimum(y, y2), np.maximum(y, y2)
        under, over = (np.floor(v / cell).astype(np.int64) for v in (low, high))
        if self.only is not None:
            section = section[some]
        for a, b in self.pieces(polygon, over - under + 1):
            e, step = _spread((over - under + 1)[a:b])
            e += a
            cy = under[e] + step
            bottom, top = cy * cell, (cy + 1) * cell
            with np.errstate(divide="ignore", invalid="ignore"):
                at = lambda v: x[e] + (v - y[e]) * (x2[e] - x[e]) / (y2[e] - y[e])  # noqa: B023, E731
                level = y2[e] == y[e]
                ends = [np.where(level, x[e], at(np.maximum(low[e], bottom))), np.where(level, x2[e], at(np.minimum(high[e], top)))]
            room = 1e-6 * cell + 1e-9 * (np.abs(x[e]) + np.abs(x2[e]))  # for rounding: more cells than needed hold the edge
            left = np.maximum(np.minimum(*ends) - room, np.minimum(x[e], x2[e]))
            right = np.minimum(np.maximum(*ends) + room, np.maximum(x[e], x2[e]))
            own, last = (np.floor(v / cell).astype(np.int64) for v in (left, right))
            whole = (low[e] <= bottom) & (high[e] >= top)
            # the leftmost cell of the polygon in the strip
            strip = np.lexsort((cy, polygon[e]))
            heads = np.flatnonzero(np.append(True, (np.diff(cy[strip]) != 0) | (np.diff(polygon[e][strip]) != 0)))
            lo = np.empty(len(e), np.int64)
            lo[strip] = np.repeat(np.minimum.reduceat(own[strip], heads), np.diff(np.append(heads, len(strip)))) if len(strip) else 0
            if self.only is None:
                begin, count = lo, last - lo + 1
            else:
                base = (section[e] * self.ny + cy - self.y0) * self.nx - self.x0
                inside = (cy >= self.y0) & (cy < self.y0 + self.ny)
                near, far = np.clip(lo, self.x0, self.x0 + self.nx), np.clip(last, self.x0 - 1, self.x0 + self.nx - 1)
                begin = np.searchsorted(self.codes, base + near, "left")
                count = np.where(inside & (near <= far), np.searchsorted(self.codes, base + far, "right") - begin, 0)
            for c, d in self.pieces(polygon[e], count):
                r, step = _spread(count[c:d])
                r += c
                cx = begin[r] + step
                if self.only is not None:
                    cx = self.codes[cx] - base[r]
                if len(r):
                    plain = whole[r] & (cx < own[r])
                    yield self.packed(rows, box, first[e[r]], polygon[e[r]], cy[r], cx, plain, [v[e[r]] for v in (x, y, x2, y2)])

    def pieces(self, polygon: np.ndarray, counts: np.ndarray) -> Iterator[tuple[int, int]]:
        """Ranges of whole polygons of about AT_ONCE rows."""
        ends = np.append(np.flatnonzero(np.diff(polygon)) + 1, len(polygon)) if len(polygon) else []
        a, sums = 0, np.append(0, np.cumsum(counts))
        for i, b in enumerate(ends):
            if i == len(ends) - 1 or sums[ends[i + 1]] - sums[a] > AT_ONCE:
                yield a, int(b)
                a = int(b)

    def packed(self, rows: pa.RecordBatch, box: np.ndarray, first: np.ndarray, polygon: np.ndarray, cy: np.ndarray, cx: np.ndarray, plain: np.ndarray, edge: list[np.ndarray]) -> pa.RecordBatch:
        order = np.lexsort((plain, cx, cy, polygon))  # the edges of a cell, then what only counts
        first, polygon, cy, cx, plain, edge = (v[order] for v in (first, polygon, cy, cx, plain, np.stack(edge, 1)))
        heads = np.flatnonzero(np.append(True, (np.diff(cx) != 0) | (np.diff(cy) != 0) | (np.diff(polygon) != 0)))
        odd, edges = np.add.reduceat(plain, heads, dtype=np.int64) % 2 == 1, np.add.reduceat(~plain, heads, dtype=np.int64)
        part = np.repeat(np.arange(len(heads)), np.diff(np.append(heads, len(cx))))
        place = np.arange(len(cx)) - heads[part]
        kept = (edges > COMPILED) if self.long else (edges <= COMPILED) & ((edges > 0) | odd)
        at = pa.array(first[heads])
        out = [rows.column(0).take(at), rows.column(1).take(at), pa.array(cx[heads]), pa.array(cy[heads]), *[pa.array(v) for v in box[:, polygon[heads]]], pa.array(odd), pa.array(edges.astype(np.int32))]
        if self.long:
            held = pa.StructArray.from_arrays([pa.array(np.ascontiguousarray(v)) for v in edge[~plain].T], list(EDGE))
            out.append(pa.ListArray.from_arrays(np.append(0, np.cumsum(edges)).astype(np.int32), held))
        else:
            columns = np.full((COMPILED, 4, len(heads)), np.inf)  # an edge at infinity is met by none
            some = ~plain & (place < COMPILED)
            columns[place[some], :, part[some]] = edge[some]
            out += [pa.array(v) for v in columns.reshape(-1, len(heads))]
        return pa.RecordBatch.from_arrays(out, ["__section", "polygon", "__pcx", "__pcy", *BOX, "__odd", "__size", *(["__edges"] if self.long else COLUMNS)]).filter(pa.array(kept))


def _parts(vertices: DataFrame, cell: float, only: pa.Table | None = None, long: bool = False) -> DataFrame:
    """What a point of a grid cell has to be tested against, a row a polygon and cell: (__section, polygon, __pcx, __pcy, BOX, __odd, __size, edges).

    In a strip of cells of one height a ray to the right crosses an edge that reaches over the whole strip whatever its height is: cells
    left of it only count such edges (odd: whether their number is). Others are edges that touch the cell, or end within
    its strip right of it. A cell inside a polygon has no edge, a cell outside no row. BOX is the polygon's, size the number of edges. Edges are COLUMNS; the parts with
    more than those hold them in an array __edges, and come with long alone.
    Vertices come to a task in order, so a polygon is cut as it passes. only: the cells that are asked for, as _Cutter takes them.
    """
    kinds = vertices.schema
    v = vertices.select("section", "polygon", F.col("x").cast("double").alias("x"), F.col("y").cast("double").alias("y"), "point_order")
    v = v.repartition("polygon", "section").sortWithinPartitions("polygon", "section", "point_order").drop("point_order")
    edges = "__edges array<struct<x: double not null, y: double not null, x2: double not null, y2: double not null>> not null" if long else ", ".join(f"{c} double not null" for c in COLUMNS)
    schema = f"__section {kinds['section'].dataType.simpleString()}, polygon {kinds['polygon'].dataType.simpleString()}, __pcx long not null, __pcy long not null, {', '.join(f'{c} double not null' for c in BOX)}, __odd boolean not null, __size int not null, {edges}"
    return v.mapInArrow(_Cutter(cell, only, long), schema)


def polygon_cells(vertices: DataFrame, cell: float) -> DataFrame:
    """The rows of _parts, one an edge: (section, polygon, __cx, __cy, x, y, x2, y2, times); a row without an edge where odd."""
    edge = lambda i: F.struct(*[F.col(v).alias(n) for v, n in zip(COLUMNS[4 * i : 4 * i + 4], EDGE, strict=True)])
    few = F.filter(F.array(*[edge(i) for i in range(COMPILED)]), lambda e: e["x"] < float("inf"))
    none = F.array(F.struct(*[F.lit(None).cast("double").alias(n) for n in EDGE]))
    cells = lambda long, edges: _parts(vertices, cell, long=long).select(
        F.col("__section").alias("section"), "polygon", F.col("__pcx").alias("__cx"), F.col("__pcy").alias("__cy"), F.inline(F.concat(F.when(F.col("__odd"), none).otherwise(F.slice(none, 1, 0)), edges)), F.lit(1).alias("times")
    )
    return cells(False, few).unionByName(cells(True, F.col("__edges")))


def _located_in(points: DataFrame, cell: float) -> DataFrame:
    """points (px, py), none of them null, with their cell."""
    known = points.withColumns({c: F.coalesce(c, F.lit(0.0)) for c in ("px", "py")})  # so that the planner knows it too
    return known.withColumns({f"__c{c}": F.floor(F.col(f"p{c}") / cell) for c in "xy"})


def _inside(long: bool = False) -> Column:
    """Whether a point with its cell lies in the polygon of a row of _parts.

    It is asked for every pair, so it is compiled into the join and kept short: the virtual machine does not compile long methods.
    """
    px, py = F.col("px"), F.col("py")
    within = lambda p, v, w: ((v <= p) & (p <= w)) | ((w <= p) & (p <= v))

    def met(x: Column, y: Column, x2: Column, y2: Column) -> tuple[Column, Column]:
        """Whether the edge crosses the ray right of the point (compared without a division), and whether the point lies on it."""
        a, b = (px - x) * (y2 - y), (py - y) * (x2 - x)
        return ((y > py) != (y2 > py)) & (a != b) & ((a < b) == (y2 > y)), (a == b) & within(py, y, y2) & within(px, x, x2)

    same = (F.col("section") == F.col("__section")) & (F.col("__cx") == F.col("__pcx")) & (F.col("__cy") == F.col("__pcy"))
    same = same & (px > F.col(BOX[0])) & (px < F.col(BOX[2])) & (py > F.col(BOX[1])) & (py < F.col(BOX[3]))
    if long:
        edge = lambda e: met(*[e[c] for c in EDGE])
        odd = F.aggregate("__edges", F.col("__odd"), lambda n, e: n != edge(e)[0])
        return same & odd & ~F.exists("__edges", lambda e: edge(e)[1])
    crossed, on = zip(*[met(*[F.col(c) for c in COLUMNS[4 * i : 4 * i + 4]]) for i in range(COMPILED)], strict=True)
    half = COMPILED // 2  # most cells have no more edges
    odd = [reduce(lambda a, b: a != b, c) for c in ([F.col("__odd"), *crossed[:half]], crossed[half:])]
    met_any = [reduce(lambda a, b: a | b, o) for o in (on[:half], on[half:])]
    more = F.col("__size") > half
    return same & (odd[0] != (more & odd[1])) & ~(met_any[0] | (more & met_any[1]))


#: Ids of points of one place that stand in a row.
IDS = 1000


def in_polygons(points: DataFrame, vertices: DataFrame, cell: float = 64) -> DataFrame:
    """Pairs (id, polygon, section): points strictly inside a polygon of their section (even-odd rule).

    Polygons have three vertices or more (fewer enclose nothing); points on an edge are outside. A place meets a polygon once, however many
    points lie there, with what the polygon has in its cell: none or the few edges there. So the join itself answers and no pair is shuffled.
    """
    p = points.select("id", "section", F.col("x").cast("double").alias("px"), F.col("y").cast("double").alias("py")).dropna(subset=["section", "px", "py"])
    place = ["section", "px", "py"]
    p = p.withColumn("__group", F.floor((F.row_number().over(W.partitionBy(*place).orderBy("px")) - 1) / IDS))
    places = _located_in(p.groupBy(*place, "__group").agg(F.collect_list(F.struct("id")).alias("ids")), cell)
    # the places of a cell are held, its polygons pass by
    pairs = [_parts(vertices, cell, long=long).join(places.hint("merge"), _inside(long)).select(F.explode("ids").alias("id"), "polygon", "section") for long in (False, True)]
    return pairs[0].unionByName(pairs[1]).select("id.*", "polygon", "section")


#: A polygon in so many is asked first by polygon_union, and the cells of the others that are asked are so much narrower. Cells that the others may be limited to.
FIRST, NARROWER, ASKED = 64, 4, 1 << 20


def _unheld(places: DataFrame, vertices: DataFrame, cell: float, only: pa.Table | None = None) -> DataFrame:
    """Places (section, px, py) that lie in no polygon. A place asks polygons until one holds it; no pairs are made."""
    left = _located_in(places.distinct(), cell)
    for long in (False, True):
        left = left.join(_parts(vertices, cell, only, long).hint("merge"), _inside(long), "left_anti")
    return left.select("section", "px", "py")


def polygon_union(points: DataFrame, vertices: DataFrame, cell: float = 64) -> DataFrame:
    """Points that lie in any polygon of their section.

    Some polygons are asked first: where they lie over each other, these hold most places. The others are cut only into the (narrower) cells
    of the places that are left, so what is shuffled follows those.
    """
    place = {"section": F.col("section"), "px": F.col("x").cast("double"), "py": F.col("y").cast("double")}
    places = points.select(*[v.alias(c) for c, v in place.items()]).dropna()
    first = F.pmod(F.xxhash64("polygon"), F.lit(FIRST)) == 0
    left, narrow = durable(_unheld(places, vertices.where(first), cell), "places"), cell / NARROWER
    cells = _located_in(left, narrow).select("section", F.col("__cx").alias("cx"), F.col("__cy").alias("cy")).distinct().limit(ASKED + 1).toArrow()
    none = _unheld(left, vertices.where(~first), narrow, cells if len(cells) <= ASKED else None)
    located = points.withColumns({f"__{c}": v for c, v in place.items()}).dropna(subset=[f"__{c}" for c in place])
    same = [F.col(f"__{c}") == F.col(f"none.{c}") for c in place]
    return located.join(none.alias("none"), same, "left_anti").select(*points.columns)


def polygon_intersection(points: DataFrame, vertices: DataFrame, cell: float = 64) -> DataFrame:
    """Points that lie in all polygons (of three vertices or more) of their section, which has one at least.

    Only points strictly inside the boxes of all polygons, and of cells that every polygon has a row for, can be such. Where no point is in all boxes,
    no polygon is cut; otherwise only those of sections that have one.
    """
    # a box with an unknown corner excludes nothing
    known = F.count(F.col("x") + F.col("y")) == F.count("*")
    box = {f"{f}_{c}": F.when(known, getattr(F, f)(c).cast("double")) for f in ("min", "max") for c in "xy"}
    boxes = vertices.groupBy("polygon", "section").agg(F.count("*").alias("n"), *[v.alias(c) for c, v in box.items()]).where("n >= 3")
    core = boxes.groupBy("section").agg(F.count("*").alias("total"), *[(F.max if c.startswith("min") else F.min)(c).alias(c) for c in box])
    core = durable(core.withColumnsRenamed({"section": "__section"}), "core")
    x, y = (F.col(c).cast("double") for c in "xy")
    held = [F.coalesce(F.col(f"min_{c}") < v, F.lit(True)) & F.coalesce(v < F.col(f"max_{c}"), F.lit(True)) for c, v in (("x", x), ("y", y))]
    within = points.join(core, (F.col("section") == F.col("__section")) & x.isNotNull() & y.isNotNull() & held[0] & held[1]).select(*points.columns)
    boxed = durable(within, "boxed")
    if boxed.isEmpty():
        return boxed
    total = core.select(F.col("__section").alias("section"), "total")
    near = vertices.join(boxed.select("section").distinct(), "section", "left_semi")
    cells = [_parts(near, cell, long=long).select(F.col("__section").alias("section"), F.col("__pcx").alias("__cx"), F.col("__pcy").alias("__cy")) for long in (False, True)]
    each = cells[0].unionByName(cells[1]).groupBy("section", "__cx", "__cy").agg(F.count("*").alias("n"))
    full = each.join(total, "section").where("n >= total").select("section", "__cx", "__cy")
    located = boxed.withColumns({f"__c{c}": F.floor(F.col(c).cast("double") / cell) for c in "xy"})
    some = located.join(full, ["section", "__cx", "__cy"], "left_semi").select(*points.columns)
    inside = in_polygons(some, near, cell).groupBy("id", "section").agg(F.count("*").alias("n")).join(total, "section").where("n = total")
    return boxed.join(inside.select("id"), "id", "left_semi")


def on_mask(detections: DataFrame, mask: DataFrame, scale: int = 32) -> DataFrame:
    """detections with on_mask: whether the mask has their downsampled pixel (section, row, col)."""
    m = mask.select("section", "row", "col").distinct().withColumn("__on", F.lit(True))
    keyed = detections.withColumns({"row": F.floor(F.col("y") / scale), "col": F.floor(F.col("x") / scale)})
    return keyed.join(m, ["section", "row", "col"], "left").select(*detections.columns, F.coalesce("__on", F.lit(False)).alias("on_mask"))


def voxel_structures(points: DataFrame, atlas: DataFrame) -> DataFrame:
    """points with the structure of their voxel (coordinates truncated); 0 where the atlas has none."""
    keyed = points.withColumns({f"__{c}": F.col(c).cast("long") for c in "zyx"})
    a = atlas.select(*[F.col(c).cast("long").alias(f"__{c}") for c in "zyx"], "structure")
    return keyed.join(a, ["__z", "__y", "__x"], "left").select(*points.columns, F.coalesce("structure", F.lit(0)).alias("structure"))


def adjacent_boxes(boxes: DataFrame, axes: Sequence[str]) -> DataFrame:
    """Ordered pairs of boxes whose grid coordinates differ by at most one on every axis: columns and columns with suffix 2."""
    steps = F.array(*[F.struct(*[F.lit(s).alias(c) for c, s in zip(axes, o, strict=True)]) for o in _offsets(len(axes))])
    left = boxes.withColumn("__o", F.explode(steps))
    left = left.withColumns({f"__{c}": F.col(c) + F.col(f"__o.{c}") for c in axes}).drop("__o")
    right = boxes.select([F.col(c).alias(f"{c}2") for c in boxes.columns]).withColumns({f"__{c}": F.col(f"{c}2") for c in axes})
    return left.join(right, [f"__{c}" for c in axes]).drop(*[f"__{c}" for c in axes])


def _offsets(n: int) -> list[tuple[int, ...]]:
    out: list[tuple[int, ...]] = [()]
    for _ in range(n):
        out = [(*o, s) for o in out for s in (-1, 0, 1)]
    return [o for o in out if any(o)]


def plane_overlap(objects: DataFrame, cells: DataFrame, box: float) -> DataFrame:
    """Objects of consecutive planes whose centres lie within a box and whose filled areas share a cell: (a, b, z, shared).

    objects: id, section, x, y; cells: id, row, col (the filled area of each object).
    """
    near = candidate_pairs(objects, objects, box * 2**0.5 + 1e-9, 1)
    xy = objects.select("id", F.col("x").cast("double").alias("x"), F.col("y").cast("double").alias("y"))
    near = near.join(xy.select(F.col("id").alias("a"), F.col("x").alias("ax"), F.col("y").alias("ay")), "a").join(xy.select(F.col("id").alias("b"), F.col("x").alias("bx"), F.col("y").alias("by")), "b")
    near = near.where((F.abs(F.col("ax") - F.col("bx")) <= box) & (F.abs(F.col("ay") - F.col("by")) <= box)).select("a", "b", "section")
    left = near.join(cells.select(F.col("id").alias("a"), "row", "col"), "a")
    both = left.join(cells.select(F.col("id").alias("b"), "row", "col"), ["b", "row", "col"])
    return both.groupBy("a", "b", F.col("section").alias("z")).agg(F.count("*").alias("shared"))
