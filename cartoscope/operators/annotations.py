"""Annotation JSON to point and polygon rows, and back. Children without the wanted keys are dropped, the others stay."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cartoscope.functions.scalars import M_UM

VOLUME = "struct<type:string,childJsons:array<struct<type:string,childJsons:array<struct<type:string,pointA:array<double>,pointB:array<double>>>>>>"
#: What vertices are read from: first points only.
VERTICES = "struct<type:string,childJsons:array<struct<childJsons:array<struct<pointA:array<double>>>>>>"
CLOUD = "struct<type:string,childJsons:array<struct<type:string,point:array<double>>>>"
POINT = "struct<type:string,point:array<double>,description:string>"


def _scaled(p: Column, resolution: tuple[float, float, float]) -> list[Column]:
    """Metres to pixels of the three axes."""
    return [p[i] * M_UM / r for i, r in enumerate(resolution)]


def _parsed(sessions: DataFrame, key: str, text: str, schema: str) -> DataFrame:
    """Rows (key, v) of the parsed texts. A generator stands between, so a text is made and parsed once, not again in every filter on v."""
    return sessions.select(key, F.explode(F.array(F.from_json(text, schema))).alias("v"))


def volume_points(sessions: DataFrame, key: str, text: str, resolution: tuple[float, float, float]) -> DataFrame:
    """Vertices (key, polygon, point_order, x, y, section) of volumes: the first points of the lines of every polygon."""
    rows = _parsed(sessions, key, text, VERTICES).where("v.type = 'volume'")
    rows = rows.select(key, F.posexplode("v.childJsons").alias("polygon", "p"))
    rows = rows.select(key, "polygon", F.posexplode("p.childJsons").alias("point_order", "l")).where("size(l.pointA) = 3")
    x, y, z = _scaled(F.col("l.pointA"), resolution)
    return rows.select(key, "polygon", "point_order", F.round(x, 6).alias("x"), F.round(y, 6).alias("y"), F.floor(F.round(z - 0.5, 6)).cast("int").alias("section"))


def cloud_points(sessions: DataFrame, key: str, text: str, resolution: tuple[float, float, float]) -> DataFrame:
    """Points (key, x, y, section) of clouds, in whole pixels (halves to even)."""
    rows = _parsed(sessions, key, text, CLOUD).where("v.type = 'cloud'")
    rows = rows.select(key, F.explode("v.childJsons").alias("p")).where("size(p.point) = 3")
    x, y, z = (F.bround(F.round(c, 6), 0).cast("int") for c in _scaled(F.col("p.point"), resolution))
    return rows.select(key, x.alias("x"), y.alias("y"), z.alias("section"))


def com_points(sessions: DataFrame, key: str, text: str) -> DataFrame:
    """Centres of mass (key, x, y, z) in micrometres of sessions of type point."""
    rows = _parsed(sessions, key, text, POINT).where("v.type = 'point' and size(v.point) = 3")
    return rows.select(key, *[F.round(F.col("v.point")[i] * M_UM, 6).alias(c) for i, c in enumerate("xyz")])


def point_json(x: Column, y: Column, z: Column, description: Column) -> Column:
    """The JSON of one point in metres."""
    return F.to_json(F.struct(F.lit("point").alias("type"), F.array(x / M_UM, y / M_UM, z / M_UM).alias("point"), description.alias("description")))


def cloud_json(points: DataFrame, key: str) -> DataFrame:
    """Rows (key, annotation): each key's points as a cloud with its centroid. One key's points make one text, as the format has it."""
    p = F.array(*[F.col(c).cast("double") / M_UM for c in ("x", "y", "z")])
    child = F.struct(F.col("id"), F.struct(p.alias("point"), F.lit("point").alias("type")).alias("c"))
    rows = points.groupBy(key).agg(F.array_sort(F.collect_list(child)).alias("l"), *[(F.avg(c) / M_UM).alias(f"c{c}") for c in "xyz"])
    whole = F.struct(F.lit("cloud").alias("type"), F.array("cx", "cy", "cz").alias("centroid"), F.transform("l", lambda v: v["c"]).alias("childJsons"))
    return rows.select(key, F.to_json(whole).alias("annotation"))


def volume_json(edges: DataFrame, key: str) -> DataFrame:
    """Rows (key, annotation): polygons (edges: key, polygon, section, point_order, x, y, x2, y2) as a volume of line pairs, with centroids of polygons and of all."""
    z = (F.col("section") + 0.5) / M_UM
    line = F.struct(F.array(F.col("x") / M_UM, F.col("y") / M_UM, z).alias("pointA"), F.array(F.col("x2") / M_UM, F.col("y2") / M_UM, z).alias("pointB"), F.lit("line").alias("type"))
    poly = edges.groupBy(key, "polygon").agg(F.sort_array(F.collect_list(F.struct("point_order", line.alias("l")))).alias("l"), *[(F.avg(c) / M_UM).alias(f"c{c}") for c in "xy"], F.first(z).alias("cz"))
    child = F.struct("polygon", F.struct(F.lit("polygon").alias("type"), F.array("cx", "cy", "cz").alias("centroid"), F.transform("l", lambda v: v["l"]).alias("childJsons")).alias("c"))
    whole = poly.groupBy(key).agg(F.sort_array(F.collect_list(child)).alias("l"), *[F.avg(f"c{c}").alias(f"c{c}") for c in "xyz"])
    out = F.struct(F.lit("volume").alias("type"), F.array("cx", "cy", "cz").alias("centroid"), F.transform("l", lambda v: v["c"]).alias("childJsons"))
    return whole.select(key, F.to_json(out).alias("annotation"))
