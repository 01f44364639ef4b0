"""Queries on ordered rows: scenes, sessions, contours, annotations, snapshots."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cartoscope.operators import annotations as A
from cartoscope.operators import contours as C
from cartoscope.operators import metadata as M
from cartoscope.operators import spatial as P
from cartoscope.plans import tables as T
from cartoscope.plans.registry import TABLES_SQL, Tables, query

TABLES_SQL["edg"] = """SELECT polygon, section, point_order, x, y, coalesce(lead(x) OVER w, first(x) OVER w) AS x2, coalesce(lead(y) OVER w, first(y) OVER w) AS y2 FROM @pol
  WINDOW w AS (PARTITION BY polygon ORDER BY point_order ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING)"""
TABLES_SQL["arc"] = "SELECT *, sqrt(((x2 - x) * (x2 - x) + (y2 - y) * (y2 - y))::DOUBLE) AS length FROM @edg"


@query("SELECT slide, scene, channel, file, row_number() OVER (PARTITION BY channel ORDER BY slide, scene, file) - 1 AS scene_order FROM (SELECT DISTINCT slide, scene, channel, file FROM @scn)")
def win_scene_order(t: Tables) -> DataFrame:
    return M.scene_order(T.scenes(t)).select("slide", "scene", "channel", "file", "scene_order")


@query("SELECT id, row_number() OVER (ORDER BY section, id) - 1 AS section, lpad((row_number() OVER (ORDER BY section, id) - 1)::VARCHAR, greatest(3, length((row_number() OVER (ORDER BY section, id) - 1)::VARCHAR))::INTEGER, '0') || '.tif' AS file_name FROM @human")
def win_section_number(t: Tables) -> DataFrame:
    rows = M.section_files(T.human_points(t).select("id", F.col("section").alias("old")), ["old", "id"])
    number = F.col("section").cast("string")
    return rows.select("id", "section", F.concat(F.lpad(number, F.greatest(F.lit(3), F.length(number)), F.lit("0")), F.lit(".tif")).alias("file_name"))


@query("SELECT id, prep, annotator, label FROM (SELECT *, row_number() OVER (PARTITION BY prep, annotator, label ORDER BY updated DESC, id DESC) AS r FROM @ses WHERE active) WHERE r = 1")
def win_latest_session(t: Tables) -> DataFrame:
    return M.latest(T.sessions(t).where("active"), ["prep", "annotator", "label"], ["updated", "id"]).select("id", "prep", "annotator", "label")


@query("SELECT slide, scene, channel, file, min(slide) OVER (PARTITION BY scan_run, file) AS master, slide = min(slide) OVER (PARTITION BY scan_run, file) AS master_active FROM @scn")
def win_master_slide(t: Tables) -> DataFrame:
    return M.master_slides(T.scenes(t), ["scan_run", "file"], "slide").select("slide", "scene", "channel", "file", "master", "master_active")


@query("SELECT id, prep, label FROM (SELECT *, row_number() OVER (PARTITION BY prep, label ORDER BY id) AS r FROM @ses) WHERE r = 1")
def win_dedupe_keep_first(t: Tables) -> DataFrame:
    return M.keep_first(T.sessions(t), ["prep", "label"], ["id"]).select("id", "prep", "label")


@query("SELECT polygon, section, point_order, x, y, x2, y2 FROM @edg")
def win_polygon_edges(t: Tables) -> DataFrame:
    return P.polygon_edges(T.polygons(t))


@query("SELECT polygon, section, point_order, length, round(coalesce(sum(length) OVER (PARTITION BY polygon ORDER BY point_order ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0), 6) AS arc FROM @arc")
def win_arc_length(t: Tables) -> DataFrame:
    return C.edge_lengths(T.polygons(t)).select("polygon", "section", "point_order", "length", F.round("arc", 6).alias("arc"))


@query()
def win_resample_even(t: Tables) -> DataFrame:
    return C.resample_even(T.polygons(t), 20).select("polygon", "section", "point_order", F.round("x", 6).alias("x"), F.round("y", 6).alias("y"))


@query("SELECT polygon, section, 2 * point_order - 1 AS point_order, x::DOUBLE AS x, y::DOUBLE AS y FROM @edg UNION ALL SELECT polygon, section, 2 * point_order, (x + x2) / 2, (y + y2) / 2 FROM @edg")
def win_densify(t: Tables) -> DataFrame:
    return C.densify(T.polygons(t))


@query("SELECT polygon, section, row_number() OVER (PARTITION BY polygon ORDER BY round(-atan2(y - cy, x - cx), 9), x, y) AS point_order, x, y FROM (SELECT *, avg(x) OVER (PARTITION BY polygon) AS cx, avg(y) OVER (PARTITION BY polygon) AS cy FROM (SELECT DISTINCT polygon, section, x, y FROM @pol))")
def win_angle_sort(t: Tables) -> DataFrame:
    return C.angle_sorted(T.polygons(t))


@query("""WITH p AS (SELECT animal, section, min(id) AS polygon FROM @human_all WHERE section % 3 > 0 GROUP BY ALL), s AS (SELECT animal, unnest(range(min(section), max(section) + 1))::INTEGER AS section FROM p GROUP BY animal)
  SELECT s.animal, s.section, last_value(p.polygon IGNORE NULLS) OVER (PARTITION BY s.animal ORDER BY s.section ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS polygon FROM s LEFT JOIN p ON p.animal = s.animal AND p.section = s.section""")
def win_fill_missing_sections(t: Tables) -> DataFrame:
    p = T.detections(t).where("status = 'F' and section % 3 > 0").groupBy("animal", "section").agg(F.min("id").alias("polygon"))
    return C.fill_sections(p, ["animal"], "polygon")


TABLES_SQL["human_all"] = "SELECT * FROM @det WHERE status = 'F'"


@query("""WITH m AS (SELECT p.id AS a, q.id AS b, p.section AS z, q.section AS next_z, p.x AS ax, p.y AS ay, q.x AS qx, q.y AS qy, (p.x - q.x) * (p.x - q.x) + (p.y - q.y) * (p.y - q.y) AS d2,
  row_number() OVER (PARTITION BY p.id ORDER BY (p.x - q.x) * (p.x - q.x) + (p.y - q.y) * (p.y - q.y), q.id) AS r
  FROM @human p JOIN (SELECT section, lead(section) OVER (ORDER BY section) AS nxt FROM (SELECT DISTINCT section FROM @human)) s ON p.section = s.section JOIN @human q ON q.section = s.nxt)
  SELECT a, b, k::INTEGER AS step, round(ax + k / 4 * (qx - ax), 9) AS x, round(ay + k / 4 * (qy - ay), 9) AS y, round(z + k / 4 * (next_z - z), 9) AS z FROM m, (SELECT unnest([1, 2, 3]) AS k) WHERE r = 1 AND d2 <= 2500""")
def win_interpolate_slices(t: Tables) -> DataFrame:
    points = T.human_points(t)
    out = C.interpolate_slices(P.next_slice(points, 50), points, 3)
    return out.select("a", "b", "step", *[F.round(c, 9).alias(c) for c in "xyz"])


@query("SELECT polygon, section, area, round(perimeter, 6) AS perimeter, round(4 * pi() * area / nullif(perimeter * perimeter, 0), 9) AS circularity FROM (SELECT polygon, section, abs(sum(x * y2 - x2 * y)) / 2 AS area, sum(length) AS perimeter FROM @arc GROUP BY ALL)")
def agg_circularity(t: Tables) -> DataFrame:
    return C.circularity(T.polygons(t)).select("polygon", "section", "area", F.round("perimeter", 6).alias("perimeter"), F.round("circularity", 9).alias("circularity"))


# annotation JSON: built from polygons and points, then read again


@query("SELECT polygon, point_order - 1 AS point_order, round(x, 6)::DOUBLE AS x, round(y, 6)::DOUBLE AS y, section FROM @pol")
def src_annotation_volume(t: Tables) -> DataFrame:
    built = A.volume_json(P.polygon_edges(T.polygons(t)).withColumnRenamed("polygon", "session").withColumn("polygon", F.lit(0)), "session")
    rows = A.volume_points(built, "session", "annotation", (1.0, 1.0, 1.0))
    return rows.select(F.col("session").alias("polygon"), F.col("point_order").cast("long").alias("point_order"), "x", "y", "section")


@query("SELECT polygon AS session, x::DOUBLE AS x, y::DOUBLE AS y FROM @pol")
def src_annotation_xyz(t: Tables) -> DataFrame:
    built = A.volume_json(P.polygon_edges(T.polygons(t)).withColumnRenamed("polygon", "session").withColumn("polygon", F.lit(0)), "session")
    return A.volume_points(built, "session", "annotation", (1.0, 1.0, 1.0)).select("session", "x", "y")


@query("SELECT section AS session, x::INTEGER AS x, y::INTEGER AS y, (section * 2)::INTEGER AS section FROM @human")
def src_annotation_cloud(t: Tables) -> DataFrame:
    points = T.human_points(t).select("id", F.col("section").alias("session"), "x", "y", (F.col("section") * 2).alias("z"))
    return A.cloud_points(A.cloud_json(points, "session"), "session", "annotation", (1.0, 1.0, 1.0))


@query("SELECT brain || structure AS key, round(x, 6) AS x, round(y, 6) AS y, round(z, 6) AS z FROM @lm")
def src_com_points(t: Tables) -> DataFrame:
    text = A.point_json(F.col("x"), F.col("y"), F.col("z"), F.col("brain"))
    return A.com_points(T.landmarks(t).select(F.concat("brain", "structure").alias("key"), text.alias("annotation")), "key", "annotation")


@query("SELECT section AS session, count(*) AS n, round(avg(x), 6) AS cx, round(avg(y), 6) AS cy FROM @human GROUP BY section")
def sink_cloud_json(t: Tables) -> DataFrame:
    points = T.human_points(t).select("id", F.col("section").alias("session"), "x", "y", F.lit(0).alias("z"))
    v = F.from_json("annotation", "struct<centroid:array<double>,childJsons:array<struct<type:string>>>")
    rows = A.cloud_json(points, "session").select("session", v.alias("v"))
    return rows.select("session", F.size("v.childJsons").cast("long").alias("n"), *[F.round(F.col("v.centroid")[i] * 1e6, 6).alias(c) for i, c in enumerate(("cx", "cy"))])


@query("SELECT section AS session, count(DISTINCT polygon) AS n_polygons, count(*) AS n_lines FROM @pol GROUP BY section")
def sink_volume_json(t: Tables) -> DataFrame:
    edges = P.polygon_edges(T.polygons(t)).withColumn("session", F.col("section"))
    v = F.from_json("annotation", A.VOLUME)
    rows = A.volume_json(edges, "session").select("session", v.alias("v"))
    return rows.select("session", F.size("v.childJsons").cast("long").alias("n_polygons"), F.aggregate("v.childJsons", F.lit(0).cast("long"), lambda s, p: s + F.size(p["childJsons"])).alias("n_lines"))


@query("SELECT event_id AS id, (props::JSON->>'k')::BIGINT AS k, '{\"id\":' || event_id || ',\"shifted\":' || ((props::JSON->>'k')::BIGINT + 10) || '}' AS nested FROM events")
def json_nested_build(t: Tables) -> DataFrame:
    k = F.from_json("props", "struct<k:bigint>")["k"]
    return t.events.select(F.col("event_id").alias("id"), k.alias("k"), F.to_json(F.struct(F.col("event_id").alias("id"), (k + 10).alias("shifted"))).alias("nested"))


# snapshots


@query("""WITH cur AS (SELECT user_id AS prep, event_type AS label, value AS v FROM events WHERE event_id % 3 = 0), n AS (SELECT prep, label, count(*) AS n FROM cur GROUP BY ALL), st AS (SELECT user_id AS prep, event_type AS label, max(value) AS v FROM events WHERE event_id % 5 = 0 GROUP BY ALL)
  SELECT prep, label, CASE WHEN st.v IS NOT NULL AND coalesce(n.n, 1) = 1 THEN st.v ELSE cur.v END AS v, CASE WHEN n.n IS NULL THEN 'inserted' WHEN st.v IS NULL THEN 'kept' WHEN n.n = 1 THEN 'updated' ELSE 'many' END AS status FROM (cur JOIN n USING (prep, label)) FULL JOIN st USING (prep, label)""")
def sink_upsert_session(t: Tables) -> DataFrame:
    current = t.events.where("event_id % 3 = 0").select(F.col("user_id").alias("prep"), F.col("event_type").alias("label"), F.col("value").alias("v"))
    staged = t.events.where("event_id % 5 = 0").groupBy(F.col("user_id").alias("prep"), F.col("event_type").alias("label")).agg(F.max("value").alias("v"))
    return M.upsert(current, staged, ["prep", "label"])


@query("SELECT id, CASE WHEN section = 5 THEN 99 ELSE x END AS x FROM @human WHERE NOT section = 7")
def sink_update_where(t: Tables) -> DataFrame:
    rows = M.delete_where(T.human_points(t), "section = 7")
    return M.update_where(rows, "section = 5", {"x": 99}).select("id", "x")
