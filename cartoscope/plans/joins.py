"""Queries that join: metadata, landmarks, masks, voxels, ranges and nearest points."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cartoscope.operators import landmarks as L
from cartoscope.operators import metadata as M
from cartoscope.operators import spatial as P
from cartoscope.plans import tables as T
from cartoscope.plans.registry import Tables, TABLES_SQL, query


@query("SELECT o_orderkey AS scene, r_name AS animal, n_name AS scan_run, c_custkey AS slide, c_nationkey - 1 AS channel_index FROM region JOIN nation ON r_regionkey = n_regionkey JOIN customer ON n_nationkey = c_nationkey JOIN orders ON c_custkey = o_custkey WHERE c_mktsegment = 'BUILDING'")
def join_sections_view(t: Tables) -> DataFrame:
    animal = t.region.select(F.col("r_regionkey").alias("animal_id"), F.col("r_name").alias("animal"))
    run = t.nation.select(F.col("n_nationkey").alias("run_id"), F.col("n_regionkey").alias("animal_id"), F.col("n_name").alias("scan_run"))
    slide = t.customer.select(F.col("c_custkey").alias("slide"), F.col("c_nationkey").alias("run_id"), F.col("c_mktsegment").alias("status"), F.col("c_nationkey").alias("channel"))
    scene = t.orders.select(F.col("o_orderkey").alias("scene"), F.col("o_custkey").alias("slide"))
    return M.sections_view(animal, run, slide, scene, "BUILDING").select("scene", "animal", "scan_run", "slide", "channel_index")


@query("SELECT id, prep FROM @ses s WHERE active AND EXISTS (SELECT 1 FROM @ses b WHERE b.prep = s.prep AND b.label IN ('click', 'purchase'))")
def join_session_labels(t: Tables) -> DataFrame:
    bridge = T.sessions(t).select("prep", "label")
    return M.having_labels(T.sessions(t).where("active"), bridge, "prep", ["click", "purchase"]).select("id", "prep")


@query("SELECT s.id, s.prep, n_name AS region, s.value FROM @ses s JOIN nation ON s.prep % 25 = n_nationkey WHERE s.annotator = 3 AND s.active")
def join_com_session_region(t: Tables) -> DataFrame:
    com = T.sessions(t).select(F.col("id").alias("session_id"), (F.col("prep") % 25).cast("long").alias("region_id"), "value")
    session = T.sessions(t).select("id", "prep", "annotator", "active")
    region = t.nation.select(F.col("n_nationkey").cast("long").alias("region_id"), F.col("n_name").alias("region"))
    return M.com_with_region(com, session, region, "annotator = 3 AND active").select("id", "prep", "region", "value")


@query("SELECT c_mktsegment AS animal, string_agg(DISTINCT n_name, ',' ORDER BY n_name) AS regions, count(*) AS n FROM customer JOIN nation ON c_nationkey = n_nationkey GROUP BY ALL")
def join_com_manual_by_animal(t: Tables) -> DataFrame:
    rows = t.customer.join(t.nation, F.col("c_nationkey") == F.col("n_nationkey"))
    return M.regions_by_animal(rows.select(F.col("c_mktsegment").alias("animal"), F.col("n_name").alias("region")))


@query("SELECT id, prep FROM @ses s WHERE EXISTS (SELECT 1 FROM @det d WHERE d.id = s.id AND d.predictions = 2)")
def join_marked_cell_session(t: Tables) -> DataFrame:
    return M.having(T.sessions(t), T.detections(t).where("predictions = 2").select("id"), "id").select("id", "prep")


@query("""SELECT id, (label = 'click' AND EXISTS (SELECT 1 FROM @human h WHERE h.id = s.id)) OR (label = 'purchase' AND EXISTS (SELECT 1 FROM @machine m WHERE m.id = s.id)) AS active FROM @ses s""")
def join_activate_sessions(t: Tables) -> DataFrame:
    children = {"click": T.human_points(t).select("id"), "purchase": T.machine_points(t).select("id")}
    return M.activate(T.sessions(t).select("id", "label"), children, "label", "id").select("id", "active")


@query("SELECT a.structure, a.x AS x1, a.y AS y1, a.z AS z1, b.x AS x2, b.y AS y2, b.z AS z2 FROM @lm a JOIN @lm b ON a.structure = b.structure WHERE a.brain = 'BUILDING' AND b.brain = 'MACHINERY' AND a.structure NOT IN (3, 7)")
def join_common_landmarks(t: Tables) -> DataFrame:
    lm = T.landmarks(t)
    return L.common(lm.where("brain = 'BUILDING'"), lm.where("brain = 'MACHINERY'"), deny=[3, 7])


@query("SELECT structure, count(DISTINCT brain) AS n_brains, count(DISTINCT brain) = (SELECT count(DISTINCT brain) FROM @lm) AS in_all FROM @lm WHERE z > 8 GROUP BY structure")
def join_shared_landmarks_n(t: Tables) -> DataFrame:
    return L.shared(T.landmarks(t).where("z > 8"), T.landmarks(t).select("brain").distinct().count())


@query("""SELECT b.brain, r.structure, m.x - r.x AS dx, m.y - r.y AS dy, m.z - r.z AS dz, sqrt(pow(m.x - r.x, 2) + pow(m.y - r.y, 2) + pow(m.z - r.z, 2)) AS dist
  FROM (SELECT DISTINCT brain FROM @lm WHERE brain <> 'BUILDING') b CROSS JOIN (SELECT * FROM @lm WHERE brain = 'BUILDING') r LEFT JOIN (SELECT * FROM @lm WHERE z > 8) m ON m.brain = b.brain AND m.structure = r.structure""")
def join_landmark_offsets(t: Tables) -> DataFrame:
    lm = T.landmarks(t)
    brains = lm.where("brain <> 'BUILDING'").select("brain").distinct()
    return L.offsets(lm.where("brain = 'BUILDING'"), lm.where("z > 8"), brains)


@query("""SELECT base, l.x AS left_x, r.x AS right_x, (l.x + r.x) / 2 AS mid_x, 500 * 2 - l.x AS mirrored_x FROM
  (SELECT floor(structure / 2)::BIGINT AS base, x FROM @lm WHERE brain = 'BUILDING' AND structure % 2 = 0) l JOIN (SELECT floor(structure / 2)::BIGINT AS base, x FROM @lm WHERE brain = 'BUILDING' AND structure % 2 = 1) r USING (base)""")
def join_left_right_pairs(t: Tables) -> DataFrame:
    lm = T.landmarks(t).where("brain = 'BUILDING'")
    named = lm.select(F.concat(F.floor(F.col("structure") / 2), F.when(F.col("structure") % 2 == 0, "_L").otherwise("_R")).alias("structure"), "x")
    return L.left_right(named, midline=500.0).select(F.col("base").cast("long").alias("base"), "left_x", "right_x", "mid_x", "mirrored_x")


@query("SELECT c.id, c.name, coalesce(p.name, 'null') AS parent_name, coalesce(p.acronym, 'null') AS parent_acronym FROM @ont c LEFT JOIN @ont p ON c.parent_id = p.id")
def join_parent_names(t: Tables) -> DataFrame:
    return M.with_parent(T.ontology(t)).select("id", "name", "parent_name", "parent_acronym")


TABLES_SQL["mask"] = "SELECT DISTINCT section, floor(y / 32)::BIGINT AS row, floor(x / 32)::BIGINT AS col FROM @human"


def tissue(t: Tables) -> DataFrame:
    return T.human_points(t).select("section", F.floor(F.col("y") / 32).alias("row"), F.floor(F.col("x") / 32).alias("col")).distinct()


@query("SELECT d.id, m.section IS NOT NULL AS on_mask FROM @machine d LEFT JOIN @mask m ON d.section = m.section AND floor(d.y / 32)::BIGINT = m.row AND floor(d.x / 32)::BIGINT = m.col")
def join_mask_lookup(t: Tables) -> DataFrame:
    return P.on_mask(T.machine_points(t), tissue(t)).select("id", "on_mask")


@query("SELECT d.id, CASE WHEN m.section IS NULL AND d.predictions > 0 THEN -2 ELSE d.predictions END::INTEGER AS predictions FROM @det d LEFT JOIN @mask m ON d.section = m.section AND floor(d.y / 32)::BIGINT = m.row AND floor(d.x / 32)::BIGINT = m.col")
def prj_fix_outside_mask(t: Tables) -> DataFrame:
    rows = P.on_mask(T.detections(t).select("id", "section", "x", "y", "predictions"), tissue(t))
    return rows.select("id", F.when(~F.col("on_mask") & (F.col("predictions") > 0), -2).otherwise(F.col("predictions")).alias("predictions"))


@query("SELECT d.id, CASE WHEN m.section IS NULL THEN 'inner' ELSE 'border' END AS part FROM @machine d LEFT JOIN @mask m ON d.section = m.section AND floor(d.y / 32)::BIGINT = m.row AND floor(d.x / 32)::BIGINT = m.col")
def join_border_cells(t: Tables) -> DataFrame:
    return P.on_mask(T.machine_points(t), tissue(t)).select("id", F.when(F.col("on_mask"), "border").otherwise("inner").alias("part"))


@query("SELECT d.id, coalesce(v.structure, 0) AS structure FROM @det d LEFT JOIN @vox v ON v.z = 0 AND v.y = d.section % 25 AND v.x = d.x % 100")
def join_voxel_structure(t: Tables) -> DataFrame:
    points = T.detections(t).select("id", F.lit(0.25).alias("z"), (F.col("section") % 25 + 0.5).alias("y"), (F.col("x") % 100 + 0.75).alias("x"))
    return P.voxel_structures(points, T.voxels(t)).select("id", "structure")


@query("SELECT v.voxel, n_name AS name FROM @vox v JOIN nation ON v.structure = n_nationkey WHERE v.structure <> 0")
def join_value_structure(t: Tables) -> DataFrame:
    names = t.nation.select(F.col("n_nationkey").alias("structure"), F.col("n_name").alias("name"))
    return M.structure_names(T.voxels(t), names).select("voxel", "name")


PIP = """
edges AS (SELECT polygon, section, x, y, coalesce(lead(x) OVER w, first(x) OVER w) AS x2, coalesce(lead(y) OVER w, first(y) OVER w) AS y2 FROM @pol
  WINDOW w AS (PARTITION BY polygon ORDER BY point_order ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING)),
many AS (SELECT polygon, section FROM @pol GROUP BY ALL HAVING count(*) >= 3),
hits AS (SELECT p.id, p.section, e.polygon,
    count(*) FILTER ((e.y > p.y) <> (e.y2 > p.y) AND CASE WHEN e.y2 > e.y THEN (p.x - e.x) * (e.y2 - e.y) - (p.y - e.y) * (e.x2 - e.x) < 0 ELSE (p.x - e.x) * (e.y2 - e.y) - (p.y - e.y) * (e.x2 - e.x) > 0 END) AS n,
    bool_or((p.x - e.x) * (e.y2 - e.y) - (p.y - e.y) * (e.x2 - e.x) = 0 AND p.x BETWEEN least(e.x, e.x2) AND greatest(e.x, e.x2) AND p.y BETWEEN least(e.y, e.y2) AND greatest(e.y, e.y2)) AS on_edge
  FROM @pip p JOIN edges e ON p.section = e.section JOIN many m ON m.polygon = e.polygon GROUP BY ALL),
inside AS (SELECT id, polygon, section FROM hits WHERE NOT on_edge AND n % 2 = 1)
"""
TABLES_SQL["pip"] = "SELECT id, section, x % 200 AS x, y % 150 AS y FROM @human"


def pip_points(t: Tables) -> DataFrame:
    return T.human_points(t).select("id", "section", (F.col("x") % 200).alias("x"), (F.col("y") % 150).alias("y"))


@query(f"WITH {PIP} SELECT * FROM inside")
def join_point_in_polygon(t: Tables) -> DataFrame:
    return P.in_polygons(pip_points(t), T.polygons(t))


@query(f"WITH {PIP} SELECT DISTINCT id FROM inside")
def join_point_in_polygon_any(t: Tables) -> DataFrame:
    return P.polygon_union(pip_points(t), T.polygons(t)).select("id")


@query(f"WITH {PIP} SELECT i.id FROM inside i JOIN (SELECT section, count(*) AS total FROM many GROUP BY section) USING (section) GROUP BY i.id, total HAVING count(*) = total")
def join_point_in_polygon_all(t: Tables) -> DataFrame:
    return P.polygon_intersection(pip_points(t), T.polygons(t)).select("id")


PAIRS = "a.section = b.section AND a.id < b.id AND (a.x - b.x) * (a.x - b.x) + (a.y - b.y) * (a.y - b.y) < 900"


@query(f"SELECT a.id AS a, b.id AS b, a.section, sqrt(((a.x - b.x) * (a.x - b.x) + (a.y - b.y) * (a.y - b.y))::DOUBLE) AS dist FROM @det a JOIN @det b ON {PAIRS}")
def join_proximity_pairs(t: Tables) -> DataFrame:
    return P.proximity_pairs(T.detections(t), 30)


@query("SELECT a.id AS a, b.id AS b, a.section, sqrt(((a.x - b.x) * (a.x - b.x) + (a.y - b.y) * (a.y - b.y))::DOUBLE) AS dist FROM @det a JOIN @det b ON a.section + 1 = b.section AND (a.x - b.x) * (a.x - b.x) + (a.y - b.y) * (a.y - b.y) < 900")
def join_across_sections(t: Tables) -> DataFrame:
    return P.across_sections(T.detections(t), 30)


TABLES_SQL["near"] = """
SELECT a, b, section, sqrt(d2::DOUBLE) AS dist, d2 FROM (SELECT m.id AS a, h.id AS b, m.section, (m.x - h.x) * (m.x - h.x) + (m.y - h.y) * (m.y - h.y) AS d2,
  row_number() OVER (PARTITION BY m.id ORDER BY (m.x - h.x) * (m.x - h.x) + (m.y - h.y) * (m.y - h.y), h.id) AS r FROM @machine m JOIN @human h ON m.section = h.section) WHERE r = 1"""


@query("SELECT a, b, section, dist FROM @near WHERE d2 < 1600")
def join_nearest_within(t: Tables) -> DataFrame:
    return P.nearest_within(T.machine_points(t), T.human_points(t), 40)


@query("SELECT DISTINCT b AS id, section FROM @near WHERE d2 <= 2500")
def join_label_to_segment(t: Tables) -> DataFrame:
    return P.labelled_segments(T.machine_points(t), T.human_points(t), 50)


@query("SELECT id, section, x, y FROM @machine WHERE id NOT IN (SELECT a FROM @near WHERE d2 < 1600)")
def join_exclude_annotated(t: Tables) -> DataFrame:
    return P.without_annotated(T.machine_points(t), T.human_points(t), 40)


@query("SELECT id, floor(x / 300)::BIGINT AS tile_x, floor(y / 200)::BIGINT AS tile_y, x % 300 AS local_x, y % 200 AS local_y FROM @det")
def join_points_to_tile(t: Tables) -> DataFrame:
    return P.to_tiles(T.detections(t).select("id", "x", "y"), 300, 200).select("id", "tile_x", "tile_y", "local_x", "local_y")


@query("""SELECT a, b, z, next_z, sqrt(d2::DOUBLE) AS dist FROM (SELECT p.id AS a, q.id AS b, p.section AS z, q.section AS next_z, (p.x - q.x) * (p.x - q.x) + (p.y - q.y) * (p.y - q.y) AS d2,
  row_number() OVER (PARTITION BY p.id ORDER BY (p.x - q.x) * (p.x - q.x) + (p.y - q.y) * (p.y - q.y), q.id) AS r
  FROM @human p JOIN (SELECT section, lead(section) OVER (ORDER BY section) AS nxt FROM (SELECT DISTINCT section FROM @human)) s ON p.section = s.section JOIN @human q ON q.section = s.nxt) WHERE r = 1 AND d2 <= 2500""")
def join_slice_match(t: Tables) -> DataFrame:
    return P.next_slice(T.human_points(t), 50)


@query("""WITH o AS (SELECT id, section, x, y FROM @det WHERE predictions = 2), c AS (SELECT id, floor(y / 10)::BIGINT + i AS row, floor(x / 10)::BIGINT + j AS col FROM o, (VALUES (0), (1)) a(i), (VALUES (0), (1)) b(j))
  SELECT p.id AS a, q.id AS b, p.section AS z, count(*) AS shared FROM o p JOIN o q ON p.section + 1 = q.section AND abs(p.x - q.x) <= 25 AND abs(p.y - q.y) <= 25
  JOIN c ca ON ca.id = p.id JOIN c cb ON cb.id = q.id AND ca.row = cb.row AND ca.col = cb.col GROUP BY ALL""")
def join_plane_overlap(t: Tables) -> DataFrame:
    objects = T.detections(t).where("predictions = 2").select("id", "section", "x", "y")
    step = F.explode(F.array(*[F.struct(F.lit(i).alias("i"), F.lit(j).alias("j")) for i in (0, 1) for j in (0, 1)])).alias("o")
    cells = objects.select("id", (F.floor(F.col("y") / 10)).alias("r"), (F.floor(F.col("x") / 10)).alias("c"), step).select("id", (F.col("r") + F.col("o.i")).alias("row"), (F.col("c") + F.col("o.j")).alias("col"))
    return P.plane_overlap(objects, cells, 25)


TABLES_SQL["grid"] = "SELECT floor(section / 8)::BIGINT AS bx, floor(x / 200)::BIGINT AS by, floor(y / 200)::BIGINT AS bz, count(*) AS n FROM @det GROUP BY ALL"


def grid(t: Tables) -> DataFrame:
    rows = T.detections(t).select(F.floor(F.col("section") / 8).cast("int").alias("bx"), F.floor(F.col("x") / 200).alias("by"), F.floor(F.col("y") / 200).alias("bz"))
    return rows.groupBy("bx", "by", "bz").agg(F.count("*").alias("n"))


@query("SELECT a.bx, a.by, a.bz, a.n, b.bx AS bx2, b.by AS by2, b.bz AS bz2, b.n AS n2 FROM @grid a JOIN @grid b ON abs(a.bx - b.bx) <= 1 AND abs(a.by - b.by) <= 1 AND abs(a.bz - b.bz) <= 1 AND NOT (a.bx = b.bx AND a.by = b.by AND a.bz = b.bz)")
def join_adjacent_boxes(t: Tables) -> DataFrame:
    return P.adjacent_boxes(grid(t), ["bx", "by", "bz"])


@query("SELECT d.id FROM @det d WHERE d.id NOT IN (SELECT id FROM @human)")
def join_train_test_anti(t: Tables) -> DataFrame:
    return T.detections(t).select("id").join(T.human_points(t).select("id"), "id", "left_anti")
