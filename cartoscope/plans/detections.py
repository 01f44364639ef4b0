"""Queries on detections: filters, classes, projections, samples, set operations, scalar functions."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cartoscope.functions import scalars as S
from cartoscope.operators import detect as D
from cartoscope.operators import ordering as O
from cartoscope.plans import tables as T
from cartoscope.plans.registry import Tables, query

POINT = ("id", "section", "x", "y")


@query("SELECT x::INTEGER AS x, y::INTEGER AS y, trunc(section + 0.5)::INTEGER AS section FROM @det WHERE predictions > 0")
def flt_positive_project(t: Tables) -> DataFrame:
    return D.positive_points(T.detections(t))


@query("SELECT id, CASE predictions WHEN 2 THEN 'sure' WHEN 0 THEN 'unsure' ELSE 'not_cell' END AS class FROM @det")
def flt_by_class(t: Tables) -> DataFrame:
    return T.detections(t).select("id", D.class_name(F.col("predictions")).alias("class"))


BOUNDS = {"x": 1000, "y": 800, "section": 60}


@query("SELECT id, section, x, y FROM @det WHERE x >= 0 AND x < 1000 AND y >= 0 AND y < 800 AND section >= 0 AND section < 60")
def flt_bounds(t: Tables) -> DataFrame:
    return D.within_bounds(T.detections(t).select(*POINT), BOUNDS)


@query("SELECT count(*) FILTER (x >= 0 AND x < 1000 AND y >= 0 AND y < 800 AND section >= 0 AND section < 60) AS n_inside, count(*) FILTER (NOT (x >= 0 AND x < 1000 AND y >= 0 AND y < 800 AND section >= 0 AND section < 60)) AS n_rejected FROM @det")
def flt_bounds_rejected(t: Tables) -> DataFrame:
    return D.bounds_report(T.detections(t), BOUNDS)


@query("SELECT id, section, x, y FROM @det WHERE x >= 200 AND x < 700 AND y >= 100 AND y < 500 AND section >= 10 AND section < 40")
def flt_box(t: Tables) -> DataFrame:
    return D.in_box(T.detections(t).select(*POINT), {"x": 200, "y": 100, "section": 10}, {"x": 700, "y": 500, "section": 40})


@query("SELECT id, area FROM @det WHERE area BETWEEN 100 AND 3000")
def flt_area(t: Tables) -> DataFrame:
    return D.by_area(T.detections(t).select("id", "area"), 100, 3000)


@query("SELECT id, section, x, y FROM @det WHERE x - 40 >= 0 AND y - 40 >= 0 AND x + 40 <= 1200 AND y + 40 <= 1000")
def flt_edge_exclusion(t: Tables) -> DataFrame:
    return D.off_edges(T.detections(t).select(*POINT), 40, 1200, 1000)


@query("SELECT id, x, y, area FROM @det WHERE x BETWEEN 100 AND 900 AND y BETWEEN 50 AND 950 AND area BETWEEN 500 AND 4000")
def flt_prune_xy(t: Tables) -> DataFrame:
    return D.prune(T.detections(t).select("id", "x", "y", "area"), (100, 900), (50, 950), (500, 4000))


@query("SELECT id, x, y, floor(x / 256)::BIGINT AS tile_x, floor(y / 256)::BIGINT AS tile_y FROM @det")
def flt_tile_core(t: Tables) -> DataFrame:
    return D.tile_core(T.detections(t).select("id", "x", "y"), 256, 40)


@query("SELECT id, floor(section / 8)::BIGINT AS slab, (section % 8)::BIGINT AS local_z, section::BIGINT AS global_z FROM @det")
def flt_slab_core(t: Tables) -> DataFrame:
    out = D.slab_core(T.detections(t).select("id", "section"), 8, 2)
    return out.select("id", "slab", F.col("local_z").cast("long").alias("local_z"), F.col("global_z").cast("long").alias("global_z"))


@query("SELECT id, section, status, predictions FROM @det WHERE status = 'F' AND section = 12 AND predictions = 2")
def flt_search_dict(t: Tables) -> DataFrame:
    return D.search(T.detections(t).select("id", "section", "status", "predictions"), {"status": "F", "section": 12, "predictions": 2})


@query("SELECT id, section FROM @det WHERE section NOT IN (1, 2, 3) AND id NOT IN (SELECT id FROM @human)")
def flt_in_list(t: Tables) -> DataFrame:
    rows = D.not_listed(T.detections(t).select("id", "section"), "section", [1, 2, 3])
    return D.not_listed(rows, "id", T.human_points(t).select("id"))


@query("SELECT id, name FROM @ont WHERE acronym = 'AS'")
def flt_binary_collation(t: Tables) -> DataFrame:
    return D.search(T.ontology(t), {"acronym": "AS"}).select("id", "name")


@query("SELECT id, prep, label FROM @ses WHERE active")
def flt_active(t: Tables) -> DataFrame:
    return T.sessions(t).where("active").select("id", "prep", "label")


@query("SELECT id, x, y FROM @det WHERE x < 900 AND y < 700")
def flt_outside_atlas(t: Tables) -> DataFrame:
    return D.within_bounds(T.detections(t).select("id", "x", "y"), {"x": 900, "y": 700})


@query("SELECT section, section IN (SELECT section FROM @human WHERE y > 900) AS has_artefact FROM (SELECT DISTINCT section FROM @det)")
def flt_sections_with(t: Tables) -> DataFrame:
    return O.presence(T.detections(t).select("section").distinct(), T.human_points(t).where("y > 900"), "section", "has_artefact")


@query("""SELECT id, image FROM (SELECT id, section AS image, area, y / 1000.0::DOUBLE AS circularity, x AS intensity, quantile_cont(x, 0.7) OVER (PARTITION BY section) AS cut FROM @det)
          WHERE area BETWEEN 500 AND 4000 AND circularity > 0.4 AND intensity > cut""")
def flt_shape(t: Tables) -> DataFrame:
    rows = T.detections(t).select("id", F.col("section").alias("image"), "area", (F.col("y") / 1000).alias("circularity"), F.col("x").alias("intensity"))
    return D.by_shape(rows, (500, 4000), 0.4, 0.7).select("id", "image")


@query("SELECT image, row, col, 9 AS value FROM @pix WHERE value IN (SELECT value FROM @pix WHERE value <> 0 GROUP BY value ORDER BY count(*) DESC, value LIMIT 5)")
def flt_top_n_values(t: Tables) -> DataFrame:
    return D.most_frequent_values(T.pixels(t), "value", 5, 9).select("image", "row", "col", "value")


@query("SELECT mean_score, std_score, area FROM @det")
def prj_select_features(t: Tables) -> DataFrame:
    return D.select_features(T.detections(t), ["mean_score", "std_score", "area"])


@query("SELECT id, (predictions > 0)::INTEGER AS label FROM @det")
def prj_label_from_prediction(t: Tables) -> DataFrame:
    return T.detections(t).select("id", D.binary_label(F.col("predictions")).alias("label"))


@query("SELECT id, mean_score, predictions FROM @det")
def cls_threshold(t: Tables) -> DataFrame:
    return T.detections(t).select("id", "mean_score", D.threshold_class(F.col("mean_score")).alias("predictions"))


@query("SELECT id, CASE WHEN mean_score < 0 THEN -2 WHEN mean_score - std_score < 0 AND mean_score > 0 THEN 0 WHEN mean_score - std_score > 0 THEN 2 END::INTEGER AS predictions FROM @det")
def cls_mean_std(t: Tables) -> DataFrame:
    return T.detections(t).select("id", D.mean_std_class(F.col("mean_score"), F.col("std_score")).alias("predictions"))


@query("""SELECT id, CASE
  WHEN 0.5 * m + 3 < s AND NOT -0.75 * m + 6.75 < s AND NOT 0.5 * m + 5.5 < s AND (-1.0 / 3) * m + 3 < s THEN 0
  WHEN (m < 0 AND NOT (-3.0 / 7) * m + (4 - 9.0 / 7) < s) OR (m > 0 AND (2.5 / 7) * m + (4.5 - 7.5 / 7) < s) THEN -2
  WHEN (m > 0 AND NOT (2.5 / 7) * m + (4.5 - 7.5 / 7) < s) OR (m < 0 AND (-3.0 / 7) * m + (4 - 9.0 / 7) < s) THEN 2 END::INTEGER AS predictions
  FROM (SELECT id, mean_score + 0.0003::DOUBLE AS m, std_score * 2 AS s FROM @det)""")
def cls_greedy(t: Tables) -> DataFrame:
    return T.detections(t).select("id", D.region_class(F.col("mean_score") + F.lit(0.0003), F.col("std_score") * 2).alias("predictions"))


@query("SELECT section, avg(s) AS mean_score, stddev_pop(s) AS std_score FROM (SELECT section, unnest([mean_score, mean_score - std_score, mean_score + std_score]) AS s FROM @det) GROUP BY section")
def agg_ensemble_stats(t: Tables) -> DataFrame:
    scores = F.explode(F.array("mean_score", F.col("mean_score") - F.col("std_score"), F.col("mean_score") + F.col("std_score"))).alias("score")
    return D.ensemble_stats(T.detections(t).select("section", scores), ["section"])


@query("SELECT animal, quantile_cont(mean_score, 0.5) AS median, quantile_cont(mean_score, 0.9) - quantile_cont(mean_score, 0.1) AS spread FROM @det GROUP BY animal")
def agg_score_spread(t: Tables) -> DataFrame:
    return D.score_spread(T.detections(t), ["animal"], "mean_score")


# ordering, samples, sets


@query("SELECT id, section, x, y FROM @det ORDER BY section, x, y, id LIMIT 100")
def limit_first(t: Tables) -> DataFrame:
    return O.first_rows(T.detections(t).select(*POINT), ["section", "x", "y", "id"], 100)


@query("SELECT slide, scene, channel, file, row_number() OVER (PARTITION BY channel ORDER BY slide, scene, file) - 1 AS position FROM (SELECT DISTINCT slide, scene, channel, file FROM @scn WHERE active)")
def sort_sections(t: Tables) -> DataFrame:
    rows = O.distinct_positions(T.scenes(t).where("active"), "channel", ["slide", "scene", "file"], "position")
    return rows.select("slide", "scene", "channel", "file", "position")


@query("SELECT polygon, section, point_order, x, y FROM @pol")
def sort_polygon_points(t: Tables) -> DataFrame:
    return O.sorted_by(T.polygons(t), ["section", "polygon", "point_order"])


@query("SELECT section, x, y, id FROM @det")
def sort_layer_points(t: Tables) -> DataFrame:
    return O.sorted_by(T.detections(t).select("section", "x", "y", "id"), ["section", "x", "y"])


@query("SELECT x, count(*) AS n FROM @det GROUP BY x ORDER BY n DESC, x LIMIT 10")
def topk_frequent(t: Tables) -> DataFrame:
    return O.top_frequent(T.detections(t), ["x"], 10)


@query()
def sample_fixed(t: Tables) -> DataFrame:
    return O.sample_rows(T.detections(t).select(*POINT), "id", 500, seed=42)


@query()
def sample_fraction(t: Tables) -> DataFrame:
    return O.split_fraction(T.detections(t).select(*POINT), "id", 80, seed=42)


@query()
def sample_bootstrap(t: Tables) -> DataFrame:
    return O.bootstrap_means(T.detections(t), "id", "mean_score", 20, seed=42)


@query()
def sample_qc(t: Tables) -> DataFrame:
    return O.sample_per_class(T.detections(t).select(*POINT, "predictions"), "predictions", {2: 50, 0: 30}, "id", seed=42)


@query("SELECT id, section, x, y, 'human' AS source FROM @human UNION ALL SELECT id, section, x, y, 'machine' FROM @machine")
def set_union_all(t: Tables) -> DataFrame:
    return O.union_sources({"human": T.human_points(t), "machine": T.machine_points(t)})


@query("SELECT id, section, x, y FROM @human UNION ALL SELECT id, section, x, y FROM @machine")
def set_append_existing(t: Tables) -> DataFrame:
    return T.human_points(t).unionByName(T.machine_points(t))


@query("SELECT x FROM @human INTERSECT SELECT x FROM @machine")
def set_intersect_keys(t: Tables) -> DataFrame:
    return T.human_points(t).select("x").intersect(T.machine_points(t).select("x"))


@query("SELECT x FROM @human EXCEPT SELECT x FROM @machine")
def set_except(t: Tables) -> DataFrame:
    return T.human_points(t).select("x").subtract(T.machine_points(t).select("x"))


@query("SELECT coalesce(a.x, b.x) AS x, CASE WHEN a.x IS NULL THEN 'right_only' WHEN b.x IS NULL THEN 'left_only' ELSE 'both' END AS status FROM (SELECT DISTINCT x FROM @human) a FULL JOIN (SELECT DISTINCT x FROM @machine) b ON a.x = b.x")
def set_symmetric_difference(t: Tables) -> DataFrame:
    return O.compare_keys(T.human_points(t), T.machine_points(t), "x")


@query("SELECT DISTINCT channel FROM @scn")
def set_distinct(t: Tables) -> DataFrame:
    return T.scenes(t).select("channel").distinct()


# scalar functions


@query("SELECT id, lpad(section::VARCHAR, 3, '0') AS name FROM @det")
def str_zero_pad(t: Tables) -> DataFrame:
    return T.detections(t).select("id", S.zero_pad(F.col("section"), 80).alias("name"))


@query("SELECT o_orderkey AS id, o_orderkey % 50 AS slide FROM orders")
def str_slide_number(t: Tables) -> DataFrame:
    name = F.concat(F.lit("AB12_slide"), F.lpad((F.col("o_orderkey") % 50).cast("string"), 3, "0"), F.lit("_2024.czi"))
    return t.orders.select(F.col("o_orderkey").alias("id"), S.slide_number(name).alias("slide"))


@query("SELECT l_orderkey AS id, 'slide' || l_orderkey || '_S' || l_linenumber || '_C' || (l_suppkey % 3 + 1) || '.tif' AS name FROM lineitem")
def str_scene_filename(t: Tables) -> DataFrame:
    czi = F.concat(F.lit("slide"), F.col("l_orderkey"), F.lit("_.czi"))
    return t.lineitem.select(F.col("l_orderkey").alias("id"), S.scene_filename(czi, F.col("l_linenumber"), F.col("l_suppkey") % 3 + 1).alias("name"))


@query("SELECT id, section::BIGINT AS section FROM @det")
def str_section_from_name(t: Tables) -> DataFrame:
    name = F.when(F.col("id") % 2 == 0, F.concat(F.lit("detections_"), F.lpad(F.col("section").cast("string"), 3, "0"), F.lit(".csv"))).otherwise(F.concat(F.lit("x_section_"), F.col("section")))
    return T.detections(t).select("id", S.section_from_name(name).alias("section"))


@query("SELECT id, CASE predictions WHEN 2 THEN 2 WHEN 0 THEN 0 ELSE -2 END::INTEGER AS prediction, CASE WHEN id % 3 = 0 THEN 'L' WHEN id % 3 = 1 THEN 'R' END AS side, 'B' || id % 3 AS tail FROM @det")
def str_category_parse(t: Tables) -> DataFrame:
    rows = T.detections(t)
    name = F.concat(F.lit("2000_"), F.when(F.col("predictions") == 2, "sure").when(F.col("predictions") == 0, "unsure").otherwise("null"))
    structure = F.concat(F.lit("SC"), F.when(F.col("id") % 3 == 0, "_L").when(F.col("id") % 3 == 1, "_R").otherwise(""))
    return rows.select("id", S.category_prediction(name).alias("prediction"), S.side(structure).alias("side"), S.after_dash(F.concat(F.lit("A-B"), F.col("id") % 3)).alias("tail"))


@query("""SELECT doc_id, CASE WHEN n = 0 THEN '0B' ELSE format('{:.2f}', round_even(n / pow(1024, i), 2)) || ' ' || ['B', 'KB', 'MB', 'GB'][i + 1] END AS size
  FROM (SELECT doc_id, n, CASE WHEN n < 1024 THEN 0 WHEN n < 1048576 THEN 1 ELSE 2 END AS i FROM (SELECT doc_id, n_chars * 64 AS n FROM documents))""")
def str_human_size(t: Tables) -> DataFrame:
    return t.documents.select("doc_id", S.human_size(F.col("n_chars") * 64).alias("size"))


@query("SELECT id, x * 0.325 AS um, round_even(x * 0.325 / 10, 0)::BIGINT AS px, (section + 0.5)::DOUBLE AS centre, round_even(x / 32, 0)::BIGINT AS down FROM (SELECT id, x::DOUBLE AS x, section::DOUBLE AS section FROM @det)")
def math_unit_convert(t: Tables) -> DataFrame:
    rows = T.detections(t).select("id", "section", F.col("x").cast("double").alias("x"))
    um = F.col("x") * F.lit(0.325)
    return rows.select("id", um.alias("um"), S.to_pixels(um, F.lit(10.0)).alias("px"), S.section_centre(F.col("section")).alias("centre"), S.downsampled(F.col("x")).alias("down"))


@query("SELECT id, CASE id % 3 WHEN 0 THEN [20.0, 0.325, 0.325]::DOUBLE[] WHEN 1 THEN [0.325, 20.0, 0.325]::DOUBLE[] ELSE [0.325, 0.325, 20.0]::DOUBLE[] END AS resolution FROM @det")
def math_resolution_vector(t: Tables) -> DataFrame:
    o = F.element_at(F.array(*map(F.lit, ("coronal", "horizontal", "sagittal"))), (F.col("id") % 3 + 1).cast("int"))
    return T.detections(t).select("id", S.resolution_vector(o, F.lit(0.325), F.lit(20.0)).alias("resolution"))


@query("SELECT id, sqrt(x::DOUBLE * x + y::DOUBLE * y) AS dist, (x - 10) * 255.0::DOUBLE / 990 AS stretched, (round_even(x / 64.0::DOUBLE, 0) * 64)::BIGINT AS rounded FROM @det")
def math_distance_stretch_round(t: Tables) -> DataFrame:
    x, y = F.col("x").cast("double"), F.col("y").cast("double")
    return T.detections(t).select("id", S.distance([x, y], [F.lit(0.0), F.lit(0.0)]).alias("dist"), S.stretch(x, 10, 1000, 255).alias("stretched"), S.round_to(x, 64).alias("rounded"))


@query("SELECT id, (id & 255)::BIGINT AS r, ((id >> 8) & 255)::BIGINT AS g, ((id >> 16) & 255)::BIGINT AS b FROM @det")
def math_id_to_rgb(t: Tables) -> DataFrame:
    r, g, b = S.id_to_rgb(F.col("id"))
    return T.detections(t).select("id", r.alias("r"), g.alias("g"), b.alias("b"))


@query("SELECT s_suppkey AS section, cos(rotation) AS m00, -sin(rotation) AS m01, xshift + 100 - 100 * cos(rotation) + 80 * sin(rotation) AS m02, sin(rotation) AS m10, cos(rotation) AS m11, yshift + 80 - 100 * sin(rotation) - 80 * cos(rotation) AS m12 FROM (SELECT section AS s_suppkey, rotation, xshift, yshift FROM @trf)")
def map_rigid_params(t: Tables) -> DataFrame:
    m = S.rigid_matrix(F.col("rotation"), F.col("xshift"), F.col("yshift"), (100.0, 80.0))
    return T.transforms(t).select("section", *[m[i].alias(f"m{i // 3}{i % 3}") for i in range(6)])


@query("SELECT id, x * 2.0::DOUBLE AS x, y * 0.5::DOUBLE AS y, section::DOUBLE AS z, 1000 - x AS flipped FROM @det")
def map_resample_points(t: Tables) -> DataFrame:
    rows = T.detections(t).select("id", F.col("section").cast("double").alias("z"), F.col("y").cast("double").alias("y"), F.col("x").cast("double").alias("x"), F.col("x").alias("px"))
    rows = S.resample_points(rows, {"z": (10, 10), "y": (10, 20), "x": (10, 5)})
    return rows.select("id", "x", "y", "z", (F.lit(1000) - F.col("px")).alias("flipped"))


@query("SELECT id, md5(name) AS md5, sha256(name) AS sha256 FROM @ont")
def hash_content(t: Tables) -> DataFrame:
    return T.ontology(t).select("id", F.md5("name").alias("md5"), F.sha2("name", 256).alias("sha256"))


@query("SELECT id, sha1(id || '|' || name) AS parent FROM @ont")
def str_stable_id(t: Tables) -> DataFrame:
    return T.ontology(t).select("id", S.stable_id("id", "name").alias("parent"))


@query("SELECT id, strftime(updated, '%Y-%m-%d') AS day, strftime(updated, '%Y%m%d_%H%M%S') AS stamp FROM @ses")
def date_stamps(t: Tables) -> DataFrame:
    return T.sessions(t).select("id", F.date_format("updated", "yyyy-MM-dd").alias("day"), F.date_format("updated", "yyyyMMdd_HHmmss").alias("stamp"))


@query("SELECT section, list_sum([section * 1.0::DOUBLE, xshift, yshift]) AS total, list_max([xshift, yshift]) AS largest FROM @trf")
def arr_sum_fold(t: Tables) -> DataFrame:
    a = F.array(F.col("section") * 1.0, "xshift", "yshift")
    return T.transforms(t).select("section", F.aggregate(a, F.lit(0.0), lambda s, v: s + v).alias("total"), F.array_max(F.array("xshift", "yshift")).alias("largest"))


@query("SELECT o.id, i.name AS label, i.acronym FROM @cnt o JOIN @ont i ON o.id = i.id")
def map_lookup_invert(t: Tables) -> DataFrame:
    return O.look_up(T.region_counts(t).select("id"), T.ontology(t).select("id", F.col("name").alias("label"), "acronym"), "id")
