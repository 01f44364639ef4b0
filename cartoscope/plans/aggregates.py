"""Queries that aggregate."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cartoscope.operators import metadata as M
from cartoscope.operators import spatial as P
from cartoscope.operators import stats as S
from cartoscope.operators import tree as H
from cartoscope.plans import tables as T
from cartoscope.plans.registry import Tables, query


@query("SELECT l_returnflag, l_linestatus, sum(l_quantity) AS l_quantity, sum(floor(l_extendedprice)) AS price FROM lineitem WHERE l_discount > 0.02 GROUP BY ALL")
def agg_filtered_sum(t: Tables) -> DataFrame:
    rows = t.lineitem.withColumn("price", F.floor("l_extendedprice").cast("double"))
    return S.filtered_sum(rows, "l_discount > 0.02", ["l_quantity", "price"], ["l_returnflag", "l_linestatus"])


@query("SELECT channel, count(*) AS n FROM @scn WHERE active GROUP BY channel")
def agg_counts(t: Tables) -> DataFrame:
    return T.scenes(t).where("active").groupBy("channel").agg(F.count("*").alias("n"))


@query("SELECT section, count(*) > 0 AS has_rows, bool_or(rotation <> 0) AS has_rotation FROM @trf GROUP BY section")
def agg_existence(t: Tables) -> DataFrame:
    return T.transforms(t).groupBy("section").agg((F.count("*") > 0).alias("has_rows"), F.bool_or(F.col("rotation") != 0).alias("has_rotation"))


@query("SELECT d.section, coalesce(rotation, 0) AS rotation, coalesce(xshift, 0) AS xshift, coalesce(yshift, 0) AS yshift FROM (SELECT DISTINCT section FROM @det) d LEFT JOIN @trf t ON t.section = d.section")
def agg_default_lookup(t: Tables) -> DataFrame:
    rows = T.detections(t).select("section").distinct().join(T.transforms(t), "section", "left")
    return rows.fillna(0.0, ["rotation", "xshift", "yshift"])


@query("SELECT section, avg(x) AS x, avg(y) AS y, count(*) AS n FROM (SELECT section, polygon, avg(x) AS x, avg(y) AS y FROM @pol GROUP BY ALL) GROUP BY section")
def agg_centroid(t: Tables) -> DataFrame:
    return S.nested_centroid(T.polygons(t), ["section", "polygon"], ["section"])


@query("SELECT section, min(x) AS min_x, max(x) AS max_x, avg(x) AS mean_x, min(y) AS min_y, max(y) AS max_y, avg(y) AS mean_y FROM @det GROUP BY section")
def agg_min_max_mean(t: Tables) -> DataFrame:
    return S.bounding_box(T.detections(t), ["section"], ["x", "y"])


@query("SELECT animal, min(x) AS origin_x, min(y) AS origin_y, min(section)::BIGINT AS origin_section, max(x) - min(x) + 1 AS size_x, max(y) - min(y) + 1 AS size_y, (max(section) - min(section) + 1)::BIGINT AS size_section FROM @det GROUP BY animal")
def agg_origin_and_size(t: Tables) -> DataFrame:
    return S.origin_and_size(T.detections(t), ["animal"], ["x", "y", "section"])


@query("SELECT min(x) AS min_x, max(x) AS max_x, avg(x) AS mean_x, min(y) AS min_y, max(y) AS max_y, avg(y) AS mean_y FROM @det WHERE predictions = 2")
def agg_merged_bbox(t: Tables) -> DataFrame:
    return S.bounding_box(T.detections(t).where("predictions = 2"), [], ["x", "y"])


@query("SELECT image, sum(value * row) / nullif(sum(value), 0)::DOUBLE AS row, sum(value * col) / nullif(sum(value), 0)::DOUBLE AS col FROM @pix GROUP BY image")
def agg_voxel_com(t: Tables) -> DataFrame:
    return S.weighted_centre(T.pixels(t), ["image"], "value", ["row", "col"])


@query("""WITH RECURSIVE s AS MATERIALIZED (SELECT DISTINCT structure AS id, CASE structure % 3 WHEN 1 THEN 'L' WHEN 2 THEN 'R' ELSE 'S' END AS side FROM @vox), c AS (SELECT id AS a, id FROM s UNION ALL SELECT c.a, s.id FROM c JOIN s ON floor(s.id / 2) = c.id)
  SELECT s.id AS structure, s.side, sum(v.z) / count(v.z) * 10 AS z, sum(v.y) / count(v.z) * 10 AS y, sum(v.x) / count(v.z) * 10 AS x, count(v.z) AS n FROM s JOIN c ON c.a = s.id LEFT JOIN @vox v ON v.structure = c.id AND (s.side = 'S' OR (s.side = 'L') = (v.x < 50)) GROUP BY ALL""")
def agg_hemisphere_com(t: Tables) -> DataFrame:
    """Centres of all structures over their descendants; structure k lies under k div 2, and its name ends in L, R or neither."""
    side = F.when(F.col("structure") % 3 == 1, "L").when(F.col("structure") % 3 == 2, "R").otherwise("S")
    asked = T.voxels(t).select("structure").distinct().withColumn("side", side)
    tree = asked.select(F.col("structure").cast("long").alias("id"), F.expr("structure div 2").alias("parent_id"))
    return H.hemisphere_centres(T.voxels(t), tree, asked, 50, 10.0)


@query("SELECT cx, cy, count(*) AS n, array_to_string(list_sort(list(x)), ',') AS xs FROM (SELECT floor(x / 250)::BIGINT AS cx, floor(y / 250)::BIGINT AS cy, x FROM @human) GROUP BY ALL")
def agg_chunk_lists(t: Tables) -> DataFrame:
    rows = T.human_points(t).select(F.floor(F.col("x") / 250).alias("cx"), F.floor(F.col("y") / 250).alias("cy"), "x")
    return rows.groupBy("cx", "cy").agg(F.count("*").alias("n"), F.array_join(F.array_sort(F.collect_list("x")).cast("array<string>"), ",").alias("xs"))


@query("SELECT predictions, status, count(*) AS n FROM @det GROUP BY ALL")
def agg_class_counts(t: Tables) -> DataFrame:
    return T.detections(t).groupBy("predictions", "status").agg(F.count("*").alias("n"))


@query("SELECT animal AS layer, section, count(*) AS n FROM @det GROUP BY ALL")
def agg_section_counts(t: Tables) -> DataFrame:
    return T.detections(t).groupBy(F.col("animal").alias("layer"), "section").agg(F.count("*").alias("n"))


@query("SELECT image, least(value * 50 // 500, 49) AS bin, count(*) AS n FROM @pix WHERE value BETWEEN 0 AND 500 AND value > 0 GROUP BY ALL")
def agg_histogram_single(t: Tables) -> DataFrame:
    return S.histogram(T.pixels(t).where("value > 0"), ["image"], "value", 0, 500, 50)


@query("SELECT value, count(*) / (SELECT count(DISTINCT image) FROM @pix) AS n FROM @pix WHERE value <> 0 GROUP BY value")
def agg_histogram_combined(t: Tables) -> DataFrame:
    return S.combined_histogram(T.pixels(t))


@query("SELECT floor(x / 100)::BIGINT AS x_bin, floor(y / 100)::BIGINT AS y_bin, floor(section / 10)::BIGINT AS section_bin, count(*) AS n FROM @det GROUP BY ALL")
def agg_density_3d(t: Tables) -> DataFrame:
    return S.density_grid(T.detections(t), [0, 0, 0], [100, 100, 10], ["x", "y", "section"])


@query("SELECT floor(x / 50)::BIGINT AS x, floor(y / 50)::BIGINT AS y, count(DISTINCT animal) AS n_brains FROM @det GROUP BY ALL")
def agg_pooled_voxels(t: Tables) -> DataFrame:
    rows = T.detections(t).select(F.floor(F.col("x") / 50).alias("x"), F.floor(F.col("y") / 50).alias("y"), "animal")
    return S.pooled_voxels(rows, ["x", "y"], "animal")


@query("SELECT section, count(*) FILTER (status = 'F') AS F, count(*) FILTER (status = 'O') AS O, count(*) FILTER (status = 'P') AS P FROM @det GROUP BY section")
def agg_pivot_counts(t: Tables) -> DataFrame:
    return T.detections(t).groupBy("section").pivot("status", ["F", "O", "P"]).agg(F.count(F.lit(1))).fillna(0)


@query("SELECT sha256(text) AS hash, count(*) AS n, min(doc_id) AS first_name FROM documents GROUP BY ALL HAVING count(*) > 1")
def agg_exact_duplicates(t: Tables) -> DataFrame:
    return M.exact_duplicates(t.documents, "doc_id", "text")


@query("SELECT page_id, sha256(html) AS sha256, md5(html) AS md5 FROM pages")
def agg_checksums(t: Tables) -> DataFrame:
    return t.pages.select("page_id", F.sha2("html", 256).alias("sha256"), F.md5("html").alias("md5"))


@query("SELECT slide, scene, channel, count(*) AS n FROM @scn GROUP BY ALL HAVING count(*) > 1")
def agg_duplicate_keys(t: Tables) -> DataFrame:
    return M.duplicate_keys(T.scenes(t), ["slide", "scene", "channel"])


@query("SELECT prep, annotator, n FROM (SELECT *, row_number() OVER (PARTITION BY prep ORDER BY n DESC, annotator) AS r FROM (SELECT prep, annotator, count(*) AS n FROM @ses GROUP BY ALL)) WHERE r = 1")
def agg_mode_annotator(t: Tables) -> DataFrame:
    return S.mode(T.sessions(t), ["prep"], "annotator")


@query("SELECT image, value, n FROM (SELECT *, row_number() OVER (PARTITION BY image ORDER BY n DESC, value) AS r FROM (SELECT image, floor(value / 50)::BIGINT AS value, count(*) AS n FROM @pix WHERE row IN (0, 7) OR col IN (0, 7) GROUP BY ALL)) WHERE r = 1")
def agg_mode_border(t: Tables) -> DataFrame:
    border = T.pixels(t).where("row in (0, 7) or col in (0, 7)").select("image", F.floor(F.col("value") / 50).alias("value"))
    return S.mode(border, ["image"], "value")


@query("SELECT row, col, round((m - avg(m) OVER ()) / stddev_pop(m) OVER (), 9) AS z FROM (SELECT row, col, avg(value) AS m FROM @pix GROUP BY ALL)")
def agg_mean_image(t: Tables) -> DataFrame:
    from cartoscope.operators.pixels import mean_image

    return mean_image(T.pixels(t)).select("row", "col", F.round("z", 9).alias("z"))


@query("SELECT image, (avg(value) FILTER (value > 150) - avg(value)) / (avg(value) FILTER (value > 150) + avg(value)) AS contrast FROM @pix GROUP BY image HAVING count(*) FILTER (value > 150) > 0 UNION ALL SELECT image, 0.0 FROM @pix GROUP BY image HAVING count(*) FILTER (value > 150) = 0")
def agg_contrast(t: Tables) -> DataFrame:
    return T.pixels(t).groupBy("image").agg(S.contrast(F.col("value"), F.col("value") > 150).alias("contrast"))


@query("SELECT *, 2 * n_both / (na + nb) AS dice FROM (SELECT (SELECT count(DISTINCT (section, x)) FROM @human) AS na, (SELECT count(DISTINCT (section, x)) FROM @machine) AS nb, (SELECT count(*) FROM (SELECT section, x FROM @human INTERSECT SELECT section, x FROM @machine)) AS n_both)")
def agg_dice(t: Tables) -> DataFrame:
    mask = lambda df: df.select("section", "x").distinct()
    return S.dice(mask(T.human_points(t)), mask(T.machine_points(t)), ["section", "x"])


@query("""WITH s AS (SELECT (mean_score + 3.5::DOUBLE) / 7 AS score, (status = 'F')::INTEGER AS label FROM @det), e AS (SELECT score, sum(label) AS p, sum(1 - label) AS n FROM s GROUP BY score), c AS (SELECT p, n, sum(p) OVER w AS tp, sum(n) OVER w AS fp FROM e WINDOW w AS (ORDER BY score DESC))
  SELECT sum(n * (2 * c.tp - p))::DOUBLE / 2 / (max(c.tp) * max(c.fp))::DOUBLE AS auc, first(k.tp) AS tp, first(k.fp) AS fp, first(k.fn) AS fn, first(k.tn) AS tn FROM c, (SELECT count(*) FILTER (score >= 0.5 AND label = 1) AS tp, count(*) FILTER (score >= 0.5 AND label = 0) AS fp, count(*) FILTER (score < 0.5 AND label = 1) AS fn, count(*) FILTER (score < 0.5 AND label = 0) AS tn FROM s) k""")
def agg_roc_auc(t: Tables) -> DataFrame:
    rows = T.detections(t).select(((F.col("mean_score") + 3.5) / 7).alias("score"), (F.col("status") == "F").cast("int").alias("label"))
    return S.auc(rows, "score", "label")


@query("SELECT threshold, count(*) FILTER (mean_score <= threshold AND status = 'F') / count(*) FILTER (status = 'F') AS miss_rate, count(*) FILTER (mean_score > threshold AND status <> 'F') / count(*) FILTER (status <> 'F') AS false_rate, count(*) FILTER (abs(mean_score) < abs(threshold)) / count(*) AS abstain_rate FROM @det, (SELECT unnest([-2.005, -1.005, 0.005, 1.005, 2.005])::DOUBLE AS threshold) GROUP BY threshold")
def agg_error_curve(t: Tables) -> DataFrame:
    rows = T.detections(t).select("mean_score", (F.col("status") == "F").cast("int").alias("label"))
    return S.error_curve(rows, "mean_score", "label", [-2.005, -1.005, 0.005, 1.005, 2.005])


@query("SELECT round((avg(f2) FILTER (flag = 'A') - avg(f2) FILTER (flag = 'R')) / sqrt(((count(*) FILTER (flag = 'A') - 1) * var_samp(f2) FILTER (flag = 'A') + (count(*) FILTER (flag = 'R') - 1) * var_samp(f2) FILTER (flag = 'R')) / (count(*) FILTER (flag = 'A') + count(*) FILTER (flag = 'R') - 2)), 9) AS d, count(*) FILTER (flag = 'A') AS n_first, count(*) FILTER (flag = 'R') AS n_second FROM @ftr")
def agg_effect_size(t: Tables) -> DataFrame:
    out = S.effect_size(T.features(t), "flag", "f2", "A", "R")
    return out.select(F.round("d", 9).alias("d"), "n_first", "n_second")


@query("WITH f AS (SELECT regr_slope(y, x) AS slope, regr_intercept(y, x) AS intercept FROM @det), r AS (SELECT y - slope * x - intercept AS r, slope, intercept FROM @det, f) SELECT round(first(slope), 9) AS slope, round(first(intercept), 6) AS intercept, count(*) FILTER (r > 0) AS n_above, count(*) FILTER (r < 0) AS n_below, round(quantile_cont(r, 0.95) FILTER (r > 0), 6) AS p95_above, round(quantile_cont(-r, 0.95) FILTER (r < 0), 6) AS p95_below FROM r")
def agg_linear_fit(t: Tables) -> DataFrame:
    out = S.linear_fit(T.detections(t), "x", "y")
    return out.select(F.round("slope", 9).alias("slope"), F.round("intercept", 6).alias("intercept"), "n_above", "n_below", F.round("p95_above", 6).alias("p95_above"), F.round("p95_below", 6).alias("p95_below"))


KS = """WITH o AS (SELECT box, f1 AS v, count(*) AS c FROM @ftr GROUP BY ALL), n AS (SELECT box, sum(c) AS n FROM o GROUP BY box), r AS (SELECT v, sum(c) OVER (ORDER BY v) / sum(c) OVER () AS upto, (sum(c) OVER (ORDER BY v) - c) / sum(c) OVER () AS before FROM (SELECT f1 AS v, count(*) AS c FROM @ftr GROUP BY ALL)),
  g AS (SELECT box, n, v, greatest(abs(s / n - upto), abs((s - c) / n - before)) AS gap FROM (SELECT o.box, n.n, o.v, o.c, sum(o.c) OVER (PARTITION BY o.box ORDER BY o.v) AS s FROM o JOIN n USING (box)) JOIN r USING (v))"""


@query(KS + " SELECT box, n::BIGINT AS n, max(gap) AS ks FROM g GROUP BY ALL")
def agg_ks_two_sample(t: Tables) -> DataFrame:
    return S.ks_two_sample(T.features(t), T.features(t), "box", "f1").select("box", "n", "ks")


@query(
    KS
    + """, d AS (SELECT box, max(gap) AS ks, sqrt(n * t / (n + t)) AS root FROM g, (SELECT count(*)::DOUBLE AS t FROM @ftr) GROUP BY box, n, t),
  p AS (SELECT floor(box / 10)::BIGINT AS bx, box % 10 AS by, list_sum(list_transform(range(1, 11), lambda k: 2 * pow(-1, k - 1) * exp(-2 * k * k * lam * lam))) AS p FROM (SELECT box, (root + 0.12::DOUBLE + 0.11::DOUBLE / root) * ks AS lam FROM d))
  SELECT a.bx, a.by, b.bx AS bx2, b.by AS by2, CASE WHEN a.p < 0.05 AND b.p < 0.05 THEN 'both' WHEN a.p < 0.05 THEN 'first' WHEN b.p < 0.05 THEN 'second' ELSE 'none' END AS relation
  FROM p a JOIN p b ON abs(a.bx - b.bx) <= 1 AND abs(a.by - b.by) <= 1 AND NOT (a.bx = b.bx AND a.by = b.by)"""
)
def agg_box_relation(t: Tables) -> DataFrame:
    """Neighbouring boxes and whether each differs from the background."""
    p = S.ks_two_sample(T.features(t), T.features(t), "box", "f1").select(F.floor(F.col("box") / 10).alias("bx"), (F.col("box") % 10).alias("by"), "p_value")
    return S.box_relation(P.adjacent_boxes(p, ["bx", "by"])).select("bx", "by", "bx2", "by2", "relation")


@query("SELECT 'a' || i AS a, 'a' || j AS b, n, round(ma, 9) AS mean_a, round(mb, 9) AS mean_b, round(c, 6) AS cov FROM (SELECT 1 AS i, 1 AS j, count(a1) AS n, avg(a1) AS ma, avg(a1) AS mb, covar_pop(a1, a1) AS c FROM @fna UNION ALL SELECT 1, 2, count(*) FILTER (a1 IS NOT NULL AND a2 IS NOT NULL), avg(a1) FILTER (a2 IS NOT NULL), avg(a2) FILTER (a1 IS NOT NULL), covar_pop(a1, a2) FROM @fna UNION ALL SELECT 2, 2, count(a2), avg(a2), avg(a2), covar_pop(a2, a2) FROM @fna)")
def agg_covariance_nan(t: Tables) -> DataFrame:
    rows = T.features(t).select(F.when(F.col("f3") != 3, F.col("f1")).alias("a1"), F.when(F.col("f3") != 2, F.floor(F.col("f2") / 100).cast("double")).alias("a2"))
    out = S.covariance(rows, ["a1", "a2"])
    return out.select("a", "b", "n", F.round("mean_a", 9).alias("mean_a"), F.round("mean_b", 9).alias("mean_b"), F.round("cov", 6).alias("cov"))


@query()
def agg_pca_axes(t: Tables) -> DataFrame:
    rows = T.voxels(t).select("structure", "x", "y", "z")
    out = S.principal_axes(rows, ["structure"])
    return out.select("structure", *[F.round(c, 6).alias(c) for c in out.columns[1:7]])


@query("SELECT row, col, avg(value) AS mean, avg(value) > quantile_cont(avg(value), 0.8) OVER () AS kept FROM @pix GROUP BY ALL")
def agg_mean_mask(t: Tables) -> DataFrame:
    from cartoscope.operators.pixels import mean_mask

    return mean_mask(T.pixels(t), 0.8)


@query("SELECT (row + image % 5)::BIGINT AS row, (col + image % 3)::BIGINT AS col, sum(value)::BIGINT AS value FROM @pix GROUP BY ALL")
def agg_assemble_volume(t: Tables) -> DataFrame:
    from cartoscope.operators.pixels import assemble

    return assemble(T.pixels(t), F.col("image") % 5, F.col("image") % 3, F.sum)


@query("SELECT (row + (image % 7) * 6)::BIGINT AS row, (col + (image % 4) * 6)::BIGINT AS col, max(value)::BIGINT AS value FROM @pix GROUP BY ALL")
def agg_max_composite(t: Tables) -> DataFrame:
    from cartoscope.operators.pixels import assemble

    return assemble(T.pixels(t), (F.col("image") % 7) * 6, (F.col("image") % 4) * 6, F.max)


@query("SELECT structure, count(*) AS n FROM @vox GROUP BY structure")
def agg_distinct_ids(t: Tables) -> DataFrame:
    return T.voxels(t).groupBy("structure").agg(F.count("*").alias("n"))


@query("SELECT count(*) AS n, sum(n_chars)::BIGINT AS total, min(n_chars) AS smallest, max(n_chars) AS largest, count(*) FILTER (n_chars < 200) AS undersized, count(*) - 1000 AS off FROM documents")
def agg_dir_quality(t: Tables) -> DataFrame:
    return M.directory_quality(t.documents, "n_chars", 200, 1000)


@query("SELECT user_id, count(*) FILTER (value >= 10) = count(*) AND count(*) FILTER (event_type <> 'error') = count(*) AS complete, count(*) AS n FROM events GROUP BY user_id")
def agg_complete_animals(t: Tables) -> DataFrame:
    flags = t.events.select("user_id", (F.col("value") >= 10).alias("examples"), (F.col("event_type") != "error").alias("features"))
    return M.complete(flags, "user_id", ["examples", "features"])


@query("SELECT (ceil(max(x) / 64) * 64)::BIGINT AS width, (ceil(max(y) / 64) * 64)::BIGINT AS height FROM @det")
def agg_max_size(t: Tables) -> DataFrame:
    return M.canvas(T.detections(t), "x", "y", 64)
