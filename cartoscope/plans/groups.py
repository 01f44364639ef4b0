"""Queries on groups, matches and the region tree."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cartoscope.operators import groups as G
from cartoscope.operators import spatial as P
from cartoscope.operators import stats as ST
from cartoscope.operators import tree as H
from cartoscope.plans import tables as T
from cartoscope.plans.registry import TABLES_SQL, Tables, query

TABLES_SQL["near30"] = "SELECT a.id AS a, b.id AS b FROM @det a JOIN @det b ON a.section = b.section AND a.id <> b.id AND (a.x - b.x) * (a.x - b.x) + (a.y - b.y) * (a.y - b.y) < 900"
GROUPS = """WITH RECURSIVE e AS MATERIALIZED (SELECT * FROM @near30), reach AS (
  SELECT id AS node, id AS root FROM @det UNION SELECT e.b, r.root FROM reach r JOIN e ON e.a = r.node WHERE r.root < e.b
), grp AS (SELECT node AS id, min(root) AS group_id FROM reach GROUP BY node),
named AS (SELECT d.*, g.group_id, CASE d.status WHEN 'F' THEN 'human' WHEN 'O' THEN 'machine' ELSE 'manual' END || CASE d.predictions WHEN 2 THEN '_sure' WHEN 0 THEN '_unsure' ELSE '_null' END AS name FROM @det d JOIN grp g USING (id)),
cat AS (SELECT group_id, list(name ORDER BY name) AS names, count(*) AS size FROM named GROUP BY group_id) """


def named_groups(t: Tables) -> DataFrame:
    who = F.when(F.col("status") == "F", "human").when(F.col("status") == "O", "machine").otherwise("manual")
    what = F.when(F.col("predictions") == 2, "_sure").when(F.col("predictions") == 0, "_unsure").otherwise("_null")
    return G.point_groups(T.detections(t), 30).withColumn("name", F.concat(who, what))


@query(GROUPS + "SELECT node AS id, component FROM (SELECT id AS node, group_id AS component FROM grp WHERE id IN (SELECT a FROM e))")
def iter_components(t: Tables) -> DataFrame:
    from cartoscope.operators.graph import connected_components

    return connected_components(P.proximity_pairs(T.detections(t), 30), "a", "b").withColumnRenamed("node", "id")


@query(GROUPS + "SELECT group_id, array_to_string(names, ',') AS names, size FROM cat")
def iter_point_groups(t: Tables) -> DataFrame:
    return G.group_categories(named_groups(t)).select("group_id", F.array_join("names", ",").alias("names"), "size")


RULES = {
    "computer_missed": {"include": ["human_sure"], "exclude": ["machine_sure", "machine_unsure", "machine_null"]},
    "human_missed": {"include": ["machine_sure"], "exclude": ["human_sure", "human_unsure", "human_null"]},
    "both": {"include": ["machine_sure", "human_sure"], "smallest": 2},
    "alone": {"largest": 1},
}


@query(
    GROUPS
    + """SELECT group_id, size, CASE WHEN list_contains(names, 'human_sure') AND NOT list_has_any(names, ['machine_sure', 'machine_unsure', 'machine_null']) THEN 'computer_missed'
  WHEN list_contains(names, 'machine_sure') AND NOT list_has_any(names, ['human_sure', 'human_unsure', 'human_null']) THEN 'human_missed'
  WHEN list_has_all(names, ['machine_sure', 'human_sure']) AND size >= 2 THEN 'both' WHEN size <= 1 THEN 'alone' END AS rule FROM cat"""
)
def iter_group_rules(t: Tables) -> DataFrame:
    return G.apply_rules(G.group_categories(named_groups(t)), RULES).select("group_id", "size", "rule")


@query(
    GROUPS
    + """SELECT agreement, count(*) AS n FROM (SELECT CASE WHEN (p1 AND n2) OR (n1 AND p2) THEN 'disagree' WHEN p1 AND p2 THEN 'agree_positive' WHEN n1 AND n2 THEN 'agree_negative' WHEN p1 OR n1 OR p2 OR n2 THEN 'single' ELSE 'none' END AS agreement
  FROM (SELECT list_contains(names, 'human_sure') AS p1, list_contains(names, 'machine_sure') AS p2, list_contains(names, 'human_null') AS n1, list_contains(names, 'machine_null') AS n2 FROM cat)) GROUP BY agreement"""
)
def iter_rater_agreement(t: Tables) -> DataFrame:
    groups = G.agreement(G.group_categories(named_groups(t)), ("human_sure", "machine_sure"), ("human_null", "machine_null"))
    return groups.groupBy("agreement").agg(F.count("*").alias("n"))


@query(
    GROUPS
    + """SELECT c, u, p, n, count(*) AS n_groups FROM (SELECT group_id, count(*) FILTER (name = 'machine_sure') AS c, count(*) FILTER (name = 'machine_unsure') AS u, count(*) FILTER (name = 'human_sure') AS p, count(*) FILTER (name = 'human_null') AS n FROM named GROUP BY group_id) GROUP BY ALL"""
)
def iter_cupn(t: Tables) -> DataFrame:
    is_ = lambda n: F.col("name") == n
    return G.cupn(named_groups(t), is_("machine_sure"), is_("machine_unsure"), is_("human_sure"), is_("human_null"))


@query(
    GROUPS
    + """, kept AS MATERIALIZED (SELECT d.id, d.section, d.x, d.y FROM @det d JOIN grp g ON d.id = g.id AND g.group_id = d.id)
  SELECT id, section, x, y FROM kept k WHERE NOT EXISTS (SELECT 1 FROM kept p WHERE p.section + 1 = k.section AND (p.x - k.x) * (p.x - k.x) + (p.y - k.y) * (p.y - k.y) < 900)"""
)
def iter_dedupe_detections(t: Tables) -> DataFrame:
    return G.dedupe(T.detections(t).select("id", "section", "x", "y"), 30)


@query(
    GROUPS
    + """, k AS (SELECT group_id, id, 1000 + 500 * (id % 5) AS threshold, predictions = 2 AS sure, mean_score FROM named WHERE predictions >= 0),
  h AS (SELECT *, bool_or(sure) OVER (PARTITION BY group_id) AS has_sure FROM k), c AS (SELECT * FROM h WHERE sure OR NOT has_sure),
  b AS (SELECT group_id, threshold FROM (SELECT *, row_number() OVER (PARTITION BY group_id ORDER BY mean_score DESC, threshold) AS r FROM c) WHERE r = 1)
  SELECT c.id, c.group_id, c.threshold FROM c JOIN b ON c.group_id = b.group_id AND c.threshold = b.threshold"""
)
def win_best_threshold(t: Tables) -> DataFrame:
    rows = named_groups(t).where("predictions >= 0").select("group_id", "id", (F.lit(1000) + 500 * (F.col("id") % 5)).alias("threshold"), F.when(F.col("predictions") == 2, "sure").otherwise("unsure").alias("kind"), "mean_score")
    return G.best_threshold(rows).select("id", "group_id", "threshold")


TABLES_SQL["mth"] = """SELECT id * 10 + (threshold // 100) % 10 AS id, section, x + (threshold % 300)::DOUBLE / 100 AS x, y, mean_score - threshold::DOUBLE / 10000 AS mean_score, CASE WHEN predictions = 2 THEN 'sure' ELSE 'unsure' END AS kind, threshold
  FROM (SELECT * FROM @det WHERE predictions >= 0), (SELECT unnest([2000, 2100, 2200, 2300, 2700]) AS threshold) WHERE (id + threshold // 100) % 3 > 0"""


@query(
    """WITH RECURSIVE t AS MATERIALIZED (SELECT * FROM @mth), e AS MATERIALIZED (SELECT a.id AS a, b.id AS b FROM t a JOIN t b ON a.section = b.section AND a.id <> b.id AND (a.x - b.x) * (a.x - b.x) + (a.y - b.y) * (a.y - b.y) < 900),
  reach AS (SELECT id AS node, id AS root FROM t UNION SELECT e.b, r.root FROM reach r JOIN e ON e.a = r.node WHERE r.root < e.b), grp AS (SELECT node AS id, min(root) AS group_id FROM reach GROUP BY node),
  h AS (SELECT t.*, group_id, bool_or(kind = 'sure') OVER (PARTITION BY group_id) AS has_sure FROM t JOIN grp USING (id)), c AS (SELECT * FROM h WHERE kind = 'sure' OR NOT has_sure),
  b AS (SELECT group_id, threshold FROM (SELECT *, row_number() OVER (PARTITION BY group_id ORDER BY mean_score DESC, threshold) AS r FROM c) WHERE r = 1)
  SELECT c.id, c.group_id, c.threshold, c.kind FROM c JOIN b ON c.group_id = b.group_id AND c.threshold = b.threshold"""
)
def iter_multi_threshold(t: Tables) -> DataFrame:
    """Detections of five thresholds (the same cells moved a little) combined into final ones."""
    rows = T.detections(t).where("predictions >= 0").select("id", "section", "x", "y", "mean_score", "predictions", F.explode(F.array(*[F.lit(v) for v in (2000, 2100, 2200, 2300, 2700)])).alias("threshold"))
    rows = rows.where((F.col("id") + F.col("threshold") / 100) % 3 > 0).select((F.col("id") * 10 + F.col("threshold") / 100 % 10).cast("long").alias("id"), "section", (F.col("x") + F.col("threshold") % 300 / 100).alias("x"), "y", (F.col("mean_score") - F.col("threshold") / 10000).alias("mean_score"), F.when(F.col("predictions") == 2, "sure").otherwise("unsure").alias("kind"), "threshold")
    return G.best_threshold(G.point_groups(rows, 30)).select("id", "group_id", "threshold", "kind")


@query(
    """WITH RECURSIVE e AS MATERIALIZED (SELECT a.id AS a, b.id AS b FROM @human a JOIN @human b ON a.section + 1 = b.section AND (a.x - b.x) * (a.x - b.x) + (a.y - b.y) * (a.y - b.y) < 900),
  s AS MATERIALIZED (SELECT a, b FROM e UNION ALL SELECT b, a FROM e), reach AS (SELECT DISTINCT a AS node, a AS root FROM s UNION SELECT s.b, r.root FROM reach r JOIN s ON s.a = r.node WHERE r.root < s.b),
  g AS (SELECT node AS id, min(root) AS c FROM reach GROUP BY node)
  SELECT n_sections, count(*) AS n_cells FROM (SELECT c, (max(section) - min(section) + 1)::INTEGER AS n_sections FROM g JOIN @human h ON h.id = g.id GROUP BY c) GROUP BY n_sections"""
)
def win_consecutive_runs(t: Tables) -> DataFrame:
    return G.consecutive_runs(T.human_points(t), 30)


@query()
def join_greedy_match(t: Tables) -> DataFrame:
    pairs = P.candidate_pairs(T.human_points(t), T.machine_points(t), 40)
    return G.greedy_match(pairs)


@query()
def iter_greedy_match(t: Tables) -> DataFrame:
    pairs = P.candidate_pairs(T.human_points(t), T.detections(t).where("status = 'P'"), 25)
    return G.greedy_match(pairs)


@query()
def agg_confusion_prf(t: Tables) -> DataFrame:
    pairs = P.candidate_pairs(T.human_points(t), T.machine_points(t), 40)
    return ST.precision_recall(G.greedy_match(pairs), T.human_points(t).count(), T.machine_points(t).count(), [10, 20, 30, 40])


TREE = """WITH RECURSIVE tree AS MATERIALIZED (SELECT * FROM @ont), clo AS (SELECT id AS ancestor, id, 0 AS depth FROM tree UNION ALL SELECT c.ancestor, t.id, c.depth + 1 FROM clo c JOIN tree t ON t.parent_id = c.id) """


@query(TREE + "SELECT ancestor, id, depth FROM clo")
def iter_hierarchy_closure(t: Tables) -> DataFrame:
    return G.closure(T.ontology(t))


@query(TREE + "SELECT c.ancestor AS id, coalesce(sum(n), 0)::BIGINT AS total FROM clo c LEFT JOIN @cnt o ON o.id = c.id GROUP BY c.ancestor")
def agg_hierarchy_rollup(t: Tables) -> DataFrame:
    return G.rollup(T.ontology(t), T.region_counts(t))


@query(TREE + "SELECT id, depth FROM clo WHERE ancestor = 'r1' AND depth BETWEEN 1 AND 2")
def iter_level_cutoff(t: Tables) -> DataFrame:
    return H.within_levels(H.intervals(T.ontology(t)), "r1", 2)


@query("SELECT id, parent_id, name FROM @ont WHERE id IN (SELECT parent_id FROM @ont) OR id IN (SELECT id FROM @cnt)")
def iter_prune_leaves(t: Tables) -> DataFrame:
    return G.prune_leaves(T.ontology(t), T.region_counts(t)).select("id", "parent_id", "name")


@query(TREE + "SELECT o.id, coalesce(m.to_id, o.id) AS merged FROM @cnt o LEFT JOIN (SELECT id, arg_min(ancestor, depth) AS to_id FROM clo WHERE ancestor LIKE 'n1%' GROUP BY id) m ON m.id = o.id")
def iter_merge_to_parent(t: Tables) -> DataFrame:
    chosen = T.ontology(t).where("id like 'n1%'")
    near = H.nearest_chosen(T.ontology(t), chosen)
    return T.region_counts(t).select("id").join(near, "id", "left").select("id", F.coalesce("chosen", "id").alias("merged"))


@query(TREE + "SELECT ancestor AS id, count(*) - 1 AS below, max(CASE WHEN ancestor = 'root' THEN 0 WHEN ancestor LIKE 'r%' THEN 1 WHEN ancestor LIKE 'n%' THEN 2 ELSE 3 END)::INTEGER AS depth FROM clo GROUP BY ancestor")
def iter_tree_intervals(t: Tables) -> DataFrame:
    """Number of descendants and depth of every region, from its interval."""
    return H.intervals(T.ontology(t)).select("id", (F.col("last") - F.col("first")).alias("below"), "depth")


@query(TREE + "SELECT c.ancestor AS id, coalesce(sum(n), 0)::BIGINT AS total FROM clo c LEFT JOIN @cnt o ON o.id = c.id GROUP BY c.ancestor")
def agg_interval_rollup(t: Tables) -> DataFrame:
    """Counts over descendants as differences of running sums."""
    return H.subtree_sums(H.intervals(T.ontology(t)), T.region_counts(t), ["n"]).withColumnRenamed("n", "total")


@query("SELECT v.structure, count(*) FILTER (WHERE d.id IS NOT NULL) AS n FROM (SELECT DISTINCT structure FROM @vox) v LEFT JOIN (SELECT id, x % 60 AS structure FROM @det) d ON d.structure = v.structure GROUP BY v.structure")
def agg_structure_counts(t: Tables) -> DataFrame:
    points = T.detections(t).select("id", (F.col("x") % 60).alias("structure"))
    return ST.structure_counts(points, T.voxels(t).select("structure").distinct())


@query("SELECT structure, n, (n - lo) * 255.0::DOUBLE / (hi - lo) AS density FROM (SELECT structure, n, min(n) OVER () AS lo, max(n) OVER () AS hi FROM (SELECT x % 60 AS structure, count(*) AS n FROM @det GROUP BY ALL))")
def agg_density_scaled(t: Tables) -> DataFrame:
    counts = T.detections(t).groupBy((F.col("x") % 60).alias("structure")).agg(F.count("*").alias("n"))
    return ST.scaled(counts, "n", "density", 255.0)
