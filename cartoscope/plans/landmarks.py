"""Queries on landmark sets and transforms."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window as W

from cartoscope.operators import chains as C
from cartoscope.operators import landmarks as L
from cartoscope.operators import rotations as Q
from cartoscope.operators import stats as ST
from cartoscope.plans import tables as T
from cartoscope.plans.registry import TABLES_SQL, Tables, query

TABLES_SQL["lmp"] = "SELECT b.brain, a.structure, a.x AS x1, a.y AS y1, a.z AS z1, b.x AS x2, b.y AS y2, b.z AS z2 FROM @lm a JOIN @lm b ON a.structure = b.structure WHERE a.brain = 'BUILDING' AND b.brain <> 'BUILDING'"


def paired(t: Tables) -> DataFrame:
    """Landmarks of every brain beside those of the reference brain."""
    lm = T.landmarks(t)
    a = lm.where("brain = 'BUILDING'").select("structure", *[F.col(c).alias(f"{c}1") for c in "xyz"])
    b = lm.where("brain <> 'BUILDING'").select("brain", "structure", *[F.col(c).alias(f"{c}2") for c in "xyz"])
    return a.join(b, "structure").select("brain", "structure", "x1", "y1", "z1", "x2", "y2", "z2")


def digits(df: DataFrame, n: int = 4) -> DataFrame:
    """Doubles rounded, for fits whose last digits follow from the order of sums."""
    return df.select([F.round(c, n).alias(c) if k == "double" else F.col(c) for c, k in df.dtypes])


@query()
def agg_affine_fit(t: Tables) -> DataFrame:
    return digits(L.affine_fit(paired(t), ["brain"]))


@query()
def agg_similarity_fit(t: Tables) -> DataFrame:
    return digits(L.similarity_fit(paired(t), ["brain"]))


@query()
def agg_registration_error(t: Tables) -> DataFrame:
    pairs = paired(t)
    return digits(L.registration_error(pairs, L.affine_fit(pairs, ["brain"]), ["brain"]))


@query()
def map_affine(t: Tables) -> DataFrame:
    fits = L.affine_fit(paired(t), ["brain"])
    points = T.detections(t).select("id", F.element_at(F.array(*map(F.lit, ("MACHINERY", "FURNITURE", "HOUSEHOLD", "AUTOMOBILE"))), (F.col("id") % 4 + 1).cast("int")).alias("brain"), F.col("x").cast("double").alias("x"), F.col("y").cast("double").alias("y"), F.col("section").cast("double").alias("z"))
    return digits(L.map_points(points, fits, "brain"), 3)


@query()
def map_inverse(t: Tables) -> DataFrame:
    fits = L.similarity_fit(paired(t), ["brain"])
    return digits(L.map_points(T.landmarks(t), fits, "brain", inverse=True), 3)


@query("""WITH p AS (SELECT section, rotation AS r, xshift + 100 - 100 * cos(rotation) + 80 * sin(rotation) AS tx, yshift + 80 - 100 * sin(rotation) - 80 * cos(rotation) AS ty, (SELECT count(*) // 2 FROM @trf) AS mid FROM @trf),
  u AS (SELECT section, a, sum(cos(a) * tx + sin(a) * ty) OVER w AS u, sum(-sin(a) * tx + cos(a) * ty) OVER w AS v FROM (SELECT *, sum(r) OVER (ORDER BY section) AS a FROM p WHERE section > mid) WINDOW w AS (ORDER BY section)),
  d AS (SELECT section - 1 AS section, a, sum(cos(a - r) * tx - sin(a - r) * ty) OVER w AS dx, sum(sin(a - r) * tx + cos(a - r) * ty) OVER w AS dy FROM (SELECT *, sum(r) OVER (ORDER BY section DESC) AS a FROM p WHERE section <= mid) WINDOW w AS (ORDER BY section DESC)),
  o AS (SELECT section, cos(a) AS c, sin(a) AS s, cos(a) * u - sin(a) * v AS dx, sin(a) * u + cos(a) * v AS dy FROM u UNION ALL SELECT section, cos(a), -sin(a), -cos(a) * dx - sin(a) * dy, sin(a) * dx - cos(a) * dy FROM d UNION ALL SELECT section, 1, 0, 0, 0 FROM p WHERE section = mid)
  SELECT section, round(c, 6) AS m00, round(-s, 6) AS m01, round(dx, 6) AS m02, round(s, 6) AS m10, round(c, 6) AS m11, round(dy, 6) AS m12 FROM o""")
def win_compose_rigid(t: Tables) -> DataFrame:
    n = t.supplier.count()
    return digits(L.compose_sections(T.transforms(t), n // 2, (100.0, 80.0)), 6)


STEPS = "SELECT *, row_number() OVER (PARTITION BY animal ORDER BY section) - 1 AS i, count(*) OVER (PARTITION BY animal) // 2 AS mid FROM @aff"
#: Entries of the next matrix n times those of the product so far p.
NEXT = "n.m00 * p.m00 + n.m01 * p.m10, n.m00 * p.m01 + n.m01 * p.m11, n.m00 * p.m02 + n.m01 * p.m12 + n.m02, n.m10 * p.m00 + n.m11 * p.m10, n.m10 * p.m01 + n.m11 * p.m11, n.m10 * p.m02 + n.m11 * p.m12 + n.m12"
ONE = "1::DOUBLE AS m00, 0::DOUBLE AS m01, 0::DOUBLE AS m02, 0::DOUBLE AS m10, 1::DOUBLE AS m11, 0::DOUBLE AS m12"


@query(f"""WITH RECURSIVE t AS MATERIALIZED ({STEPS}), v AS (SELECT animal, i - 1 AS i, m11 / d AS m00, -m01 / d AS m01, (m01 * m12 - m11 * m02) / d AS m02, -m10 / d AS m10, m00 / d AS m11, (m10 * m02 - m00 * m12) / d AS m12 FROM (SELECT *, m00 * m11 - m01 * m10 AS d FROM t)),
  up AS (SELECT animal, i, {ONE} FROM t WHERE i = mid UNION ALL SELECT p.animal, n.i, {NEXT} FROM up p JOIN t n ON n.animal = p.animal AND n.i = p.i + 1),
  down AS (SELECT animal, i, {ONE} FROM t WHERE i = mid UNION ALL SELECT p.animal, n.i, {NEXT} FROM down p JOIN v n ON n.animal = p.animal AND n.i = p.i - 1)
  SELECT animal, section, {', '.join(f'round(c.m{i}{j}, 6) AS m{i}{j}' for i in range(2) for j in range(3))} FROM (SELECT * FROM up UNION ALL SELECT d.* FROM down d JOIN t ON t.animal = d.animal AND t.i = d.i AND d.i < t.mid) c JOIN t USING (animal, i)""")
def win_compose_transforms(t: Tables) -> DataFrame:
    """Affine transforms of every section to the middle one of its animal."""
    return digits(C.to_middle(T.affine_steps(t), "animal", "section"), 6)


@query(f"""WITH RECURSIVE t AS MATERIALIZED ({STEPS}), p AS (SELECT animal, i, m00, m01, m02, m10, m11, m12 FROM t WHERE i = 0 UNION ALL SELECT p.animal, n.i, {NEXT} FROM p JOIN t n ON n.animal = p.animal AND n.i = p.i + 1)
  SELECT p.animal, p.i::INTEGER AS pos, t.section, {', '.join(f'round(p.m{i}{j}, 6) AS m{i}{j}' for i in range(2) for j in range(3))}, round(l.m00 * l.m11 - l.m01 * l.m10, 6) AS det FROM p JOIN t USING (animal, i) JOIN p l ON l.animal = p.animal AND l.i = (SELECT max(i) FROM t u WHERE u.animal = p.animal)""")
def arr_matrix_fold(t: Tables) -> DataFrame:
    """Ordered arrays of an animal's matrices: running products by element, and the determinant of the whole product."""
    steps = T.affine_steps(t).select("animal", "section", C.as_struct([F.col(c) for c in C.ENTRIES]).alias("m"))
    lists = steps.groupBy("animal").agg(F.sort_array(F.collect_list(F.struct("section", "m"))).alias("x"))
    lists = lists.select("animal", F.col("x.section").alias("section"), C.scanned(F.col("x.m")).alias("m"), C.folded(F.col("x.m")).alias("all"))
    rows = lists.select("animal", F.posexplode(F.arrays_zip("section", "m")).alias("pos", "x"), (F.col("all.m00") * F.col("all.m11") - F.col("all.m01") * F.col("all.m10")).alias("det"))
    return digits(rows.select("animal", "pos", "x.section", *[F.col(f"x.m.{c}").alias(c) for c in C.ENTRIES], "det"), 6)


HALVES = ", ".join(f"{f}({c} / 2) AS {f[0]}{c}" for c in "xyz" for f in ("cos", "sin"))


@query(f"""WITH q AS MATERIALIZED (SELECT brain, id, sx * cy * cz - cx * sy * sz AS x, cx * sy * cz + sx * cy * sz AS y, cx * cy * sz - sx * sy * cz AS z, cx * cy * cz + sx * sy * sz AS w FROM (SELECT brain, id, {HALVES} FROM @trn)),
  a AS (SELECT q.brain, CASE WHEN q.x * f.x + q.y * f.y + q.z * f.z + q.w * f.w < 0 THEN -1 ELSE 1 END AS s, q.x, q.y, q.z, q.w FROM q JOIN (SELECT * FROM q QUALIFY row_number() OVER (PARTITION BY brain ORDER BY id) = 1) f ON f.brain = q.brain),
  m AS (SELECT brain, count(*) AS n, avg(s * x) AS x, avg(s * y) AS y, avg(s * z) AS z, avg(s * w) AS w FROM a GROUP BY brain), u AS (SELECT brain, n, x / l AS x, y / l AS y, z / l AS z, w / l AS w FROM (SELECT *, sqrt(x * x + y * y + z * z + w * w) AS l FROM m))
  SELECT brain, n, round(1 - 2 * (y * y + z * z), 6) AS r00, round(2 * (x * y - z * w), 6) AS r01, round(2 * (x * z + y * w), 6) AS r02, round(2 * (x * y + z * w), 6) AS r10, round(1 - 2 * (x * x + z * z), 6) AS r11, round(2 * (y * z - x * w), 6) AS r12,
         round(2 * (x * z - y * w), 6) AS r20, round(2 * (y * z + x * w), 6) AS r21, round(1 - 2 * (x * x + y * y), 6) AS r22 FROM u""")
def agg_average_rotation(t: Tables) -> DataFrame:
    """Mean rotation of each brain's axes, turned to the side of the first."""
    rows = T.turns(t).select("brain", "id", *[v.alias(k) for k, v in Q.euler_matrix(F.col("x"), F.col("y"), F.col("z")).items()])
    return digits(Q.aligned_mean(rows, ["brain"], "id"), 6)


@query()
def agg_main_rotation(t: Tables) -> DataFrame:
    """The rotation closest to all axes of each brain."""
    rows = T.turns(t).select("brain", *[v.alias(k) for k, v in Q.euler_matrix(F.col("x"), F.col("y"), F.col("z")).items()])
    return digits(Q.main_rotation(rows, ["brain"]), 6)


@query()
def iter_combinations(t: Tables) -> DataFrame:
    return digits(L.rank_combinations(paired(t), 5, ["brain"]))


@query()
def topk_best_combo(t: Tables) -> DataFrame:
    """The ten best combinations of every brain."""
    ranked = digits(L.rank_combinations(paired(t), 5, ["brain"]))
    best = W.partitionBy("brain").orderBy("mean_dist", "combo")
    return ranked.withColumn("place", F.row_number().over(best)).where("place <= 10").drop("place")


@query("SELECT structure, avg(x) AS x, avg(y) AS y, avg(z) AS z, count(*) AS n_brains FROM @lm GROUP BY structure")
def agg_com_across_brains(t: Tables) -> DataFrame:
    return ST.mean_points(T.landmarks(t), ["structure"]).withColumnRenamed("n", "n_brains")


ERR = "SELECT brain, structure, x2 - x1 AS dx, y2 - y1 AS dy, z2 - z1 AS dz FROM @lmp"
TABLES_SQL["err"] = ERR


@query("SELECT name, max(v) FILTER (brain = 'AUTOMOBILE') AS AUTOMOBILE, max(v) FILTER (brain = 'FURNITURE') AS FURNITURE, max(v) FILTER (brain = 'HOUSEHOLD') AS HOUSEHOLD, max(v) FILTER (brain = 'MACHINERY') AS MACHINERY FROM (SELECT brain, structure || '_dx' AS name, dx AS v FROM @err UNION ALL SELECT brain, structure || '_dy', dy FROM @err UNION ALL SELECT brain, structure || '_dz', dz FROM @err) GROUP BY name")
def agg_error_pivot(t: Tables) -> DataFrame:
    rows = paired(t).select("brain", "structure", *[(F.col(f"{c}2") - F.col(f"{c}1")).alias(f"d{c}") for c in "xyz"])
    return ST.error_pivot(rows, ["dx", "dy", "dz"], ["AUTOMOBILE", "FURNITURE", "HOUSEHOLD", "MACHINERY"])


@query("SELECT structure, count(*) AS n, quantile_cont(dx, 0.25) AS q1, quantile_cont(dx, 0.5) AS median, quantile_cont(dx, 0.75) AS q3 FROM @err GROUP BY structure HAVING count(*) >= 3")
def agg_offset_boxplot(t: Tables) -> DataFrame:
    rows = paired(t).select("structure", (F.col("x2") - F.col("x1")).alias("dx"))
    return ST.box_quantiles(rows, ["structure"], "dx", 3)


@query("SELECT avg(rotation) AS rotation, avg(xshift) AS xshift, avg(yshift) AS yshift FROM @trf")
def agg_average_transform(t: Tables) -> DataFrame:
    return T.transforms(t).agg(*[F.avg(c).alias(c) for c in ("rotation", "xshift", "yshift")])
