"""Stand-ins for the domain's tables, made from the given ones; each as a DataFrame and as SQL.

Integer arithmetic on purpose, so that both sides agree to the last digit.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cartoscope.operators.detect import threshold_class
from cartoscope.plans.registry import TABLES_SQL, Tables


def whole(c: str) -> Column:
    return F.floor(F.col(c)).cast("long")


def months(c: str) -> Column:
    return ((F.year(c) - 1995) * 12 + F.month(c) - 1).cast("int")


def detections(t: Tables) -> DataFrame:
    """Scored detections: id, animal, section, x, y, area, mean_score, std_score, status, predictions."""
    n = whole("o_totalprice")
    rows = t.orders.select(
        F.col("o_orderkey").alias("id"),
        F.col("o_orderpriority").alias("animal"),
        months("o_orderdate").alias("section"),
        F.col("o_custkey").alias("x"),
        (n % 1000).alias("y"),
        (n % 5000).alias("area"),
        ((n % 700) / 100 - 3.5).alias("mean_score"),
        ((n % 310) / 100).alias("std_score"),
        F.col("o_orderstatus").alias("status"),
    )
    return rows.withColumn("predictions", threshold_class(F.col("mean_score"), 1.5))


TABLES_SQL["det"] = """
SELECT *, CASE WHEN mean_score > 1.5 THEN 2 WHEN mean_score >= -1.5 THEN 0 ELSE -2 END::INTEGER AS predictions FROM (
  SELECT o_orderkey AS id, o_orderpriority AS animal, ((year(o_orderdate) - 1995) * 12 + month(o_orderdate) - 1)::INTEGER AS section, o_custkey AS x,
         floor(o_totalprice)::BIGINT % 1000 AS y, floor(o_totalprice)::BIGINT % 5000 AS area,
         (floor(o_totalprice)::BIGINT % 700)::DOUBLE / 100 - 3.5::DOUBLE AS mean_score, (floor(o_totalprice)::BIGINT % 310)::DOUBLE / 100 AS std_score, o_orderstatus AS status FROM orders)"""


def human_points(t: Tables) -> DataFrame:
    """Points marked by people: detections of status F, moved by (1, -1)."""
    return detections(t).where("status = 'F'").select("id", "section", (F.col("x") + 1).alias("x"), (F.col("y") - 1).alias("y"))


TABLES_SQL["human"] = "SELECT id, section, x + 1 AS x, y - 1 AS y FROM @det WHERE status = 'F'"


def machine_points(t: Tables) -> DataFrame:
    """Points found by a detector: detections of status O."""
    return detections(t).where("status = 'O'").select("id", "section", "x", "y")


TABLES_SQL["machine"] = "SELECT id, section, x, y FROM @det WHERE status = 'O'"


def sessions(t: Tables) -> DataFrame:
    """Annotation sessions: id, prep, label, updated, active, annotator."""
    return t.events.select(
        F.col("event_id").alias("id"), F.col("user_id").alias("prep"), F.col("event_type").alias("label"), F.col("ts").alias("updated"), (F.col("value") >= 10).alias("active"), (F.col("event_id") % 7).alias("annotator"), "value"
    )


TABLES_SQL["ses"] = "SELECT event_id AS id, user_id AS prep, event_type AS label, ts AS updated, value >= 10 AS active, event_id % 7 AS annotator, value FROM events"


def landmarks(t: Tables) -> DataFrame:
    """Centres of mass: brain, structure, x, y, z."""
    rows = t.customer.groupBy(F.col("c_mktsegment").alias("brain"), F.col("c_nationkey").alias("structure"))
    return rows.agg(F.avg(F.floor("c_acctbal").cast("long")).alias("x"), F.avg("c_custkey").alias("y"), F.count("*").cast("double").alias("z"))


TABLES_SQL["lm"] = "SELECT c_mktsegment AS brain, c_nationkey AS structure, avg(floor(c_acctbal)::BIGINT)::DOUBLE AS x, avg(c_custkey)::DOUBLE AS y, count(*)::DOUBLE AS z FROM customer GROUP BY ALL"


def ontology(t: Tables) -> DataFrame:
    """Region tree: id, parent_id, name, acronym; root, regions, nations, customers."""
    root = t.spark.sql("SELECT 'root' AS id, CAST(NULL AS string) AS parent_id, 'root' AS name, 'rt' AS acronym")
    region = t.region.select(F.concat(F.lit("r"), "r_regionkey").alias("id"), F.lit("root").alias("parent_id"), F.col("r_name").alias("name"), F.substring("r_name", 1, 2).alias("acronym"))
    nation = t.nation.select(F.concat(F.lit("n"), "n_nationkey").alias("id"), F.concat(F.lit("r"), "n_regionkey").alias("parent_id"), F.col("n_name").alias("name"), F.substring("n_name", 1, 3).alias("acronym"))
    customer = t.customer.select(F.concat(F.lit("c"), "c_custkey").alias("id"), F.concat(F.lit("n"), "c_nationkey").alias("parent_id"), F.col("c_name").alias("name"), F.col("c_mktsegment").alias("acronym"))
    return root.unionByName(region).unionByName(nation).unionByName(customer)


TABLES_SQL["ont"] = """
SELECT 'root' AS id, NULL::VARCHAR AS parent_id, 'root' AS name, 'rt' AS acronym
UNION ALL SELECT 'r' || r_regionkey, 'root', r_name, substr(r_name, 1, 2) FROM region
UNION ALL SELECT 'n' || n_nationkey, 'r' || n_regionkey, n_name, substr(n_name, 1, 3) FROM nation
UNION ALL SELECT 'c' || c_custkey, 'n' || c_nationkey, c_name, c_mktsegment FROM customer"""


def region_counts(t: Tables) -> DataFrame:
    """Cells counted in each leaf of the tree: id, n."""
    return t.orders.groupBy(F.concat(F.lit("c"), "o_custkey").alias("id")).agg(F.count("*").alias("n"))


TABLES_SQL["cnt"] = "SELECT 'c' || o_custkey AS id, count(*) AS n FROM orders GROUP BY ALL"


def scenes(t: Tables) -> DataFrame:
    """Scenes of slides: scan_run, slide, scene, channel, file, active."""
    return t.lineitem.select(
        F.col("l_returnflag").alias("scan_run"), F.col("l_orderkey").alias("slide"), F.col("l_linenumber").alias("scene"), (F.col("l_suppkey") % 3 + 1).alias("channel"), F.col("l_partkey").alias("file"), (F.col("l_linestatus") == "F").alias("active")
    )


TABLES_SQL["scn"] = "SELECT l_returnflag AS scan_run, l_orderkey AS slide, l_linenumber AS scene, l_suppkey % 3 + 1 AS channel, l_partkey AS file, l_linestatus = 'F' AS active FROM lineitem"


def transforms(t: Tables) -> DataFrame:
    """Section-to-previous rigid parameters: section, rotation, xshift, yshift."""
    return t.supplier.select(F.col("s_suppkey").alias("section"), (F.floor("s_acctbal") / 10000).alias("rotation"), F.col("s_suppkey").cast("double").alias("xshift"), (-F.col("s_suppkey")).cast("double").alias("yshift"))


TABLES_SQL["trf"] = "SELECT s_suppkey AS section, floor(s_acctbal)::DOUBLE / 10000 AS rotation, s_suppkey::DOUBLE AS xshift, (-s_suppkey)::DOUBLE AS yshift FROM supplier"


def affine_steps(t: Tables) -> DataFrame:
    """Section-to-previous affine transforms with shear: animal, section, m00 to m12."""
    k = F.col("s_suppkey")
    m = {"m00": 1 + (k % 7 - 3) / 64, "m01": (k % 5 - 2) / 32, "m02": (k % 11 - 5).cast("double"), "m10": (k % 3 - 1) / 16, "m11": 1 - (k % 4) / 64, "m12": (F.floor("s_acctbal") % 13).cast("double")}
    return t.supplier.select(F.col("s_nationkey").alias("animal"), k.alias("section"), *[v.alias(c) for c, v in m.items()])


TABLES_SQL["aff"] = """SELECT s_nationkey AS animal, s_suppkey AS section, 1 + (s_suppkey % 7 - 3) / 64::DOUBLE AS m00, (s_suppkey % 5 - 2) / 32::DOUBLE AS m01, (s_suppkey % 11 - 5)::DOUBLE AS m02,
  (s_suppkey % 3 - 1) / 16::DOUBLE AS m10, 1 - (s_suppkey % 4) / 64::DOUBLE AS m11, (floor(s_acctbal)::BIGINT % 13)::DOUBLE AS m12 FROM supplier"""


def turns(t: Tables) -> DataFrame:
    """Euler angles of axes found in brains: brain, id, x, y, z."""
    k = F.col("c_custkey")
    return t.customer.select(F.col("c_mktsegment").alias("brain"), k.alias("id"), (F.floor("c_acctbal") / 20000).alias("x"), (k % 50 / 40).alias("y"), (k % 97 / 16).alias("z"))


TABLES_SQL["trn"] = "SELECT c_mktsegment AS brain, c_custkey AS id, floor(c_acctbal)::DOUBLE / 20000 AS x, (c_custkey % 50) / 40::DOUBLE AS y, (c_custkey % 97) / 16::DOUBLE AS z FROM customer"


def pixels(t: Tables) -> DataFrame:
    """Pixels of 8 x 8 images: image, row, col, value."""
    e = t.embeddings.select(F.col("vec_id").alias("image"), F.posexplode("embedding").alias("p", "e"))
    return e.select("image", F.floor(F.col("p") / 8).cast("int").alias("row"), (F.col("p") % 8).alias("col"), F.floor(F.abs(F.col("e").cast("double")) * 1000).cast("long").alias("value"))


TABLES_SQL["pix"] = """
SELECT vec_id AS image, floor((p - 1) / 8)::INTEGER AS row, ((p - 1) % 8)::INTEGER AS col, floor(abs(e::DOUBLE) * 1000)::BIGINT AS value
FROM (SELECT vec_id, unnest(embedding) AS e, generate_subscripts(embedding, 1) AS p FROM embeddings)"""


def voxels(t: Tables) -> DataFrame:
    """Label volume: z, y, x, structure; voxel (z, y, x) are the digits of a part's key."""
    k = F.col("p_partkey")
    return t.part.select(F.floor(k / 10000).alias("z"), (F.floor(k / 100) % 100).alias("y"), (k % 100).alias("x"), F.col("p_size").alias("structure"), k.alias("voxel"))


TABLES_SQL["vox"] = "SELECT floor(p_partkey / 10000)::BIGINT AS z, (floor(p_partkey / 100)::BIGINT) % 100 AS y, p_partkey % 100 AS x, p_size AS structure, p_partkey AS voxel FROM part"


def polygons(t: Tables) -> DataFrame:
    """Polygon vertices: polygon, section, point_order, x, y; one polygon an order, one vertex a line."""
    from pyspark.sql.window import Window as W

    order = W.partitionBy("l_orderkey").orderBy("l_linenumber", "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice", "l_shipdate", "l_discount", "l_tax")
    lines = t.lineitem.withColumn("point_order", F.row_number().over(order).cast("long"))
    rows = lines.join(t.orders.select("o_orderkey", months("o_orderdate").alias("section")), lines.l_orderkey == F.col("o_orderkey"))
    return rows.select(F.col("l_orderkey").alias("polygon"), "section", "point_order", (F.col("l_partkey") % 200).alias("x"), (F.col("l_suppkey") % 100 + F.col("l_quantity").cast("long")).alias("y"))


TABLES_SQL["pol"] = """
SELECT l_orderkey AS polygon, ((year(o_orderdate) - 1995) * 12 + month(o_orderdate) - 1)::INTEGER AS section,
       row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey, l_suppkey, l_quantity, l_extendedprice, l_shipdate, l_discount, l_tax) AS point_order,
       l_partkey % 200 AS x, l_suppkey % 100 + l_quantity::BIGINT AS y
FROM lineitem JOIN orders ON l_orderkey = o_orderkey"""


def features(t: Tables) -> DataFrame:
    """Features of cells in boxes: box, cell, f1, f2, f3."""
    return t.lineitem.select((F.col("l_suppkey") % 100).alias("box"), "l_orderkey", F.col("l_quantity").alias("f1"), F.floor("l_extendedprice").cast("double").alias("f2"), (F.col("l_linenumber") % 10).cast("double").alias("f3"), F.col("l_returnflag").alias("flag"))


TABLES_SQL["ftr"] = "SELECT l_suppkey % 100 AS box, l_orderkey, l_quantity AS f1, floor(l_extendedprice)::DOUBLE AS f2, (l_linenumber % 10)::DOUBLE AS f3, l_returnflag AS flag FROM lineitem"

TABLES_SQL["fna"] = "SELECT CASE WHEN f3 <> 3 THEN f1 END AS a1, CASE WHEN f3 <> 2 THEN floor(f2 / 100) END AS a2 FROM @ftr"
