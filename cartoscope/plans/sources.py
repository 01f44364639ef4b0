"""Queries on sources and sinks: files are written from the tables to the shared folder and read back."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cartoscope.functions.durable import shared_dir
from cartoscope.plans import tables as T
from cartoscope.plans.registry import Tables, query
from cartoscope.sources import files as S
from cartoscope.sources import writers as O


def folder(t: Tables, name: str) -> str:
    return f"{shared_dir(t.spark)}/{name}-{uuid.uuid4().hex}"


def detection_rows(t: Tables) -> DataFrame:
    return T.detections(t).select("animal", F.col("section"), F.col("y").cast("double").alias("row"), F.col("x").cast("double").alias("col"), "mean_score", "std_score", "predictions")


@query("SELECT animal, section, y::DOUBLE AS row, x::DOUBLE AS col, predictions FROM @det")
def src_detections_csv(t: Tables) -> DataFrame:
    path = folder(t, "detections")
    detection_rows(t).write.option("header", True).csv(path)
    return S.detections_csv(t.spark, path).select("animal", "section", "row", "col", "predictions")


@query("SELECT section::DOUBLE AS section, x::DOUBLE AS x, predictions::DOUBLE AS predictions FROM @det UNION ALL SELECT section::DOUBLE, x::DOUBLE, 0.0 FROM @human")
def src_schema_reconcile(t: Tables) -> DataFrame:
    return S.reconcile([T.detections(t).select("section", "animal", "x", "predictions"), T.human_points(t).select("x", "y", "section")])


def counted_without_tiny(t: Tables, documents: DataFrame) -> DataFrame:
    """Documents written as lines beside files that are too small, and read back without those."""
    path = folder(t, "tiny")
    rows = documents.select(F.concat(F.lit("doc,"), F.lpad(F.col("doc_id").cast("string"), 12, "0")).alias("value"))
    rows.write.text(path)
    t.spark.range(4, numPartitions=4).select(F.lit("x").alias("value")).write.text(path + "-small")
    lines = S.without_tiny(t.spark, path).unionByName(S.without_tiny(t.spark, path + "-small"))
    return lines.groupBy(F.element_at(F.split("line", ","), 2).cast("long").alias("doc_id")).agg(F.count("*").alias("n"))


@query("SELECT doc_id, count(*) AS n FROM documents GROUP BY doc_id")
def src_skip_tiny_csv(t: Tables) -> DataFrame:
    return counted_without_tiny(t, t.documents)


@query("SELECT event_id, event_type, value FROM events WHERE user_id = 7")
def src_db_tables(t: Tables) -> DataFrame:
    return S.prep_table(t.events, "user_id", 7, ["event_id", "event_type", "value"])


@query("SELECT structure, round(sum(x), 6) AS x, round(sum(y), 6) AS y, count(*) AS n FROM (SELECT section::VARCHAR AS structure, rotation * 2 AS x, xshift * 2 AS y FROM @trf) GROUP BY structure")
def src_com_textfiles(t: Tables) -> DataFrame:
    path = folder(t, "com")
    rows = T.transforms(t).select("section", F.concat_ws(" ", "rotation", "xshift", "yshift").alias("value"))
    S.dealt(rows, "section").write.partitionBy("section").text(path)
    read = t.spark.read.text(path, wholetext=True)
    parts = F.split(F.trim("value"), r"\s+")
    out = read.select(F.col("section").cast("string").alias("structure"), (parts[0].cast("double") * 2).alias("x"), (parts[1].cast("double") * 2).alias("y"))
    return out.groupBy("structure").agg(F.round(F.sum("x"), 6).alias("x"), F.round(F.sum("y"), 6).alias("y"), F.count("*").alias("n"))


@query("SELECT polygon, count(*) AS n, sum(x)::DOUBLE AS sx, sum(y)::DOUBLE AS sy FROM @pol GROUP BY polygon")
def src_hand_contours(t: Tables) -> DataFrame:
    point = F.concat(F.lit("[ "), F.col("x"), F.lit("\n "), F.col("y"), F.lit(" ]"))
    text = F.concat(F.lit("["), F.array_join(F.collect_list(point), " "), F.lit(",,]"))
    rows = T.polygons(t).groupBy("polygon").agg(text.alias("vertices"))
    read = S.hand_contours(rows)
    total = lambda i: F.aggregate("points", F.lit(0.0), lambda s, p: s + p[i])
    return read.select("polygon", F.size("points").cast("long").alias("n"), total(0).alias("sx"), total(1).alias("sy"))


@query("SELECT section, rotation, xshift, yshift FROM @trf")
def src_transform_params(t: Tables) -> DataFrame:
    text = F.concat(F.lit("// x\n(TransformParameters "), F.concat_ws(" ", "rotation", "xshift", "yshift"), F.lit(")\n(Size 100 80)\n(Kind \"Euler\")"))
    rows = S.transform_parameters(T.transforms(t).select("section", text.alias("text")), "text")
    p = F.col("params")["TransformParameters"]
    return rows.select("section", p[0].alias("rotation"), p[1].alias("xshift"), p[2].alias("yshift"))


@query("SELECT section, rotation AS m00, round(xshift + 10 - 10 * rotation, 6) AS m03 FROM @trf")
def src_transform_params_ants(t: Tables) -> DataFrame:
    values = F.concat_ws(" ", "rotation", *map(F.lit, "0 0 0 1 0 0 0 1".split()), "xshift", F.lit("0"), F.lit("0"))
    text = F.concat(F.lit("#Transform\nParameters: "), values, F.lit("\nFixedParameters: 10 20 30\n"))
    rows = S.labelled_numbers(S.labelled_numbers(T.transforms(t).select("section", text.alias("text")), "text", "Parameters", "v"), "text", "FixedParameters", "c")
    m = S.affine_with_centre(F.col("v"), F.col("c"))
    return rows.select("section", m[0].alias("m00"), F.round(m[3], 6).alias("m03"))


@query("SELECT x::DOUBLE AS x, y::DOUBLE AS y, section::DOUBLE AS z FROM @human")
def src_registered_points(t: Tables) -> DataFrame:
    line = F.concat(F.lit("Point\t1\t; OutputPoint = [ "), F.concat_ws(" ", "x", "y", "section"), F.lit(" ]\t; Deformation = [ 0 0 ]"))
    lines = T.human_points(t).select(line.alias("value"))
    return S.registered_points(lines.unionByName(t.spark.range(3).select(F.lit("header").alias("value"))))


@query("SELECT section, 'point' || chr(10) || count(*) || chr(10) || string_agg(x || ' ' || y, chr(10) ORDER BY id) AS text FROM @human GROUP BY section")
def sink_point_file(t: Tables) -> DataFrame:
    """A file a section, written and read back as text."""
    path = folder(t, "points")
    O.write_points(T.human_points(t), "section", ["x", "y"], ["id"], path)
    return t.spark.read.text(path, wholetext=True).select(F.regexp_extract(F.col("_metadata.file_name"), r"(.*)\.pts", 1).cast("int").alias("section"), F.regexp_replace("value", r"\n$", "").alias("text"))


@query("SELECT section AS layer, count(*) AS n, round(sum(rotation), 6) AS z FROM @trf GROUP BY section")
def src_tile_info_json(t: Tables) -> DataFrame:
    path = folder(t, "tiles")
    rows = T.transforms(t).select(F.col("section").alias("layer"), F.array("xshift", "yshift").alias("tile_mmxx_um"), F.array("xshift", "yshift").alias("tile_mmll_um"), F.col("rotation").alias("layer_z_um"), F.array("xshift").alias("stack_size_um"), F.lit(0).alias("tile"))
    S.dealt(rows, "layer", "tile").write.partitionBy("layer", "tile").json(path)
    return S.tile_info(t.spark, path).groupBy(F.col("layer").cast("long").alias("layer")).agg(F.count("*").alias("n"), F.round(F.sum("layer_z_um"), 6).alias("z"))


@query("SELECT id, acronym, name, parent_id FROM @ont WHERE id NOT LIKE 'c%'")
def src_ontology_json(t: Tables) -> DataFrame:
    o = T.ontology(t)
    nations = o.where("id like 'n%'").groupBy("parent_id").agg(F.collect_list(F.struct("id", "acronym", "name")).alias("children"))
    regions = o.where("id like 'r%' and id <> 'root'").join(nations.withColumnRenamed("parent_id", "p"), F.col("id") == F.col("p"), "left")
    whole = regions.agg(F.collect_list(F.struct("id", "acronym", "name", "children")).alias("children"))
    text = whole.select(F.to_json(F.struct(F.lit("root").alias("id"), F.lit("rt").alias("acronym"), F.lit("root").alias("name"), "children")).alias("text"))
    return S.flatten_ontology(text, "text", 2)


@query("SELECT count(*) AS n, sum(area)::DOUBLE AS total FROM @det WHERE predictions = 2")
def src_results_tsv_gz(t: Tables) -> DataFrame:
    path = folder(t, "tsv")
    T.detections(t).select((F.col("predictions") == 2).cast("int").alias("selected"), "area").write.option("sep", "\t").option("header", True).option("compression", "gzip").csv(path)
    return S.selected_total(t.spark, path, "area")


@query("SELECT count(DISTINCT section) AS n FROM @human")
def src_file_inventory(t: Tables) -> DataFrame:
    path = folder(t, "inventory")
    T.human_points(t).repartition("section").write.partitionBy("section").option("header", True).csv(path)
    return S.inventory(t.spark, path).where("name like '%.csv' and length > 0").agg(F.count("*").alias("n"))


@query("SELECT section, count(*) AS n, sum(x)::BIGINT AS sx FROM @det GROUP BY section")
def sink_detections_csv(t: Tables) -> DataFrame:
    path = folder(t, "sink")
    S.write_partitioned(T.detections(t).select("section", "x", "y", "predictions"), path, "section")
    return t.spark.read.option("header", True).csv(path).groupBy("section").agg(F.count("*").alias("n"), F.sum(F.col("x").cast("long")).alias("sx"))


@query("SELECT section, '{\"x\":' || x || ',\"y\":' || y || ',\"section\":' || section || '}' AS json FROM @det WHERE predictions > 0")
def sink_all_predictions(t: Tables) -> DataFrame:
    rows = T.detections(t).where("predictions > 0").orderBy("section")
    return rows.select("section", F.to_json(F.struct("x", "y", "section")).alias("json"))


@query("SELECT sum(n)::BIGINT AS n_points, count(*) AS n_cells, max(n) AS \"limit\" FROM (SELECT floor(x / 200)::BIGINT AS cx, floor(y / 200)::BIGINT AS cy, floor(section / 10)::BIGINT AS cz, count(*) AS n FROM @det GROUP BY ALL)")
def sink_spatial_chunks(t: Tables) -> DataFrame:
    """A file a cell, written and read back by folders that tasks own."""
    path, cells = folder(t, "chunks"), ["cx", "cy", "cz"]
    points = T.detections(t).select("id", "x", "y", F.col("section").alias("z"))
    O.write_cells(S.spatial_chunks(points, (200, 200, 10)), cells, path)
    return S.chunk_info(O.read_cells(t.spark, cells, points.schema, path))


@query("SELECT cx, cy, cz, count(*) AS n FROM (SELECT DISTINCT floor(x / 256)::BIGINT AS cx, floor(y / 256)::BIGINT AS cy, floor(section / 16)::BIGINT AS cz, x, y, section FROM @human WHERE y >= 0 AND section >= 0) GROUP BY ALL")
def sink_chunked_voxels(t: Tables) -> DataFrame:
    """A slab of ones for each chunk with a point, written and read back. Slabs are packed: most of their voxels are 0."""
    path, size = folder(t, "slabs"), (256, 256, 16)
    points = T.human_points(t).select("x", "y", F.col("section").alias("z"))
    shape = points.agg(*[F.coalesce(F.max(c), F.lit(0)) + 1 for c in "xyz"]).first()
    O.write_slabs(points.where("y >= 0 and z >= 0"), size, shape, path, packed=True)
    rows = S.spatial_chunks(O.read_slabs(t.spark.read.format("binaryFile").load(path)), size)
    return rows.groupBy("cx", "cy", "cz").agg(F.count("*").alias("n"))
