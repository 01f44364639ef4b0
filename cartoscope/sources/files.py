"""Readers and writers: detections CSV, parameter texts, point files, JSON, inventories, spatial chunks.

Schemas are fixed; text that does not fit gives nulls or no row, never an exception of the whole read.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

DETECTION = "animal string, section int, row double, col double, mean_score double, std_score double, predictions int"
TILE = "tile_mmxx_um array<double>, tile_mmll_um array<double>, layer_z_um double, stack_size_um array<double>"


def detections_csv(spark: SparkSession, path: str) -> DataFrame:
    """All detections files under a folder; empty and unreadable files give no rows."""
    return spark.read.option("header", True).option("mode", "PERMISSIVE").option("ignoreCorruptFiles", True).option("recursiveFileLookup", True).option("pathGlobFilter", "*.csv").schema(DETECTION).csv(path)


def reconcile(frames: Sequence[DataFrame]) -> DataFrame:
    """Rows of frames whose columns differ: numbers become doubles, predictions default to 0.0, and the columns that all have stay, in the first one's order."""
    numeric = ("int", "bigint", "float", "double", "smallint", "tinyint")
    cast = [f.select([F.col(c).cast("double").alias(c) if k in numeric else F.col(c) for c, k in f.dtypes]) for f in frames]
    cast = [f if "predictions" in f.columns else f.withColumn("predictions", F.lit(0.0)) for f in cast]
    common = [c for c in cast[0].columns if all(c in f.columns for f in cast)]
    return reduce(DataFrame.unionByName, [f.select(common) for f in cast])


def without_tiny(spark: SparkSession, path: str, smallest: int = 10) -> DataFrame:
    """Lines of the files under a folder that have at least so many bytes: rows (path, line)."""
    sizes = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(path).select("path", "length").where(F.col("length") >= smallest)
    lines = spark.read.option("recursiveFileLookup", True).text(path).select(F.col("_metadata.file_path").alias("path"), F.col("value").alias("line"))
    # both name a file alike but for the slashes behind its scheme
    bare = lambda c: F.regexp_replace(c, r"^(\w+):/+", "$1:/")
    return lines.join(sizes.select(bare(F.col("path")).alias("p")), bare(F.col("path")) == F.col("p"), "left_semi")


def prep_table(table: DataFrame, key: str, prep: object, columns: Sequence[str]) -> DataFrame:
    """Columns of one preparation's rows; the filter and the columns reach the scan."""
    return table.where(F.col(key) == F.lit(prep)).select(*columns)


def com_text_files(spark: SparkSession, path: str, scale: float = 1.0) -> DataFrame:
    """Landmarks from `<structure>.txt` files of three numbers: structure, x, y, z times scale."""
    rows = spark.read.option("wholetext", True).option("recursiveFileLookup", True).text(path)
    name = F.regexp_extract(F.col("_metadata.file_name"), r"^(.*)\.txt", 1)
    parts = F.split(F.trim("value"), r"[\s,]+")
    return rows.select(name.alias("structure"), *[(F.try_element_at(parts, F.lit(i + 1)).try_cast("double") * scale).alias(c) for i, c in enumerate("xyz")])


def hand_contours(rows: DataFrame, text: str = "vertices") -> DataFrame:
    """rows with points: the vertices of a malformed text (spaces for commas, line breaks, doubled commas) as arrays."""
    t = F.regexp_replace(F.col(text), r"\s+", ",")
    t = F.regexp_replace(F.regexp_replace(t, r",+", ","), r"\[,", "[")
    t = F.regexp_replace(t, r",\]", "]")
    t = F.regexp_replace(t, r"\]\[", "],[")
    return rows.withColumn("points", F.from_json(t, "array<array<double>>"))


def transform_parameters(rows: DataFrame, text: str) -> DataFrame:
    """rows with params: map from each key of `(Key v v v)` to its numbers."""
    found = F.regexp_extract_all(F.col(text), F.lit(r"\((\w+) ([^()]*)\)"), F.lit(0))
    entry = lambda t: F.struct(F.regexp_extract(t, r"\((\w+) ", 1), F.transform(F.split(F.regexp_extract(t, r"\(\w+ ([^()]*)\)", 1), " +"), lambda v: v.try_cast("double")))
    return rows.withColumn("params", F.map_from_entries(F.transform(found, entry)))


def affine_with_centre(values: Column, centre: Column) -> list[Column]:
    """3 x 4 matrix of twelve numbers (3 x 3, then translation) about a centre: the offset is t + c - A c."""
    a = [[values[3 * i + j] for j in range(3)] for i in range(3)]
    out = []
    for i in range(3):
        offset = values[9 + i] + centre[i] - sum((a[i][j] * centre[j] for j in range(3)), F.lit(0.0))
        out += [*a[i], offset]
    return out


def labelled_numbers(rows: DataFrame, text: str, label: str, name: str) -> DataFrame:
    """rows with the numbers behind a label at the start of a line, such as `Parameters: 1 2 3`."""
    line = F.regexp_extract(F.col(text), rf"(?m)^{label}:[ \t]*(.*)$", 1)
    return rows.withColumn(name, F.transform(F.split(F.trim(line), " +"), lambda v: v.try_cast("double")))


def registered_points(lines: DataFrame, text: str = "value") -> DataFrame:
    """Points of lines that hold `OutputPoint = [ x y z ]`."""
    inner = F.regexp_extract(F.col(text), r"OutputPoint = \[ ([^\]]*) \]", 1)
    parts = F.split(inner, " +")
    return lines.where(inner != "").select(*[F.try_element_at(parts, F.lit(i + 1)).try_cast("double").alias(c) for i, c in enumerate("xyz")])


def point_files(points: DataFrame, key: str, axes: Sequence[str], order: Sequence[str]) -> DataFrame:
    """Rows (key, text): per key a header with the number of points, then a line a point. A file is one key's points, as the format has it."""
    line = F.concat_ws(" ", *[F.col(c).cast("string") for c in axes])
    rows = points.groupBy(key).agg(F.array_sort(F.collect_list(F.struct(*order, line.alias("line")))).alias("l"))
    return rows.select(key, F.concat_ws("\n", F.lit("point"), F.size("l").cast("string"), F.array_join(F.transform("l", lambda v: v["line"]), "\n")).alias("text"))


def dealt(rows: DataFrame, *keys: str) -> DataFrame:
    """rows by keys to as many tasks as spark.sql.shuffle.partitions says, so that a key is one file of one task.

    The number is named because the adaptive planner would otherwise merge small rows into one task, however many files they become.
    """
    return rows.repartition(int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions")), *keys)


def write_partitioned(rows: DataFrame, path: str, key: str, kind: str = "csv") -> None:
    """One folder a key. Every task writes the rows it has, so a hot key is several files and nothing is shuffled."""
    rows.write.mode("overwrite").partitionBy(key).option("header", True).format(kind).save(path)


def tile_info(spark: SparkSession, path: str) -> DataFrame:
    """Tile JSON files with the layer and tile of their path."""
    rows = spark.read.schema(TILE).option("recursiveFileLookup", True).json(path)
    name = F.col("_metadata.file_path")
    return rows.select(F.regexp_extract(name, r"layer=(\d+)", 1).cast("int").alias("layer"), F.regexp_extract(name, r"tile=(\d+)", 1).cast("int").alias("tile"), "*")


def flatten_ontology(rows: DataFrame, column: str, depth: int) -> DataFrame:
    """Nodes (id, acronym, name, parent_id) of nested JSON children, down to depth levels."""
    kind = "struct<id:string,acronym:string,name:string>"
    for _ in range(depth):
        kind = f"struct<id:string,acronym:string,name:string,children:array<{kind}>>"
    level = rows.select(F.from_json(column, kind).alias("n"), F.lit(None).cast("string").alias("parent_id"))
    out = None
    for k in range(depth + 1):
        part = level.select("n.id", "n.acronym", "n.name", "parent_id")
        out = part if out is None else out.unionByName(part)
        if k < depth:
            level = level.select(F.explode("n.children").alias("c"), F.col("n.id").alias("parent_id")).select(F.col("c").alias("n"), "parent_id")
    return out


def selected_total(spark: SparkSession, path: str, column: str) -> DataFrame:
    """Number of the selected rows of gzipped TSV files and the sum of a column."""
    rows = spark.read.option("sep", "\t").option("header", True).csv(path)
    return rows.where("selected = '1'").agg(F.count("*").alias("n"), F.sum(F.col(column).try_cast("double")).alias("total"))


def inventory(spark: SparkSession, path: str) -> DataFrame:
    """Files of a folder: name, length. Contents are not read."""
    rows = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(path)
    return rows.select(F.element_at(F.split("path", "/"), -1).alias("name"), "length")


def spatial_chunks(points: DataFrame, size: Sequence[float], axes: Sequence[str] = ("x", "y", "z")) -> DataFrame:
    """points with the grid cell that each belongs to (cx, cy, cz)."""
    return points.withColumns({f"c{c}": F.floor(F.col(c) / s).cast("long") for c, s in zip(axes, size, strict=True)})


def chunk_info(chunked: DataFrame) -> DataFrame:
    """One row: points, cells, and the most points in a cell."""
    per = chunked.groupBy("cx", "cy", "cz").agg(F.count("*").alias("n"))
    return per.agg(F.sum("n").cast("long").alias("n_points"), F.count("*").alias("n_cells"), F.max("n").alias("limit"))
