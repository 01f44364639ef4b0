"""Metadata tables: sections view, sessions, ontology names, slides, scenes and file checks."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window as W

from cartoscope.operators.ordering import distinct_positions


def sections_view(animal: DataFrame, scan_run: DataFrame, slide: DataFrame, scene: DataFrame, good: str) -> DataFrame:
    """Scenes of good slides with their scan run and animal; channel_index counts channels from 0."""
    slides = slide.where(F.col("status") == good).join(scan_run, "run_id").join(animal, "animal_id")
    return scene.join(slides, "slide").withColumn("channel_index", F.col("channel") - 1)


def having(rows: DataFrame, other: DataFrame, key: str) -> DataFrame:
    """Rows whose key occurs in other."""
    return rows.join(other.select(key), key, "left_semi")


def having_labels(sessions: DataFrame, bridge: DataFrame, key: str, labels: Sequence[str]) -> DataFrame:
    """Sessions that have any of the labels through the bridge table."""
    return having(sessions, bridge.where(F.col("label").isin(list(labels))), key)


def com_with_region(com: DataFrame, session: DataFrame, region: DataFrame, condition: str) -> DataFrame:
    """Centres of mass with their session (filtered) and region."""
    return com.join(session.where(condition), F.col("session_id") == F.col("id")).join(region, "region_id")


def regions_by_animal(rows: DataFrame) -> DataFrame:
    """Per animal the distinct region names, sorted and comma-joined, and the number of rows."""
    return rows.groupBy("animal").agg(F.array_join(F.array_sort(F.collect_set("region")), ",").alias("regions"), F.count("*").alias("n"))


def activate(sessions: DataFrame, children: Mapping[str, DataFrame], kind: str, key: str) -> DataFrame:
    """sessions with active: whether the child table of their kind has a row for them."""
    out = None
    for name, child in children.items():
        part = having(sessions.where(F.col(kind) == name), child, key).select(F.col(key).alias("__k"), F.lit(name).alias("__n"))
        out = part if out is None else out.unionByName(part)
    found = out.distinct()
    return sessions.join(found, (F.col(key) == F.col("__k")) & (F.col(kind) == F.col("__n")), "left").select(*sessions.columns, F.col("__k").isNotNull().alias("active"))


def with_parent(ontology: DataFrame) -> DataFrame:
    """ontology with name and acronym of the parent, the text null for roots."""
    parent = ontology.select(F.col("id").alias("__id"), F.col("name").alias("__name"), F.col("acronym").alias("__acronym"))
    rows = ontology.join(parent, F.col("parent_id") == F.col("__id"), "left")
    return rows.select(*ontology.columns, F.coalesce("__name", F.lit("null")).alias("parent_name"), F.coalesce("__acronym", F.lit("null")).alias("parent_acronym"))


def structure_names(voxels: DataFrame, names: DataFrame) -> DataFrame:
    """voxels with the name of their structure; 0 and unknown structures are dropped."""
    return voxels.where("structure <> 0").join(names, "structure")


def latest(sessions: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """The latest session of each key by the order columns."""
    top = F.row_number().over(W.partitionBy(*keys).orderBy(*[F.desc(c) for c in order]))
    return sessions.withColumn("__r", top).where("__r = 1").drop("__r")


def keep_first(rows: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """One row of each key, the first by the order columns."""
    return rows.withColumn("__r", F.row_number().over(W.partitionBy(*keys).orderBy(*order))).where("__r = 1").drop("__r")


def scene_order(scenes: DataFrame) -> DataFrame:
    """Distinct scenes (channel, slide, scene, file) with their 0-based order per channel by slide, scene and file."""
    return distinct_positions(scenes, "channel", ["slide", "scene", "file"], "scene_order")


def section_files(rows: DataFrame, order: Sequence[str]) -> DataFrame:
    """rows numbered 0..n-1 in order, with a file name of three digits.

    The rows are range-partitioned by the order, so counts of partitions give the numbers and no task sorts all rows.
    """
    ranged = rows.repartitionByRange(*order).sortWithinPartitions(*order).withColumn("__p", F.spark_partition_id()).withColumn("__i", F.monotonically_increasing_id())
    ranged = ranged.withColumn("__at", F.row_number().over(W.partitionBy("__p").orderBy(*order)))
    sizes = ranged.groupBy("__p").agg(F.count("*").alias("__n"))
    before = sizes.withColumn("__before", F.sum("__n").over(W.orderBy("__p").rowsBetween(W.unboundedPreceding, -1))).fillna(0, ["__before"])
    out = ranged.join(F.broadcast(before), "__p").withColumn("section", (F.col("__before") + F.col("__at") - 1).cast("long"))
    return out.withColumn("file_name", F.concat(F.lpad(F.col("section").cast("string"), 3, "0"), F.lit(".tif"))).drop("__p", "__i", "__at", "__n", "__before")


def master_slides(scenes: DataFrame, keys: Sequence[str], slide: str) -> DataFrame:
    """scenes re-pointed to the smallest slide of their key (master), with master_active false for the other slides."""
    low = F.min(slide).over(W.partitionBy(*keys))
    return scenes.withColumn("master", low).withColumn("master_active", F.col(slide) == F.col("master"))


def duplicate_keys(rows: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keys that occur more than once, with their number of rows."""
    return rows.groupBy(*keys).agg(F.count("*").alias("n")).where("n > 1")


def exact_duplicates(files: DataFrame, name: str, content: str) -> DataFrame:
    """Groups of files with equal content: hash, number, smallest name. Names stay in the rows, not in a list."""
    return files.groupBy(F.sha2(content, 256).alias("hash")).agg(F.count("*").alias("n"), F.min(name).alias("first_name")).where("n > 1")


def complete(flags: DataFrame, key: str, needed: Sequence[str]) -> DataFrame:
    """Keys all of whose rows have every needed flag."""
    ok = F.lit(True)
    for c in needed:
        ok = ok & (F.count_if(F.col(c)) == F.count("*"))
    return flags.groupBy(key).agg(ok.alias("complete"), F.count("*").alias("n"))


def canvas(sections: DataFrame, width: str, height: str, unit: int = 64) -> DataFrame:
    """Largest width and height, rounded up to multiples of unit."""
    up = lambda c: (F.ceil(F.max(c) / unit) * unit).cast("long")
    return sections.agg(up(width).alias("width"), up(height).alias("height"))


def directory_quality(files: DataFrame, size: str, smallest: int, expected: int) -> DataFrame:
    """One row: files, total, smallest and largest size, files below the smallest allowed size, difference from the expected number."""
    return files.agg(F.count("*").alias("n"), F.sum(size).alias("total"), F.min(size).alias("smallest"), F.max(size).alias("largest"), F.count_if(F.col(size) < smallest).alias("undersized"), (F.count("*") - F.lit(expected)).alias("off"))


def upsert(current: DataFrame, staged: DataFrame, keys: Sequence[str]) -> DataFrame:
    """The snapshot after inserting new keys and updating those that exist once; keys that exist several times are reported and kept."""
    values = [c for c in current.columns if c not in keys]
    n = current.groupBy(*keys).agg(F.count("*").alias("__n"))
    new = staged.select(*keys, *[F.col(c).alias(f"__new_{c}") for c in values], F.lit(True).alias("__staged"))
    rows = current.join(n, list(keys)).join(new, list(keys), "full")
    update = F.coalesce("__staged", F.lit(False)) & (F.coalesce("__n", F.lit(1)) == 1)
    status = F.when(F.col("__n").isNull(), "inserted").when(~F.coalesce("__staged", F.lit(False)), "kept").when(F.col("__n") == 1, "updated").otherwise("many")
    return rows.select(*keys, *[F.when(update, F.col(f"__new_{c}")).otherwise(F.col(c)).alias(c) for c in values], status.alias("status"))


def update_where(table: DataFrame, condition: str, values: Mapping[str, object]) -> DataFrame:
    """The snapshot in which rows that meet a condition have new values."""
    return table.withColumns({c: F.when(F.expr(condition), F.lit(v)).otherwise(F.col(c)) for c, v in values.items()})


def delete_where(table: DataFrame, condition: str) -> DataFrame:
    """The snapshot without the rows that meet a condition; rows for which it is unknown stay."""
    return table.where(~F.coalesce(F.expr(condition), F.lit(False)))
