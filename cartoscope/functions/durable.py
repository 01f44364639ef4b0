"""Cut lineage with tables in the folder that the cluster shares (spark.checkpoint.dir)."""

from __future__ import annotations

import re
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def shared_dir(spark: SparkSession) -> str:
    """The folder of spark.checkpoint.dir. Where none is named, one process (a local master) gets a temporary one; a cluster is refused."""
    found = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if not found:
        if not re.fullmatch(r"local(\[[^]]*\])?", spark.sparkContext.master):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        found = f"file://{tempfile.mkdtemp(prefix='cartoscope-')}"
        spark.conf.set("spark.checkpoint.dir", found)
    return found.rstrip("/")


def durable(df: DataFrame, label: str = "t") -> DataFrame:
    """Write df once to the shared folder and return the table that reads it back.

    A lost executor costs no recomputation beyond the current stage, and the plan of the
    result is a plain scan. The path is kept on the result for release().
    """
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/{label}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    out = spark.read.schema(df.schema).parquet(path)
    out._durable_path = path
    return out


def together(tables: list[DataFrame]) -> DataFrame:
    """One scan over several durable() tables of one schema, however many there are."""
    return tables[0].sparkSession.read.schema(tables[0].schema).parquet(*[t._durable_path for t in tables])


def release(df: DataFrame | None) -> None:
    """Delete the files of a durable() table that no later step reads."""
    path = getattr(df, "_durable_path", None)
    if path is None:
        return
    remove(df.sparkSession, path)


def remove(spark: SparkSession, path: str) -> None:
    """Delete a folder of any file system, if it is there."""
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    where.getFileSystem(spark._jsc.hadoopConfiguration()).delete(where, True)
