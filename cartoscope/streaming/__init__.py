"""Incremental file processing with Structured Streaming."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cartoscope.functions.durable import remove


def new_rows(spark: SparkSession, source: str, schema: str, out: str, checkpoint: str) -> DataFrame:
    """Append what arrived under source since the last call to out, and return out. The checkpoint remembers processed files."""
    stream = spark.readStream.schema(schema).option("recursiveFileLookup", True).parquet(source)
    q = stream.writeStream.format("parquet").option("path", out).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    q.awaitTermination()
    return spark.read.schema(schema).parquet(out)


#: Days after which a content that did not come again is forgotten.
KEPT_DAYS = 365
REPORT = "hash string, file string, first boolean, duplicate_of string"


STATE = "hash string, file string, until long, born long"


def report_duplicates(spark: SparkSession, source: str, schema: str, content: str, file: str, out: str, checkpoint: str, keep_ms: int = KEPT_DAYS * 86_400_000) -> DataFrame:
    """What arrived under source since the last call, appended to out: hash, file, first, duplicate_of; returns out.

    first marks the first file of a content; the others are reported on arrival with the file that had it, however many calls, restarts or arrivals
    ago. State is one row a content and expires keep_ms after it last came. Of equal contents in one arrival that with the smallest name is the first.

    State is a table (hash, file, until, born: the batch) beside the checkpoint's own files. A batch merges what came into the table of the batch before
    it and writes its own, so a batch that is run again finds what it found the first time and replaces its own rows.
    """
    state = f"{checkpoint}/contents"
    rows = spark.readStream.schema(schema).parquet(source).select(F.sha2(content, 256).alias("hash"), F.col(file).cast("string").alias("file"), F.unix_millis(F.current_timestamp()).alias("at"))

    def put(batch: DataFrame, number: int) -> None:
        session = batch.sparkSession
        any_row = batch.select("at").first()
        now = any_row["at"] if any_row else 0  # the batch's own time, the same when it is run again; without rows nothing is new or forgotten
        counted = batch.groupBy("hash", "file").agg(F.count("*").alias("n")).persist()
        came = counted.groupBy(F.col("hash").alias("h")).agg(F.min("file").alias("least"), F.count("*").alias("names"))
        known = (session.read.schema(STATE).parquet(f"{state}/batch={number - 1}") if number else session.createDataFrame([], STATE)).where(F.col("until") >= now)
        new = F.col("until").isNull()
        after = known.join(came, F.col("hash").eqNullSafe(F.col("h")), "full_outer").select(
            F.when(new, F.col("h")).otherwise(F.col("hash")).alias("hash"),
            F.when(new, F.col("least")).otherwise(F.col("file")).alias("file"),
            F.when(F.col("names").isNull(), F.col("until")).otherwise(now + keep_ms).alias("until"),  # a content that comes again is kept from now on
            F.coalesce("born", F.lit(number)).cast("long").alias("born"),
        )
        after.write.mode("overwrite").parquet(f"{state}/batch={number}")
        of = session.read.schema(STATE).parquet(f"{state}/batch={number}").where(F.col("until") == now + keep_ms).select(F.col("hash").alias("h"), F.col("file").alias("least"), "born")
        each = counted.join(of, F.col("hash").eqNullSafe(F.col("h"))).withColumn("k", F.explode(F.expr("sequence(1L, n)")))
        first = (F.col("born") == number) & F.col("file").eqNullSafe(F.col("least")) & (F.col("k") == 1)
        each.select("hash", "file", first.alias("first"), F.when(~first, F.col("least")).alias("duplicate_of")).write.mode("overwrite").parquet(f"{out}/batch={number}")
        counted.unpersist()
        remove(session, f"{state}/batch={number - 2}")

    rows.writeStream.foreachBatch(put).option("checkpointLocation", checkpoint).trigger(availableNow=True).start().awaitTermination()
    return spark.read.schema(f"{REPORT}, batch long").parquet(out).select("hash", "file", "first", "duplicate_of")


def progress(arrived: DataFrame, processed: DataFrame, key: str) -> DataFrame:
    """Status of every key that arrived: processed or waiting."""
    done = processed.select(F.col(key).alias("__k")).distinct()
    rows = arrived.select(key).distinct().join(done, F.col(key) == F.col("__k"), "left")
    return rows.select(key, F.when(F.col("__k").isNull(), "waiting").otherwise("processed").alias("status"))


def merge_status(spark: SparkSession, source: str, schema: str, key: str, status: str, checkpoint: str) -> DataFrame:
    """Per batch the counts of each key are appended to a status table (batch, key, n); a replayed batch replaces its own rows."""

    def put(batch: DataFrame, number: int) -> None:
        batch.groupBy(key).agg(F.count("*").alias("n")).write.mode("overwrite").parquet(f"{status}/batch={number}")

    q = spark.readStream.schema(schema).parquet(source).writeStream.foreachBatch(put).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    q.awaitTermination()
    return spark.read.parquet(status)
