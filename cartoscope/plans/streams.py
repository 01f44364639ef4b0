"""Queries on streams of files and on boosted-tree ensembles."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cartoscope import streaming as R
from cartoscope.operators import ensemble as E
from cartoscope.plans import tables as T
from cartoscope.plans.registry import Tables, query
from cartoscope.plans.sources import folder

EVENT = "event_id bigint, user_id bigint, event_type string, value double"


@query("SELECT event_type, count(*) AS n FROM events GROUP BY event_type")
def stream_new_sections(t: Tables) -> DataFrame:
    """Two arrivals of files; each is processed once."""
    src, out, mark = folder(t, "arrive"), folder(t, "out"), folder(t, "mark")
    rows = t.events.select("event_id", "user_id", "event_type", "value")
    for half in (0, 1):
        rows.where(F.col("event_id") % 2 == half).write.mode("append").parquet(src)
        done = R.new_rows(t.spark, src, EVENT, out, mark)
    return done.groupBy("event_type").agg(F.count("*").alias("n"))


@query("SELECT sha256(text) AS hash, 1::BIGINT AS n_first, count(*) - 1 AS n_duplicates, count(*) - 1 AS n_named FROM documents GROUP BY text")
def stream_dedupe_files(t: Tables) -> DataFrame:
    """Two arrivals of files; a duplicate is reported with the file that had its content first."""
    src, out, mark = folder(t, "files"), folder(t, "out"), folder(t, "mark")
    for half in (0, 1):
        t.documents.where(F.col("doc_id") % 2 == half).select("doc_id", "text").write.mode("append").parquet(src)
        rows = R.report_duplicates(t.spark, src, "doc_id bigint, text string", "text", "doc_id", out, mark)
    names = rows.where("first").select(F.col("hash").alias("h"), F.col("file").alias("f"))
    each = rows.join(names, F.col("hash").eqNullSafe(F.col("h")))
    return each.groupBy("hash").agg(F.count_if("first").alias("n_first"), F.count_if(~F.col("first")).alias("n_duplicates"), F.count_if(F.col("duplicate_of") == F.col("f")).alias("n_named"))


@query("SELECT user_id, CASE WHEN count(*) FILTER (event_id % 4 = 0) > 0 THEN 'processed' ELSE 'waiting' END AS status FROM events GROUP BY user_id")
def stream_progress(t: Tables) -> DataFrame:
    src = folder(t, "part")
    rows = t.events.select("event_id", "user_id", "event_type", "value")
    rows.where("event_id % 4 = 0").write.parquet(src)
    done = R.merge_status(t.spark, src, EVENT, "user_id", folder(t, "status"), folder(t, "mark"))
    return R.progress(rows, done, "user_id")


def training_rows(t: Tables) -> DataFrame:
    rows = T.detections(t).select("id", "x", "y", "area", "mean_score", "std_score", (F.col("predictions") == 2).cast("double").alias("label"))
    return rows.withColumn("mean_score", F.col("mean_score") + (F.col("x") % 7) / 10)


FEATURES = ["x", "y", "area", "mean_score", "std_score"]


@query()
def ml_train_ensemble(t: Tables) -> DataFrame:
    return E.describe(E.train(training_rows(t), FEATURES, "label", "id"))


@query()
def ml_score_ensemble(t: Tables) -> DataFrame:
    rows = training_rows(t)
    models = E.train(rows, FEATURES, "label", "id")
    return E.score(rows, FEATURES, models).select("id", F.round("mean_score", 6).alias("mean_score"), F.round("std_score", 6).alias("std_score"), "predictions")
