"""From raw documents to tokens: toxicity, near duplicates, repeated passages, source mixing, encoding.

STAGES are applied in this order; each is written as Parquet and read again as the next one's documents.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from cartoscope.functions.durable import durable
from cartoscope.llm.mixing import mixed_documents
from cartoscope.llm.partenum import keep_one
from cartoscope.llm.pieces import encode_decode
from cartoscope.llm.queries import model_file
from cartoscope.llm.recompression import drop_repeats
from cartoscope.llm.toxicity import drop_toxic


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose toxicity score is below 0.7."""
    return drop_toxic(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"), threshold=0.7)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group with a five-word-shingle Jaccard similarity of 0.8 or more: the smallest id."""
    return keep_one(docs, q=5, percent=80)


def substrings(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the passages of 50 words or more that a smaller id has too."""
    return drop_repeats(docs, width=50, chars_col="n_chars")


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the temperature mix of their sources asks for."""
    return mixed_documents(docs, target_entropy=0.95, max_repeats=4.0)


def encoding(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token counts and digests of ids and decoded text."""
    return encode_decode(docs, model_file(), digests=True)


STAGES = [("toxicity", toxicity), ("near duplicates", near_duplicates), ("substrings", substrings), ("mixing", mixing), ("encoding", encoding)]

#: The first stage is a fitted network, which SQL cannot express.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents of sf_dir."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for k, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if k < len(STAGES) - 1:
            docs = durable(docs, "stage")
    return docs
