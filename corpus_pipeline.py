"""A training-data pipeline over ``documents``: stages that each apply one operator to what the stage before has kept."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from tilewright.llm import decontaminate, jaccard, packing, pii
from tilewright.llm.keys import own_id
from tilewright.llm.queries import pseudonym_key, quality_scores
from tilewright.sources.scratch import written
from tilewright.sources.shipping import shipped


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Without the documents that the quality classifier rejects. Rows with a null id are judged by their text; rows that share an
    id stay if one of them is accepted. Other columns, also those named like the scores', are kept."""
    keyed = docs.withColumn("_own", own_id())
    scores = quality_scores(keyed.select(F.col("_own").alias("doc_id"), "text"), spark.read.parquet(f"{sf_dir}/labels.parquet"))
    kept = scores.where("predicted = 1").select(F.col("doc_id").alias("_own")).distinct()
    return keyed.join(kept, "_own", "left_semi").select(docs.columns)


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies: five-word shingles, Jaccard similarity of 0.8 or more. Rows with a null
    id stay if no row with an id is in their group; null and empty texts are no copies."""
    return jaccard.one_of_each(docs, k=5, num=80, den=100).select(docs.columns)


def benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Without the documents that hold a benchmark item; rows with a null id are judged by their text."""
    return decontaminate.without_leaks(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet")).select(docs.columns)


def private(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """With pseudonyms for personal data; ``n_chars`` follows the text; all rows stay, null texts too."""
    return pii.pseudonymised(docs, pseudonym_key(spark)).withColumn("n_chars", F.length("text").cast("long")).select(docs.columns)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all rows, packed into sequences of 1024 tokens."""
    return packing.pack(docs, size=1024)


STAGES = [("quality", quality), ("near_copies", near_copies), ("benchmark", benchmark), ("private", private), ("pack", pack)]

#: The classifier, the groups and the packing are not expressible in SQL; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = shipped(spark).read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), name)
    return written(STAGES[-1][1](spark, docs, sf_dir), STAGES[-1][0])
