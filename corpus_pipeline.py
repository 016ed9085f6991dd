"""From raw documents to packed training sequences, in stages that each write their result.

Quality and toxicity drop whole documents, near duplicates leave one document of each group, repeated passages are cut
out of the documents that have them later, and packing lays what is left into sequences.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from stockyard.llm import near_duplicates, packing, passages, quality, toxicity
from stockyard.llm.common import shipped, written


def _labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/labels.parquet")


def good_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return quality.accepted(docs, _labels(spark, sf_dir))


def not_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return toxicity.accepted(docs, _labels(spark, sf_dir))


def one_of_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return near_duplicates.one_of_each(docs)


def without_repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return passages.without_repeats(docs)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sequences of the documents with words; those without (null or blank text), which earlier stages keep, go here."""
    return packing.sequences(packing.pack(docs))


STAGES = [
    ("quality", good_quality),
    ("toxicity", not_toxic),
    ("near duplicates", one_of_near_duplicates),
    ("repeated passages", without_repeated_passages),
    ("packing", packed),
]

#: models, signatures and packing cannot be put in SQL; tests hold the stages against plain versions
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages on the table ``documents``: one row per sequence, with the ids of the documents in it."""
    docs = shipped(spark).read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), f"pipeline-{name.replace(' ', '-')}")
    return STAGES[-1][1](spark, docs, sf_dir)
