"""From raw documents to packed training sequences, stage by stage."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from labelloop.llm import curriculum, ngram_join, packing, quality_trees, toxicity
from labelloop.llm.common import stored, table
from labelloop.llm.queries import tokenizer_path
from labelloop.session import share_code


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier accepts."""
    return quality_trees.accepted(docs, table(spark, sf_dir, "labels"))


def toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the toxicity classifier does not reject."""
    return toxicity.accepted(docs, table(spark, sf_dir, "labels"))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each class of similar texts."""
    share_code(spark)
    return ngram_join.one_of_each(docs)


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in training order, each as often as its source's target has it read."""
    return curriculum.training_order(docs)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of documents at their places in training sequences."""
    share_code(spark)
    return packing.pack(docs, tokenizer_path())


STAGES = [("quality", quality), ("toxicity", toxic), ("near duplicates", near_duplicates), ("mixing", mixing), ("packing", packed)]

#: Trained models and a tokenizer decide: no SQL expresses the stages.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents, each written and read again for the next."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
