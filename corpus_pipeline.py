"""A cleaning pipeline over ``documents``: toxicity, exact dedup, n-gram join, packing.

Each stage takes (spark, docs, sf_dir), works on all rows that the stage before it kept, and returns
the columns of documents; the last returns the pieces of packed sequences.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from stratum.llm import exact_dedup, ngram_join, packing, toxicity
from stratum.llm.common import table
from stratum.llm.queries import tokenizer
from stratum.session import cut_lineage


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the toxicity score accepts."""
    return toxicity.without_toxic(docs, table(spark, sf_dir, "labels"))


def drop_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of documents with equal texts, the one with the smallest doc_id."""
    return exact_dedup.without_copies(docs)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each class of similar documents, the one with the smallest doc_id."""
    return ngram_join.one_of_each(docs)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of the packed sequences of all documents."""
    return packing.layout(docs, tokenizer("word_bpe_49k.json"))


STAGES = [("toxicity", drop_toxic), ("exact dedup", drop_copies), ("n-gram join", drop_near_copies), ("packing", pack)]

#: SQL cannot express scores, near duplicates or ids; the stages are tested against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages on ``documents``, each one's result written and read again."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = cut_lineage(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
