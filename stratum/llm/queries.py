"""The queries of this subpackage, by name; each takes (spark, sf_dir)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stratum.session import scratch_path

from . import bpe_documents, chat, collocations, exact_dedup, line_blocks, ngram_join, packing, repair, sharding, token_counts, token_files, toxicity, vptree
from .common import table


def tokenizer(name: str) -> str:
    """A public tokenizer file's place on this machine."""
    import public_tokenizers

    return public_tokenizers.path(name)


def op1_vp_trees(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vptree.nearest(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 20 == 0)


def op2_noisy_channel_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.score(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op3_prefix_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts.totals(table(spark, sf_dir, "documents"), tokenizer("byte_bpe_50k.json"))


def op4_bayes_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_join.links(table(spark, sf_dir, "documents"))


def op5_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.exact_dedup(table(spark, sf_dir, "documents"))


def op6_prefix_targets(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    said = "</s>[INST] ok [/INST]"
    extra = spark.range(1).selectExpr("inline(array(struct(-1L, 0L, 'user', t), struct(-1L, 1L, 'assistant', t)))".replace("t)", f"'{said}')"))
    return chat.digests(turns.unionByName(extra.toDF("conv_id", "turn", "role", "text")))


def op7_bpe_automaton(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe_documents.digests(table(spark, sf_dir, "documents"), tokenizer("word_bpe_49k.json"))


def op8_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.layout(table(spark, sf_dir, "documents"), tokenizer("word_bpe_49k.json"))


def op9_fuzzy_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_blocks.fuzzy_lines(table(spark, sf_dir, "documents"))


def op10_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_files.round_trip(table(spark, sf_dir, "documents"), tokenizer("word_bpe_49k.json"))


def op11_jump_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.digests(table(spark, sf_dir, "documents"), scratch_path(spark, "shards"), 16)


def op12_era_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations.collocations(table(spark, sf_dir, "documents"))


def op13_audit_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repair.digests(table(spark, sf_dir, "conversations"))


QUERIES = {
    f.__name__: f
    for f in (
        op1_vp_trees, op2_noisy_channel_toxicity, op3_prefix_counts, op4_bayes_ngram_join, op5_exact_dedup, op6_prefix_targets, op7_bpe_automaton,
        op8_packing, op9_fuzzy_lines, op10_token_files, op11_jump_shards, op12_era_collocations, op13_audit_repair,
    )
}
