"""The registered queries of the training-data operators, and their SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tripmart.llm import (conv_trie, decontam, lang_id, line_dedup, lm_score, merkle, near_dup, neighbours, packing, quality,
                          substrings, toxicity, url_filter)
from tripmart.llm.common import table


def op9_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lang_id.identify(table(spark, sf_dir, "documents"))


def op7_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_dedup.count_lines(table(spark, sf_dir, "documents"))


def op1_near_dup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per document: doc_id, class_id, n_links, class_size, kept."""
    docs = table(spark, sf_dir, "documents")
    classes = near_dup.classify(docs)
    return classes.select("doc_id", "class_id", "n_links", "class_size", F.col("leads").alias("kept"))


def op2_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.judge(table(spark, sf_dir, "documents"))


def op3_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_filter.judge_urls(table(spark, sf_dir, "pages"), url_filter.default_rules(spark))


def op4_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.assess(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op5_repeated_substrings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substrings.digest(table(spark, sf_dir, "documents"))


def op6_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The documents that hold a benchmark item: doc_id, item_id and the scores."""
    return decontam.contaminated(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op8_lm_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lm_score.score_documents(table(spark, sf_dir, "documents"))


def op10_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The places of the pieces, with the checksum of their ids for the ids."""
    return packing.pack_documents(table(spark, sf_dir, "documents")).drop("ids")


def op11_nearest_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 20 nearest of every vector whose id is divisible by 20: query_id, rank,
    vec_id, score."""
    return neighbours.nearest(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 20 == 0, 20)


def op12_conversation_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The nodes of the trie of the rebuilt conversations."""
    return conv_trie.trie(table(spark, sf_dir, "conversations"), rebuilt=True).drop("last_words")


def op13_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document proved against the manifest, a fifth of them after tampering."""
    return merkle.audit(table(spark, sf_dir, "documents"))


REGISTRY = {
    "op1_near_dup": op1_near_dup,
    "op2_quality_rules": op2_quality_rules,
    "op3_url_filter": op3_url_filter,
    "op4_toxicity": op4_toxicity,
    "op5_repeated_substrings": op5_repeated_substrings,
    "op6_decontaminate": op6_decontaminate,
    "op7_line_dedup": op7_line_dedup,
    "op8_lm_score": op8_lm_score,
    "op9_language_id": op9_language_id,
    "op10_packing": op10_packing,
    "op11_nearest_neighbours": op11_nearest_neighbours,
    "op12_conversation_trie": op12_conversation_trie,
    "op13_merkle_manifest": op13_merkle_manifest,
}

#: Queries that SQL can express.
ORACLE_SQL: dict[str, str] = {"op3_url_filter": url_filter.ORACLE_SQL}
