"""The corpus pipeline: documents to packed sequences, in five stages.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame that is written
as Parquet and read again as the next stage's docs. All but the last return the
columns of documents.

Defined cases: null and empty texts, and texts without a letter, go in the first
stage; null doc_ids, other null columns and further columns stay; repeated rows
lose the same lines and one of them stays as the first of its class; an empty
documents table gives empty results, an empty benchmark removes nothing.

The first stage sets the session's Arrow batches to TEXT_ROWS rows: its result is
computed after it returns, and an executor holds whole texts several times.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tripmart.llm import decontam, lang_id, line_dedup, near_dup, packing
from tripmart.llm.common import ARROW_ROWS, TEXT_ROWS, table, written

#: Words that a packing worker remembers; the executors' heap is full by then.
PACK_WORDS = 150_000


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a language (no text, no letter) go."""
    if not 0 < int(spark.conf.get(ARROW_ROWS)) <= TEXT_ROWS:
        spark.conf.set(ARROW_ROWS, str(TEXT_ROWS))
    return lang_id.keep_identified(docs)


def lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Lines similar to an earlier line go; documents left without a line go."""
    return line_dedup.dedup_lines(docs)


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each near-duplicate class stays, the first."""
    return near_dup.keep_first(docs)


def clean_of_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a benchmark item go."""
    return decontam.keep_clean(docs, table(spark, sf_dir, "benchmark"))


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of the documents left, with their ids and their places in the
    sequences: what ``packing.sequences`` joins and pads."""
    return packing.pack_documents(docs, most_words=PACK_WORDS)


STAGES = [
    ("language_id", language),
    ("line_dedup", lines),
    ("near_dup", near_copies),
    ("decontaminate", clean_of_benchmark),
    ("packing", packed),
]

#: Language ID and the decontamination learn from the corpus, the near-duplicate
#: stage hashes, packing runs a tokenizer: SQL expresses none of these stages.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), f"stage-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
