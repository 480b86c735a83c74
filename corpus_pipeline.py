"""Corpus pipeline: quality rules, near-duplicates, benchmark passages, source mixing, token shards.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; it is written as Parquet and read again as the next one's docs.
Every stage takes any columns besides doc_id, text and source, whatever their names; all but the last pass them on.  A null
doc_id is a document without an id, not an error; rows that share an id are documents of their own, told apart by their text.  An
empty table goes through all stages and gives no rows.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

from mlframe.llm import decontam, mixing, quality, simhash, tokens
from mlframe.llm.common import table
from mlframe.runtime import scratch_dir


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality rules reject go; texts of the others lose the lines that too many texts of their source share.

    Null and empty texts have no words and are rejected; a null source is a source.  Repeated rows are judged alike.
    """
    return quality.keep_good(docs)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of linked fingerprints the document with the smallest id stays, exactly one row.

    Of rows that share that id the text with the smallest hash stays; a row without an id only where its group has none.  Null and empty
    texts are one group.
    """
    return simhash.keep_one(docs)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a passage of the benchmark go; each row by its own text, so a clean row stays beside a dirty one of the same id.

    Null and empty texts, and all texts where the benchmark is empty, stay.
    """
    return decontam.clean(docs, table(spark, sf_dir, "benchmark"))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The mix in training order; a document is repeated as often as the mix takes it.

    Documents without words are taken 0 times; a null source is the last source; rows without an id share one place in the order.
    """
    return mixing.curriculum(docs)


def token_shards(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token shards of the mix, read back: one row per document copy, null ids first, copies of one id in the order of their texts' hashes.

    Null and empty texts hold the end id only.
    """
    return tokens.query(docs)


STAGES = [("quality_rules", quality_rules), ("simhash_near_dedup", near_dedup), ("decontamination", decontaminate),
          ("source_mixing", mix_sources), ("token_shards", token_shards)]

# The tokenizer cannot be written in SQL; tests hold the pipeline against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over documents; each stage's table lies in the shared folder."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        path = f"{scratch_dir(spark).rstrip('/')}/pipeline-{name}-{uuid.uuid4().hex}"
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
