"""From raw documents to token ids: the corpus pipeline.

``STAGES`` lists the stages in order. Each takes (spark, docs, sf_dir) and
returns a frame that is written as Parquet and read again as the next
stage's ``docs``; all but the last return the columns of ``docs``."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from lectio.llm.bpe_automaton import encode_documents
from lectio.llm.common import byte_bpe_path, table, written
from lectio.llm.order_minhash import drop_near_copies
from lectio.llm.quality_ledger import keep_documents
from lectio.llm.radix_dedup import drop_copies
from lectio.llm.source_mix import mixed_documents


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the current quality policy keeps."""
    return keep_documents(docs)


def exact_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document with the largest id of each group of equal texts."""
    return drop_copies(docs)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document with the smallest id of each class of near copies."""
    return drop_near_copies(docs)


def source_mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix of sources takes them."""
    return mixed_documents(docs)


def bpe_tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids and digests of every document of the mix."""
    return encode_documents(docs, byte_bpe_path()).drop("decoded")


STAGES = [
    ("quality_rules", quality_rules),
    ("exact_dedup", exact_dedup),
    ("near_dedup", near_dedup),
    ("source_mix", source_mix),
    ("bpe_tokens", bpe_tokens),
]

#: No SQL: neither the near-duplicate classes nor BPE can be written in it.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
