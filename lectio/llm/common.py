"""Helpers shared by the operators."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lectio.session import scratch_path

#: A word, for Java's and RE2's engines: a run without ASCII white space.
WORD_RE = r"[^\x20\x09-\x0D]+"


def written(df: DataFrame, name: str) -> DataFrame:
    """``df`` written once to the shared scratch folder and read back:
    cuts lineage, fixes generated row numbers and survives lost executors."""
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def table(spark: SparkSession, base: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{base.rstrip('/')}/{name}.parquet")


def n_words(text: Column) -> Column:
    """Number of words of a text; null has none."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD_RE)), F.lit(0)).cast("long")


def new_name(df: DataFrame, stem: str) -> str:
    """A column name that ``df`` does not have (case-insensitively)."""
    have, name = {c.lower() for c in df.columns}, stem
    while name.lower() in have:
        name += "_"
    return name


def byte_bpe_path() -> str:
    """The byte-level BPE file of the installed public tokenizers."""
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")
