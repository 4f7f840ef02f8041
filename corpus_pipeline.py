"""A corpus pipeline: each stage works on what the one before it kept.

Stages take (spark, docs, sf_dir) and return a DataFrame, which is written as Parquet and read again for the
next stage. All but the last return the columns of the documents.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from marketlake.llm import chaining, language, packing, setsketch
from marketlake.llm.book import tokenizer_file
from marketlake.session import stored

LEAST_LANGUAGE_SCORE = 0.2  # texts in a known language score above 0.4, signs and foreign scripts near 0


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in a language that their corpus teaches; texts without letters and unlike any language go."""
    return language.identified(docs, LEAST_LANGUAGE_SCORE)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document, that of the smallest id, of each group of near copies."""
    return setsketch.without_near_duplicates(docs)


def cut_repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents without the passages that an earlier document holds."""
    return chaining.without_passages(docs, chaining.passages(docs))


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of the documents that are left, with their sequences."""
    return packing.pack_documents(docs, tokenizer_file("word_bpe_49k.json"))


STAGES = [
    ("language identification", identify_language),
    ("near-duplicate removal", drop_near_copies),
    ("repeated passages", cut_repeated_passages),
    ("best-fit packing", pack_sequences),
]

ORACLE_SQL = None  # no stage can be expressed in SQL; see tests/llm


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents of a folder."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for number, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if number + 1 < len(STAGES):
            docs = stored(docs, name.replace(" ", "-"))
    return docs
