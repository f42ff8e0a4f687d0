"""From raw documents to packed training sequences.

Each stage takes ``(spark, docs, sf_dir)``; its result is written as Parquet and read again as the
next stage's ``docs``.  All stages but the last return the columns of ``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from entityloom.llm import decontaminate, language, packing, personal, simhash
from entityloom.llm.components import written
from entityloom.llm.queries import table, tokenizer_file
from entityloom.llm.shipping import ship


def in_known_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in some language: those without a letter go."""
    ship(spark)
    return language.keep_identified(docs)


def one_of_each_group(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies: the one with the smallest id."""
    return simhash.keep_first(docs, shingle=3, max_bits=3)


def without_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no passages of the benchmark, or hardly any."""
    return decontaminate.clean(docs, table(spark, sf_dir, "benchmark"))


def without_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, personal data masked."""
    return personal.mask_personal(docs, length="n_chars")


def in_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all documents in sequences."""
    return packing.pack_documents(docs, tokenizer_file())


STAGES = [
    ("language", in_known_language),
    ("simhash", one_of_each_group),
    ("decontamination", without_benchmark),
    ("personal", without_personal_data),
    ("packing", in_sequences),
]

# No stage but decontamination can be said in SQL: networks, 64-bit hashes and tokenizers.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = written(stage(spark, docs, sf_dir), f"stage-{name}")
    return docs
