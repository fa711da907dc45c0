"""A corpus pipeline: language, exact copies, near copies, mixing, tokens.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame, which is written as Parquet
and read again as the documents of the next one. Extra columns of the documents stay until the
last stage, whatever their names; an empty table goes through all stages.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from setwise.llm import bpe, exact_dedup, language, mixing, ngram_join
from setwise.llm.common import load, scratch, store
from setwise.llm.queries import vocabulary


def known_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language can be told. Null texts and texts without a letter go; rows
    that repeat an id are judged one by one."""
    return language.in_a_known_language(docs)


def no_exact_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of equal texts: the row with the largest id, a null id being
    the smallest, and one of the rows that repeat both."""
    return exact_dedup.without_copies(docs)


def no_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of similar texts: the row with the smallest id, a null id
    being the largest, and one of the rows that repeat it. Texts without words stay."""
    return ngram_join.without_near_duplicates(docs)


def mixed_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as the mix of sources takes it. A null source is one too; a text
    without words counts nothing and is taken like others of its draw."""
    return mixing.mixed_documents(docs, load(spark, sf_dir, "labels"))


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Number of tokens of each document, and digests of its ids and of their decoding. A null
    text counts as empty and has no tokens."""
    # Executors that ran all the other stages before have less memory left than fresh ones.
    return bpe.encode(docs, vocabulary("word_bpe_49k.json"), form="digests", remember=1 << 17)


STAGES = [
    ("language ID", known_language),
    ("exact dedup", no_exact_copies),
    ("near duplicates", no_near_copies),
    ("mixing sources", mixed_sources),
    ("BPE encoding", tokens),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = load(spark, sf_dir, "documents")
    for name, stage in STAGES:
        with scratch(spark):
            docs = store(stage(spark, docs, sf_dir), name.replace(" ", "_"), keep=True)
    return docs


QUERIES = {"pipeline": run}
ORACLE_SQL = None
"""Learned models and tokens cannot be told in SQL; tests compare with a plain version."""
ORACLES: dict[str, str] = {}
