"""The corpus operators as queries over the test tables, with production parameters."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from setwise.llm import (
    bpe, exact_dedup, language, line_dedup, mixing, ngram_join, pii, quality, ranking, substrings, token_counts, warc, whitening,
)
from setwise.llm.common import load

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def query(fn: Query) -> Query:
    QUERIES[fn.__name__] = fn
    return fn


def vocabulary(name: str) -> str:
    """The place of a public tokenizer's file; the same on every machine."""
    import public_tokenizers

    return public_tokenizers.path(name)


@query
def op1_line_dedup(spark, sf):
    cut = line_dedup.without_repeated_lines(load(spark, sf, "documents"))
    return cut.select("doc_id", "n_lines", "n_removed", F.sha2("text", 256).alias("kept_sha256"))


@query
def op2_mix_sources(spark, sf):
    return mixing.mix(load(spark, sf, "documents"), load(spark, sf, "labels"))


@query
def op3_language_id(spark, sf):
    return language.identify(load(spark, sf, "documents"))


@query
def op4_quality_rules(spark, sf):
    return quality.judge(load(spark, sf, "documents"))


@query
def op5_token_counts(spark, sf):
    counted = token_counts.count_tokens(load(spark, sf, "documents"), vocabulary("piece_bpe_32k.model"))
    return counted.withColumn("over_limit", F.col("n_tokens") > 4096)


@query
def op6_bpe_round_trip(spark, sf):
    return bpe.encode(load(spark, sf, "documents"), vocabulary("word_bpe_49k.json"), form="digests")


@query
def op7_warc_round_trip(spark, sf):
    return warc.round_trip(load(spark, sf, "pages"))


@query
def op8_substring_dedup(spark, sf):
    cut = substrings.without_repeats(load(spark, sf, "documents"))
    return cut.select("doc_id", "n_words", "n_removed", F.sha2("text", 256).alias("kept_sha256"))


@query
def op9_exact_dedup(spark, sf):
    return exact_dedup.copies(load(spark, sf, "documents"))


@query
def op10_ngram_jaccard_join(spark, sf):
    return ngram_join.near_duplicates(load(spark, sf, "documents"))


@query
def op11_personal_data(spark, sf):
    found = pii.find_spans(load(spark, sf, "documents"))
    return found.select("doc_id", "n_email", "n_ip", "n_card", "n_phone", F.sha2("base", 256).alias("base_sha256"), "spans", "n_added")


@query
def op12_embedding_whitening(spark, sf):
    whitened = whitening.whiten(load(spark, sf, "embeddings"))
    # A deviation beyond 64 bits (some ten million rows on) is null here; the decimal has it.
    return whitened.withColumnRenamed("deviation", "exact_deviation").withColumn("deviation", F.expr("try_cast(exact_deviation AS BIGINT)"))


@query
def op13_ranked_search(spark, sf):
    return ranking.search(load(spark, sf, "documents"), load(spark, sf, "benchmark"))
