"""The queries of the training-data operators, with production parameters over whole tables, and their SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from pricemart.llm import (decontam, host_rules, line_dedup, mix, ngram_join, packing, periodic_runs, quality, revisits, suffix_dedup,
                           token_files, toxicity, whitening)
from pricemart.llm.common import configure, table


def op1_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The words that a mix of all sources takes of every document."""
    configure(spark)
    return mix.report(table(spark, sf_dir, "documents"), weights=(3, 1, 2), share=1.5, max_epochs=2.0)


def op2_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The quality score of every document."""
    configure(spark)
    return quality.report(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op3_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Class and number of links of every document, at a Jaccard similarity of 0.8 of 5-word shingles."""
    configure(spark)
    return ngram_join.report(table(spark, sf_dir, "documents"))


def op4_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Hits of the benchmark's 10-word windows in every document."""
    configure(spark)
    return decontam.report(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op5_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The toxicity score of every document."""
    configure(spark)
    return toxicity.report(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op6_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Passages of at least 50 words that are in the corpus twice or more, by document."""
    configure(spark)
    return suffix_dedup.report(table(spark, sf_dir, "documents"))


def op7_host_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rule counts and verdicts of every document; its source is its host."""
    configure(spark)
    return host_rules.report(table(spark, sf_dir, "documents"))


def op8_revisits(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Revisit records over captures rendered from every page, resolved."""
    configure(spark)
    return revisits.report(table(spark, sf_dir, "pages"))


def op9_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's ids, written to Arrow stream files and read back."""
    import public_tokenizers

    configure(spark)
    return token_files.report(table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"))


def op10_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines that at least 10 documents share go from every document."""
    configure(spark)
    return line_dedup.report(table(spark, sf_dir, "documents"), min_docs=10, min_chars=1)


def op11_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every vector on the components of all vectors' covariance, with unit variance."""
    configure(spark)
    return whitening.report(table(spark, sf_dir, "embeddings"))


def op12_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Periodic runs of words in every document, and the digest of what is left without repetitions."""
    configure(spark)
    return periodic_runs.report(table(spark, sf_dir, "documents"))


def op13_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents in sequences of 2,048 tokens, each window by the sources' shares: the pieces."""
    import public_tokenizers

    configure(spark)
    return packing.report(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"))


QUERIES = {f.__name__: f for f in (
    op1_mix_sources, op2_quality, op3_ngram_join, op4_decontaminate, op5_toxicity, op6_suffix_dedup, op7_host_rules, op8_revisits,
    op9_token_files, op10_line_dedup, op11_whitening, op12_periodic_runs, op13_packing)}
