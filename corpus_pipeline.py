"""A corpus pipeline over ``documents``: five stages, each one operator of ``pricemart.llm``.

1. quality classifier: documents that score below 0.3 go;
2. n-gram Jaccard join: one document of each class stays (5-word shingles, similarity 0.8);
3. benchmark decontamination: documents with a 10-word window of a benchmark item go;
4. mixing: sources by weights 3, 1, 2, 150 % of all words, a document at most twice;
5. token files: ids in Arrow stream files, read back as one row per document.

Every stage takes (spark, docs, sf_dir) and returns a DataFrame; ``run`` writes it as Parquet below the shared checkpoint
folder and reads it again for the next stage.  All but the last return the columns of ``documents``.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from pricemart.llm import decontam, mix, ngram_join, quality, token_files
from pricemart.llm.common import configure, staged, table

TOKENIZER = public_tokenizers.path("word_bpe_49k.json")


def good(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    configure(spark)
    return quality.keep_good(docs, table(spark, sf_dir, "labels"), learn=~quality.held_out())


def distinct(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    configure(spark)
    return ngram_join.keep_one(docs)


def clean(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    configure(spark)
    return decontam.decontaminate(docs, table(spark, sf_dir, "benchmark"), remove="document")


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    configure(spark)
    return mix.mix(docs, weights=(3, 1, 2), share=1.5, max_epochs=2.0)


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    configure(spark)
    return token_files.report(docs, TOKENIZER)


STAGES = [("quality", good), ("near_duplicates", distinct), ("decontamination", clean), ("mix", mixed), ("token_files", tokens)]

#: the classifier's network has no SQL
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The pipeline's last stage over all documents."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = staged(spark, stage(spark, docs, sf_dir), f"stage-{name}")
    return docs
