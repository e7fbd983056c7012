"""Corpus cleaning as stages over whole tables; each stage's rows are written and read again.

The first four stages return the columns of documents for the rows they keep, the
last one the digests of each kept document's tokens:

1. language ID: drops documents without an identified language;
2. quality classifier: drops documents scored below the threshold;
3. SimHash near-dedup: keeps the smallest doc_id of each component;
4. benchmark decontamination: drops documents that hold a benchmark window;
5. BPE: tokens and decoded text of each document, as digests.

Every stage learns from what its predecessor kept.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from tallyhour.llm import bpe, langid, phrase_index, quality_crf, simhash
from tallyhour.llm.common import scratch, table
from tallyhour.llm.entry_queries import vocabulary

#: Least share of a text's windows that its language's filter must know.
MIN_EVIDENCE = 0.15


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return langid.keep_identified(docs, langid.fit(docs), MIN_EVIDENCE)


def keep_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    chain = quality_crf.fit(docs, table(spark, sf_dir, "labels"))
    return quality_crf.keep_good(docs, chain, quality_crf.THRESHOLD)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return simhash.keep_one(docs)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return phrase_index.drop_contaminated(docs, table(spark, sf_dir, "benchmark"))


def encode_bpe(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return bpe.round_trip(docs, vocabulary("byte_bpe_50k.json"))


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("language ID", identify_language),
    ("quality classifier", keep_quality),
    ("SimHash near-dedup", drop_near_duplicates),
    ("benchmark decontamination", decontaminate),
    ("BPE encoding and decoding", encode_bpe),
]

#: The stages learn models, compute XXH64 majorities and merge token pairs: not SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; the rows of the last stage."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        path = scratch(spark, "pipeline-" + name.lower().replace(" ", "-"))
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
