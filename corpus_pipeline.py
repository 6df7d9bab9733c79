"""Corpus pipeline: from documents to packed training sequences.

``STAGES`` are applied in order, each to all rows its predecessor kept:

1. toxicity: documents scored as toxic go;
2. language ID: documents without a learned language go;
3. n-gram Jaccard join: one document of each group of near copies stays;
4. mixing sources to target weights: documents stay as often as the mix takes them;
5. best-fit packing: the pieces of the documents with their places in sequences.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tablekit.llm import langid, mixing, ngram_join, packing, toxicity
from tablekit.llm.common import table

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]

#: a document goes from this toxicity score on: op7's own threshold
TOXIC_FROM = toxicity.TOXIC_FROM
#: near copies: words in a shingle, similarity in percent
SHINGLE_WORDS, SIMILAR_PERCENT = 5, 80


def toxicity_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop documents whose toxicity score reaches TOXIC_FROM (trained on the table ``labels``)."""
    out = toxicity.toxicity_scores(docs, table(spark, sf_dir, "labels"), docs.columns, score="__toxicity")
    return out.filter(F.col("__toxicity") < TOXIC_FROM).select(docs.columns)


def language_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop documents in no learned language: NULL, empty, without letters, or too few n-grams in any filter."""
    out = langid.identified(docs, docs.columns, names=("__lang", "__score", "__learned"))
    return out.filter("__learned").select(docs.columns)


def near_copy_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep one document of each component of near copies."""
    return ngram_join.one_of_each(docs, SHINGLE_WORDS, SIMILAR_PERCENT, 100)


def mixing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep each document as often as the mix of sources takes it."""
    return mixing.mixed_documents(docs)


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pack the documents' token pieces into sequences."""
    return packing.pack_documents(docs)


STAGES: list[tuple[str, Stage]] = [
    ("toxicity", toxicity_stage),
    ("language ID", language_stage),
    ("n-gram Jaccard join", near_copy_stage),
    ("mixing sources to target weights", mixing_stage),
    ("best-fit packing", packing_stage),
]

#: the learned stages can't be expressed in SQL; tests hold run() against brute force
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the table ``documents``."""
    docs = table(spark, sf_dir, "documents")
    for _, stage in STAGES:
        docs = stage(spark, docs, sf_dir)
    return docs
