"""From raw documents to packed training sequences, one operator of ``caremesa.llm`` for each stage.

All stages take documents with null ids, texts, languages and sources, empty and very long
texts, repeated rows, no rows at all, and further columns of any name; what becomes of each stands
below. All but the last return the columns they were given, as they were.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from caremesa.llm import packing, quality, simhash, toxicity
from caremesa.llm.common import ready, settle, table


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that fail a base rule or are outliers of their language and source go.

    Null and empty texts go, as they have too few words; equal texts of one language and
    source go or stay together.
    """
    ready(spark)
    return quality.keep(docs)


def toxicity_filter(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that score as toxic go.

    A null or empty text stays; equal texts go or stay together. A null doc_id has no label.
    """
    return toxicity.keep(docs, table(spark, sf_dir, "labels"))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates stays, the one with the smallest doc_id.

    A null doc_id is larger than any other. Equal rows count once; of different rows that
    share the smallest doc_id one stays. Texts without words are one group.
    """
    return simhash.keep_one(docs)


def best_fit_packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """What is left goes into sequences; one row for each token piece.

    A null or empty text has one piece, the end mark alone; long texts have several. Repeated
    rows get places of their own. Other columns than doc_id and text end here.
    """
    return packing.pack(docs)


STAGES = [
    ("quality_rules", quality_rules),
    ("toxicity_filter", toxicity_filter),
    ("near_duplicates", near_duplicates),
    ("best_fit_packing", best_fit_packing),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each is written as Parquet to the shared folder and read again."""
    docs = table(spark, sf_dir, "documents")
    for _, stage in STAGES:
        docs = settle(stage(spark, docs, sf_dir))
    return docs


#: SQL expresses none of the model-based stages; tests hold them against brute force.
ORACLE_SQL = None
