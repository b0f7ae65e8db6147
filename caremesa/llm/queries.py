"""The registered queries of the corpus operators: each applies one to its whole table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

import corpus_pipeline
from caremesa.llm import bpe, fim, htmltext, licenses, packing, pii, quality, sharding, simhash, topk, toxicity, variants, warc
from caremesa.llm.common import table


def op1_sharding(spark: SparkSession, folder: str) -> DataFrame:
    return sharding.shard(table(spark, folder, "documents"))


def op2_license_scan(spark: SparkSession, folder: str) -> DataFrame:
    return licenses.scan(table(spark, folder, "documents"))


def op3_byte_bpe(spark: SparkSession, folder: str) -> DataFrame:
    return bpe.encode(table(spark, folder, "documents"))


def op4_warc(spark: SparkSession, folder: str) -> DataFrame:
    return warc.archive(table(spark, folder, "pages"))


def op5_simhash(spark: SparkSession, folder: str) -> DataFrame:
    return simhash.near_duplicates(table(spark, folder, "documents"))


def op6_topk_search(spark: SparkSession, folder: str) -> DataFrame:
    return topk.search(table(spark, folder, "embeddings"))


def op7_toxicity(spark: SparkSession, folder: str) -> DataFrame:
    return toxicity.score(table(spark, folder, "documents"), table(spark, folder, "labels"))


def op8_html_text(spark: SparkSession, folder: str) -> DataFrame:
    return htmltext.extract(table(spark, folder, "pages"))


def op9_quality_rules(spark: SparkSession, folder: str) -> DataFrame:
    return quality.judge(table(spark, folder, "documents"))


def op10_packing(spark: SparkSession, folder: str) -> DataFrame:
    return packing.pack(table(spark, folder, "documents"))


def op11_personal_data(spark: SparkSession, folder: str) -> DataFrame:
    return pii.digests(table(spark, folder, "documents"))


def op12_spelling_variants(spark: SparkSession, folder: str) -> DataFrame:
    return variants.group(table(spark, folder, "documents"), slips=97)


def op13_fill_in_middle(spark: SparkSession, folder: str) -> DataFrame:
    return fim.digests(table(spark, folder, "documents"))


QUERIES = {query.__name__: query for query in (
    op1_sharding, op2_license_scan, op3_byte_bpe, op4_warc, op5_simhash, op6_topk_search, op7_toxicity, op8_html_text, op9_quality_rules, op10_packing, op11_personal_data, op12_spelling_variants, op13_fill_in_middle,
)} | {"pipeline": corpus_pipeline.run}

ORACLE_SQL: dict[str, str] = {"op4_warc": warc.ORACLE, "op6_topk_search": topk.ORACLE, "op12_spelling_variants": variants.ORACLE, "op13_fill_in_middle": fim.ORACLE}
