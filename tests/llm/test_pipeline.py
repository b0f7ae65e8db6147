import duckdb
import pytest
from cases import documents, rows

import corpus_pipeline
from caremesa.llm import packing, quality, queries, simhash, toxicity
from caremesa.llm.common import settle

FOLDER = "/root/testdata/sf0.001"


def test_stages_decide_as_their_operators(spark):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    labels = spark.read.parquet(f"{FOLDER}/labels.parquet")
    names = docs.columns
    ids = lambda frame: sorted(row["doc_id"] for row in frame.collect())
    quality_stage, toxicity_stage, duplicate_stage, packing_stage = (stage for _, stage in corpus_pipeline.STAGES)
    first = settle(quality_stage(spark, docs, FOLDER))
    assert first.columns == names and ids(first) == ids(quality.judge(docs).where("kept"))
    second = settle(toxicity_stage(spark, first, FOLDER))
    assert second.columns == names and ids(second) == ids(toxicity.score(first, labels).where("predicted = 0"))
    third = settle(duplicate_stage(spark, second, FOLDER))
    found = simhash.near_duplicates(second).collect()
    assert third.columns == names and ids(third) == sorted({row["component_id"] for row in found})
    last = packing_stage(spark, third, FOLDER)
    columns = ["doc_id", "piece", "start", "length", "ids_crc32"]
    assert rows(last, *columns) == rows(packing.pieces(third), *columns)
    assert rows(corpus_pipeline.run(spark, FOLDER), *last.columns) == rows(last, *last.columns)


def test_stages_take_an_empty_table(spark):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet").limit(0)
    for _, stage in corpus_pipeline.STAGES:
        docs = settle(stage(spark, docs, FOLDER))
    assert docs.count() == 0


def test_stages_take_awkward_rows(spark):
    """Nulls, empty and long texts, repeated rows, and columns with the names of results and of helpers."""
    docs = documents(spark).selectExpr("*", "length(text) as n_chars", "1 as _score", "2 as _k1", "3 as _fp", "4 as _row", "5 as _stats", "6 as n_words", "7 as toxic")
    columns = docs.columns
    given = {(row["doc_id"], row["text"]) for row in docs.collect()}
    docs = settle(docs)
    for _, stage in corpus_pipeline.STAGES[:-1]:
        docs = settle(stage(spark, docs, FOLDER))
        assert docs.columns == columns
        assert {(row["doc_id"], row["text"]) for row in docs.collect()} <= given
        assert {row["kept"] for row in docs.collect()} <= {"clash"} and {row["_score"] for row in docs.collect()} <= {1}
    kept = [row["doc_id"] for row in docs.collect()]
    assert 1 in kept and kept.count(1) == 1 and 5 not in kept and 3 not in kept  # long, but repeated words; null text
    packed = corpus_pipeline.STAGES[-1][1](spark, docs, FOLDER)
    assert {row["doc_id"] for row in packed.collect()} == set(kept)


@pytest.mark.parametrize("name", sorted(queries.ORACLE_SQL))
def test_query_equals_sql(spark, name):
    duck = duckdb.connect()
    for table in ("documents", "embeddings", "pages"):
        duck.execute(f"create view {table} as select * from '{FOLDER}/{table}.parquet'")
    result = duck.execute(queries.ORACLE_SQL[name])
    names = [column[0] for column in result.description]
    found = queries.QUERIES[name](spark, FOLDER)
    assert sorted(found.columns) == sorted(names)
    assert sorted(map(str, map(tuple, found.select(*names).collect()))) == sorted(map(str, result.fetchall()))


def test_one_query_for_each_operator():
    assert [sum(key.startswith(f"op{n}_") for key in queries.QUERIES) for n in range(1, 14)] == [1] * 13
    assert "pipeline" in queries.QUERIES
