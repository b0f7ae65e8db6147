import zlib
from collections import Counter

import pytest
from cases import DOCUMENTS, documents
from pyspark.sql import functions as F

from caremesa.llm import sharding
from caremesa.llm.common import each_copy, numbered


@pytest.mark.parametrize("n", [1, 2, 3, 5, 7, 24, 100, 4097])
def test_permutation_is_one_to_one(spark, n):
    places = spark.range(n).select(sharding.permuted(F.col("id"), F.lit(n).cast("bigint")).alias("p")).collect()
    assert sorted(row["p"] for row in places) == list(range(n))


def test_permutation_depends_on_the_seed(spark):
    one, other = (
        [row["p"] for row in spark.range(50).select(sharding.permuted(F.col("id"), F.lit(50).cast("bigint"), seed).alias("p")).collect()]
        for seed in (1, 2)
    )
    assert one != other and one != list(range(50))


def test_shards_are_even_gapless_and_repeatable(spark):
    docs = documents(spark)
    found = sharding.shard(docs, 5)
    assert found.columns == ["doc_id", "size", "text_crc32", "law", "shard", "slot", "grown_shard"]
    rows = found.collect()
    slots = {}
    for row in rows:
        slots.setdefault(row["shard"], []).append(row["slot"])
    assert all(sorted(own) == list(range(len(own))) for own in slots.values())
    assert max(map(len, slots.values())) - min(map(len, slots.values())) <= 1
    digests = [(d, len((t or "").encode()) + 8, zlib.crc32((t or "").encode())) for d, t, *_ in DOCUMENTS]
    assert Counter((r["doc_id"], r["size"], r["text_crc32"]) for r in rows) == Counter(digests)
    again = sharding.shard(docs.repartition(7, "source"), 5).collect()
    assert Counter(map(tuple, rows)) == Counter(map(tuple, again))
    assert all(r["law"] == "rows" and r["grown_shard"] is None for r in rows)


def test_empty_table_and_carried_columns(spark):
    assert sharding.shard(documents(spark).limit(0)).count() == 0
    assert sharding.shard(documents(spark), carry=["lang"]).columns[-1] == "lang"


def test_repeated_rows_are_numbered_one_by_one(spark):
    frame = spark.range(1000).select((F.col("id") % 3).alias("k"), F.lit("same").alias("v"))
    found = each_copy(numbered(frame, ["k"], 4), "n").collect()
    for key in range(3):
        own = sorted(row["n"] for row in found if row["k"] == key)
        assert own == list(range(len(own))) and all(row["_total"] == len(own) for row in found if row["k"] == key)
