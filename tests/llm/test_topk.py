import math

import duckdb
import numpy as np
import pytest

from caremesa.llm import topk

FOLDER = "/root/testdata/sf0.001"


def test_coarse_scores_are_sums_of_products():
    rng = np.random.default_rng(1)
    values, query = rng.integers(-40, 40, (200, 6)).astype(np.int32), rng.integers(-30, 30, 6)
    slices, low, dropped = topk.slices_of(values)
    lead = (values - low) >> dropped
    full = (1 << topk.BITS) - 1
    expected = np.where(query > 0, lead * query, (full - lead) * -query).sum(axis=1)
    added = topk.add_slices(slices, query)
    bits = [np.unpackbits(part.view(np.uint8), bitorder="little")[:200].astype(np.int64) for part in added]
    assert (sum(bit << place for place, bit in enumerate(bits)) == expected).all()


def brute(rows, k=10, every=100):
    """Rows (vec_id, vector) as the contract says, in whole numbers of any size."""
    fit = [(i, [math.floor(1024 * x) for x in v]) for i, v in rows if v is not None and all(x is not None and math.isfinite(x) for x in v)]
    out = []
    for at, (query_id, query) in enumerate(fit):
        if query_id is not None and query_id % every == 0:
            scores = [(-sum(a * b for a, b in zip(query, v)), i is None, i or 0) for place, (i, v) in enumerate(fit) if place != at]
            out += [(query_id, rank + 1, None if none else i, -score) for rank, (score, none, i) in enumerate(sorted(scores)[:k])]
    return sorted(out, key=repr)


@pytest.mark.parametrize("case", range(12))
def test_block_equals_sorting(case):
    rng = np.random.default_rng(case)
    n, size = int(rng.integers(1, 300)), (500, 2**61)[case % 2]
    values = rng.integers(-size, size, (n, 8))
    if case % 3 == 0:
        values[: n // 2] = values[0]
    slices, _, dropped = topk.slices_of(values)
    ids = np.sort(rng.choice(10**6, n, replace=False))
    block = topk.Block(ids, np.zeros(n, bool), np.ones(n, np.int64), values, slices, dropped)
    for i in range(0, n, 7):
        query = values[i] if size == 500 else np.where(rng.random(8) < 0.3, rng.integers(-1, 2, 8), 0)
        at, scores, copies = block.best(int(ids[i]), query, 10)
        exact = [sum(int(a) * int(b) for a, b in zip(v, query)) for v in values]
        expected = sorted((row for row in range(n) if row != i or (query != values[i]).any()), key=lambda row: (-exact[row], ids[row]))[:10]
        assert list(at) == expected and list(scores) == [exact[row] for row in expected] and (copies == 1).all()


def test_awkward_rows(spark):
    rows = [
        (0, [1.0, 0.5]), (0, [1.0, 0.5]), (0, [0.25, 0.0]), (1, [1.0, 1.0]), (2, [1.0, 1.0]), (3, None), (4, [None, 1.0]),
        (5, [float("nan"), 1.0]), (6, [float("inf"), 1.0]), (None, [1.0, 1.0]), (7, []), (8, [3e9, 0.0]), (100, [0.0001, -0.0001]),
        *[(9, [2.0])] * 14, (200, [-1.0, 0.0, 5.0]), (200, [-1.0, 0.0, 5.0, 0.0]), (300, []),
    ]
    frame = spark.createDataFrame(rows, "vec_id bigint, embedding array<double>").selectExpr("*", "'clash' as v", "1 as rank", "2 as copies")
    for k, block, queries in ((3, 3, 1), (20, 100, 10), (1, 1, 2)):
        found = topk.search(frame, k=k, block=block, queries=queries).collect()
        assert sorted(map(tuple, found), key=repr) == brute(rows, k)
    assert topk.search(frame.limit(0)).count() == 0
    alone = spark.createDataFrame([(0, [1.0])], "vec_id bigint, embedding array<float>")
    assert topk.search(alone).count() == 0


def test_large_components_keep_their_order(spark):
    """What a limit on components would make equal."""
    rows = [(0, [1.0]), (1, [70000.0]), (2, [80000.0]), (3, [-2.0**40]), (4, [2.0**40]), (100, [1e-3, 7.0])]
    frame = spark.createDataFrame(rows, "vec_id bigint, embedding array<double>")
    assert sorted(map(tuple, topk.search(frame).collect()), key=repr) == brute(rows)
    with pytest.raises(Exception, match="does not fit 64 bits"):
        topk.search(spark.createDataFrame([(0, [2.0**40]), (1, [2.0**40])], frame.schema)).collect()
    with pytest.raises(Exception, match="a component is"):
        topk.search(spark.createDataFrame([(0, [1.0]), (1, [2.0**60])], frame.schema)).collect()


@pytest.mark.parametrize("block", [7, 64, 1000])
def test_random_vectors_with_copies(spark, block):
    rng = np.random.default_rng(block)
    rows = [(int(rng.integers(0, 60)) * 10, [float(x) for x in rng.integers(-3, 4, 3) / 8]) for _ in range(150)]
    rows += rows[:40] + [rows[0]] * 30
    frame = spark.createDataFrame(rows, "vec_id bigint, embedding array<double>")
    assert sorted(map(tuple, topk.search(frame, block=block, queries=5).collect()), key=repr) == brute(rows)


def test_equals_sql(spark):
    duck = duckdb.connect()
    duck.execute(f"create view embeddings as select * from '{FOLDER}/embeddings.parquet'")
    found = topk.search(spark.read.parquet(f"{FOLDER}/embeddings.parquet"), block=100, queries=2)
    assert sorted(map(tuple, found.collect())) == sorted(duck.execute(topk.ORACLE).fetchall())
