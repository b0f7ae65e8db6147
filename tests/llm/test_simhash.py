import random
import re

import numpy as np
import pytest
import xxhash
from cases import DOCUMENTS, documents
from pyspark.sql import functions as F

from caremesa.llm import simhash
from caremesa.llm.components import roots


def slow_fingerprint(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    shingles = [" ".join(words[i : i + 4]) for i in range(max(1, len(words) - 3))] if words else []
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << bit for bit in range(64) if 2 * sum(h >> bit & 1 for h in hashes) > len(hashes))


def slow_components(prints):
    """Component id of each fingerprint of {fingerprint: smallest id}."""
    fps, label = np.array(list(prints), np.uint64), {fp: fp for fp in prints}

    def find(fp):
        while label[fp] != fp:
            fp = label[fp]
        return fp

    for fp in fps:
        for other in fps[np.bitwise_count(fps ^ fp) <= 4]:
            label[find(int(fp))] = find(int(other))
    least = {}
    for fp, doc in prints.items():
        least[find(fp)] = min(least.get(find(fp), doc), doc)
    return {fp: least[find(fp)] for fp in prints}


@pytest.mark.parametrize("text", [row[1] for row in DOCUMENTS if not row[1] or len(row[1]) < 5000] + ["A", "a B c", "À bc DE f", "w " * 700])
def test_fingerprint(text):
    assert simhash.fingerprint(text) == slow_fingerprint(text)


def test_fingerprint_in_parts(monkeypatch):
    text = " ".join(f"w{i % 97}" for i in range(1000))
    whole = simhash.fingerprint(text)
    monkeypatch.setattr(simhash, "_AT_ONCE", 64)
    assert simhash.fingerprint(text) == whole == slow_fingerprint(text)


def near_fingerprints(count, seed):
    random.seed(seed)
    fps = {random.getrandbits(64) for _ in range(count)}
    for base in list(fps)[: count // 3]:
        for _ in range(random.randint(1, 12)):
            base ^= sum(1 << bit for bit in random.sample(range(64), random.randint(1, 5)))
            fps.add(base)
    return sorted(fps)


@pytest.mark.parametrize("blocks", [None, 5, 8])
@pytest.mark.parametrize("chunk", [2, 1024])
def test_components_equal_brute_force(spark, blocks, chunk):
    fps = near_fingerprints(120, 5)
    signed = np.array(fps, np.uint64).view(np.int64).tolist()
    frame = spark.createDataFrame([(fp,) for fp in signed], "fp bigint")
    found = {row["node"]: row["root"] for row in roots(simhash.links(frame, chunk, blocks)).collect()}
    expected = slow_components({fp: s for fp, s in zip(fps, signed)})
    assert {s: found.get(s, s) for s in signed} == {s: expected[fp] for fp, s in zip(fps, signed)}


def test_forest_joins_what_belongs_together_without_all_pairs():
    fps = np.array(near_fingerprints(300, 9), np.uint64)
    links, expected = simhash.forest(fps), slow_components({int(fp): int(fp) for fp in fps})
    assert all((a ^ b).bit_count() <= 4 for a, b in links)
    assert len(links) == len(fps) - len(set(expected.values()))


def test_long_chain_and_hub(spark):
    edges = [(i, i + 1) for i in range(200)] + [(1000, i) for i in range(1001, 1400)] + [(7, 7)]
    found = {r["node"]: r["root"] for r in roots(spark.createDataFrame(edges, "a bigint, b bigint")).collect()}
    assert found == {i: 0 for i in range(201)} | {i: 1000 for i in range(1000, 1400)}
    assert roots(spark.createDataFrame([], "a bigint, b bigint")).count() == 0


def test_rows(spark):
    found = simhash.near_duplicates(documents(spark)).collect()
    assert len(found) == len(DOCUMENTS)
    own = {}
    for doc_id, text, *_ in DOCUMENTS:
        fp = slow_fingerprint(text) if not text or len(text) < 5000 else simhash.fingerprint(text)
        own.setdefault(fp, []).append(doc_id)
    least = {fp: min((i for i in ids if i is not None), default=10**9) for fp, ids in own.items()}
    component = {f"{fp:016x}": None if doc == 10**9 else doc for fp, doc in slow_components(least).items()}
    assert {(r["fingerprint"], r["component_id"]) for r in found} == set(component.items())
    assert simhash.near_duplicates(documents(spark).limit(0)).count() == 0


def test_one_row_of_each_component_stays(spark):
    docs = documents(spark).withColumn("extra", F.lit(1))
    kept = simhash.keep_one(docs)
    assert kept.columns == docs.columns
    ids = sorted((r["doc_id"] or -1) for r in kept.collect())
    assert ids == sorted({(r["component_id"] or -1) for r in simhash.near_duplicates(docs).collect()})
    assert simhash.keep_one(docs.limit(0)).count() == 0
