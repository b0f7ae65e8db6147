import random
import zlib
from collections import defaultdict

import numpy as np
import pytest
from cases import DOCUMENTS, documents
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from caremesa.llm import packing


@pytest.fixture(scope="module")
def tokenizer():
    own = Tokenizer.from_file(packing.VOCABULARY)
    own.encode_special_tokens = True
    return own


def expected_pieces(tokenizer, text, capacity):
    ids = np.array([*tokenizer.encode(text or "", add_special_tokens=False).ids, packing.END], "<u4")
    count, start = -(-len(ids) // capacity), 0
    end = len(ids) - (count - 1) * capacity
    for piece in range(count):
        yield piece, start, end - start, zlib.crc32(ids[start:end].tobytes())
        start, end = end, end + capacity


@settings(max_examples=60, deadline=None)
@given(st.text(max_size=80))
def test_ids_are_those_of_the_tokenizer(text):
    own = Tokenizer.from_file(packing.VOCABULARY)
    own.encode_special_tokens = True
    ids = np.frombuffer(packing.encoder(packing.VOCABULARY).encode(text), "<u4").tolist()
    assert ids == own.encode(text, add_special_tokens=False).ids


@pytest.mark.parametrize("seed", range(60))
def test_plan_places_every_piece_once_without_gaps(seed):
    random.seed(seed)
    capacity = random.choice([10, 30, 1024])
    counts = {random.randint(1, capacity): random.randint(1, random.choice([1, 3, 200])) for _ in range(random.choice([1, 5, 50]))}
    plan = packing.Plan(counts, capacity)
    sequences, seen = defaultdict(list), defaultdict(list)
    for length, low, high, first, each, offset in plan.places:
        for number in range(low, high):
            seen[length].append(number)
            sequences[first + (number - low) // each].append((offset + (number - low) % each * length, length))
    assert all(sorted(seen[length]) == list(range(n)) for length, n in counts.items())
    assert set(sequences) == set(range(plan.sequences))
    for items in sequences.values():
        at = 0
        for offset, length in sorted(items):
            assert offset == at
            at += length
        assert at <= capacity and sum(3 * length > capacity for _, length in items) <= 2
    ordinary = first_fit(counts, capacity)
    assert plan.sequences <= ordinary + max(1, ordinary // 50)


def first_fit(counts, capacity):
    """First-fit decreasing over single pieces."""
    gaps = []
    for length in sorted((x for x, n in counts.items() for _ in range(n)), reverse=True):
        for i, gap in enumerate(gaps):
            if gap >= length:
                gaps[i] -= length
                break
        else:
            gaps.append(capacity - length)
    return len(gaps)


def test_a_large_plan_stays_small():
    random.seed(5)
    counts = {length: random.randint(1, 10**6) for length in range(1, 1025)}
    plan = packing.Plan(counts)
    assert len(plan.places) < 10_000 and plan.sequences * 1024 < 1.01 * sum(x * n for x, n in counts.items())


@pytest.mark.parametrize("capacity", [7, 1024])
def test_rows(spark, tokenizer, capacity):
    docs = documents(spark).where("doc_id is null or doc_id != 5") if capacity == 7 else documents(spark)
    rows = packing.pack(docs, capacity).collect()
    texts = [(d, t) for d, t, *_ in DOCUMENTS if capacity != 7 or d != 5]
    expected = sorted((d or 0, *piece) for d, t in texts for piece in expected_pieces(tokenizer, t, capacity))
    assert sorted((r["doc_id"] or 0, r["piece"], r["start"], r["length"], r["ids_crc32"]) for r in rows) == expected
    sequences = defaultdict(list)
    for row in rows:
        sequences[row["sequence_id"]].append((row["offset"], row["length"]))
    for items in sequences.values():
        at = 0
        for offset, length in sorted(items):
            assert offset == at
            at += length
        assert at <= capacity


def test_empty_table(spark):
    assert packing.pack(documents(spark).limit(0)).count() == 0


@pytest.mark.parametrize(
    "text",
    ["a <|endoftext|> b", "<|endoftext|>", "a<|endoftext|><|endoftext|>\n b", "x  <|endoftext|>  y", "<|endoftext|", "<|endo<|endoftext|>", "aa<|ENDOFTEXT|>"],
)
def test_added_tokens_get_their_ids_as_in_the_library_by_default(text):
    ids = np.frombuffer(packing.encoder(packing.VOCABULARY).encode(text), "<u4").tolist()
    assert ids == Tokenizer.from_file(packing.VOCABULARY).encode(text, add_special_tokens=False).ids


def test_one_length_only_gets_buckets_of_bounded_size(spark, monkeypatch):
    monkeypatch.setattr(packing, "BUCKET_ROWS", 2)
    asked = []
    numbered = packing.numbered
    monkeypatch.setattr(packing, "numbered", lambda frame, within, buckets: asked.append(buckets) or numbered(frame, within, buckets))
    docs = spark.createDataFrame([(i, "word") for i in range(1_200)], "doc_id int, text string")
    found = packing.pack(docs).collect()
    assert asked == [600] and len({(r["sequence_id"], r["offset"]) for r in found}) == len({r["doc_id"] for r in found}) == 1_200
