import hashlib
import random

import public_tokenizers
import pytest
import tiktoken
from cases import DOCUMENTS, documents
from hypothesis import given, settings
from hypothesis import strategies as st

from caremesa.llm import bpe


@pytest.fixture(scope="module")
def codec():
    return bpe.Codec(bpe.RANKS, bpe.PATTERN)


@pytest.fixture(scope="module")
def library(codec):
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=codec.ranks, special_tokens={})


def expected(library, text):
    ids = library.encode_ordinary(text or "")
    joined = " ".join(map(str, ids))
    return len(ids), hashlib.sha256(joined.encode()).hexdigest(), hashlib.sha256((text or "").encode()).hexdigest()


def test_equals_the_library_on_awkward_texts(codec, library):
    random.seed(3)
    texts = ["".join(random.choices("abcdeé漢🙂 \n\t'sst019 .!", k=random.randint(0, 200))) for _ in range(200)]
    texts += ["", "a" * 1000, "ab" * 700, " " * 5000, "\x00", "z" * 255, "z" * 256, "<|endoftext|>", "aéaé" * 400]
    found = codec.slice(texts)
    assert [tuple(row) for row in found[["n_tokens", "ids_sha256", "decoded_sha256"]].itertuples(index=False)] == [expected(library, t) for t in texts]
    ids = [library.encode_ordinary(t) for t in texts]
    assert [[int(i) for i in own.split()] for own in found["ids"]] == ids
    assert codec.decode(ids) == [t.encode() for t in texts]


@settings(max_examples=40, deadline=None)
@given(st.lists(st.text(max_size=60), min_size=1, max_size=5))
def test_equals_the_library_on_any_text(texts):
    own = bpe.codec(bpe.RANKS, bpe.PATTERN)
    library = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=own.ranks, special_tokens={})
    assert [len(library.encode_ordinary(t)) for t in texts] == own.slice(texts)["n_tokens"].tolist()


def test_words_are_learned_anew_beyond_the_bound(codec, library, monkeypatch):
    monkeypatch.setattr(bpe, "REMEMBERED", 3)
    for text in ("one two three four five", "six seven one two"):
        assert codec.slice([text])["n_tokens"].tolist() == [len(library.encode_ordinary(text))]


def test_unknown_id_raises(codec):
    with pytest.raises(ValueError):
        codec.decode([[1, 60_000]])


def test_rows(spark, library):
    found = bpe.encode(documents(spark), with_ids=True)
    rows = sorted((r["doc_id"] or 0, *tuple(r)[1:4]) for r in found.collect())
    assert rows == sorted((d or 0, *expected(library, t)) for d, t, *_ in DOCUMENTS)
    back = {r["doc_id"]: bytes(r["bytes"]) for r in bpe.decode(found).collect()}
    assert back[8] == DOCUMENTS[-1][1].encode() and back[4] == b""
    assert bpe.encode(documents(spark).limit(0)).count() == 0
