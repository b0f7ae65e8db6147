import random
import re
import tracemalloc
import zlib
from collections import Counter

import duckdb
import numpy as np
import pandas as pd
import pytest
from cases import DOCUMENTS, documents

from caremesa.llm import variants

LOWER = str.maketrans(variants.UPPER, variants.LOWER)


def near(a, b):
    if abs(len(a) - len(b)) > 1 or a == b:
        return False
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    short, long = sorted((a, b), key=len)
    return any(long[:i] + long[i + 1 :] == short for i in range(len(long)))


def count(rows, slips=0):
    words = Counter()
    for doc_id, text, *_ in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = run.translate(LOWER)
            code = zlib.crc32(f"{'' if doc_id is None else doc_id}:{run}".encode())
            if slips and code % slips == 0:
                run = run[: code % len(run)] + run[code % len(run) + 1 :]
            words[run] += 1
    return {word: n for word, n in words.items() if len(word) >= 5 and n >= 3}


def slow(words, factor=2):
    """Every word against every other."""
    rows = {}
    for word, n in words.items():
        others = sorted((-m, other) for other, m in words.items() if near(word, other))
        form = others[0][1] if others and -others[0][0] >= factor * n else None
        rows[word] = (word, n, form, len(others), words[form] if form else None)
    def root(word):
        return root(rows[word][2]) if rows[word][2] else word
    return sorted((word, n, form, root(word), m, k) for word, n, form, m, k in rows.values())


def found(frame, **options):
    return sorted(tuple(row) for row in variants.group(frame, **options).collect())


def texts(seed, alphabet, most, n):
    random.seed(seed)
    base = ["".join(random.choices(alphabet, k=random.randint(4, most))) for _ in range(n)]
    words = []
    for word in base:
        for _ in range(random.randint(0, 4)):
            i, letter = random.randrange(len(word)), random.choice(alphabet)
            other = random.choice((word[:i] + word[i + 1 :], word[:i] + letter + word[i:], word[:i] + letter + word[i + 1 :]))
            words += [other] * random.randint(1, 9)
        words += [word] * random.randint(2, 30)
    random.shuffle(words)
    return [(i, " ".join(words[i::7]).title() if i % 2 else ", ".join(words[i::7])) for i in range(7)]


@pytest.mark.parametrize(("alphabet", "most", "small"), [("abcdeéßÿÀ", 9, False), ("abz", 8, True), ("abcdefgh", 7, True)])
def test_equals_brute_force(spark, monkeypatch, alphabet, most, small):
    """With cells, groups and leaves so small that trees and grids are deep."""
    if small:
        for name, value in (("CELL", 20), ("VISITORS", 15), ("LEAF", 3), ("FIT", 8)):
            monkeypatch.setattr(variants, name, value)
    rows = texts(len(alphabet), alphabet, most, 150)
    frame = spark.createDataFrame(rows, "doc_id bigint, text string")
    for slips in (0, 3):
        assert found(frame, slips=slips) == slow(count(rows, slips))


def test_anagrams_are_divided_by_place(spark, monkeypatch):
    """Hundreds of words of equal letter counts: only the counts of the first half tell them apart."""
    monkeypatch.setattr(variants, "CELL", 60)
    monkeypatch.setattr(variants, "LEAF", 30)
    random.seed(5)
    words = {"".join(random.sample("aabbccdd", 8)) for _ in range(400)}
    words |= {word[:3] + "e" + word[4:] for word in random.sample(sorted(words), 40)}
    rows = [(1, " ".join(word for word in sorted(words) for _ in range(3 + 4 * (word[0] == "a"))))]
    assert found(spark.createDataFrame(rows, "doc_id int, text string")) == slow(count(rows))
    codes = variants.letters(sorted(w for w in words if "e" not in w), 8)
    _, leaves = variants.grow(variants.vectors(codes, 4), 30)
    assert max(map(len, leaves)) < len(codes) / 4


def test_roots_follow_long_chains(spark):
    chain = [("w" * 5 + "x" * i, "w" * 5 + "x" * (i + 1) if i < 21 else None) for i in range(22)]
    ends = dict(map(tuple, variants.roots(spark.createDataFrame(chain, "word string, form string")).collect()))
    assert ends == {word: chain[-1][0] for word, _ in chain[:-1]}
    words = {"w" * 5 + "x" * i: 3 * 2**i for i in range(6)}
    rows = [(0, " ".join(word for word, n in words.items() for _ in range(n)))]
    assert {row[3] for row in found(spark.createDataFrame(rows, "doc_id int, text string"))} == {"wwwwwxxxxx"}


def test_long_words_and_awkward_rows(spark):
    long = "x" * 3_000
    rows = [*((d, t) for d, t, *_ in DOCUMENTS), (9, f"{long} {long} {long[:1000]}y{long[1000:]} " * 3)]
    frame = documents(spark).select("doc_id", "text", "root").union(spark.createDataFrame([(*rows[-1], "r")], "doc_id bigint, text string, root string"))
    assert found(frame, slips=97) == slow(count(rows, 97))
    assert found(frame.limit(0)) == [] and found(frame.select("doc_id", "text").withColumn("text", frame.text.substr(1, 0))) == []
    with pytest.raises(ValueError):
        variants.group(frame, factor=1)


def test_sql_agrees(spark):
    rows = texts(3, "abcdéß", 8, 120)
    frame = spark.createDataFrame(rows, "doc_id bigint, text string")
    documents = frame.toArrow()  # noqa: F841
    columns = "word, n, form, root, n_near, form_n"
    assert found(frame, slips=97) == sorted(duckdb.sql(f"select {columns} from ({variants.ORACLE})").fetchall()) == slow(count(rows, 97))


def test_box_search_leaves_nothing_out():
    random.seed(8)
    words = sorted({"".join(random.choices("abcde", k=6)) for _ in range(900)})
    short = sorted({"".join(random.choices("abcde", k=5)) for _ in range(500)})
    codes = variants.letters(words, 6)
    for others in (words, short):
        got = sorted((int(r), int(v)) for rs, vs in variants.pairs(codes, variants.letters(others, len(others[0]))) for r, v in zip(rs, vs))
        assert got == sorted((i, j) for i, a in enumerate(words) for j, b in enumerate(others) if near(a, b))
    points = variants.vectors(codes, 3)
    tree, leaves = variants.grow(points, 10)
    place = variants.home(tree, points)
    assert all((place[leaf] == i).all() for i, leaf in enumerate(leaves)) and sorted(np.concatenate(leaves)) == list(range(len(words)))


def test_a_full_group_needs_little_memory():
    """All the residents and visitors that a group may hold: two workers stand beside an executor's heap."""
    random.seed(9)
    own, shorter = (["".join(word) for word in zip(*(random.choices("aeinorst", k=70_000) for _ in range(size)))] for size in (9, 8))
    own, shorter = list(dict.fromkeys(own)), list(dict.fromkeys(shorter))[: variants.VISITORS // 2]
    residents, visitors = own[: 2 * variants.CELL], own[: variants.VISITORS // 2] + shorter
    group = pd.DataFrame({"word": residents + visitors, "n": 3, "visits": [False] * len(residents) + [True] * len(visitors)})
    assert len(residents) == 2 * variants.CELL and len(visitors) == variants.VISITORS
    tracemalloc.start()
    try:
        found = variants._meet(group)
        assert tracemalloc.get_traced_memory()[1] < 60e6
    finally:
        tracemalloc.stop()
    some = found.groupby("word")["n_near"].sum()
    for word in random.sample(residents[: len(visitors) // 2], 5):  # also a visitor: that one counts residents, the resident shorter ones
        assert some.get(word, 0) == sum(near(word, other) for other in residents + shorter)


@pytest.mark.parametrize("length", [5, 127, 128, 40_000])
def test_counts_of_long_words_fit_their_type(length):
    codes = variants.letters(["a" * length, "ab" * (length // 2) + "a" * (length % 2)], length)
    counts = variants.vectors(codes, length // 2)
    assert counts[0, 0] == length and counts[0, variants.WIDTH] == length // 2
    assert counts[1, 0] + counts[1, 1] == length and (counts >= 0).all()
    found = [(int(r), int(v)) for rs, vs in variants.pairs(codes[:1], variants.letters(["a" * (length - 1) + "b", "b" * length], length)) for r, v in zip(rs, vs)]
    assert found == [(0, 0)]
    found = [(int(r), int(v)) for rs, vs in variants.pairs(codes[:1], variants.letters(["a" * (length - 1), "b" * (length - 1)], length - 1)) for r, v in zip(rs, vs)]
    assert found == [(0, 0)]
