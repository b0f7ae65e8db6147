import random
from functools import lru_cache

import pytest
from cases import documents

from caremesa.llm import licenses


def found(text):
    return [(n["license"], n["start"]) for n in licenses.notices(text)]


@pytest.mark.parametrize(
    ("text", "license", "start"),
    [
        ("This project is released under the MIT License.", "MIT", 16), ("Licensed under the MIT License.", "MIT", 0),
        ("Released under the Apache License, Version 2.0.", "Apache-2.0", 0), ("This work is licensed under CC BY 4.0.", "CC-BY-4.0", 13),
        ("It is available under the MIT licence and nothing else.", "MIT", 6), ("Photo: CC BY-SA 4.0, the author", "CC-BY-SA-4.0", 7),
        ("Code is licensed under the terms of the GNU General Public License, version 2.", "GPL-2.0", 8),
        ("distributed under the GNU Lesser General Public License version 3", "LGPL-3.0", 0), ("Licensed under AGPLv3", "AGPL-3.0", 0),
        ("Software under the ISC License.", "ISC", 0), ("x\nSPDX-License-Identifier: GPL-2.0-or-later\ny", "GPL-2.0-or-later", 2),
        ("// SPDX-License-Identifier: (MIT OR Apache-2.0)", "MIT", 3), ("Released under the Unlicense.", "Unlicense", 0),
        ("Licensed under a Creative Commons Attribution-ShareAlike 4.0 International License", "CC-BY-SA-4.0", 0),
        ("LICENSED UNDER THE BSD 3-CLAUSE LICENSE", "BSD-3-Clause", 0),
    ],
)
def test_usual_sentences(text, license, start):
    assert found(text) == [(license, start)]


@pytest.mark.parametrize(
    "text",
    [
        "", "He read the MIT license aloud.", "You need a license plate.", "the licence was granted to him", "public domain", "gpl", "cc by mail", "MIT is a university",
        "Copyright 2020 by the author. All rights reserved.", "a licensed driver under the bridge of the river",
    ],
)
def test_mentions_are_no_notices(text):
    assert found(text) == []


@pytest.mark.parametrize(
    ("text", "difference"),
    [
        ("This work is not licensed under the GNU General Public License, version 3.", "- > not"),
        ("Licensed under the Apache License, Version 3.0.", "2 > 3"), ("Licensed under CC BY-ND 9.0.", "4 > 9"),
        ("This is not released under the MIT License.", "- > not; licensed > released"),
    ],
)
def test_binding_differences_are_reported(text, difference):
    (notice,) = licenses.notices(text)
    assert notice["license"] is None and notice["binding"] and notice["differences"] == difference


def test_exact_and_altered_wordings():
    text = (
        "Foo bar. Licensed under the Apache License Version 2.0 (the 'License'); you may not use this file except in compliance with this "
        "License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0\nReleased under the MIT License."
    )
    first, second = licenses.notices(text)
    assert (first["start"], first["template"], first["differences"]) == (9, "Apache-2.0 header", "the > this") and not first["binding"]
    assert second["license"] == "MIT" and text[second["start"] :].startswith("Released")


@pytest.mark.parametrize("name", sorted(licenses.TEMPLATES))
def test_every_template_finds_itself_inside_other_text(name):
    wording = licenses.TEMPLATES[name]
    (notice,) = licenses.notices(f"Some words first.\n{wording} And so on with more words.")
    assert notice["n_differences"] == 0 and notice["start"] == 18 and notice["n_words"] == len(licenses.words_of(wording))
    assert notice["license"] == ("And" if name == licenses.SPDX else name.split(" ")[0])


def slow_distance(one, two):
    @lru_cache(None)
    def at(i, j):
        if not i or not j:
            return i + j
        return min(at(i - 1, j) + 1, at(i, j - 1) + 1, at(i - 1, j - 1) + (one[i - 1] != two[j - 1]))

    return at(len(one), len(two))


def test_alignment_equals_brute_force():
    random.seed(3)
    for _ in range(300):
        template = tuple(random.choices("abc", k=random.randint(1, 6)))
        words = tuple(random.choices("abcx", k=random.randint(0, 8)))
        changes, start, end = licenses.align(template, words)
        least = min(slow_distance(template, words[i:j]) for i in range(len(words) + 1) for j in range(i, len(words) + 1))
        assert len(changes) == least == slow_distance(template, words[start:end])


def slow_notices(text):
    """Every template at every run of words, without compression or an index; one notice at most."""
    words, best = licenses.words_of(text), None
    for name, wording in licenses.TEMPLATES.items():
        template = tuple(licenses.words_of(wording))
        changes, start, end = licenses.align(template, words)
        if end > start and len(changes) <= licenses.allowed(len(template)):
            denied = any(word in licenses.DENIALS for word in words[max(0, start - 3) : start])
            binding = denied or any(licenses.is_binding(word) for change in changes for word in change if word)
            if not binding:
                shared = len(template) - len(changes)
                best = max(best or (0, 0, ""), (shared, -len(changes), name.split(" ")[0]))
    return best


def test_notices_equal_brute_force_on_altered_wordings():
    """Wordings with a word changed, dropped or added, inside other words; a found licence is as good as any."""
    random.seed(5)
    filler = "garden river window letter story people market evening travel".split()
    seen = 0
    for name, wording in licenses.TEMPLATES.items():
        for _ in range(3):
            words = wording.split()
            for _ in range(random.randint(0, 2)):
                i = random.randrange(len(words))
                words[i : i + 1] = random.choice([[], [random.choice(filler)], [words[i], random.choice(filler)]])
            text = " ".join([*random.choices(filler, k=4), *words, *random.choices(filler, k=4)])
            want, got = slow_notices(text), [n for n in licenses.notices(text) if not n["binding"]]
            if want and name != licenses.SPDX and licenses._CUE.search(text):
                seen += 1
                best = max((len(licenses.words_of(licenses.TEMPLATES[n["template"]])) - n["n_differences"] for n in got), default=0)
                assert best >= want[0] or best >= 0.9 * want[0], (text, want, got)
    assert seen > 100


def test_awkward_rows(spark):
    assert licenses.scan(documents(spark)).count() == 0
    assert licenses.scan(documents(spark).limit(0)).count() == 0
    long = "word " * 100_000 + "\nReleased under the MIT License.\n" + "licence " * 20_000
    frame = spark.createDataFrame([(1, long), (1, long), (None, None), (2, "not under the MIT License")], "doc_id bigint, text string")
    rows = licenses.scan(frame.selectExpr("*", "'clash' as start", "'clash' as license", "1 as binding")).collect()
    assert sorted((r["doc_id"], r["license"], r["start"]) for r in rows if r["license"]) == [(1, "MIT", 500_001)] * 2
    ties = licenses.scan(frame.limit(1), {"B short": "Released under the MIT License.", "A short": "Released under the MIT License."})
    assert [r["license"] for r in ties.collect()] == ["A"]
