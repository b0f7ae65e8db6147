"""Operator 2: licence notices found by conditional compression.

Every cue of a licence starts candidates: for each template the block of words that the template
would cover if the cue were its own. A block is compressed alone and with the template as a raw
zstandard dictionary; the more the template saves, the more of its wording the block shares. All
templates that save anything are taken in the order of their saving and aligned word by word, with
a free beginning and end, and only wordings with few differences are confirmed. Differences in
binding words change the licence: they are reported, and the notice names no licence then.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator, Mapping, Sequence
from dataclasses import dataclass
from functools import lru_cache

import pandas as pd
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from caremesa.llm.common import c

# Names that short notices give to licences, with their articles.
NAMES = {
    "MIT": ("the MIT License",),
    "Apache-2.0": ("the Apache License, Version 2.0", "the Apache 2.0 License", "Apache-2.0"),
    "Apache-1.1": ("the Apache License, Version 1.1",),
    "GPL-2.0": ("the GNU General Public License, version 2", "the GNU GPL, version 2", "GPLv2", "GPL-2.0"),
    "GPL-3.0": ("the GNU General Public License, version 3", "the GNU GPL, version 3", "GPLv3", "GPL-3.0"),
    "LGPL-2.1": ("the GNU Lesser General Public License, version 2.1", "LGPLv2.1", "LGPL-2.1"),
    "LGPL-3.0": ("the GNU Lesser General Public License, version 3", "LGPLv3", "LGPL-3.0"),
    "AGPL-3.0": ("the GNU Affero General Public License, version 3", "AGPLv3", "AGPL-3.0"),
    "MPL-2.0": ("the Mozilla Public License, version 2.0", "MPL 2.0"),
    "EPL-2.0": ("the Eclipse Public License, version 2.0", "EPL 2.0"),
    "BSD-2-Clause": ("the BSD 2-Clause License", "the Simplified BSD License"),
    "BSD-3-Clause": ("the BSD 3-Clause License", "the New BSD License"),
    "ISC": ("the ISC License",),
    "Zlib": ("the zlib License",),
    "Unlicense": ("the Unlicense",),
    "CC0-1.0": ("CC0 1.0", "a Creative Commons Zero 1.0 Universal License"),
    "CC-BY-4.0": ("CC BY 4.0", "a Creative Commons Attribution 4.0 International License"),
    "CC-BY-3.0": ("CC BY 3.0", "a Creative Commons Attribution 3.0 Unported License"),
    "CC-BY-SA-4.0": ("CC BY-SA 4.0", "a Creative Commons Attribution-ShareAlike 4.0 International License"),
    "CC-BY-SA-3.0": ("CC BY-SA 3.0", "a Creative Commons Attribution-ShareAlike 3.0 Unported License"),
    "CC-BY-NC-4.0": ("CC BY-NC 4.0", "a Creative Commons Attribution-NonCommercial 4.0 International License"),
    "CC-BY-ND-4.0": ("CC BY-ND 4.0", "a Creative Commons Attribution-NoDerivatives 4.0 International License"),
    "CC-BY-NC-SA-4.0": ("CC BY-NC-SA 4.0", "a Creative Commons Attribution-NonCommercial-ShareAlike 4.0 International License"),
    "CC-BY-NC-ND-4.0": ("CC BY-NC-ND 4.0", "a Creative Commons Attribution-NonCommercial-NoDerivatives 4.0 International License"),
}
# How short notices name a licence.
FORMS = ("Licensed under {}.", "Licensed under the terms of {}.")
# Longer notices, as the stewards of the licences word them.
_GNU = (
    "This {0} is free software: you can redistribute it and/or modify it under the terms of the GNU {1}General Public License as "
    "published by the Free Software Foundation, either version {2} of the License, or (at your option) any later version."
)
_AS_IS = (
    'THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF '
    "MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT."
)
_BSD = (
    "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following "
    "conditions are met:"
)
_BSD_CLAUSES = (
    "Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer. "
    "Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer "
    "in the documentation and/or other materials provided with the distribution."
)
_MIT = (
    "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation "
    'files (the "Software"), to deal in the Software without restriction, including without limitation the rights to use, copy, '
    "modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software "
    "is furnished to do so, subject to the following conditions:"
)
NOTICES = {
    "Apache-2.0 header": 'Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in '
    "compliance with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0",
    "MIT grant": _MIT,
    "MIT text": f"{_MIT} The above copyright notice and this permission notice shall be included in all copies or substantial "
    f"portions of the Software. {_AS_IS}",
    "ISC grant": "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby "
    "granted, provided that the above copyright notice and this permission notice appear in all copies.",
    "GPL-2.0 header": _GNU.format("program", "", "2"),
    "GPL-3.0 header": _GNU.format("program", "", "3"),
    "LGPL-2.1 header": _GNU.format("library", "Lesser ", "2.1"),
    "LGPL-3.0 header": _GNU.format("library", "Lesser ", "3"),
    "AGPL-3.0 header": _GNU.format("program", "Affero ", "3"),
    "BSD grant": _BSD,
    "BSD-2-Clause text": f"{_BSD} {_BSD_CLAUSES}",
    "BSD-3-Clause text": f"{_BSD} {_BSD_CLAUSES} Neither the name of the copyright holder nor the names of its contributors may be "
    "used to endorse or promote products derived from this software without specific prior written permission.",
    "MPL-2.0 header": "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL "
    "was not distributed with this file, You can obtain one at",
    "Unlicense text": "This is free and unencumbered software released into the public domain. Anyone is free to copy, modify, "
    "publish, use, compile, sell, or distribute this software, either in source code form or as a compiled binary, for any purpose, "
    "commercial or non-commercial, and by any means.",
    "CC0-1.0 waiver": "To the extent possible under law, the author has waived all copyright and related or neighboring rights to "
    "this work.",
    "Zlib grant": "Permission is granted to anyone to use this software for any purpose, including commercial applications, and to "
    "alter it and redistribute it freely, subject to the following restrictions:",
    "EPL-2.0 header": "This program and the accompanying materials are made available under the terms of the Eclipse Public License "
    "2.0 which is available at",
    "SPDX line": "SPDX-License-Identifier:",
}


def short_templates(names: Mapping[str, Sequence[str]] = NAMES) -> dict[str, str]:
    """Short notices by rule: each form with each name of a licence; marks of Creative Commons stand alone, too."""
    made = {}
    for licence, own in names.items():
        for i, name in enumerate(own):
            made |= {f"{licence} short {i}{j}": form.format(name) for j, form in enumerate(FORMS)}
        if licence.startswith("CC-"):
            made[f"{licence} mark"] = own[0]
    return made


TEMPLATES = short_templates() | NOTICES
SPDX = "SPDX line"
LEVEL = 6
#: Differences that a wording may have: one below eight words, else two or that share of its words.
FEW, SHARE = 8, 0.1
# Words whose change changes the licence, besides those with a digit, and words that deny what follows.
BINDING = frozenset(
    """
    apache mit gnu gpl lgpl agpl general lesser affero public mozilla mpl eclipse epl bsd isc zlib unlicense cc cc0 by nc sa nd zero clause
    simplified new attribution noncommercial sharealike noderivatives license not no non never without unencumbered waived spdx identifier
    """.split()
)
DENIALS = frozenset("not no non never neither isn t aren without".split())
#: Words that are read as others: spellings.
SPELLINGS = {"licence": "license", "licences": "licenses", "licenced": "licensed", "sublicence": "sublicense"}

_CUE = re.compile(
    r"licen[cs]|copyright|redistribut|permission|public domain|creative commons|free software|unencumbered|\bcc0\b|\bcc[ -]by\b|\b[al]?gplv?\d?\b|\bunlicense\b|mozilla public|accompanying materials|apache|\bbsd\b|\b[em]pl\b",
    re.I,
)
#: Each cue holds one of these; plain search rules out most texts.
_SIGNS = ("licen", "copyright", "redistribut", "permission", "public domain", "creative", "free software", "unencumbered", "cc", "gpl", "mozilla", "accompanying", "apache", "bsd", "epl", "mpl")
_WORD = re.compile(r"\w+", re.A)
_IDENTIFIER = re.compile(r"\s*:?\s*\(?([A-Za-z0-9][A-Za-z0-9.+-]*)")


def words_of(text: str) -> list[str]:
    return [SPELLINGS.get(word, word) for word in _WORD.findall(text.lower())]


def is_binding(word: str) -> bool:
    return word in BINDING or any(char.isdigit() for char in word)


def allowed(n_words: int) -> int:
    """Differences that a wording of so many words may have."""
    return 1 if n_words < FEW else max(2, int(n_words * SHARE))


@dataclass(frozen=True)
class Template:
    """``before``: words in front of each cue in the wording."""

    name: str
    words: tuple[str, ...]
    before: tuple[int, ...]
    compressor: zstandard.ZstdCompressor

    @property
    def licence(self) -> str:
        return self.name.partition(" ")[0]


@lru_cache(maxsize=4)
def _made(templates: tuple[tuple[str, str], ...]) -> list[Template]:
    made = []
    for name, text in templates:
        content = zstandard.ZstdCompressionDict(text.lower().encode(), dict_type=zstandard.DICT_TYPE_RAWCONTENT)
        content.precompute_compress(level=LEVEL)
        starts = [match.start() for match in _WORD.finditer(text)]
        before = tuple(dict.fromkeys(max(0, sum(start <= cue.start() for start in starts) - 1) for cue in _CUE.finditer(text)))
        made.append(Template(name, tuple(words_of(text)), before, zstandard.ZstdCompressor(dict_data=content)))
    return made


@lru_cache(maxsize=4)
def _index(templates: tuple[tuple[str, str], ...]) -> dict[str, list[int]]:
    """Templates by their rarest words, one more of them than a wording may lack: without any of these it can't be confirmed."""
    made = _made(templates)
    common = Counter(word for template in made for word in set(template.words))
    found: dict[str, list[int]] = {}
    for i, template in enumerate(made):
        rarest = sorted(set(template.words), key=lambda word: (common[word], word))
        for word in rarest[: allowed(len(template.words)) + 1]:
            found.setdefault(word, []).append(i)
    return found


_PLAIN = zstandard.ZstdCompressor(level=LEVEL)


def align(template: Sequence[str], words: Sequence[str]) -> tuple[list[tuple[str, str]], int, int]:
    """The fewest word changes (expected, found) from the template to any run of ``words``, and where that run begins and ends.

    Of equally close runs the one that ends last, of these the longest.
    """
    width = len(words)
    rows = [[0] * (width + 1)]
    for i, expected in enumerate(template, 1):
        above, row = rows[-1], [i]
        for j, found in enumerate(words, 1):
            row.append(min(above[j - 1] + (expected != found), above[j] + 1, row[j - 1] + 1))
        rows.append(row)
    i, j = len(template), min(range(width + 1), key=lambda k: (rows[-1][k], -k))
    end, changes = j, []
    while i:
        if j and rows[i][j] == rows[i - 1][j - 1] + (template[i - 1] != words[j - 1]):
            i, j = i - 1, j - 1
            if template[i] != words[j]:
                changes.append((template[i], words[j]))
        elif j and rows[i][j] == rows[i][j - 1] + 1:
            j -= 1
            changes.append(("", words[j]))
        else:
            i -= 1
            changes.append((template[i], ""))
    return changes[::-1], j, end


@dataclass(frozen=True)
class Notice:
    """A confirmed wording: where its first and last word stand, and how it differs."""

    first: int
    end: int
    template: Template
    changes: tuple[tuple[str, str], ...]
    saved: int

    @property
    def binding(self) -> bool:
        return any(is_binding(word) for change in self.changes for word in change if word)

    @property
    def rank(self) -> tuple:
        """The smallest is the best: no binding difference, or the fewest; the most words shared, the closest, the largest saving."""
        shared = len(self.template.words) - len(self.changes)
        return self.binding, self.binding * len(self.changes), -shared, len(self.changes), -self.saved, self.template.name


def confirm(known: Sequence[Template], words: Sequence[str], cue: int, text: str, spans: Sequence[tuple[int, int]], floor: int) -> Notice | None:
    """The best notice around the word with number ``cue`` that begins at ``floor`` or later."""
    ranked = []
    for template in known:
        size, slack = len(template.words), allowed(len(template.words))
        for before in template.before:
            low = max(floor, cue - before - slack)
            high = min(len(words), cue - before + size + slack)
            own = words[low:high]
            missing = size - sum((Counter(template.words) & Counter(own)).values())
            if missing > slack:
                continue  # every missing word is a difference
            block = text[spans[low][0] : spans[high - 1][1]].lower().encode("utf-8", "surrogatepass")
            saved = len(_PLAIN.compress(block)) - len(template.compressor.compress(block))
            if saved > 0:
                ranked.append((-saved / len(block), -saved, template.name, template, low, own))
    best = None
    for _, saved, _, template, low, own in sorted(ranked, key=lambda row: row[:3]):
        changes, start, end = align(template.words, own)
        if len(changes) > allowed(len(template.words)) or start == end:
            continue
        denied = [("", word) for word in words[max(0, low + start - 3) : low + start] if word in DENIALS]
        notice = Notice(low + start, low + end, template, (*denied, *changes), -saved)
        if best is None or notice.rank < best.rank:
            best = notice
    return best


def _may_hold(text: str) -> bool:
    lowered = text.lower()
    return any(sign in lowered for sign in _SIGNS)


def _cue_words(text: str, spans: Sequence[tuple[int, int]]) -> Iterator[int]:
    """The numbers of the words at which cues begin, in order."""
    at, last = 0, -1
    for match in _CUE.finditer(text):
        while at < len(spans) and spans[at][1] <= match.start():
            at += 1
        if at < len(spans) and at != last:
            last = at
            yield at


def notices(text: str | None, templates: Mapping[str, str] = TEMPLATES) -> list[dict]:
    """Confirmed notices in their order: start, template, license (None with a binding difference), words and differences."""
    if not text or not _may_hold(text) or not _CUE.search(text):
        return []
    listed = tuple(templates.items())
    known, index = _made(listed), _index(listed)
    spans = [match.span() for match in _WORD.finditer(text)]
    words = words_of(text)
    found, free, tried = [], 0, set()
    reach = max(len(template.words) + allowed(len(template.words)) for template in known) + 4
    for cue in _cue_words(text, spans):
        if cue < free:
            continue  # part of a confirmed notice
        # equal surroundings give an equal answer, so repeated words are looked at once
        around = words[max(free, cue - reach) : cue + reach]
        likely = sorted(set().union(*(index[word] for word in set(around) & index.keys())))
        if not likely:
            continue
        key = (tuple(around), min(cue - free, reach))
        if key in tried:
            continue
        notice = confirm([known[i] for i in likely], words, cue, text, spans, free)
        if notice is None:
            if len(tried) > 512:
                tried.clear()
            tried.add(key)
            continue
        free = notice.end
        licence = None if notice.binding else notice.template.licence
        if notice.template.name == SPDX:
            named = _IDENTIFIER.match(text, spans[notice.end - 1][1])
            licence = named[1] if named and licence else None
        found.append({
            "start": spans[notice.first][0], "template": notice.template.name, "license": licence, "n_words": notice.end - notice.first,
            "n_differences": len(notice.changes), "differences": "; ".join(f"{a or '-'} > {b or '-'}" for a, b in notice.changes),
            "binding": notice.binding, "bytes_saved": notice.saved,
        })
    return found


_NOTICE = (
    "array<struct<start: bigint, template: string, license: string, n_words: int, n_differences: int, differences: string, "
    "binding: boolean, bytes_saved: int>>"
)


def scan(docs: DataFrame, templates: Mapping[str, str] = TEMPLATES, carry: Sequence[str] = ("doc_id",)) -> DataFrame:
    """A row for each licence notice in the whole texts of ``docs``.

    Returns the columns in ``carry``, start (code points), license, template, n_words,
    n_differences, differences, binding and bytes_saved. license is null where a binding word
    differs or a denial stands before the notice. A text without notices gives no row.

    Nulls: null and empty texts have no notices; a null doc_id stays null. Repeated rows
    give their notices each. Of templates that fit a place equally well, the one that saves
    more holds, then the first by name. An empty table gives no rows. Other columns are
    ignored unless carried; a carried column must not have a result's name.
    """
    chosen = dict(templates)

    def read(text: pd.Series) -> pd.Series:
        return pd.Series([notices(t, chosen) for t in text], dtype=object)

    # not deterministic by name only: else Spark would infer a filter from the explode and run the function twice
    reader = F.pandas_udf(read, _NOTICE).asNondeterministic()
    read_once = docs.select(*carry, reader("text").alias("_notices"))
    found = read_once.select(*carry, F.explode("_notices").alias("_notice")).select(*carry, "_notice.*")
    rest = ("template", "n_words", "n_differences", "differences", "binding", "bytes_saved")
    return found.select(*carry, "start", "license", *[c(name) for name in rest])
