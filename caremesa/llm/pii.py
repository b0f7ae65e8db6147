"""Operator 11: personal data found by anchors and expanded by local parsers.

One Aho-Corasick automaton reads each whole text once and finds anchors: at-signs, masked
at-signs, schemes, digits, plus signs and the cue words of identifiers. At an anchor a
parser reads outwards, no further than the characters of its own kind, and validates what it
finds. Anchors come in the order of the text, and a parser passes over anchors inside what it
has already read, so the work is linear.

The four base kinds are exactly the leftmost non-overlapping matches of these patterns:

======  =================================================  =============================
email   ``[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\\.[A-Za-z0-9-]+)+``
ip      ``[0-9]+(\\.[0-9]+)(\\.[0-9]+)(\\.[0-9]+)``           each part at most 255
card    ``[0-9]([\\x20-]?[0-9])+``                           16 to 19 digits, passing Luhn
phone   ``\\+[0-9][\\x20().0-9-]+[0-9]``                      8 to 15 digits
======  =================================================  =============================

A match that fails its check is dropped and not tried again in part. The other kinds are
additions of this method, each from an anchor of its own.
"""

from __future__ import annotations

import ipaddress
import threading
from collections.abc import Callable, Iterator, Sequence

import ahocorasick
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from caremesa.llm.common import c

# Characters of the kinds, schemes and cue words.
DIGIT = frozenset("0123456789")
UPPER = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZ")
ALNUM = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789")
LOCAL = ALNUM | frozenset("._%+-")
LABEL = ALNUM | frozenset("-")
PHONE = DIGIT | frozenset(" ().-")
USER = ALNUM | frozenset("-._~%!$&'()*+,;=:@")
HEX = frozenset("0123456789abcdefABCDEF:.")
BASE = ("email", "ip", "card", "phone")
ADDED = ("masked_email", "login", "ipv6", "tel", "iban", "ssn", "account", "passport")
KINDS = BASE + ADDED
MASKED_AT = ("(at)", "[at]", "{at}")
MASKED_DOT = ("(dot)", "[dot]", "{dot}")
SCHEMES = ("://", "tel:")
CUES = {
    "iban": ("iban",),
    "ssn": ("ssn", "social security number", "social security no"),
    "account": (
        "account number", "account no", "account #", "acct", "customer number", "kontonummer", "konto-nr", "kundennummer",
        "numéro de compte", "numero de compte", "número de cuenta", "numero de cuenta",
    ),
    "passport": ("passport", "reisepass", "passeport", "pasaporte"),
}
#: What may stand between a cue word and its value.
BETWEEN = frozenset(" \t:#.=-")
FILLERS = ("number", "no", "nr", "is", "ist", "est", "es")
IBAN_CHARS = (15, 34)
ACCOUNT_DIGITS = (6, 18)
PASSPORT_CHARS = (6, 9)

Span = tuple[int, int]


def _run(text: str, at: int, chars: frozenset[str], most: int | None = None) -> int:
    """The end of the run of ``chars`` that begins at ``at``."""
    end = len(text) if most is None else min(len(text), at + most)
    while at < end and text[at] in chars:
        at += 1
    return at


def luhn(digits: str) -> bool:
    total = 0
    for place, digit in enumerate(reversed(digits)):
        value = int(digit) * (2 if place % 2 else 1)
        total += value - 9 if value > 9 else value
    return total % 10 == 0


def mod97(iban: str) -> bool:
    """Whether the check digits of an IBAN hold."""
    return int("".join(str(int(char, 36)) for char in iban[4:] + iban[:4])) % 97 == 1


class Reader:
    """The parsers, and how far each has read in one text."""

    def __init__(self, text: str) -> None:
        self.text = text
        self.found: dict[str, list[Span]] = {}
        self.read: dict[str, int] = {}

    def _keep(self, kind: str, start: int, end: int) -> None:
        """Keeps a span, unless one of its kind reaches into it."""
        spans = self.found.setdefault(kind, [])
        if not spans or spans[-1][1] <= start:
            spans.append((start, end))

    def email(self, at: int, _: int) -> None:
        text, floor = self.text, self.read.get("email", 0)
        start = at
        while start > floor and text[start - 1] in LOCAL:
            start -= 1
        end = _run(text, at + 1, LABEL)
        labels = 1 if end > at + 1 else 0
        while labels and end + 1 < len(text) and text[end] == "." and text[end + 1] in LABEL:
            end, labels = _run(text, end + 1, LABEL), labels + 1
        if start < at and labels > 1:
            self._keep("email", start, end)
            self.read["email"] = end
        else:
            self.read["email"] = max(floor, at + 1)  # no local part reaches over an at-sign

    def digit(self, at: int, _: int) -> None:
        if at >= self.read.get("ip", 0):
            self._ip(at)
        if at >= self.read.get("card", 0):
            self._card(at)

    def _ip(self, at: int) -> None:
        text, parts = self.text, [at]
        end = _run(text, at, DIGIT)
        while True:  # four parts at a time, until a part has no dot and digit after it
            if len(parts) == 4:
                bounds = [*parts, end + 1]
                values = [text[a : b - 1].lstrip("0") for a, b in zip(bounds, bounds[1:])]
                if all(len(value) <= 3 and int(value or 0) <= 255 for value in values):
                    self._keep("ip", at, end)
                self.read["ip"] = end
                return
            if not (end + 1 < len(text) and text[end] == "." and text[end + 1] in DIGIT):
                self.read["ip"] = end  # too few parts, whichever of them begins
                return
            parts.append(end + 1)
            end = _run(text, end + 1, DIGIT)

    def _card(self, at: int) -> None:
        text, end, size = self.text, at, len(self.text)
        while True:
            end = _run(text, end, DIGIT)
            if end + 1 < size and text[end] in " -" and text[end + 1] in DIGIT:
                end += 1
            else:
                break
        self.read["card"] = end
        if 16 <= end - at <= 37:
            digits = "".join(char for char in text[at:end] if char in DIGIT)
            if 16 <= len(digits) <= 19 and luhn(digits):
                self._keep("card", at, end)

    def phone(self, at: int, _: int) -> None:
        text = self.text
        if at + 1 >= len(text) or text[at + 1] not in DIGIT:
            return
        end = _run(text, at + 2, PHONE)
        while end > at + 2 and text[end - 1] not in DIGIT:
            end -= 1
        if end >= at + 4 and 8 <= sum(char in DIGIT for char in text[at:end]) <= 15:
            self._keep("phone", at, end)

    def masked_email(self, at: int, after: int) -> None:
        text, floor = self.text, self.read.get("masked_email", 0)
        start = at - 1 if at > floor and text[at - 1] == " " else at
        stop = start
        while start > floor and text[start - 1] in LOCAL:
            start -= 1
        here = after + 1 if text[after : after + 1] == " " else after
        end = _run(text, here, LABEL)
        labels = 1 if end > here else 0
        while labels:
            gap = end + 1 if text[end : end + 1] == " " else end
            dot = next((mark for mark in (".", *MASKED_DOT) if text[gap : gap + len(mark)].lower() == mark), None)
            if dot is None or (dot == "." and gap > end):
                break
            gap += len(dot)
            gap += dot != "." and text[gap : gap + 1] == " "
            if _run(text, gap, LABEL) == gap:
                break
            end, labels = _run(text, gap, LABEL), labels + 1
        if start < stop and labels > 1:
            self._keep("masked_email", start, end)
        self.read["masked_email"] = max(floor, after)

    def scheme(self, at: int, after: int) -> None:
        """A URL with user information before its host, or with an IPv6 address as host."""
        text, here = self.text, after
        if after < self.read.get("scheme", 0):
            return
        end = _run(text, here, USER)
        self.read["scheme"] = end
        sign = text.rfind("@", here, end)
        if sign > here:
            self._keep("login", here, sign)
            here = sign + 1
        if text[here : here + 1] == "[":
            close = _run(text, here + 1, HEX, 46)
            if text[close : close + 1] == "]":
                try:
                    ipaddress.IPv6Address(text[here + 1 : close])
                except ValueError:
                    return
                self._keep("ipv6", here + 1, close)

    def tel(self, at: int, after: int) -> None:
        end = _run(self.text, after, PHONE)
        while end > after and self.text[end - 1] not in DIGIT:
            end -= 1
        if end > after and self.text[after] in DIGIT and 7 <= sum(char in DIGIT for char in self.text[after:end]) <= 15:
            self._keep("tel", after, end)

    def _value(self, at: int, after: int) -> int | None:
        """Where the value of a cue word begins, if the cue word stands alone."""
        text = self.text
        if (at and text[at - 1].isalnum()) or (text[after - 1].isalnum() and text[after : after + 1].isalnum()):
            return None
        here = _run(text, after, BETWEEN, 4)
        for _ in range(2):  # as in "number is"
            word = next((w for w in FILLERS if text[here : here + len(w)].lower() == w and not text[here + len(w) : here + len(w) + 1].isalnum()), "")
            here = _run(text, here + len(word), BETWEEN, 4) if word else here
        return here

    def _grouped(self, here: int, chars: frozenset[str], separators: str, most: int) -> int:
        """The end of characters with at most one separator between two of them, at most ``most`` long and one over."""
        text, end, held = self.text, here, 0
        while held <= most and end < len(text):
            step = end + 1 if held and text[end] in separators else end
            if step >= len(text) or text[step] not in chars:
                break
            end, held = step + 1, held + 1
        return end

    def iban(self, at: int, after: int) -> None:
        here = self._value(at, after)
        if here is None:
            return
        end = self._grouped(here, UPPER | DIGIT, " ", IBAN_CHARS[1])
        while end > here:  # a word in capitals may follow: take off groups until the check digits hold
            code = self.text[here:end].replace(" ", "")
            if len(code) < IBAN_CHARS[0]:
                return
            if len(code) <= IBAN_CHARS[1] and code[:2].isalpha() and code[2:4].isdigit() and mod97(code):
                self._keep("iban", here, end)
                return
            end = self.text.rfind(" ", here, end)

    def ssn(self, at: int, after: int) -> None:
        here = self._value(at, after)
        if here is None:
            return
        end = self._grouped(here, DIGIT, " -", 9)
        digits = "".join(char for char in self.text[here:end] if char in DIGIT)
        if len(digits) == 9 and digits[:3] not in ("000", "666") and digits[0] != "9" and digits[3:5] != "00" and digits[5:] != "0000":
            self._keep("ssn", here, end)

    def account(self, at: int, after: int) -> None:
        here = self._value(at, after)
        if here is None:
            return
        end = self._grouped(here, DIGIT, " -", ACCOUNT_DIGITS[1])
        if ACCOUNT_DIGITS[0] <= sum(char in DIGIT for char in self.text[here:end]) <= ACCOUNT_DIGITS[1]:
            self._keep("account", here, end)

    def passport(self, at: int, after: int) -> None:
        here = self._value(at, after)
        if here is None:
            return
        end = _run(self.text, here, UPPER | DIGIT, PASSPORT_CHARS[1] + 1)
        whole = not self.text[end : end + 1].isalnum()
        if whole and PASSPORT_CHARS[0] <= end - here <= PASSPORT_CHARS[1] and any(char in DIGIT for char in self.text[here:end]):
            self._keep("passport", here, end)

    def spans(self) -> Iterator[tuple[str, int, int]]:
        """All spans by kind, then start."""
        for kind in KINDS:
            for start, end in self.found.get(kind, []):
                yield kind, start, end


def _anchors() -> Iterator[tuple[str, Callable]]:
    yield "@", Reader.email
    yield "+", Reader.phone
    yield "://", Reader.scheme
    yield from ((digit, Reader.digit) for digit in sorted(DIGIT))
    words = [(mark, Reader.masked_email) for mark in MASKED_AT] + [("tel:", Reader.tel)]
    words += [(cue, getattr(Reader, kind)) for kind, cues in CUES.items() for cue in cues]
    for word, parser in words:
        yield from ((form, parser) for form in {word, word.upper(), word.title(), word.capitalize()})


_own = threading.local()


def automaton() -> ahocorasick.Automaton:
    """This worker's automaton over all anchors."""
    if not hasattr(_own, "automaton"):
        built = ahocorasick.Automaton()
        for anchor, parser in _anchors():
            built.add_word(anchor, (len(anchor), parser))
        built.make_automaton()
        _own.automaton = built
    return _own.automaton


def spans(text: str | None) -> list[tuple[str, int, int]]:
    """The spans (kind, start, end) of one text by kind, then start; code points, end exclusive."""
    if not text:
        return []
    reader = Reader(text)
    for last, (size, parser) in automaton().iter(text):
        parser(reader, last + 1 - size, last + 1)
    return list(reader.spans())


FOUND = "array<struct<kind: string, start: int, end: int, value: string>>"


def find(docs: DataFrame, carry: Sequence[str] = ("doc_id",)) -> DataFrame:
    """The columns in ``carry`` and ``found``: kind, start, end (code points, end exclusive) and value of all personal data.

    Each kind is ordered by start and free of overlaps; spans of different kinds may
    overlap. Nulls: a null text is empty; an empty text has an empty list. Texts are read
    whole, whatever their length. Repeated rows give a row each, an empty table gives no
    rows. Other columns are ignored unless carried; a carried column must not be named
    ``found``. Narrow: no shuffle, and nothing is kept from one text to the next.
    """

    def search(texts: pd.Series) -> pd.Series:
        return pd.Series(
            [[{"kind": k, "start": a, "end": b, "value": text[a:b]} for k, a, b in spans(text)] for text in texts], dtype=object
        )

    return docs.select(*carry, F.pandas_udf(search, FOUND)("text").alias("found"))


def redact(docs: DataFrame, carry: Sequence[str] = ("doc_id",)) -> DataFrame:
    """The columns in ``carry`` and ``redacted``: the text with each span of personal data replaced by its kind in brackets.

    Spans that overlap are replaced as one, by the kind that begins first. A null text
    stays null. Other rows and columns as in ``find``.
    """

    def replace(texts: pd.Series) -> pd.Series:
        out = []
        for text in texts:
            parts, at = [], 0
            for start, neg_end, kind in sorted((a, -b, k) for k, a, b in spans(text)):
                if start >= at:
                    parts += [text[at:start], f"[{kind}]"]
                at = max(at, -neg_end)
            out.append(None if text is None else "".join(parts) + text[at:])
        return pd.Series(out, dtype=object)

    return docs.select(*carry, F.pandas_udf(replace, "string")("text").alias("redacted"))


def _listed(found: Column) -> Column:
    return F.array_join(F.transform(found, lambda span: F.concat_ws(":", span.kind, span.start, span.end)), ",")


def digests(docs: DataFrame) -> DataFrame:
    """Counts of the base kinds, the digest of their spans, and all spans as text, derived from ``find``."""
    found = c("found")
    of = lambda *kinds: F.filter(found, lambda span: span.kind.isin(*kinds))
    return find(docs).select(
        "doc_id",
        *[F.size(of(kind)).cast("bigint").alias(f"n_{kind}") for kind in BASE],
        F.sha2(_listed(of(*BASE)), 256).alias("base_sha256"),
        _listed(found).alias("spans"),
    )
