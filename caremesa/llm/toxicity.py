"""Operator 7: toxicity by noisy-channel deobfuscation.

A character language model (trigrams over letter classes) is counted over all texts.
Words that may be disguised become lattices: a digit or sign may stand for a letter it
resembles or for a gap, a long run of a letter for one or two, a separator between single
letters for nothing. Viterbi decoding under the language model and the channel's odds
restores the text. All other words have one path through their lattice and stay as they
are. The restored text is then scored by the words and word beginnings that mark toxic
training rows.
"""

from __future__ import annotations

import math
import re
import uuid
from bisect import bisect_left
from collections import Counter
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from caremesa.llm.common import c, free_name, settle

CLASSES = 64
THRESHOLD = 0.3
#: The classifier is fitted on the distinct texts of about this many labelled rows (a fixed hash of doc_id picks them). A
#: feature has to mark that many toxic texts, nearly none that are not toxic, and so many that no chosen feature explains.
FIT_ROWS, SUPPORT, PRECISION, LEAST = 20_000, 3, 0.9, 2.0
SMOOTHING = 8.0

# Letters that a digit or sign may stand for.
LOOKS = {
    "0": "o", "1": "il", "2": "z", "3": "e", "4": "a", "5": "s", "6": "gb", "7": "t", "8": "b", "9": "g",
    "@": "a", "$": "s", "!": "i", "|": "il", "+": "t", "(": "c", "<": "c", "€": "e", "£": "l",
}
MASK = "*"
_SIGNS = re.escape("".join(LOOKS) + MASK)
_LETTER = r"[^\W\d_]"
#: Four or more single characters with blanks between them.
_SPACED = re.compile(r"(?<!\S)\S(?: {1,2}\S){3,}(?!\S)")
#: A word with separators between all its characters, with a sign that touches a letter, or with a letter three
#: times in a row.
_SUSPECT = re.compile(
    rf"(?<!\w)(?:[^\W_]|[{_SIGNS}])(?:[.\-_*](?:[^\W_]|[{_SIGNS}])){{3,}}(?![^\W_])"
    rf"|[{_SIGNS}]{_LETTER}|{_LETTER}[{_SIGNS}]|({_LETTER})\1\1"
)
_TRIPLE = re.compile(r"(.)\1\1")
_APART = re.compile(rf"\W*(?:[^\W_]|[{_SIGNS}])(?:[.\-_*](?:[^\W_]|[{_SIGNS}])){{3,}}(?![^\W_])")
_SEPARATORS = " .-_*"
_WORD = re.compile(rf"{_LETTER}+")
_RUN = re.compile(r"(.)\1*", re.S)


@lru_cache(maxsize=1)
def _class_table() -> np.ndarray:
    """Class of each character: 0 for what is no letter, a-z, Latin-1 letters, all other letters."""
    table = np.zeros(0x110000, np.uint8)
    for point in range(0x110000):
        if chr(point).isalpha():
            table[point] = 60
    table[ord("a") : ord("z") + 1] = np.arange(1, 27)
    table[0xDF:0x100] = 27 + np.arange(0x100 - 0xDF)
    table[0xF7] = 0
    return table


def _classes(text: str) -> np.ndarray:
    points = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), "<u4")
    return _class_table()[points]


def _joined(texts: pd.Series, size: int = 1 << 20) -> Iterator[str]:
    """The texts with gaps between them, a megabyte or a whole text at a time."""
    part, length = [], 0
    for text in texts:
        part.append(text or "")
        length += len(part[-1])
        if length >= size:
            yield "\n\n".join(part)
            part, length = [], 0
    yield "\n\n".join(part)


def _count_trigrams(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    total = np.zeros(CLASSES**3, np.int64)
    for frame in frames:
        for text in _joined(frame["text"]):
            codes = _classes(text.lower()).astype(np.int64)
            codes = np.concatenate(([0, 0], codes[(codes != 0) | np.concatenate(([True], codes[:-1] != 0))], [0]))
            total += np.bincount((codes[:-2] * CLASSES + codes[1:-1]) * CLASSES + codes[2:], minlength=CLASSES**3)
    found = np.flatnonzero(total)
    yield pd.DataFrame({"code": found, "n": total[found]})


def language_model(docs: DataFrame) -> np.ndarray:
    """Log probabilities [first, second, third], interpolated; from all texts.

    The table has 64^3 entries whatever the corpus.
    """
    counted = docs.select("text").mapInPandas(_count_trigrams, "code bigint, n bigint").groupBy("code").agg(F.sum("n").alias("n"))
    counts = np.zeros(CLASSES**3)
    for row in counted.collect():
        counts[row["code"]] = row["n"]
    counts = counts.reshape((CLASSES,) * 3)
    single = counts.sum((0, 1)) + 1
    single /= single.sum()
    pairs = counts.sum(0) + SMOOTHING * single
    pairs /= pairs.sum(1, keepdims=True)
    triples = counts + SMOOTHING * pairs
    return np.log(triples / triples.sum(2, keepdims=True)).astype(np.float32)


@lru_cache(maxsize=4096)
def _codes(option: str) -> tuple[int, ...]:
    return tuple(_classes(option).tolist())


class Restorer:
    """Reads texts as restored words; remembers the words it has read, up to a bound."""

    def __init__(self, model: np.ndarray, remembered: int = 50_000) -> None:
        self.model, self.remembered = model.tolist(), remembered
        self.known: dict[str, list[str]] = {}

    @staticmethod
    def _options(sign: str, length: int, gap: float) -> list[tuple[str, float]]:
        """Readings of a run of one sign; ``gap`` is the chance that it stands between words."""
        if sign == MASK:
            return [(x, math.log((1 - gap) / 27)) for x in "abcdefghijklmnopqrstuvwxyz"] + [("", math.log((1 - gap) / 27)), (" ", math.log(gap))]
        looks = LOOKS.get(sign, "")
        times = (1,) if length == 1 else (1, 2)
        read = [(x * k, math.log((1 - gap) / len(looks) / len(times))) for x in looks for k in times]
        return [*read, (" ", math.log(gap))]

    def _lattice(self, span: str, spaced: bool) -> list[list[tuple[str, float]]]:
        columns = []
        for run in _RUN.finditer(span):
            sign, length = run[1], len(run[0])
            before, after = span[run.start() - 1 : run.start()], span[run.end() : run.end() + 1]
            if spaced and sign in _SEPARATORS:
                columns.append([("", math.log(0.8)), (" ", math.log(0.2))])
            elif sign.isalpha() and length < 3:
                columns.append([(run[0], 0.0)])
            elif sign.isalpha():
                columns.append([(sign, math.log(0.5)), (sign * 2, math.log(0.5))])
            else:  # signs end a word more often than they begin one; within a word they are letters
                gap = (0.05 if before.isalnum() else 0.2) if after.isalnum() else 0.8
                columns.append(self._options(sign, length, gap))
        return columns

    def decode(self, span: str, spaced: bool) -> str:
        """The most likely reading of a lower-case span (Viterbi; a state is the last two classes)."""
        model = self.model
        states: dict[tuple[int, int], tuple[float, tuple]] = {(0, 0): (0.0, ())}
        for column in [*self._lattice(span, spaced), [(" ", 0.0)]]:
            following: dict[tuple[int, int], tuple[float, tuple]] = {}
            for (a, b), (score, path) in states.items():
                for option, cost in column:
                    x, y, total = a, b, score + cost
                    for code in _codes(option):
                        if code or y:  # gaps after a gap cost nothing
                            total += model[x][y][code]
                            x, y = y, code
                    if (x, y) not in following or following[x, y][0] < total:
                        following[x, y] = (total, (path, option))
            states = following
        _, path = max(states.values(), key=lambda state: state[0])
        parts = []
        while path:
            path, option = path
            parts.append(option)
        return "".join(reversed(parts))

    def read(self, token: str) -> list[str]:
        """Restored words of a token, decoded as a whole."""
        if token.isalpha() and not _TRIPLE.search(token):
            return [token]
        if not _SUSPECT.search(token):
            return _WORD.findall(token)
        return _WORD.findall(self.decode(token, bool(_APART.match(token))))

    def tokens(self, text: str | None) -> list[str]:
        """The words of a text as they stand, in lower case; runs of single characters are read as one."""
        text = (text or "").lower()
        return _SPACED.sub(self._joined, text).split()

    def _joined(self, span: re.Match) -> str:
        return self.decode(span[0], True)

    def words(self, text: str | None) -> Counter:
        """Number of times that each restored word occurs."""
        found: Counter = Counter()
        for token, n in Counter(self.tokens(text)).items():
            for word in self._remembered(token):
                found[word] += n
        return found

    def _remembered(self, token: str) -> list[str]:
        words = self.known.get(token)
        if words is None:
            if len(self.known) >= self.remembered:
                self.known.clear()
            words = self.known[token] = self.read(token)
        return words

    def restore(self, text: str | None) -> str:
        """The text in lower case as its restored words."""
        return " ".join(word for token in self.tokens(text) for word in self.read(token))


def stems(word: str) -> Iterator[str]:
    """A word, and its beginnings of 3 to 10 letters where it goes on."""
    yield "=" + word
    for length in range(3, min(len(word), 11)):
        yield word[:length]


def features(words: Counter) -> set[str]:
    """Stems with the number of times they occur: once, twice, or more often."""
    counts: Counter = Counter()
    for word, n in words.items():
        for stem in stems(word):
            counts[stem] += n
    return {f"{stem}#{times}" for stem, n in counts.items() for times in range(1, min(n, 3) + 1)}


class Scorer:
    """Noisy-or over the features of a text."""

    def __init__(self, model: np.ndarray, weights: dict[str, float], base: float) -> None:
        self.restorer, self.base = Restorer(model), base
        self.levels: dict[str, list[tuple[int, float]]] = {}
        for feature, weight in weights.items():
            stem, _, times = feature.rpartition("#")
            self.levels.setdefault(stem, []).append((int(times), weight))
        self.clean: set[str] = set()
        self.marked: dict[str, list[str]] = {}

    def _marked(self, token: str) -> list[str]:
        """Stems that count in a token; remembered."""
        found = self.marked.get(token)
        if found is None:
            if len(self.clean) + len(self.marked) >= self.restorer.remembered:
                self.clean.clear()
                self.marked.clear()
            found = [stem for word in self.restorer.read(token) for stem in stems(word) if stem in self.levels]
            if found:
                self.marked[token] = found
            else:
                self.clean.add(token)
        return found

    def score(self, text: str | None) -> float:
        tokens = self.restorer.tokens(text)
        counts: Counter = Counter()
        for token in set(tokens).difference(self.clean):
            if found := self._marked(token):
                times = tokens.count(token)
                for stem in found:
                    counts[stem] += times
        clean = 1 - self.base
        for stem in sorted(counts):
            for times, weight in self.levels[stem]:
                if counts[stem] >= times:
                    clean *= 1 - weight
        return 1 - clean


_own: dict[str, object] = {}


def _kept(key: str, make):
    """This worker's reader, made once for each model."""
    if key not in _own:
        _own.clear()
        _own[key] = make()
    return _own[key]


def training_rows(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """text and toxic of the distinct texts of about FIT_ROWS labelled rows outside the held-out quarter.

    A text with many copies counts once, and as toxic if one of them is.
    """
    known = labels.where(c("doc_id").isNotNull() & c("toxic").isNotNull() & ~held_out(c("doc_id")))
    known = known.groupBy(c("doc_id").alias("_id")).agg(F.max("toxic").alias("toxic"))
    steps = 1 << 20
    cut = min(steps, steps * FIT_ROWS // max(1, known.count()))
    sample = known.where(F.pmod(F.xxhash64("_id"), F.lit(steps)) < cut)
    return docs.join(F.broadcast(sample), c("doc_id") == c("_id")).groupBy("text").agg(F.max("toxic").alias("toxic"))


def held_out(doc_id: Column) -> Column:
    return F.coalesce(F.crc32(doc_id.cast("string")) % 4 == 2, F.lit(False))


def fit(docs: DataFrame, labels: DataFrame, model: np.ndarray) -> tuple[dict[str, float], float]:
    """Odds of the chosen features and the score of a text without any."""
    name = uuid.uuid4().hex

    def count(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        own = _kept(name, lambda: Restorer(model))
        toxic, rows = Counter(), Counter()
        for frame in frames:
            for text, label in zip(frame["text"], frame["toxic"]):
                found = features(own.words(text))
                rows.update(found)
                if label:
                    toxic.update(found)
                if len(rows) > 50_000:
                    yield pd.DataFrame([(f, toxic[f], n) for f, n in rows.items()], columns=["feature", "t", "n"])
                    toxic, rows = Counter(), Counter()
        yield pd.DataFrame([(f, toxic[f], n) for f, n in rows.items()], columns=["feature", "t", "n"])

    rows = settle(training_rows(docs, labels))
    counted = rows.mapInPandas(count, "feature string, t bigint, n bigint")
    counted = counted.groupBy("feature").agg(F.sum("t").alias("t"), F.sum("n").alias("n"))
    good = counted.where((c("t") >= SUPPORT) & (c("t") >= PRECISION * c("n")))
    listed = sorted(tuple(row) for row in good.collect())  # of the distinct texts of about FIT_ROWS rows
    numbers = {feature: i for i, (feature, _, _) in enumerate(listed)}

    def found(text: pd.Series) -> pd.Series:
        own = _kept(name, lambda: Restorer(model))
        return pd.Series([sorted(numbers[f] for f in features(own.words(t)) if f in numbers) for t in text], dtype=object)

    toxic = rows.where("toxic = 1").select(F.pandas_udf(found, "array<int>")("text").alias("f"))
    # of the same texts; those with equal features count together
    marked = [(row["f"], row["n"]) for row in toxic.groupBy("f").agg(F.count(F.lit(1)).alias("n")).collect()]
    chosen = cover(listed, marked)
    total = sum(n for _, n in marked)
    missed = sum(n for found_in, n in marked if not any(listed[f][0] in chosen for f in found_in))
    clean = max(1, rows.count() - total)
    return chosen, min(0.25, (missed + 0.1) / (missed + clean + 1))


def cover(listed: list[tuple[str, int, int]], marked: list[tuple[list[int], int]]) -> dict[str, float]:
    """Greedy choice among ``listed`` (feature, toxic texts, texts); ``marked``: the features of toxic texts, and their number.

    A text counts half as much with each choice that marks it, so that every telling word
    is found, however rare beside others, and the chance words of texts that are explained
    are not. A choice has to mark at least ``LEAST`` by that count, less the texts it
    marks wrongly. Of words with the same beginning one is chosen; of equals the most specific.
    """
    if not listed:
        return {}
    bare = [feature.rpartition("#")[0].lstrip("=") for feature, _, _ in listed]
    by_bare: dict[str, list[int]] = {}
    for i, word in enumerate(bare):
        by_bare.setdefault(word, []).append(i)
    ordered = sorted(by_bare)
    specific = np.empty(len(listed), np.int64)
    specific[sorted(range(len(listed)), key=lambda f: (len(listed[f][0]), listed[f][0]))] = range(len(listed))
    wrong = np.array([n - t for _, t, n in listed], float)
    texts = np.repeat(np.arange(len(marked)), [len(own) for own, _ in marked])
    held = np.array([f for own, _ in marked for f in own], np.int64)
    order = np.argsort(held, kind="stable")
    texts, held = texts[order], held[order]
    starts = np.searchsorted(held, np.arange(len(listed) + 1))
    weights, chosen = np.array([n for _, n in marked], float), {}
    left = np.ones(len(listed), bool)
    while left.any():
        gain = np.where(left, np.bincount(held, weights[texts], len(listed)) - wrong, -np.inf)
        if gain.max() < LEAST:
            break
        best = max(np.flatnonzero(gain == gain.max()), key=specific.__getitem__)
        feature, t, n = listed[best]
        chosen[feature] = (t + 0.5) / (n + 1)
        weights[texts[starts[best] : starts[best + 1]]] /= 2
        word = bare[best]
        alike = ordered[bisect_left(ordered, word) : bisect_left(ordered, word + chr(0x10FFFF))]
        for other in (*alike, *(word[:k] for k in range(len(word)))):
            left[by_bare.get(other, [])] = False
    return chosen


def with_score(docs: DataFrame, labels: DataFrame, name: str) -> DataFrame:
    """All columns of ``docs`` (doc_id, text) and the score, which rests on the text alone, under a name that is free."""
    texts = docs.select("doc_id", "text")
    model = language_model(texts)
    weights, base = fit(texts, labels, model)
    key = uuid.uuid4().hex

    def score(text: pd.Series) -> pd.Series:
        own = _kept(key, lambda: Scorer(model, weights, base))
        return pd.Series([own.score(t) for t in text], dtype="float64")

    return docs.withColumn(name, F.pandas_udf(score, "double")("text"))


def score(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """doc_id, held_out, score and predicted of all rows of ``docs`` (doc_id, text).

    Learns from rows of ``labels`` (doc_id, toxic) whose crc32(doc_id) mod 4 is not 2.

    Nulls: a null text is empty, and an empty text has the score of a text without any
    mark; a null doc_id is not held out; labels without doc_id or toxic are left out, and
    of several for a doc_id the highest holds. Repeated rows get the same score. Without
    labels every score is that of a text without marks, below the threshold. An empty
    table gives no rows. Other columns are ignored.
    """
    scored = with_score(docs.select("doc_id", "text"), labels, "score")
    predicted = (c("score") >= THRESHOLD).cast("int")
    return scored.select("doc_id", held_out(c("doc_id")).alias("held_out"), "score", predicted.alias("predicted"))


def keep(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The rows of ``docs`` (doc_id, text) whose score stays below the threshold, with all their columns as they are.

    Nulls, empty and long texts, ties and repeated rows as in ``score``: a null or empty
    text stays, and equal texts go or stay together. An empty table gives no rows. Other
    columns may have any names.
    """
    name = free_name(docs, "score")
    return with_score(docs, labels, name).where(c(name) < THRESHOLD).select(*(c(f"`{column}`") for column in docs.columns))
