"""Operator 10: best-fit packing of token pieces by large-item matching.

A sequence holds 1024 tokens. Pieces longer than a third of it are large: at most two of
them share a sequence, so they are matched greedily, each with the longest that still
fits. Smaller pieces then go, longest first, to the tightest gap that holds them.

Only lengths matter for that, and there are at most 1024. The plan is made on the counts
of each length: it works on runs of equal sequences at once. Its size does not grow with
the corpus. Pieces are numbered within their length and look up their place in the plan.
"""

from __future__ import annotations

import json
import threading
import zlib
from bisect import bisect_left, insort
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pandas as pd
import public_tokenizers
import tiktoken
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from caremesa.llm.common import c, each_copy, numbered, settle

CAPACITY, END = 1024, 2
#: Pieces of one length that are numbered together.
BUCKET_ROWS = 100_000
VOCABULARY = public_tokenizers.path("byte_bpe_50k.json")
PATTERN = public_tokenizers.PATTERN
_PIECE = "array<struct<piece int, start bigint, length bigint, ids_crc32 bigint>>"


def _byte_of() -> dict[str, int]:
    """Byte that a character of the vocabulary's tokens stands for: printable Latin-1 for itself, others from 256 on."""
    printable = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    others = [b for b in range(256) if b not in printable]
    return {chr(b): b for b in printable} | {chr(256 + i): b for i, b in enumerate(others)}


class Encoder:
    """Token ids of whole texts as little-endian 32-bit numbers; the string of an added token gets that token's id.

    The vocabulary's file says which tokens there are; a token's id is its rank in merging.
    tiktoken gives the same ids as the library that the file is made for, several times faster.
    """

    def __init__(self, vocabulary: str) -> None:
        with open(vocabulary, encoding="utf-8") as source:
            described = json.load(source)
        special = {token["content"]: token["id"] for token in described["added_tokens"]}
        byte_of = _byte_of()
        ranks = {bytes(map(byte_of.__getitem__, token)): i for token, i in described["model"]["vocab"].items() if token not in special}
        self.encoding = tiktoken.Encoding("packing", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens=special)

    def encode(self, text: str | None) -> bytes:
        return np.array(self.encoding.encode(text or "", allowed_special="all"), "<u4").tobytes()


_own = threading.local()


def encoder(vocabulary: str) -> Encoder:
    """This worker's encoder."""
    if getattr(_own, "name", None) != vocabulary:
        _own.name, _own.encoder = vocabulary, Encoder(vocabulary)
    return _own.encoder


def pieces_of(ids: bytes, capacity: int) -> Iterator[tuple[int, int, int, int]]:
    """piece, start, length and checksum; all pieces but the first have full length."""
    total = len(ids) // 4
    count = -(-total // capacity)
    start, end = 0, total - (count - 1) * capacity
    for piece in range(count):
        yield piece, start, end - start, zlib.crc32(ids[4 * start : 4 * end])
        start, end = end, end + capacity


def pieces(docs: DataFrame, capacity: int = CAPACITY, vocabulary: str = VOCABULARY, carry: Sequence[str] = ("doc_id",)) -> DataFrame:
    """The token pieces of all rows: the columns in ``carry``, piece, start, length, ids_crc32."""
    end = END.to_bytes(4, "little")

    def cut(text: pd.Series) -> pd.Series:
        own = encoder(vocabulary)
        return pd.Series([list(pieces_of(own.encode(t) + end, capacity)) for t in text], dtype=object)

    # not deterministic by name only: else Spark would infer a filter from the explode and run the function twice
    cutter = F.pandas_udf(cut, _PIECE).asNondeterministic()
    cut_up = docs.select(*carry, cutter("text").alias("_pieces"))
    return cut_up.select(*carry, F.explode("_pieces").alias("_piece")).select(*carry, "_piece.*")


@dataclass
class _Run:
    """``count`` sequences from ``first`` on, filled alike."""

    first: int
    count: int
    used: int = 0


class Plan:
    """Packs counts of lengths. ``places``: rows of (length, low, high, sequence, each, offset).

    Of a length, the pieces numbered low to high - 1 go to the sequences from ``sequence``
    on, ``each`` to one, the first at ``offset``.
    """

    def __init__(self, counts: dict[int, int], capacity: int = CAPACITY) -> None:
        self.left, self.capacity, self.sequences = dict(counts), capacity, 0
        self.taken = dict.fromkeys(counts, 0)
        self.places: list[tuple[int, int, int, int, int, int]] = []
        self.gaps: dict[int, list[_Run]] = {}
        self.open: list[int] = []  # the sizes of gaps that are there, sorted
        self._match_large()
        for length in sorted((x for x in self.left if 3 * x <= capacity), reverse=True):
            self._fill(length)

    def _place(self, run: _Run, length: int, each: int) -> None:
        """The next pieces of a length go into a run, ``each`` to a sequence."""
        low, number = self.taken[length], run.count * each
        self.places.append((length, low, low + number, run.first, each, run.used))
        self.taken[length] += number
        self.left[length] -= number
        run.used += each * length

    def _new(self, count: int) -> _Run:
        run = _Run(self.sequences, count)
        self.sequences += count
        return run

    def _keep(self, run: _Run) -> None:
        gap = self.capacity - run.used
        if gap and run.count:
            if gap not in self.gaps:
                self.gaps[gap] = []
                insort(self.open, gap)
            self.gaps[gap].append(run)

    def _match_large(self) -> None:
        large = sorted(x for x in self.left if 3 * x > self.capacity and self.left[x])
        while large:
            longest = large[-1]
            at = bisect_left(large, self.capacity - longest + 1) - 1
            partner = large[at] if at >= 0 else None
            if partner is None:
                run = self._new(self.left[longest])
                self._place(run, longest, 1)
            elif partner == longest and self.left[longest] > 1:
                run = self._new(self.left[longest] // 2)
                self._place(run, longest, 2)
            elif partner == longest:
                # one is left over; the next shorter one is its partner
                run = self._new(1)
                self._place(run, longest, 1)
                if at > 0:
                    self._place(run, large[at - 1], 1)
            else:
                run = self._new(min(self.left[longest], self.left[partner]))
                self._place(run, longest, 1)
                self._place(run, partner, 1)
            self._keep(run)
            large = [x for x in large if self.left[x]]

    def _fill(self, length: int) -> None:
        while self.left[length]:
            at = bisect_left(self.open, length)
            if at == len(self.open):  # no gap holds it
                each = self.capacity // length
                run = self._new(max(1, self.left[length] // each))
                self._place(run, length, min(each, self.left[length]))
                self._keep(run)
                continue
            gap = self.open[at]
            run = self.gaps[gap].pop()
            if not self.gaps[gap]:
                del self.gaps[gap], self.open[at]
            each = min(gap // length, self.left[length])
            count = min(run.count, self.left[length] // each)
            rest = _Run(run.first + count, run.count - count, run.used)
            self._keep(rest)
            run.count = count
            self._place(run, length, each)
            self._keep(run)


_PLAN = "_length bigint, _low bigint, _high bigint, _sequence bigint, _each bigint, _offset bigint"


def pack(docs: DataFrame, capacity: int = CAPACITY, vocabulary: str = VOCABULARY, carry: Sequence[str] = ("doc_id",)) -> DataFrame:
    """Every token piece of all rows of ``docs`` with its sequence and its offset there.

    Returns the columns in ``carry``, piece, start, length, ids_crc32, sequence_id and
    offset. A document's ids are those of its text and then id 2; only documents of more
    than ``capacity`` ids are cut, all pieces but the first full.

    Nulls: a null text is empty, and an empty text has one piece, the id 2 alone; a null
    doc_id is an ordinary value. Repeated rows each get places of their own; which gets
    which does not show. An empty table gives no rows. Other columns are ignored unless
    carried; a carried column must not have a result's name.

    The driver sees the counts of at most ``capacity`` lengths, and the plan, which is
    bounded by these and broadcast.
    """
    cut = settle(pieces(docs, capacity, vocabulary, carry))
    counts = {row["length"]: row["n"] for row in cut.groupBy("length").agg(F.count(F.lit(1)).alias("n")).collect()}
    buckets = max(256, -(-max(counts.values(), default=0) // BUCKET_ROWS))  # follows the most frequent length
    places = Plan(counts, capacity).places  # uses the counts up
    plan = F.broadcast(docs.sparkSession.createDataFrame(places, _PLAN))
    items = each_copy(numbered(cut, ["length"], buckets), "_number")
    found = items.join(plan, (c("length") == c("_length")) & (c("_number") >= c("_low")) & (c("_number") < c("_high")))
    within = c("_number") - c("_low")
    return found.select(
        *cut.columns,
        (c("_sequence") + F.floor(within / c("_each"))).cast("bigint").alias("sequence_id"),
        (c("_offset") + F.pmod(within, c("_each")) * c("length")).cast("bigint").alias("offset"),
    )
