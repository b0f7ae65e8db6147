"""Operator 3: byte-level BPE encoding and decoding with DuckDB inside each task.

The pattern cuts a text into words. The bytes of each distinct word are rows (word,
place, token); a recursive query joins neighbouring rows with the merge table and
contracts each word's leftmost pair of the lowest rank, until no word has a pair left.
Ordered aggregation turns token rows into ids and, through the vocabulary, back into
bytes: the rows are sorted once, and the connection's one thread takes them in that order.

The merge table is derived from a rank file: a token may arise from any two tokens whose
bytes make up its own.
"""

from __future__ import annotations

import base64
import heapq
import os
import tempfile
import threading
from collections.abc import Iterator, Sequence
from itertools import chain

import duckdb
import numpy as np
import pandas as pd
import public_tokenizers
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

RANKS = public_tokenizers.path("byte_bpe_50k.tiktoken")
PATTERN = public_tokenizers.PATTERN
#: Characters of text that are worked on at once (a longer text alone), words a worker remembers, and bytes from
#: which a word is merged with a heap: the query's rounds grow with the longest word.
SLICE, REMEMBERED, LONG = 4_000_000, 800_000, 256
MEMORY = "512MB"

#: A row's key is the word's number, then the number of the token in the word, without gaps: the next token's key is one
#: more, so neighbours meet by a hash join. The second token of a merged pair goes, and the numbers after it drop by one.
_MERGE = """
with recursive step(key, token, final) as (
    select key, token, false from start
    union all
    select key, token, final
    from (
        with open as materialized (
            select key, token from step where not final
        ), best as (
            select a.key >> 20 as word, min(rank::bigint << 20 | (a.key & 1048575)) as pick
            from open a join open b on a.key + 1 = b.key join merges on pair = (a.token::bigint << 16 | b.token)
            group by all
        )
        select case when r.key & 1048575 > pick & 1048575 then r.key - 1 else r.key end as key, pick is null as final,
            case when r.key & 1048575 = pick & 1048575 then (pick >> 20)::integer else r.token end as token,
            (r.key & 1048575) - (pick & 1048575) as after
        from open r left join best on r.key >> 20 = best.word
    )
    where after is null or after <> 1
)
"""


class Codec:
    """A worker's DuckDB connection with the merge table, the vocabulary and the words seen so far."""

    def __init__(self, ranks_path: str, pattern: str) -> None:
        with open(ranks_path, "rb") as lines:
            self.ranks = {base64.b64decode(token): int(rank) for token, rank in (line.split() for line in lines if line.strip())}
        self.pattern = regex.compile(pattern)
        self.of_byte = np.array([self.ranks[bytes([b])] for b in range(256)], np.int32)
        spill = os.path.join(tempfile.gettempdir(), f"bpe-{os.getpid()}")  # made and emptied by DuckDB, if it spills at all
        self.db = duckdb.connect(config={"threads": 1, "memory_limit": MEMORY, "temp_directory": spill})
        pairs = [
            (first, second, rank)
            for token, rank in self.ranks.items()
            for cut in range(1, len(token))
            if (first := self.ranks.get(token[:cut])) is not None and (second := self.ranks.get(token[cut:])) is not None
        ]
        self._table("merges", pair=[first << 16 | second for first, second, _ in pairs], rank=[rank for _, _, rank in pairs])
        self._table("vocabulary", token=list(self.ranks.values()), hexed=[token.hex() for token in self.ranks])
        self._forget()

    def _table(self, name: str, **columns: list) -> None:
        self.db.register("given", pa.table(columns))
        self.db.execute(f"create table {name} as select * from given")
        self.db.unregister("given")

    def _forget(self) -> None:
        self.known: dict[str, int] = {}
        self.db.execute("create or replace table words (word integer, n bigint, ids varchar, hexed varchar)")

    def _long(self, word: bytes) -> list[int]:
        """The same merges with a heap of pairs; for words of many bytes."""
        tokens: list[bytes | None] = [word[i : i + 1] for i in range(len(word))]
        after, before = list(range(1, len(word) + 1)), list(range(-1, len(word) - 1))
        heap: list[tuple[int, int, bytes, bytes]] = []

        def offer(left: int) -> None:
            right = after[left]
            if left >= 0 and right < len(word):
                rank = self.ranks.get(tokens[left] + tokens[right])
                if rank is not None:
                    heapq.heappush(heap, (rank, left, tokens[left], tokens[right]))

        for i in range(len(word)):
            offer(i)
        while heap:
            _, left, first, second = heapq.heappop(heap)
            right = after[left]
            if tokens[left] != first or right >= len(word) or tokens[right] != second:
                continue  # one of the two has been merged since
            tokens[left], tokens[right] = first + second, None
            after[left] = after[right]
            if after[left] < len(word):
                before[after[left]] = left
            if before[left] >= 0:
                offer(before[left])
            offer(left)
        return [self.ranks[token] for token in tokens if token is not None]

    def _learn(self, words: list[str]) -> None:
        """Encodes new words and keeps their ids and decoded bytes."""
        codes = range(len(self.known), len(self.known) + len(words))
        self.known.update(zip(words, codes))
        pairs = [(code, word.encode("utf-8", "surrogatepass")) for code, word in zip(codes, words)]
        short = [(code, word) for code, word in pairs if len(word) < LONG]
        sizes = np.fromiter((len(word) for _, word in short), np.int64, len(short))
        flat = np.frombuffer(b"".join(word for _, word in short), np.uint8)
        place = np.arange(len(flat)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
        start = {
            "key": np.repeat(np.fromiter((code for code, _ in short), np.int64, len(short)), sizes) << 20 | place,
            "token": self.of_byte[flat],
        }
        long = [(code << 32 | place, token) for code, word in pairs if len(word) >= LONG for place, token in enumerate(self._long(word))]
        whole = {name: np.array([row[i] for row in long], np.int64) for i, name in enumerate(("key", "token"))}
        self.db.register("start", pa.table(start))
        self.db.register("whole", pa.table(whole))
        self.db.execute(
            f"""insert into words
            select word, count(*), string_agg(token::varchar, ' '), string_agg(hexed, '')
            from (
                select word, token, hexed
                from (
                    ({_MERGE} select key >> 20 as word, key & 1048575 as place, token from step where final)
                    union all select key >> 32, key & 4294967295, token from whole
                ) join vocabulary using (token) order by word, place
            ) group by word"""
        )

    def slice(self, texts: Sequence[str]) -> pd.DataFrame:
        """n_tokens, ids (joined by blanks) and the SHA-256 digests of ids and decoded bytes of some texts."""
        found = [self.pattern.findall(text) for text in texts]
        if len(self.known) > REMEMBERED:
            self._forget()
        new = list(set().union(*found).difference(self.known))
        if new:
            self._learn(new)
        sizes = [len(words) for words in found]
        occurrences = {
            "doc": np.repeat(np.arange(len(texts)), sizes),
            "place": np.arange(sum(sizes)),
            "word": np.fromiter(map(self.known.__getitem__, chain.from_iterable(found)), np.int32, sum(sizes)),
        }
        self.db.register("occurrences", pa.table(occurrences))
        self.db.register("docs", pa.table({"doc": np.arange(len(texts))}))
        return self.db.execute(
            """select coalesce(n, 0) as n_tokens, coalesce(ids, '') as ids, sha256(coalesce(ids, '')) as ids_sha256,
                sha256(unhex(coalesce(hexed, ''))) as decoded_sha256
            from docs left join (
                select doc, sum(n)::bigint as n, string_agg(ids, ' ') as ids, string_agg(hexed, '') as hexed
                from (select doc, n, ids, hexed from occurrences join words using (word) order by doc, place) group by doc
            ) using (doc) order by doc"""
        ).df()

    def decode(self, ids: Sequence[Sequence[int]]) -> list[bytes]:
        """The bytes of each list of ids; an id outside the vocabulary raises."""
        sizes = [len(own) for own in ids]
        flat = np.fromiter((i for own in ids for i in own), np.int32, sum(sizes))
        self.db.register("rows", pa.table({"doc": np.repeat(np.arange(len(ids)), sizes), "place": np.arange(len(flat)), "token": flat}))
        if self.db.execute("select count(*) from rows anti join vocabulary using (token)").fetchall()[0][0]:
            raise ValueError("id outside the vocabulary")
        found = dict(self.db.execute("select doc, string_agg(hexed, '' order by place) from rows join vocabulary using (token) group by doc").fetchall())
        return [bytes.fromhex(found.get(doc, "")) for doc in range(len(ids))]


_own = threading.local()


def codec(ranks_path: str, pattern: str) -> Codec:
    """This worker's codec."""
    if getattr(_own, "key", None) != (ranks_path, pattern):
        _own.key, _own.codec = (ranks_path, pattern), Codec(ranks_path, pattern)
    return _own.codec


def slices(texts: pd.Series) -> Iterator[list[str]]:
    part, size = [], 0
    for text in texts:
        text = text or ""
        if part and size + len(text) > SLICE:
            yield part
            part, size = [], 0
        part.append(text)
        size += len(text)
    if part:
        yield part


def encode(docs: DataFrame, ranks_path: str = RANKS, pattern: str = PATTERN, carry: Sequence[str] = ("doc_id",), with_ids: bool = False) -> DataFrame:
    """Encodes the whole text of all rows of ``docs`` and decodes the ids again.

    Returns the columns in ``carry``, n_tokens, ids_sha256 (of the decimal ids joined by
    one blank) and decoded_sha256 (of the decoded bytes), and with ``with_ids`` the ids.

    Nulls: a null text is empty; an empty text has no ids and the digests of no bytes.
    Words of 256 bytes and more are merged by the same rule with a heap. Repeated rows
    give a row each. An empty table gives no rows. Other columns are ignored unless
    carried; a carried column must not have a result's name.
    """
    names = ["n_tokens", "ids_sha256", "decoded_sha256", *(["ids"] if with_ids else [])]

    def digests(text: pd.Series) -> pd.DataFrame:
        own = codec(ranks_path, pattern)
        parts = [own.slice(part) for part in slices(text)]
        if not parts:
            return pd.DataFrame({name: [] for name in names})
        found = pd.concat(parts, ignore_index=True)
        if with_ids:
            found["ids"] = [[int(i) for i in ids.split()] for ids in found["ids"]]
        return found[names]

    schema = "n_tokens bigint, ids_sha256 string, decoded_sha256 string" + (", ids array<int>" if with_ids else "")
    found = docs.select(*carry, F.pandas_udf(digests, StructType.fromDDL(schema))("text").alias("_codes"))
    return found.select(*carry, "_codes.*")


def decode(rows: DataFrame, ranks_path: str = RANKS, carry: Sequence[str] = ("doc_id",)) -> DataFrame:
    """The columns in ``carry`` and ``bytes``, decoded from the array column ``ids``; null ids give null."""

    def back(ids: pd.Series) -> pd.Series:
        own = codec(ranks_path, PATTERN)
        decoded = own.decode([[] if i is None else i for i in ids])
        return pd.Series([None if i is None else b for i, b in zip(ids, decoded)], dtype=object)

    return rows.select(*carry, F.pandas_udf(back, "binary")("ids").alias("bytes"))
