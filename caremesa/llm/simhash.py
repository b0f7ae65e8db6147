"""Operator 5: near-duplicates by SimHash fingerprints at 4 or fewer differing bits.

Candidate search embeds a fingerprint as the bit counts of its 32 two-bit segments. The
Manhattan distance of two such vectors is a lower bound of the number of differing bits,
so linked fingerprints lie within 4 of each other. The vector is cut into blocks; a
distance of 4 touches at most 4 blocks, so the two agree on all others. Grid cells are
the values on every choice of blocks but four: any linked pair shares a cell. Inside a
cell, pairs are held against the bound and then verified on the bits.

Only distinct fingerprints enter, and a cell gives the links of a spanning forest in
place of all its pairs. Cells with many members are cut into chunks that meet pair by
pair in separate tasks.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from caremesa.llm.common import c, free_name, settle
from caremesa.llm.components import roots

BITS, SEED, WORDS = 4, 42, 4
SEGMENTS = 32
#: Members of a chunk; pairs of chunks meet in one task's memory.
CHUNK = 1024
_AT_ONCE = 65_536


def fingerprint(text: str | None) -> int:
    """64-bit SimHash of the 4-word shingles, ASCII letters in lower case."""
    words = (text or "").encode("utf-8", "surrogatepass").lower().split()  # bytes: ASCII case and white space only
    if not words:
        return 0
    whole, n = b" ".join(words), max(1, len(words) - WORDS + 1)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    starts = np.concatenate(([0], ends[:-1] + 1)).tolist()
    ends = ends[min(WORDS, len(words)) - 1 :].tolist()
    hashed = xxhash.xxh64_intdigest
    counts = np.zeros(64, np.int64)
    for at in range(0, n, _AT_ONCE):
        spans = zip(starts[at : min(at + _AT_ONCE, n)], ends[at : at + _AT_ONCE])
        part = np.array([hashed(whole[s:e], SEED) for s, e in spans], "<u8")
        counts += np.unpackbits(part.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * counts > n, bitorder="little").view("<u8")[0])


def _fingerprints(text: pd.Series) -> pd.Series:
    return pd.Series(np.array([fingerprint(t) for t in text], "<u8").view(np.int64))


def fingerprints(docs: DataFrame, *carry: str) -> DataFrame:
    """The columns in ``carry`` and ``fp``, the fingerprint as a signed 64-bit number."""
    return docs.select(*carry, F.pandas_udf(_fingerprints, "bigint")("text").alias("fp"))


def blocks_for(rows: int) -> int:
    """Number of blocks: a cell then holds few unrelated fingerprints. Any number of 5 or more gives all links.

    Bit counts of two random bits agree with a chance of 3/8, so a cell of k segments
    brings together (3/8)^k of all pairs.
    """
    for blocks in range(6, 12):
        segments = SEGMENTS * (blocks - BITS) / blocks
        if rows * 0.375**segments < 32:
            return blocks
    return 12


def _cells(blocks: int) -> Column:
    """The grid cells of ``fp``: one for each choice of blocks - 4 blocks of segments."""
    low = F.lit(0x5555555555555555)
    even, odd = c("fp").bitwiseAND(low), F.shiftrightunsigned(c("fp"), 1).bitwiseAND(low)
    counts = F.shiftleft(even.bitwiseAND(odd), 1).bitwiseOR(even.bitwiseXOR(odd))  # even + odd in each field of two bits
    cuts = [round(i * SEGMENTS / blocks) for i in range(blocks + 1)]
    masks = [((1 << 2 * cuts[i + 1]) - (1 << 2 * cuts[i])) for i in range(blocks)]
    signed = lambda x: x - (1 << 64) if x >> 63 else x
    chosen = [signed(sum(masks[i] for i in kept)) for kept in combinations(range(blocks), blocks - BITS)]
    return F.array(*[F.xxhash64(F.lit(k), counts.bitwiseAND(F.lit(mask))) for k, mask in enumerate(chosen)])


def _segment_counts(fps: np.ndarray) -> np.ndarray:
    return np.bitwise_count(np.ascontiguousarray(fps)[..., None].view(np.uint8)).astype(np.int8)


def forest(fps: np.ndarray) -> list[tuple[int, int]]:
    """Links of a spanning forest over all links among the distinct ``fps`` (unsigned)."""
    n = len(fps)
    if n <= 512:  # most cells have no link at all
        near = np.bitwise_count(fps[:, None] ^ fps[None, :]) <= BITS
        if np.count_nonzero(near) == n:
            return []
    counts, links = _segment_counts(fps), []
    waiting = np.arange(n)
    while waiting.size:
        reached, waiting = [waiting[0]], waiting[1:]
        while reached and waiting.size:
            at = reached.pop()
            found = np.abs(counts[waiting] - counts[at]).sum(axis=1, dtype=np.int16) <= BITS
            found[found] = np.bitwise_count(fps[waiting[found]] ^ fps[at]) <= BITS
            if found.any():
                hits, waiting = waiting[found], waiting[~found]
                links.extend((int(fps[at]), int(fps[hit])) for hit in hits)
                reached.extend(hits.tolist())
    return links


def _links(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Links of each run of equal (cell, i, j). Rows come sorted by these; a run may go on in the next frame."""
    rest: pd.DataFrame | None = None
    names = ["cell", "i", "j"]

    def done(frame: pd.DataFrame) -> pd.DataFrame:
        keys, fps = frame[names].to_numpy(), frame["fp"].to_numpy().view(np.uint64)
        cuts = np.flatnonzero((keys[1:] != keys[:-1]).any(axis=1)) + 1
        links: list[tuple[int, int]] = []
        for start, end in zip([0, *cuts.tolist()], [*cuts.tolist(), len(fps)]):
            if end - start > 1:
                links += forest(fps[start:end])
        return pd.DataFrame(np.array(list(set(links)), np.uint64).reshape(-1, 2).view(np.int64), columns=["a", "b"])

    for frame in frames:
        frame = frame if rest is None else pd.concat([rest, frame], ignore_index=True)
        same = (frame[names].to_numpy() == frame[names].iloc[-1].to_numpy()).all(axis=1)
        last = len(frame) - int(np.argmin(same[::-1])) if not same.all() else 0
        rest = frame.iloc[last:]
        if last:
            yield done(frame.iloc[:last])
    if rest is not None and len(rest):
        yield done(rest)


def links(distinct: DataFrame, chunk: int = CHUNK, blocks: int | None = None) -> DataFrame:
    """Verified links (a, b) among distinct fingerprints ``fp`` that connect all that belong together."""
    blocks = blocks or blocks_for(distinct.count())
    placed = settle(distinct.select(F.explode(_cells(blocks)).alias("cell"), "fp"))
    sizes = settle(placed.groupBy("cell").agg(F.count(F.lit(1)).alias("n")).where(c("n") > 1))
    chunks = F.ceil(c("n") / chunk).cast("int")
    own = F.pmod(F.xxhash64("fp", F.lit(7)), chunks).cast("int")
    other = F.explode(F.sequence(F.lit(0), chunks - 1)).alias("o")
    met = placed.join(sizes, "cell").select("cell", "fp", own.alias("k"), other)
    met = met.select("cell", F.least("k", "o").cast("bigint").alias("i"), F.greatest("k", "o").cast("bigint").alias("j"), "fp")
    parts = distinct.sparkSession.conf.get("spark.sql.shuffle.partitions")
    dealt = met.repartition(int(parts), "cell", "i", "j").sortWithinPartitions("cell", "i", "j")
    return dealt.mapInPandas(_links, "a bigint, b bigint").distinct()


def components(prints: DataFrame) -> DataFrame:
    """Each distinct ``fp`` of ``prints`` (doc_id, fp) with the smallest doc_id reachable by links.

    Returns _fp, component_id and root, the component's smallest fingerprint as a signed number.
    """
    distinct = settle(prints.groupBy("fp").agg(F.min("doc_id").alias("least")))
    linked = roots(links(distinct.select("fp")))
    joined = settle(linked.join(distinct, c("node") == c("fp")).select("root", "fp", "least"))
    least = settle(joined.groupBy("root").agg(F.min("least").alias("own")))
    member = settle(joined.join(least, "root").select(c("fp").alias("_fp"), "root", "own"))
    # a component's smallest doc_id, where its fingerprint has company, else the fingerprint's own
    own = F.when(c("root").isNull(), c("least")).otherwise(c("own")).alias("component_id")
    return settle(
        distinct.join(member, c("fp") == c("_fp"), "left").select(c("fp").alias("_fp"), own, F.coalesce("root", "fp").alias("root"))
    )


def hexadecimal(fp: Column) -> Column:
    return F.lower(F.lpad(F.hex(fp), 16, "0"))


def near_duplicates(docs: DataFrame) -> DataFrame:
    """doc_id, fingerprint (16 hex digits) and component_id of all rows of ``docs`` (doc_id, text).

    Nulls: a null text has no words, like an empty one; both have fingerprint zero, which
    links like any other. A null doc_id is never the smallest unless its component has no
    other; component_id is null then. Repeated rows give one result row each. An empty
    table gives no rows. Other columns are ignored.
    """
    prints = settle(fingerprints(docs, "doc_id"))
    found = prints.join(components(prints), c("fp") == c("_fp"))
    return found.select("doc_id", hexadecimal(c("fp")).alias("fingerprint"), "component_id")


def keep_one(docs: DataFrame) -> DataFrame:
    """One row of each component, with all columns: that of the smallest doc_id.

    Rows that share it are told apart by a 128-bit hash of all columns; equal rows count
    once. A null doc_id is larger than any other. The texts are shuffled once; what is
    decided travels as hashes. A null text has no words, like an empty one, and long texts
    are read whole. An empty table gives no rows. Other columns may have any names; columns of
    map type are not allowed.
    """
    names = [free_name(docs, "_k1"), free_name(docs, "_k2")]
    columns = [c(f"`{column}`") for column in docs.columns]
    keys = [F.xxhash64(*columns).alias(names[0]), F.xxhash64(F.lit(1), *columns).alias(names[1])]
    prints = settle(fingerprints(docs.select("doc_id", "text", *keys), "doc_id", *names))
    found = prints.join(components(prints), c("fp") == c("_fp"))
    first = F.min(F.struct(c("doc_id").isNull().alias("none"), "doc_id", *names))
    chosen = settle(found.groupBy("root").agg(first.alias("row")).select(*(f"row.{name}" for name in names)))
    return docs.select("*", *keys).dropDuplicates(names).join(chosen, names, "left_semi").select(*columns)
