"""Operator 1: reproducible shuffle into shards by a Feistel permutation.

Every row has a global number from 0 to N-1. A Feistel network permutes the
numbers: a number is written as a pair (l, r) in a rectangle of a by b cells with
a*b >= N and each round adds a hash of one half to the other half. A result outside
0..N-1 walks on through the network until it falls inside (cycle walking), which
keeps the mapping one-to-one. Position p goes to shard p mod S at slot p div S.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from caremesa.llm.common import c, each_copy, numbered

SEED = 20_240_607
ROUNDS = 4
#: The rectangle has fewer than sqrt(N) + 1 cells too many, so up to N = 4096 a walk is shorter than this for
#: certain; beyond that, a step stays outside with a chance below 1/64. A longer walk raises an error.
WALK = 63


def _network(number: Column, a: Column, b: Column, seed: int, rounds: int) -> Column:
    """One pass: a permutation of 0 .. a*b-1."""
    keys = F.array(*[F.lit(seed + i).cast("bigint") for i in range(rounds)])
    start = F.struct(F.floor(number / b).cast("bigint").alias("l"), F.pmod(number, b).alias("r"))

    def left(state: Column, key: Column) -> Column:
        return F.pmod(state["l"] + F.pmod(F.xxhash64(key, F.lit(0), state["r"]), a), a)

    def right(state: Column, key: Column) -> Column:
        return F.pmod(state["r"] + F.pmod(F.xxhash64(key, F.lit(1), state["l"]), b), b)

    def both(state: Column, key: Column) -> Column:
        half = F.struct(left(state, key).alias("l"), state["r"].alias("r"))
        return F.transform(F.array(half), lambda s: F.struct(s["l"].alias("l"), right(s, key).alias("r")))[0]

    return F.aggregate(keys, start, both, lambda s: s["l"] * b + s["r"])


def permuted(number: Column, total: Column, seed: int = SEED, rounds: int = ROUNDS) -> Column:
    """The place of ``number`` in a pseudo-random permutation of 0 .. total-1."""
    a = F.ceil(F.sqrt(total.cast("double"))).cast("bigint")
    b = F.floor((total + a - 1) / a).cast("bigint")
    state = F.struct(total.alias("n"), a.alias("a"), b.alias("b"))

    def walk(s: Column) -> Column:
        first = _network(number, s["a"], s["b"], seed, rounds)
        step = lambda x, _: F.when(x < s["n"], x).otherwise(_network(x, s["a"], s["b"], seed, rounds))
        far = lambda x: F.when(x < s["n"], x).otherwise(F.raise_error(F.lit("cycle walk too long")).cast("bigint"))
        inside = lambda x: F.when(x < s["n"], x).otherwise(F.aggregate(F.sequence(F.lit(1), F.lit(WALK)), x, step, far))
        return F.transform(F.array(first), inside)[0]

    return F.transform(F.array(state), walk)[0]


def shard(docs: DataFrame, shards: int = 24, seed: int = SEED, carry: Sequence[str] = ()) -> DataFrame:
    """Deals all rows of ``docs`` (doc_id, text) to ``shards`` shards by law ``rows``.

    Returns doc_id, size (UTF-8 bytes of the text plus 8), text_crc32, law, shard, slot
    and grown_shard, then the columns named in ``carry``. Shard counts differ by one at
    most; slots of a shard run from 0 without gaps; the same rows get the same places in
    every run, whatever the partitions. Law ``rows`` places by number, so grown_shard is
    null.

    Nulls: a null text counts no bytes and has the checksum of no bytes; a null doc_id is
    an ordinary value. Empty texts have size 8. Repeated rows each get a place of their
    own; which of them gets which does not show. An empty table gives no rows. Other
    columns are ignored unless carried; a carried column must not have a result's name.
    """
    text = F.encode(F.coalesce(c("text"), F.lit("")), "UTF-8")
    digest = docs.select(
        "doc_id",
        (F.octet_length(text) + 8).cast("bigint").alias("size"),
        F.crc32(text).alias("text_crc32"),
        F.xxhash64("text").alias("_text"),
        *carry,
    )
    placed = each_copy(numbered(digest), "_number").withColumn("_place", permuted(c("_number"), c("_total"), seed))
    return placed.select(
        "doc_id",
        "size",
        "text_crc32",
        F.lit("rows").alias("law"),
        F.pmod(c("_place"), F.lit(shards)).cast("int").alias("shard"),
        F.floor(c("_place") / shards).cast("bigint").alias("slot"),
        F.lit(None).cast("int").alias("grown_shard"),
        *carry,
    )
