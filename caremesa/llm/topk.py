"""Operator 6: exact top-k inner products by a bit-sliced index.

Rows are cut into blocks. A block keeps its vectors as whole numbers and, of each
component, the leading bits above the block's minimum as bitmap slices. A query adds the
slices by bitmap arithmetic: each set bit of a coefficient contributes the component's
slices, shifted, and carry-save adders sum them to the slices of a coarse score. From the
most significant slice downward the k-th best coarse score is found, then all rows whose
coarse score is within the rounding error of it. These boundary rows are scored exactly.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from caremesa.llm.common import c, settle

SCALE, K, EVERY = 1024, 10, 100
#: Rows of an index block, queries of a query block, leading bits of a component that are sliced.
BLOCK, QUERIES, BITS = 16_384, 1_024, 6
#: Components have to stay below this size after scaling.
LIMIT = 1 << 62


def whole_numbers(vectors: DataFrame) -> DataFrame:
    """vec_id, v (the components times 1024 rounded down) and copies, the number of such rows.

    Vectors that are null or hold null or non-finite components are left out; a component
    that is too large raises an error.
    """
    x = F.col("embedding")
    unfit = F.exists(x, lambda e: e.isNull() | F.isnan(e) | (F.abs(e) == float("inf")))
    too_large = F.raise_error(F.lit(f"a component is {LIMIT // SCALE} or more")).cast("bigint")

    def whole(e):
        scaled = e.cast("double") * SCALE
        return F.when(F.abs(scaled) >= float(LIMIT), too_large).otherwise(F.floor(scaled).cast("bigint"))

    fit = vectors.where(x.isNotNull() & ~unfit).select("vec_id", F.transform(x, whole).alias("v"))
    # trailing zeros say nothing: vectors that differ in them only are equal
    fit = fit.withColumn("v", F.expr("slice(v, 1, coalesce(array_max(transform(v, (x, i) -> if(x <> 0, i + 1, 0))), 0))"))
    return fit.groupBy("vec_id", "v").agg(F.count(F.lit(1)).alias("copies"))


def _matrix(vectors: pd.Series) -> np.ndarray:
    """Rows of equal width; missing components are zero."""
    width = max(1, *(len(v) for v in vectors))
    if all(len(v) == width for v in vectors):
        return np.stack(vectors.to_numpy()).astype(np.int64)
    return np.stack([np.pad(np.asarray(v, np.int64), (0, width - len(v))) for v in vectors])


def _packed(frame: pd.DataFrame) -> dict[str, object]:
    """Ids, nulls among them, copies and values of a block."""
    frame = frame.sort_values("vec_id", kind="stable", na_position="last")
    none = frame["vec_id"].isna().to_numpy()
    values = _matrix(frame["v"])
    ids, copies = frame["vec_id"].fillna(0).astype("int64").to_numpy(), frame["copies"].to_numpy(np.int64)
    return {"ids": ids.tobytes(), "none": none.tobytes(), "copies": copies.tobytes(), "width": values.shape[1], "numbers": values.tobytes()}


def slices_of(values: np.ndarray) -> tuple[np.ndarray, np.ndarray, int]:
    """Bitmaps [component, bit, word], minimum of each component, number of bits dropped."""
    low = values.min(axis=0)
    above = values.astype(np.uint64) - low.astype(np.uint64)  # a range of 64 bits fits
    dropped = max(0, int(above.max()).bit_length() - BITS)
    lead = (above >> np.uint64(dropped)).astype(np.uint8)
    rows = -(-len(values) // 64) * 64
    bits = np.zeros((values.shape[1], BITS, rows), np.uint8)
    for bit in range(BITS):
        bits[:, bit, : len(values)] = ((lead >> bit) & 1).T
    return np.packbits(bits, axis=2, bitorder="little").view(np.uint64), low, dropped


def add_slices(slices: np.ndarray, query: np.ndarray) -> list[np.ndarray]:
    """Slices of the coarse score, least significant first.

    A negative coefficient adds the complement of the component; that shifts all scores alike.
    """
    columns: dict[int, list[np.ndarray]] = {}
    for sign in (1, -1):
        sizes = np.maximum(sign * query, 0)
        for bit in range(int(sizes.max(initial=0)).bit_length()):
            chosen = np.flatnonzero(sizes >> bit & 1)
            for level in range(BITS if len(chosen) else 0):
                part = slices[chosen, level]
                columns.setdefault(bit + level, []).append(part if sign > 0 else ~part)
    result, weight, words = [], 0, slices.shape[2]
    while columns:
        parts = columns.pop(weight, None)
        stack = np.concatenate(parts) if parts else np.zeros((1, words), np.uint64)
        carried = []
        while len(stack) > 1:  # full adders: three of a weight make one of it and one of the next
            full = len(stack) // 3
            if full:
                a, b, d = stack[:full], stack[full : 2 * full], stack[2 * full : 3 * full]
                half = a ^ b
                carried.append((a & b) | (half & d))
                stack = np.concatenate((half ^ d, stack[3 * full :]))
            else:
                carried.append(stack[:1] & stack[1:2])
                stack = stack[:1] ^ stack[1:2]
        if carried:
            columns.setdefault(weight + 1, []).extend(carried)
        result.append(stack[0])
        weight += 1
    return result


def kth_score(slices: list[np.ndarray], rows: np.ndarray, k: int) -> int:
    """The k-th largest coarse score among ``rows`` (a bitmap with at least k rows)."""
    above, equal, score = np.zeros_like(rows), rows, 0
    for place in range(len(slices) - 1, -1, -1):
        ones = equal & slices[place]
        if int(np.bitwise_count(above | ones).sum()) >= k:
            equal, score = ones, score | 1 << place
        else:
            above, equal = above | ones, equal & ~slices[place]
    return score


def rows_from(slices: list[np.ndarray], rows: np.ndarray, least: int) -> np.ndarray:
    """Bitmap of the ``rows`` whose coarse score is ``least`` or more."""
    if least <= 0:
        return rows
    if least >> len(slices):
        return np.zeros_like(rows)
    above, equal = np.zeros_like(rows), rows
    for place in range(len(slices) - 1, -1, -1):
        if least >> place & 1:
            equal = equal & slices[place]
        else:
            above, equal = above | (equal & slices[place]), equal & ~slices[place]
    return above | equal


class Block:
    """A block of the index with its slices."""

    def __init__(self, ids: np.ndarray, none: np.ndarray, copies: np.ndarray, values: np.ndarray, slices: np.ndarray, dropped: int) -> None:
        self.ids, self.none, self.copies, self.values, self.slices, self.dropped = ids, none, copies, values, slices, dropped
        self.largest = int(max(abs(int(values.min(initial=0))), abs(int(values.max(initial=0)))))
        everything = np.zeros(slices.shape[2] * 64, np.uint8)
        everything[: len(ids)] = 1
        self.rows = np.packbits(everything, bitorder="little").view(np.uint64)

    def _scores(self, found: np.ndarray, query: np.ndarray) -> np.ndarray:
        """Exact scores of some rows; beyond 63 bits in whole numbers of any size."""
        if self.largest * sum(abs(int(x)) for x in query) < 1 << 63:
            return self.values[found] @ query
        return self.values[found].astype(object) @ query.astype(object)

    def best(self, query_id: int, query: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Row numbers, scores and copies of the k best distinct rows; of the query's own row, the other copies."""
        width = self.values.shape[1]
        longer = query[width:].any()  # then the block holds no such row
        query = query[:width] if len(query) >= width else np.pad(query, (0, width - len(query)))
        rows, copies = self.rows.copy(), self.copies
        own = np.flatnonzero((self.ids == query_id) & ~self.none)
        for row in () if longer else own[(self.values[own] == query).all(axis=1)]:
            copies = copies.copy()
            copies[row] -= 1
            if not copies[row]:
                rows[row // 64] &= ~np.uint64(1 << int(row) % 64)
        if int(np.bitwise_count(rows).sum()) > k:
            slices = add_slices(self.slices, query)
            error = sum(abs(int(x)) for x in query) * ((1 << self.dropped) - 1)
            rows = rows_from(slices, rows, kth_score(slices, rows, k) - (error >> self.dropped))
        found = np.flatnonzero(np.unpackbits(rows.view(np.uint8), bitorder="little"))
        scores = self._scores(found, query)
        order = np.lexsort((self.ids[found], self.none[found], -scores))[:k]
        if scores.dtype == object and any(not -(1 << 63) <= score < 1 << 63 for score in scores[order]):
            raise OverflowError("a score does not fit 64 bits")
        return found[order], scores[order].astype(np.int64), copies[found[order]]


_BLOB = "ids binary, none binary, copies binary, width int, numbers binary"


def _blocks(rows: DataFrame, name: str, number: int, index: bool) -> DataFrame:
    """One row per block; blocks are dealt by a hash of the row, so they are of nearly equal size."""

    def one(frame: pd.DataFrame) -> pd.DataFrame:
        packed = _packed(frame)
        if index:
            slices, _, dropped = slices_of(np.frombuffer(packed["numbers"], np.int64).reshape(-1, packed["width"]))
            packed |= {"slices": slices.tobytes(), "dropped": dropped}
        return pd.DataFrame([{name: int(frame["_block"].iloc[0]), **packed}])

    dealt = rows.withColumn("_block", F.pmod(F.xxhash64("vec_id", "v"), F.lit(number)).cast("int"))
    return dealt.groupBy("_block").applyInPandas(one, f"{name} int, {_BLOB}" + (", slices binary, dropped int" if index else ""))


def build_index(rows: DataFrame, number: int) -> DataFrame:
    """The bit-sliced index: one row per block."""
    return _blocks(rows, "block", number, True)


def _search(frames: Iterator[pd.DataFrame], k: int) -> Iterator[pd.DataFrame]:
    def numbers(row, prefix: str = "") -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        get = lambda name, kind: np.frombuffer(getattr(row, prefix + name), kind)
        return get("ids", np.int64), get("none", bool), get("copies", np.int64), get("numbers", np.int64).reshape(-1, getattr(row, f"{prefix}width"))

    for frame in frames:
        for row in frame.itertuples(index=False):
            ids, none, copies, values = numbers(row)
            slices = np.frombuffer(row.slices, np.uint64).reshape(values.shape[1], BITS, -1)
            block = Block(ids, none, copies, values, slices, row.dropped)
            found = []
            asked, _, times, queries = numbers(row, "q_")
            for query_id, repeated, query in zip(asked, times, queries):
                at, scores, others = block.best(int(query_id), query, k)
                key = query[: len(np.trim_zeros(query, "b"))].tobytes()
                found.append(pd.DataFrame({
                    "query_id": int(query_id), "query": [key] * len(at), "repeated": int(repeated),
                    "vec_id": pd.array(np.where(none[at], None, ids[at]), "Int64"), "score": scores, "copies": others,
                }))
            if found:
                yield pd.concat(found)


def search(vectors: DataFrame, k: int = K, every: int = EVERY, block: int = BLOCK, queries: int = QUERIES) -> DataFrame:
    """For each row of ``vectors`` (vec_id, embedding) whose id is divisible by ``every``, the k best other rows.

    Returns query_id, rank, vec_id and score: the integer inner product of the components
    times 1024 rounded down; ties go to the smaller vec_id.

    Nulls: vectors that are null or hold null or non-finite components take no part; a
    row without vec_id is a candidate, last among ties, but no query. Repeated rows are rows
    of their own: each copy is a candidate, and each copy of a query is asked and has the others
    as candidates. Rows that share a vec_id but not the vector are told apart in the same way.
    Shorter vectors are filled with zeros. Scores are exact; components of 2^52 and more and
    scores beyond 64 bits raise an error. With fewer than k other rows all are given; an
    empty table gives no rows. Other columns are ignored.

    The index is shuffled once, by block; the blocks of queries, a small part of the rows,
    are sent to each of its blocks.
    """
    rows = settle(whole_numbers(vectors))
    asked = rows.where(c("vec_id") % every == 0)
    number, sets = max(1, -(-rows.count() // block)), max(1, -(-asked.count() // queries))
    sought = _blocks(asked, "set", sets, False)
    sought = sought.select(*[c(name).alias(f"q_{name}") for name in ("ids", "none", "copies", "width", "numbers")])
    sought = sought.withColumn("block", F.explode(F.sequence(F.lit(0), F.lit(number - 1))))
    pairs = build_index(rows, number).join(sought, "block")
    found = "query_id bigint, query binary, repeated bigint, vec_id bigint, score bigint, copies bigint"
    near = pairs.mapInPandas(lambda frames: _search(frames, k), found)
    each = near.withColumn("copy", F.explode(F.sequence(F.lit(1), F.least(c("copies"), F.lit(k)).cast("int"))))  # more than k can't rank
    order = Window.partitionBy("query_id", "query").orderBy(c("score").desc(), c("vec_id").asc_nulls_last())
    ranked = each.withColumn("rank", F.row_number().over(order)).where(c("rank") <= k)
    return ranked.withColumn("copy", F.explode(F.sequence(F.lit(1), c("repeated").cast("int")))).select("query_id", "rank", "vec_id", "score")


ORACLE = """
with vectors as (
    select vec_id, row_number() over () as place, list_transform(embedding, lambda x: floor(1024 * x::double)) as v from embeddings
    where embedding is not null and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0
), scored as (
    select q.vec_id as query_id, q.place, o.vec_id as vec_id, list_inner_product(q.v, o.v)::bigint as score
    from vectors q join vectors o on q.vec_id % 100 = 0 and q.place <> o.place
)
select query_id, rank, vec_id, score
from (select *, row_number() over (partition by place order by score desc, vec_id)::integer as rank from scored)
where rank <= 10
"""
