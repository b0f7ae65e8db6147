"""Operator 13: fill-in-the-middle transformation with ``pyarrow.compute`` on whole batches.

A text is cut into units: white space and the word after it, or white space at the end. Two
draws from a digest of the row's id cut the units into prefix, middle and suffix. For a
batch, the units of all texts are one flat array with the row each belongs to; ordinals
within the row give the role, the units of a role become lists again and are joined.

Both directions are narrow: no shuffle, and a batch holds at most what the session's
batch size allows, or one text.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from caremesa.llm.common import c

MARKERS = ("<P>", "<S>", "<M>")
#: One unit, over the bytes of UTF-8: white space is ASCII, so bytes and code points agree.
UNIT = rb"([\x20\x09-\x0D]*[^\x20\x09-\x0D]+|[\x20\x09-\x0D]+)"
#: A byte that no UTF-8 text holds.
BREAK = b"\xff"


def _binary(values: pa.Array) -> pa.Array:
    return pc.cast(values, pa.binary())


def _text(values: pa.Array) -> pa.Array:
    return pc.cast(values, pa.string())


def _offsets(sizes: pa.Array) -> pa.Array:
    return pa.concat_arrays([pa.array([0], pa.int32()), pc.cast(pc.cumulative_sum(sizes), pa.int32())])


def _rest(values: pa.Array, by: pa.Array) -> pa.Array:
    return pc.subtract(values, pc.multiply(pc.divide(values, by), by))


def units(texts: pa.Array) -> tuple[pa.Array, pa.Array, pa.Array, pa.Array]:
    """The number of units of each text; all units, the row and the ordinal of each."""
    lists = pc.split_pattern(pc.replace_substring_regex(texts, pattern=UNIT, replacement=rb"\1" + BREAK), pattern=BREAK)
    flat, row = pc.list_flatten(lists), pc.list_parent_indices(lists)
    held = pc.greater(pc.binary_length(flat), 0)  # each text ends with a break, after which nothing follows
    sizes = pc.cast(pc.subtract(pc.list_value_length(lists), 1), pa.int64())
    flat, row = flat.filter(held), row.filter(held)
    starts = pc.subtract(pc.cumulative_sum(sizes), sizes)
    return sizes, flat, row, pc.subtract(pa.array(np.arange(len(flat))), pc.take(starts, row))


def pieces(texts: pa.Array, first: pa.Array, second: pa.Array) -> tuple[pa.Array, list[pa.Array]]:
    """The number of units of each text, and its prefix, middle and suffix.

    ``first`` and ``second`` are draws; a draw modulo the number of units and one is a cut.
    """
    n, flat, row, ordinal = units(texts)
    ways = pc.add(n, 1)
    one, two = _rest(first, ways), _rest(second, ways)
    low, high = pc.min_element_wise(one, two), pc.max_element_wise(one, two)
    role = pc.add(
        pc.cast(pc.greater_equal(ordinal, pc.take(low, row)), pa.int8()), pc.cast(pc.greater_equal(ordinal, pc.take(high, row)), pa.int8())
    )
    parts = []
    for number, sizes in enumerate((low, pc.subtract(high, low), pc.subtract(n, high))):
        lists = pa.ListArray.from_arrays(_offsets(sizes), flat.filter(pc.equal(role, number)))
        parts.append(pc.binary_join(lists, b""))
    return n, parts


def _joined(*parts: pa.Array | bytes) -> pa.Array:
    scalars = [pa.scalar(part, pa.binary()) if isinstance(part, bytes) else part for part in parts]
    return pc.binary_join_element_wise(*scalars, pa.scalar(b"", pa.binary()))


def _checked(markers: Sequence[str]) -> list[bytes]:
    if len(set(markers)) != 3 or not all(markers):
        raise ValueError("three different markers are needed")
    for one in markers:
        for two in markers:
            if (one != two and one in two) or any(one[-k:] == two[:k] for k in range(1, min(len(one), len(two)))):
                raise ValueError(f"markers overlap: {one} {two}")  # a text beside a marker could make up another one
    return [marker.encode() for marker in markers]


def _batchwise(frame: DataFrame, carry: Sequence[str], work: Callable[[pa.RecordBatch], dict[str, pa.Array]], result: str) -> DataFrame:
    """``work`` over batches of ``frame``, in Arrow; gives the columns in ``carry`` and those of ``result``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                found = work(batch)
                yield pa.RecordBatch.from_arrays([*(batch.column(name) for name in carry), *found.values()], [*carry, *found])

    kinds = ", ".join(f"`{name}` {frame.schema[name].dataType.simpleString()}" for name in carry)
    return frame.mapInArrow(run, f"{kinds}, {result}" if kinds else result)


def transform(
    docs: DataFrame, rate: int = 50, spm: int = 80, seed: int = 42, markers: Sequence[str] = MARKERS, carry: Sequence[str] = ("doc_id",)
) -> DataFrame:
    """Rearranges ``rate`` percent of all texts for filling in the middle, ``spm`` percent of them with the suffix first.

    The draws are the 32-bit groups of the SHA-256 of ``seed``, a colon and doc_id: the
    first two choose the cuts, the third whether, the fourth in which form. Returns the
    columns in ``carry``, n (units), form (plain, psm, spm), prefix_chars, middle_chars
    (code points, null if plain) and output.

    Nulls: a null text is empty, a null doc_id counts as an empty id. Empty texts and texts
    that hold a marker stay plain, so every output can be taken apart again. Rows with
    equal ids have equal draws; repeated rows give a row each. An empty table gives no
    rows. Other columns are ignored unless carried; a carried column must not have a
    result's name. Markers that contain or overlap each other raise ``ValueError``.
    """
    signs = _checked(markers)
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(c("doc_id").cast("string"), F.lit(""))), 256)
    draws = [F.conv(F.substring(digest, 8 * i + 1, 8), 16, 10).cast("bigint") for i in range(4)]
    text = F.coalesce(c("text"), F.lit(""))
    plain = (text == "") | (F.pmod(draws[2], F.lit(100)) >= rate)
    for marker in markers:
        plain = plain | F.contains(text, F.lit(marker))
    form = F.when(plain, "plain").when(F.pmod(draws[3], F.lit(100)) < spm, "spm").otherwise("psm")
    rows = docs.select(*carry, text.alias("_text"), draws[0].alias("_first"), draws[1].alias("_second"), form.alias("_form"))

    def work(batch: pa.RecordBatch) -> dict[str, pa.Array]:
        texts, form = _binary(batch.column("_text")), batch.column("_form")
        n, (prefix, middle, suffix) = pieces(texts, batch.column("_first"), batch.column("_second"))
        plain = pc.equal(form, "plain")
        moved = pc.if_else(
            pc.equal(form, "psm"), _joined(signs[0], prefix, signs[1], suffix, signs[2], middle), _joined(signs[1], suffix, signs[0], prefix, signs[2], middle)
        )
        chars = [pc.if_else(plain, pa.scalar(None, pa.int64()), pc.cast(pc.utf8_length(_text(part)), pa.int64())) for part in (prefix, middle)]
        return {"n": n, "form": form, "prefix_chars": chars[0], "middle_chars": chars[1], "output": _text(pc.if_else(plain, texts, moved))}

    return _batchwise(rows, carry, work, "n bigint, form string, prefix_chars bigint, middle_chars bigint, output string")


def restore(rows: DataFrame, markers: Sequence[str] = MARKERS, carry: Sequence[str] = ("doc_id",)) -> DataFrame:
    """The columns in ``carry`` and ``restored``, the exact text rebuilt from the columns ``output`` and ``form`` alone.

    A null output or form gives null. An output that lacks its markers raises an error.
    """
    signs = _checked(markers)
    empty = b"".join(signs)

    def work(batch: pa.RecordBatch) -> dict[str, pa.Array]:
        output, form = _binary(batch.column("_output")), batch.column("_form")
        moved = pc.fill_null(pc.and_(pc.not_equal(form, "plain"), pc.is_valid(output)), False)
        cut = pc.if_else(moved, output, pa.scalar(empty, pa.binary()))
        for marker in signs:
            cut = pc.replace_substring(cut, pattern=marker, replacement=BREAK)
        lists = pc.split_pattern(cut, pattern=BREAK)
        if pc.any(pc.not_equal(pc.list_value_length(lists), 4)).as_py():
            raise ValueError("an output does not hold each marker once")
        one, two, middle = (pc.list_element(lists, i) for i in (1, 2, 3))
        suffix_first = pc.equal(form, "spm")
        whole = _joined(pc.if_else(suffix_first, two, one), middle, pc.if_else(suffix_first, one, two))
        known = pc.if_else(pc.is_valid(form), output, pa.scalar(None, pa.binary()))
        return {"restored": _text(pc.if_else(moved, whole, known))}

    return _batchwise(rows.select(*carry, c("output").alias("_output"), c("form").alias("_form")), carry, work, "restored string")


def digests(docs: DataFrame) -> DataFrame:
    """``transform`` and ``restore`` of all texts, with the SHA-256 digests of output and restored text in their place."""
    kept = ["doc_id", "n", "form", "prefix_chars", "middle_chars", "output"]
    back = restore(transform(docs), carry=kept)
    return back.select(*kept[:-1], F.sha2(c("output"), 256).alias("output_sha256"), F.sha2(c("restored"), 256).alias("restored_sha256"))


ORACLE = r"""
with given as (
    select doc_id, coalesce(text, '') as text, sha256('42:' || coalesce(doc_id::varchar, '')) as digest from documents
), cut as (
    select doc_id, text, regexp_extract_all(text, '[\x20\x09-\x0D]*[^\x20\x09-\x0D]+|[\x20\x09-\x0D]+') as units,
        ('0x' || substr(digest, 1, 8))::ubigint as h1, ('0x' || substr(digest, 9, 8))::ubigint as h2,
        ('0x' || substr(digest, 17, 8))::ubigint as h3, ('0x' || substr(digest, 25, 8))::ubigint as h4
    from given
), formed as (
    select doc_id, text, units, len(units)::bigint as n,
        least(h1 % (len(units) + 1), h2 % (len(units) + 1))::bigint as low, greatest(h1 % (len(units) + 1), h2 % (len(units) + 1))::bigint as high,
        case when text = '' or contains(text, '<P>') or contains(text, '<S>') or contains(text, '<M>') or h3 % 100 >= 50 then 'plain'
            when h4 % 100 < 80 then 'spm' else 'psm' end as form
    from cut
), parted as (
    select doc_id, text, n, form, array_to_string(units[1:low], '') as prefix,
        array_to_string(units[low + 1:high], '') as middle, array_to_string(units[high + 1:], '') as suffix
    from formed
)
select doc_id, n, form, case when form <> 'plain' then length(prefix) end as prefix_chars, case when form <> 'plain' then length(middle) end as middle_chars,
    sha256(case form when 'plain' then text when 'psm' then '<P>' || prefix || '<S>' || suffix || '<M>' || middle
        else '<S>' || suffix || '<P>' || prefix || '<M>' || middle end) as output_sha256,
    sha256(case form when 'plain' then text else prefix || middle || suffix end) as restored_sha256
from parted
"""
