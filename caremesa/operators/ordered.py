"""Exact order-dependent operators without a single-task sort.

A global window puts every row into one task, and a window over a frequent key
puts that key's rows into one task. Here the order is cut into ranges, each
range is worked on by itself, and only one small record per range is put in
sequence.
"""

from __future__ import annotations

import struct
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from caremesa.sources.shared import settled

c = F.col
#: Rows of a range, and the fewest and most ranges. Beyond the most, ranges grow; sorting them spills.
RANGE_ROWS, FEWEST, MOST = 500_000, 8, 1 << 16
#: Splits that are compared in generated code; more of them are looked up in a sorted list.
COMPARED = 64


def range_count(rows: int) -> int:
    """The number of ranges follows the number of rows."""
    return min(MOST, max(FEWEST, -(-rows // RANGE_ROWS)))


def range_splits(frame: DataFrame, column: str) -> list[float]:
    """Approximate quantiles of a numeric column: fixed cut points for a plan.

    They only set how even the ranges are; any cut points give the same result.
    """
    ranges = range_count(frame.count())
    points = [i / ranges for i in range(1, ranges)]
    return sorted(set(frame.approxQuantile(column, points, 1 / (4 * ranges))))


def range_bucket(value: Column, splits: list[float]) -> Column:
    """Number of splits at or below the value, by binary search."""

    def search(low: int, high: int) -> Column:
        if low == high:
            return F.lit(low)
        middle = (low + high) // 2
        return F.when(value < splits[middle], search(low, middle)).otherwise(search(middle + 1, high))

    if len(splits) <= COMPARED:
        return search(0, len(splits))
    width = len(splits).bit_length()
    ordered = F.array(*map(F.lit, [*splits, *[float("inf")] * ((1 << width) - len(splits))]))
    steps = F.array(*(F.lit(1 << i) for i in reversed(range(width))))
    # NULL and NaN end as in the comparisons above: NULL beyond all splits, NaN as well
    return F.when(value.isNull() | F.isnan(value.cast("double")), F.lit(len(splits))).otherwise(
        F.aggregate(steps, F.lit(0), lambda found, step: F.when(value >= F.element_at(ordered, found + step), found + step).otherwise(found))
    )


def running_total(frame: DataFrame, order: str, amount: str, name: str, total: str | None = None) -> DataFrame:
    """Running sum of ``amount`` in the order of a unique numeric column.

    One record per range is put in sequence, at most ``MOST`` of them, which is also the
    proven size of the broadcast side.
    """
    ranged = frame.withColumn("_range", range_bucket(c(order), range_splits(frame, order)))
    in_order = Window.orderBy("_range")
    offsets = (
        ranged.groupBy("_range")
        .agg(F.sum(amount).alias("_sum"))
        .select(
            "_range",
            F.coalesce(
                F.sum("_sum").over(in_order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)
            ).alias("_offset"),
            F.sum("_sum").over(in_order.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)).alias("_total"),
        )
    )
    inside = Window.partitionBy("_range").orderBy(order).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    result = (
        ranged.withColumn("_inside", F.sum(amount).over(inside))
        .join(F.broadcast(offsets), "_range")
        .withColumn(name, c("_inside") + c("_offset"))
    )
    if total is not None:
        result = result.withColumn(total, c("_total"))
    return result.drop("_range", "_inside", "_offset", "_total")


def row_numbers(frame: DataFrame, key: str, name: str = "RowNumber", total: str = "RowTotal") -> DataFrame:
    """Global row number in the order of a unique numeric key, and the row total."""
    ones = frame.withColumn("_one", F.lit(1).cast("bigint"))
    return running_total(ones, key, "_one", name, total).drop("_one")


def ranked_rows(
    frame: DataFrame, counts: str, key: str, ties: tuple[str, ...] = (),
    name: str = "RowNumber", total: str = "RowTotal",
) -> DataFrame:
    """Global row number by (counts descending, key, ties) and the row total.

    ``counts`` is a whole number per row, such as encounters per provider. Its
    distinct values are few: d different positive counts need at least d*d/2
    encounters, so the sequence over them stays small. Rows of one count are cut
    by key ranges, so a very frequent count is spread as well.
    """
    ranged = frame.withColumns({"_value": c(counts), "_range": range_bucket(c(key), range_splits(frame, key))})
    cells = ranged.groupBy("_value", "_range").agg(F.count(F.lit(1)).alias("_n"))
    before = Window.partitionBy("_value").orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    cell_offsets = cells.select("_value", "_range", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_in_value"))
    by_value = Window.orderBy(c("_value").desc())
    value_offsets = (
        cells.groupBy("_value")
        .agg(F.sum("_n").alias("_n"))
        .select(
            "_value",
            F.coalesce(F.sum("_n").over(by_value.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("_above"),
            F.sum("_n").over(by_value.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)).alias(total),
        )
    )
    inside = Window.partitionBy("_value", "_range").orderBy(key, *ties)
    return (
        ranged.withColumn("_inside", F.row_number().over(inside))
        .join(cell_offsets, ["_value", "_range"])
        .join(value_offsets, "_value")
        .withColumn(name, c("_inside") + c("_in_value") + c("_above"))
        .drop("_value", "_range", "_inside", "_in_value", "_above")
    )


def ntile(number: Column, total: Column, tiles: int) -> Column:
    """Tile of a row number: the first ``total % tiles`` tiles hold one row more."""
    size, extra = F.floor(total / tiles), total % tiles
    large = extra * (size + 1)
    in_large = F.floor((number - 1) / (size + 1)) + 1
    in_small = F.floor((number - large - 1) / F.greatest(size, F.lit(1))) + extra + 1
    return F.when(number <= large, in_large).otherwise(in_small)


#: Rows of one group and day that are worked on together; a day with more is cut into seconds.
SLICE = 1_000_000


def previous_moment(frame: DataFrame, group: str, moment: str, tie: str, name: str, slice_rows: int = SLICE) -> DataFrame:
    """Adds the previous ``moment`` of the same group; rows without one are dropped.

    Inside a day the previous row is found by a window over (group, day). The first row of a
    day takes the last moment of the group's previous day, found over one record per
    day. A day with more than ``slice_rows`` rows is cut into time slices of a second, each
    worked on alone, with the last moment carried over (``_before_in_slices``). Rows without a
    moment come first and have no predecessor, so they are left out at once. ``tie`` must be unique.
    """
    daily = frame.where(c(moment).isNotNull()).withColumn("_day", F.to_date(moment))
    over_days = Window.partitionBy(group).orderBy("_day")
    counted = daily.groupBy(group, "_day").agg(F.max(moment).alias("_last"), F.count(F.lit(1)).alias("_n"))
    days = counted.select(group, "_day", F.lag("_last").over(over_days).alias("_before"))
    hot = settled(counted.where(c("_n") > slice_rows).select(group, "_day"))  # at most one record for ``slice_rows`` rows
    inside = F.lag(moment).over(Window.partitionBy(group, "_day").orderBy(moment, tie))
    if hot.isEmpty():
        placed = daily.withColumn("_inside", inside)
    else:
        keys = [group, "_day"]
        ordinary = daily.join(hot, keys, "left_anti").withColumn("_inside", inside)
        placed = ordinary.unionByName(_before_in_slices(daily.join(hot, keys, "left_semi"), group, moment, tie))
    return (
        placed.join(days, [group, "_day"])
        .withColumn(name, F.coalesce("_inside", "_before"))
        .where(c(name).isNotNull())
        .drop("_day", "_inside", "_before")
    )


def _before_in_slices(rows: DataFrame, group: str, moment: str, tie: str) -> DataFrame:
    """Adds ``_inside``, the previous moment in the same group and day, however many rows these hold.

    Equal moments become one record; of their rows only the first by ``tie`` looks back, the
    others have the moment itself. The records of a second are put in sequence, at most a
    million, then one record per second of the day, at most 86,400.
    """
    second = F.date_trunc("second", moment)
    moments = rows.groupBy(group, "_day", second.alias("_second"), moment).agg(F.min(tie).alias("_tie"))
    in_second = F.lag(moment).over(Window.partitionBy(group, "_day", "_second").orderBy(moment))
    in_day = F.lag("_last").over(Window.partitionBy(group, "_day").orderBy("_second"))
    seconds = (
        moments.groupBy(group, "_day", "_second").agg(F.max(moment).alias("_last"))
        .select(group, "_day", "_second", in_day.alias("_carried"))
    )
    looked = (
        moments.withColumn("_back", in_second).join(seconds, [group, "_day", "_second"])
        .select(group, "_day", moment, "_tie", F.coalesce("_back", "_carried").alias("_back"))
    )
    names = rows.columns
    return rows.join(looked, [group, "_day", moment]).select(
        *names, F.when(c(tie) == c("_tie"), c("_back")).otherwise(c(moment)).alias("_inside")
    )


def latest_per_group(frame: DataFrame, group: str, order: tuple[str, ...], columns: tuple[str, ...]) -> DataFrame:
    """The row of each group that is last in ``order``; NULL sorts lowest."""
    picked = frame.groupBy(group).agg(F.max(F.struct(*order, *columns)).alias("_row"))
    return picked.select(group, *(c(f"_row.{name}").alias(name) for name in dict.fromkeys((*order, *columns))))


def earliest_per_group(frame: DataFrame, group: str, order: tuple[str, ...], columns: tuple[str, ...]) -> DataFrame:
    """The row of each group that is first in ``order``; NULL sorts lowest."""
    picked = frame.groupBy(group).agg(F.min(F.struct(*order, *columns)).alias("_row"))
    return picked.select(group, *(c(f"_row.{name}").alias(name) for name in dict.fromkeys((*order, *columns))))


# -- exact medians ----------------------------------------------------------------

#: The bits of a double below its sign and exponent, and buckets of one pass.
FRACTION, PASS_BITS = 52, 12
NAN, NOTHING = 2**63 - 1, -(2**63)


def double_bits(value: Column) -> Column:
    """Whole numbers in the order of doubles: the bits of the magnitude, negative for negative ones; NaN is the largest.

    Powers of two are exact in a double, so exponent and fraction come out exactly; the
    logarithm is off by one at most and is put right by comparison.
    """
    size = F.abs(value)
    near = F.greatest(F.floor(F.log2(size)), F.lit(-1022))
    exponent = F.when(F.pow(F.lit(2.0), near) > size, near - 1).when(F.pow(F.lit(2.0), near + 1) <= size, near + 1).otherwise(near)
    power = F.pow(F.lit(2.0), exponent.cast("double"))
    fraction = ((size / power - 1) * float(2**FRACTION)).cast("bigint")
    # below the smallest exponent the fraction stands alone, in steps of 2**-1074
    small = (size * float(2**537) * float(2**537)).cast("bigint")
    normal = F.call_function("shiftleft", (exponent + 1023).cast("bigint"), F.lit(FRACTION)) + fraction
    bits = F.when(size < 2.0**-1022, small).when(size == float("inf"), F.lit(2047 << FRACTION)).otherwise(normal)
    return F.when(value.isNull(), F.lit(None)).when(F.isnan(value), F.lit(NAN)).when(value < 0, -bits).otherwise(bits)


def bits_double(bits: int) -> float:
    """The double that has these bits."""
    if bits == NAN:
        return float("nan")
    (size,) = struct.unpack("<d", struct.pack("<q", abs(bits)))
    return -size if bits < 0 else size


@dataclass
class _Rank:
    """A rank that is looked for among the values of a column whose bits lie in [low, high]; ``rank`` counts from 0 there."""

    column: str
    rank: int
    low: int = -(2**63) + 1
    high: int = NAN

    @property
    def shift(self) -> int:
        return max(0, (self.high - self.low).bit_length() - PASS_BITS)


def medians(frame: DataFrame, columns: Sequence[str]) -> dict[str, float | None]:
    """The exact median of each numeric column, the mean of the two middle values; None for a column without values.

    Radix selection: the middle ranks of all columns are refined together. A pass reads the
    frame once, counts the values of each column by the next twelve bits of their range and
    keeps the bucket that holds the rank, with its smallest and largest value; it ends when
    these are equal. No sort, no shuffle of values: at most 4,096 counters for each column and rank.
    """
    if not columns:
        return {}
    filled = frame.agg(*(F.count(name).alias(f"n{i}") for i, name in enumerate(columns))).first()
    ranks = {
        (name, half): _Rank(name, (filled[f"n{i}"] - 1 + half) // 2)
        for i, name in enumerate(columns) if filled[f"n{i}"] for half in (0, 1)
    }
    bits = frame.select(*(double_bits(c(name).cast("double")).alias(f"b{i}") for i, name in enumerate(columns)))
    place = {name: f"b{i}" for i, name in enumerate(columns)}
    while open_ranks := [rank for rank in ranks.values() if rank.low < rank.high]:
        spans = list(dict.fromkeys((rank.column, rank.low, rank.high, rank.shift) for rank in open_ranks))
        records = []
        for i, (name, low, high, shift) in enumerate(spans):
            key = place[name]
            # the range of all doubles is wider than a whole number holds: there the sign stays with the bucket
            bucket = f"shiftright({key}, {shift})" if shift > FRACTION - 1 else f"shiftright({key} - {low}L, {shift})"
            records.append(f"if({key} between {low}L and {high}L, named_struct('span', {i}, 'bucket', {bucket}, 'bits', {key}), null)")
        counted = (
            bits.selectExpr(f"inline(array({', '.join(records)}))").where("span is not null").groupBy("span", "bucket")
            .agg(F.count(F.lit(1)).alias("n"), F.min("bits").alias("low"), F.max("bits").alias("high"))
        )
        found: dict[int, list] = {}
        for row in sorted(counted.collect()):  # at most 4,096 a span
            found.setdefault(row["span"], []).append(row)
        for rank in open_ranks:
            for row in found[spans.index((rank.column, rank.low, rank.high, rank.shift))]:
                if rank.rank < row["n"]:
                    rank.low, rank.high = row["low"], row["high"]
                    break
                rank.rank -= row["n"]
    middle = {key: bits_double(rank.low) for key, rank in ranks.items()}

    def between(one: float, two: float) -> float:
        return one if one == two else (one + two) / 2

    return {name: between(middle[name, 0], middle[name, 1]) if (name, 0) in middle else None for name in columns}
