"""The distributed order operators against brute force, with one hot group."""

import datetime as dt
import math
import random
import statistics
import struct

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from caremesa.operators import ordered


def test_running_total_and_row_numbers(spark):
    rng = random.Random(1)
    keys = rng.sample(range(10_000_000), 900)
    rows = [(k, rng.randint(-5, 9)) for k in keys]
    frame = spark.createDataFrame(rows, "k bigint, v bigint")
    got = {r.k: (r.upto, r.all) for r in ordered.running_total(frame, "k", "v", "upto", "all").collect()}
    total, seen = sum(v for _, v in rows), 0
    for k, v in sorted(rows):
        seen += v
        assert got[k] == (seen, total)
    numbers = {r.k: r.RowNumber for r in ordered.row_numbers(frame, "k").collect()}
    assert numbers == {k: i + 1 for i, k in enumerate(sorted(keys))}


@pytest.mark.parametrize("size", [0, 1, 3, 4, 7, 401])
def test_quartiles_equal_a_global_window(spark, size):
    rng = random.Random(size)
    # Half of the rows share one count.
    rows = [(i, 5 if rng.random() < 0.5 else rng.randint(1, 20)) for i in range(size)]
    frame = spark.createDataFrame(rows, "id bigint, n bigint")
    numbered = ordered.ranked_rows(frame, "n", "id")
    got = {r.id: (r.RowNumber, r.t) for r in numbered.withColumn("t", ordered.ntile(F.col("RowNumber"), F.col("RowTotal"), 4)).collect()}
    expected = sorted(rows, key=lambda r: (-r[1], r[0]))
    tiles = []
    for tile in range(4):
        tiles += [tile + 1] * (size // 4 + (tile < size % 4))
    assert got == {row[0]: (i + 1, tiles[i]) for i, row in enumerate(expected)}


def test_previous_moment_equals_lag(spark):
    rng = random.Random(3)
    start = dt.datetime(1999, 1, 1)
    # One person holds a third of all rows; several rows share a moment.
    rows = [
        (0 if i % 3 == 0 else rng.randint(1, 40), start + dt.timedelta(hours=rng.randint(0, 900)) if i % 17 else None, i)
        for i in range(900)
    ]
    frame = spark.createDataFrame(rows, "g bigint, t timestamp_ntz, id bigint")
    got = {r.id: r.before for r in ordered.previous_moment(frame, "g", "t", "id", "before").collect()}
    expected, last = {}, {}
    for g, t, i in sorted((r for r in rows if r[1]), key=lambda r: (r[0], r[1], r[2])):
        if g in last:
            expected[i] = last[g]
        last[g] = t
    assert got == expected


def test_one_patient_day_holds_all_rows(spark, monkeypatch):
    """A day with more rows than a slice is cut; rows share seconds, moments and days."""
    rng = random.Random(6)
    day = dt.datetime(2000, 2, 29)
    moments = [day + dt.timedelta(seconds=rng.choice([0, 1, 1, 5, 86_399]), microseconds=rng.choice([0, 1, 2, 999_999])) for _ in range(400)]
    rows = [(7, t, i) for i, t in enumerate(moments)]
    rows += [(7, day - dt.timedelta(days=1), 900), (7, day + dt.timedelta(days=2), 901), (8, day, 902), (8, day, 903), (8, None, 904)]
    frame = spark.createDataFrame(rows, "g bigint, t timestamp_ntz, id bigint")
    expected, last = {}, {}
    for g, t, i in sorted((r for r in rows if r[1]), key=lambda r: (r[0], r[1], r[2])):
        if g in last:
            expected[i] = last[g]
        last[g] = t
    for slice_rows in (100, 1, 10_000):
        found = ordered.previous_moment(frame, "g", "t", "id", "before", slice_rows)
        assert {r.id: r.before for r in found.collect()} == expected
    assert found.columns == ["g", "t", "id", "before"] or set(found.columns) == {"g", "t", "id", "before"}


def test_range_count_follows_the_rows(spark, monkeypatch):
    assert [ordered.range_count(n) for n in (0, 1_000_000, 50_000_000, 10**9, 10**15)] == [8, 8, 100, 2000, 1 << 16]
    monkeypatch.setattr(ordered, "RANGE_ROWS", 10)
    rng = random.Random(2)
    keys = [k - 2_000 for k in rng.sample(range(5_000), 1_500)]
    frame = spark.createDataFrame([(k, 2) for k in keys], "k bigint, v bigint")
    splits = ordered.range_splits(frame, "k")
    assert len(splits) > 100
    found = frame.select("k", ordered.range_bucket(F.col("k"), splits).alias("r")).collect()
    assert all(r.r == sum(s <= r.k for s in splits) for r in found)
    got = {r.k: r.upto for r in ordered.running_total(frame, "k", "v", "upto").collect()}
    assert got == {k: 2 * (i + 1) for i, k in enumerate(sorted(keys))}


AWKWARD = [0.0, -0.0, 5e-324, -5e-324, 2.0**-1022, 1e308, -1.7976931348623157e308, float("inf"), -float("inf"), 0.1, 1 / 3]


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.one_of(st.none(), st.integers(-50, 50), st.just(7), st.floats(allow_nan=False), st.sampled_from(AWKWARD)), max_size=40))
def test_medians_of_several_columns(spark, values):
    rows = [(None if v is None else float(v), None, i) for i, v in enumerate(values)]
    frame = spark.createDataFrame(rows, "x double, empty double, i int")
    present = sorted(v for v, _, _ in rows if v is not None)
    found = ordered.medians(frame, ["x", "empty", "i"])
    if present:
        one, two = present[(len(present) - 1) // 2], present[len(present) // 2]
        assert found["x"] == (one if one == two else (one + two) / 2) or (one, two) == (-float("inf"), float("inf"))
    else:
        assert found["x"] is None
    assert found["empty"] is None and found["i"] == (statistics.median(range(len(rows))) if rows else None)
    assert ordered.medians(frame, []) == {}


def test_bits_are_in_the_order_of_doubles(spark):
    rng = random.Random(1)
    values = [struct.unpack("<d", struct.pack("<Q", rng.getrandbits(64)))[0] for _ in range(2000)] + AWKWARD
    values += [2.0**k for k in range(-1074, 1024, 9)] + [math.nextafter(2.0**k, 0) for k in range(-1070, 1024, 9)]
    values = [v for v in values if not math.isnan(v)]
    frame = spark.createDataFrame([(v,) for v in values], "x double")
    bits = [r[0] for r in frame.select(ordered.double_bits(F.col("x"))).collect()]
    raw = [struct.unpack("<q", struct.pack("<d", v))[0] for v in values]
    assert bits == [b if b >= 0 else -(b & (2**63 - 1)) for b in raw]
    assert [ordered.bits_double(b) for b in bits] == values
    assert frame.select(ordered.double_bits(F.lit(float("nan")))).first()[0] == ordered.NAN and math.isnan(ordered.bits_double(ordered.NAN))


def test_first_and_last_of_group(spark):
    frame = spark.createDataFrame([(1, 5, "a"), (1, 7, "b"), (1, None, "c"), (2, 1, "d")], "g int, o int, v string")
    last = {r.g: (r.o, r.v) for r in ordered.latest_per_group(frame, "g", ("o",), ("v",)).collect()}
    first = {r.g: (r.o, r.v) for r in ordered.earliest_per_group(frame, "g", ("o",), ("v",)).collect()}
    assert last == {1: (7, "b"), 2: (1, "d")}
    assert first == {1: (None, "c"), 2: (1, "d")}
