"""Load and reshape operators."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from caremesa.operators import ordered
from caremesa.sources.snapshots import SnapshotDataset

c = F.col


def inline_values(spark: SparkSession, rows: Sequence[tuple], schema: str) -> DataFrame:
    """A small literal list as a table."""
    return spark.createDataFrame(rows, schema)


def number_series(spark: SparkSession, last: int, name: str = "n") -> DataFrame:
    """1..last, generated on the executors."""
    return spark.range(1, last + 1).withColumnRenamed("id", name)


def new_rows(batch: DataFrame, target: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows of the batch whose business key the target does not hold.

    Key parts are compared like ``=``: a NULL part matches nothing.
    """
    return batch.join(target.select(*keys).distinct(), list(keys), "left_anti").select(*batch.columns)


def append_new(batch: DataFrame, path: str, keys: Sequence[str]) -> None:
    """Idempotent append to a parquet dataset; the second run adds nothing.

    The new rows are found before the write starts. Spark commits the files of
    one append together, so a failed run leaves the old rows readable.
    """
    spark = batch.sparkSession
    target = spark.read.schema(batch.schema).parquet(path)
    new_rows(batch, target, keys).write.mode("append").parquet(path)


def append_snapshot(batch: DataFrame, dataset: SnapshotDataset, keys: Sequence[str]) -> int:
    """The same append to a dataset of snapshots; gives the number of the snapshot.

    Readers see all of an append or nothing, a broken run leaves no trace, and of two writers
    at once the second looks again.
    """
    return dataset.append_new(batch, keys)


def round_robin(frame: DataFrame, key: str, dimension: DataFrame, dimension_key: str) -> DataFrame:
    """The n-th row of the frame gets the ((n-1) mod size)-th dimension row.

    Both sides are numbered by range, never in a single task.
    """
    members = ordered.row_numbers(dimension, dimension_key, name="_member", total="_members")
    numbered = ordered.row_numbers(frame, key, name="_n", total="_rows")
    size = dimension.agg(F.count(F.lit(1)).alias("s")).scalar()
    return (
        numbered.withColumn("_member", (c("_n") - 1) % size + 1)
        .join(members.drop("_members"), "_member")
        .drop("_member", "_n", "_rows")
    )


def expand_slots(frame: DataFrame, last_slot, name: str = "slot") -> DataFrame:
    """One row per slot 0..last_slot of each row, without a theta join."""
    return frame.withColumn(name, F.explode(F.sequence(F.lit(0), last_slot.cast("int"))))


def expand_values(frame: DataFrame, values: Mapping[str, Sequence]) -> DataFrame:
    """Every row with every entry of a short literal list of columns."""
    names = list(values)
    entries = F.array(*(F.struct(*(F.lit(v).alias(n) for n, v in zip(names, row))) for row in zip(*values.values())))
    return frame.select("*", F.inline(entries))


def first_match(
    frame: DataFrame, key: str, candidates: DataFrame, order: tuple[str, ...], columns: tuple[str, ...], keep: bool = False
) -> DataFrame:
    """The first candidate of each key; ``keep`` keeps rows without one."""
    first = ordered.earliest_per_group(candidates, key, order, columns)
    return frame.join(first, key, "left" if keep else "inner")


def with_group_minimum(frame: DataFrame, keys: Sequence[str], candidates: DataFrame, value: str, name: str) -> DataFrame:
    """The least value of the row's group, by aggregate and join."""
    least = candidates.groupBy(*keys).agg(F.min(value).alias(name))
    return frame.join(least, list(keys))


def top_groups(
    frame: DataFrame, details: DataFrame, amount: str, total: str, order: str, limit: int, number: str = "rn"
) -> DataFrame:
    """The first ``limit`` groups with their total, numbered in key order.

    ``frame`` has one row per key, ``details`` the amounts. The first keys with a detail
    are a distributed top-k; only their details are summed, and only they are numbered.
    """
    with_details = frame.join(details.select(order), order, "left_semi")
    first = with_details.orderBy(order).limit(limit)
    grouped = first.join(details, order).groupBy(*frame.columns).agg(F.sum(amount).alias(total))
    return grouped.withColumn(number, F.row_number().over(Window.orderBy(order)).cast("bigint"))


def register_views(frames: Mapping[str, DataFrame]) -> list[str]:
    """Named results for ``spark.sql``; defined again on every call."""
    for name, frame in frames.items():
        frame.createOrReplaceTempView(name)
    return sorted(frames)
