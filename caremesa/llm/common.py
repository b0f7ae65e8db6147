"""Helpers shared by the corpus operators."""

from __future__ import annotations

import os
import shutil
import tempfile
from collections.abc import Sequence
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from caremesa.sources import shared

c = F.col


def shared_folder(spark: SparkSession) -> str:
    """A new folder below ``spark.checkpoint.dir``, removed when the driver ends.

    The cluster names a folder there that driver and executors share; without it an error
    is raised. Only where driver and executors are one process, as in tests, is a
    temporary folder of that machine set for the session.
    """
    if not spark.conf.get(shared.SETTING, None) and spark.sparkContext.master.startswith("local["):
        spark.conf.set(shared.SETTING, f"file://{tempfile.mkdtemp(prefix='caremesa-llm-')}")
    return shared.shared_folder(spark)


def settle(frame: DataFrame) -> DataFrame:
    """The frame as a table written once to the shared folder.

    It cuts the lineage and survives lost executors; the work behind it runs once,
    however often the result is read.
    """
    path = shared_folder(frame.sparkSession)
    frame.write.parquet(path)
    return frame.sparkSession.read.schema(frame.schema).parquet(path)


def free_name(frame: DataFrame, name: str) -> str:
    """A name like ``name`` that no column of the frame has."""
    taken = {column.lower() for column in frame.columns}
    while name.lower() in taken:
        name += "_"
    return name


def numbered(frame: DataFrame, within: Sequence[str] = (), buckets: int = 8192) -> DataFrame:
    """Numbers all rows from 0 without gaps, separately for each value of ``within``.

    The number depends on the rows alone, not on their layout. Equal rows are counted
    before the shuffle and come back as one row with ``_copies`` and the first of their
    numbers in ``_first``; ``_total`` is the number of rows that share ``within``. Each
    value of ``within`` is dealt to ``buckets`` hash buckets, so no value meets in one
    task; only the bucket sizes, at most ``buckets`` rows, are put in sequence together.
    Columns of map type cannot be numbered.
    """
    columns, keys = frame.columns, [*within, "_bucket"]
    groups = (
        frame.groupBy(*columns)
        .agg(F.count(F.lit(1)).alias("_copies"))
        .withColumn("_bucket", F.pmod(F.xxhash64(*columns), F.lit(buckets)).cast("int"))
    )
    sized = groups.groupBy(*keys).agg(F.sum("_copies").alias("_size"))
    order = Window.partitionBy(*within).orderBy("_bucket")
    starts = sized.select(
        *[c(name).alias(f"_k{i}") for i, name in enumerate(keys)],
        (F.sum("_size").over(order) - c("_size")).alias("_start"),
        F.sum("_size").over(Window.partitionBy(*within)).alias("_total"),
    )
    if not within:
        starts = F.broadcast(starts)  # at most `buckets` rows
    same = [c(name).eqNullSafe(c(f"_k{i}")) for i, name in enumerate(keys)]
    before = Window.partitionBy(*keys).orderBy(*columns).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return groups.join(starts, same).select(
        *columns,
        "_copies",
        (c("_start") + F.sum("_copies").over(before) - c("_copies")).alias("_first"),
        "_total",
    )


def each_copy(numbers: DataFrame, name: str) -> DataFrame:
    """One row per copy of what ``numbered`` gives, with its number in ``name``."""
    own = F.explode(F.sequence(c("_first"), c("_first") + c("_copies") - 1)).alias(name)
    return numbers.select("*", own).drop("_first", "_copies")


def small_batches(spark: SparkSession) -> None:
    """Keeps what a Python worker gets at once below 8 MB, unless the session sets a size of its own.

    The setting stays for the rest of the session: Spark reads it when a query runs, not when it is planned.
    """
    setting, ordinary = "spark.sql.execution.arrow.maxBytesPerBatch", 64 << 20
    if int(spark.conf.get(setting).rstrip("b")) == ordinary:
        spark.conf.set(setting, "8388608b")


_shipped: set[str] = set()


def ship_package(spark: SparkSession) -> None:
    """Gives this package to the Python workers, once per application, unless their PYTHONPATH has it."""
    root = Path(__file__).resolve().parents[2]
    context = spark.sparkContext
    paths = filter(None, os.environ.get("PYTHONPATH", "").split(os.pathsep))
    if context.applicationId in _shipped or root in [Path(path).resolve() for path in paths]:
        return
    _shipped.add(context.applicationId)
    # the driver's own folder will do: Spark hands the archive on to the executors
    context.addPyFile(shutil.make_archive(f"{tempfile.mkdtemp()}/caremesa", "zip", root, "caremesa"))


def ready(spark: SparkSession) -> None:
    """What the operators ask of a session."""
    small_batches(spark)
    ship_package(spark)


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    ready(spark)
    return spark.read.parquet(f"{folder}/{name}.parquet")
