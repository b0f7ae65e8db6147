"""Dataset profiles."""

from __future__ import annotations

from collections.abc import Mapping
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

c = F.col


def _missing(frame: DataFrame, name: str) -> Column:
    """NULL, or not-a-number in a floating column."""
    floating = dict(frame.dtypes)[name] in ("double", "float")
    return c(name).isNull() | F.isnan(name) if floating else c(name).isNull()


def _repeated(frame: DataFrame) -> DataFrame:
    """One row with the number of rows that repeat an earlier one.

    Two hashes of a row are grouped, not its columns. Only rows whose hashes occur more
    than once are compared in full.
    """
    names = frame.columns
    hashes = [F.xxhash64(*names).alias("_h1"), F.xxhash64(F.lit(1), *names).alias("_h2")]
    often = frame.select(*hashes).groupBy("_h1", "_h2").agg(F.count(F.lit(1)).alias("_n")).where("_n > 1").drop("_n")
    candidates = frame.select(*names, *hashes).join(often, ["_h1", "_h2"], "left_semi")
    equal = candidates.groupBy(*names).agg(F.count(F.lit(1)).alias("_n"))
    return equal.agg(F.coalesce(F.sum(c("_n") - 1), F.lit(0)).alias("_repeated"))


def profile(frame: DataFrame, dataset: str) -> DataFrame:
    """Rows, columns, repeated rows, missing cells and empty columns.

    Rows and missing cells are counted in a pass without a shuffle.
    """
    names = frame.columns
    missing = [F.coalesce(F.sum(_missing(frame, name).cast("int")), F.lit(0)).alias(f"_m{i}") for i, name in enumerate(names)]
    totals = frame.agg(F.count(F.lit(1)).alias("rows"), *missing)
    per_column = [c(f"_m{i}") for i in range(len(names))]
    empty = F.filter(
        F.array(*(F.when(lost == c("rows"), F.lit(name)) for lost, name in zip(per_column, names))),
        lambda name: name.isNotNull(),
    )
    return totals.select(
        F.lit(dataset).alias("dataset"),
        "rows",
        F.lit(len(names)).alias("columns"),
        _repeated(frame).scalar().alias("duplicate_rows"),
        reduce(lambda a, b: a + b, per_column).alias("missing_values"),
        F.when(F.size(empty) == 0, "None").otherwise(F.array_join(empty, ", ")).alias("empty_columns"),
    )


def validation_report(datasets: Mapping[str, DataFrame]) -> DataFrame:
    """The profiles of all datasets, by name."""
    profiles = [profile(frame, name) for name, frame in sorted(datasets.items())]
    return reduce(DataFrame.unionByName, profiles).orderBy("dataset")


def eda_summary(datasets: Mapping[str, DataFrame]) -> DataFrame:
    """The same figures without the column names."""
    return validation_report(datasets).select("dataset", "rows", "columns", "missing_values", "duplicate_rows")
