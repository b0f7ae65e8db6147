"""Named tables, opened lazily and with the wanted columns only."""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterable, Mapping, Sequence
from functools import partial
from urllib.parse import unquote

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DataType, StringType

# Gets the wanted columns (none: all of them) and returns just these.
Reader = Callable[[tuple[str, ...]], DataFrame]


class Tables:
    """A set of named tables.

    ``read(name, "A", "B")`` passes the wanted columns to the source, so that a
    derived table can leave out the joins that only feed other columns.
    """

    def __init__(self, spark: SparkSession, readers: Mapping[str, Reader]):
        self.spark = spark
        self._readers = dict(readers)
        self._types: dict[str, dict[str, DataType]] = {}

    def __contains__(self, name: str) -> bool:
        return name in self._readers

    @property
    def names(self) -> list[str]:
        return sorted(self._readers)

    def read(self, name: str, *columns: str) -> DataFrame:
        if name not in self._readers:
            raise KeyError(f"Unknown table: {name}")
        return self._readers[name](columns)

    def columns(self, name: str) -> list[str]:
        return self.read(name).columns

    def types(self, name: str) -> dict[str, DataType]:
        """The type of each column, by its name in lower case; found once."""
        if name not in self._types:
            self._types[name] = {field.name.lower(): field.dataType for field in self.read(name).schema}
        return self._types[name]

    def versions(self, names: Iterable[str]) -> dict[str, str]:
        """For each table a text that changes when its files, or the way they are read, change.

        It covers path, length and modification time of every file, and the plan over them. A table
        without files has the version of its plan, which covers the rows of a local frame. All files are looked
        up in one job, which reads none of them.
        """
        frames = {name: self.read(name) for name in names}
        files = {name: sorted(map(unquote, frame.inputFiles())) for name, frame in frames.items()}
        seen = _statuses(self.spark, sorted(set().union(*files.values())))
        found = {}
        for name, frame in frames.items():
            parts = [str(frame.semanticHash()), *(f"{path} {seen.get(path)}" for path in files[name])]
            found[name] = hashlib.sha256("\n".join(parts).encode()).hexdigest()[:16]
        return found

    def replaced(self, readers: Mapping[str, Reader]) -> Tables:
        """These tables, some read in another way."""
        return Tables(self.spark, self._readers | dict(readers))

    def collated(self, collation: str = "UTF8_LCASE_RTRIM") -> Tables:
        """These tables with all text compared under a collation: keys, groups and lists of labels alike.

        The default leaves case and trailing blanks out of account, as many databases do. Without
        it text is compared byte by byte.
        """

        def reader(name: str) -> Reader:
            def load(columns: tuple[str, ...]) -> DataFrame:
                frame = self.read(name, *columns)
                texts = [field.name for field in frame.schema if isinstance(field.dataType, StringType)]
                return frame.withColumns({text: F.collate(text, collation) for text in texts})

            return load

        return Tables(self.spark, {name: reader(name) for name in self._readers})

    def narrowed(self, keys: Mapping[str, tuple[str, DataFrame]]) -> Tables:
        """These tables, some cut to the rows whose key is among given ones.

        ``keys`` gives (column, frame of that column) for each table to be cut. The cut is
        a semi join at the scan, so that only rows of interest are aggregated.
        """

        def reader(name: str) -> Reader:
            column, wanted = keys[name]

            def load(columns: tuple[str, ...]) -> DataFrame:
                asked = tuple(dict.fromkeys((*columns, column))) if columns else ()
                return _narrow(self.read(name, *asked).join(wanted, column, "left_semi"), columns)

            return load

        return Tables(self.spark, self._readers | {name: reader(name) for name in keys if name in self})


def _statuses(spark: SparkSession, files: Sequence[str]) -> dict[str, str]:
    """Length and modification time of some files."""
    if not files:
        return {}
    listed = spark.read.format("binaryFile").load(list(files)).select("path", "length", "modificationTime")
    return {unquote(row["path"]): f"{row['length']} {row['modificationTime']}" for row in listed.collect()}


def _narrow(frame: DataFrame, columns: tuple[str, ...]) -> DataFrame:
    return frame.select(*columns) if columns else frame


def frame_tables(spark: SparkSession, frames: Mapping[str, DataFrame]) -> Tables:
    """Tables over DataFrames that exist already."""
    return Tables(spark, {name: partial(_narrow, frame) for name, frame in frames.items()})


def parquet_tables(spark: SparkSession, folder: str, names: Iterable[str]) -> Tables:
    """One parquet dataset per table: ``<folder>/<name>.parquet``."""

    def reader(name: str) -> Reader:
        return lambda columns: _narrow(spark.read.parquet(f"{folder.rstrip('/')}/{name}.parquet"), columns)

    return Tables(spark, {name: reader(name) for name in names})


def jdbc_tables(
    spark: SparkSession,
    url: str,
    names: Mapping[str, str],
    keys: Mapping[str, tuple[str, int, int]] | None = None,
    partitions: int = 64,
    **options: str,
) -> Tables:
    """Tables of a relational database.

    ``names`` maps the local name to the table in the database; ``keys`` gives
    (column, low, high) for tables to be fetched in parallel key ranges.
    """

    def reader(name: str) -> Reader:
        def load(columns: tuple[str, ...]) -> DataFrame:
            source = spark.read.format("jdbc").options(url=url, dbtable=names[name], **options)
            if keys and name in keys:
                column, low, high = keys[name]
                source = source.options(
                    partitionColumn=column, lowerBound=low, upperBound=high, numPartitions=partitions
                )
            return _narrow(source.load(), columns)

        return load

    return Tables(spark, {name: reader(name) for name in names})
