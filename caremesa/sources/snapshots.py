"""Datasets of parquet files with a list of snapshots: readers see whole appends, writers exclude each other.

A write stages its files in a folder of its own. It becomes part of the dataset by one step: a numbered snapshot
that lists all folders is moved to its place, and the move fails if another writer has taken the number.
What a broken run has staged is never listed. A writer that comes second looks again at what the
dataset holds now, so two writers can't both add a key. The file system has to move files in one
step, as HDFS does.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable, Sequence

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType


class Conflict(RuntimeError):
    """Another writer has taken the next snapshot."""


class SnapshotDataset:
    """A dataset of one schema in ``folder``, which all writers and readers share."""

    def __init__(self, spark: SparkSession, folder: str, schema: StructType) -> None:
        self.spark, self.folder, self.schema = spark, folder.rstrip("/"), schema
        context = spark.sparkContext
        self._fs = context._jvm.org.apache.hadoop.fs
        self._conf = context._jsc.hadoopConfiguration()

    def _path(self, name: str):
        return self._fs.Path(f"{self.folder}/{name}")

    def versions(self) -> list[int]:
        """Numbers of the snapshots, in order."""
        path = self._path("snapshots/*.json")
        found = path.getFileSystem(self._conf).globStatus(path) or []
        return sorted(int(status.getPath().getName().removesuffix(".json")) for status in found)

    def folders(self, version: int | None = None) -> tuple[int, list[str]]:
        """The number of a snapshot (the last, if none is given; 0 without any) and its folders."""
        versions = self.versions()
        if not versions:
            return 0, []
        version = versions[-1] if version is None else version
        (text,) = self.spark.read.text(f"{self.folder}/snapshots/{version}.json", wholetext=True).first()
        return version, json.loads(text)

    def read(self, version: int | None = None) -> DataFrame:
        """The rows of a snapshot; later writes don't show in it."""
        _, folders = self.folders(version)
        if not folders:
            return self.spark.createDataFrame([], self.schema)
        return self.spark.read.schema(self.schema).parquet(*(f"{self.folder}/data/{name}" for name in folders))

    def stage(self, rows: DataFrame) -> str:
        """Writes rows to a folder that no snapshot lists yet."""
        name = uuid.uuid4().hex
        rows.select(*self.schema.names).write.parquet(f"{self.folder}/data/{name}")
        return name

    def commit(self, base: int, folders: Sequence[str]) -> int:
        """Makes ``folders`` the snapshot after ``base``, in one step; ``Conflict`` if there is one already."""
        staged, target = self._path(f"staged/{uuid.uuid4().hex}.json"), self._path(f"snapshots/{base + 1}.json")
        files = staged.getFileSystem(self._conf)
        files.mkdirs(target.getParent())
        out = files.create(staged, False)
        out.write(bytearray(json.dumps(list(folders)).encode()))
        out.close()
        rename = getattr(self._fs, "Options$Rename")
        never = self.spark.sparkContext._gateway.new_array(rename, 1)
        never[0] = rename.NONE
        try:
            self._fs.FileContext.getFileContext(staged.toUri(), self._conf).rename(staged, target, never)
        except Py4JJavaError as error:
            if "FileAlreadyExists" not in str(error):
                raise
            raise Conflict(f"snapshot {base + 1} has been taken") from error
        return base + 1

    def append_new(self, batch: DataFrame, keys: Sequence[str], attempts: int = 5, before_commit: Callable[[], None] = lambda: None) -> int:
        """Adds the rows of ``batch`` whose key the dataset does not hold, and gives the number of the snapshot.

        Key parts are compared like ``=``: a NULL part matches nothing. A second run adds nothing. When another
        writer was faster, the rows are looked at again. ``before_commit`` is called between write and commit.
        """
        for _ in range(attempts):
            base, folders = self.folders()
            held = self.read(base) if base else self.spark.createDataFrame([], self.schema)
            new = batch.join(held.select(*keys).distinct(), list(keys), "left_anti")
            name = self.stage(new)
            before_commit()
            try:
                return self.commit(base, [*folders, name])
            except Conflict:
                continue
        raise Conflict(f"{attempts} attempts to append to {self.folder} met other writers")

    def unlisted(self) -> list[str]:
        """Staged folders that no snapshot lists: left by broken runs, or in the making."""
        path = self._path("data/*")
        found = {status.getPath().getName() for status in path.getFileSystem(self._conf).globStatus(path) or []}
        return sorted(found.difference(*(self.folders(version)[1] for version in self.versions())))


def row_count(dataset: SnapshotDataset) -> int:
    return dataset.read().agg(F.count(F.lit(1))).scalar()
