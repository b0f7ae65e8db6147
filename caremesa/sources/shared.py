"""The folder that driver and executors share."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

SETTING = "spark.checkpoint.dir"


def shared_folder(spark: SparkSession, name: str = "") -> str:
    """A new folder below the one named in ``spark.checkpoint.dir``, removed when the driver ends.

    With a name, the application's one folder of that name. A folder of one machine would
    not do: executors could not see each other's files.
    """
    root = spark.conf.get(SETTING, None)
    if not root:
        raise RuntimeError(f"{SETTING} has to name a folder that the driver and all executors share")
    own = f"{spark.sparkContext.applicationId}-{name}" if name else uuid.uuid4().hex
    path = f"{root.rstrip('/')}/caremesa-{own}"
    hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    hadoop.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).deleteOnExit(hadoop)
    return path


def settled(frame: DataFrame) -> DataFrame:
    """The frame, computed once and written to the shared folder.

    Used for aggregates that are far smaller than their facts and that a plan reads in
    several jobs. The files survive lost executors.
    """
    path = shared_folder(frame.sparkSession)
    frame.write.parquet(path)
    return frame.sparkSession.read.schema(frame.schema).parquet(path)
