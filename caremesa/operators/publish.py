"""Views written once, with their quality checks as a by-product of the write.

``quality.results`` plans every view for its checks. Where the views are stored anyway, the checks of rows
need no pass of their own: they ride on the write as observed metrics, and their counts are there when the write
is. Only duplicate keys are counted afterwards, over the stored key column alone.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from caremesa.functions import flag
from caremesa.operators import quality
from caremesa.sources.tables import Tables, parquet_tables

c = F.col


def publish(tables: Tables, as_of: str, folder: str, names: Iterable[str] = tuple(quality.VIEWS)) -> tuple[Tables, DataFrame]:
    """Writes views below ``folder``, and gives them as tables with one row per check as in ``quality.results``.

    A view is computed once, for its write. A failed write raises and reports nothing.
    """
    spark, today = tables.spark, quality.moment_of(as_of)
    names = list(names)
    counts: dict[int, int] = {}
    for name in names:
        view = quality.VIEWS[name]
        frame = view.build(tables, as_of)
        checks = [check for check in quality.CHECKS if check.view == name and check.issue is not None]
        observed = Observation(f"checks of {name}")
        metrics = [F.sum(flag(check.issue(today))).alias(check.id) for check in checks]
        frame.observe(observed, F.count(F.lit(1)).alias("rows"), *metrics).write.mode("overwrite").parquet(f"{folder}/{name}.parquet")
        seen = observed.get
        counts |= {check.number: seen[check.id] or 0 for check in checks}
    stored = parquet_tables(spark, folder, names)
    for check in quality.CHECKS:
        if check.view in names and check.issue is None:
            view = quality.VIEWS[check.view]
            keys = stored.read(check.view, view.key)
            keys = keys.where(c(view.key).isNotNull()) if view.skip_null_key else keys
            counts[check.number] = keys.groupBy(view.key).count().where("count > 1").count()
    listed = [(check.number, check.area, check.name, counts[check.number], check.description) for check in quality.CHECKS if check.number in counts]
    report = spark.createDataFrame(listed, "CheckID int, QualityArea string, CheckName string, IssueCount bigint, CheckDescription string")
    return stored, quality.with_status(report)
