"""Monthly views kept as a stored table and refreshed by months.

A monthly view is stored with one partition per month. When facts of some months have changed, only these months are
computed, from the facts that the period cut leaves, and only their partitions are replaced; all
others are neither read nor written. Months without rows lose their partition. Distinct patients are exact, as a
month is always counted whole.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable, Iterable

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from caremesa.functions import as_date
from caremesa.plans import kpis, reports, views
from caremesa.sources.tables import Tables

c = F.col
PARTITION, ADMITTED = "Month", "AdmissionDateTimeUTC"


def _admitted(tables: Tables, period: kpis.Period) -> Tables:
    """Tables with the encounters that begin in a period."""

    def load(columns: tuple[str, ...]) -> DataFrame:
        asked = dict.fromkeys((*columns, ADMITTED)) if columns else ()
        rows = kpis.within(tables.read("clinical_encounter", *asked), ADMITTED, period)
        return rows.select(*columns) if columns else rows

    return tables.replaced({"clinical_encounter": load})


#: What each monthly view is built from, the dated parents whose child facts its period cuts, and its month.
VIEWS: dict[str, tuple[Callable[[Tables, str, kpis.Period], DataFrame], tuple[str, ...], str]] = {
    "V03": (lambda t, _, p: views.clinical_utilization_monthly(_admitted(t, p)), (), "EncounterMonth"),
    "V12": (lambda t, _, p: kpis.hospital_monthly_performance(t, p), ("insurance_claim", "telehealth_virtualvisit"), "KPI_Month"),
    "V14": (lambda t, _, p: kpis.telehealth_monthly(t, p), ("telehealth_virtualvisit",), "KPI_Month"),
    "V15": (kpis.revenue_cycle_monthly, ("insurance_claim", "billing_invoice"), "KPI_Month"),
    "V16": (lambda t, _, p: kpis.claim_denial_monthly(t, p), ("insurance_claim",), "KPI_Month"),
}


def first_of(month: dt.date | str) -> dt.date:
    return as_date(month).replace(day=1)


def after(month: dt.date) -> dt.date:
    return (month + dt.timedelta(days=32)).replace(day=1)


def spans(months: Iterable[dt.date | str]) -> list[tuple[dt.date, dt.date]]:
    """Months as periods (first day, day after the last): neighbours are taken together."""
    found: list[tuple[dt.date, dt.date]] = []
    for month in sorted({first_of(month) for month in months}):
        if found and found[-1][1] == month:
            found[-1] = (found[-1][0], after(month))
        else:
            found.append((month, after(month)))
    return found


class MonthlyStore:
    """One monthly view, stored in ``folder``."""

    def __init__(self, spark: SparkSession, view: str, folder: str, as_of: str) -> None:
        self.spark, self.view, self.folder, self.as_of = spark, view, folder, as_of

    def _rows(self, tables: Tables, period: kpis.Period) -> DataFrame:
        build, parents, month = VIEWS[self.view]
        frame = kpis.within(build(reports.of_parents(tables, period, *parents), self.as_of, period), month, period)
        return frame.withColumn(PARTITION, F.date_format(month, "yyyy-MM"))

    def _write(self, rows: DataFrame, months: Iterable[str] = ()) -> set[str]:
        """Replaces the partitions of the months in ``rows``; gives those of ``months`` that have rows, counted by the write."""
        observed, wanted = Observation(), list(months)
        counts = [F.count(F.when(c(PARTITION) == month, 1)).alias(month) for month in wanted]
        # one task and one file a month, however many there are; a month has few rows
        counted = rows.repartition(PARTITION).observe(observed, F.count(F.lit(1)).alias("rows"), *counts)
        counted.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(PARTITION).parquet(self.folder)
        seen = observed.get
        return {month for month in wanted if seen[month]}

    def build(self, tables: Tables) -> None:
        """Stores all months."""
        self._write(self._rows(tables, kpis.ALWAYS))

    def refresh(self, tables: Tables, months: Iterable[dt.date | str]) -> None:
        """Computes some months anew and replaces their partitions; months without rows lose theirs."""
        for first, end in spans(months):
            own = []
            while not own or own[-1] < end:
                own.append(first if not own else after(own[-1]))
            names = [f"{month:%Y-%m}" for month in own[:-1]]
            for gone in set(names) - self._write(self._rows(tables, (first, end)), names):
                self._drop(gone)

    def _drop(self, month: str) -> None:
        path = self.spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{self.folder}/{PARTITION}={month}")
        path.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)

    def read(self, first: dt.date | str | None = None, last: dt.date | str | None = None) -> DataFrame:
        """The stored rows, or those from one month to another; other partitions are not listed as input."""
        rows = self.spark.read.parquet(self.folder)
        if first is not None:
            rows = rows.where(c(PARTITION) >= f"{first_of(first):%Y-%m}")
        if last is not None:
            rows = rows.where(c(PARTITION) <= f"{first_of(last):%Y-%m}")
        return rows.drop(PARTITION)
