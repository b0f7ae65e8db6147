"""CSV extracts: sink, source and folder source."""

from __future__ import annotations

from pyspark.errors import AnalysisException, PySparkException
from pyspark.sql import DataFrame, SparkSession

from caremesa.sources.tables import Tables

# Extract names, their tables and keys.
EXTRACTS = {
    "patients": ("clinical_patient", "PatientID"),
    "encounters": ("clinical_encounter", "EncounterID"),
    "telehealth_visits": ("telehealth_virtualvisit", "VirtualVisitID"),
    "claims": ("insurance_claim", "ClaimID"),
    "invoices": ("billing_invoice", "InvoiceID"),
    "ai_predictions": ("ai_prediction", "PredictionID"),
}


def extract(tables: Tables, dataset: str, rows: int | None = None) -> DataFrame:
    """One table; with ``rows`` only the first rows by key, so that a rerun gives the same."""
    name, key = EXTRACTS[dataset]
    whole = tables.read(name)
    return whole if rows is None else whole.orderBy(key).limit(rows)


def write_csv(frame: DataFrame, folder: str, dataset: str) -> None:
    """One dataset as CSV files with headers, written in parallel."""
    frame.write.mode("overwrite").option("header", True).csv(f"{folder}/{dataset}.csv")


def export_extracts(tables: Tables, folder: str, rows: int | None = None) -> dict[str, str]:
    """All extracts. A dataset that Spark cannot plan or run is noted and the others go on."""
    outcome = {}
    for dataset in EXTRACTS:
        try:
            write_csv(extract(tables, dataset, rows), folder, dataset)
            outcome[dataset] = "SAVED"
        except (PySparkException, KeyError):
            outcome[dataset] = "FAILED"
    return outcome


def read_csv(spark: SparkSession, folder: str, dataset: str) -> DataFrame:
    """One dataset with inferred types; a missing one raises."""
    path = f"{folder}/{dataset}.csv"
    try:
        return spark.read.option("header", True).option("inferSchema", True).csv(path)
    except AnalysisException as error:
        if "PATH_NOT_FOUND" in str(error):
            raise FileNotFoundError(f"Dataset not found: {path}") from error
        raise


def dataset_names(spark: SparkSession, folder: str) -> list[str]:
    """Names of the CSV datasets of a folder, sorted."""
    hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs
    path = hadoop.Path(f"{folder}/*.csv")
    found = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).globStatus(path)
    return sorted(status.getPath().getName().removesuffix(".csv") for status in found or [])


def read_folder(spark: SparkSession, folder: str) -> dict[str, DataFrame]:
    """Every CSV dataset of a folder."""
    return {name: read_csv(spark, folder, name) for name in dataset_names(spark, folder)}
