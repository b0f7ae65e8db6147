"""Row counts and orphan lists over the base tables (D35-D43); declared rules are in ``caremesa.operators.constraints``."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from caremesa.operators.constraints import stack
from caremesa.plans.kpis import side_by_side
from caremesa.sources.tables import Tables

c = F.col

# Tables whose seed rows are counted.
SEEDED = (
    "hospital_hospital", "hospital_location", "hospital_department", "hospital_specialty", "hospital_provider",
    "hospital_providerspecialty", "clinical_medication", "insurance_payer", "insurance_insuranceplan",
    "marketing_referralsource", "marketing_audiencesegment", "ai_model", "ai_modelversion",
    "ai_featuredefinition", "ai_modelfeature",
)
# Schemas in the load summary.
LOADED_SCHEMAS = ("clinical", "telehealth", "insurance", "billing", "marketing", "ai")
# Columns of the enterprise totals.
TOTALS = {
    "Patients": "clinical_patient",
    "Encounters": "clinical_encounter",
    "TelehealthVisits": "telehealth_virtualvisit",
    "Claims": "insurance_claim",
    "Invoices": "billing_invoice",
    "Payments": "billing_payment",
    "Campaigns": "marketing_campaign",
    "Interactions": "marketing_campaigninteraction",
    "Predictions": "ai_prediction",
    "Outcomes": "ai_predictionoutcome",
}


def _count(tables: Tables, name: str, column: str) -> DataFrame:
    return tables.read(name, tables.columns(name)[0]).agg(F.count(F.lit(1)).alias(column))


def seed_counts(tables: Tables) -> DataFrame:
    """D35"""
    counts = [_count(tables, name, "RowCount").withColumn("TableName", F.lit(name)) for name in SEEDED if name in tables]
    return stack(counts).select("TableName", "RowCount").orderBy("TableName")


def schema_counts(tables: Tables) -> DataFrame:
    """D42"""
    counts = []
    for name in tables.names:
        schema, table = name.split("_", 1)
        if schema in LOADED_SCHEMAS:
            counts.append(
                _count(tables, name, "RowCount").select(
                    F.lit(schema).alias("SchemaName"), F.lit(table).alias("TableName"), "RowCount"
                )
            )
    return stack(counts).orderBy("SchemaName", "TableName")


def enterprise_totals(tables: Tables) -> DataFrame:
    """D43"""
    return side_by_side(*(_count(tables, name, column) for column, name in TOTALS.items()))


def orphan_providers(tables: Tables) -> DataFrame:
    """D36"""
    providers = tables.read("hospital_provider", "ProviderID", "ProviderCode", "HospitalID")
    return providers.join(tables.read("hospital_hospital", "HospitalID"), "HospitalID", "left_anti").select(
        "ProviderID", "ProviderCode", "HospitalID"
    )


def provider_department_mismatch(tables: Tables) -> DataFrame:
    """D37"""
    departments = tables.read("hospital_department", "DepartmentID", "HospitalID").withColumnRenamed(
        "HospitalID", "DepartmentHospitalID"
    )
    return (
        tables.read("hospital_provider", "ProviderID", "ProviderCode", "HospitalID", "DepartmentID")
        .join(departments, "DepartmentID")
        .where(c("DepartmentHospitalID") != c("HospitalID"))
        .select("ProviderID", "ProviderCode", "HospitalID", "DepartmentID", "DepartmentHospitalID")
    )


def orphan_departments(tables: Tables) -> DataFrame:
    """D38"""
    departments = tables.read("hospital_department", "DepartmentID", "DepartmentCode", "HospitalID")
    return departments.join(tables.read("hospital_hospital", "HospitalID"), "HospitalID", "left_anti").select(
        "DepartmentID", "DepartmentCode", "HospitalID"
    )


def orphan_plans(tables: Tables) -> DataFrame:
    """D39"""
    plans = tables.read("insurance_insuranceplan", "InsurancePlanID", "PlanCode", "PayerID")
    return plans.join(tables.read("insurance_payer", "PayerID"), "PayerID", "left_anti").select(
        "InsurancePlanID", "PlanCode", "PayerID"
    )


def orphan_model_versions(tables: Tables) -> DataFrame:
    """D40"""
    versions = tables.read("ai_modelversion", "ModelVersionID", "ModelID", "VersionNumber")
    return versions.join(tables.read("ai_model", "ModelID"), "ModelID", "left_anti").select(
        "ModelVersionID", "ModelID", "VersionNumber"
    )


def orphan_model_features(tables: Tables) -> DataFrame:
    """The version or the feature is missing; one pass with two existence marks."""
    versions = tables.read("ai_modelversion", "ModelVersionID").distinct().withColumn("_version", F.lit(True))
    features = tables.read("ai_featuredefinition", "FeatureDefinitionID").distinct().withColumn("_feature", F.lit(True))
    return (
        tables.read("ai_modelfeature", "ModelFeatureID", "ModelVersionID", "FeatureDefinitionID")
        .join(versions, "ModelVersionID", "left")
        .join(features, "FeatureDefinitionID", "left")
        .where(c("_version").isNull() | c("_feature").isNull())
        .select("ModelFeatureID", "ModelVersionID", "FeatureDefinitionID")
    )
