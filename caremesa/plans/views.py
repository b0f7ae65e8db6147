"""The ten subject views.

Facts are reduced to one row per join key before they are joined, so no join
multiplies rows and a frequent key is combined on the map side first. Dimension
joins carry no broadcast hint: Spark broadcasts by measured size and falls back
to a sort-merge join, which adaptive execution splits on skew. Names of small dimensions
are attached after the joins by large keys, so those do not shuffle them.
"""

from __future__ import annotations

import datetime as dt
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from caremesa.functions import (
    age_years,
    as_date,
    flag,
    full_name,
    minutes_between,
    month_start,
    percent,
    whole_average,
    zero,
)
from caremesa.sources.tables import Tables

c = F.col
HIGH = "High Risk"


def rows() -> F.Column:
    return F.count(F.lit(1))


def count_if(condition) -> F.Column:
    return F.sum(flag(condition))


def _zeroed(frame: DataFrame, *names: str) -> DataFrame:
    return frame.withColumns({name: zero(c(name)) for name in names})


def patient_360(tables: Tables, as_of: dt.date | str, exact_paid: bool = False) -> DataFrame:
    """One row per patient (and primary active address).

    Paid amounts are allocations per invoice counted once per invoice line, as
    the published figures do; ``exact_paid`` counts each allocation once.
    """
    encounters = (
        tables.read("clinical_encounter", "PatientID", "IsTelehealth", "EncounterType", "AdmissionDateTimeUTC")
        .groupBy("PatientID")
        .agg(
            rows().alias("TotalEncounters"),
            count_if(c("IsTelehealth")).alias("TelehealthEncounters"),
            count_if(c("EncounterType") == "Emergency").alias("EmergencyEncounters"),
            F.max("AdmissionDateTimeUTC").alias("MostRecentEncounterDateUTC"),
        )
    )
    # Counted per (patient, code) first: the distinct count is then a plain count.
    diagnoses = (
        tables.read("clinical_diagnosis", "PatientID", "DiagnosisCode")
        .groupBy("PatientID", "DiagnosisCode")
        .agg(rows().alias("n"))
        .groupBy("PatientID")
        .agg(F.sum("n").alias("TotalDiagnoses"), F.count("DiagnosisCode").alias("DistinctDiagnosisCount"))
    )
    primary = c("CoveragePriority") == "Primary"
    coverage = (
        tables.read("insurance_patientcoverage", "PatientID", "InsurancePlanID", "CoveragePriority", "IsActive")
        .where("IsActive")
        .join(tables.read("insurance_insuranceplan", "InsurancePlanID", "PayerID", "PlanName"), "InsurancePlanID")
        .join(tables.read("insurance_payer", "PayerID", "PayerName"), "PayerID")
        .groupBy("PatientID")
        .agg(
            rows().alias("ActiveCoverageCount"),
            F.max(F.when(primary, c("PayerName"))).alias("PrimaryPayerName"),
            F.max(F.when(primary, c("PlanName"))).alias("PrimaryPlanName"),
        )
    )
    lines = (
        tables.read("billing_invoiceline", "InvoiceID", "LineAmount")
        .groupBy("InvoiceID")
        .agg(F.sum("LineAmount").alias("Billed"), rows().alias("Lines"))
    )
    posted = (
        tables.read("billing_paymentallocation", "InvoiceID", "AllocationStatus", "AllocatedAmount")
        .where(c("AllocationStatus") == "Posted")
        .groupBy("InvoiceID")
        .agg(F.sum("AllocatedAmount").alias("Posted"))
    )
    times = F.lit(1) if exact_paid else c("Lines")
    billing = (
        tables.read("billing_invoice", "InvoiceID", "PatientID")
        .join(lines, "InvoiceID")
        .join(posted, "InvoiceID", "left")
        .groupBy("PatientID")
        .agg(
            F.sum("Billed").cast("decimal(38,2)").alias("TotalBilledAmount"),
            F.sum(zero(c("Posted")) * times).cast("decimal(38,2)").alias("TotalPaidAmount"),
        )
    )
    predictions = (
        tables.read("ai_prediction", "PatientID", "ProbabilityScore", "PredictionDateTimeUTC")
        .groupBy("PatientID")
        .agg(
            rows().alias("PredictionCount"),
            F.max("ProbabilityScore").alias("MaximumProbabilityScore"),
            F.max("PredictionDateTimeUTC").alias("MostRecentPredictionDateUTC"),
        )
    )
    address = (
        tables.read("clinical_patientaddress", "PatientID", "City", "StateProvince", "PostalCode", "IsPrimary", "IsActive")
        .where("IsPrimary and IsActive")
        .drop("IsPrimary", "IsActive")
    )
    patients = tables.read(
        "clinical_patient", "PatientID", "MedicalRecordNumber", "FirstName", "LastName", "DateOfBirth", "Gender",
        "MaritalStatus", "PreferredLanguage", "BloodType", "IsActive",
    )
    sides = (address, encounters, diagnoses, coverage, billing, predictions)
    joined = reduce(lambda left, right: left.join(right, "PatientID", "left"), sides, patients)
    joined = _zeroed(
        joined, "TotalEncounters", "TelehealthEncounters", "EmergencyEncounters", "TotalDiagnoses",
        "DistinctDiagnosisCount", "ActiveCoverageCount", "TotalBilledAmount", "TotalPaidAmount", "PredictionCount",
    )
    return joined.select(
        "PatientID", "MedicalRecordNumber", "FirstName", "LastName", "DateOfBirth",
        age_years(c("DateOfBirth"), as_date(as_of)).alias("AgeYears"),
        "Gender", "MaritalStatus", "PreferredLanguage", "BloodType", "City", "StateProvince", "PostalCode",
        "TotalEncounters", "TelehealthEncounters", "EmergencyEncounters", "MostRecentEncounterDateUTC",
        "TotalDiagnoses", "DistinctDiagnosisCount", "ActiveCoverageCount", "PrimaryPayerName", "PrimaryPlanName",
        "TotalBilledAmount", "TotalPaidAmount",
        (c("TotalBilledAmount") - c("TotalPaidAmount")).cast("decimal(38,2)").alias("EstimatedOutstandingAmount"),
        "PredictionCount", "MaximumProbabilityScore", "MostRecentPredictionDateUTC", "IsActive",
    )


def encounter_details(tables: Tables) -> DataFrame:
    """One row per encounter with its organisation and child counts.

    The three child tables are stacked and counted in one pass, which replaces
    the child-by-child product and its distinct counts.
    """

    def child(name: str, key: str, position: int) -> DataFrame:
        ones = [F.lit(int(i == position)) for i in range(3)]
        return tables.read(name, key, "EncounterID").where(c(key).isNotNull()).select(
            "EncounterID", *(one.alias(f"n{i}") for i, one in enumerate(ones))
        )

    children = (
        child("clinical_diagnosis", "DiagnosisID", 0)
        .union(child("clinical_procedure", "ProcedureID", 1))
        .union(child("clinical_medicationorder", "MedicationOrderID", 2))
        .groupBy("EncounterID")
        .agg(
            F.sum("n0").alias("DiagnosisCount"),
            F.sum("n1").alias("ProcedureCount"),
            F.sum("n2").alias("MedicationOrderCount"),
        )
    )
    patients = tables.read("clinical_patient", "PatientID", "MedicalRecordNumber", "FirstName", "LastName").select(
        "PatientID", "MedicalRecordNumber", full_name(c("FirstName"), c("LastName")).alias("PatientName")
    )
    providers = tables.read(
        "hospital_provider", "ProviderID", "ProviderCode", "FirstName", "LastName", "ProviderType"
    ).select(
        "ProviderID", "ProviderCode", full_name(c("FirstName"), c("LastName")).alias("ProviderName"), "ProviderType"
    )
    joined = (
        tables.read(
            "clinical_encounter", "EncounterID", "EncounterNumber", "PatientID", "HospitalID", "DepartmentID",
            "ProviderID", "EncounterType", "EncounterStatus", "AdmissionDateTimeUTC", "DischargeDateTimeUTC",
            "ReasonForVisit", "Disposition", "IsTelehealth",
        )
        .join(children, "EncounterID", "left")
        .join(patients, "PatientID")
        .join(providers, "ProviderID")
        .join(tables.read("hospital_department", "DepartmentID", "DepartmentCode", "DepartmentName"), "DepartmentID")
        .join(tables.read("hospital_hospital", "HospitalID", "HospitalCode", "HospitalName"), "HospitalID")
    )
    stay = minutes_between(c("AdmissionDateTimeUTC"), c("DischargeDateTimeUTC"))
    joined = _zeroed(joined, "DiagnosisCount", "ProcedureCount", "MedicationOrderCount")
    return joined.select(
        "EncounterID", "EncounterNumber", "PatientID", "MedicalRecordNumber", "PatientName",
        "HospitalID", "HospitalCode", "HospitalName", "DepartmentID", "DepartmentCode", "DepartmentName",
        "ProviderID", "ProviderCode", "ProviderName", "ProviderType", "EncounterType", "EncounterStatus",
        "AdmissionDateTimeUTC", "DischargeDateTimeUTC",
        stay.alias("LengthOfStayMinutes"),
        (stay.cast("decimal(12,0)") / 60).cast("decimal(12,2)").alias("LengthOfStayHours"),
        "ReasonForVisit", "Disposition", "IsTelehealth",
        "DiagnosisCount", "ProcedureCount", "MedicationOrderCount",
    )


def clinical_utilization_monthly(tables: Tables) -> DataFrame:
    """Month x hospital x department x encounter type."""
    encounters = tables.read(
        "clinical_encounter", "PatientID", "HospitalID", "DepartmentID", "EncounterType", "IsTelehealth",
        "AdmissionDateTimeUTC", "DischargeDateTimeUTC",
    )
    return (
        encounters.join(tables.read("hospital_hospital", "HospitalID", "HospitalName"), "HospitalID")
        .join(tables.read("hospital_department", "DepartmentID", "DepartmentName"), "DepartmentID")
        .groupBy(
            month_start(c("AdmissionDateTimeUTC")).alias("EncounterMonth"),
            "HospitalID", "HospitalName", "DepartmentID", "DepartmentName", "EncounterType",
        )
        .agg(
            rows().alias("EncounterCount"),
            F.count_distinct("PatientID").alias("UniquePatientCount"),
            count_if(c("IsTelehealth")).alias("TelehealthEncounterCount"),
            whole_average(minutes_between(c("AdmissionDateTimeUTC"), c("DischargeDateTimeUTC"))).alias(
                "AverageLengthOfStayMinutes"
            ),
        )
    )


def telehealth_performance(tables: Tables) -> DataFrame:
    """One row per virtual visit with delays, duration and session events."""
    sessions = (
        tables.read("telehealth_sessionevent", "VirtualVisitID", "TechnicalErrorCode")
        .groupBy("VirtualVisitID")
        .agg(rows().alias("SessionEventCount"), F.count("TechnicalErrorCode").alias("TechnicalErrorCount"))
    )
    providers = tables.read("hospital_provider", "ProviderID", "FirstName", "LastName").select(
        "ProviderID", full_name(c("FirstName"), c("LastName")).alias("ProviderName")
    )
    joined = (
        tables.read("telehealth_virtualvisit")
        .join(sessions, "VirtualVisitID", "left")
        .join(tables.read("clinical_patient", "PatientID", "MedicalRecordNumber"), "PatientID")
        .join(providers, "ProviderID")
        .join(tables.read("hospital_department", "DepartmentID", "DepartmentName"), "DepartmentID")
        .join(tables.read("hospital_hospital", "HospitalID", "HospitalName"), "HospitalID")
    )
    scheduled = c("ScheduledStartDateTimeUTC")
    return joined.select(
        "VirtualVisitID", "VisitNumber", "EncounterID", "PatientID", "MedicalRecordNumber", "ProviderID",
        "ProviderName", "HospitalID", "HospitalName", "DepartmentID", "DepartmentName", "VisitType", "VisitStatus",
        "PlatformName", "PatientDeviceType", "PatientConnectionMethod", "ScheduledStartDateTimeUTC",
        "ActualStartDateTimeUTC", "ActualEndDateTimeUTC",
        minutes_between(scheduled, c("PatientJoinedDateTimeUTC")).alias("PatientJoinDelayMinutes"),
        minutes_between(scheduled, c("ProviderJoinedDateTimeUTC")).alias("ProviderJoinDelayMinutes"),
        minutes_between(c("ActualStartDateTimeUTC"), c("ActualEndDateTimeUTC")).alias("ActualVisitDurationMinutes"),
        flag(c("VisitStatus") == "Completed").alias("IsCompleted"),
        flag(c("VisitStatus") == "No Show").alias("IsNoShow"),
        flag(c("VisitStatus") == "Disconnected").alias("IsDisconnected"),
        zero(c("SessionEventCount")).alias("SessionEventCount"),
        zero(c("TechnicalErrorCount")).alias("TechnicalErrorCount"),
        "IsInterpreterRequired", "InterpreterLanguage",
    )


def _claims_with_lines(tables: Tables, *extra: F.Column) -> DataFrame:
    """Claims joined to their people, plan and payer, with line totals."""
    lines = (
        tables.read("insurance_claimline")
        .groupBy("ClaimID")
        .agg(
            rows().alias("ClaimLineCount"),
            F.sum("ChargeAmount").alias("TotalChargeAmount"),
            F.sum("AllowedAmount").alias("TotalAllowedAmount"),
            F.sum("PaidAmount").alias("TotalPaidAmount"),
            F.sum("PatientResponsibilityAmount").alias("TotalPatientResponsibilityAmount"),
            F.sum("AdjustmentAmount").alias("TotalAdjustmentAmount"),
            count_if(c("LineStatus") == "Denied").alias("DeniedLineCount"),
            *extra,
        )
    )
    coverage = (
        tables.read("insurance_patientcoverage", "PatientCoverageID", "InsurancePlanID")
        .join(tables.read("insurance_insuranceplan", "InsurancePlanID", "PayerID", "PlanName", "PlanType"), "InsurancePlanID")
        .join(tables.read("insurance_payer", "PayerID", "PayerName"), "PayerID")
    )
    providers = tables.read("hospital_provider", "ProviderID", "FirstName", "LastName").select(
        "ProviderID", full_name(c("FirstName"), c("LastName")).alias("ProviderName")
    )
    joined = (
        tables.read(
            "insurance_claim", "ClaimID", "ClaimNumber", "PatientID", "PatientCoverageID", "EncounterID",
            "ProviderID", "HospitalID", "ClaimType", "ServiceStartDate", "ServiceEndDate",
            "SubmissionDateTimeUTC", "AdjudicationDateTimeUTC", "ClaimStatus",
        )
        .join(tables.read("clinical_patient", "PatientID", "MedicalRecordNumber"), "PatientID")
        .join(coverage, "PatientCoverageID")
        .join(lines, "ClaimID", "left")
        .join(providers, "ProviderID")
        .join(tables.read("hospital_hospital", "HospitalID", "HospitalName"), "HospitalID")
    )
    return joined.withColumns(
        {
            "SubmissionLagDays": F.datediff(F.to_date("SubmissionDateTimeUTC"), c("ServiceEndDate")),
            "AdjudicationDays": F.datediff(F.to_date("AdjudicationDateTimeUTC"), F.to_date("SubmissionDateTimeUTC")),
            "IsDeniedClaim": flag((c("ClaimStatus") == "Denied") | (zero(c("DeniedLineCount")) > 0)),
            "PaidToChargePercent": percent(c("TotalPaidAmount"), c("TotalChargeAmount")),
            **{
                name: zero(c(name))
                for name in (
                    "ClaimLineCount", "TotalChargeAmount", "TotalAllowedAmount", "TotalPaidAmount",
                    "TotalPatientResponsibilityAmount", "TotalAdjustmentAmount", "DeniedLineCount",
                )
            },
        }
    )


def claim_financials(tables: Tables) -> DataFrame:
    """One row per claim with charges, payments and denial flag."""
    return _claims_with_lines(tables).select(
        "ClaimID", "ClaimNumber", "PatientID", "MedicalRecordNumber", "EncounterID", "ProviderID", "ProviderName",
        "HospitalID", "HospitalName", "PayerID", "PayerName", "InsurancePlanID", "PlanName", "PlanType", "ClaimType",
        "ServiceStartDate", "ServiceEndDate", "SubmissionDateTimeUTC", "AdjudicationDateTimeUTC",
        "SubmissionLagDays", "AdjudicationDays", "ClaimStatus", "ClaimLineCount", "TotalChargeAmount",
        "TotalAllowedAmount", "TotalPaidAmount", "TotalPatientResponsibilityAmount", "TotalAdjustmentAmount",
        "DeniedLineCount", "IsDeniedClaim", "PaidToChargePercent",
    )


def claim_denial_analysis(tables: Tables) -> DataFrame:
    """Claims with the alphabetically last denial code.

    The code is one more aggregate of the pass over the claim lines, so the
    lines are read and shuffled once instead of twice.
    """
    reason = F.max("DenialReasonCode").alias("PrimaryDenialReasonCode")
    return _claims_with_lines(tables, reason).select(
        "ClaimID", "ClaimNumber", "PatientID", "MedicalRecordNumber", "HospitalName", "ProviderName", "PayerName",
        "PlanName", "ClaimType", "ServiceStartDate", "ClaimStatus", "TotalChargeAmount", "TotalAllowedAmount",
        "TotalPaidAmount", "TotalPatientResponsibilityAmount", "DeniedLineCount", "IsDeniedClaim",
        "PrimaryDenialReasonCode", c("DeniedLineCount").alias("DeniedClaimLineCount"),
    )


def patient_billing_summary(tables: Tables, as_of: dt.date | str) -> DataFrame:
    """One row per invoice with paid, outstanding and derived status."""
    totals = (
        tables.read("billing_invoiceline", "InvoiceID", "LineAmount")
        .groupBy("InvoiceID")
        .agg(F.sum("LineAmount").alias("InvoiceAmount"))
    )
    allocated = (
        tables.read("billing_paymentallocation", "InvoiceID", "AllocationStatus", "AllocatedAmount")
        .groupBy("InvoiceID")
        .agg(F.sum(F.when(c("AllocationStatus") == "Posted", c("AllocatedAmount")).otherwise(0)).alias("PaidAmount"))
    )
    accounts = tables.read(
        "billing_patientaccount", "PatientAccountID", "AccountNumber", "IsFinancialAssistanceEligible"
    )
    patients = tables.read("clinical_patient", "PatientID", "MedicalRecordNumber", "FirstName", "LastName").select(
        "PatientID", "MedicalRecordNumber", full_name(c("FirstName"), c("LastName")).alias("PatientName")
    )
    today = F.lit(as_date(as_of))
    late = F.datediff(today, c("DueDate"))
    settled = c("OutstandingAmount") <= 0
    return (
        tables.read(
            "billing_invoice", "InvoiceID", "InvoiceNumber", "PatientAccountID", "PatientID", "InvoiceDate",
            "DueDate", "InvoiceStatus",
        )
        .join(totals, "InvoiceID")
        .join(allocated, "InvoiceID", "left")
        .join(accounts, "PatientAccountID")
        .join(patients, "PatientID")
        .withColumn("PaidAmount", zero(c("PaidAmount")))
        .withColumn("OutstandingAmount", c("InvoiceAmount") - c("PaidAmount"))
        .select(
            "InvoiceID", "InvoiceNumber", "PatientAccountID", "AccountNumber", "PatientID", "MedicalRecordNumber",
            "PatientName", "InvoiceDate", "DueDate", "InvoiceStatus", "InvoiceAmount", "PaidAmount",
            "OutstandingAmount",
            F.when(settled, "Paid")
            .when(c("DueDate") < today, "Overdue")
            .when(c("PaidAmount") > 0, "Partially Paid")
            .otherwise("Open")
            .alias("DerivedPaymentStatus"),
            F.when(settled | (late <= 0), 0).otherwise(late).alias("DaysPastDue"),
            "IsFinancialAssistanceEligible",
        )
    )


def marketing_campaign_performance(tables: Tables) -> DataFrame:
    """One row per campaign with spend, funnel and acquisition."""
    spend = (
        tables.read("marketing_campaignchannel", "CampaignID", "PlannedSpendAmount", "ActualSpendAmount")
        .groupBy("CampaignID")
        .agg(
            rows().alias("ChannelCount"),
            F.sum("PlannedSpendAmount").alias("PlannedSpendAmount"),
            F.sum("ActualSpendAmount").alias("ActualSpendAmount"),
        )
    )
    stages = ("Delivered", "Opened", "Clicked", "Converted")
    funnel = (
        tables.read("marketing_campaigninteraction", "CampaignID", "PatientID", "InteractionType")
        .groupBy("CampaignID")
        .agg(
            rows().alias("TotalInteractions"),
            F.count_distinct("PatientID").alias("ReachedPatients"),
            *(count_if(c("InteractionType") == stage).alias(f"{stage}Count") for stage in stages),
        )
    )
    acquired = (
        tables.read("marketing_patientacquisition", "CampaignID", "AcquisitionCost")
        .where(c("CampaignID").isNotNull())
        .groupBy("CampaignID")
        .agg(rows().alias("AcquiredPatientCount"), F.sum("AcquisitionCost").alias("AcquisitionCost"))
    )
    counted = (
        "ChannelCount", "PlannedSpendAmount", "ActualSpendAmount", "TotalInteractions", "ReachedPatients",
        "DeliveredCount", "OpenedCount", "ClickedCount", "ConvertedCount", "AcquiredPatientCount", "AcquisitionCost",
    )
    joined = (
        tables.read(
            "marketing_campaign", "CampaignID", "CampaignCode", "CampaignName", "CampaignType", "CampaignObjective",
            "StartDate", "EndDate", "CampaignStatus", "HospitalID", "BudgetAmount",
        )
        .join(tables.read("hospital_hospital", "HospitalID", "HospitalName"), "HospitalID", "left")
        .join(spend, "CampaignID", "left")
        .join(funnel, "CampaignID", "left")
        .join(acquired, "CampaignID", "left")
    )
    converted = c("ConvertedCount")
    return _zeroed(joined, *counted).select(
        "CampaignID", "CampaignCode", "CampaignName", "CampaignType", "CampaignObjective", "StartDate", "EndDate",
        "CampaignStatus", "HospitalID", "HospitalName", "BudgetAmount", *counted,
        percent(c("OpenedCount"), c("DeliveredCount")).alias("OpenRatePercent"),
        percent(c("ClickedCount"), c("OpenedCount")).alias("ClickThroughRatePercent"),
        percent(converted, c("TotalInteractions")).alias("ConversionRatePercent"),
        F.when(converted == 0, None)
        .otherwise((c("ActualSpendAmount") / converted).cast("decimal(18,2)"))
        .alias("CostPerConversion"),
    )


def prediction_performance(tables: Tables) -> DataFrame:
    """One row per prediction with its final outcome.

    An outcome without a class compares as unknown: it counts as incorrect and
    falls through to True Negative.
    """
    outcomes = (
        tables.read(
            "ai_predictionoutcome", "PredictionID", "PredictionOutcomeID", "OutcomeType", "ActualClass",
            "ActualValue", "OutcomeDateTimeUTC", "IsFinalOutcome",
        ).where("IsFinalOutcome")
    )
    versions = tables.read("ai_modelversion", "ModelVersionID", "ModelID", "VersionNumber", "AlgorithmName").join(
        tables.read("ai_model", "ModelID", "ModelCode", "ModelName"), "ModelID"
    )
    unknown = c("PredictionOutcomeID").isNull()
    predicted, actual = c("PredictedClass"), c("ActualClass")
    return (
        tables.read(
            "ai_prediction", "PredictionID", "ModelVersionID", "PatientID", "EncounterID", "PredictionDateTimeUTC",
            "PredictionType", "PredictedClass", "PredictedValue", "ProbabilityScore", "RiskScore", "ThresholdUsed",
            "PredictionStatus",
        )
        .join(versions, "ModelVersionID")
        .join(outcomes, "PredictionID", "left")
        .select(
            "PredictionID", "ModelID", "ModelCode", "ModelName", "ModelVersionID", "VersionNumber", "AlgorithmName",
            "PatientID", "EncounterID", "PredictionDateTimeUTC", "PredictionType", "PredictedClass",
            "PredictedValue", "ProbabilityScore", "RiskScore", "ThresholdUsed", "PredictionStatus",
            "PredictionOutcomeID", "OutcomeType", "ActualClass", "ActualValue", "OutcomeDateTimeUTC",
            "IsFinalOutcome",
            F.when(unknown, None).otherwise(flag(predicted == actual)).alias("IsCorrectPrediction"),
            F.when(unknown, None)
            .when((predicted == HIGH) & (actual == HIGH), "True Positive")
            .when((predicted == HIGH) & (actual != HIGH), "False Positive")
            .when((predicted != HIGH) & (actual == HIGH), "False Negative")
            .otherwise("True Negative")
            .alias("ConfusionMatrixCategory"),
        )
    )


def hospital_executive_summary(tables: Tables, exact_claims: bool = False) -> DataFrame:
    """One row per hospital.

    Claims are counted once per claim line, as published; ``exact_claims``
    counts each claim once. Lines are summed per claim before the join, so the
    multiplicity is a factor instead of extra rows.
    """
    encounters = (
        tables.read(
            "clinical_encounter", "HospitalID", "PatientID", "IsTelehealth", "EncounterType",
            "AdmissionDateTimeUTC", "DischargeDateTimeUTC",
        )
        .groupBy("HospitalID")
        .agg(
            rows().alias("TotalEncounters"),
            F.count_distinct("PatientID").alias("UniquePatients"),
            count_if(c("IsTelehealth")).alias("TelehealthEncounters"),
            count_if(c("EncounterType") == "Emergency").alias("EmergencyEncounters"),
            whole_average(minutes_between(c("AdmissionDateTimeUTC"), c("DischargeDateTimeUTC"))).alias(
                "AverageEncounterDurationMinutes"
            ),
        )
    )
    lines = (
        tables.read("insurance_claimline", "ClaimID", "ChargeAmount", "PaidAmount")
        .groupBy("ClaimID")
        .agg(rows().alias("n"), F.sum("ChargeAmount").alias("Charge"), F.sum("PaidAmount").alias("Paid"))
    )
    weight = F.lit(1).cast("bigint") if exact_claims else F.coalesce(c("n"), F.lit(1))
    claims = (
        tables.read("insurance_claim", "ClaimID", "HospitalID", "ClaimStatus")
        .join(lines, "ClaimID", "left")
        .groupBy("HospitalID")
        .agg(
            F.sum(weight).alias("TotalClaims"),
            F.sum(F.when(c("ClaimStatus") == "Denied", weight).otherwise(0)).alias("DeniedClaims"),
            F.sum("Charge").cast("decimal(38,2)").alias("TotalChargeAmount"),
            F.sum("Paid").cast("decimal(38,2)").alias("TotalPaidAmount"),
        )
    )
    visits = (
        tables.read("telehealth_virtualvisit", "HospitalID", "VisitStatus")
        .groupBy("HospitalID")
        .agg(
            rows().alias("TotalVirtualVisits"),
            count_if(c("VisitStatus") == "Completed").alias("CompletedVirtualVisits"),
            count_if(c("VisitStatus") == "No Show").alias("NoShowVirtualVisits"),
        )
    )
    providers = (
        tables.read("hospital_provider", "HospitalID", "IsActive")
        .where("IsActive")
        .groupBy("HospitalID")
        .agg(rows().alias("ActiveProviderCount"))
    )
    hospitals = tables.read(
        "hospital_hospital", "HospitalID", "HospitalCode", "HospitalName", "HospitalType", "NumberOfBeds",
        "IsTeachingHospital", "HasEmergencyDepartment",
    )
    joined = reduce(
        lambda left, right: left.join(right, "HospitalID", "left"), (encounters, claims, visits, providers), hospitals
    )
    joined = _zeroed(
        joined, "ActiveProviderCount", "TotalEncounters", "UniquePatients", "TelehealthEncounters",
        "EmergencyEncounters", "TotalClaims", "DeniedClaims", "TotalChargeAmount", "TotalPaidAmount",
        "TotalVirtualVisits", "CompletedVirtualVisits", "NoShowVirtualVisits",
    )
    return joined.select(
        "HospitalID", "HospitalCode", "HospitalName", "HospitalType", "NumberOfBeds", "IsTeachingHospital",
        "HasEmergencyDepartment", "ActiveProviderCount", "TotalEncounters", "UniquePatients",
        "TelehealthEncounters", "EmergencyEncounters", "AverageEncounterDurationMinutes", "TotalClaims",
        "DeniedClaims", percent(c("DeniedClaims"), c("TotalClaims")).alias("ClaimDenialRatePercent"),
        "TotalChargeAmount", "TotalPaidAmount",
        percent(c("TotalPaidAmount"), c("TotalChargeAmount")).alias("CollectionRatePercent"),
        "TotalVirtualVisits", "CompletedVirtualVisits", "NoShowVirtualVisits",
        percent(c("NoShowVirtualVisits"), c("TotalVirtualVisits")).alias("TelehealthNoShowRatePercent"),
    )
