"""The eight executive KPI views (V11-V18), built on the subject views."""

from __future__ import annotations

import datetime as dt
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from caremesa.functions import month_start, percent, whole_average, zero
from caremesa.plans import views
from caremesa.plans.views import HIGH, count_if, rows
from caremesa.sources.tables import Tables

c = F.col


Period = tuple[dt.date | None, dt.date | None]
ALWAYS: Period = (None, None)


def within(frame: DataFrame, column: str, period: Period) -> DataFrame:
    """Rows from the first to before the second date.

    Months are cut on the plain date column, not on the month computed from it,
    so the condition reaches the scan and its partitions and row groups.
    """
    first, after = period
    if first is not None:
        frame = frame.where(c(column) >= F.lit(first))
    if after is not None:
        frame = frame.where(c(column) < F.lit(after))
    return frame


def _wide_sum(name: str) -> Column:
    return F.sum(name).cast("decimal(38,2)")


def side_by_side(*frames: DataFrame) -> DataFrame:
    """One row out of several one-row frames, by stacking and folding them."""
    stacked = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)
    return stacked.agg(*(F.max(name).alias(name) for name in stacked.columns))


def _encounter_measures() -> list[Column]:
    return [
        rows().alias("TotalEncounters"),
        F.count_distinct("PatientID").alias("UniquePatients"),
        count_if(c("IsTelehealth")).alias("TelehealthEncounters"),
        count_if(c("EncounterType") == "Emergency").alias("EmergencyEncounters"),
        whole_average(c("LengthOfStayMinutes")).alias("AverageEncounterDurationMinutes"),
    ]


def _claim_measures() -> list[Column]:
    return [
        rows().alias("TotalClaims"),
        F.sum("IsDeniedClaim").alias("DeniedClaims"),
        _wide_sum("TotalChargeAmount").alias("TotalChargeAmount"),
        _wide_sum("TotalPaidAmount").alias("TotalPaidAmount"),
    ]


def enterprise_scorecard(tables: Tables, as_of: dt.date | str) -> DataFrame:
    """One row of enterprise totals and rates."""
    encounters = views.encounter_details(tables).agg(*_encounter_measures())
    visits = views.telehealth_performance(tables).agg(
        rows().alias("TotalVirtualVisits"),
        F.sum("IsCompleted").alias("CompletedVirtualVisits"),
        F.sum("IsNoShow").alias("NoShowVirtualVisits"),
        F.sum("IsDisconnected").alias("DisconnectedVirtualVisits"),
        whole_average(c("ActualVisitDurationMinutes")).alias("AverageVirtualVisitMinutes"),
    )
    claims = views.claim_financials(tables).agg(
        *_claim_measures(),
        _wide_sum("TotalAllowedAmount").alias("TotalAllowedAmount"),
        _wide_sum("TotalPatientResponsibilityAmount").alias("TotalPatientResponsibilityAmount"),
    )
    billing = views.patient_billing_summary(tables, as_of).agg(
        rows().alias("TotalInvoices"),
        _wide_sum("InvoiceAmount").alias("TotalInvoiceAmount"),
        _wide_sum("PaidAmount").alias("TotalInvoicePaidAmount"),
        _wide_sum("OutstandingAmount").alias("TotalOutstandingAmount"),
        count_if(c("DerivedPaymentStatus") == "Overdue").alias("OverdueInvoices"),
    )
    models = views.prediction_performance(tables).agg(
        rows().alias("TotalPredictions"),
        F.count("PredictionOutcomeID").alias("PredictionsWithOutcome"),
        count_if(c("IsCorrectPrediction") == 1).alias("CorrectPredictions"),
    )
    return side_by_side(encounters, visits, claims, billing, models).select(
        "TotalEncounters", "UniquePatients", "TelehealthEncounters", "EmergencyEncounters",
        "AverageEncounterDurationMinutes",
        percent(c("TelehealthEncounters"), c("TotalEncounters")).alias("TelehealthAdoptionRatePercent"),
        "TotalVirtualVisits", "CompletedVirtualVisits", "NoShowVirtualVisits", "DisconnectedVirtualVisits",
        "AverageVirtualVisitMinutes",
        percent(c("CompletedVirtualVisits"), c("TotalVirtualVisits")).alias("TelehealthCompletionRatePercent"),
        percent(c("NoShowVirtualVisits"), c("TotalVirtualVisits")).alias("TelehealthNoShowRatePercent"),
        "TotalClaims", "DeniedClaims", "TotalChargeAmount", "TotalAllowedAmount", "TotalPaidAmount",
        "TotalPatientResponsibilityAmount",
        percent(c("DeniedClaims"), c("TotalClaims")).alias("ClaimDenialRatePercent"),
        percent(c("TotalPaidAmount"), c("TotalChargeAmount")).alias("CollectionRatePercent"),
        "TotalInvoices", "TotalInvoiceAmount", "TotalInvoicePaidAmount", "TotalOutstandingAmount", "OverdueInvoices",
        percent(c("OverdueInvoices"), c("TotalInvoices")).alias("OverdueInvoiceRatePercent"),
        "TotalPredictions", "PredictionsWithOutcome", "CorrectPredictions",
        percent(c("CorrectPredictions"), c("PredictionsWithOutcome")).alias("PredictionAccuracyPercent"),
    )


def hospital_monthly_performance(tables: Tables, period: Period = ALWAYS) -> DataFrame:
    """Month x hospital, anchored on months that have encounters."""
    encounters = (
        within(views.encounter_details(tables), "AdmissionDateTimeUTC", period)
        .groupBy(month_start(c("AdmissionDateTimeUTC")).alias("KPI_Month"), "HospitalID", "HospitalName")
        .agg(*_encounter_measures())
    )
    claims = (
        within(views.claim_financials(tables), "ServiceStartDate", period)
        .groupBy(month_start(c("ServiceStartDate")).alias("KPI_Month"), "HospitalID")
        .agg(*_claim_measures())
    )
    visits = (
        within(views.telehealth_performance(tables), "ScheduledStartDateTimeUTC", period)
        .groupBy(month_start(c("ScheduledStartDateTimeUTC")).alias("KPI_Month"), "HospitalID")
        .agg(
            rows().alias("TotalVirtualVisits"),
            F.sum("IsCompleted").alias("CompletedVirtualVisits"),
            F.sum("IsNoShow").alias("NoShowVirtualVisits"),
        )
    )
    keys = ["KPI_Month", "HospitalID"]
    joined = encounters.join(claims, keys, "left").join(visits, keys, "left")
    counted = (
        "TotalClaims", "DeniedClaims", "TotalChargeAmount", "TotalPaidAmount", "TotalVirtualVisits",
        "CompletedVirtualVisits", "NoShowVirtualVisits",
    )
    return joined.withColumns({name: zero(c(name)) for name in counted}).select(
        *keys, "HospitalName", "TotalEncounters", "UniquePatients", "TelehealthEncounters", "EmergencyEncounters",
        "AverageEncounterDurationMinutes", "TotalClaims", "DeniedClaims", "TotalChargeAmount", "TotalPaidAmount",
        percent(c("DeniedClaims"), c("TotalClaims")).alias("ClaimDenialRatePercent"),
        percent(c("TotalPaidAmount"), c("TotalChargeAmount")).alias("CollectionRatePercent"),
        "TotalVirtualVisits", "CompletedVirtualVisits", "NoShowVirtualVisits",
        percent(c("NoShowVirtualVisits"), c("TotalVirtualVisits")).alias("TelehealthNoShowRatePercent"),
    )


def provider_productivity(tables: Tables) -> DataFrame:
    """Provider x hospital x department; claims are per provider only."""
    encounters = (
        views.encounter_details(tables)
        .groupBy(
            "ProviderID", "ProviderCode", "ProviderName", "ProviderType", "HospitalID", "HospitalName",
            "DepartmentID", "DepartmentName",
        )
        .agg(
            *_encounter_measures(),
            F.sum("DiagnosisCount").alias("TotalDiagnosesDocumented"),
            F.sum("ProcedureCount").alias("TotalProceduresDocumented"),
            F.sum("MedicationOrderCount").alias("TotalMedicationOrders"),
        )
    )
    claims = views.claim_financials(tables).groupBy("ProviderID").agg(*_claim_measures())
    counted = ("TotalClaims", "DeniedClaims", "TotalChargeAmount", "TotalPaidAmount")
    joined = encounters.join(claims, "ProviderID", "left").withColumns({name: zero(c(name)) for name in counted})
    return joined.select(
        "ProviderID", "ProviderCode", "ProviderName", "ProviderType", "HospitalID", "HospitalName", "DepartmentID",
        "DepartmentName", "TotalEncounters", "UniquePatients", "TelehealthEncounters", "EmergencyEncounters",
        "AverageEncounterDurationMinutes", "TotalDiagnosesDocumented", "TotalProceduresDocumented",
        "TotalMedicationOrders", *counted,
        percent(c("DeniedClaims"), c("TotalClaims")).alias("ClaimDenialRatePercent"),
        (c("TotalPaidAmount").cast("decimal(26,2)") / c("TotalEncounters"))
        .cast("decimal(18,2)")
        .alias("PaidAmountPerEncounter"),
    )


def telehealth_monthly(tables: Tables, period: Period = ALWAYS) -> DataFrame:
    """Month x hospital x department x platform x patient device."""
    grouped = (
        within(views.telehealth_performance(tables), "ScheduledStartDateTimeUTC", period)
        .groupBy(
            month_start(c("ScheduledStartDateTimeUTC")).alias("KPI_Month"),
            "HospitalID", "HospitalName", "DepartmentID", "DepartmentName", "PlatformName", "PatientDeviceType",
        )
        .agg(
            rows().alias("TotalVirtualVisits"),
            F.sum("IsCompleted").alias("CompletedVisits"),
            F.sum("IsNoShow").alias("NoShowVisits"),
            F.sum("IsDisconnected").alias("DisconnectedVisits"),
            whole_average(c("PatientJoinDelayMinutes")).alias("AveragePatientJoinDelayMinutes"),
            whole_average(c("ProviderJoinDelayMinutes")).alias("AverageProviderJoinDelayMinutes"),
            whole_average(c("ActualVisitDurationMinutes")).alias("AverageVisitDurationMinutes"),
            F.sum("TechnicalErrorCount").alias("TotalTechnicalErrors"),
            count_if(c("IsInterpreterRequired")).alias("InterpreterRequiredVisits"),
        )
    )
    total = c("TotalVirtualVisits")
    return grouped.withColumns(
        {
            "CompletionRatePercent": percent(c("CompletedVisits"), total),
            "NoShowRatePercent": percent(c("NoShowVisits"), total),
            "DisconnectionRatePercent": percent(c("DisconnectedVisits"), total),
        }
    )


def revenue_cycle_monthly(tables: Tables, as_of: dt.date | str, period: Period = ALWAYS) -> DataFrame:
    """Month, anchored on months that have claims."""
    claims = (
        within(views.claim_financials(tables), "ServiceStartDate", period)
        .groupBy(month_start(c("ServiceStartDate")).alias("KPI_Month"))
        .agg(
            rows().alias("TotalClaims"),
            F.sum("IsDeniedClaim").alias("DeniedClaims"),
            _wide_sum("TotalChargeAmount").alias("TotalChargeAmount"),
            _wide_sum("TotalAllowedAmount").alias("TotalAllowedAmount"),
            _wide_sum("TotalPaidAmount").alias("InsurancePaidAmount"),
            _wide_sum("TotalPatientResponsibilityAmount").alias("PatientResponsibilityAmount"),
            whole_average(c("SubmissionLagDays")).alias("AverageSubmissionLagDays"),
            whole_average(c("AdjudicationDays")).alias("AverageAdjudicationDays"),
        )
    )
    invoices = (
        within(views.patient_billing_summary(tables, as_of), "InvoiceDate", period)
        .groupBy(month_start(c("InvoiceDate")).alias("KPI_Month"))
        .agg(
            rows().alias("TotalInvoices"),
            _wide_sum("InvoiceAmount").alias("TotalInvoiceAmount"),
            _wide_sum("PaidAmount").alias("PatientPaidAmount"),
            _wide_sum("OutstandingAmount").alias("OutstandingAmount"),
            count_if(c("DerivedPaymentStatus") == "Overdue").alias("OverdueInvoices"),
        )
    )
    counted = ("TotalInvoices", "TotalInvoiceAmount", "PatientPaidAmount", "OutstandingAmount", "OverdueInvoices")
    joined = claims.join(invoices, "KPI_Month", "left").withColumns({name: zero(c(name)) for name in counted})
    return joined.select(
        "KPI_Month", "TotalClaims", "DeniedClaims", "TotalChargeAmount", "TotalAllowedAmount",
        "InsurancePaidAmount", "PatientResponsibilityAmount", "AverageSubmissionLagDays", "AverageAdjudicationDays",
        percent(c("DeniedClaims"), c("TotalClaims")).alias("ClaimDenialRatePercent"),
        percent(c("InsurancePaidAmount"), c("TotalChargeAmount")).alias("InsuranceCollectionRatePercent"),
        *counted,
        percent(c("OverdueInvoices"), c("TotalInvoices")).alias("OverdueInvoiceRatePercent"),
        (c("InsurancePaidAmount") + c("PatientPaidAmount")).cast("decimal(38,2)").alias("TotalCollectedAmount"),
    )


def claim_denial_monthly(tables: Tables, period: Period = ALWAYS) -> DataFrame:
    """Month x hospital x payer x plan x type x denial reason."""
    denied = c("IsDeniedClaim") == 1
    grouped = (
        within(views.claim_denial_analysis(tables), "ServiceStartDate", period)
        .groupBy(
            month_start(c("ServiceStartDate")).alias("KPI_Month"),
            "HospitalName", "PayerName", "PlanName", "ClaimType", "PrimaryDenialReasonCode",
        )
        .agg(
            rows().alias("TotalClaims"),
            F.sum("IsDeniedClaim").alias("DeniedClaims"),
            _wide_sum("TotalChargeAmount").alias("TotalChargeAmount"),
            F.sum(F.when(denied, c("TotalChargeAmount")).otherwise(0)).cast("decimal(38,2)").alias("DeniedChargeAmount"),
            _wide_sum("TotalPaidAmount").alias("TotalPaidAmount"),
        )
    )
    return grouped.withColumns(
        {
            "DenialRatePercent": percent(c("DeniedClaims"), c("TotalClaims")),
            "DeniedChargeRatePercent": percent(c("DeniedChargeAmount"), c("TotalChargeAmount")),
        }
    )


def patient_risk_population(tables: Tables, as_of: dt.date | str) -> DataFrame:
    """One row per patient with the latest prediction and a risk tier.

    The latest prediction is a greatest-struct aggregate: it combines before the
    shuffle, so a patient with very many predictions stays one small record.
    """
    latest = (
        views.prediction_performance(tables)
        .groupBy("PatientID")
        .agg(
            F.max(
                F.struct(
                    "PredictionDateTimeUTC", "PredictionID", "ModelName", "PredictedClass", "ProbabilityScore",
                    "RiskScore",
                )
            ).alias("latest")
        )
        .select(
            "PatientID",
            c("latest.ModelName").alias("ModelName"),
            c("latest.PredictedClass").alias("LatestPredictedClass"),
            c("latest.ProbabilityScore").alias("LatestProbabilityScore"),
            c("latest.RiskScore").alias("LatestRiskScore"),
            c("latest.PredictionDateTimeUTC").alias("LatestPredictionDateUTC"),
        )
    )
    high = c("LatestPredictedClass") == HIGH
    medium = (c("EmergencyEncounters") >= 2) | (c("DistinctDiagnosisCount") >= 5)
    return views.patient_360(tables, as_of).join(latest, "PatientID", "left").select(
        "PatientID", "MedicalRecordNumber", "FirstName", "LastName", "AgeYears", "Gender", "City", "StateProvince",
        "TotalEncounters", "TelehealthEncounters", "EmergencyEncounters", "TotalDiagnoses",
        "DistinctDiagnosisCount", "TotalBilledAmount", "TotalPaidAmount", "EstimatedOutstandingAmount", "ModelName",
        "LatestPredictedClass", "LatestProbabilityScore", "LatestRiskScore", "LatestPredictionDateUTC",
        F.when(high, "High").when(medium, "Medium").otherwise("Low").alias("DerivedPatientRiskTier"),
        F.when(high | medium, 1).otherwise(0).alias("NeedsCareManagementReview"),
    )


def model_performance(tables: Tables) -> DataFrame:
    """One row per model version with confusion counts and rates."""
    category = c("ConfusionMatrixCategory")
    grouped = (
        views.prediction_performance(tables)
        .groupBy("ModelID", "ModelCode", "ModelName", "ModelVersionID", "VersionNumber", "AlgorithmName")
        .agg(
            rows().alias("TotalPredictions"),
            F.count("PredictionOutcomeID").alias("PredictionsWithOutcome"),
            count_if(c("IsCorrectPrediction") == 1).alias("CorrectPredictions"),
            count_if(category == "True Positive").alias("TruePositives"),
            count_if(category == "False Positive").alias("FalsePositives"),
            count_if(category == "True Negative").alias("TrueNegatives"),
            count_if(category == "False Negative").alias("FalseNegatives"),
            F.avg(c("ProbabilityScore").cast("decimal(18,8)")).cast("decimal(18,8)").alias("AverageProbabilityScore"),
            F.avg(c("RiskScore").cast("decimal(18,6)")).cast("decimal(18,6)").alias("AverageRiskScore"),
        )
    )
    hits = c("TruePositives")
    return grouped.withColumns(
        {
            "AccuracyPercent": percent(c("CorrectPredictions"), c("PredictionsWithOutcome")),
            "PrecisionPercent": percent(hits, hits + c("FalsePositives")),
            "RecallPercent": percent(hits, hits + c("FalseNegatives")),
        }
    )
