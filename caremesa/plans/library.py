"""The analytic query library (Q01-Q40)."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from caremesa.functions import month_start, percent, whole_average, wide_average, zero
from caremesa.operators import ordered
from caremesa.sources.shared import settled
from caremesa.plans import kpis, reports, views
from caremesa.plans.views import HIGH, count_if, rows
from caremesa.sources.tables import Tables

c = F.col
RATE = "decimal(10,2)"

# Windows without a partition below run over months, hospitals, departments,
# payers or model versions: tables that do not grow with the facts.


def _desc(name: str) -> Column:
    return c(name).desc()


def monthly_volume_growth(tables: Tables, as_of=None) -> DataFrame:
    """Q01"""
    monthly = (
        views.encounter_details(tables)
        .groupBy(month_start(c("AdmissionDateTimeUTC")).alias("EncounterMonth"))
        .agg(rows().alias("TotalEncounters"))
    )
    before = c("PreviousMonthEncounters")
    change = c("TotalEncounters") - before
    return (
        monthly.withColumn("PreviousMonthEncounters", F.lag("TotalEncounters").over(Window.orderBy("EncounterMonth")))
        .withColumns({"EncounterChange": change, "MonthOverMonthGrowthPercent": percent(change, before, RATE)})
        .orderBy("EncounterMonth")
    )


def _hospital_totals(tables: Tables, name: str) -> DataFrame:
    return kpis.hospital_monthly_performance(tables).groupBy("HospitalID", "HospitalName").agg(
        F.sum("TotalEncounters").alias(name)
    )


def hospital_ranking(tables: Tables, as_of=None) -> DataFrame:
    """Q02"""
    ranked = F.rank().over(Window.orderBy(_desc("TotalEncounters"))).cast("bigint")
    return _hospital_totals(tables, "TotalEncounters").withColumn("HospitalRank", ranked).orderBy("HospitalRank")


def top_providers_per_hospital(tables: Tables, as_of=None, top: int = 3) -> DataFrame:
    """Q03: the rank filter becomes a group limit before the shuffle."""
    order = Window.partitionBy("HospitalID").orderBy(_desc("TotalEncounters"), "ProviderID", "DepartmentID")
    return (
        kpis.provider_productivity(tables)
        .select(
            "HospitalID", "HospitalName", "ProviderID", "ProviderName", "ProviderType", "TotalEncounters",
            F.row_number().over(order).cast("bigint").alias("ProviderRank"),
        )
        .where(c("ProviderRank") <= top)
        .orderBy("HospitalName", "ProviderRank")
    )


def running_collections(tables: Tables, as_of) -> DataFrame:
    """Q04"""
    upto = Window.orderBy("KPI_Month").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return (
        kpis.revenue_cycle_monthly(tables, as_of)
        .select(
            "KPI_Month", "TotalCollectedAmount",
            F.sum("TotalCollectedAmount").over(upto).cast("decimal(38,2)").alias("RunningCollectedAmount"),
        )
        .orderBy("KPI_Month")
    )


def moving_average_collections(tables: Tables, as_of) -> DataFrame:
    """Q05"""
    recent = Window.orderBy("KPI_Month").rowsBetween(-2, Window.currentRow)
    mean = F.avg(c("TotalCollectedAmount").cast("decimal(28,2)")).over(recent)
    return (
        kpis.revenue_cycle_monthly(tables, as_of)
        .select("KPI_Month", "TotalCollectedAmount", mean.cast("decimal(18,2)").alias("ThreeMonthMovingAverage"))
        .orderBy("KPI_Month")
    )


def frequent_emergency_users(tables: Tables, as_of) -> DataFrame:
    """Q06"""
    return (
        views.patient_360(tables, as_of)
        .where(c("EmergencyEncounters") >= 2)
        .select(
            "PatientID", "MedicalRecordNumber", "FirstName", "LastName", "EmergencyEncounters", "TotalEncounters",
            percent(c("EmergencyEncounters"), c("TotalEncounters"), RATE).alias("EmergencyEncounterRatePercent"),
        )
        .orderBy(_desc("EmergencyEncounters"), _desc("TotalEncounters"))
    )


def risk_segmentation(tables: Tables, as_of) -> DataFrame:
    """Q07"""
    return kpis.patient_risk_population(tables, as_of).groupBy("DerivedPatientRiskTier").agg(
        rows().alias("PatientCount"),
        whole_average(c("TotalEncounters")).alias("AverageEncounters"),
        whole_average(c("EmergencyEncounters")).alias("AverageEmergencyEncounters"),
        wide_average(c("EstimatedOutstandingAmount")).alias("AverageOutstandingAmount"),
    )


def _patients(tables: Tables, as_of) -> DataFrame:
    return views.patient_360(tables, as_of).select("PatientID", "MedicalRecordNumber", "FirstName", "LastName")


def patients_without_encounters(tables: Tables, as_of) -> DataFrame:
    """Q08"""
    seen = views.encounter_details(tables).select("PatientID").distinct()
    return _patients(tables, as_of).join(seen, "PatientID", "left_anti")


def latest_encounter(tables: Tables, as_of) -> DataFrame:
    """Q09"""
    latest = ordered.latest_per_group(
        views.encounter_details(tables), "PatientID", ("AdmissionDateTimeUTC", "EncounterID"),
        ("EncounterType", "HospitalName", "ProviderName"),
    )
    return _patients(tables, as_of).join(latest, "PatientID")


def latest_encounter_or_none(tables: Tables, as_of) -> DataFrame:
    """Q10"""
    latest = ordered.latest_per_group(
        views.encounter_details(tables), "PatientID", ("AdmissionDateTimeUTC", "EncounterID"), ("EncounterType",)
    )
    return _patients(tables, as_of).join(latest, "PatientID", "left")


def monthly_collection_rate(tables: Tables, as_of) -> DataFrame:
    """Q11"""
    return (
        kpis.revenue_cycle_monthly(tables, as_of)
        .select(
            "KPI_Month", "TotalChargeAmount", "InsurancePaidAmount", "PatientPaidAmount", "TotalCollectedAmount",
            percent(c("TotalCollectedAmount"), c("TotalChargeAmount"), RATE).alias("TotalCollectionRatePercent"),
        )
        .orderBy("KPI_Month")
    )


def payer_denial_ranking(tables: Tables, as_of=None) -> DataFrame:
    """Q12"""
    payers = kpis.claim_denial_monthly(tables).groupBy("PayerName").agg(
        F.sum("TotalClaims").alias("TotalClaims"),
        F.sum("DeniedClaims").alias("DeniedClaims"),
        F.sum("DeniedChargeAmount").cast("decimal(38,2)").alias("DeniedChargeAmount"),
    )
    ranked = F.rank().over(Window.orderBy(_desc("DeniedChargeAmount"))).cast("bigint")
    return payers.withColumn("PayerDenialRank", ranked).orderBy("PayerDenialRank")


def _denial_rate() -> Column:
    return percent(F.sum("DeniedClaims"), F.sum("TotalClaims"), RATE)


def denial_rate_vs_enterprise(tables: Tables, as_of=None) -> DataFrame:
    """Q13"""
    monthly = kpis.claim_denial_monthly(tables)  # one exchange feeds the rows and the rate
    enterprise = monthly.agg(_denial_rate().alias("r")).scalar()
    return monthly.select(
        "KPI_Month", "HospitalName", "PayerName", "TotalClaims", "DeniedClaims", "DenialRatePercent",
        enterprise.alias("EnterpriseDenialRatePercent"),
    ).orderBy(_desc("DenialRatePercent"))


def outstanding_by_tier(tables: Tables, as_of) -> DataFrame:
    """Q14"""
    amount = c("EstimatedOutstandingAmount")
    return kpis.patient_risk_population(tables, as_of).groupBy("DerivedPatientRiskTier").agg(
        rows().alias("PatientCount"),
        F.sum(amount).cast("decimal(38,2)").alias("TotalOutstandingAmount"),
        F.avg(amount.cast("decimal(28,2)")).cast("decimal(28,6)").alias("AverageOutstandingAmount"),
        F.max(amount).alias("MaximumOutstandingAmount"),
    )


def overdue_above_average(tables: Tables, as_of) -> DataFrame:
    """Q15"""
    overdue = views.patient_billing_summary(tables, as_of).where(c("DerivedPaymentStatus") == "Overdue")
    mean = overdue.agg(F.avg("OutstandingAmount").alias("m")).scalar()
    return (
        overdue.where(c("OutstandingAmount") > mean)
        .select("PatientID", "MedicalRecordNumber", "InvoiceID", "InvoiceDate", "OutstandingAmount", "DerivedPaymentStatus")
        .orderBy(_desc("OutstandingAmount"))
    )


def telehealth_adoption(tables: Tables, as_of=None) -> DataFrame:
    """Q16"""
    return (
        kpis.hospital_monthly_performance(tables)
        .groupBy("KPI_Month")
        .agg(
            F.sum("TotalEncounters").alias("TotalEncounters"),
            F.sum("TelehealthEncounters").alias("TelehealthEncounters"),
            percent(F.sum("TelehealthEncounters"), F.sum("TotalEncounters"), RATE).alias("TelehealthAdoptionRatePercent"),
        )
        .orderBy("KPI_Month")
    )


def platform_comparison(tables: Tables, as_of=None) -> DataFrame:
    """Q17: the duration is the plain mean of the monthly means."""
    return (
        kpis.telehealth_monthly(tables)
        .groupBy("PlatformName")
        .agg(
            F.sum("TotalVirtualVisits").alias("TotalVirtualVisits"),
            F.sum("CompletedVisits").alias("CompletedVisits"),
            F.sum("NoShowVisits").alias("NoShowVisits"),
            F.sum("DisconnectedVisits").alias("DisconnectedVisits"),
            F.avg("AverageVisitDurationMinutes").cast("decimal(28,6)").alias("AverageVisitDurationMinutes"),
        )
        .orderBy(_desc("TotalVirtualVisits"))
    )


def department_no_show_ranking(tables: Tables, as_of=None) -> DataFrame:
    """Q18"""
    departments = kpis.telehealth_monthly(tables).groupBy("DepartmentID", "DepartmentName").agg(
        F.sum("TotalVirtualVisits").alias("TotalVirtualVisits"),
        F.sum("NoShowVisits").alias("NoShowVisits"),
        percent(F.sum("NoShowVisits"), F.sum("TotalVirtualVisits"), RATE).alias("NoShowRatePercent"),
    )
    ranked = F.dense_rank().over(Window.orderBy(_desc("NoShowRatePercent"))).cast("bigint")
    return departments.withColumn("NoShowRank", ranked).orderBy("NoShowRank")


def technical_errors(tables: Tables, as_of=None) -> DataFrame:
    """Q19"""
    return (
        views.telehealth_performance(tables)
        .where((c("TechnicalErrorCount") > 0) | (c("IsDisconnected") == 1))
        .select(
            "VirtualVisitID", "VisitNumber", "HospitalName", "DepartmentName", "PlatformName", "PatientDeviceType",
            "TechnicalErrorCount", "IsDisconnected", "ScheduledStartDateTimeUTC",
        )
        .orderBy(_desc("TechnicalErrorCount"), _desc("ScheduledStartDateTimeUTC"))
    )


def model_accuracy_ranking(tables: Tables, as_of=None) -> DataFrame:
    """Q20"""
    return (
        kpis.model_performance(tables)
        .select(
            "ModelCode", "ModelName", "VersionNumber", "TotalPredictions", "AccuracyPercent", "PrecisionPercent",
            "RecallPercent", F.rank().over(Window.orderBy(_desc("AccuracyPercent"))).cast("bigint").alias("AccuracyRank"),
        )
        .orderBy("AccuracyRank")
    )


def precision_below_recall(tables: Tables, as_of=None) -> DataFrame:
    """Q21"""
    return (
        kpis.model_performance(tables)
        .where(c("PrecisionPercent") < c("RecallPercent"))
        .select(
            "ModelCode", "ModelName", "VersionNumber", "PrecisionPercent", "RecallPercent",
            (c("RecallPercent") - c("PrecisionPercent")).alias("RecallPrecisionGap"),
        )
        .orderBy(_desc("RecallPrecisionGap"))
    )


def high_risk_share(tables: Tables, as_of=None) -> DataFrame:
    """Q22"""
    high = count_if(c("PredictedClass") == HIGH)
    return (
        views.prediction_performance(tables)
        .groupBy("ModelName", "VersionNumber")
        .agg(
            rows().alias("TotalPredictions"),
            high.alias("HighRiskPredictions"),
            percent(high, rows(), RATE).alias("HighRiskPredictionRatePercent"),
        )
        .orderBy(_desc("HighRiskPredictionRatePercent"))
    )


def false_negative_review(tables: Tables, as_of=None) -> DataFrame:
    """Q23"""
    return (
        views.prediction_performance(tables)
        .where(c("ConfusionMatrixCategory") == "False Negative")
        .select(
            "PredictionID", "PatientID", "ModelName", "VersionNumber", "PredictedClass", "ActualClass",
            "ProbabilityScore", "RiskScore", "PredictionDateTimeUTC",
        )
        .orderBy(_desc("RiskScore"), _desc("ProbabilityScore"))
    )


def monthly_prediction_volume(tables: Tables, as_of=None) -> DataFrame:
    """Q24"""
    return (
        views.prediction_performance(tables)
        .groupBy(month_start(c("PredictionDateTimeUTC")).alias("PredictionMonth"), "ModelName")
        .agg(rows().alias("PredictionCount"))
        .orderBy("PredictionMonth", "ModelName")
    )


def productivity_quartiles(tables: Tables, as_of=None) -> DataFrame:
    """Q25: ties are settled by provider and department."""
    providers = kpis.provider_productivity(tables).select(
        "ProviderID", "ProviderName", "HospitalName", "DepartmentID", "TotalEncounters"
    )
    numbered = ordered.ranked_rows(settled(providers), "TotalEncounters", "ProviderID", ("DepartmentID",))
    return numbered.select(
        "ProviderID", "ProviderName", "HospitalName", "TotalEncounters",
        ordered.ntile(c("RowNumber"), c("RowTotal"), 4).cast("int").alias("ProductivityQuartile"),
    )


def provider_vs_hospital(tables: Tables, as_of=None) -> DataFrame:
    """Q26: the hospital mean is an aggregate joined back, not a window."""
    providers = kpis.provider_productivity(tables).select(
        "ProviderID", "ProviderName", "HospitalID", "HospitalName", "TotalEncounters"
    )
    means = providers.groupBy("HospitalID").agg(whole_average(c("TotalEncounters")).alias("mean"))
    return (
        providers.join(means, "HospitalID")
        .select(
            "ProviderID", "ProviderName", "HospitalName", "TotalEncounters",
            c("mean").cast("decimal(18,2)").alias("HospitalAverageEncounters"),
            (c("TotalEncounters") - c("mean")).cast("decimal(18,2)").alias("DifferenceFromHospitalAverage"),
        )
        .orderBy("HospitalName", _desc("TotalEncounters"))
    )


def first_and_latest_encounter(tables: Tables, as_of=None) -> DataFrame:
    """Q27: first and last in time order are the least and greatest.

    NULL sorts lowest, so a patient with any undated encounter starts at NULL.
    """
    at = c("AdmissionDateTimeUTC")
    return views.encounter_details(tables).groupBy("PatientID").agg(
        F.when(F.count(at) == rows(), F.min(at)).alias("FirstEncounterDate"),
        F.max(at).alias("MostRecentEncounterDate"),
    )


def _with_previous(tables: Tables, *columns: str) -> DataFrame:
    encounters = views.encounter_details(tables).select("PatientID", "EncounterID", *columns, "AdmissionDateTimeUTC")
    return ordered.previous_moment(
        encounters, "PatientID", "AdmissionDateTimeUTC", "EncounterID", "PreviousEncounterDate"
    )


def _gap() -> Column:
    return F.datediff(F.to_date("AdmissionDateTimeUTC"), F.to_date("PreviousEncounterDate"))


def days_since_previous(tables: Tables, as_of=None) -> DataFrame:
    """Q28"""
    return (
        _with_previous(tables)
        .withColumn("DaysSincePreviousEncounter", _gap())
        .orderBy("PatientID", "AdmissionDateTimeUTC")
    )


def readmissions(tables: Tables, as_of=None) -> DataFrame:
    """Q29"""
    return (
        _with_previous(tables, "HospitalName")
        .withColumn("DaysBetweenEncounters", _gap())
        .where(c("DaysBetweenEncounters").between(1, 30))
        .orderBy("PatientID", "AdmissionDateTimeUTC")
    )


PIVOTED_TYPES = ["Emergency", "Inpatient", "Outpatient", "Telehealth"]


def encounter_type_pivot(tables: Tables, as_of=None) -> DataFrame:
    """Q30: four named types; a month with none of them still has a row."""
    return (
        views.encounter_details(tables)
        .groupBy(month_start(c("AdmissionDateTimeUTC")).alias("EncounterMonth"))
        .pivot("EncounterType", PIVOTED_TYPES)
        .agg(F.count("EncounterID"))
        .fillna(0, PIVOTED_TYPES)
        .orderBy("EncounterMonth")
    )


# Label of each unpivoted measure.
UNPIVOTED = {
    "Total Encounters": "TotalEncounters",
    "Unique Patients": "UniquePatients",
    "Total Claims": "TotalClaims",
    "Denied Claims": "DeniedClaims",
    "Total Predictions": "TotalPredictions",
    "Prediction Accuracy Percent": "PredictionAccuracyPercent",
}


def scorecard_unpivot(tables: Tables, as_of) -> DataFrame:
    """Q31"""
    wide = kpis.enterprise_scorecard(tables, as_of).select(
        *(c(name).cast("decimal(18,2)").alias(label) for label, name in UNPIVOTED.items())
    )
    return wide.unpivot([], list(UNPIVOTED), "KPIName", "KPIValue")


def month_calendar(tables: Tables, as_of) -> DataFrame:
    """Q32: every month from the first to the last, gaps filled with zero."""
    monthly = kpis.revenue_cycle_monthly(tables, as_of).select("KPI_Month", "TotalCollectedAmount")
    months = F.sequence(F.min("KPI_Month"), F.max("KPI_Month"), F.expr("interval 1 month"))
    calendar = monthly.agg(months.alias("m")).select(F.explode("m").alias("CalendarMonth"))
    return (
        calendar.join(monthly, c("CalendarMonth") == c("KPI_Month"), "left")
        .select("CalendarMonth", zero(c("TotalCollectedAmount")).alias("TotalCollectedAmount"))
        .orderBy("CalendarMonth")
    )


def providers_without_claims(tables: Tables, as_of=None) -> DataFrame:
    """Q33"""
    claiming = views.claim_financials(tables).select("ProviderID").distinct()
    return (
        kpis.provider_productivity(tables)
        .join(claiming, "ProviderID", "left_anti")
        .select("ProviderID", "ProviderName", "HospitalName", "TotalEncounters")
        .orderBy(_desc("TotalEncounters"))
    )


def hospitals_above_enterprise_denial(tables: Tables, as_of=None) -> DataFrame:
    """Q34: the enterprise rate is summed from the hospital rows, of which there are few, in the same pass."""
    hospitals = (
        kpis.claim_denial_monthly(tables)
        .groupBy("HospitalName")
        .agg(
            F.sum("TotalClaims").alias("TotalClaims"),
            F.sum("DeniedClaims").alias("DeniedClaims"),
            _denial_rate().alias("HospitalDenialRatePercent"),
        )
    )
    all_hospitals = Window.partitionBy()
    enterprise = percent(F.sum("DeniedClaims").over(all_hospitals), F.sum("TotalClaims").over(all_hospitals), RATE)
    return (
        hospitals.withColumn("EnterpriseDenialRatePercent", enterprise)
        .where(c("HospitalDenialRatePercent") > c("EnterpriseDenialRatePercent"))
        .orderBy(_desc("HospitalDenialRatePercent"))
    )


def second_highest_provider(tables: Tables, as_of=None) -> DataFrame:
    """Q35: the second-highest distinct count is found first, then its providers.

    The two highest counts come from a top-2 over the distinct counts, so no
    task ranks all providers.
    """
    providers = settled(kpis.provider_productivity(tables).select("ProviderID", "ProviderName", "TotalEncounters"))
    top_two = providers.select("TotalEncounters").distinct().orderBy(_desc("TotalEncounters")).limit(2)
    second = top_two.agg(F.when(rows() == 2, F.min("TotalEncounters")).alias("v")).scalar()
    return providers.where(c("TotalEncounters") == second)


def duplicate_mrns(tables: Tables, as_of) -> DataFrame:
    """Q36"""
    return (
        views.patient_360(tables, as_of)
        .groupBy("MedicalRecordNumber")
        .agg(rows().alias("DuplicateCount"))
        .where(c("DuplicateCount") > 1)
    )


def top_balance_per_tier(tables: Tables, as_of) -> DataFrame:
    """Q37: the rank filter becomes a group limit before the shuffle."""
    order = Window.partitionBy("DerivedPatientRiskTier").orderBy(_desc("EstimatedOutstandingAmount"), "PatientID")
    return (
        kpis.patient_risk_population(tables, as_of)
        .select(
            "PatientID", "MedicalRecordNumber", "FirstName", "LastName", "DerivedPatientRiskTier",
            "EstimatedOutstandingAmount", F.row_number().over(order).cast("bigint").alias("BalanceRank"),
        )
        .where(c("BalanceRank") == 1)
    )


def hospital_share(tables: Tables, as_of=None) -> DataFrame:
    """Q38"""
    everything = F.sum("HospitalEncounters").over(Window.partitionBy())
    return (
        _hospital_totals(tables, "HospitalEncounters")
        .withColumn("EnterpriseEncounterSharePercent", percent(c("HospitalEncounters"), everything, RATE))
        .orderBy(_desc("HospitalEncounters"))
    )


def executive_exception_score(tables: Tables, as_of) -> DataFrame:
    """Q39"""
    tier, urgent, owed = c("DerivedPatientRiskTier"), c("EmergencyEncounters"), c("EstimatedOutstandingAmount")
    score = (
        F.when(tier == "High", 50).when(tier == "Medium", 25).otherwise(5)
        + F.when(urgent >= 3, 25).when(urgent == 2, 15).when(urgent == 1, 5).otherwise(0)
        + F.when(owed >= 5000, 25).when(owed >= 1000, 10).otherwise(0)
    )
    return (
        kpis.patient_risk_population(tables, as_of)
        .select(
            "PatientID", "MedicalRecordNumber", "DerivedPatientRiskTier", "EmergencyEncounters",
            "EstimatedOutstandingAmount", "LatestProbabilityScore", score.alias("ExecutiveExceptionScore"),
        )
        .orderBy(_desc("ExecutiveExceptionScore"), _desc("EstimatedOutstandingAmount"))
    )


def report_inventory(tables: Tables, as_of: dt.date | str | None = None) -> DataFrame:
    """Q40: the registered reports. Creation dates have no counterpart here."""
    names = [("Analytics", name) for name in sorted(reports.REPORTS)]
    return tables.spark.createDataFrame(names, "SchemaName string, ReportName string")


LIBRARY = {
    "Q01": monthly_volume_growth,
    "Q02": hospital_ranking,
    "Q03": top_providers_per_hospital,
    "Q04": running_collections,
    "Q05": moving_average_collections,
    "Q06": frequent_emergency_users,
    "Q07": risk_segmentation,
    "Q08": patients_without_encounters,
    "Q09": latest_encounter,
    "Q10": latest_encounter_or_none,
    "Q11": monthly_collection_rate,
    "Q12": payer_denial_ranking,
    "Q13": denial_rate_vs_enterprise,
    "Q14": outstanding_by_tier,
    "Q15": overdue_above_average,
    "Q16": telehealth_adoption,
    "Q17": platform_comparison,
    "Q18": department_no_show_ranking,
    "Q19": technical_errors,
    "Q20": model_accuracy_ranking,
    "Q21": precision_below_recall,
    "Q22": high_risk_share,
    "Q23": false_negative_review,
    "Q24": monthly_prediction_volume,
    "Q25": productivity_quartiles,
    "Q26": provider_vs_hospital,
    "Q27": first_and_latest_encounter,
    "Q28": days_since_previous,
    "Q29": readmissions,
    "Q30": encounter_type_pivot,
    "Q31": scorecard_unpivot,
    "Q32": month_calendar,
    "Q33": providers_without_claims,
    "Q34": hospitals_above_enterprise_denial,
    "Q35": second_highest_provider,
    "Q36": duplicate_mrns,
    "Q37": top_balance_per_tier,
    "Q38": hospital_share,
    "Q39": executive_exception_score,
}
