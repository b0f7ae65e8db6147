"""The parameterised reports.

Arguments are checked before any Spark work. A filter is added only when its
argument is given, so the optimizer sees plain predicates.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable
from decimal import Decimal

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from caremesa.functions import as_date, money, zero
from caremesa.plans import kpis, views
from caremesa.sources.tables import Tables

c = F.col

# Error numbers and texts of the report checks.
ERRORS = {
    51001: "Provide either @PatientID or @MedicalRecordNumber.",
    51002: "@EndDate must be greater than or equal to @StartDate.",
    51003: "@MinimumEncounters cannot be negative.",
    51004: "@EndDate must be greater than or equal to @StartDate.",
    51005: "@MinimumDenialRatePercent must be between 0 and 100.",
    51006: "@EndDate must be greater than or equal to @StartDate.",
    51007: "@EndDate must be greater than or equal to @StartDate.",
    51008: "@RiskTier must be High, Medium, Low, or NULL.",
    51009: "@MinimumPredictionCount cannot be negative.",
    51010: "@PatientID is required.",
    51011: "@EndDate must be greater than or equal to @StartDate.",
    51012: "Provide either @PatientID or @MedicalRecordNumber.",
    51013: "@TopN must be between 1 and 1000.",
}


class ReportError(ValueError):
    def __init__(self, number: int):
        super().__init__(ERRORS[number])
        self.number = number


def _require(condition: bool, number: int) -> None:
    if not condition:
        raise ReportError(number)


# The period of a report without dates.
FIRST_DATE, LAST_DATE = dt.date(1900, 1, 1), dt.date(9999, 12, 31)


def _period(start, end, number: int) -> tuple[dt.date, dt.date]:
    first = as_date(start) if start is not None else FIRST_DATE
    last = as_date(end) if end is not None else LAST_DATE
    _require(first <= last, number)
    return first, last


def _matching(frame: DataFrame, **wanted) -> DataFrame:
    for name, value in wanted.items():
        if value is not None:
            frame = frame.where(c(name) == value)
    return frame


def _month_bounds(first: dt.date, last: dt.date) -> kpis.Period:
    """Start of the first month and of the month after the last; open ends stay open."""
    start = None if first == FIRST_DATE else first.replace(day=1)
    after = None if last.year == LAST_DATE.year else (last.replace(day=1) + dt.timedelta(days=32)).replace(day=1)
    return start, after


# Tables with one row or more for each patient, and the child tables of invoices and encounters.
PATIENT_FACTS = (
    "clinical_patientaddress", "clinical_encounter", "clinical_diagnosis", "insurance_patientcoverage", "ai_prediction",
    "billing_invoice",
)
INVOICE_FACTS = ("billing_invoiceline", "billing_paymentallocation")
ENCOUNTER_FACTS = ("clinical_diagnosis", "clinical_procedure", "clinical_medicationorder")
# What carries the date of a report -> its key, date and child tables.
DATED = {
    "insurance_claim": ("ClaimID", "ServiceStartDate", ("insurance_claimline",)),
    "billing_invoice": ("InvoiceID", "InvoiceDate", INVOICE_FACTS),
    "telehealth_virtualvisit": ("VirtualVisitID", "ScheduledStartDateTimeUTC", ("telehealth_sessionevent",)),
}


def _of_patient(tables: Tables, patient_id: int | None, mrn: str | None) -> Tables:
    """Tables with the facts of one patient only, children included."""
    known = tables.read("clinical_patient", "PatientID", "MedicalRecordNumber")
    patients = _matching(known, PatientID=patient_id, MedicalRecordNumber=mrn).select("PatientID")
    invoices = tables.read("billing_invoice", "InvoiceID", "PatientID").join(patients, "PatientID", "left_semi").select("InvoiceID")
    return tables.narrowed(
        {name: ("PatientID", patients) for name in PATIENT_FACTS} | {name: ("InvoiceID", invoices) for name in INVOICE_FACTS}
    )


def of_parents(tables: Tables, period: kpis.Period, *parents: str, **wanted) -> Tables:
    """Tables whose child facts belong to parents of the period with the wanted values; without either nothing is cut."""
    given = {name: value for name, value in wanted.items() if value is not None}
    if period == kpis.ALWAYS and not given:
        return tables
    keys = {}
    for parent in parents:
        key, date, children = DATED[parent]
        rows = _matching(kpis.within(tables.read(parent, key, date, *given), date, period), **given).select(key)
        keys |= {child: (key, rows) for child in children}
    return tables.narrowed(keys)


def _of_place(tables: Tables, hospital_id: int | None, department_id: int | None) -> Tables:
    """Tables whose child facts belong to encounters of a place, or to claims of providers with such encounters."""
    if hospital_id is None and department_id is None:
        return tables
    everywhere = tables.read("clinical_encounter", "EncounterID", "ProviderID", "HospitalID", "DepartmentID")
    here = _matching(everywhere, HospitalID=hospital_id, DepartmentID=department_id)
    claims = tables.read("insurance_claim", "ClaimID", "ProviderID").join(here.select("ProviderID"), "ProviderID", "left_semi")
    encounters = {name: ("EncounterID", here.select("EncounterID")) for name in ENCOUNTER_FACTS}
    return tables.narrowed(encounters | {"insurance_claimline": ("ClaimID", claims.select("ClaimID"))})


def _months(frame: DataFrame, first: dt.date, last: dt.date) -> DataFrame:
    """Months from that of the first date to that of the last, both whole."""
    return frame.where(c("KPI_Month").between(F.lit(first.replace(day=1)), F.lit(last.replace(day=1))))


def enterprise_dashboard(tables: Tables, as_of) -> DataFrame:
    """P01"""
    return kpis.enterprise_scorecard(tables, as_of)


def patient_360(tables: Tables, as_of, patient_id: int | None = None, mrn: str | None = None) -> DataFrame:
    """P02"""
    _require(patient_id is not None or mrn is not None, 51001)
    own = _of_patient(tables, patient_id, mrn)
    return _matching(views.patient_360(own, as_of), PatientID=patient_id, MedicalRecordNumber=mrn)


def hospital_performance(tables: Tables, as_of=None, hospital_id: int | None = None, start=None, end=None) -> DataFrame:
    """P03"""
    first, last = _period(start, end, 51002)
    period = _month_bounds(first, last)
    own = of_parents(tables, period, "insurance_claim", "telehealth_virtualvisit", HospitalID=hospital_id)
    frame = _matching(kpis.hospital_monthly_performance(own, period), HospitalID=hospital_id)
    return _months(frame, first, last).orderBy("KPI_Month", "HospitalID")


def provider_productivity(
    tables: Tables, as_of=None, hospital_id: int | None = None, department_id: int | None = None, min_encounters: int = 0
) -> DataFrame:
    """P04"""
    _require(min_encounters >= 0, 51003)
    own = _of_place(tables, hospital_id, department_id)
    frame = _matching(kpis.provider_productivity(own), HospitalID=hospital_id, DepartmentID=department_id)
    return frame.where(c("TotalEncounters") >= min_encounters).orderBy(c("TotalEncounters").desc(), "ProviderID")


def claim_denial_report(
    tables: Tables, as_of=None, start=None, end=None, hospital_name: str | None = None, payer_name: str | None = None,
    min_rate: float | Decimal = 0,
) -> DataFrame:
    """P05"""
    first, last = _period(start, end, 51004)
    _require(0 <= min_rate <= 100, 51005)
    period = _month_bounds(first, last)
    own = of_parents(tables, period, "insurance_claim")
    frame = _matching(kpis.claim_denial_monthly(own, period), HospitalName=hospital_name, PayerName=payer_name)
    floor = F.lit(Decimal(str(min_rate))).cast("decimal(9,2)")
    return (
        _months(frame, first, last)
        .where(zero(c("DenialRatePercent")) >= floor)
        .orderBy("KPI_Month", c("DenialRatePercent").desc(), c("DeniedChargeAmount").desc())
    )


def monthly_revenue_cycle(tables: Tables, as_of, start=None, end=None) -> DataFrame:
    """P06"""
    first, last = _period(start, end, 51006)
    period = _month_bounds(first, last)
    own = of_parents(tables, period, "insurance_claim", "billing_invoice")
    return _months(kpis.revenue_cycle_monthly(own, as_of, period), first, last).orderBy("KPI_Month")


def telehealth_operations(
    tables: Tables, as_of=None, start=None, end=None, hospital_id: int | None = None, department_id: int | None = None
) -> DataFrame:
    """P07"""
    first, last = _period(start, end, 51007)
    period = _month_bounds(first, last)
    own = of_parents(tables, period, "telehealth_virtualvisit", HospitalID=hospital_id, DepartmentID=department_id)
    frame = _matching(kpis.telehealth_monthly(own, period), HospitalID=hospital_id, DepartmentID=department_id)
    return _months(frame, first, last).orderBy("KPI_Month", "HospitalID", "DepartmentID")


def high_risk_worklist(
    tables: Tables, as_of, tier: str | None = None, min_outstanding: float | Decimal = 0, needs_review_only: bool = True
) -> DataFrame:
    """P08"""
    _require(tier in (None, "High", "Medium", "Low"), 51008)
    frame = _matching(kpis.patient_risk_population(tables, as_of), DerivedPatientRiskTier=tier)
    frame = frame.where(c("EstimatedOutstandingAmount") >= F.lit(Decimal(str(min_outstanding))))
    if needs_review_only:
        frame = frame.where(c("NeedsCareManagementReview") == 1)
    rank = F.when(c("DerivedPatientRiskTier") == "High", 1).when(c("DerivedPatientRiskTier") == "Medium", 2).otherwise(3)
    return frame.orderBy(
        rank, c("LatestProbabilityScore").desc(), c("EmergencyEncounters").desc(), c("TotalEncounters").desc()
    )


def model_performance(tables: Tables, as_of=None, model_code: str | None = None, min_predictions: int = 0) -> DataFrame:
    """P09"""
    _require(min_predictions >= 0, 51009)
    frame = _matching(kpis.model_performance(tables), ModelCode=model_code)
    return frame.where(c("TotalPredictions") >= min_predictions).orderBy("ModelName", "VersionNumber")


def patient_encounter_history(tables: Tables, as_of=None, patient_id: int | None = None, start=None, end=None) -> DataFrame:
    """P10"""
    _require(patient_id is not None, 51010)
    first, last = _period(start, end, 51011)
    period = None if first == FIRST_DATE else first, None if last == LAST_DATE else last + dt.timedelta(days=1)
    admitted = tables.read("clinical_encounter", "EncounterID", "PatientID", "AdmissionDateTimeUTC")
    wanted = kpis.within(_matching(admitted, PatientID=patient_id), "AdmissionDateTimeUTC", period).select("EncounterID")
    own = tables.narrowed({name: ("EncounterID", wanted) for name in ENCOUNTER_FACTS})
    frame = kpis.within(_matching(views.encounter_details(own), PatientID=patient_id), "AdmissionDateTimeUTC", period)
    frame = frame.where(F.to_date("AdmissionDateTimeUTC").between(F.lit(first), F.lit(last)))
    return frame.orderBy(c("AdmissionDateTimeUTC").desc(), c("EncounterID").desc())


def patient_billing_detail(
    tables: Tables, as_of, patient_id: int | None = None, mrn: str | None = None, only_outstanding: bool = False
) -> DataFrame:
    """P11"""
    _require(patient_id is not None or mrn is not None, 51012)
    own = _of_patient(tables, patient_id, mrn)
    frame = _matching(views.patient_billing_summary(own, as_of), PatientID=patient_id, MedicalRecordNumber=mrn)
    if only_outstanding:
        frame = frame.where(c("OutstandingAmount") > 0)
    return frame.orderBy(c("InvoiceDate").desc(), c("InvoiceID").desc())


def top_executive_exceptions(tables: Tables, as_of, top_n: int | None = 20) -> dict[str, DataFrame]:
    """Three top-N lists of one shape. The id breaks ties."""
    _require(top_n is not None and 1 <= top_n <= 1000, 51013)

    def shaped(frame: DataFrame, kind: str, entity: str, code: str, value, context) -> DataFrame:
        return frame.select(
            F.lit(kind).alias("ExceptionType"), c(entity).alias("EntityID"), c(code).alias("EntityCode"),
            money(value).alias("ExceptionValue"), context.alias("AdditionalContext"),
        )

    outstanding = (
        kpis.patient_risk_population(tables, as_of)
        .where(c("EstimatedOutstandingAmount") > 0)
        .orderBy(c("EstimatedOutstandingAmount").desc(), "PatientID")
        .limit(top_n)
    )
    denied = (
        views.claim_denial_analysis(tables)
        .where(c("IsDeniedClaim") == 1)
        .orderBy(c("TotalChargeAmount").desc(), "ClaimID")
        .limit(top_n)
    )
    absent = (
        views.telehealth_performance(tables)
        .where(c("IsNoShow") == 1)
        .orderBy(c("ScheduledStartDateTimeUTC").desc(), "VirtualVisitID")
        .limit(top_n)
    )
    return {
        "outstanding": shaped(
            outstanding, "High Outstanding Balance", "PatientID", "MedicalRecordNumber",
            c("EstimatedOutstandingAmount"), c("DerivedPatientRiskTier"),
        ),
        "denials": shaped(
            denied, "Claim Denial", "ClaimID", "ClaimNumber", c("TotalChargeAmount"),
            F.coalesce(c("PrimaryDenialReasonCode"), F.lit("Unknown")),
        ),
        "no_shows": shaped(
            absent, "Telehealth No Show", "VirtualVisitID", "VisitNumber", zero(c("PatientJoinDelayMinutes")),
            c("HospitalName"),
        ),
    }


REPORTS: dict[str, Callable] = {
    "AIModelPerformance": model_performance,
    "ClaimDenialReport": claim_denial_report,
    "EnterpriseExecutiveDashboard": enterprise_dashboard,
    "GetPatient360": patient_360,
    "HighRiskPatientWorklist": high_risk_worklist,
    "HospitalPerformance": hospital_performance,
    "MonthlyRevenueCycle": monthly_revenue_cycle,
    "PatientBillingDetail": patient_billing_detail,
    "PatientEncounterHistory": patient_encounter_history,
    "ProviderProductivity": provider_productivity,
    "TelehealthOperations": telehealth_operations,
    "TopExecutiveExceptions": top_executive_exceptions,
}
