"""The reports (P01-P12) as SQL table functions with parameters.

``register`` makes the views and twelve temporary functions known to a session, so that
``select * from patient_360(patient_id => 1)`` works in plain SQL. Spark puts the arguments into the function's query before
it plans, so a filter on a key reaches the scans as in the Python form. Arguments that a report refuses raise its text
when the query meets rows; the texts are those of ``reports.ERRORS``.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession

from caremesa.plans import kpis, views
from caremesa.plans.reports import ERRORS
from caremesa.sources.tables import Tables

PREFIX = "analytics_"

#: The views that the functions read.
SOURCES: dict[str, Callable[[Tables, str], DataFrame]] = {
    "enterprise_scorecard": kpis.enterprise_scorecard,
    "patient_360": views.patient_360,
    "hospital_monthly_performance": lambda t, _: kpis.hospital_monthly_performance(t),
    "provider_productivity": lambda t, _: kpis.provider_productivity(t),
    "claim_denial_monthly": lambda t, _: kpis.claim_denial_monthly(t),
    "revenue_cycle_monthly": kpis.revenue_cycle_monthly,
    "telehealth_monthly": lambda t, _: kpis.telehealth_monthly(t),
    "patient_risk_population": kpis.patient_risk_population,
    "model_performance": lambda t, _: kpis.model_performance(t),
    "encounter_details": lambda t, _: views.encounter_details(t),
    "patient_billing_summary": views.patient_billing_summary,
    "claim_denial_analysis": lambda t, _: views.claim_denial_analysis(t),
    "telehealth_performance": lambda t, _: views.telehealth_performance(t),
}


@dataclass(frozen=True)
class Function:
    """``refused``: conditions under which an error is raised, by number; ``where``: conditions on the rows of ``source``."""

    source: str
    parameters: dict[str, str] = field(default_factory=dict)
    refused: dict[int, str] = field(default_factory=dict)
    where: tuple[str, ...] = ()


PERIOD = {"start_date": "date default null", "end_date": "date default null"}
PLACE = {"hospital_id": "int default null", "department_id": "int default null"}
PERSON = {"patient_id": "bigint default null", "mrn": "string default null"}
BACKWARDS, NOBODY = "start_date > end_date", "patient_id is null and mrn is null"
MONTHS = (
    "KPI_Month between coalesce(trunc(start_date, 'MM'), date'1900-01-01') and coalesce(trunc(end_date, 'MM'), date'9999-12-01')",
)


def _equal(**columns: str) -> tuple[str, ...]:
    """A column equals its parameter where one is given."""
    return tuple(f"({parameter} is null or {column} = {parameter})" for parameter, column in columns.items())


HOSPITAL, DEPARTMENT = _equal(hospital_id="HospitalID"), _equal(department_id="DepartmentID")
WHO = _equal(patient_id="PatientID", mrn="MedicalRecordNumber")

FUNCTIONS: dict[str, Function] = {
    "enterprise_dashboard": Function("enterprise_scorecard"),
    "patient_360": Function("patient_360", PERSON, {51001: NOBODY}, WHO),
    "hospital_performance": Function(
        "hospital_monthly_performance", {"hospital_id": PLACE["hospital_id"], **PERIOD}, {51002: BACKWARDS}, (*HOSPITAL, *MONTHS)
    ),
    "provider_productivity": Function(
        "provider_productivity", {**PLACE, "min_encounters": "int default 0"}, {51003: "min_encounters < 0"},
        (*HOSPITAL, *DEPARTMENT, "TotalEncounters >= min_encounters"),
    ),
    "claim_denial_report": Function(
        "claim_denial_monthly",
        {**PERIOD, "hospital_name": "string default null", "payer_name": "string default null", "min_rate": "decimal(9,2) default 0"},
        {51004: BACKWARDS, 51005: "min_rate not between 0 and 100"},
        (*_equal(hospital_name="HospitalName", payer_name="PayerName"), *MONTHS, "coalesce(DenialRatePercent, 0) >= min_rate"),
    ),
    "monthly_revenue_cycle": Function("revenue_cycle_monthly", PERIOD, {51006: BACKWARDS}, MONTHS),
    "telehealth_operations": Function("telehealth_monthly", {**PERIOD, **PLACE}, {51007: BACKWARDS}, (*HOSPITAL, *DEPARTMENT, *MONTHS)),
    "high_risk_worklist": Function(
        "patient_risk_population",
        {"tier": "string default null", "min_outstanding": "decimal(18,2) default 0", "needs_review_only": "boolean default true"},
        {51008: "tier not in ('High', 'Medium', 'Low')"},
        (
            *_equal(tier="DerivedPatientRiskTier"), "EstimatedOutstandingAmount >= min_outstanding",
            "(not needs_review_only or NeedsCareManagementReview = 1)",
        ),
    ),
    "model_performance": Function(
        "model_performance", {"model_code": "string default null", "min_predictions": "int default 0"}, {51009: "min_predictions < 0"},
        (*_equal(model_code="ModelCode"), "TotalPredictions >= min_predictions"),
    ),
    "patient_encounter_history": Function(
        "encounter_details", {"patient_id": PERSON["patient_id"], **PERIOD}, {51010: "patient_id is null", 51011: BACKWARDS},
        (
            *_equal(patient_id="PatientID"),
            "to_date(AdmissionDateTimeUTC) between coalesce(start_date, date'1900-01-01') and coalesce(end_date, date'9999-12-31')",
        ),
    ),
    "patient_billing_detail": Function(
        "patient_billing_summary", {**PERSON, "only_outstanding": "boolean default false"}, {51012: NOBODY},
        (*WHO, "(not only_outstanding or OutstandingAmount > 0)"),
    ),
}

#: Kind of exception, source, condition, value that ranks, id, code, context.
EXCEPTIONS = (
    ("High Outstanding Balance", "patient_risk_population", "EstimatedOutstandingAmount > 0", "EstimatedOutstandingAmount",
     "PatientID", "MedicalRecordNumber", "EstimatedOutstandingAmount", "DerivedPatientRiskTier"),
    ("Claim Denial", "claim_denial_analysis", "IsDeniedClaim = 1", "TotalChargeAmount",
     "ClaimID", "ClaimNumber", "TotalChargeAmount", "coalesce(PrimaryDenialReasonCode, 'Unknown')"),
    ("Telehealth No Show", "telehealth_performance", "IsNoShow = 1", "ScheduledStartDateTimeUTC",
     "VirtualVisitID", "VisitNumber", "coalesce(PatientJoinDelayMinutes, 0)", "HospitalName"),
)
TOO_MANY = {51013: "top_n is null or top_n not between 1 and 1000"}


def _checked(refused: dict[int, str], condition: str) -> str:
    """The condition, or an error where arguments are refused: then no condition keeps the rows from it."""
    for number, bad in reversed(refused.items()):
        condition = f"if({bad}, cast(raise_error('{ERRORS[number]}') as boolean), {condition})"
    return condition


def _query(function: Function) -> str:
    return f"select * from {PREFIX}{function.source} where {_checked(function.refused, ' and '.join(function.where) or 'true')}"


def _exceptions() -> str:
    lists = []
    for kind, source, condition, rank, key, code, value, context in EXCEPTIONS:
        lists.append(
            f"select '{kind}' as ExceptionType, {key} as EntityID, {code} as EntityCode, cast({value} as decimal(18,2)) as ExceptionValue, "
            f"{context} as AdditionalContext from (select *, row_number() over (order by {rank} desc, {key}) as place "
            f"from {PREFIX}{source} where {condition}) where {_checked(TOO_MANY, 'place <= top_n')}"
        )
    return " union all ".join(lists)


def register(tables: Tables, as_of: str) -> list[str]:
    """Makes views and functions known to the session of ``tables``; gives the names of the functions."""
    spark: SparkSession = tables.spark
    for name, build in SOURCES.items():
        build(tables, as_of).createOrReplaceTempView(f"{PREFIX}{name}")
    queries = {name: (function.parameters, _query(function)) for name, function in FUNCTIONS.items()}
    queries["top_executive_exceptions"] = ({"top_n": "int default 20"}, _exceptions())
    for name, (parameters, query) in queries.items():
        declared = ", ".join(f"{parameter} {kind}" for parameter, kind in parameters.items())
        spark.sql(f"create or replace temporary function {name}({declared}) returns table return {query}")
    return list(queries)
