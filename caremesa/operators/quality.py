"""Data-quality checks over the views.

The checks of one view are counted in one pass. The view is grouped by its
business key, which gives the duplicate check and the predicate counts together;
for views that are already partitioned by that key the grouping adds no shuffle.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable, Iterable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from caremesa.functions import as_moment, blank, flag, percent
from caremesa.plans import views
from caremesa.sources.tables import Tables

c = F.col
RATE = "decimal(10,2)"


@dataclass(frozen=True)
class AsOf:
    """The moment of a run: dates are compared with its date, times with the moment itself."""

    date: Column
    moment: Column
    year_later: Column


def moment_of(as_of: dt.date | str) -> AsOf:
    """A date, or a date with a time of day; a date means its midnight."""
    moment = as_moment(as_of)
    literal = f"timestamp_ntz'{moment:%Y-%m-%d %H:%M:%S.%f}'"
    return AsOf(F.lit(moment.date()), F.expr(literal), F.expr(f"{literal} + interval '1' year"))


@dataclass(frozen=True)
class Check:
    """``issue`` counts rows; a check without one counts duplicated keys."""

    number: int
    area: str
    name: str
    description: str
    view: str
    issue: Callable[[AsOf], Column] | None = None

    @property
    def id(self) -> str:
        return f"D{self.number:02d}"


@dataclass(frozen=True)
class View:
    build: Callable[[Tables, str], DataFrame]
    key: str
    skip_null_key: bool = False


VIEWS = {
    "patients": View(views.patient_360, "MedicalRecordNumber", skip_null_key=True),
    "encounters": View(lambda t, _: views.encounter_details(t), "EncounterID"),
    # The denial view carries every column the claim checks need.
    "claims": View(lambda t, _: views.claim_denial_analysis(t), "ClaimID"),
    "invoices": View(views.patient_billing_summary, "InvoiceID"),
    "visits": View(lambda t, _: views.telehealth_performance(t), "VirtualVisitID"),
    "predictions": View(lambda t, _: views.prediction_performance(t), "PredictionID"),
}


def _years(today: Column) -> Column:
    return F.year(today) - F.year("DateOfBirth")


# Areas, names and descriptions of the checks.
CHECKS = (
    Check(1, "Patient", "Duplicate medical record numbers",
          "Identifies medical record numbers assigned to more than one patient.", "patients"),
    Check(2, "Patient", "Missing medical record numbers",
          "Patients should have a populated medical record number.", "patients",
          lambda _: blank(c("MedicalRecordNumber"))),
    Check(3, "Patient", "Missing patient names",
          "Identifies patient records with a missing first or last name.", "patients",
          lambda _: blank(c("FirstName")) | blank(c("LastName"))),
    Check(4, "Patient", "Future dates of birth",
          "A patient date of birth cannot occur in the future.", "patients",
          lambda today: c("DateOfBirth") > today.date),
    Check(5, "Patient", "Implausible patient ages",
          "Flags calculated ages below zero or above 120 years.", "patients",
          lambda today: (_years(today.date) < 0) | (_years(today.date) > 120)),
    Check(6, "Encounter", "Duplicate encounter IDs",
          "Each healthcare encounter should have one unique encounter identifier.", "encounters"),
    Check(7, "Encounter", "Missing patient references",
          "Every encounter should be associated with a patient.", "encounters",
          lambda _: c("PatientID").isNull()),
    Check(8, "Encounter", "Missing provider references",
          "Every encounter should be assigned to a provider.", "encounters",
          lambda _: c("ProviderID").isNull()),
    Check(9, "Encounter", "Missing hospital references",
          "Every encounter should be associated with a hospital.", "encounters",
          lambda _: c("HospitalID").isNull()),
    Check(10, "Encounter", "Future encounter dates",
          "Historical encounter data should not contain future admission timestamps.", "encounters",
          lambda today: c("AdmissionDateTimeUTC") > today.moment),
    Check(11, "Encounter", "Discharge before admission",
          "Discharge timestamps must occur after admission timestamps.", "encounters",
          lambda _: c("DischargeDateTimeUTC") < c("AdmissionDateTimeUTC")),
    Check(12, "Insurance", "Duplicate claim IDs",
          "Each insurance claim should have one unique claim identifier.", "claims"),
    Check(13, "Insurance", "Missing payer names",
          "Every insurance claim should identify its payer.", "claims",
          lambda _: blank(c("PayerName"))),
    Check(14, "Insurance", "Negative claim charges",
          "Claim charge amounts should not be negative.", "claims",
          lambda _: c("TotalChargeAmount") < 0),
    Check(15, "Insurance", "Claim payments exceed charges",
          "The paid amount should not exceed the original claim charge without a documented adjustment.", "claims",
          lambda _: c("TotalPaidAmount") > c("TotalChargeAmount")),
    Check(16, "Insurance", "Denied claims missing denial reason",
          "Denied claims should contain a denial reason code.", "claims",
          lambda _: (c("IsDeniedClaim") == 1) & blank(c("PrimaryDenialReasonCode"))),
    Check(17, "Billing", "Duplicate invoice IDs",
          "Each invoice should have one unique invoice identifier.", "invoices"),
    Check(18, "Billing", "Negative invoice amounts",
          "Invoice amounts should not be negative.", "invoices",
          lambda _: c("InvoiceAmount") < 0),
    Check(19, "Billing", "Negative outstanding balances",
          "Outstanding balances should not be negative unless explicitly treated as credits.", "invoices",
          lambda _: c("OutstandingAmount") < 0),
    Check(20, "Billing", "Invoice payments exceed invoice amount",
          "Paid amounts should not exceed invoice totals without a refund or credit workflow.", "invoices",
          lambda _: c("PaidAmount") > F.coalesce(c("InvoiceAmount"), F.lit(0))),
    Check(21, "Billing", "Outstanding balance reconciliation",
          "Checks whether invoice amount minus payments equals the outstanding balance.", "invoices",
          lambda _: F.abs(
              F.coalesce(c("InvoiceAmount"), F.lit(0)) - c("PaidAmount") - F.coalesce(c("OutstandingAmount"), F.lit(0))
          ) > F.lit("0.01").cast("decimal(3,2)")),
    Check(22, "Telehealth", "Duplicate virtual visit IDs",
          "Each virtual visit should have one unique visit identifier.", "visits"),
    Check(23, "Telehealth", "Negative technical error counts",
          "Technical error counts cannot be negative.", "visits",
          lambda _: c("TechnicalErrorCount") < 0),
    Check(24, "Telehealth", "Missing telehealth platforms",
          "Virtual visits should record the platform used.", "visits",
          lambda _: blank(c("PlatformName"))),
    Check(25, "Telehealth", "Telehealth visits scheduled over one year ahead",
          "Flags virtual visits scheduled unusually far into the future.", "visits",
          lambda today: c("ScheduledStartDateTimeUTC") > today.year_later),
    Check(26, "AI", "Duplicate prediction IDs",
          "Each AI prediction should have one unique prediction identifier.", "predictions"),
    Check(27, "AI", "Missing AI model names",
          "Every prediction should identify the model that generated it.", "predictions",
          lambda _: blank(c("ModelName"))),
    Check(28, "AI", "Probability scores outside valid range",
          "Prediction probabilities should be between zero and one.", "predictions",
          lambda _: (c("ProbabilityScore") < 0) | (c("ProbabilityScore") > 1)),
    Check(29, "AI", "Risk scores outside expected range",
          "Risk scores are expected to remain between zero and 100.", "predictions",
          lambda _: (c("RiskScore") < 0) | (c("RiskScore") > 100)),
    Check(30, "AI", "Missing predicted classes",
          "Every AI prediction should have a predicted class.", "predictions",
          lambda _: blank(c("PredictedClass"))),
    Check(31, "AI", "Missing actual classes for evaluated predictions",
          "Evaluated predictions should include an actual observed class.", "predictions",
          lambda _: c("ConfusionMatrixCategory").isNotNull() & blank(c("ActualClass"))),
)


def _counts(frame: DataFrame, view: View, checks: list[Check], today: AsOf) -> DataFrame:
    """One row: the issue count of each check, in columns named by check id."""
    predicates = [check for check in checks if check.issue is not None]
    duplicates = [check for check in checks if check.issue is None]
    flags = [F.sum(flag(check.issue(today))).alias(check.id) for check in predicates]
    if not duplicates:
        return frame.agg(*flags)
    grouped = frame.groupBy(view.key).agg(F.count(F.lit(1)).alias("_n"), *flags)
    repeated = c("_n") > 1
    if view.skip_null_key:
        repeated = repeated & c(view.key).isNotNull()
    return grouped.agg(
        *(F.sum(flag(repeated)).alias(check.id) for check in duplicates),
        *(F.sum(check.id).alias(check.id) for check in predicates),
    )


def results(tables: Tables, as_of: str, checks: Iterable[Check] = CHECKS) -> DataFrame:
    """One row per check: id, area, name, issue count, PASS or WARNING, description."""
    today = moment_of(as_of)
    wanted = list(checks)
    frames = []
    for name, view in VIEWS.items():
        mine = [check for check in wanted if check.view == name]
        if not mine:
            continue
        one_row = _counts(view.build(tables, as_of), view, mine, today)
        entries = F.array(
            *(
                F.struct(
                    F.lit(check.number).alias("CheckID"),
                    F.lit(check.area).alias("QualityArea"),
                    F.lit(check.name).alias("CheckName"),
                    F.coalesce(c(check.id), F.lit(0)).cast("bigint").alias("IssueCount"),
                    F.lit(check.description).alias("CheckDescription"),
                )
                for check in mine
            )
        )
        frames.append(one_row.select(F.inline(entries)))
    stacked = frames[0]
    for frame in frames[1:]:
        stacked = stacked.unionByName(frame)
    return with_status(stacked)


def with_status(counted: DataFrame) -> DataFrame:
    status = F.when(c("IssueCount") == 0, "PASS").otherwise("WARNING")
    return counted.select(
        "CheckID", "QualityArea", "CheckName", "IssueCount", status.alias("QualityStatus"), "CheckDescription"
    )


def single(tables: Tables, as_of: str, number: int) -> DataFrame:
    """One check."""
    return results(tables, as_of, [check for check in CHECKS if check.number == number])


def detail_report(tables: Tables, as_of: str) -> DataFrame:
    """All checks, warnings first."""
    warning_first = F.when(c("QualityStatus") == "WARNING", 1).otherwise(2)
    return results(tables, as_of).orderBy(warning_first, "QualityArea", "CheckID")


def _score(name: str) -> list[Column]:
    passed = F.sum(flag(c("QualityStatus") == "PASS"))
    return [
        F.count(F.lit(1)).alias("TotalChecks"),
        passed.alias("PassedChecks"),
        F.sum(flag(c("QualityStatus") == "WARNING")).alias("WarningChecks"),
        F.sum("IssueCount").alias("TotalIssues"),
        percent(passed, F.count(F.lit(1)), RATE).alias(name),
    ]


def summary_by_area(tables: Tables, as_of: str) -> DataFrame:
    """D33"""
    return results(tables, as_of).groupBy("QualityArea").agg(*_score("PassRatePercent")).orderBy("QualityArea")


def enterprise_score(tables: Tables, as_of: str) -> DataFrame:
    """D34"""
    return results(tables, as_of).agg(*_score("EnterpriseDataQualityScorePercent"))
