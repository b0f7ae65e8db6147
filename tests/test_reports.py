import contextlib
import datetime as dt
import io

import pytest

from caremesa import registry
from caremesa.plans import library, reports
from caremesa.sources.tables import parquet_tables
from tests.micro import micro_tables

AS_OF = "1999-06-30"
WRONG_ORDER = {"start": "1999-02-01", "end": "1999-01-01"}
CASES = [
    (51001, reports.patient_360, {}),
    (51002, reports.hospital_performance, WRONG_ORDER),
    (51003, reports.provider_productivity, {"min_encounters": -1}),
    (51004, reports.claim_denial_report, WRONG_ORDER),
    (51005, reports.claim_denial_report, {"min_rate": 101}),
    (51006, reports.monthly_revenue_cycle, WRONG_ORDER),
    (51007, reports.telehealth_operations, WRONG_ORDER),
    (51008, reports.high_risk_worklist, {"tier": "Severe"}),
    (51009, reports.model_performance, {"min_predictions": -1}),
    (51010, reports.patient_encounter_history, {}),
    (51011, reports.patient_encounter_history, {"patient_id": 1, **WRONG_ORDER}),
    (51012, reports.patient_billing_detail, {}),
    (51013, reports.top_executive_exceptions, {"top_n": 0}),
    (51013, reports.top_executive_exceptions, {"top_n": 1001}),
    (51013, reports.top_executive_exceptions, {"top_n": None}),
    (51002, reports.hospital_performance, {"end": "1899-12-31"}),
]


@pytest.mark.parametrize("number, report, arguments", CASES)
def test_wrong_arguments_raise_before_any_work(number, report, arguments):
    with pytest.raises(ValueError) as caught:
        report(None, AS_OF, **arguments)  # no tables are touched
    assert str(caught.value) == reports.ERRORS[number]
    assert caught.value.number == number


def test_filters(spark):
    tables = micro_tables(
        spark,
        clinical_patient=[{"PatientID": i, "MedicalRecordNumber": f"M{i}"} for i in (1, 2)],
    )
    assert [r.PatientID for r in reports.patient_360(tables, AS_OF, mrn="M2").collect()] == [2]
    assert reports.patient_360(tables, AS_OF, patient_id=1, mrn="M2").count() == 0
    assert set(reports.top_executive_exceptions(tables, AS_OF)) == {"outstanding", "denials", "no_shows"}


def formatted_plan(frame):
    printed = io.StringIO()
    with contextlib.redirect_stdout(printed):
        frame.explain("formatted")
    return printed.getvalue()


def test_months_are_taken_whole_and_cut_at_the_scan(spark, tmp_path):
    days = [dt.date(1999, 1, 31), dt.date(1999, 2, 1), dt.date(1999, 2, 28), dt.date(1999, 3, 31), dt.date(1999, 4, 1)]
    claims = [
        {"ClaimID": i, "PatientID": 1, "PatientCoverageID": 1, "ProviderID": 1, "HospitalID": 1, "ServiceStartDate": day}
        for i, day in enumerate(days)
    ]
    tables = micro_tables(spark, insurance_claim=claims)
    for name in tables.names:
        tables.read(name).write.parquet(str(tmp_path / f"{name}.parquet"))
    stored = parquet_tables(spark, str(tmp_path), tables.names)
    report = reports.monthly_revenue_cycle(stored, AS_OF, start="1999-02-15", end="1999-03-02")
    assert [(r.KPI_Month.month, r.TotalClaims) for r in report.collect()] == [(2, 2), (3, 1)]
    plan = formatted_plan(report)
    assert "GreaterThanOrEqual(ServiceStartDate,1999-02-01)" in plan and "LessThan(ServiceStartDate,1999-04-01)" in plan
    telehealth = formatted_plan(reports.telehealth_operations(stored, start="1999-02-15"))
    assert "GreaterThanOrEqual(ScheduledStartDateTimeUTC,1999-02-01" in telehealth


def test_the_registered_hospital_report_has_every_month(spark):
    days = [dt.datetime(1990, 5, 3), dt.datetime(1995, 6, 7), dt.datetime(2001, 2, 28)]
    encounters = [
        {"EncounterID": i, "PatientID": 1, "HospitalID": 1, "DepartmentID": 1, "ProviderID": 1, "AdmissionDateTimeUTC": day}
        for i, day in enumerate(days)
    ]
    claims = [
        {"ClaimID": i, "PatientID": 1, "PatientCoverageID": 1, "ProviderID": 1, "HospitalID": 1, "ServiceStartDate": day.date()}
        for i, day in enumerate(days)
    ]
    tables = micro_tables(spark, clinical_encounter=encounters, insurance_claim=claims)
    months = {
        key: [(r.KPI_Month.year, r.TotalEncounters, r.TotalClaims) for r in registry.REPORTS[key](tables).collect()] for key in ("P03", "P03a")
    }
    assert months == {"P03": [(1990, 1, 1), (1995, 1, 1), (2001, 1, 1)], "P03a": [(1995, 1, 1)]}


def test_inventory_lists_every_report(spark):
    listed = [r.ReportName for r in library.report_inventory(micro_tables(spark)).collect()]
    assert listed == sorted(reports.REPORTS) and len(listed) == 12
