"""One case per documented behaviour of the views."""

import datetime as dt
from decimal import Decimal as D

from caremesa.plans import kpis, views
from caremesa.plans import library
from tests.micro import micro_tables

AS_OF = "1999-06-30"
T = dt.datetime


def invoice(number, due=None):
    return {
        "InvoiceID": number, "PatientAccountID": 1, "PatientID": 1, "InvoiceDate": dt.date(1999, 1, 1), "DueDate": due,
    }


def line(number, amount):
    return {"InvoiceID": number, "LineAmount": D(amount)}


def paid(number, amount, status="Posted"):
    return {"InvoiceID": number, "AllocatedAmount": D(amount), "AllocationStatus": status}


def encounter(number, **values):
    return {
        "EncounterID": number, "PatientID": 1, "HospitalID": 1, "DepartmentID": 1, "ProviderID": 1,
        "EncounterType": "Emergency", "IsTelehealth": False, "AdmissionDateTimeUTC": T(1999, 1, 1, 10), **values,
    }


def claim(number, **values):
    return {
        "ClaimID": number, "PatientID": 1, "PatientCoverageID": 1, "ProviderID": 1, "HospitalID": 1,
        "ServiceStartDate": dt.date(1999, 1, 5), "ServiceEndDate": dt.date(1999, 1, 6), "ClaimStatus": "Approved", **values,
    }


def claim_line(number, charge="10", paid_amount="7", status="Paid", reason=None):
    return {
        "ClaimLineID": number * 10, "ClaimID": number, "ChargeAmount": D(charge), "PaidAmount": D(paid_amount),
        "LineStatus": status, "DenialReasonCode": reason,
    }


def prediction(number, label="Low Risk", **values):
    return {
        "PredictionID": number, "ModelVersionID": 1, "PatientID": 1, "PredictedClass": label,
        "PredictionDateTimeUTC": T(1999, 1, 1), **values,
    }


def outcome(number, label, final=True):
    return {"PredictionID": number, "PredictionOutcomeID": number, "ActualClass": label, "IsFinalOutcome": final}


def test_allocation_counts_once_per_invoice_line(spark):
    tables = micro_tables(
        spark, billing_invoice=[invoice(1)], billing_invoiceline=[line(1, "30"), line(1, "20")],
        billing_paymentallocation=[paid(1, "10"), paid(1, "99", "Reversed")],
    )
    row = views.patient_360(tables, AS_OF).first()
    assert (row.TotalBilledAmount, row.TotalPaidAmount, row.EstimatedOutstandingAmount) == (D("50"), D("20"), D("30"))
    assert views.patient_360(tables, AS_OF, exact_paid=True).first().TotalPaidAmount == D("10")


def test_hospital_claims_are_counted_per_line(spark):
    tables = micro_tables(
        spark, insurance_claim=[claim(1, ClaimStatus="Denied"), claim(2)],
        insurance_claimline=[claim_line(1), claim_line(1), claim_line(1)],
    )
    row = views.hospital_executive_summary(tables).first()
    assert (row.TotalClaims, row.DeniedClaims, row.TotalChargeAmount) == (4, 3, D("30"))
    exact = views.hospital_executive_summary(tables, exact_claims=True).first()
    assert (exact.TotalClaims, exact.DeniedClaims) == (2, 1)


def test_primary_denial_reason_is_the_last_in_the_alphabet(spark):
    tables = micro_tables(
        spark, insurance_claim=[claim(1)],
        insurance_claimline=[claim_line(1, status="Denied", reason="CO-16"), claim_line(1, status="Denied", reason="PR-1")],
    )
    row = views.claim_denial_analysis(tables).first()
    assert (row.PrimaryDenialReasonCode, row.DeniedClaimLineCount, row.IsDeniedClaim) == ("PR-1", 2, 1)


def test_outcome_without_class_is_a_true_negative_and_wrong(spark):
    tables = micro_tables(
        spark,
        ai_prediction=[prediction(1, "High Risk"), prediction(2), prediction(3, None), prediction(4), prediction(5, "High Risk")],
        ai_predictionoutcome=[
            outcome(1, None), outcome(2, "High Risk"), outcome(3, "High Risk"), outcome(4, "Low Risk", final=False),
            outcome(5, "Low Risk"),
        ],
    )
    got = {r.PredictionID: (r.IsCorrectPrediction, r.ConfusionMatrixCategory) for r in views.prediction_performance(tables).collect()}
    assert got == {
        1: (0, "True Negative"), 2: (0, "False Negative"), 3: (0, "True Negative"), 4: (None, None),
        5: (0, "False Positive"),
    }
    summary = kpis.model_performance(tables).first()
    parts = summary.TruePositives + summary.FalsePositives + summary.TrueNegatives + summary.FalseNegatives
    assert parts == summary.PredictionsWithOutcome == 4
    assert summary.PrecisionPercent == D("0.00") and summary.RecallPercent == D("0.00")


def test_months_are_anchored_on_one_side(spark):
    tables = micro_tables(
        spark, clinical_encounter=[encounter(1)],
        insurance_claim=[claim(1, ServiceStartDate=dt.date(1999, 3, 1), ServiceEndDate=dt.date(1999, 3, 2))],
        insurance_claimline=[claim_line(1)], billing_invoice=[invoice(1)], billing_invoiceline=[line(1, "5")],
    )
    hospital = kpis.hospital_monthly_performance(tables).collect()
    assert [(r.KPI_Month, r.TotalClaims) for r in hospital] == [(dt.date(1999, 1, 1), 0)]
    revenue = kpis.revenue_cycle_monthly(tables, AS_OF).collect()
    assert [(r.KPI_Month, r.TotalInvoices, r.TotalCollectedAmount) for r in revenue] == [(dt.date(1999, 3, 1), 0, D("7.00"))]


def test_encounter_without_provider_is_left_out(spark):
    tables = micro_tables(
        spark, clinical_encounter=[encounter(1, ProviderID=None)],
        clinical_diagnosis=[{"DiagnosisID": 1, "EncounterID": 1, "PatientID": 1, "DiagnosisCode": "A"}],
    )
    assert views.encounter_details(tables).count() == 0
    # The patient then counts as one without encounters.
    assert [r.PatientID for r in library.patients_without_encounters(tables, AS_OF).collect()] == [1]


def test_children_are_counted_without_multiplying(spark):
    tables = micro_tables(
        spark, clinical_encounter=[encounter(1), encounter(2)],
        clinical_diagnosis=[{"DiagnosisID": i, "EncounterID": 1, "PatientID": 1} for i in range(3)],
        clinical_procedure=[{"ProcedureID": i, "EncounterID": 1} for i in range(2)],
        clinical_medicationorder=[{"MedicationOrderID": 1, "EncounterID": 1}],
    )
    got = {r.EncounterID: (r.DiagnosisCount, r.ProcedureCount, r.MedicationOrderCount)
           for r in views.encounter_details(tables).collect()}
    assert got == {1: (3, 2, 1), 2: (0, 0, 0)}


def test_invoice_status_order_and_days_past_due(spark):
    late, today = dt.date(1999, 6, 1), dt.date(1999, 6, 30)
    tables = micro_tables(
        spark,
        billing_invoice=[invoice(1, late), invoice(2, late), invoice(3, today), invoice(4), invoice(5, late), invoice(6, today)],
        billing_invoiceline=[line(i, "100") for i in range(1, 7)],
        billing_paymentallocation=[paid(1, "100"), paid(2, "40"), paid(3, "40"), paid(5, "130")],
    )
    got = {r.InvoiceID: (r.DerivedPaymentStatus, r.DaysPastDue, r.OutstandingAmount)
           for r in views.patient_billing_summary(tables, AS_OF).collect()}
    assert got == {
        1: ("Paid", 0, D("0.00")),
        2: ("Overdue", 29, D("60.00")),
        3: ("Partially Paid", 0, D("60.00")),
        4: ("Open", None, D("100.00")),
        5: ("Paid", 0, D("-30.00")),
        6: ("Open", 0, D("100.00")),
    }


def test_claims_of_a_provider_show_in_every_department(spark):
    tables = micro_tables(
        spark, clinical_encounter=[encounter(1), encounter(2, DepartmentID=2)],
        insurance_claim=[claim(1)], insurance_claimline=[claim_line(1)],
    )
    got = sorted((r.DepartmentID, r.TotalClaims, r.PaidAmountPerEncounter) for r in kpis.provider_productivity(tables).collect())
    assert got == [(1, 1, D("7.00")), (2, 1, D("7.00"))]


def test_rates_without_denominator_are_null(spark):
    tables = micro_tables(spark, insurance_claim=[claim(1), claim(2)], insurance_claimline=[claim_line(2, "0", "0")])
    assert [r.PaidToChargePercent for r in views.claim_financials(tables).collect()] == [None, None]
    empty = kpis.enterprise_scorecard(micro_tables(spark), AS_OF).collect()
    assert len(empty) == 1 and empty[0].TotalEncounters == 0 and empty[0].PredictionAccuracyPercent is None


def test_latest_prediction_and_tier(spark):
    tables = micro_tables(
        spark, clinical_encounter=[encounter(1), encounter(2)],
        ai_prediction=[prediction(1, "High Risk"), prediction(2, "Low Risk"), prediction(3, "High Risk", PredictionDateTimeUTC=T(1998, 1, 1))],
    )
    row = kpis.patient_risk_population(tables, AS_OF).first()
    assert (row.LatestPredictedClass, row.DerivedPatientRiskTier, row.NeedsCareManagementReview) == ("Low Risk", "Medium", 1)


def test_readmission_gaps(spark):
    at = [T(1999, 1, 1, 8), T(1999, 1, 1, 8), T(1999, 1, 2, 1), T(1999, 2, 1), T(1999, 3, 4), None]
    tables = micro_tables(spark, clinical_encounter=[encounter(i, AdmissionDateTimeUTC=when) for i, when in enumerate(at)])
    gaps = {r.EncounterID: r.DaysSincePreviousEncounter for r in library.days_since_previous(tables).collect()}
    # The undated encounter sorts first, so the earliest dated one has no predecessor either.
    assert gaps == {1: 0, 2: 1, 3: 30, 4: 31}
    assert sorted(r.EncounterID for r in library.readmissions(tables).collect()) == [2, 3]
    assert library.first_and_latest_encounter(tables).first().FirstEncounterDate is None


def test_pivot_keeps_months_without_listed_types(spark):
    tables = micro_tables(
        spark, clinical_encounter=[encounter(1, EncounterType="Surgery"), encounter(2, AdmissionDateTimeUTC=T(1999, 2, 1))]
    )
    got = [tuple(r) for r in library.encounter_type_pivot(tables).collect()]
    assert got == [(dt.date(1999, 1, 1), 0, 0, 0, 0), (dt.date(1999, 2, 1), 1, 0, 0, 0)]


def test_calendar_fills_missing_months(spark):
    tables = micro_tables(
        spark, insurance_claim=[claim(1), claim(2, ServiceStartDate=dt.date(1999, 3, 9))],
        insurance_claimline=[claim_line(1), claim_line(2)],
    )
    got = [(r.CalendarMonth.month, r.TotalCollectedAmount) for r in library.month_calendar(tables, AS_OF).collect()]
    assert got == [(1, D("7.00")), (2, D("0.00")), (3, D("7.00"))]


def test_second_highest_keeps_ties(spark):
    tables = micro_tables(
        spark,
        hospital_provider=[{"ProviderID": i, "FirstName": "Dr", "LastName": str(i), "HospitalID": 1} for i in range(4)],
        clinical_encounter=[encounter(i, ProviderID=p) for i, p in enumerate([0, 0, 0, 1, 1, 2, 2, 3])],
    )
    assert sorted(r.ProviderID for r in library.second_highest_provider(tables).collect()) == [1, 2]
    single = micro_tables(spark, clinical_encounter=[encounter(1)])
    assert library.second_highest_provider(single).count() == 0
