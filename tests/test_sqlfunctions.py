"""Reports as SQL table functions: equal to the Python form, with its errors and its pushdown."""

import os

import pytest

from caremesa.plans import reports, sqlfunctions
from caremesa.sources.derived import AS_OF, derived_tables

FOLDER = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="data folder missing")


@pytest.fixture(scope="module")
def tables(spark):
    tables = derived_tables(spark, FOLDER)
    assert len(sqlfunctions.register(tables, AS_OF)) == 12
    return tables


def exceptions(tables, top_n):
    found = list(reports.top_executive_exceptions(tables, AS_OF, top_n).values())
    return found[0].unionByName(found[1]).unionByName(found[2])


CASES = [
    ("enterprise_dashboard()", lambda t: reports.enterprise_dashboard(t, AS_OF)),
    ("patient_360(1)", lambda t: reports.patient_360(t, AS_OF, patient_id=1)),
    ("patient_360(mrn => 'MRN-000000000007')", lambda t: reports.patient_360(t, AS_OF, mrn="MRN-000000000007")),
    ("hospital_performance(1, date'1994-02-10', date'1997-09-20')", lambda t: reports.hospital_performance(t, hospital_id=1, start="1994-02-10", end="1997-09-20")),
    ("hospital_performance()", lambda t: reports.hospital_performance(t)),
    ("provider_productivity(min_encounters => 100)", lambda t: reports.provider_productivity(t, min_encounters=100)),
    ("provider_productivity(2, 11)", lambda t: reports.provider_productivity(t, hospital_id=2, department_id=11)),
    ("claim_denial_report(date'1996-03-15', date'1998-07-10', min_rate => 5)", lambda t: reports.claim_denial_report(t, start="1996-03-15", end="1998-07-10", min_rate=5)),
    ("monthly_revenue_cycle(start_date => date'1996-03-15')", lambda t: reports.monthly_revenue_cycle(t, AS_OF, start="1996-03-15")),
    ("telehealth_operations(end_date => date'1999-12-31', hospital_id => 1)", lambda t: reports.telehealth_operations(t, end="1999-12-31", hospital_id=1)),
    ("high_risk_worklist('High')", lambda t: reports.high_risk_worklist(t, AS_OF, tier="High")),
    ("high_risk_worklist(needs_review_only => false, min_outstanding => 1000)", lambda t: reports.high_risk_worklist(t, AS_OF, min_outstanding=1000, needs_review_only=False)),
    ("model_performance(min_predictions => 1)", lambda t: reports.model_performance(t, min_predictions=1)),
    ("patient_encounter_history(1)", lambda t: reports.patient_encounter_history(t, patient_id=1)),
    ("patient_encounter_history(1, date'1996-01-01', date'1997-06-30')", lambda t: reports.patient_encounter_history(t, patient_id=1, start="1996-01-01", end="1997-06-30")),
    ("patient_billing_detail(1)", lambda t: reports.patient_billing_detail(t, AS_OF, patient_id=1)),
    ("patient_billing_detail(patient_id => 4, only_outstanding => true)", lambda t: reports.patient_billing_detail(t, AS_OF, patient_id=4, only_outstanding=True)),
    ("top_executive_exceptions()", lambda t: exceptions(t, 20)), ("top_executive_exceptions(3)", lambda t: exceptions(t, 3)),
]


@pytest.mark.parametrize(("call", "report"), CASES, ids=[call for call, _ in CASES])
def test_function_equals_report(spark, tables, call, report):
    expected = report(tables)
    found = spark.sql(f"select * from {call}")
    assert found.columns == expected.columns
    assert sorted(map(str, found.collect())) == sorted(map(str, expected.collect()))


def test_functions_are_part_of_larger_queries(spark, tables):
    joined = spark.sql("select p.PatientID, count(*) as n from patient_360(1) p join patient_encounter_history(1) e on e.PatientID = p.PatientID group by 1")
    history = reports.patient_encounter_history(tables, patient_id=1).count()
    assert [tuple(row) for row in joined.collect()] == ([(1, history)] if history else [])


@pytest.mark.parametrize(
    ("call", "number"),
    [
        ("patient_360()", 51001), ("hospital_performance(1, date'1999-02-01', date'1999-01-01')", 51002), ("provider_productivity(min_encounters => -1)", 51003),
        ("claim_denial_report(date'1999-02-01', date'1999-01-01')", 51004), ("claim_denial_report(min_rate => 101)", 51005),
        ("monthly_revenue_cycle(date'1999-02-01', date'1999-01-01')", 51006), ("telehealth_operations(date'1999-02-01', date'1999-01-01')", 51007),
        ("high_risk_worklist('Severe')", 51008), ("model_performance(min_predictions => -1)", 51009), ("patient_encounter_history()", 51010),
        ("patient_encounter_history(1, date'1999-02-01', date'1999-01-01')", 51011), ("patient_billing_detail()", 51012),
        ("top_executive_exceptions(0)", 51013), ("top_executive_exceptions(1001)", 51013),
    ],
)
def test_refused_arguments_raise_their_text(spark, tables, call, number):
    with pytest.raises(Exception, match=reports.ERRORS[number].split(",")[0]):
        spark.sql(f"select * from {call}").collect()


def test_patient_filter_reaches_the_scans(spark, tables):
    plan = spark.sql("select * from patient_360(1)")._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters: [IsNotNull(c_custkey), EqualTo(c_custkey,1)]" in plan
