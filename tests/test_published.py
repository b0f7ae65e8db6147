"""Published views with observed checks, stored monthly views, snapshots of datasets, collated text."""

import datetime as dt
import os
import pathlib

import pytest
from pyspark.sql import functions as F

from caremesa.functions import as_date, as_moment
from caremesa.operators import constraints, loading, monthly, publish, quality
from caremesa.operators.constraints import KeyRule, RowRule
from caremesa.plans import kpis, views
from caremesa.sources.derived import AS_OF, derived_tables
from caremesa.sources.snapshots import Conflict, SnapshotDataset
from caremesa.sources.tables import frame_tables
from tests.micro import micro_tables

FOLDER = "/root/testdata/sf0.001"
needs_data = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="data folder missing")


def texts(frame):
    return sorted(map(str, frame.collect()))


@needs_data
def test_checks_are_a_by_product_of_one_write(spark, tmp_path, monkeypatch):
    tables = derived_tables(spark, FOLDER)
    built = []
    for name, view in quality.VIEWS.items():
        monkeypatch.setitem(quality.VIEWS, name, quality.View(lambda t, a, v=view, n=name: built.append(n) or v.build(t, a), view.key, view.skip_null_key))
    stored, report = publish.publish(tables, AS_OF, f"file://{tmp_path}")
    assert built == list(quality.VIEWS)
    assert texts(report) == texts(quality.results(tables, AS_OF).select(*report.columns))
    assert stored.read("encounters").count() == views.encounter_details(tables).count()
    _, some = publish.publish(tables, AS_OF, f"file://{tmp_path}/again", ["visits"])
    assert {row["CheckID"] for row in some.collect()} == {22, 23, 24, 25}


def test_as_of_may_have_a_time_of_day(spark):
    encounter = {"PatientID": 1, "HospitalID": 1, "DepartmentID": 1, "ProviderID": 1, "EncounterType": "Emergency"}
    tables = micro_tables(
        spark,
        clinical_encounter=[{**encounter, "EncounterID": i, "AdmissionDateTimeUTC": dt.datetime(1999, 6, 30, 9 + i)} for i in range(3)],
        clinical_patient=[{"PatientID": 1, "DateOfBirth": dt.date(1999, 6, 30)}], hospital_hospital=[{"HospitalID": 1}],
        hospital_department=[{"DepartmentID": 1}], hospital_provider=[{"ProviderID": 1, "HospitalID": 1}],
        telehealth_virtualvisit=[
            {"VirtualVisitID": i, "EncounterID": 0, "PatientID": 1, "HospitalID": 1, "DepartmentID": 1, "ProviderID": 1,
             "ScheduledStartDateTimeUTC": dt.datetime(2000, 6, 30, 9 + i)} for i in range(3)
        ],
    )
    issues = lambda as_of, number: quality.single(tables, as_of, number).first().IssueCount
    assert [issues(as_of, 10) for as_of in ("1999-06-30", "1999-06-30 10:00:00", dt.datetime(1999, 6, 30, 23))] == [3, 1, 0]
    assert [issues(as_of, 25) for as_of in ("1999-06-30", "1999-06-30 10:00:00", dt.datetime(1999, 6, 30, 23))] == [3, 1, 0]
    assert [issues(as_of, 4) for as_of in ("1999-06-30 00:00:01", "1999-06-29 23:59:59")] == [0, 1]
    assert as_date(dt.datetime(1999, 1, 2, 3)) == as_date("1999-01-02 03:00") == dt.date(1999, 1, 2)
    assert as_moment(dt.date(1999, 1, 2)) == dt.datetime(1999, 1, 2)


# -- monthly stores -----------------------------------------------------------------


def test_neighbouring_months_are_taken_together():
    assert monthly.spans(["1999-12-24", "2000-01-01", "1999-03-31", "2000-01-09"]) == [
        (dt.date(1999, 3, 1), dt.date(1999, 4, 1)), (dt.date(1999, 12, 1), dt.date(2000, 2, 1)),
    ]


def files(folder):
    return {str(path): path.stat().st_mtime_ns for path in pathlib.Path(folder).rglob("*.parquet")}


@needs_data
@pytest.mark.parametrize("view", sorted(monthly.VIEWS))
def test_refresh_of_months_equals_full_recomputation(spark, tmp_path, view):
    tables = derived_tables(spark, FOLDER)
    store = monthly.MonthlyStore(spark, view, f"file://{tmp_path}", AS_OF)
    store.build(tables)
    before = files(tmp_path)
    # facts of two neighbouring months change, and those of a third go
    def changed(name, date, column):
        def load(columns):
            rows = tables.read(name, *(dict.fromkeys((*columns, date)) if columns else ()))
            month = F.date_format(date, "yyyy-MM")
            rows = rows.where(month != "1997-03")
            if column in rows.columns:
                rows = rows.withColumn(column, F.when(month.isin("1995-05", "1995-06"), None).otherwise(F.col(column)))
            return rows.select(*(columns or rows.columns))
        return load
    now = tables.replaced({
        "clinical_encounter": changed("clinical_encounter", "AdmissionDateTimeUTC", "DischargeDateTimeUTC"),
        "insurance_claim": changed("insurance_claim", "ServiceStartDate", "ClaimStatus"),
        "telehealth_virtualvisit": changed("telehealth_virtualvisit", "ScheduledStartDateTimeUTC", "VisitStatus"),
    })
    store.refresh(now, ["1995-05-01", "1995-06-15", "1997-03-03"])
    build, _, _ = monthly.VIEWS[view]
    whole = build(now, AS_OF, kpis.ALWAYS)
    assert texts(store.read().select(*whole.columns)) == texts(whole)
    assert not (tmp_path / "Month=1997-03").exists()
    after = files(tmp_path)
    touched = {path.split("Month=")[1][:7] for path in before.keys() ^ after.keys()}
    months = {path.split("Month=")[1][:7] for path in before.keys() | after.keys()}
    assert touched == {"1995-05", "1995-06", "1997-03"} & months and len(touched) >= 2
    assert all(after[path] == before[path] for path in before.keys() & after.keys())


@needs_data
def test_only_the_wanted_partitions_are_read(spark, tmp_path):
    store = monthly.MonthlyStore(spark, "V16", f"file://{tmp_path}", AS_OF)
    tables = derived_tables(spark, FOLDER)
    store.build(tables)
    plan = store.read("1996-02-01", "1996-04-30")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(Month" in plan
    assert {row["KPI_Month"] for row in store.read("1996-02-01", "1996-04-30").collect()} <= {dt.date(1996, m, 1) for m in (2, 3, 4)}
    months = store._rows(tables, (dt.date(1996, 2, 1), dt.date(1996, 3, 1)))._jdf.queryExecution().executedPlan().toString()
    assert "LeftSemi" in months  # child facts are cut to the parents of the month


# -- snapshots ------------------------------------------------------------------------


@pytest.fixture
def dataset(spark, tmp_path):
    return SnapshotDataset(spark, f"file://{tmp_path}/set", spark.createDataFrame([], "id bigint, v string").schema)


def rows(dataset, version=None):
    return sorted(map(tuple, dataset.read(version).collect()), key=str)


def batch(spark, *pairs):
    return spark.createDataFrame(list(pairs), "id bigint, v string")


def test_appends_are_idempotent_and_readers_keep_their_snapshot(spark, dataset):
    assert rows(dataset) == [] and dataset.versions() == []
    assert loading.append_snapshot(batch(spark, (1, "a"), (2, "b"), (None, "n")), dataset, ["id"]) == 1
    again = batch(spark, (2, "again"), (3, "c"))
    assert loading.append_snapshot(again, dataset, ["id"]) == 2 and loading.append_snapshot(again, dataset, ["id"]) == 3
    assert rows(dataset, 1) == [(1, "a"), (2, "b"), (None, "n")]
    assert sorted(dataset.read().where("id is not null").select("id").toPandas()["id"]) == [1, 2, 3]


def test_a_run_broken_between_write_and_commit_leaves_no_trace(spark, dataset):
    dataset.append_new(batch(spark, (1, "a")), ["id"])

    def broken():
        raise RuntimeError("stop")

    with pytest.raises(RuntimeError):
        dataset.append_new(batch(spark, (2, "b")), ["id"], before_commit=broken)
    assert rows(dataset) == [(1, "a")] and len(dataset.unlisted()) == 1
    dataset.append_new(batch(spark, (2, "b")), ["id"])
    assert rows(dataset) == [(1, "a"), (2, "b")] and len(dataset.unlisted()) == 1


def test_two_interleaved_writers_cannot_both_add_a_key(spark, dataset):
    dataset.append_new(batch(spark, (1, "a")), ["id"])
    other = SnapshotDataset(spark, dataset.folder, dataset.schema)
    turns = []

    def meanwhile():
        if not turns:
            turns.append(other.append_new(batch(spark, (2, "other"), (3, "other")), ["id"]))

    assert dataset.append_new(batch(spark, (2, "mine"), (4, "mine")), ["id"], before_commit=meanwhile) == 3
    assert turns == [2] and rows(dataset) == [(1, "a"), (2, "other"), (3, "other"), (4, "mine")]

    def always():
        other.append_new(batch(spark), ["id"])

    with pytest.raises(Conflict):
        dataset.append_new(batch(spark, (9, "x")), ["id"], attempts=2, before_commit=always)
    assert (9, "x") not in rows(dataset)
    with pytest.raises(Conflict):
        dataset.commit(1, [])


# -- collation ------------------------------------------------------------------------


def test_collation_of_keys_groups_and_labels(spark):
    tables = micro_tables(
        spark,
        clinical_patient=[{"PatientID": i, "MedicalRecordNumber": text, "FirstName": "x", "LastName": "y"} for i, text in enumerate(["A1", "a1 ", "b", None])],
    )
    assert quality.single(tables, AS_OF, 1).first().IssueCount == 0
    assert quality.single(tables.collated(), AS_OF, 1).first().IssueCount == 1


def test_collation_in_views_and_rules(spark):
    plain = frame_tables(spark, {
        "t": spark.createDataFrame([("Paid", "K", 1), ("PAID ", "k ", 1), ("Lost", "q", 1)], "Status string, Code string, n int"),
    })
    keys = [KeyRule("code", "t", ("Code", "n"))]
    labels = [RowRule("label", "t", "Status in ('Paid', 'Open')")]
    counts = lambda t: [r.Violations for check in (constraints.check_keys(t, keys), constraints.check_rows(t, labels, AS_OF)) for r in check.collect()]
    assert counts(plain) == [0, 2] and counts(plain.collated()) == [1, 1] and counts(plain.collated("UNICODE_CI")) == [0, 2]
    assert constraints.check_keys(plain.collated("UNICODE_CI_RTRIM"), keys).first().Violations == 1


def test_claims_view_with_collated_labels(spark):
    claim = {"PatientID": 1, "HospitalID": 1, "ProviderID": 1, "EncounterID": 1, "PatientCoverageID": 1, "ClaimType": "Other"}
    tables = micro_tables(
        spark,
        insurance_claim=[{**claim, "ClaimID": i, "ClaimStatus": status} for i, status in enumerate(["Denied", "denied ", "Paid"])],
        clinical_patient=[{"PatientID": 1}], hospital_hospital=[{"HospitalID": 1}], hospital_provider=[{"ProviderID": 1, "HospitalID": 1}],
        clinical_encounter=[{"EncounterID": 1, "PatientID": 1, "HospitalID": 1, "DepartmentID": 1, "ProviderID": 1}],
        insurance_patientcoverage=[{"PatientCoverageID": 1, "PatientID": 1, "InsurancePlanID": 1}],
        insurance_insuranceplan=[{"InsurancePlanID": 1, "PayerID": 1}], insurance_payer=[{"PayerID": 1}],
    )
    denied = lambda t: sorted(r.IsDeniedClaim for r in views.claim_financials(t).collect())
    assert denied(tables) == [0, 0, 1] and denied(tables.collated()) == [0, 1, 1]
