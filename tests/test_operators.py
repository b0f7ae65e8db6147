import datetime as dt
import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from caremesa.operators import loading, profile, quality, risk_model
from caremesa.sources import files
from caremesa.sources.tables import frame_tables, parquet_tables
from tests.micro import micro_tables

AS_OF = "1999-06-30"


def test_duplicate_and_predicate_checks_share_one_pass(spark):
    tables = micro_tables(
        spark,
        clinical_patient=[
            {"PatientID": 1, "MedicalRecordNumber": "A", "FirstName": "x", "LastName": "y", "DateOfBirth": dt.date(1980, 1, 1)},
            {"PatientID": 2, "MedicalRecordNumber": "A", "FirstName": " ", "LastName": "y", "DateOfBirth": dt.date(2001, 1, 1)},
            {"PatientID": 3, "FirstName": "x", "LastName": None, "DateOfBirth": dt.date(1870, 1, 1)},
            {"PatientID": 4, "FirstName": "x", "LastName": "y"},
        ],
    )
    got = {r.CheckID: (r.IssueCount, r.QualityStatus) for r in quality.results(tables, AS_OF).collect()}
    assert len(got) == 31
    # NULL numbers are missing, not duplicates of each other.
    assert [got[i][0] for i in range(1, 6)] == [1, 2, 2, 1, 2]
    assert got[6] == (0, "PASS")
    total = quality.enterprise_score(tables, AS_OF).first()
    by_area = quality.summary_by_area(tables, AS_OF).collect()
    assert sum(r.TotalIssues for r in by_area) == total.TotalIssues == 8
    assert sum(r.TotalChecks for r in by_area) == total.TotalChecks == 31
    assert quality.single(tables, AS_OF, 3).first().IssueCount == 2


def test_append_twice_equals_append_once(spark, tmp_path):
    path = str(tmp_path / "target")
    first = spark.createDataFrame([(1, "a"), (2, "b")], "id bigint, v string")
    first.write.parquet(path)
    batch = spark.createDataFrame([(2, "again"), (3, "c"), (4, "d")], "id bigint, v string")
    for _ in range(2):
        loading.append_new(batch, path, ["id"])
        assert sorted(tuple(r) for r in spark.read.parquet(path).collect()) == [(1, "a"), (2, "b"), (3, "c"), (4, "d")]


def test_round_robin_and_slots(spark):
    people = spark.createDataFrame([(i * 7,) for i in range(23)], "p bigint")
    desks = spark.createDataFrame([(d,) for d in (3, 11, 40)], "d bigint")
    got = dict(sorted(tuple(r) for r in loading.round_robin(people, "p", desks, "d").select("p", "d").collect()))
    assert got == {i * 7: (3, 11, 40)[i % 3] for i in range(23)}
    slots = loading.expand_slots(people, people.p % 3).groupBy("p").count().collect()
    assert {r.p: r["count"] for r in slots} == {i * 7: i * 7 % 3 + 1 for i in range(23)}


def test_first_match_keeps_or_drops(spark):
    left = spark.createDataFrame([(1,), (2,)], "k int")
    right = spark.createDataFrame([(1, 5, "x"), (1, 3, "y")], "k int, o int, v string")
    assert [tuple(r) for r in loading.first_match(left, "k", right, ("o",), ("v",)).collect()] == [(1, 3, "y")]
    assert loading.first_match(left, "k", right, ("o",), ("v",), keep=True).count() == 2


def test_profile_edge_cases(spark):
    frame = spark.createDataFrame(
        [(1, None, None), (1, None, None), (2, float("nan"), None), (None, 1.0, None)], "a int, b double, c string"
    )
    row = profile.profile(frame, "odd").first()
    assert (row.rows, row["columns"], row.duplicate_rows, row.missing_values, row.empty_columns) == (4, 3, 1, 8, "c")
    nothing = profile.profile(frame.where("false"), "empty").first()
    assert (nothing.rows, nothing.duplicate_rows, nothing.missing_values) == (0, 0, 0)
    summary = profile.eda_summary({"b": frame, "a": frame}).collect()
    assert [r.dataset for r in summary] == ["a", "b"]


def test_csv_round_trip_and_missing_dataset(spark, tmp_path):
    folder = str(tmp_path)
    files.write_csv(spark.createDataFrame([(1, "x,y"), (2, None)], "id int, t string"), folder, "things")
    assert files.dataset_names(spark, folder) == ["things"]
    back = files.read_csv(spark, folder, "things")
    assert back.dtypes == [("id", "int"), ("t", "string")] and back.count() == 2
    with pytest.raises(FileNotFoundError, match="Dataset not found"):
        files.read_csv(spark, folder, "absent")


def test_failing_dataset_does_not_stop_the_others(spark, tmp_path):
    tables = micro_tables(spark)
    outcome = files.export_extracts(tables, str(tmp_path))
    assert outcome["patients"] == "SAVED" and len(outcome) == 6
    broken = frame_tables(spark, {"clinical_patient": tables.read("clinical_patient")})
    partial = files.export_extracts(broken, str(tmp_path / "second"))
    assert partial["patients"] == "SAVED" and partial["claims"].startswith("FAILED")


def test_parquet_tables_read_only_wanted_columns(spark, tmp_path):
    spark.range(5).selectExpr("id", "id * 2 as twice").write.parquet(str(tmp_path / "t.parquet"))
    tables = parquet_tables(spark, str(tmp_path), ["t"])
    assert tables.read("t", "twice").columns == ["twice"] and tables.names == ["t"]
    with pytest.raises(KeyError):
        tables.read("absent")


def sample_predictions(spark, size=400):
    rng = random.Random(5)
    rows = []
    for i in range(size):
        score = None if i % 29 == 0 else round(rng.random(), 3)
        label = None if i % 41 == 0 else ("High Risk" if (score or 0) > 0.5 else "Low Risk")
        rows.append((i, label, None, score, (score or 0.0) * 10, 0.5))
    schema = "PredictionID bigint, PredictedClass string, PredictedValue double, ProbabilityScore double, RiskScore double, ThresholdUsed double"
    return spark.createDataFrame(rows, schema)


def test_split_is_exact_per_class(spark):
    frame = risk_model.drop_untargeted(sample_predictions(spark))
    rows = risk_model.stratified_split(frame).collect()
    sizes = Counter(r.PredictedClass for r in rows)
    tests = Counter(r.PredictedClass for r in rows if r.IsTest)
    assert len(rows) == frame.count()
    assert tests == {label: int(n * 0.2 + 0.5) for label, n in sizes.items()}
    again = {r.PredictionID: r.IsTest for r in risk_model.stratified_split(frame.repartition(3)).collect()}
    assert again == {r.PredictionID: r.IsTest for r in rows}


def test_imputation_uses_all_rows_and_keeps_empty_columns(spark):
    rows = risk_model.prepared(sample_predictions(spark)).collect()
    assert all(r.ProbabilityScore is not None and r.PredictedValue is None for r in rows)
    coerced = risk_model.coerce_numeric(
        spark.createDataFrame([(1, "a", "1.5"), (2, "a", "oops")], "PredictionID bigint, PredictedClass string, RiskScore string")
    )
    assert [r.RiskScore for r in coerced.collect()] == [1.5, None]


def test_forest_is_repeatable_and_reads_the_signal(spark):
    frame = sample_predictions(spark)
    first, second = (risk_model.fit(frame, trees=10) for _ in range(2))
    assert first.features == ["ProbabilityScore", "RiskScore", "ThresholdUsed"]
    importances = [risk_model.feature_importance(f).collect() for f in (first, second)]
    assert importances[0] == importances[1]
    predictions = risk_model.predict(first)
    report = risk_model.accuracy_report(predictions).first()
    assert report.Accuracy == pytest.approx(risk_model.accuracy(predictions)) and report.Accuracy > 0.9
    assert risk_model.forest_summary(first).count() == 10


def test_classification_report(spark):
    pairs = [("a", "a")] * 3 + [("a", "b")] + [("b", "b")] * 2 + [("c", "a")]
    frame = spark.createDataFrame(pairs, "PredictedClass string, PredictedLabel string")
    got = {r.Class: (round(r.Precision, 4), round(r.Recall, 4), round(r.F1Score, 4), r.Support)
           for r in risk_model.classification_report(frame).collect()}
    assert got["a"] == (0.75, 0.75, 0.75, 4)
    assert got["b"] == (0.6667, 1.0, 0.8, 2)
    assert got["c"] == (0.0, 0.0, 0.0, 1)
    assert got["accuracy"][0] == round(5 / 7, 4)
    assert got["macro avg"] == (0.4722, 0.5833, 0.5167, 7)
    assert got["weighted avg"][0] == round((0.75 * 4 + 2 / 3 * 2) / 7, 4)


def test_training_tasks_are_bounded_in_rows(spark, monkeypatch):
    monkeypatch.setattr(risk_model, "TASK_ROWS", 20, raising=False)
    seen = {}

    class Stopped(Exception):
        pass

    def stop(_, training):
        seen["sizes"] = training.groupBy(F.spark_partition_id()).count().collect()
        seen["tasks"] = training.rdd.getNumPartitions()
        raise Stopped

    monkeypatch.setattr(risk_model.Pipeline, "fit", stop)
    frame = spark.range(400).selectExpr(
        "id as PredictionID", "if(id % 2 = 0, 'High Risk', 'Low Risk') as PredictedClass", "cast(id as double) as RiskScore"
    )
    with pytest.raises(Stopped):
        risk_model.fit(frame, trees=2)
    assert seen["tasks"] == 16 and sum(size["count"] for size in seen["sizes"]) == 320
    monkeypatch.setattr(risk_model, "TASK_ROWS", 1_000_000, raising=False)
    with pytest.raises(Stopped):
        risk_model.fit(frame, trees=2)
    assert seen["tasks"] == spark.sparkContext.defaultParallelism  # few rows still use every core
