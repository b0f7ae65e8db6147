"""Query ids mapped to plans over the derived tables of one data folder."""

from __future__ import annotations

import zlib
from collections.abc import Callable
from weakref import WeakKeyDictionary

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from caremesa.operators import constraints, integrity, loading, monthly, profile, publish, quality, risk_model
from caremesa.operators.register import RuleRegister
from caremesa.plans import kpis, library, reports, rules, views
from caremesa.sources import files
from caremesa.sources.derived import AS_OF, derived_tables
from caremesa.sources.shared import shared_folder
from caremesa.sources.snapshots import SnapshotDataset
from caremesa.sources.tables import Tables

Query = Callable[[SparkSession, str], DataFrame]

VIEWS: dict[str, Callable[[Tables], DataFrame]] = {
    "V01": lambda t: views.patient_360(t, AS_OF),
    "V02": views.encounter_details,
    "V03": views.clinical_utilization_monthly,
    "V04": views.telehealth_performance,
    "V05": views.claim_financials,
    "V06": views.claim_denial_analysis,
    "V07": lambda t: views.patient_billing_summary(t, AS_OF),
    "V08": views.marketing_campaign_performance,
    "V09": views.prediction_performance,
    "V10": views.hospital_executive_summary,
    "V11": lambda t: kpis.enterprise_scorecard(t, AS_OF),
    "V12": kpis.hospital_monthly_performance,
    "V13": kpis.provider_productivity,
    "V14": kpis.telehealth_monthly,
    "V15": lambda t: kpis.revenue_cycle_monthly(t, AS_OF),
    "V16": kpis.claim_denial_monthly,
    "V17": lambda t: kpis.patient_risk_population(t, AS_OF),
    "V18": kpis.model_performance,
}

REPORTS: dict[str, Callable[[Tables], DataFrame]] = {
    "P01": lambda t: reports.enterprise_dashboard(t, AS_OF),
    "P02": lambda t: reports.patient_360(t, AS_OF, patient_id=1),
    "P03": lambda t: reports.hospital_performance(t, hospital_id=1),
    "P03a": lambda t: reports.hospital_performance(t, hospital_id=1, start="1994-02-10", end="1997-09-20"),
    "P04": lambda t: reports.provider_productivity(t, min_encounters=1),
    "P04a": lambda t: reports.provider_productivity(t, hospital_id=2, department_id=11),
    "P05": lambda t: reports.claim_denial_report(t, start="1996-03-15", end="1998-07-10", min_rate=5),
    "P06": lambda t: reports.monthly_revenue_cycle(t, AS_OF, start="1996-03-15"),
    "P07": lambda t: reports.telehealth_operations(t, end="1999-12-31", hospital_id=1),
    "P08": lambda t: reports.high_risk_worklist(t, AS_OF, tier="High"),
    "P09": lambda t: reports.model_performance(t, min_predictions=1),
    "P10": lambda t: reports.patient_encounter_history(t, patient_id=1),
    "P11": lambda t: reports.patient_billing_detail(t, AS_OF, patient_id=1),
    "P12": lambda t: constraints.stack(list(reports.top_executive_exceptions(t, AS_OF).values())),
    "P12a": lambda t: reports.top_executive_exceptions(t, AS_OF)["outstanding"],
    "P12b": lambda t: reports.top_executive_exceptions(t, AS_OF)["denials"],
    "P12c": lambda t: reports.top_executive_exceptions(t, AS_OF)["no_shows"],
}

LIBRARY = {key: (lambda t, plan=plan: plan(t, AS_OF)) for key, plan in library.LIBRARY.items()}


def _published_checks(t: Tables) -> DataFrame:
    """The report of D32, observed on one write of each view."""
    return publish.publish(t, AS_OF, shared_folder(t.spark))[1]


def _refreshed(view: str) -> Callable[[Tables], DataFrame]:
    """A monthly view that was stored without the facts of three months and then refreshed for these."""
    late = ("1995-05-01", "1996-11-01", "1996-12-01")

    def plan(t: Tables) -> DataFrame:
        store = monthly.MonthlyStore(t.spark, view, shared_folder(t.spark), AS_OF)
        dates = {"clinical_encounter": "AdmissionDateTimeUTC", "insurance_claim": "ServiceStartDate"}
        months = [f"{day[:7]}" for day in late]

        def early(name: str) -> Callable[[tuple[str, ...]], DataFrame]:
            def load(columns: tuple[str, ...]) -> DataFrame:
                rows = t.read(name, *(dict.fromkeys((*columns, dates[name])) if columns else ()))
                return rows.where(~F.date_format(dates[name], "yyyy-MM").isin(months)).select(*(columns or rows.columns))

            return load

        store.build(t.replaced({name: early(name) for name in dates}))
        store.refresh(t, late)
        return store.read()

    return plan


QUALITY: dict[str, Callable[[Tables], DataFrame]] = {
    check.id: (lambda t, number=check.number: quality.single(t, AS_OF, number)) for check in quality.CHECKS
} | {
    "D32": lambda t: quality.detail_report(t, AS_OF),
    "D33": lambda t: quality.summary_by_area(t, AS_OF),
    "D34": lambda t: quality.enterprise_score(t, AS_OF),
    "D32_published": _published_checks,
    "D35": integrity.seed_counts,
    "D36": integrity.orphan_providers,
    "D37": integrity.provider_department_mismatch,
    "D38": integrity.orphan_departments,
    "D39": integrity.orphan_plans,
    "D40": integrity.orphan_model_versions,
    "D41": integrity.orphan_model_features,
    "D42": integrity.schema_counts,
    "D43": integrity.enterprise_totals,
}


MONTHLY = {f"{view}_refreshed": _refreshed(view) for view in monthly.VIEWS}


def rule_register(t: Tables, folder: str) -> RuleRegister:
    """The register of the declared rules over one data folder; it lasts as long as the application."""
    return RuleRegister(t, shared_folder(t.spark, f"rules-{zlib.crc32(folder.encode()):08x}"), rules.FAMILIES, AS_OF)


def _family(name: str) -> Query:
    return lambda spark, folder: constraints.with_status(rule_register(derived_tables(spark, str(folder)), str(folder)).run([name]))


def _open_rules(spark: SparkSession, folder: str) -> DataFrame:
    return rule_register(derived_tables(spark, str(folder)), str(folder)).open_rules()


INTEGRITY: dict[str, Query] = {"D44": _open_rules} | {name: _family(name) for name in rules.FAMILIES}

# Grouping of encounter types used by the inline-list example.
TYPE_GROUPS = [("Emergency", "Acute"), ("Inpatient", "Acute"), ("Observation", "Acute"), ("Outpatient", "Planned")]


def _inline_values(t: Tables) -> DataFrame:
    groups = loading.inline_values(t.spark, TYPE_GROUPS, "EncounterType string, TypeGroup string")
    encounters = t.read("clinical_encounter", "EncounterType")
    return encounters.join(groups, "EncounterType").groupBy("TypeGroup").agg(F.count(F.lit(1)).alias("Encounters"))


def _number_series(t: Tables) -> DataFrame:
    """Numbers 1..patients that are no claim number."""
    patients = t.read("clinical_patient", "PatientID").count()
    claims = t.read("insurance_claim", "ClaimID").withColumnRenamed("ClaimID", "n")
    return loading.number_series(t.spark, patients).join(claims, "n", "left_anti")


def _exported(t: Tables) -> tuple[str, dict[str, str]]:
    folder = shared_folder(t.spark)
    return folder, files.export_extracts(t, folder)


def _csv_sink(t: Tables) -> DataFrame:
    folder, outcome = _exported(t)
    listed = t.spark.createDataFrame(sorted(outcome.items()), "dataset string, status string")
    written = [
        frame.agg(F.count(F.lit(1)).alias("rows")).withColumn("dataset", F.lit(name))
        for name, frame in files.read_folder(t.spark, folder).items()
    ]
    return listed.join(constraints.stack(written), "dataset", "left").select("dataset", "status", "rows")


def _csv_source(t: Tables) -> DataFrame:
    folder = shared_folder(t.spark)
    files.write_csv(files.extract(t, "claims"), folder, "claims")
    return files.read_csv(t.spark, folder, "claims").select(
        F.col("ClaimID").cast("bigint"), "ClaimNumber", F.col("PatientID").cast("bigint"), "ClaimType", "ClaimStatus"
    )


def _csv_folder(t: Tables) -> DataFrame:
    folder, _ = _exported(t)
    counted = [
        frame.agg(F.count(F.lit(1)).alias("rows")).select(F.lit(name).alias("dataset"), "rows", F.lit(len(frame.columns)).alias("columns"))
        for name, frame in files.read_folder(t.spark, folder).items()
    ]
    return constraints.stack(counted)


def _idempotent_append(t: Tables) -> DataFrame:
    """All encounters are appended, twice, to a dataset that holds those with a claim.

    ``Run`` is the run that added a row: 0 from the start, 1 for new ones, never 2.
    """
    batch = t.read("clinical_encounter", "EncounterNumber", "EncounterID", "PatientID").withColumn("Run", F.lit(0))
    dataset = SnapshotDataset(t.spark, shared_folder(t.spark), batch.schema)
    held = batch.join(t.read("insurance_claim", "EncounterID"), "EncounterID", "left_semi").select(*batch.columns)
    dataset.commit(0, [dataset.stage(held)])
    for run in (1, 2):
        loading.append_snapshot(batch.withColumn("Run", F.lit(run)), dataset, ["EncounterID"])
    return dataset.read()


def _round_robin(t: Tables) -> DataFrame:
    patients = t.read("clinical_patient", "PatientID", "MedicalRecordNumber")
    return loading.round_robin(patients, "PatientID", t.read("hospital_provider", "ProviderID"), "ProviderID")


def _slots(t: Tables) -> DataFrame:
    return loading.expand_slots(t.read("clinical_encounter", "EncounterID"), F.col("EncounterID") % 3)


METRICS = {"MetricName": ("Charge", "Paid"), "Weight": (1, -1)}


def _cross_values(t: Tables) -> DataFrame:
    return loading.expand_values(t.read("insurance_claim", "ClaimID", "ClaimNumber"), METRICS)


def _first_coverage(t: Tables) -> DataFrame:
    coverage = t.read("insurance_patientcoverage", "PatientID", "CoveragePriority", "PatientCoverageID", "IsActive")
    return loading.first_match(
        t.read("clinical_encounter", "EncounterID", "PatientID"), "PatientID", coverage.where("IsActive"),
        ("CoveragePriority", "PatientCoverageID"), (),
    )


def _first_encounter(t: Tables) -> DataFrame:
    return loading.first_match(
        t.read("clinical_patient", "PatientID", "MedicalRecordNumber"), "PatientID",
        t.read("clinical_encounter", "PatientID", "AdmissionDateTimeUTC", "EncounterID"),
        ("AdmissionDateTimeUTC", "EncounterID"), (), keep=True,
    )


def _earliest_invoice(t: Tables) -> DataFrame:
    return loading.with_group_minimum(
        t.read("billing_payment", "PaymentID", "PatientAccountID", "PatientID"), ["PatientAccountID", "PatientID"],
        t.read("billing_invoice", "InvoiceID", "PatientAccountID", "PatientID"), "InvoiceID", "FirstInvoiceID",
    )


def _first_invoices(t: Tables) -> DataFrame:
    invoices = t.read("billing_invoice", "InvoiceID", "PatientAccountID", "PatientID", "InvoiceDate")
    lines = t.read("billing_invoiceline", "InvoiceID", "LineAmount")
    return loading.top_groups(invoices, lines, "LineAmount", "InvoiceAmount", "InvoiceID", 800)


def _registered_views(t: Tables) -> DataFrame:
    loading.register_views({f"analytics_{key}": plan(t) for key, plan in VIEWS.items()})
    return t.spark.sql(
        "select e.EncounterType, count(*) as Encounters, count(v.VirtualVisitID) as Visits "
        "from analytics_V02 e left join analytics_V04 v on v.EncounterID = e.EncounterID group by e.EncounterType"
    )


def _datasets(t: Tables) -> dict[str, DataFrame]:
    return {dataset: t.read(table) for dataset, (table, _) in files.EXTRACTS.items()}


def _validation_report(t: Tables) -> DataFrame:
    """The report as it is read back from its CSV file."""
    report, folder = profile.validation_report(_datasets(t)), shared_folder(t.spark)
    files.write_csv(report, folder, "validation_report")
    back = files.read_csv(t.spark, folder, "validation_report")
    return back.select(*(F.col(name).cast(kind) for name, kind in report.dtypes)).orderBy("dataset")


LOADING: dict[str, Callable[[Tables], DataFrame]] = {
    "E01": lambda t: t.read("clinical_encounter"),
    "E02": _inline_values,
    "E03": _number_series,
    **{f"E04_{name}": (lambda t, name=name: files.extract(t, name)) for name in files.EXTRACTS},
    "E05": _csv_sink,
    "E06": _csv_source,
    "E07": _csv_folder,
    "E08": _idempotent_append,
    "E09": _round_robin,
    "E10": _slots,
    "E11": _cross_values,
    "E12": _first_coverage,
    "E13": _first_encounter,
    "E14": _earliest_invoice,
    "E15": _first_invoices,
    "E16": _registered_views,
    "E17": lambda t: profile.profile(t.read("clinical_encounter"), "encounters"),
    "E18": _validation_report,
    "E19": lambda t: profile.eda_summary(_datasets(t)),
}


def _predictions(t: Tables) -> DataFrame:
    return t.read("ai_prediction")


def _coerced(t: Tables) -> DataFrame:
    return risk_model.coerce_numeric(risk_model.select_features(_predictions(t)))


def _stored_report(t: Tables) -> DataFrame:
    """The report of M09 on the classes that are stored with predictions and outcomes."""
    stored = views.prediction_performance(t).where("ActualClass is not null and PredictedClass is not null")
    report = risk_model.classification_report(stored, "ActualClass", "PredictedClass")
    rounded = [F.round(name, 6).alias(name) for name in ("Precision", "Recall", "F1Score")]
    return report.select("Class", *rounded, F.col("Support").cast("bigint").alias("Support"))


def _split_sizes(t: Tables) -> DataFrame:
    """Training and test rows of each class, which M07 and M08 work on."""
    split = RISK_MODEL["M06"](t)
    tested = F.sum(F.col("IsTest").cast("int"))
    return split.groupBy(risk_model.TARGET).agg(
        (F.count(F.lit(1)) - tested).alias("TrainingRows"), tested.alias("TestRows")
    )


_FITS: WeakKeyDictionary[Tables, risk_model.Fit] = WeakKeyDictionary()


def _train(t: Tables) -> risk_model.Fit:
    _FITS[t] = risk_model.fit(_predictions(t))
    return _FITS[t]


def _trained(t: Tables) -> risk_model.Fit:
    """The forest of M07 over the same tables; it is grown here if M07 has not run."""
    return _FITS.get(t) or _train(t)


RISK_MODEL: dict[str, Callable[[Tables], DataFrame]] = {
    "M01": lambda t: risk_model.select_features(_predictions(t)),
    "M02": _coerced,
    "M03": lambda t: risk_model.impute_median(_coerced(t)),
    "M04": lambda t: risk_model.prepared(_predictions(t)),
    "M05": lambda t: risk_model.class_distribution(risk_model.drop_untargeted(_predictions(t))),
    "M06": lambda t: risk_model.stratified_split(
        risk_model.drop_untargeted(risk_model.select_features(_predictions(t)))
    ).select(risk_model.KEY, risk_model.TARGET, "IsTest"),
    "M07": lambda t: risk_model.forest_summary(_train(t)),
    "M08": lambda t: risk_model.accuracy_report(risk_model.predict(_trained(t))),
    "M09": lambda t: risk_model.classification_report(risk_model.predict(_trained(t))),
    "M07_split": _split_sizes,
    "M09_stored": _stored_report,
    "M10": lambda t: risk_model.feature_importance(_trained(t)),
}


def _over_tables(plan: Callable[[Tables], DataFrame]) -> Query:
    return lambda spark, folder: plan(derived_tables(spark, str(folder)))


def queries() -> dict[str, Query]:
    plans = {**VIEWS, **REPORTS, **LIBRARY, **QUALITY, **LOADING, **RISK_MODEL, **MONTHLY}
    return {key: _over_tables(plan) for key, plan in plans.items()} | INTEGRITY
