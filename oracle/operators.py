"""DuckDB text of the quality, integrity, loading, profile and model queries."""

from __future__ import annotations

from caremesa.operators.quality import CHECKS
from oracle import rules
from oracle.views import AS_OF, pct, tally

EMPTY = "coalesce(trim({0}), '') = ''"


def empty(column: str) -> str:
    return EMPTY.format(column)


def rows_where(view: str, condition: str) -> str:
    return f"select count(*) from {view} where {condition}"


def repeated(view: str, key: str) -> str:
    return f"select count(*) from (select {key} from {view} where {key} is not null group by 1 having count(*) > 1)"


YEARS = f"date_diff('year', DateOfBirth, {AS_OF})"
ISSUES: dict[int, str] = {
    1: repeated("v01", "MedicalRecordNumber"),
    2: rows_where("v01", empty("MedicalRecordNumber")),
    3: rows_where("v01", f"{empty('FirstName')} or {empty('LastName')}"),
    4: rows_where("v01", f"DateOfBirth > {AS_OF}"),
    5: rows_where("v01", f"not ({YEARS} between 0 and 120)"),
    6: repeated("v02", "EncounterID"),
    7: rows_where("v02", "PatientID is null"),
    8: rows_where("v02", "ProviderID is null"),
    9: rows_where("v02", "HospitalID is null"),
    10: rows_where("v02", f"AdmissionDateTimeUTC > {AS_OF}"),
    11: rows_where("v02", "DischargeDateTimeUTC < AdmissionDateTimeUTC"),
    12: repeated("v05", "ClaimID"),
    13: rows_where("v05", empty("PayerName")),
    14: rows_where("v05", "TotalChargeAmount < 0"),
    15: rows_where("v05", "TotalPaidAmount > TotalChargeAmount"),
    16: rows_where("v06", f"IsDeniedClaim = 1 and {empty('PrimaryDenialReasonCode')}"),
    17: repeated("v07", "InvoiceID"),
    18: rows_where("v07", "InvoiceAmount < 0"),
    19: rows_where("v07", "OutstandingAmount < 0"),
    20: rows_where("v07", "PaidAmount > InvoiceAmount"),
    21: rows_where("v07", "abs(InvoiceAmount - PaidAmount - OutstandingAmount) > 0.01"),
    22: repeated("v04", "VirtualVisitID"),
    23: rows_where("v04", "TechnicalErrorCount < 0"),
    24: rows_where("v04", empty("PlatformName")),
    25: rows_where("v04", f"ScheduledStartDateTimeUTC > {AS_OF} + interval 1 year"),
    26: repeated("v09", "PredictionID"),
    27: rows_where("v09", empty("ModelName")),
    28: rows_where("v09", "not (ProbabilityScore between 0 and 1)"),
    29: rows_where("v09", "not (RiskScore between 0 and 100)"),
    30: rows_where("v09", empty("PredictedClass")),
    31: rows_where("v09", f"ConfusionMatrixCategory is not null and {empty('ActualClass')}"),
}


def _entry(number: int) -> str:
    check = next(check for check in CHECKS if check.number == number)
    return (
        f"select {number} as CheckID, '{check.area}' as QualityArea, '{check.name}' as CheckName, n as IssueCount, "
        f"if(n = 0, 'PASS', 'WARNING') as QualityStatus, '{check.description}' as CheckDescription from ({ISSUES[number]}) t(n)"
    )


ALL_CHECKS = " union all ".join(_entry(number) for number in ISSUES)


def _score(name: str) -> str:
    passed = tally("QualityStatus = 'PASS'")
    return (
        f"count(*) as TotalChecks, {passed} as PassedChecks, {tally("QualityStatus = 'WARNING'")} as WarningChecks, "
        f"sum(IssueCount)::bigint as TotalIssues, {pct(passed, 'count(*)', 10)} as {name}"
    )


SEEDED = (
    "hospital_hospital hospital_location hospital_department hospital_specialty hospital_provider "
    "hospital_providerspecialty clinical_medication insurance_payer insurance_insuranceplan marketing_referralsource "
    "marketing_audiencesegment ai_model ai_modelversion ai_featuredefinition ai_modelfeature"
).split()
LOADED = {
    "clinical": "patient patientaddress encounter diagnosis procedure medication medicationorder vitals",
    "telehealth": "virtualvisit sessionevent device devicereading waitlistqueue",
    "insurance": "payer insuranceplan patientcoverage claim claimline priorauthorization claimstatushistory",
    "billing": "patientaccount invoice invoiceline payment paymentallocation adjustment refund accountbalancehistory",
    "marketing": "campaign campaignchannel campaigninteraction patientacquisition patientcommunicationpreference "
                 "referralsource audiencesegment campaignaudience",
    "ai": "model modelversion featuredefinition modelfeature prediction predictionoutcome modelperformancemetric modelmonitoringevent",
}
TOTALS = {
    "Patients": "clinical_patient", "Encounters": "clinical_encounter", "TelehealthVisits": "telehealth_virtualvisit",
    "Claims": "insurance_claim", "Invoices": "billing_invoice", "Payments": "billing_payment",
    "Campaigns": "marketing_campaign", "Interactions": "marketing_campaigninteraction",
    "Predictions": "ai_prediction", "Outcomes": "ai_predictionoutcome",
}


def _violations(entries: list[tuple[str, str, str]]) -> str:
    return " union all ".join(
        f"select '{name}' as RuleName, '{table}' as TableName, n as Violations from ({sql}) t(n)"
        for name, table, sql in entries
    )


def _broken(entries) -> str:
    return _violations([(f"CK_{name}", table, f"select count(*) from {table} where {condition}") for name, table, condition in entries])


def _references(single: bool) -> str:
    entries = []
    for name, table, columns, parent, parent_columns in rules.REFERENCES:
        pairs = list(zip(columns.split(", "), parent_columns.split(", ")))
        if (len(pairs) == 1) == single:
            present = " and ".join(f"c.{column} is not null" for column, _ in pairs)
            match = " and ".join(f"p.{b} = c.{a}" for a, b in pairs)
            entries.append((
                f"FK_{name}", table,
                f"select count(*) from {table} c where {present} and not exists (select 1 from {parent} p where {match})",
            ))
    return _violations(entries)


def _keys(kind: str, listed) -> str:
    return _violations([
        (f"{kind}_{name}", table, f"select count(*) from (select 1 from {table} where {condition} group by {columns} having count(*) > 1)")
        for name, table, columns, condition in listed
    ])


RULE_REPORTS = {
    "D45": _broken(rules.CHECKS),
    "D46": _references(single=True),
    "D47": _references(single=False),
    "D48": _keys("UQ", [(*rule, "true") for rule in rules.UNIQUE]),
    "D49": _keys("UX", rules.FILTERED),
    "D50": _broken([
        (name, table, f"{column} is not null and not (json_valid({column}) and ltrim({column})[1] in ('{{', '['))")
        for name, table, column in rules.JSON
    ]),
    "D51": _broken([(
        "Provider_NPINumber", "hospital_provider", "NPINumber is not null and (length(NPINumber) <> 10 or regexp_matches(NPINumber, '[^0-9]'))",
    )]),
}

QUALITY: dict[str, str] = {f"D{number:02d}": _entry(number) for number in ISSUES} | {
    "D32": ALL_CHECKS,
    "D33": f"select QualityArea, {_score('PassRatePercent')} from ({ALL_CHECKS}) group by 1",
    "D34": f"select {_score('EnterpriseDataQualityScorePercent')} from ({ALL_CHECKS})",
    "D35": " union all ".join(f"select '{name}' as TableName, count(*) as RowCount from {name}" for name in SEEDED),
    "D36": "select ProviderID, ProviderCode, HospitalID from hospital_provider where HospitalID not in (select HospitalID from hospital_hospital)",
    "D37": """select ProviderID, ProviderCode, p.HospitalID, d.DepartmentID, d.HospitalID as DepartmentHospitalID
              from hospital_provider p join hospital_department d on d.DepartmentID = p.DepartmentID
              where d.HospitalID <> p.HospitalID""",
    "D38": "select DepartmentID, DepartmentCode, HospitalID from hospital_department where HospitalID not in (select HospitalID from hospital_hospital)",
    "D39": "select InsurancePlanID, PlanCode, PayerID from insurance_insuranceplan where PayerID not in (select PayerID from insurance_payer)",
    "D40": "select ModelVersionID, ModelID, VersionNumber from ai_modelversion where ModelID not in (select ModelID from ai_model)",
    "D41": """select ModelFeatureID, ModelVersionID, FeatureDefinitionID from ai_modelfeature
              where ModelVersionID not in (select ModelVersionID from ai_modelversion)
                 or FeatureDefinitionID not in (select FeatureDefinitionID from ai_featuredefinition)""",
    "D42": " union all ".join(
        f"select '{schema}' as SchemaName, '{name}' as TableName, count(*) as RowCount from {schema}_{name}"
        for schema, names in LOADED.items() for name in names.split()
    ),
    "D43": "select " + ", ".join(f"(select count(*) from {table}) as {name}" for name, table in TOTALS.items()),
    "D44": "select *, 'FAIL' as RuleStatus from (" + " union all ".join(RULE_REPORTS.values()) + ") where Violations > 0",
} | {
    key: f"select *, if(Violations = 0, 'PASS', 'FAIL') as RuleStatus from ({sql})" for key, sql in RULE_REPORTS.items()
}

# Dataset name -> table, key and number of columns.
EXTRACTS = {
    "patients": ("clinical_patient", "PatientID", 11),
    "encounters": ("clinical_encounter", "EncounterID", 14),
    "telehealth_visits": ("telehealth_virtualvisit", "VirtualVisitID", 20),
    "claims": ("insurance_claim", "ClaimID", 14),
    "invoices": ("billing_invoice", "InvoiceID", 11),
    "ai_predictions": ("ai_prediction", "PredictionID", 15),
}


def _profile(dataset: str) -> str:
    table, _, width = EXTRACTS[dataset]
    filled = f"(unpivot (select count(columns('(.*)')) as '\\1' from {table}) on columns(*) into name k value v)"
    return (
        f"select '{dataset}' as dataset, r as \"rows\", {width} as \"columns\", "
        f"r - (select count(*) from (select distinct * from {table})) as duplicate_rows, "
        f"(select sum(r - v) from {filled})::bigint as missing_values, "
        f"coalesce((select string_agg(k, ', ') from {filled} where v = 0), 'None') as empty_columns "
        f"from (select count(*) as r from {table})"
    )


PROFILES = " union all ".join(f"select * from ({_profile(dataset)})" for dataset in EXTRACTS)


def _extract_counts(select: str) -> str:
    return " union all ".join(
        f"select {select.format(dataset=dataset, width=width)} from {table}" for dataset, (table, _, width) in EXTRACTS.items()
    )


LOADING: dict[str, str] = {
    "E01": "select * from clinical_encounter",
    "E02": """select case when EncounterType = 'Outpatient' then 'Planned' else 'Acute' end as TypeGroup, count(*) as Encounters
              from clinical_encounter where EncounterType <> 'Telehealth' group by 1""",
    "E03": """select n from range(1, (select count(*) from clinical_patient) + 1) t(n)
              where not exists (select 1 from insurance_claim where ClaimID = n)""",
    **{
        f"E04_{dataset}": f"select * from {table}"
        for dataset, (table, _, _) in EXTRACTS.items()
    },
    "E05": _extract_counts("'{dataset}' as dataset, 'SAVED' as status, count(*) as \"rows\""),
    "E06": "select ClaimID, ClaimNumber, PatientID, ClaimType, ClaimStatus from insurance_claim",
    "E07": _extract_counts("'{dataset}' as dataset, count(*) as \"rows\", {width} as \"columns\""),
    "E08": """select EncounterNumber, EncounterID, PatientID,
                     if(exists (select 1 from insurance_claim c where c.EncounterID = e.EncounterID), 0, 1) as Run
              from clinical_encounter e""",
    "E09": """with p as (select ProviderID, row_number() over (order by ProviderID) - 1 as rn, count(*) over () as cnt from hospital_provider),
                   n as (select PatientID, MedicalRecordNumber, row_number() over (order by PatientID) as n from clinical_patient)
              select PatientID, MedicalRecordNumber, ProviderID from n join p on rn = (n - 1) % cnt""",
    "E10": "select EncounterID, slot::integer as slot from clinical_encounter join range(3) s(slot) on slot <= EncounterID % 3",
    "E11": """select ClaimID, ClaimNumber, MetricName, Weight
              from insurance_claim, (values ('Charge', 1), ('Paid', -1)) m(MetricName, Weight)""",
    "E12": """select EncounterID, PatientID, CoveragePriority, PatientCoverageID
              from clinical_encounter e, lateral (select CoveragePriority, PatientCoverageID from insurance_patientcoverage c
                   where c.PatientID = e.PatientID and c.IsActive order by CoveragePriority, PatientCoverageID limit 1)""",
    "E13": """select p.PatientID, MedicalRecordNumber, AdmissionDateTimeUTC, EncounterID
              from clinical_patient p left join clinical_encounter e on e.PatientID = p.PatientID
              qualify row_number() over (partition by p.PatientID order by AdmissionDateTimeUTC nulls first, EncounterID) = 1""",
    "E14": """select PaymentID, p.PatientAccountID, p.PatientID, i.InvoiceID as FirstInvoiceID
              from billing_payment p join billing_invoice i on i.PatientAccountID = p.PatientAccountID and i.PatientID = p.PatientID
              where not exists (select 1 from billing_invoice j where j.PatientAccountID = p.PatientAccountID
                                and j.PatientID = p.PatientID and j.InvoiceID < i.InvoiceID)""",
    "E15": """select InvoiceID, PatientAccountID, PatientID, InvoiceDate, sum(LineAmount)::decimal(28,2) as InvoiceAmount,
                     row_number() over (order by InvoiceID) as rn
              from billing_invoice join billing_invoiceline using (InvoiceID) group by 1, 2, 3, 4 qualify rn <= 800""",
    "E16": """select EncounterType, count(*) as Encounters, count(VirtualVisitID) as Visits
              from v02 e left join v04 v on v.EncounterID = e.EncounterID group by 1""",
    "E17": _profile("encounters"),
    "E18": PROFILES,
    "E19": f'select dataset, "rows", "columns", missing_values, duplicate_rows from ({PROFILES})',
}

NUMBERS = ", ".join(
    f"{name}::double as {name}" for name in ("PredictedValue", "ProbabilityScore", "RiskScore", "ThresholdUsed")
)
FILLED = ", ".join(
    f"coalesce({name}::double, (select median({name}::double) from ai_prediction)) as {name}"
    for name in ("PredictedValue", "ProbabilityScore", "RiskScore", "ThresholdUsed")
)
RISK_MODEL: dict[str, str] = {
    "M01": "select PredictionID, PredictedClass, PredictedValue, ProbabilityScore, RiskScore, ThresholdUsed from ai_prediction",
    "M02": f"select PredictionID, PredictedClass, {NUMBERS} from ai_prediction",
    "M03": f"select PredictionID, PredictedClass, {FILLED} from ai_prediction",
    "M04": f"select PredictionID, PredictedClass, {FILLED} from ai_prediction where PredictedClass is not null",
    "M05": "select PredictedClass, count(*) as RowCount from ai_prediction where PredictedClass is not null group by 1",
    "M06": """select PredictionID, PredictedClass,
                     row_number() over (partition by PredictedClass order by md5(PredictionID::varchar || '-42'), PredictionID)
                       <= floor(count(*) over (partition by PredictedClass) * 0.2 + 0.5) as IsTest
              from ai_prediction where PredictedClass is not null""",
    "M07_split": """with split as (select PredictedClass,
                        row_number() over (partition by PredictedClass order by md5(PredictionID::varchar || '-42'), PredictionID)
                          <= floor(count(*) over (partition by PredictedClass) * 0.2 + 0.5) as IsTest
                      from ai_prediction where PredictedClass is not null)
              select PredictedClass, count(*) filter (not IsTest) as TrainingRows, count(*) filter (IsTest) as TestRows
              from split group by 1""",
    "M09_stored": """with pairs as (select ActualClass as a, PredictedClass as p from v09
                        where ActualClass is not null and PredictedClass is not null),
                   classes as (select a as k from pairs union select p from pairs),
                   counts as (select k, count(*) filter (a = k) as Support, count(*) filter (p = k) as said,
                        count(*) filter (a = k and p = k) as hits from classes, pairs group by k),
                   ratios as (select *, if(said > 0, hits / said, 0) as pr, if(Support > 0, hits / Support, 0) as re from counts),
                   scored as (select *, if(pr + re > 0, 2 * pr * re / (pr + re), 0) as f1 from ratios),
                   reported as (
                     select k as Class, pr, re, f1, Support from scored
                     union all
                     select 'accuracy', sum(hits) / sum(Support), sum(hits) / sum(Support), sum(hits) / sum(Support), sum(Support) from scored
                     union all
                     select 'macro avg', avg(pr), avg(re), avg(f1), sum(Support) from scored
                     union all
                     select 'weighted avg', sum(pr * Support) / sum(Support), sum(re * Support) / sum(Support),
                       sum(f1 * Support) / sum(Support), sum(Support) from scored)
              select Class, round(pr, 6) as Precision, round(re, 6) as Recall, round(f1, 6) as F1Score, Support::bigint as Support
              from reported""",
}
