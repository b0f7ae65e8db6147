"""Hand-made tables: only the given columns are filled, the rest are NULL."""

from caremesa.sources.tables import frame_tables

SCHEMAS = {
    "clinical_patient": "PatientID bigint, MedicalRecordNumber string, FirstName string, LastName string, "
    "DateOfBirth date, Gender string, MaritalStatus string, PreferredLanguage string, BloodType string, IsActive boolean",
    "clinical_patientaddress": "PatientID bigint, City string, StateProvince string, PostalCode string, "
    "IsPrimary boolean, IsActive boolean",
    "clinical_encounter": "EncounterID bigint, EncounterNumber string, PatientID bigint, HospitalID int, DepartmentID int, "
    "ProviderID bigint, EncounterType string, EncounterStatus string, AdmissionDateTimeUTC timestamp_ntz, "
    "DischargeDateTimeUTC timestamp_ntz, ReasonForVisit string, Disposition string, IsTelehealth boolean",
    "clinical_diagnosis": "DiagnosisID bigint, EncounterID bigint, PatientID bigint, DiagnosisCode string",
    "clinical_procedure": "ProcedureID bigint, EncounterID bigint",
    "clinical_medicationorder": "MedicationOrderID bigint, EncounterID bigint",
    "hospital_hospital": "HospitalID int, HospitalCode string, HospitalName string, HospitalType string, "
    "NumberOfBeds int, IsTeachingHospital boolean, HasEmergencyDepartment boolean",
    "hospital_department": "DepartmentID int, DepartmentCode string, DepartmentName string",
    "hospital_provider": "ProviderID bigint, ProviderCode string, FirstName string, LastName string, "
    "ProviderType string, HospitalID int, IsActive boolean",
    "telehealth_virtualvisit": "VirtualVisitID bigint, VisitNumber string, EncounterID bigint, PatientID bigint, "
    "ProviderID bigint, HospitalID int, DepartmentID int, VisitType string, VisitStatus string, PlatformName string, "
    "PatientDeviceType string, PatientConnectionMethod string, ScheduledStartDateTimeUTC timestamp_ntz, "
    "ActualStartDateTimeUTC timestamp_ntz, ActualEndDateTimeUTC timestamp_ntz, PatientJoinedDateTimeUTC timestamp_ntz, "
    "ProviderJoinedDateTimeUTC timestamp_ntz, IsInterpreterRequired boolean, InterpreterLanguage string",
    "telehealth_sessionevent": "VirtualVisitID bigint, TechnicalErrorCode string",
    "insurance_payer": "PayerID int, PayerName string",
    "insurance_insuranceplan": "InsurancePlanID int, PayerID int, PlanName string, PlanType string",
    "insurance_patientcoverage": "PatientCoverageID bigint, PatientID bigint, InsurancePlanID int, "
    "CoveragePriority string, IsActive boolean",
    "insurance_claim": "ClaimID bigint, ClaimNumber string, PatientID bigint, PatientCoverageID bigint, "
    "EncounterID bigint, ProviderID bigint, HospitalID int, ClaimType string, ServiceStartDate date, "
    "ServiceEndDate date, SubmissionDateTimeUTC timestamp_ntz, AdjudicationDateTimeUTC timestamp_ntz, ClaimStatus string",
    "insurance_claimline": "ClaimLineID bigint, ClaimID bigint, ChargeAmount decimal(18,2), AllowedAmount decimal(18,2), "
    "PaidAmount decimal(18,2), PatientResponsibilityAmount decimal(18,2), AdjustmentAmount decimal(18,2), "
    "LineStatus string, DenialReasonCode string",
    "billing_patientaccount": "PatientAccountID bigint, AccountNumber string, IsFinancialAssistanceEligible boolean",
    "billing_invoice": "InvoiceID bigint, InvoiceNumber string, PatientAccountID bigint, PatientID bigint, "
    "InvoiceDate date, DueDate date, InvoiceStatus string",
    "billing_invoiceline": "InvoiceID bigint, LineAmount decimal(18,2)",
    "billing_paymentallocation": "InvoiceID bigint, AllocatedAmount decimal(18,2), AllocationStatus string",
    "ai_model": "ModelID int, ModelCode string, ModelName string",
    "ai_modelversion": "ModelVersionID int, ModelID int, VersionNumber string, AlgorithmName string",
    "ai_prediction": "PredictionID bigint, ModelVersionID int, PatientID bigint, EncounterID bigint, "
    "PredictionDateTimeUTC timestamp_ntz, PredictionType string, PredictedClass string, PredictedValue decimal(19,6), "
    "ProbabilityScore decimal(9,8), RiskScore decimal(9,6), ThresholdUsed decimal(9,8), PredictionStatus string",
    "ai_predictionoutcome": "PredictionID bigint, PredictionOutcomeID bigint, OutcomeType string, ActualClass string, "
    "ActualValue decimal(19,6), OutcomeDateTimeUTC timestamp_ntz, IsFinalOutcome boolean",
}

# One organisation, patient, provider and account used by most cases.
BASE = {
    "clinical_patient": [{"PatientID": 1, "MedicalRecordNumber": "M1", "FirstName": "Ann", "LastName": "Lee"}],
    "hospital_hospital": [{"HospitalID": 1, "HospitalName": "H1"}],
    "hospital_department": [{"DepartmentID": 1, "DepartmentName": "D1"}, {"DepartmentID": 2, "DepartmentName": "D2"}],
    "hospital_provider": [{"ProviderID": 1, "FirstName": "Dr", "LastName": "No", "HospitalID": 1}],
    "insurance_payer": [{"PayerID": 1, "PayerName": "P1"}],
    "insurance_insuranceplan": [{"InsurancePlanID": 1, "PayerID": 1, "PlanName": "Plan"}],
    "insurance_patientcoverage": [
        {"PatientCoverageID": 1, "PatientID": 1, "InsurancePlanID": 1, "CoveragePriority": "Primary", "IsActive": True}
    ],
    "billing_patientaccount": [{"PatientAccountID": 1, "AccountNumber": "A1"}],
    "ai_model": [{"ModelID": 1, "ModelName": "Model"}],
    "ai_modelversion": [{"ModelVersionID": 1, "ModelID": 1, "VersionNumber": "1.0"}],
}


def micro_tables(spark, **rows):
    """Every table of SCHEMAS; the given rows replace those of BASE."""
    frames = {}
    for name, ddl in SCHEMAS.items():
        columns = [part.strip().split(" ")[0] for part in ddl.replace("(18,2)", "").replace("(19,6)", "")
                   .replace("(9,8)", "").replace("(9,6)", "").split(",")]
        data = [tuple(row.get(column) for column in columns) for row in rows.get(name, BASE.get(name, []))]
        frames[name] = spark.createDataFrame(data, ddl)
    return frame_tables(spark, frames)
