"""The declared integrity rules of the schema, by their catalogue names: all of them, checkable here or not.

CHECK rules (a row breaks one when the predicate is false; unknown passes), foreign keys, unique keys and filtered
unique keys. Rules whose table or columns a set of tables lacks are reported as not checked. Other lists of rules can
be passed to the operators in ``caremesa.operators.constraints``.
"""

from __future__ import annotations

from collections.abc import Sequence

from caremesa.operators.constraints import KeyRule, ReferenceRule, RowRule

Part = tuple[str, str]


def _on(table: str, prefix: str, *parts: Part) -> list[RowRule]:
    """The CHECK rules of a table; each part gives the rest of the name and the predicate."""
    return [RowRule(f"CK_{prefix}_{rest}", table, predicate) for rest, predicate in parts]


def _rule(name: str, predicate: str) -> Part:
    return name, predicate


def _one_of(column: str, *values: str, name: str = "") -> Part:
    listed = ", ".join(f"'{value}'" for value in values)
    return name or column, f"{column} in ({listed})"


def _between(column: str, low: float, high: float, name: str = "") -> Part:
    return name or column, f"{column} between {low} and {high}"


def _at_least(column: str, low: float, name: str = "") -> Part:
    return name or column, f"{column} >= {low}"


def _positive(column: str, name: str = "") -> Part:
    return name or column, f"{column} > 0"


def _none_below_zero(name: str, *columns: str) -> Part:
    return name, " and ".join(f"coalesce({column}, 0) >= 0" for column in columns)


def _not_before(later: str, earlier: str, name: str = "") -> Part:
    return name or later, f"{later} >= {earlier}"


def _together(first: str, second: str, name: str) -> Part:
    return name, f"({first} is null) = ({second} is null)"


def _filled(column: str, name: str = "") -> Part:
    return name or column, f"coalesce(trim({column}), '') <> ''"


def _filled_if(condition: str, column: str, name: str = "") -> Part:
    """Where the condition holds, the text column must not be blank."""
    return name or column, f"not ({condition}) or coalesce(trim({column}), '') <> ''"


def _present_if(condition: str, column: str, name: str = "") -> Part:
    return name or column, f"not ({condition}) or {column} is not null"


def _json(column: str) -> Part:
    """Valid JSON whose top level is an object or an array."""
    return column, f"{column} is null or (try_parse_json({column}) is not null and ltrim({column}) rlike '^[\\\\[{{]')"


def _words(text: str) -> tuple[str, ...]:
    return tuple(text.split(", "))


def _reference(name: str, table: str, columns: str, parent: str, key: str = "") -> ReferenceRule:
    return ReferenceRule(f"FK_{name}", table, _words(columns), parent, _words(key or columns))


def _unique(name: str, table: str, columns: str, when: str | None = None, kind: str = "UQ") -> KeyRule:
    return KeyRule(f"{kind}_{name}", table, _words(columns), when)


# Allowed labels, bounds and consistency conditions of the schema.
ROW_RULES: list[RowRule] = [
    *_on(
        "hospital_hospital", "Hospital",
        _one_of("HospitalType", "General", "Specialty", "Teaching", "Community", "Critical Access", "Childrens",
                "Rehabilitation"),
        _one_of("TraumaLevel", "Level I", "Level II", "Level III", "Level IV", "Level V", "Not Designated"),
        _at_least("NumberOfBeds", 0),
        _rule("OpenedDate", "OpenedDate <= :as_of"),
    ),
    *_on(
        "hospital_location", "Location",
        _one_of("LocationType", "Hospital Campus", "Outpatient Clinic", "Urgent Care", "Diagnostic Center",
                "Administrative Office", "Telehealth Center", "Other"),
        _between("Latitude", -90, 90),
        _between("Longitude", -180, 180),
        _together("Latitude", "Longitude", name="Coordinates"),
    ),
    *_on(
        "hospital_department", "Department",
        _one_of("DepartmentType", "Clinical", "Operational", "Administrative", "Diagnostic", "Support"),
        _together("OpensAt", "ClosesAt", name="OperatingHours"),
    ),
    *_on(
        "hospital_provider", "Provider",
        _one_of("Gender", "M", "F", "O", "U"),
        _one_of("ProviderType", "Physician", "Surgeon", "Specialist", "Nurse", "Nurse Practitioner", "Physician Assistant",
                "Resident", "Fellow", "Therapist", "Technician", "Pharmacist", "Social Worker", "Other"),
        _one_of("EmploymentStatus", "Full-Time", "Part-Time", "Contract", "Locum Tenens", "Resident", "Fellow", "Inactive"),
        _between("YearsExperience", 0, 80),
        _not_before("TerminationDate", "HireDate", name="EmploymentDates"),
        _rule("LicenseExpirationDate", "LicenseExpirationDate >= date'1900-01-01'"),
    ),
    *_on(
        "hospital_providerspecialty", "ProviderSpecialty",
        _not_before("CertificationExpiryDate", "CertificationDate", name="CertificationDates"),
    ),
    *_on(
        "clinical_patient", "Patient",
        _one_of("Gender", "M", "F", "O", "U"),
        _one_of("MaritalStatus", "Single", "Married", "Divorced", "Widowed", "Separated", "Partnered", "Unknown"),
        _one_of("BloodType", "A+", "A-", "B+", "B-", "AB+", "AB-", "O+", "O-"),
        _rule("DateOfBirth", "DateOfBirth <= :as_of"),
        _not_before("DeceasedDate", "DateOfBirth"),
    ),
    *_on(
        "clinical_patientaddress", "PatientAddress",
        _one_of("AddressType", "Home", "Mailing", "Work", "Temporary", "Billing", "Other"),
        _between("Latitude", -90, 90),
        _between("Longitude", -180, 180),
        _together("Latitude", "Longitude", name="Coordinates"),
        _not_before("EffectiveEndDate", "EffectiveStartDate", name="EffectiveDates"),
    ),
    *_on(
        "clinical_encounter", "Encounter",
        _one_of("EncounterType", "Inpatient", "Outpatient", "Emergency", "Observation", "Telehealth", "Surgery",
                "Urgent Care", "Home Health"),
        _one_of("EncounterStatus", "Planned", "Arrived", "In Progress", "Completed", "Cancelled", "No Show", "Discharged"),
        _not_before("DischargeDateTimeUTC", "AdmissionDateTimeUTC", name="DischargeAfterAdmission"),
        _rule("TelehealthConsistency", "(EncounterType = 'Telehealth') = IsTelehealth"),
    ),
    *_on(
        "clinical_diagnosis", "Diagnosis",
        _one_of("DiagnosisType", "Primary", "Secondary", "Admitting", "Discharge", "Historical"),
        _one_of("PresentOnAdmission", "Y", "N", "U", "W"),
    ),
    *_on(
        "clinical_procedure", "Procedure",
        _one_of("ProcedureStatus", "Scheduled", "In Progress", "Completed", "Cancelled", "Aborted"),
        _positive("Quantity"),
    ),
    *_on(
        "clinical_medicationorder", "MedicationOrder",
        _one_of("OrderStatus", "Active", "Completed", "Discontinued", "On Hold", "Cancelled"),
        _not_before("EndDate", "StartDate", name="EndAfterStart"),
        _positive("Quantity"),
        _at_least("Refills", 0),
        _positive("Dose"),
    ),
    *_on(
        "clinical_vitals", "Vitals",
        _between("HeightCM", 20, 300),
        _between("WeightKG", 0.2, 700),
        _between("TemperatureCelsius", 25, 45),
        _between("HeartRateBPM", 0, 300),
        _between("RespiratoryRate", 0, 100),
        _between("SystolicBloodPressure", 40, 300),
        _between("DiastolicBloodPressure", 20, 200),
        _between("OxygenSaturationPercent", 0, 100),
        _between("BloodGlucoseMgDL", 10, 2000),
        _between("PainScore", 0, 10),
        _not_before("SystolicBloodPressure", "DiastolicBloodPressure", name="BloodPressureConsistency"),
    ),
    *_on(
        "telehealth_virtualvisit", "VirtualVisit",
        _one_of("VisitType", "Video", "Audio", "Chat", "Remote Consultation", "Follow-up"),
        _one_of("VisitStatus", "Scheduled", "Waiting", "In Progress", "Completed", "Cancelled", "No Show", "Disconnected"),
        _not_before("ScheduledEndDateTimeUTC", "ScheduledStartDateTimeUTC", name="ScheduledTimes"),
        _not_before("ActualEndDateTimeUTC", "ActualStartDateTimeUTC", name="ActualTimes"),
        _rule("InterpreterLanguage", "(not IsInterpreterRequired and InterpreterLanguage is null) or "
              "(IsInterpreterRequired and coalesce(trim(InterpreterLanguage), '') <> '')"),
    ),
    *_on(
        "telehealth_sessionevent", "SessionEvent",
        _positive("EventSequenceNumber"),
        _one_of("EventType", "Session Created", "Patient Joined", "Provider Joined", "Interpreter Joined",
                "Connection Lost", "Connection Restored", "Session Started", "Session Ended", "Patient Left",
                "Provider Left", "Technical Error"),
        _one_of("ParticipantType", "Patient", "Provider", "Interpreter", "System", "Support"),
        _rule("TechnicalErrorDetails", "EventType <> 'Technical Error' or TechnicalErrorCode is not null "
              "or TechnicalErrorMessage is not null"),
    ),
    *_on(
        "telehealth_device", "Device",
        _one_of("DeviceType", "Blood Pressure Monitor", "Glucose Meter", "Pulse Oximeter", "Weight Scale", "Thermometer",
                "Heart Rate Monitor", "Wearable", "Other"),
        _one_of("DeviceStatus", "Assigned", "Active", "Inactive", "Returned", "Lost", "Damaged", "Maintenance"),
        _not_before("ActivatedDate", "AssignedDate", name="ActivatedAfterAssigned"),
        _not_before("DeactivatedDate", "ActivatedDate", name="DeactivatedAfterActivated"),
    ),
    *_on(
        "telehealth_devicereading", "DeviceReading",
        _one_of("ReadingType", "Systolic Blood Pressure", "Diastolic Blood Pressure", "Blood Pressure", "Blood Glucose",
                "Oxygen Saturation", "Weight", "Temperature", "Heart Rate", "Steps", "Sleep", "Other"),
        _one_of("DataSource", "Bluetooth", "Cellular", "Wi-Fi", "Manual", "API", "File Import"),
        _rule("ValuePresent", "NumericValue is not null or SecondaryNumericValue is not null or coalesce(trim(TextValue), '') <> ''"),
        _at_least("NumericValue", 0),
        _at_least("SecondaryNumericValue", 0),
        _rule("SecondaryUnit", "SecondaryNumericValue is not null or SecondaryUnitOfMeasure is null"),
        _rule("ReceivedNotBeforeReading", "ReceivedDateTimeUTC >= ReadingDateTimeUTC - interval '5' minute"),
    ),
    *_on(
        "telehealth_waitlistqueue", "WaitlistQueue",
        _one_of("QueueStatus", "Waiting", "Called", "Admitted", "Completed", "Cancelled", "No Show", "Removed"),
        _one_of("PriorityLevel", "Low", "Normal", "High", "Urgent"),
        _not_before("QueueCalledDateTimeUTC", "QueueEnteredDateTimeUTC", name="CalledAfterEntered"),
        _not_before("QueueExitedDateTimeUTC", "QueueEnteredDateTimeUTC", name="ExitedAfterEntered"),
        _not_before("QueueExitedDateTimeUTC", "QueueCalledDateTimeUTC", name="ExitedAfterCalled"),
        _rule("ExitReason", "QueueExitedDateTimeUTC is null or "
              "QueueStatus in ('Admitted', 'Completed', 'Cancelled', 'No Show', 'Removed')"),
    ),
    *_on(
        "insurance_payer", "Payer",
        _one_of("PayerType", "Commercial", "Medicare", "Medicaid", "Government", "Employer", "Self-Pay", "Other"),
    ),
    *_on(
        "insurance_insuranceplan", "InsurancePlan",
        _one_of("PlanType", "Medical", "Dental", "Vision", "Pharmacy", "Behavioral Health", "Other"),
        _one_of("NetworkType", "HMO", "PPO", "EPO", "POS", "HDHP", "Medicare Advantage", "Medicaid Managed Care", "Other"),
        _not_before("EffectiveEndDate", "EffectiveStartDate", name="EffectiveDates"),
    ),
    *_on(
        "insurance_patientcoverage", "PatientCoverage",
        _one_of("RelationshipToSubscriber", "Self", "Spouse", "Child", "Parent", "Other", name="Relationship"),
        _one_of("CoveragePriority", "Primary", "Secondary", "Tertiary"),
        _one_of("CoverageStatus", "Active", "Inactive", "Pending", "Terminated", "Expired"),
        _not_before("EffectiveEndDate", "EffectiveStartDate", name="EffectiveDates"),
        _rule("SubscriberRelationship", "(RelationshipToSubscriber = 'Self' and coalesce(SubscriberPatientID = PatientID, true)) or "
              "(RelationshipToSubscriber <> 'Self' and SubscriberPatientID is not null)"),
    ),
    *_on(
        "insurance_priorauthorization", "PriorAuth",
        _one_of("AuthorizationStatus", "Submitted", "Under Review", "Approved", "Partially Approved", "Denied", "Cancelled",
                "Expired"),
        _not_before("DecisionDateTimeUTC", "RequestedDateTimeUTC", name="DecisionAfterRequested"),
        _not_before("ApprovedEndDate", "ApprovedStartDate", name="ApprovedDates"),
        _positive("AuthorizedUnits"),
        _filled_if("AuthorizationStatus = 'Denied'", "DenialReason"),
    ),
    *_on(
        "insurance_claim", "Claim",
        _one_of("ClaimType", "Professional", "Institutional", "Pharmacy", "Dental", "Vision", "Other"),
        _one_of("ClaimStatus", "Draft", "Submitted", "Received", "In Review", "Approved", "Partially Approved", "Denied",
                "Rejected", "Paid", "Voided"),
        _not_before("ServiceEndDate", "ServiceStartDate", name="ServiceDates"),
        _not_before("AdjudicationDateTimeUTC", "SubmissionDateTimeUTC", name="AdjudicationAfterSubmission"),
        _rule("OriginalClaimNotSelf", "OriginalClaimID <> ClaimID"),
    ),
    *_on(
        "insurance_claimline", "ClaimLine",
        _positive("Units"),
        _none_below_zero("MonetaryValues", "ChargeAmount", "AllowedAmount", "PaidAmount", "PatientResponsibilityAmount",
                             "AdjustmentAmount"),
        _one_of("LineStatus", "Submitted", "Approved", "Partially Approved", "Denied", "Paid", "Adjusted", "Voided"),
        _filled_if("LineStatus = 'Denied'", "DenialReasonCode", name="DenialReason"),
    ),
    *_on(
        "insurance_claimstatushistory", "ClaimStatusHistory",
        _positive("StatusSequenceNumber", name="SequenceNumber"),
        _one_of("ClaimStatus", "Draft", "Submitted", "Received", "In Review", "Approved", "Partially Approved", "Denied",
                "Rejected", "Paid", "Voided"),
    ),
    *_on(
        "billing_patientaccount", "PatientAccount",
        _one_of("AccountStatus", "Active", "Inactive", "Collections", "Closed", "Deceased"),
        _one_of("BillingPreference", "Paper", "Electronic", "Both"),
        _one_of("PreferredCommunicationMethod", "Mail", "Email", "SMS", "Portal", "Phone", name="CommunicationMethod"),
        _rule("ActiveStatusConsistency", "IsActive = (AccountStatus = 'Active')"),
    ),
    *_on(
        "billing_invoice", "Invoice",
        _one_of("InvoiceStatus", "Draft", "Issued", "Partially Paid", "Paid", "Overdue", "Cancelled", "Voided",
                "Collections"),
        _one_of("StatementCycle", "Initial", "First Reminder", "Second Reminder", "Final Notice", "Collections"),
        _not_before("DueDate", "InvoiceDate"),
        _rule("OriginalNotSelf", "OriginalInvoiceID <> InvoiceID"),
        _present_if("InvoiceStatus = 'Overdue'", "DueDate", name="OverdueRequiresDueDate"),
    ),
    *_on(
        "billing_invoiceline", "InvoiceLine",
        _positive("Quantity"),
        _one_of("LineType", "Charge", "Copay", "Coinsurance", "Deductible", "Adjustment", "Credit", "Fee", "Other"),
    ),
    *_on(
        "billing_payment", "Payment",
        _positive("PaymentAmount"),
        _one_of("PaymentSource", "Patient", "Insurance", "Employer", "Government", "Charity", "Other"),
        _one_of("PaymentMethod", "Credit Card", "Debit Card", "ACH", "Check", "Cash", "Wire Transfer", "Portal", "Lockbox",
                "Other"),
        _one_of("PaymentStatus", "Pending", "Posted", "Reversed", "Failed", "Refunded"),
        _present_if("PaymentSource = 'Insurance'", "PayerID", name="PayerSourceConsistency"),
        _filled_if("PaymentMethod = 'Check'", "CheckNumber"),
    ),
    *_on(
        "billing_paymentallocation", "PaymentAllocation",
        _positive("AllocatedAmount"),
        _one_of("AllocationStatus", "Pending", "Posted", "Reversed"),
        _filled_if("AllocationStatus = 'Reversed'", "ReversalReason"),
    ),
    *_on(
        "billing_adjustment", "Adjustment",
        _positive("AdjustmentAmount"),
        _one_of("AdjustmentType", "Contractual", "Administrative", "Charity", "Bad Debt", "Courtesy", "Correction",
                "Insurance", "Other"),
        _one_of("AdjustmentStatus", "Pending", "Approved", "Posted", "Reversed", "Denied"),
        _filled("AdjustmentReasonCode", name="ReasonCode"),
    ),
    *_on(
        "billing_refund", "Refund",
        _positive("RefundAmount"),
        _one_of("RefundMethod", "Credit Card", "Debit Card", "ACH", "Check", "Cash", "Wire Transfer", "Other"),
        _one_of("RefundStatus", "Pending", "Approved", "Issued", "Failed", "Cancelled"),
        _filled("Reason"),
    ),
    *_on(
        "billing_accountbalancehistory", "AccountBalanceHistory",
        _none_below_zero("NonNegative", "CurrentBalance", "Balance0To30Days", "Balance31To60Days", "Balance61To90Days",
                             "Balance91To120Days", "BalanceOver120Days", "InsurancePendingAmount", "PatientResponsibilityAmount",
                             "CollectionsAmount"),
    ),
    *_on(
        "marketing_campaign", "Campaign",
        _one_of("CampaignType", "Awareness", "Acquisition", "Retention", "Reactivation", "Education", "Engagement",
                "Referral", "Other"),
        _one_of("CampaignObjective", "Lead Generation", "Appointment Booking", "Brand Awareness", "Patient Education",
                "Retention", "Reactivation", "Survey", "Other"),
        _one_of("CampaignStatus", "Draft", "Scheduled", "Active", "Paused", "Completed", "Cancelled", "Archived"),
        _not_before("EndDate", "StartDate"),
        _at_least("BudgetAmount", 0),
    ),
    *_on(
        "marketing_campaignchannel", "CampaignChannel",
        _one_of("ChannelType", "Email", "SMS", "Phone", "Portal", "Website", "Social Media", "Search", "Display",
                "Direct Mail", "Referral", "Event", "Other"),
        _at_least("PlannedSpendAmount", 0, name="PlannedSpend"),
        _at_least("ActualSpendAmount", 0, name="ActualSpend"),
    ),
    *_on(
        "marketing_audiencesegment", "AudienceSegment",
        _one_of("SegmentType", "Demographic", "Clinical", "Geographic", "Behavioral", "Payer", "Custom", "Other"),
        _one_of("RefreshFrequency", "Manual", "Daily", "Weekly", "Monthly", "Quarterly", "Annually"),
        _at_least("EstimatedMemberCount", 0),
    ),
    *_on(
        "marketing_campaignaudience", "CampaignAudience",
        _one_of("AudienceRole", "Target", "Control", "Exclusion", "Test"),
        _positive("PriorityRank"),
        _at_least("ExpectedReach", 0),
    ),
    *_on(
        "marketing_patientcommunicationpreference", "PatientCommPref",
        _one_of("ChannelType", "Email", "SMS", "Phone", "Portal", "Direct Mail", "Push Notification", "Other"),
        _one_of("ConsentStatus", "Opted In", "Opted Out", "Pending", "Revoked"),
        _one_of("ConsentSource", "Web Portal", "Phone", "In Person", "Paper Form", "SMS", "Email", "Import", "Other"),
        _one_of("PreferredContactTime", "Morning", "Afternoon", "Evening", "Anytime"),
        _present_if("ConsentStatus = 'Opted In'", "ConsentDateTimeUTC", name="OptedInRequiresConsent"),
        _present_if("ConsentStatus = 'Revoked'", "RevokedDateTimeUTC", name="RevokedRequiresDate"),
        _not_before("RevokedDateTimeUTC", "ConsentDateTimeUTC", name="RevokedNotBeforeConsent"),
        _rule("InactiveConsistency", "ConsentStatus not in ('Opted Out', 'Revoked') or not IsActive"),
    ),
    *_on(
        "marketing_campaigninteraction", "CampaignInteraction",
        _one_of("InteractionType", "Sent", "Delivered", "Opened", "Clicked", "Replied", "Called", "Viewed", "Registered",
                "Attended", "Converted", "Unsubscribed", "Bounced", "Failed"),
        _one_of("InteractionStatus", "Pending", "Queued", "Success", "Failed", "Bounced", "Rejected", "Cancelled"),
    ),
    *_on(
        "marketing_referralsource", "ReferralSource",
        _one_of("ReferralSourceType", "Provider", "Hospital", "Health Plan", "Employer", "Patient", "Digital", "Community",
                "Event", "Internal", "Other"),
    ),
    *_on(
        "marketing_patientacquisition", "PatientAcquisition",
        _one_of("AcquisitionChannel", "Email", "SMS", "Phone", "Portal", "Website", "Social Media", "Search", "Display",
                "Direct Mail", "Referral", "Event", "Other"),
        _one_of("AttributionModel", "First Touch", "Last Touch", "Linear", "Time Decay", "Position Based", "Data Driven",
                "Other"),
        _one_of("AcquisitionStatus", "Lead", "Qualified", "Converted", "Lost", "Inactive"),
        _at_least("AcquisitionCost", 0),
        _present_if("CampaignInteractionID is not null", "CampaignID", name="InteractionRequiresCampaign"),
    ),
    *_on(
        "ai_model", "Model",
        _one_of("ModelType", "Machine Learning", "Deep Learning", "Statistical", "Rule Based", "Ensemble", "Generative",
                "Other"),
        _one_of("ProblemType", "Binary Classification", "Multiclass Classification", "Regression", "Clustering",
                "Time Series", "Ranking", "Survival", "Other"),
        _one_of("ModelStatus", "Development", "Validation", "Approved", "Production", "Shadow", "Suspended", "Retired"),
        _one_of("RiskLevel", "Low", "Medium", "High", "Critical"),
        _present_if("OwnerProviderID is not null", "OwningHospitalID", name="OwnerRequiresHospital"),
    ),
    *_on(
        "ai_modelversion", "ModelVersion",
        _one_of("ApprovalStatus", "Pending", "Approved", "Rejected", "Withdrawn"),
        _not_before("TrainingDataEndDate", "TrainingDataStartDate", name="TrainingDateRange"),
        _not_before("EffectiveEndDateTimeUTC", "EffectiveStartDateTimeUTC", name="EffectiveDateRange"),
        _at_least("TrainingRecordCount", 0),
        _at_least("FeatureCount", 0),
        _rule("ApprovalConsistency",
              "(ApprovalStatus = 'Approved' and ApprovedByProviderID is not null and ApprovedDateTimeUTC is not null) or "
              "(ApprovalStatus <> 'Approved' and ApprovedByProviderID is null and ApprovedDateTimeUTC is null)"),
    ),
    *_on(
        "ai_featuredefinition", "FeatureDefinition",
        _one_of("DataType", "Integer", "Decimal", "Boolean", "String", "Text", "DateTime", "Categorical", "Binary",
                "Other"),
        _one_of("FeatureCategory", "Demographic", "Clinical", "Lab", "Vitals", "Medication", "Utilization", "Financial",
                "Behavioral", "Temporal", "Derived", "Other"),
        _filled("SourceSchema"),
        _filled("SourceTable"),
    ),
    *_on(
        "ai_modelfeature", "ModelFeature",
        _one_of("FeatureRole", "Input", "Target", "Identifier", "Protected Attribute", "Monitoring Only"),
        _positive("FeatureOrder"),
    ),
    *_on(
        "ai_prediction", "Prediction",
        _one_of("PredictionType", "Classification", "Regression", "Risk Score", "Probability", "Forecast", "Recommendation",
                "Anomaly", "Other"),
        _one_of("PredictionStatus", "Generated", "Delivered", "Consumed", "Overridden", "Suppressed", "Failed"),
        _between("ProbabilityScore", 0, 1),
        _between("ThresholdUsed", 0, 1),
        _at_least("RiskScore", 0),
    ),
    *_on(
        "ai_predictionoutcome", "PredictionOutcome",
        _one_of("OutcomeType", "Confirmed", "Refuted", "Partial", "Censored", "Unknown", "Other"),
        _one_of("OutcomeSource", "EHR", "Manual Review", "Claims", "Lab", "Registry", "External", "Other"),
        _together("VerifiedByProviderID", "VerifiedDateTimeUTC", name="VerificationConsistency"),
    ),
    *_on(
        "ai_modelperformancemetric", "ModelPerformanceMetric",
        _one_of("MetricName", "AUROC", "AUPRC", "Accuracy", "Precision", "Recall", "Sensitivity", "Specificity", "F1 Score",
                "Log Loss", "Brier Score", "RMSE", "MAE", "MAPE", "R2", "Calibration Slope", "Calibration Intercept",
                "Other"),
        _filled_if("MetricName = 'Other'", "MetricDescription", name="OtherDescription"),
        _one_of("EvaluationDataset", "Training", "Validation", "Test", "Holdout", "Production", "Shadow", "Other"),
        _not_before("EvaluationEndDate", "EvaluationStartDate", name="EvaluationDateRange"),
        _between("ThresholdValue", 0, 1),
        _at_least("SampleSize", 0),
    ),
    *_on(
        "ai_modelmonitoringevent", "ModelMonitoringEvent",
        _one_of("EventType", "Data Drift", "Concept Drift", "Performance Degradation", "Bias Alert", "Missing Data",
                "Latency", "Availability", "Security", "Safety", "Compliance", "Other"),
        _one_of("Severity", "Info", "Low", "Medium", "High", "Critical"),
        _one_of("ResolutionStatus", "Open", "Acknowledged", "Investigating", "Resolved", "Dismissed"),
        _not_before("ExpectedMaximum", "ExpectedMinimum", name="ExpectedRange"),
        _rule("ResolutionConsistency",
              "(ResolutionStatus in ('Resolved', 'Dismissed') and ResolvedByProviderID is not null and ResolvedDateTimeUTC is not null) or "
              "(ResolutionStatus in ('Open', 'Acknowledged', 'Investigating') and ResolvedByProviderID is null and ResolvedDateTimeUTC is null)"),
    ),
]

# Columns that hold JSON.
JSON_RULES: list[RowRule] = [
    *_on("marketing_audiencesegment", "AudienceSegment", _json("DefinitionJSON")),
    *_on("ai_modelversion", "ModelVersion", _json("HyperparametersJSON")),
    *_on("ai_prediction", "Prediction", _json("InputSnapshotJSON")),
    *_on("ai_prediction", "Prediction", _json("ExplanationJSON")),
]

DIGIT_RULES: list[RowRule] = _on("hospital_provider", "Provider", _rule("NPINumber", "length(NPINumber) = 10 and NPINumber rlike '^[0-9]{10}$'"))

# Foreign keys of one column, as name, table, column, parent (and the parent's column).
REFERENCE_RULES: list[ReferenceRule] = [
    _reference("Location_Hospital", "hospital_location", "HospitalID", "hospital_hospital"),
    _reference("Department_Hospital", "hospital_department", "HospitalID", "hospital_hospital"),
    _reference("Provider_Hospital", "hospital_provider", "HospitalID", "hospital_hospital"),
    _reference("ProviderSpecialty_Provider", "hospital_providerspecialty", "ProviderID", "hospital_provider"),
    _reference("ProviderSpecialty_Specialty", "hospital_providerspecialty", "SpecialtyID", "hospital_specialty"),
    _reference("PatientAddress_Patient", "clinical_patientaddress", "PatientID", "clinical_patient"),
    _reference("Encounter_Patient", "clinical_encounter", "PatientID", "clinical_patient"),
    _reference("Encounter_Hospital", "clinical_encounter", "HospitalID", "hospital_hospital"),
    _reference("Diagnosis_Patient", "clinical_diagnosis", "PatientID", "clinical_patient"),
    _reference("Procedure_Patient", "clinical_procedure", "PatientID", "clinical_patient"),
    _reference("Procedure_Provider", "clinical_procedure", "ProviderID", "hospital_provider"),
    _reference("MedicationOrder_Patient", "clinical_medicationorder", "PatientID", "clinical_patient"),
    _reference("MedicationOrder_Provider", "clinical_medicationorder", "ProviderID", "hospital_provider"),
    _reference("MedicationOrder_Medication", "clinical_medicationorder", "MedicationID", "clinical_medication"),
    _reference("Vitals_Patient", "clinical_vitals", "PatientID", "clinical_patient"),
    _reference("Vitals_Provider", "clinical_vitals", "RecordedByProviderID", "hospital_provider", "ProviderID"),
    _reference("SessionEvent_VirtualVisit", "telehealth_sessionevent", "VirtualVisitID", "telehealth_virtualvisit"),
    _reference("Device_Patient", "telehealth_device", "PatientID", "clinical_patient"),
    _reference("InsurancePlan_Payer", "insurance_insuranceplan", "PayerID", "insurance_payer"),
    _reference("PatientCoverage_Patient", "insurance_patientcoverage", "PatientID", "clinical_patient"),
    _reference("PatientCoverage_InsurancePlan", "insurance_patientcoverage", "InsurancePlanID", "insurance_insuranceplan"),
    _reference("PatientCoverage_Subscriber", "insurance_patientcoverage", "SubscriberPatientID", "clinical_patient", "PatientID"),
    _reference("PriorAuth_Patient", "insurance_priorauthorization", "PatientID", "clinical_patient"),
    _reference("PriorAuth_InsurancePlan", "insurance_priorauthorization", "InsurancePlanID", "insurance_insuranceplan"),
    _reference("PriorAuth_Provider", "insurance_priorauthorization", "ProviderID", "hospital_provider"),
    _reference("Claim_Patient", "insurance_claim", "PatientID", "clinical_patient"),
    _reference("Claim_Hospital", "insurance_claim", "HospitalID", "hospital_hospital"),
    _reference("Claim_OriginalClaim", "insurance_claim", "OriginalClaimID", "insurance_claim", "ClaimID"),
    _reference("ClaimLine_Claim", "insurance_claimline", "ClaimID", "insurance_claim"),
    _reference("ClaimStatusHistory_Claim", "insurance_claimstatushistory", "ClaimID", "insurance_claim"),
    _reference("PatientAccount_Patient", "billing_patientaccount", "PatientID", "clinical_patient"),
    _reference("Invoice_OriginalInvoice", "billing_invoice", "OriginalInvoiceID", "billing_invoice", "InvoiceID"),
    _reference("InvoiceLine_Invoice", "billing_invoiceline", "InvoiceID", "billing_invoice"),
    _reference("InvoiceLine_ClaimLine", "billing_invoiceline", "ClaimLineID", "insurance_claimline"),
    _reference("Payment_Payer", "billing_payment", "PayerID", "insurance_payer"),
    _reference("PaymentAllocation_Payment", "billing_paymentallocation", "PaymentID", "billing_payment"),
    _reference("PaymentAllocation_Invoice", "billing_paymentallocation", "InvoiceID", "billing_invoice"),
    _reference("Adjustment_Invoice", "billing_adjustment", "InvoiceID", "billing_invoice"),
    _reference("Adjustment_Claim", "billing_adjustment", "ClaimID", "insurance_claim"),
    _reference("Adjustment_Provider", "billing_adjustment", "ApprovedByProviderID", "hospital_provider", "ProviderID"),
    _reference("Refund_Provider", "billing_refund", "ApprovedByProviderID", "hospital_provider", "ProviderID"),
    _reference("Campaign_Hospital", "marketing_campaign", "HospitalID", "hospital_hospital"),
    _reference("CampaignChannel_Campaign", "marketing_campaignchannel", "CampaignID", "marketing_campaign"),
    _reference("CampaignAudience_Campaign", "marketing_campaignaudience", "CampaignID", "marketing_campaign"),
    _reference("CampaignAudience_AudienceSegment", "marketing_campaignaudience", "AudienceSegmentID", "marketing_audiencesegment"),
    _reference("PatientCommPref_Patient", "marketing_patientcommunicationpreference", "PatientID", "clinical_patient"),
    _reference("CampaignInteraction_Patient", "marketing_campaigninteraction", "PatientID", "clinical_patient"),
    _reference("ReferralSource_Hospital", "marketing_referralsource", "ReferringHospitalID", "hospital_hospital", "HospitalID"),
    _reference("PatientAcquisition_Patient", "marketing_patientacquisition", "PatientID", "clinical_patient"),
    _reference("PatientAcquisition_ReferralSource", "marketing_patientacquisition", "ReferralSourceID", "marketing_referralsource"),
    _reference("PatientAcquisition_Campaign", "marketing_patientacquisition", "CampaignID", "marketing_campaign"),
    _reference("Model_Hospital", "ai_model", "OwningHospitalID", "hospital_hospital", "HospitalID"),
    _reference("ModelVersion_Model", "ai_modelversion", "ModelID", "ai_model"),
    _reference("ModelVersion_ApprovedByProvider", "ai_modelversion", "ApprovedByProviderID", "hospital_provider", "ProviderID"),
    _reference("ModelFeature_ModelVersion", "ai_modelfeature", "ModelVersionID", "ai_modelversion"),
    _reference("ModelFeature_FeatureDefinition", "ai_modelfeature", "FeatureDefinitionID", "ai_featuredefinition"),
    _reference("Prediction_ModelVersion", "ai_prediction", "ModelVersionID", "ai_modelversion"),
    _reference("Prediction_Patient", "ai_prediction", "PatientID", "clinical_patient"),
    _reference("PredictionOutcome_Prediction", "ai_predictionoutcome", "PredictionID", "ai_prediction"),
    _reference("PredictionOutcome_VerifiedByProvider", "ai_predictionoutcome", "VerifiedByProviderID", "hospital_provider", "ProviderID"),
    _reference("ModelPerformanceMetric_ModelVersion", "ai_modelperformancemetric", "ModelVersionID", "ai_modelversion"),
    _reference("ModelMonitoringEvent_ModelVersion", "ai_modelmonitoringevent", "ModelVersionID", "ai_modelversion"),
    _reference("ModelMonitoringEvent_ResolvedByProvider", "ai_modelmonitoringevent", "ResolvedByProviderID", "hospital_provider", "ProviderID"),
]

# Foreign keys of several columns.
COMPOSITE_REFERENCE_RULES: list[ReferenceRule] = [
    _reference("Department_Location_Hospital", "hospital_department", "LocationID, HospitalID", "hospital_location"),
    _reference("Provider_Department_Hospital", "hospital_provider", "DepartmentID, HospitalID", "hospital_department"),
    _reference("Encounter_Location_Hospital", "clinical_encounter", "LocationID, HospitalID", "hospital_location"),
    _reference("Encounter_Department_Hospital", "clinical_encounter", "DepartmentID, HospitalID", "hospital_department"),
    _reference("Encounter_Provider_Hospital", "clinical_encounter", "ProviderID, HospitalID", "hospital_provider"),
    _reference("Diagnosis_Encounter_Patient", "clinical_diagnosis", "EncounterID, PatientID", "clinical_encounter"),
    _reference("Procedure_Encounter_Patient", "clinical_procedure", "EncounterID, PatientID", "clinical_encounter"),
    _reference("MedicationOrder_Encounter_Patient", "clinical_medicationorder", "EncounterID, PatientID", "clinical_encounter"),
    _reference("Vitals_Encounter_Patient", "clinical_vitals", "EncounterID, PatientID", "clinical_encounter"),
    _reference("VirtualVisit_Encounter_Patient", "telehealth_virtualvisit", "EncounterID, PatientID", "clinical_encounter"),
    _reference("VirtualVisit_Provider_Hospital", "telehealth_virtualvisit", "ProviderID, HospitalID", "hospital_provider"),
    _reference("VirtualVisit_Department_Hospital", "telehealth_virtualvisit", "DepartmentID, HospitalID", "hospital_department"),
    _reference("DeviceReading_Device_Patient", "telehealth_devicereading", "DeviceID, PatientID", "telehealth_device"),
    _reference("DeviceReading_Encounter_Patient", "telehealth_devicereading", "EncounterID, PatientID", "clinical_encounter"),
    _reference("WaitlistQueue_Visit_Patient", "telehealth_waitlistqueue", "VirtualVisitID, PatientID", "telehealth_virtualvisit"),
    _reference("WaitlistQueue_Visit_Provider", "telehealth_waitlistqueue", "VirtualVisitID, ProviderID", "telehealth_virtualvisit"),
    _reference("WaitlistQueue_Visit_Department", "telehealth_waitlistqueue", "VirtualVisitID, DepartmentID", "telehealth_virtualvisit"),
    _reference("PriorAuth_Encounter_Patient", "insurance_priorauthorization", "EncounterID, PatientID", "clinical_encounter"),
    _reference("Claim_Coverage_Patient", "insurance_claim", "PatientCoverageID, PatientID", "insurance_patientcoverage"),
    _reference("Claim_Encounter_Patient", "insurance_claim", "EncounterID, PatientID", "clinical_encounter"),
    _reference("Claim_Provider_Hospital", "insurance_claim", "ProviderID, HospitalID", "hospital_provider"),
    _reference("Invoice_Account_Patient", "billing_invoice", "PatientAccountID, PatientID", "billing_patientaccount"),
    _reference("Invoice_Encounter_Patient", "billing_invoice", "EncounterID, PatientID", "clinical_encounter"),
    _reference("Invoice_Claim_Patient", "billing_invoice", "ClaimID, PatientID", "insurance_claim"),
    _reference("InvoiceLine_Invoice_Encounter", "billing_invoiceline", "InvoiceID, EncounterID", "billing_invoice"),
    _reference("Payment_Account_Patient", "billing_payment", "PatientAccountID, PatientID", "billing_patientaccount"),
    _reference("Adjustment_InvoiceLine_Invoice", "billing_adjustment", "InvoiceLineID, InvoiceID", "billing_invoiceline"),
    _reference("Refund_Payment_Account_Patient", "billing_refund", "PaymentID, PatientAccountID, PatientID", "billing_payment"),
    _reference("Refund_Account_Patient", "billing_refund", "PatientAccountID, PatientID", "billing_patientaccount"),
    _reference("AccountBalanceHistory_Account_Patient", "billing_accountbalancehistory", "PatientAccountID, PatientID", "billing_patientaccount"),
    _reference("Campaign_Owner_Hospital", "marketing_campaign", "OwnerProviderID, HospitalID", "hospital_provider", "ProviderID, HospitalID"),
    _reference("CampaignInteraction_Channel_Campaign", "marketing_campaigninteraction", "CampaignChannelID, CampaignID", "marketing_campaignchannel"),
    _reference("CampaignInteraction_Encounter_Patient", "marketing_campaigninteraction", "EncounterID, PatientID", "clinical_encounter"),
    _reference("ReferralSource_Provider_Hospital", "marketing_referralsource", "ReferringProviderID, ReferringHospitalID", "hospital_provider", "ProviderID, HospitalID"),
    _reference("PatientAcquisition_Interaction", "marketing_patientacquisition", "CampaignInteractionID, PatientID, CampaignID", "marketing_campaigninteraction"),
    _reference("PatientAcquisition_FirstEncounter_Patient", "marketing_patientacquisition", "FirstEncounterID, PatientID", "clinical_encounter", "EncounterID, PatientID"),
    _reference("Model_Owner_Hospital", "ai_model", "OwnerProviderID, OwningHospitalID", "hospital_provider", "ProviderID, HospitalID"),
    _reference("Prediction_Encounter_Patient", "ai_prediction", "EncounterID, PatientID", "clinical_encounter"),
]

# Unique keys.
KEY_RULES: list[KeyRule] = [
    _unique("Hospital_HospitalCode", "hospital_hospital", "HospitalCode"),
    _unique("Location_Hospital_LocationCode", "hospital_location", "HospitalID, LocationCode"),
    _unique("Location_LocationID_HospitalID", "hospital_location", "LocationID, HospitalID"),
    _unique("Department_Hospital_DepartmentCode", "hospital_department", "HospitalID, DepartmentCode"),
    _unique("Department_DepartmentID_HospitalID", "hospital_department", "DepartmentID, HospitalID"),
    _unique("Specialty_SpecialtyCode", "hospital_specialty", "SpecialtyCode"),
    _unique("Specialty_SpecialtyName", "hospital_specialty", "SpecialtyName"),
    _unique("Provider_Hospital_ProviderCode", "hospital_provider", "HospitalID, ProviderCode"),
    _unique("ProviderSpecialty_Provider_Specialty", "hospital_providerspecialty", "ProviderID, SpecialtyID"),
    _unique("Patient_MedicalRecordNumber", "clinical_patient", "MedicalRecordNumber"),
    _unique("Encounter_EncounterNumber", "clinical_encounter", "EncounterNumber"),
    _unique("Medication_MedicationCode", "clinical_medication", "MedicationCode"),
    _unique("Provider_ProviderID_HospitalID", "hospital_provider", "ProviderID, HospitalID"),
    _unique("Encounter_EncounterID_PatientID", "clinical_encounter", "EncounterID, PatientID"),
    _unique("VirtualVisit_VisitNumber", "telehealth_virtualvisit", "VisitNumber"),
    _unique("VirtualVisit_EncounterID", "telehealth_virtualvisit", "EncounterID"),
    _unique("VirtualVisit_VisitID_PatientID", "telehealth_virtualvisit", "VirtualVisitID, PatientID"),
    _unique("VirtualVisit_VisitID_ProviderID", "telehealth_virtualvisit", "VirtualVisitID, ProviderID"),
    _unique("VirtualVisit_VisitID_DepartmentID", "telehealth_virtualvisit", "VirtualVisitID, DepartmentID"),
    _unique("SessionEvent_Visit_Sequence", "telehealth_sessionevent", "VirtualVisitID, EventSequenceNumber"),
    _unique("Device_DeviceIdentifier", "telehealth_device", "DeviceIdentifier"),
    _unique("Device_DeviceID_PatientID", "telehealth_device", "DeviceID, PatientID"),
    _unique("WaitlistQueue_Visit_EnteredTime", "telehealth_waitlistqueue", "VirtualVisitID, QueueEnteredDateTimeUTC"),
    _unique("Payer_PayerCode", "insurance_payer", "PayerCode"),
    _unique("InsurancePlan_Payer_PlanCode", "insurance_insuranceplan", "PayerID, PlanCode"),
    _unique("PatientCoverage_Plan_MemberNumber", "insurance_patientcoverage", "InsurancePlanID, MemberNumber"),
    _unique("PatientCoverage_CoverageID_PatientID", "insurance_patientcoverage", "PatientCoverageID, PatientID"),
    _unique("Claim_ClaimNumber", "insurance_claim", "ClaimNumber"),
    _unique("ClaimLine_Claim_LineNumber", "insurance_claimline", "ClaimID, LineNumber"),
    _unique("ClaimStatusHistory_Claim_Sequence", "insurance_claimstatushistory", "ClaimID, StatusSequenceNumber"),
    _unique("Claim_ClaimID_PatientID", "insurance_claim", "ClaimID, PatientID"),
    _unique("PatientAccount_AccountNumber", "billing_patientaccount", "AccountNumber"),
    _unique("PatientAccount_AccountID_PatientID", "billing_patientaccount", "PatientAccountID, PatientID"),
    _unique("Invoice_InvoiceNumber", "billing_invoice", "InvoiceNumber"),
    _unique("Invoice_InvoiceID_EncounterID", "billing_invoice", "InvoiceID, EncounterID"),
    _unique("Invoice_InvoiceID_Account_Patient", "billing_invoice", "InvoiceID, PatientAccountID, PatientID"),
    _unique("InvoiceLine_Invoice_LineNumber", "billing_invoiceline", "InvoiceID, LineNumber"),
    _unique("InvoiceLine_LineID_InvoiceID", "billing_invoiceline", "InvoiceLineID, InvoiceID"),
    _unique("Payment_PaymentNumber", "billing_payment", "PaymentNumber"),
    _unique("Payment_PaymentID_Account_Patient", "billing_payment", "PaymentID, PatientAccountID, PatientID"),
    _unique("PaymentAllocation_Payment_Sequence", "billing_paymentallocation", "PaymentID, AllocationSequenceNumber"),
    _unique("Adjustment_AdjustmentNumber", "billing_adjustment", "AdjustmentNumber"),
    _unique("Refund_RefundNumber", "billing_refund", "RefundNumber"),
    _unique("AccountBalanceHistory_Account_SnapshotDate", "billing_accountbalancehistory", "PatientAccountID, SnapshotDate"),
    _unique("Campaign_CampaignCode", "marketing_campaign", "CampaignCode"),
    _unique("CampaignChannel_ChannelID_CampaignID", "marketing_campaignchannel", "CampaignChannelID, CampaignID"),
    _unique("AudienceSegment_SegmentCode", "marketing_audiencesegment", "SegmentCode"),
    _unique("CampaignAudience_Campaign_Segment_Role", "marketing_campaignaudience", "CampaignID, AudienceSegmentID, AudienceRole"),
    _unique("CampaignInteraction_Interaction_Patient_Campaign", "marketing_campaigninteraction", "CampaignInteractionID, PatientID, CampaignID"),
    _unique("ReferralSource_ReferralSourceCode", "marketing_referralsource", "ReferralSourceCode"),
    _unique("PatientAcquisition_PatientID", "marketing_patientacquisition", "PatientID"),
    _unique("Model_ModelCode", "ai_model", "ModelCode"),
    _unique("ModelVersion_Model_VersionNumber", "ai_modelversion", "ModelID, VersionNumber"),
    _unique("FeatureDefinition_FeatureCode", "ai_featuredefinition", "FeatureCode"),
    _unique("ModelFeature_Version_Feature", "ai_modelfeature", "ModelVersionID, FeatureDefinitionID"),
    _unique("Prediction_CorrelationID", "ai_prediction", "CorrelationID"),
    _unique("PredictionOutcome_PredictionID", "ai_predictionoutcome", "PredictionID"),
]

# Unique indexes, filtered but for one.
CONDITIONAL_KEY_RULES: list[KeyRule] = [
    _unique("Hospital_TaxID", "hospital_hospital", "TaxID", when="TaxID is not null", kind="UX"),
    _unique("Location_OnePrimaryPerHospital", "hospital_location", "HospitalID", when="IsPrimary and IsActive", kind="UX"),
    _unique("Provider_NPINumber", "hospital_provider", "NPINumber", when="NPINumber is not null", kind="UX"),
    _unique(
        "Provider_MedicalLicense", "hospital_provider",
        "MedicalLicenseNumber, LicenseState",
        when="MedicalLicenseNumber is not null and LicenseState is not null", kind="UX",
    ),
    _unique("Provider_DEANumber", "hospital_provider", "DEANumber", when="DEANumber is not null", kind="UX"),
    _unique(
        "ProviderSpecialty_OnePrimary", "hospital_providerspecialty",
        "ProviderID",
        when="IsPrimary and IsActive", kind="UX",
    ),
    _unique(
        "PatientAddress_OnePrimaryPerPatient", "clinical_patientaddress",
        "PatientID",
        when="IsPrimary and IsActive", kind="UX",
    ),
    _unique("Device_SerialNumber", "telehealth_device", "SerialNumber", when="SerialNumber is not null", kind="UX"),
    _unique("Payer_TaxIdentifier", "insurance_payer", "TaxIdentifier", when="TaxIdentifier is not null", kind="UX"),
    _unique(
        "PriorAuth_AuthorizationNumber", "insurance_priorauthorization",
        "AuthorizationNumber",
        when="AuthorizationNumber is not null", kind="UX",
    ),
    _unique("PatientAccount_ActivePatient", "billing_patientaccount", "PatientID", when="IsActive", kind="UX"),
    _unique(
        "Payment_TransactionReference", "billing_payment",
        "TransactionReference",
        when="TransactionReference is not null", kind="UX",
    ),
    _unique(
        "Refund_TransactionReference", "billing_refund",
        "TransactionReference",
        when="TransactionReference is not null", kind="UX",
    ),
    _unique(
        "CampaignChannel_Campaign_Type_Name", "marketing_campaignchannel",
        "CampaignID, ChannelType, ChannelName",
        when="ChannelName is not null", kind="UX",
    ),
    _unique(
        "CampaignChannel_TrackingCode", "marketing_campaignchannel",
        "TrackingCode",
        when="TrackingCode is not null", kind="UX",
    ),
    _unique(
        "PatientCommPref_ActivePatientChannel", "marketing_patientcommunicationpreference",
        "PatientID, ChannelType",
        when="IsActive", kind="UX",
    ),
    _unique(
        "CampaignInteraction_Source_ExternalMessage", "marketing_campaigninteraction",
        "SourceSystem, ExternalMessageID",
        when="ExternalMessageID is not null and SourceSystem is not null", kind="UX",
    ),
    _unique(
        "PatientAcquisition_ExternalLeadID", "marketing_patientacquisition",
        "ExternalLeadID",
        when="ExternalLeadID is not null", kind="UX",
    ),
    _unique("ModelVersion_ModelHash", "ai_modelversion", "ModelHash", when="ModelHash is not null", kind="UX"),
    _unique(
        "ModelPerformanceMetric_Version_Metric_Window", "ai_modelperformancemetric",
        "ModelVersionID, MetricName, EvaluationDataset, EvaluationStartDate, EvaluationEndDate, PatientPopulationSegment", kind="UX",
    ),
]

#: Every rule by the query that checks its family.
FAMILIES: dict[str, Sequence[RowRule | KeyRule | ReferenceRule]] = {
    "D45": ROW_RULES,
    "D46": REFERENCE_RULES,
    "D47": COMPOSITE_REFERENCE_RULES,
    "D48": KEY_RULES,
    "D49": CONDITIONAL_KEY_RULES,
    "D50": JSON_RULES,
    "D51": DIGIT_RULES,
}
