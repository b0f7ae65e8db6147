"""DuckDB text of the declared rules, written from the schema's catalogue and not from the engine's lists.

Each CHECK states when a row breaks it.
"""

from __future__ import annotations

from oracle.views import AS_OF

# Name, table, and the condition under which a row breaks the rule.
CHECKS = [
    ("Hospital_HospitalType", "hospital_hospital",
     "HospitalType not in ('General', 'Specialty', 'Teaching', 'Community', 'Critical Access', 'Childrens', 'Rehabilitation')"),
    ("Hospital_TraumaLevel", "hospital_hospital",
     "TraumaLevel not in ('Level I', 'Level II', 'Level III', 'Level IV', 'Level V', 'Not Designated')"),
    ("Hospital_NumberOfBeds", "hospital_hospital",
     "NumberOfBeds < 0"),
    ("Hospital_OpenedDate", "hospital_hospital",
     f"OpenedDate > {AS_OF}"),
    ("Location_LocationType", "hospital_location",
     "LocationType not in ('Hospital Campus', 'Outpatient Clinic', 'Urgent Care', 'Diagnostic Center', 'Administrative Office', 'Telehealth Center', 'Other')"),
    ("Location_Latitude", "hospital_location",
     "Latitude < -90 or Latitude > 90"),
    ("Location_Longitude", "hospital_location",
     "Longitude < -180 or Longitude > 180"),
    ("Location_Coordinates", "hospital_location",
     "(Latitude is null) <> (Longitude is null)"),
    ("Department_DepartmentType", "hospital_department",
     "DepartmentType not in ('Clinical', 'Operational', 'Administrative', 'Diagnostic', 'Support')"),
    ("Department_OperatingHours", "hospital_department",
     "(OpensAt is null) <> (ClosesAt is null)"),
    ("Provider_Gender", "hospital_provider",
     "Gender not in ('M', 'F', 'O', 'U')"),
    ("Provider_ProviderType", "hospital_provider",
     "ProviderType not in ('Physician', 'Surgeon', 'Specialist', 'Nurse', 'Nurse Practitioner', 'Physician Assistant', 'Resident', 'Fellow', 'Therapist', 'Technician', 'Pharmacist', 'Social Worker', 'Other')"),
    ("Provider_EmploymentStatus", "hospital_provider",
     "EmploymentStatus not in ('Full-Time', 'Part-Time', 'Contract', 'Locum Tenens', 'Resident', 'Fellow', 'Inactive')"),
    ("Provider_YearsExperience", "hospital_provider",
     "YearsExperience < 0 or YearsExperience > 80"),
    ("Provider_EmploymentDates", "hospital_provider",
     "TerminationDate < HireDate"),
    ("Provider_LicenseExpirationDate", "hospital_provider",
     "LicenseExpirationDate < date '1900-01-01'"),
    ("ProviderSpecialty_CertificationDates", "hospital_providerspecialty",
     "CertificationExpiryDate < CertificationDate"),
    ("Patient_Gender", "clinical_patient",
     "Gender not in ('M', 'F', 'O', 'U')"),
    ("Patient_MaritalStatus", "clinical_patient",
     "MaritalStatus not in ('Single', 'Married', 'Divorced', 'Widowed', 'Separated', 'Partnered', 'Unknown')"),
    ("Patient_BloodType", "clinical_patient",
     "BloodType not in ('A+', 'A-', 'B+', 'B-', 'AB+', 'AB-', 'O+', 'O-')"),
    ("Patient_DateOfBirth", "clinical_patient",
     f"DateOfBirth > {AS_OF}"),
    ("Patient_DeceasedDate", "clinical_patient",
     "DeceasedDate < DateOfBirth"),
    ("PatientAddress_AddressType", "clinical_patientaddress",
     "AddressType not in ('Home', 'Mailing', 'Work', 'Temporary', 'Billing', 'Other')"),
    ("PatientAddress_Latitude", "clinical_patientaddress",
     "Latitude < -90 or Latitude > 90"),
    ("PatientAddress_Longitude", "clinical_patientaddress",
     "Longitude < -180 or Longitude > 180"),
    ("PatientAddress_Coordinates", "clinical_patientaddress",
     "(Latitude is null) <> (Longitude is null)"),
    ("PatientAddress_EffectiveDates", "clinical_patientaddress",
     "EffectiveEndDate < EffectiveStartDate"),
    ("Encounter_EncounterType", "clinical_encounter",
     "EncounterType not in ('Inpatient', 'Outpatient', 'Emergency', 'Observation', 'Telehealth', 'Surgery', 'Urgent Care', 'Home Health')"),
    ("Encounter_EncounterStatus", "clinical_encounter",
     "EncounterStatus not in ('Planned', 'Arrived', 'In Progress', 'Completed', 'Cancelled', 'No Show', 'Discharged')"),
    ("Encounter_DischargeAfterAdmission", "clinical_encounter",
     "DischargeDateTimeUTC < AdmissionDateTimeUTC"),
    ("Encounter_TelehealthConsistency", "clinical_encounter",
     "(EncounterType = 'Telehealth') <> IsTelehealth"),
    ("Diagnosis_DiagnosisType", "clinical_diagnosis",
     "DiagnosisType not in ('Primary', 'Secondary', 'Admitting', 'Discharge', 'Historical')"),
    ("Diagnosis_PresentOnAdmission", "clinical_diagnosis",
     "PresentOnAdmission not in ('Y', 'N', 'U', 'W')"),
    ("Procedure_ProcedureStatus", "clinical_procedure",
     "ProcedureStatus not in ('Scheduled', 'In Progress', 'Completed', 'Cancelled', 'Aborted')"),
    ("Procedure_Quantity", "clinical_procedure",
     "Quantity <= 0"),
    ("MedicationOrder_OrderStatus", "clinical_medicationorder",
     "OrderStatus not in ('Active', 'Completed', 'Discontinued', 'On Hold', 'Cancelled')"),
    ("MedicationOrder_EndAfterStart", "clinical_medicationorder",
     "EndDate < StartDate"),
    ("MedicationOrder_Quantity", "clinical_medicationorder",
     "Quantity <= 0"),
    ("MedicationOrder_Refills", "clinical_medicationorder",
     "Refills < 0"),
    ("MedicationOrder_Dose", "clinical_medicationorder",
     "Dose <= 0"),
    ("Vitals_HeightCM", "clinical_vitals",
     "HeightCM < 20 or HeightCM > 300"),
    ("Vitals_WeightKG", "clinical_vitals",
     "WeightKG < 0.2 or WeightKG > 700"),
    ("Vitals_TemperatureCelsius", "clinical_vitals",
     "TemperatureCelsius < 25 or TemperatureCelsius > 45"),
    ("Vitals_HeartRateBPM", "clinical_vitals",
     "HeartRateBPM < 0 or HeartRateBPM > 300"),
    ("Vitals_RespiratoryRate", "clinical_vitals",
     "RespiratoryRate < 0 or RespiratoryRate > 100"),
    ("Vitals_SystolicBloodPressure", "clinical_vitals",
     "SystolicBloodPressure < 40 or SystolicBloodPressure > 300"),
    ("Vitals_DiastolicBloodPressure", "clinical_vitals",
     "DiastolicBloodPressure < 20 or DiastolicBloodPressure > 200"),
    ("Vitals_OxygenSaturationPercent", "clinical_vitals",
     "OxygenSaturationPercent < 0 or OxygenSaturationPercent > 100"),
    ("Vitals_BloodGlucoseMgDL", "clinical_vitals",
     "BloodGlucoseMgDL < 10 or BloodGlucoseMgDL > 2000"),
    ("Vitals_PainScore", "clinical_vitals",
     "PainScore < 0 or PainScore > 10"),
    ("Vitals_BloodPressureConsistency", "clinical_vitals",
     "SystolicBloodPressure < DiastolicBloodPressure"),
    ("VirtualVisit_VisitType", "telehealth_virtualvisit",
     "VisitType not in ('Video', 'Audio', 'Chat', 'Remote Consultation', 'Follow-up')"),
    ("VirtualVisit_VisitStatus", "telehealth_virtualvisit",
     "VisitStatus not in ('Scheduled', 'Waiting', 'In Progress', 'Completed', 'Cancelled', 'No Show', 'Disconnected')"),
    ("VirtualVisit_ScheduledTimes", "telehealth_virtualvisit",
     "ScheduledEndDateTimeUTC < ScheduledStartDateTimeUTC"),
    ("VirtualVisit_ActualTimes", "telehealth_virtualvisit",
     "ActualEndDateTimeUTC < ActualStartDateTimeUTC"),
    ("VirtualVisit_InterpreterLanguage", "telehealth_virtualvisit",
     "(not IsInterpreterRequired and InterpreterLanguage is not null) or (IsInterpreterRequired and coalesce(trim(InterpreterLanguage), '') = '') "
     "or (IsInterpreterRequired is null and trim(InterpreterLanguage) = '')"),
    ("SessionEvent_EventSequenceNumber", "telehealth_sessionevent",
     "EventSequenceNumber <= 0"),
    ("SessionEvent_EventType", "telehealth_sessionevent",
     "EventType not in ('Session Created', 'Patient Joined', 'Provider Joined', 'Interpreter Joined', 'Connection Lost', 'Connection Restored', 'Session Started', 'Session Ended', 'Patient Left', 'Provider Left', 'Technical Error')"),
    ("SessionEvent_ParticipantType", "telehealth_sessionevent",
     "ParticipantType not in ('Patient', 'Provider', 'Interpreter', 'System', 'Support')"),
    ("SessionEvent_TechnicalErrorDetails", "telehealth_sessionevent",
     "EventType = 'Technical Error' and TechnicalErrorCode is null and TechnicalErrorMessage is null"),
    ("Device_DeviceType", "telehealth_device",
     "DeviceType not in ('Blood Pressure Monitor', 'Glucose Meter', 'Pulse Oximeter', 'Weight Scale', 'Thermometer', 'Heart Rate Monitor', 'Wearable', 'Other')"),
    ("Device_DeviceStatus", "telehealth_device",
     "DeviceStatus not in ('Assigned', 'Active', 'Inactive', 'Returned', 'Lost', 'Damaged', 'Maintenance')"),
    ("Device_ActivatedAfterAssigned", "telehealth_device",
     "ActivatedDate < AssignedDate"),
    ("Device_DeactivatedAfterActivated", "telehealth_device",
     "DeactivatedDate < ActivatedDate"),
    ("DeviceReading_ReadingType", "telehealth_devicereading",
     "ReadingType not in ('Systolic Blood Pressure', 'Diastolic Blood Pressure', 'Blood Pressure', 'Blood Glucose', 'Oxygen Saturation', 'Weight', 'Temperature', 'Heart Rate', 'Steps', 'Sleep', 'Other')"),
    ("DeviceReading_DataSource", "telehealth_devicereading",
     "DataSource not in ('Bluetooth', 'Cellular', 'Wi-Fi', 'Manual', 'API', 'File Import')"),
    ("DeviceReading_ValuePresent", "telehealth_devicereading",
     "NumericValue is null and SecondaryNumericValue is null and coalesce(trim(TextValue), '') = ''"),
    ("DeviceReading_NumericValue", "telehealth_devicereading",
     "NumericValue < 0"),
    ("DeviceReading_SecondaryNumericValue", "telehealth_devicereading",
     "SecondaryNumericValue < 0"),
    ("DeviceReading_SecondaryUnit", "telehealth_devicereading",
     "SecondaryNumericValue is null and SecondaryUnitOfMeasure is not null"),
    ("DeviceReading_ReceivedNotBeforeReading", "telehealth_devicereading",
     "ReceivedDateTimeUTC < ReadingDateTimeUTC - interval 5 minute"),
    ("WaitlistQueue_QueueStatus", "telehealth_waitlistqueue",
     "QueueStatus not in ('Waiting', 'Called', 'Admitted', 'Completed', 'Cancelled', 'No Show', 'Removed')"),
    ("WaitlistQueue_PriorityLevel", "telehealth_waitlistqueue",
     "PriorityLevel not in ('Low', 'Normal', 'High', 'Urgent')"),
    ("WaitlistQueue_CalledAfterEntered", "telehealth_waitlistqueue",
     "QueueCalledDateTimeUTC < QueueEnteredDateTimeUTC"),
    ("WaitlistQueue_ExitedAfterEntered", "telehealth_waitlistqueue",
     "QueueExitedDateTimeUTC < QueueEnteredDateTimeUTC"),
    ("WaitlistQueue_ExitedAfterCalled", "telehealth_waitlistqueue",
     "QueueExitedDateTimeUTC < QueueCalledDateTimeUTC"),
    ("WaitlistQueue_ExitReason", "telehealth_waitlistqueue",
     "QueueExitedDateTimeUTC is not null and QueueStatus not in ('Admitted', 'Completed', 'Cancelled', 'No Show', 'Removed')"),
    ("Payer_PayerType", "insurance_payer",
     "PayerType not in ('Commercial', 'Medicare', 'Medicaid', 'Government', 'Employer', 'Self-Pay', 'Other')"),
    ("InsurancePlan_PlanType", "insurance_insuranceplan",
     "PlanType not in ('Medical', 'Dental', 'Vision', 'Pharmacy', 'Behavioral Health', 'Other')"),
    ("InsurancePlan_NetworkType", "insurance_insuranceplan",
     "NetworkType not in ('HMO', 'PPO', 'EPO', 'POS', 'HDHP', 'Medicare Advantage', 'Medicaid Managed Care', 'Other')"),
    ("InsurancePlan_EffectiveDates", "insurance_insuranceplan",
     "EffectiveEndDate < EffectiveStartDate"),
    ("PatientCoverage_Relationship", "insurance_patientcoverage",
     "RelationshipToSubscriber not in ('Self', 'Spouse', 'Child', 'Parent', 'Other')"),
    ("PatientCoverage_CoveragePriority", "insurance_patientcoverage",
     "CoveragePriority not in ('Primary', 'Secondary', 'Tertiary')"),
    ("PatientCoverage_CoverageStatus", "insurance_patientcoverage",
     "CoverageStatus not in ('Active', 'Inactive', 'Pending', 'Terminated', 'Expired')"),
    ("PatientCoverage_EffectiveDates", "insurance_patientcoverage",
     "EffectiveEndDate < EffectiveStartDate"),
    ("PatientCoverage_SubscriberRelationship", "insurance_patientcoverage",
     "(RelationshipToSubscriber = 'Self' and SubscriberPatientID <> PatientID) or (RelationshipToSubscriber <> 'Self' and SubscriberPatientID is null)"),
    ("PriorAuth_AuthorizationStatus", "insurance_priorauthorization",
     "AuthorizationStatus not in ('Submitted', 'Under Review', 'Approved', 'Partially Approved', 'Denied', 'Cancelled', 'Expired')"),
    ("PriorAuth_DecisionAfterRequested", "insurance_priorauthorization",
     "DecisionDateTimeUTC < RequestedDateTimeUTC"),
    ("PriorAuth_ApprovedDates", "insurance_priorauthorization",
     "ApprovedEndDate < ApprovedStartDate"),
    ("PriorAuth_AuthorizedUnits", "insurance_priorauthorization",
     "AuthorizedUnits <= 0"),
    ("PriorAuth_DenialReason", "insurance_priorauthorization",
     "AuthorizationStatus = 'Denied' and coalesce(trim(DenialReason), '') = ''"),
    ("Claim_ClaimType", "insurance_claim",
     "ClaimType not in ('Professional', 'Institutional', 'Pharmacy', 'Dental', 'Vision', 'Other')"),
    ("Claim_ClaimStatus", "insurance_claim",
     "ClaimStatus not in ('Draft', 'Submitted', 'Received', 'In Review', 'Approved', 'Partially Approved', 'Denied', 'Rejected', 'Paid', 'Voided')"),
    ("Claim_ServiceDates", "insurance_claim",
     "ServiceEndDate < ServiceStartDate"),
    ("Claim_AdjudicationAfterSubmission", "insurance_claim",
     "AdjudicationDateTimeUTC < SubmissionDateTimeUTC"),
    ("Claim_OriginalClaimNotSelf", "insurance_claim",
     "OriginalClaimID = ClaimID"),
    ("ClaimLine_Units", "insurance_claimline",
     "Units <= 0"),
    ("ClaimLine_MonetaryValues", "insurance_claimline",
     "least(ChargeAmount, AllowedAmount, PaidAmount, PatientResponsibilityAmount, AdjustmentAmount) < 0"),
    ("ClaimLine_LineStatus", "insurance_claimline",
     "LineStatus not in ('Submitted', 'Approved', 'Partially Approved', 'Denied', 'Paid', 'Adjusted', 'Voided')"),
    ("ClaimLine_DenialReason", "insurance_claimline",
     "LineStatus = 'Denied' and coalesce(trim(DenialReasonCode), '') = ''"),
    ("ClaimStatusHistory_SequenceNumber", "insurance_claimstatushistory",
     "StatusSequenceNumber <= 0"),
    ("ClaimStatusHistory_ClaimStatus", "insurance_claimstatushistory",
     "ClaimStatus not in ('Draft', 'Submitted', 'Received', 'In Review', 'Approved', 'Partially Approved', 'Denied', 'Rejected', 'Paid', 'Voided')"),
    ("PatientAccount_AccountStatus", "billing_patientaccount",
     "AccountStatus not in ('Active', 'Inactive', 'Collections', 'Closed', 'Deceased')"),
    ("PatientAccount_BillingPreference", "billing_patientaccount",
     "BillingPreference not in ('Paper', 'Electronic', 'Both')"),
    ("PatientAccount_CommunicationMethod", "billing_patientaccount",
     "PreferredCommunicationMethod not in ('Mail', 'Email', 'SMS', 'Portal', 'Phone')"),
    ("PatientAccount_ActiveStatusConsistency", "billing_patientaccount",
     "IsActive <> (AccountStatus = 'Active')"),
    ("Invoice_InvoiceStatus", "billing_invoice",
     "InvoiceStatus not in ('Draft', 'Issued', 'Partially Paid', 'Paid', 'Overdue', 'Cancelled', 'Voided', 'Collections')"),
    ("Invoice_StatementCycle", "billing_invoice",
     "StatementCycle not in ('Initial', 'First Reminder', 'Second Reminder', 'Final Notice', 'Collections')"),
    ("Invoice_DueDate", "billing_invoice",
     "DueDate < InvoiceDate"),
    ("Invoice_OriginalNotSelf", "billing_invoice",
     "OriginalInvoiceID = InvoiceID"),
    ("Invoice_OverdueRequiresDueDate", "billing_invoice",
     "InvoiceStatus = 'Overdue' and DueDate is null"),
    ("InvoiceLine_Quantity", "billing_invoiceline",
     "Quantity <= 0"),
    ("InvoiceLine_LineType", "billing_invoiceline",
     "LineType not in ('Charge', 'Copay', 'Coinsurance', 'Deductible', 'Adjustment', 'Credit', 'Fee', 'Other')"),
    ("Payment_PaymentAmount", "billing_payment",
     "PaymentAmount <= 0"),
    ("Payment_PaymentSource", "billing_payment",
     "PaymentSource not in ('Patient', 'Insurance', 'Employer', 'Government', 'Charity', 'Other')"),
    ("Payment_PaymentMethod", "billing_payment",
     "PaymentMethod not in ('Credit Card', 'Debit Card', 'ACH', 'Check', 'Cash', 'Wire Transfer', 'Portal', 'Lockbox', 'Other')"),
    ("Payment_PaymentStatus", "billing_payment",
     "PaymentStatus not in ('Pending', 'Posted', 'Reversed', 'Failed', 'Refunded')"),
    ("Payment_PayerSourceConsistency", "billing_payment",
     "PaymentSource = 'Insurance' and PayerID is null"),
    ("Payment_CheckNumber", "billing_payment",
     "PaymentMethod = 'Check' and coalesce(trim(CheckNumber), '') = ''"),
    ("PaymentAllocation_AllocatedAmount", "billing_paymentallocation",
     "AllocatedAmount <= 0"),
    ("PaymentAllocation_AllocationStatus", "billing_paymentallocation",
     "AllocationStatus not in ('Pending', 'Posted', 'Reversed')"),
    ("PaymentAllocation_ReversalReason", "billing_paymentallocation",
     "AllocationStatus = 'Reversed' and coalesce(trim(ReversalReason), '') = ''"),
    ("Adjustment_AdjustmentAmount", "billing_adjustment",
     "AdjustmentAmount <= 0"),
    ("Adjustment_AdjustmentType", "billing_adjustment",
     "AdjustmentType not in ('Contractual', 'Administrative', 'Charity', 'Bad Debt', 'Courtesy', 'Correction', 'Insurance', 'Other')"),
    ("Adjustment_AdjustmentStatus", "billing_adjustment",
     "AdjustmentStatus not in ('Pending', 'Approved', 'Posted', 'Reversed', 'Denied')"),
    ("Adjustment_ReasonCode", "billing_adjustment",
     "coalesce(trim(AdjustmentReasonCode), '') = ''"),
    ("Refund_RefundAmount", "billing_refund",
     "RefundAmount <= 0"),
    ("Refund_RefundMethod", "billing_refund",
     "RefundMethod not in ('Credit Card', 'Debit Card', 'ACH', 'Check', 'Cash', 'Wire Transfer', 'Other')"),
    ("Refund_RefundStatus", "billing_refund",
     "RefundStatus not in ('Pending', 'Approved', 'Issued', 'Failed', 'Cancelled')"),
    ("Refund_Reason", "billing_refund",
     "coalesce(trim(Reason), '') = ''"),
    ("AccountBalanceHistory_NonNegative", "billing_accountbalancehistory",
     "least(CurrentBalance, Balance0To30Days, Balance31To60Days, Balance61To90Days, Balance91To120Days, BalanceOver120Days, InsurancePendingAmount, PatientResponsibilityAmount, CollectionsAmount) < 0"),
    ("Campaign_CampaignType", "marketing_campaign",
     "CampaignType not in ('Awareness', 'Acquisition', 'Retention', 'Reactivation', 'Education', 'Engagement', 'Referral', 'Other')"),
    ("Campaign_CampaignObjective", "marketing_campaign",
     "CampaignObjective not in ('Lead Generation', 'Appointment Booking', 'Brand Awareness', 'Patient Education', 'Retention', 'Reactivation', 'Survey', 'Other')"),
    ("Campaign_CampaignStatus", "marketing_campaign",
     "CampaignStatus not in ('Draft', 'Scheduled', 'Active', 'Paused', 'Completed', 'Cancelled', 'Archived')"),
    ("Campaign_EndDate", "marketing_campaign",
     "EndDate < StartDate"),
    ("Campaign_BudgetAmount", "marketing_campaign",
     "BudgetAmount < 0"),
    ("CampaignChannel_ChannelType", "marketing_campaignchannel",
     "ChannelType not in ('Email', 'SMS', 'Phone', 'Portal', 'Website', 'Social Media', 'Search', 'Display', 'Direct Mail', 'Referral', 'Event', 'Other')"),
    ("CampaignChannel_PlannedSpend", "marketing_campaignchannel",
     "PlannedSpendAmount < 0"),
    ("CampaignChannel_ActualSpend", "marketing_campaignchannel",
     "ActualSpendAmount < 0"),
    ("AudienceSegment_SegmentType", "marketing_audiencesegment",
     "SegmentType not in ('Demographic', 'Clinical', 'Geographic', 'Behavioral', 'Payer', 'Custom', 'Other')"),
    ("AudienceSegment_RefreshFrequency", "marketing_audiencesegment",
     "RefreshFrequency not in ('Manual', 'Daily', 'Weekly', 'Monthly', 'Quarterly', 'Annually')"),
    ("AudienceSegment_EstimatedMemberCount", "marketing_audiencesegment",
     "EstimatedMemberCount < 0"),
    ("CampaignAudience_AudienceRole", "marketing_campaignaudience",
     "AudienceRole not in ('Target', 'Control', 'Exclusion', 'Test')"),
    ("CampaignAudience_PriorityRank", "marketing_campaignaudience",
     "PriorityRank <= 0"),
    ("CampaignAudience_ExpectedReach", "marketing_campaignaudience",
     "ExpectedReach < 0"),
    ("PatientCommPref_ChannelType", "marketing_patientcommunicationpreference",
     "ChannelType not in ('Email', 'SMS', 'Phone', 'Portal', 'Direct Mail', 'Push Notification', 'Other')"),
    ("PatientCommPref_ConsentStatus", "marketing_patientcommunicationpreference",
     "ConsentStatus not in ('Opted In', 'Opted Out', 'Pending', 'Revoked')"),
    ("PatientCommPref_ConsentSource", "marketing_patientcommunicationpreference",
     "ConsentSource not in ('Web Portal', 'Phone', 'In Person', 'Paper Form', 'SMS', 'Email', 'Import', 'Other')"),
    ("PatientCommPref_PreferredContactTime", "marketing_patientcommunicationpreference",
     "PreferredContactTime not in ('Morning', 'Afternoon', 'Evening', 'Anytime')"),
    ("PatientCommPref_OptedInRequiresConsent", "marketing_patientcommunicationpreference",
     "ConsentStatus = 'Opted In' and ConsentDateTimeUTC is null"),
    ("PatientCommPref_RevokedRequiresDate", "marketing_patientcommunicationpreference",
     "ConsentStatus = 'Revoked' and RevokedDateTimeUTC is null"),
    ("PatientCommPref_RevokedNotBeforeConsent", "marketing_patientcommunicationpreference",
     "RevokedDateTimeUTC < ConsentDateTimeUTC"),
    ("PatientCommPref_InactiveConsistency", "marketing_patientcommunicationpreference",
     "ConsentStatus in ('Opted Out', 'Revoked') and IsActive"),
    ("CampaignInteraction_InteractionType", "marketing_campaigninteraction",
     "InteractionType not in ('Sent', 'Delivered', 'Opened', 'Clicked', 'Replied', 'Called', 'Viewed', 'Registered', 'Attended', 'Converted', 'Unsubscribed', 'Bounced', 'Failed')"),
    ("CampaignInteraction_InteractionStatus", "marketing_campaigninteraction",
     "InteractionStatus not in ('Pending', 'Queued', 'Success', 'Failed', 'Bounced', 'Rejected', 'Cancelled')"),
    ("ReferralSource_ReferralSourceType", "marketing_referralsource",
     "ReferralSourceType not in ('Provider', 'Hospital', 'Health Plan', 'Employer', 'Patient', 'Digital', 'Community', 'Event', 'Internal', 'Other')"),
    ("PatientAcquisition_AcquisitionChannel", "marketing_patientacquisition",
     "AcquisitionChannel not in ('Email', 'SMS', 'Phone', 'Portal', 'Website', 'Social Media', 'Search', 'Display', 'Direct Mail', 'Referral', 'Event', 'Other')"),
    ("PatientAcquisition_AttributionModel", "marketing_patientacquisition",
     "AttributionModel not in ('First Touch', 'Last Touch', 'Linear', 'Time Decay', 'Position Based', 'Data Driven', 'Other')"),
    ("PatientAcquisition_AcquisitionStatus", "marketing_patientacquisition",
     "AcquisitionStatus not in ('Lead', 'Qualified', 'Converted', 'Lost', 'Inactive')"),
    ("PatientAcquisition_AcquisitionCost", "marketing_patientacquisition",
     "AcquisitionCost < 0"),
    ("PatientAcquisition_InteractionRequiresCampaign", "marketing_patientacquisition",
     "CampaignInteractionID is not null and CampaignID is null"),
    ("Model_ModelType", "ai_model",
     "ModelType not in ('Machine Learning', 'Deep Learning', 'Statistical', 'Rule Based', 'Ensemble', 'Generative', 'Other')"),
    ("Model_ProblemType", "ai_model",
     "ProblemType not in ('Binary Classification', 'Multiclass Classification', 'Regression', 'Clustering', 'Time Series', 'Ranking', 'Survival', 'Other')"),
    ("Model_ModelStatus", "ai_model",
     "ModelStatus not in ('Development', 'Validation', 'Approved', 'Production', 'Shadow', 'Suspended', 'Retired')"),
    ("Model_RiskLevel", "ai_model",
     "RiskLevel not in ('Low', 'Medium', 'High', 'Critical')"),
    ("Model_OwnerRequiresHospital", "ai_model",
     "OwnerProviderID is not null and OwningHospitalID is null"),
    ("ModelVersion_ApprovalStatus", "ai_modelversion",
     "ApprovalStatus not in ('Pending', 'Approved', 'Rejected', 'Withdrawn')"),
    ("ModelVersion_TrainingDateRange", "ai_modelversion",
     "TrainingDataEndDate < TrainingDataStartDate"),
    ("ModelVersion_EffectiveDateRange", "ai_modelversion",
     "EffectiveEndDateTimeUTC < EffectiveStartDateTimeUTC"),
    ("ModelVersion_TrainingRecordCount", "ai_modelversion",
     "TrainingRecordCount < 0"),
    ("ModelVersion_FeatureCount", "ai_modelversion",
     "FeatureCount < 0"),
    ("ModelVersion_ApprovalConsistency", "ai_modelversion",
     "(ApprovedByProviderID is null) <> (ApprovedDateTimeUTC is null) or (ApprovalStatus = 'Approved' and ApprovedByProviderID is null) or (ApprovalStatus <> 'Approved' and ApprovedByProviderID is not null)"),
    ("FeatureDefinition_DataType", "ai_featuredefinition",
     "DataType not in ('Integer', 'Decimal', 'Boolean', 'String', 'Text', 'DateTime', 'Categorical', 'Binary', 'Other')"),
    ("FeatureDefinition_FeatureCategory", "ai_featuredefinition",
     "FeatureCategory not in ('Demographic', 'Clinical', 'Lab', 'Vitals', 'Medication', 'Utilization', 'Financial', 'Behavioral', 'Temporal', 'Derived', 'Other')"),
    ("FeatureDefinition_SourceSchema", "ai_featuredefinition",
     "coalesce(trim(SourceSchema), '') = ''"),
    ("FeatureDefinition_SourceTable", "ai_featuredefinition",
     "coalesce(trim(SourceTable), '') = ''"),
    ("ModelFeature_FeatureRole", "ai_modelfeature",
     "FeatureRole not in ('Input', 'Target', 'Identifier', 'Protected Attribute', 'Monitoring Only')"),
    ("ModelFeature_FeatureOrder", "ai_modelfeature",
     "FeatureOrder <= 0"),
    ("Prediction_PredictionType", "ai_prediction",
     "PredictionType not in ('Classification', 'Regression', 'Risk Score', 'Probability', 'Forecast', 'Recommendation', 'Anomaly', 'Other')"),
    ("Prediction_PredictionStatus", "ai_prediction",
     "PredictionStatus not in ('Generated', 'Delivered', 'Consumed', 'Overridden', 'Suppressed', 'Failed')"),
    ("Prediction_ProbabilityScore", "ai_prediction",
     "ProbabilityScore < 0 or ProbabilityScore > 1"),
    ("Prediction_ThresholdUsed", "ai_prediction",
     "ThresholdUsed < 0 or ThresholdUsed > 1"),
    ("Prediction_RiskScore", "ai_prediction",
     "RiskScore < 0"),
    ("PredictionOutcome_OutcomeType", "ai_predictionoutcome",
     "OutcomeType not in ('Confirmed', 'Refuted', 'Partial', 'Censored', 'Unknown', 'Other')"),
    ("PredictionOutcome_OutcomeSource", "ai_predictionoutcome",
     "OutcomeSource not in ('EHR', 'Manual Review', 'Claims', 'Lab', 'Registry', 'External', 'Other')"),
    ("PredictionOutcome_VerificationConsistency", "ai_predictionoutcome",
     "(VerifiedByProviderID is null) <> (VerifiedDateTimeUTC is null)"),
    ("ModelPerformanceMetric_MetricName", "ai_modelperformancemetric",
     "MetricName not in ('AUROC', 'AUPRC', 'Accuracy', 'Precision', 'Recall', 'Sensitivity', 'Specificity', 'F1 Score', 'Log Loss', 'Brier Score', 'RMSE', 'MAE', 'MAPE', 'R2', 'Calibration Slope', 'Calibration Intercept', 'Other')"),
    ("ModelPerformanceMetric_OtherDescription", "ai_modelperformancemetric",
     "MetricName = 'Other' and coalesce(trim(MetricDescription), '') = ''"),
    ("ModelPerformanceMetric_EvaluationDataset", "ai_modelperformancemetric",
     "EvaluationDataset not in ('Training', 'Validation', 'Test', 'Holdout', 'Production', 'Shadow', 'Other')"),
    ("ModelPerformanceMetric_EvaluationDateRange", "ai_modelperformancemetric",
     "EvaluationEndDate < EvaluationStartDate"),
    ("ModelPerformanceMetric_ThresholdValue", "ai_modelperformancemetric",
     "ThresholdValue < 0 or ThresholdValue > 1"),
    ("ModelPerformanceMetric_SampleSize", "ai_modelperformancemetric",
     "SampleSize < 0"),
    ("ModelMonitoringEvent_EventType", "ai_modelmonitoringevent",
     "EventType not in ('Data Drift', 'Concept Drift', 'Performance Degradation', 'Bias Alert', 'Missing Data', 'Latency', 'Availability', 'Security', 'Safety', 'Compliance', 'Other')"),
    ("ModelMonitoringEvent_Severity", "ai_modelmonitoringevent",
     "Severity not in ('Info', 'Low', 'Medium', 'High', 'Critical')"),
    ("ModelMonitoringEvent_ResolutionStatus", "ai_modelmonitoringevent",
     "ResolutionStatus not in ('Open', 'Acknowledged', 'Investigating', 'Resolved', 'Dismissed')"),
    ("ModelMonitoringEvent_ExpectedRange", "ai_modelmonitoringevent",
     "ExpectedMaximum < ExpectedMinimum"),
    ("ModelMonitoringEvent_ResolutionConsistency", "ai_modelmonitoringevent",
     "(ResolvedByProviderID is null) <> (ResolvedDateTimeUTC is null) or (ResolutionStatus in ('Resolved', 'Dismissed') and ResolvedByProviderID is null) or (ResolutionStatus in ('Open', 'Acknowledged', 'Investigating') and ResolvedByProviderID is not null) or ResolutionStatus not in ('Resolved', 'Dismissed', 'Open', 'Acknowledged', 'Investigating')"),
]
JSON = [
    ("AudienceSegment_DefinitionJSON", "marketing_audiencesegment", "DefinitionJSON"),
    ("ModelVersion_HyperparametersJSON", "ai_modelversion", "HyperparametersJSON"),
    ("Prediction_InputSnapshotJSON", "ai_prediction", "InputSnapshotJSON"),
    ("Prediction_ExplanationJSON", "ai_prediction", "ExplanationJSON"),
]

# Name, table, columns, parent, its columns.
REFERENCES = [
    ("Location_Hospital", "hospital_location", "HospitalID", "hospital_hospital", "HospitalID"),
    ("Department_Hospital", "hospital_department", "HospitalID", "hospital_hospital", "HospitalID"),
    ("Department_Location_Hospital", "hospital_department", "LocationID, HospitalID", "hospital_location", "LocationID, HospitalID"),
    ("Provider_Hospital", "hospital_provider", "HospitalID", "hospital_hospital", "HospitalID"),
    ("Provider_Department_Hospital", "hospital_provider", "DepartmentID, HospitalID", "hospital_department", "DepartmentID, HospitalID"),
    ("ProviderSpecialty_Provider", "hospital_providerspecialty", "ProviderID", "hospital_provider", "ProviderID"),
    ("ProviderSpecialty_Specialty", "hospital_providerspecialty", "SpecialtyID", "hospital_specialty", "SpecialtyID"),
    ("PatientAddress_Patient", "clinical_patientaddress", "PatientID", "clinical_patient", "PatientID"),
    ("Encounter_Patient", "clinical_encounter", "PatientID", "clinical_patient", "PatientID"),
    ("Encounter_Hospital", "clinical_encounter", "HospitalID", "hospital_hospital", "HospitalID"),
    ("Encounter_Location_Hospital", "clinical_encounter", "LocationID, HospitalID", "hospital_location", "LocationID, HospitalID"),
    ("Encounter_Department_Hospital", "clinical_encounter", "DepartmentID, HospitalID", "hospital_department", "DepartmentID, HospitalID"),
    ("Diagnosis_Patient", "clinical_diagnosis", "PatientID", "clinical_patient", "PatientID"),
    ("Procedure_Patient", "clinical_procedure", "PatientID", "clinical_patient", "PatientID"),
    ("Procedure_Provider", "clinical_procedure", "ProviderID", "hospital_provider", "ProviderID"),
    ("MedicationOrder_Patient", "clinical_medicationorder", "PatientID", "clinical_patient", "PatientID"),
    ("MedicationOrder_Provider", "clinical_medicationorder", "ProviderID", "hospital_provider", "ProviderID"),
    ("MedicationOrder_Medication", "clinical_medicationorder", "MedicationID", "clinical_medication", "MedicationID"),
    ("Vitals_Patient", "clinical_vitals", "PatientID", "clinical_patient", "PatientID"),
    ("Vitals_Provider", "clinical_vitals", "RecordedByProviderID", "hospital_provider", "ProviderID"),
    ("Encounter_Provider_Hospital", "clinical_encounter", "ProviderID, HospitalID", "hospital_provider", "ProviderID, HospitalID"),
    ("Diagnosis_Encounter_Patient", "clinical_diagnosis", "EncounterID, PatientID", "clinical_encounter", "EncounterID, PatientID"),
    ("Procedure_Encounter_Patient", "clinical_procedure", "EncounterID, PatientID", "clinical_encounter", "EncounterID, PatientID"),
    ("MedicationOrder_Encounter_Patient", "clinical_medicationorder", "EncounterID, PatientID", "clinical_encounter", "EncounterID, PatientID"),
    ("Vitals_Encounter_Patient", "clinical_vitals", "EncounterID, PatientID", "clinical_encounter", "EncounterID, PatientID"),
    ("VirtualVisit_Encounter_Patient", "telehealth_virtualvisit", "EncounterID, PatientID", "clinical_encounter", "EncounterID, PatientID"),
    ("VirtualVisit_Provider_Hospital", "telehealth_virtualvisit", "ProviderID, HospitalID", "hospital_provider", "ProviderID, HospitalID"),
    ("VirtualVisit_Department_Hospital", "telehealth_virtualvisit", "DepartmentID, HospitalID", "hospital_department", "DepartmentID, HospitalID"),
    ("SessionEvent_VirtualVisit", "telehealth_sessionevent", "VirtualVisitID", "telehealth_virtualvisit", "VirtualVisitID"),
    ("Device_Patient", "telehealth_device", "PatientID", "clinical_patient", "PatientID"),
    ("DeviceReading_Device_Patient", "telehealth_devicereading", "DeviceID, PatientID", "telehealth_device", "DeviceID, PatientID"),
    ("DeviceReading_Encounter_Patient", "telehealth_devicereading", "EncounterID, PatientID", "clinical_encounter", "EncounterID, PatientID"),
    ("WaitlistQueue_Visit_Patient", "telehealth_waitlistqueue", "VirtualVisitID, PatientID", "telehealth_virtualvisit", "VirtualVisitID, PatientID"),
    ("WaitlistQueue_Visit_Provider", "telehealth_waitlistqueue", "VirtualVisitID, ProviderID", "telehealth_virtualvisit", "VirtualVisitID, ProviderID"),
    ("WaitlistQueue_Visit_Department", "telehealth_waitlistqueue", "VirtualVisitID, DepartmentID", "telehealth_virtualvisit", "VirtualVisitID, DepartmentID"),
    ("InsurancePlan_Payer", "insurance_insuranceplan", "PayerID", "insurance_payer", "PayerID"),
    ("PatientCoverage_Patient", "insurance_patientcoverage", "PatientID", "clinical_patient", "PatientID"),
    ("PatientCoverage_InsurancePlan", "insurance_patientcoverage", "InsurancePlanID", "insurance_insuranceplan", "InsurancePlanID"),
    ("PatientCoverage_Subscriber", "insurance_patientcoverage", "SubscriberPatientID", "clinical_patient", "PatientID"),
    ("PriorAuth_Patient", "insurance_priorauthorization", "PatientID", "clinical_patient", "PatientID"),
    ("PriorAuth_InsurancePlan", "insurance_priorauthorization", "InsurancePlanID", "insurance_insuranceplan", "InsurancePlanID"),
    ("PriorAuth_Encounter_Patient", "insurance_priorauthorization", "EncounterID, PatientID", "clinical_encounter", "EncounterID, PatientID"),
    ("PriorAuth_Provider", "insurance_priorauthorization", "ProviderID", "hospital_provider", "ProviderID"),
    ("Claim_Patient", "insurance_claim", "PatientID", "clinical_patient", "PatientID"),
    ("Claim_Coverage_Patient", "insurance_claim", "PatientCoverageID, PatientID", "insurance_patientcoverage", "PatientCoverageID, PatientID"),
    ("Claim_Encounter_Patient", "insurance_claim", "EncounterID, PatientID", "clinical_encounter", "EncounterID, PatientID"),
    ("Claim_Provider_Hospital", "insurance_claim", "ProviderID, HospitalID", "hospital_provider", "ProviderID, HospitalID"),
    ("Claim_Hospital", "insurance_claim", "HospitalID", "hospital_hospital", "HospitalID"),
    ("Claim_OriginalClaim", "insurance_claim", "OriginalClaimID", "insurance_claim", "ClaimID"),
    ("ClaimLine_Claim", "insurance_claimline", "ClaimID", "insurance_claim", "ClaimID"),
    ("ClaimStatusHistory_Claim", "insurance_claimstatushistory", "ClaimID", "insurance_claim", "ClaimID"),
    ("PatientAccount_Patient", "billing_patientaccount", "PatientID", "clinical_patient", "PatientID"),
    ("Invoice_Account_Patient", "billing_invoice", "PatientAccountID, PatientID", "billing_patientaccount", "PatientAccountID, PatientID"),
    ("Invoice_Encounter_Patient", "billing_invoice", "EncounterID, PatientID", "clinical_encounter", "EncounterID, PatientID"),
    ("Invoice_Claim_Patient", "billing_invoice", "ClaimID, PatientID", "insurance_claim", "ClaimID, PatientID"),
    ("Invoice_OriginalInvoice", "billing_invoice", "OriginalInvoiceID", "billing_invoice", "InvoiceID"),
    ("InvoiceLine_Invoice", "billing_invoiceline", "InvoiceID", "billing_invoice", "InvoiceID"),
    ("InvoiceLine_ClaimLine", "billing_invoiceline", "ClaimLineID", "insurance_claimline", "ClaimLineID"),
    ("InvoiceLine_Invoice_Encounter", "billing_invoiceline", "InvoiceID, EncounterID", "billing_invoice", "InvoiceID, EncounterID"),
    ("Payment_Account_Patient", "billing_payment", "PatientAccountID, PatientID", "billing_patientaccount", "PatientAccountID, PatientID"),
    ("Payment_Payer", "billing_payment", "PayerID", "insurance_payer", "PayerID"),
    ("PaymentAllocation_Payment", "billing_paymentallocation", "PaymentID", "billing_payment", "PaymentID"),
    ("PaymentAllocation_Invoice", "billing_paymentallocation", "InvoiceID", "billing_invoice", "InvoiceID"),
    ("Adjustment_Invoice", "billing_adjustment", "InvoiceID", "billing_invoice", "InvoiceID"),
    ("Adjustment_InvoiceLine_Invoice", "billing_adjustment", "InvoiceLineID, InvoiceID", "billing_invoiceline", "InvoiceLineID, InvoiceID"),
    ("Adjustment_Claim", "billing_adjustment", "ClaimID", "insurance_claim", "ClaimID"),
    ("Adjustment_Provider", "billing_adjustment", "ApprovedByProviderID", "hospital_provider", "ProviderID"),
    ("Refund_Payment_Account_Patient", "billing_refund", "PaymentID, PatientAccountID, PatientID", "billing_payment", "PaymentID, PatientAccountID, PatientID"),
    ("Refund_Account_Patient", "billing_refund", "PatientAccountID, PatientID", "billing_patientaccount", "PatientAccountID, PatientID"),
    ("Refund_Provider", "billing_refund", "ApprovedByProviderID", "hospital_provider", "ProviderID"),
    ("AccountBalanceHistory_Account_Patient", "billing_accountbalancehistory", "PatientAccountID, PatientID", "billing_patientaccount", "PatientAccountID, PatientID"),
    ("Campaign_Hospital", "marketing_campaign", "HospitalID", "hospital_hospital", "HospitalID"),
    ("Campaign_Owner_Hospital", "marketing_campaign", "OwnerProviderID, HospitalID", "hospital_provider", "ProviderID, HospitalID"),
    ("CampaignChannel_Campaign", "marketing_campaignchannel", "CampaignID", "marketing_campaign", "CampaignID"),
    ("CampaignAudience_Campaign", "marketing_campaignaudience", "CampaignID", "marketing_campaign", "CampaignID"),
    ("CampaignAudience_AudienceSegment", "marketing_campaignaudience", "AudienceSegmentID", "marketing_audiencesegment", "AudienceSegmentID"),
    ("PatientCommPref_Patient", "marketing_patientcommunicationpreference", "PatientID", "clinical_patient", "PatientID"),
    ("CampaignInteraction_Channel_Campaign", "marketing_campaigninteraction", "CampaignChannelID, CampaignID", "marketing_campaignchannel", "CampaignChannelID, CampaignID"),
    ("CampaignInteraction_Patient", "marketing_campaigninteraction", "PatientID", "clinical_patient", "PatientID"),
    ("CampaignInteraction_Encounter_Patient", "marketing_campaigninteraction", "EncounterID, PatientID", "clinical_encounter", "EncounterID, PatientID"),
    ("ReferralSource_Hospital", "marketing_referralsource", "ReferringHospitalID", "hospital_hospital", "HospitalID"),
    ("ReferralSource_Provider_Hospital", "marketing_referralsource", "ReferringProviderID, ReferringHospitalID", "hospital_provider", "ProviderID, HospitalID"),
    ("PatientAcquisition_Patient", "marketing_patientacquisition", "PatientID", "clinical_patient", "PatientID"),
    ("PatientAcquisition_ReferralSource", "marketing_patientacquisition", "ReferralSourceID", "marketing_referralsource", "ReferralSourceID"),
    ("PatientAcquisition_Campaign", "marketing_patientacquisition", "CampaignID", "marketing_campaign", "CampaignID"),
    ("PatientAcquisition_Interaction", "marketing_patientacquisition", "CampaignInteractionID, PatientID, CampaignID", "marketing_campaigninteraction", "CampaignInteractionID, PatientID, CampaignID"),
    ("PatientAcquisition_FirstEncounter_Patient", "marketing_patientacquisition", "FirstEncounterID, PatientID", "clinical_encounter", "EncounterID, PatientID"),
    ("Model_Hospital", "ai_model", "OwningHospitalID", "hospital_hospital", "HospitalID"),
    ("Model_Owner_Hospital", "ai_model", "OwnerProviderID, OwningHospitalID", "hospital_provider", "ProviderID, HospitalID"),
    ("ModelVersion_Model", "ai_modelversion", "ModelID", "ai_model", "ModelID"),
    ("ModelVersion_ApprovedByProvider", "ai_modelversion", "ApprovedByProviderID", "hospital_provider", "ProviderID"),
    ("ModelFeature_ModelVersion", "ai_modelfeature", "ModelVersionID", "ai_modelversion", "ModelVersionID"),
    ("ModelFeature_FeatureDefinition", "ai_modelfeature", "FeatureDefinitionID", "ai_featuredefinition", "FeatureDefinitionID"),
    ("Prediction_ModelVersion", "ai_prediction", "ModelVersionID", "ai_modelversion", "ModelVersionID"),
    ("Prediction_Patient", "ai_prediction", "PatientID", "clinical_patient", "PatientID"),
    ("Prediction_Encounter_Patient", "ai_prediction", "EncounterID, PatientID", "clinical_encounter", "EncounterID, PatientID"),
    ("PredictionOutcome_Prediction", "ai_predictionoutcome", "PredictionID", "ai_prediction", "PredictionID"),
    ("PredictionOutcome_VerifiedByProvider", "ai_predictionoutcome", "VerifiedByProviderID", "hospital_provider", "ProviderID"),
    ("ModelPerformanceMetric_ModelVersion", "ai_modelperformancemetric", "ModelVersionID", "ai_modelversion", "ModelVersionID"),
    ("ModelMonitoringEvent_ModelVersion", "ai_modelmonitoringevent", "ModelVersionID", "ai_modelversion", "ModelVersionID"),
    ("ModelMonitoringEvent_ResolvedByProvider", "ai_modelmonitoringevent", "ResolvedByProviderID", "hospital_provider", "ProviderID"),
]

# Name, table, columns.
UNIQUE = [
    ("Hospital_HospitalCode", "hospital_hospital", "HospitalCode"),
    ("Location_Hospital_LocationCode", "hospital_location", "HospitalID, LocationCode"),
    ("Location_LocationID_HospitalID", "hospital_location", "LocationID, HospitalID"),
    ("Department_Hospital_DepartmentCode", "hospital_department", "HospitalID, DepartmentCode"),
    ("Department_DepartmentID_HospitalID", "hospital_department", "DepartmentID, HospitalID"),
    ("Specialty_SpecialtyCode", "hospital_specialty", "SpecialtyCode"),
    ("Specialty_SpecialtyName", "hospital_specialty", "SpecialtyName"),
    ("Provider_Hospital_ProviderCode", "hospital_provider", "HospitalID, ProviderCode"),
    ("ProviderSpecialty_Provider_Specialty", "hospital_providerspecialty", "ProviderID, SpecialtyID"),
    ("Patient_MedicalRecordNumber", "clinical_patient", "MedicalRecordNumber"),
    ("Encounter_EncounterNumber", "clinical_encounter", "EncounterNumber"),
    ("Medication_MedicationCode", "clinical_medication", "MedicationCode"),
    ("Provider_ProviderID_HospitalID", "hospital_provider", "ProviderID, HospitalID"),
    ("Encounter_EncounterID_PatientID", "clinical_encounter", "EncounterID, PatientID"),
    ("VirtualVisit_VisitNumber", "telehealth_virtualvisit", "VisitNumber"),
    ("VirtualVisit_EncounterID", "telehealth_virtualvisit", "EncounterID"),
    ("VirtualVisit_VisitID_PatientID", "telehealth_virtualvisit", "VirtualVisitID, PatientID"),
    ("VirtualVisit_VisitID_ProviderID", "telehealth_virtualvisit", "VirtualVisitID, ProviderID"),
    ("VirtualVisit_VisitID_DepartmentID", "telehealth_virtualvisit", "VirtualVisitID, DepartmentID"),
    ("SessionEvent_Visit_Sequence", "telehealth_sessionevent", "VirtualVisitID, EventSequenceNumber"),
    ("Device_DeviceIdentifier", "telehealth_device", "DeviceIdentifier"),
    ("Device_DeviceID_PatientID", "telehealth_device", "DeviceID, PatientID"),
    ("WaitlistQueue_Visit_EnteredTime", "telehealth_waitlistqueue", "VirtualVisitID, QueueEnteredDateTimeUTC"),
    ("Payer_PayerCode", "insurance_payer", "PayerCode"),
    ("InsurancePlan_Payer_PlanCode", "insurance_insuranceplan", "PayerID, PlanCode"),
    ("PatientCoverage_Plan_MemberNumber", "insurance_patientcoverage", "InsurancePlanID, MemberNumber"),
    ("PatientCoverage_CoverageID_PatientID", "insurance_patientcoverage", "PatientCoverageID, PatientID"),
    ("Claim_ClaimNumber", "insurance_claim", "ClaimNumber"),
    ("ClaimLine_Claim_LineNumber", "insurance_claimline", "ClaimID, LineNumber"),
    ("ClaimStatusHistory_Claim_Sequence", "insurance_claimstatushistory", "ClaimID, StatusSequenceNumber"),
    ("Claim_ClaimID_PatientID", "insurance_claim", "ClaimID, PatientID"),
    ("PatientAccount_AccountNumber", "billing_patientaccount", "AccountNumber"),
    ("PatientAccount_AccountID_PatientID", "billing_patientaccount", "PatientAccountID, PatientID"),
    ("Invoice_InvoiceNumber", "billing_invoice", "InvoiceNumber"),
    ("Invoice_InvoiceID_EncounterID", "billing_invoice", "InvoiceID, EncounterID"),
    ("Invoice_InvoiceID_Account_Patient", "billing_invoice", "InvoiceID, PatientAccountID, PatientID"),
    ("InvoiceLine_Invoice_LineNumber", "billing_invoiceline", "InvoiceID, LineNumber"),
    ("InvoiceLine_LineID_InvoiceID", "billing_invoiceline", "InvoiceLineID, InvoiceID"),
    ("Payment_PaymentNumber", "billing_payment", "PaymentNumber"),
    ("Payment_PaymentID_Account_Patient", "billing_payment", "PaymentID, PatientAccountID, PatientID"),
    ("PaymentAllocation_Payment_Sequence", "billing_paymentallocation", "PaymentID, AllocationSequenceNumber"),
    ("Adjustment_AdjustmentNumber", "billing_adjustment", "AdjustmentNumber"),
    ("Refund_RefundNumber", "billing_refund", "RefundNumber"),
    ("AccountBalanceHistory_Account_SnapshotDate", "billing_accountbalancehistory", "PatientAccountID, SnapshotDate"),
    ("Campaign_CampaignCode", "marketing_campaign", "CampaignCode"),
    ("CampaignChannel_ChannelID_CampaignID", "marketing_campaignchannel", "CampaignChannelID, CampaignID"),
    ("AudienceSegment_SegmentCode", "marketing_audiencesegment", "SegmentCode"),
    ("CampaignAudience_Campaign_Segment_Role", "marketing_campaignaudience", "CampaignID, AudienceSegmentID, AudienceRole"),
    ("CampaignInteraction_Interaction_Patient_Campaign", "marketing_campaigninteraction", "CampaignInteractionID, PatientID, CampaignID"),
    ("ReferralSource_ReferralSourceCode", "marketing_referralsource", "ReferralSourceCode"),
    ("PatientAcquisition_PatientID", "marketing_patientacquisition", "PatientID"),
    ("Model_ModelCode", "ai_model", "ModelCode"),
    ("ModelVersion_Model_VersionNumber", "ai_modelversion", "ModelID, VersionNumber"),
    ("FeatureDefinition_FeatureCode", "ai_featuredefinition", "FeatureCode"),
    ("ModelFeature_Version_Feature", "ai_modelfeature", "ModelVersionID, FeatureDefinitionID"),
    ("Prediction_CorrelationID", "ai_prediction", "CorrelationID"),
    ("PredictionOutcome_PredictionID", "ai_predictionoutcome", "PredictionID"),
]

# Name, table, columns, condition.
FILTERED = [
    ("Hospital_TaxID", "hospital_hospital", "TaxID", "TaxID is not null"),
    ("Location_OnePrimaryPerHospital", "hospital_location", "HospitalID", "IsPrimary and IsActive"),
    ("Provider_NPINumber", "hospital_provider", "NPINumber", "NPINumber is not null"),
    ("Provider_MedicalLicense", "hospital_provider", "MedicalLicenseNumber, LicenseState", "MedicalLicenseNumber is not null and LicenseState is not null"),
    ("Provider_DEANumber", "hospital_provider", "DEANumber", "DEANumber is not null"),
    ("ProviderSpecialty_OnePrimary", "hospital_providerspecialty", "ProviderID", "IsPrimary and IsActive"),
    ("PatientAddress_OnePrimaryPerPatient", "clinical_patientaddress", "PatientID", "IsPrimary and IsActive"),
    ("Device_SerialNumber", "telehealth_device", "SerialNumber", "SerialNumber is not null"),
    ("Payer_TaxIdentifier", "insurance_payer", "TaxIdentifier", "TaxIdentifier is not null"),
    ("PriorAuth_AuthorizationNumber", "insurance_priorauthorization", "AuthorizationNumber", "AuthorizationNumber is not null"),
    ("PatientAccount_ActivePatient", "billing_patientaccount", "PatientID", "IsActive"),
    ("Payment_TransactionReference", "billing_payment", "TransactionReference", "TransactionReference is not null"),
    ("Refund_TransactionReference", "billing_refund", "TransactionReference", "TransactionReference is not null"),
    ("CampaignChannel_Campaign_Type_Name", "marketing_campaignchannel", "CampaignID, ChannelType, ChannelName", "ChannelName is not null"),
    ("CampaignChannel_TrackingCode", "marketing_campaignchannel", "TrackingCode", "TrackingCode is not null"),
    ("PatientCommPref_ActivePatientChannel", "marketing_patientcommunicationpreference", "PatientID, ChannelType", "IsActive"),
    ("CampaignInteraction_Source_ExternalMessage", "marketing_campaigninteraction", "SourceSystem, ExternalMessageID", "ExternalMessageID is not null and SourceSystem is not null"),
    ("PatientAcquisition_ExternalLeadID", "marketing_patientacquisition", "ExternalLeadID", "ExternalLeadID is not null"),
    ("ModelVersion_ModelHash", "ai_modelversion", "ModelHash", "ModelHash is not null"),
    ("ModelPerformanceMetric_Version_Metric_Window", "ai_modelperformancemetric", "ModelVersionID, MetricName, EvaluationDataset, EvaluationStartDate, EvaluationEndDate, PatientPopulationSegment", "true"),
]
