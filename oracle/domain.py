"""DuckDB text of the derived hospital tables, one common table expression each."""

from __future__ import annotations

N = "(select count(*) from supplier)"


def provider(k: str) -> str:
    return f"(({k} * 7 + {k} // 13) % {N})"


def hospital_of(p: str) -> str:
    return f"cast(case when {p} % 97 = 53 then 99 else {p} % 25 end as integer)"


def department_of(p: str) -> str:
    return (
        f"cast((case when {p} % 37 = 11 then ({p} + 1) % 25 else {p} % 25 end) * 5 + ({p} // 25) % 5 as integer)"
    )


def claimed(k: str) -> str:
    return f"{k} % 3 <> 0 and {k} % 97 <> 0 and {provider(k)} % 10 <> 4"


def invoiced(k: str) -> str:
    return f"{claimed(k)} and {k} % 5 <> 0"


def code(prefix: str, k: str) -> str:
    return f"'{prefix}-' || lpad(cast({k} as varchar), 12, '0')"


def pick(index: str, *labels: str) -> str:
    return f"([{', '.join(repr(label) for label in labels)}])[cast({index} as integer) + 1]"


def share(amount: str, factor: str) -> str:
    return f"cast({amount} * {factor}::decimal(3,2) as decimal(18,2))"


PATIENT = "(o_custkey + case when o_custkey % 50 = 0 then 1 else 0 end)"
LOW = "o_orderpriority = '5-LOW'"
ADMITTED = "(o_orderdate + to_hours(o_orderkey % 24))"
DISCHARGED = (
    f"(case when o_orderkey % 41 = 0 then null when o_orderkey % 509 = 100 then {ADMITTED} - to_hours(2) "
    f"else {ADMITTED} + to_hours(1 + o_orderkey % 96) + to_seconds(o_orderkey % 60) end)"
)
SERVICE_END = f"cast(coalesce({DISCHARGED}, {ADMITTED}) as date)"
LINE_ID = (
    "((l_orderkey * 8 + l_linenumber) * 4194304 + (l_partkey * 1009 + l_suppkey * 31 + l_quantity::bigint) % 4194304)"
)
CHARGE = "l_extendedprice::decimal(18,2)"
DENIED = "(l_orderkey % 17 = 3 or (l_linestatus = 'F' and l_linenumber = 7))"
TOTAL = "o_totalprice::decimal(18,2)"
ALLOCATED = (
    f"(case o_orderkey % 4 when 0 then {share(TOTAL, '0.10')} when 1 then {share(TOTAL, '0.25')} "
    f"when 2 then {share(TOTAL, '0.50')} else {share(TOTAL, '1.10')} end)"
)
P = provider("o_orderkey")
CREDIT = "(l_partkey % 499 = 0 and l_linenumber = 1)"

DOMAIN: dict[str, str] = {
    "hospital_hospital": """
        select n_nationkey as HospitalID, 'HOSP-' || lpad(n_nationkey::varchar, 2, '0') as HospitalCode,
               n_name as HospitalName, 'TX-' || (n_nationkey % 24) as TaxID,
               (['General','Teaching','Community','Specialty','Childrens'])[n_regionkey + 1] as HospitalType,
               case when n_nationkey % 6 = 1 then 'Level I' end as TraumaLevel,
               50 + 25 * n_nationkey as NumberOfBeds, n_nationkey % 3 = 0 as IsTeachingHospital,
               n_nationkey % 4 <> 0 as HasEmergencyDepartment, date '1950-01-01' + n_nationkey * 400 as OpenedDate,
               true as IsActive
        from nation""",
    "hospital_location": """
        select n_nationkey as LocationID, n_nationkey as HospitalID, 'LOC-' || n_nationkey as LocationCode,
               case when n_nationkey = 11 then 'Tent' else 'Hospital Campus' end as LocationType, n_name as City,
               (case when n_nationkey % 5 <> 0 then n_nationkey end)::decimal(9,6) as Latitude,
               (case when n_nationkey % 10 <> 0 then n_nationkey * 2 end)::decimal(9,6) as Longitude,
               true as IsPrimary, true as IsActive
        from nation""",
    "hospital_department": """
        select (n_nationkey * 5 + slot)::integer as DepartmentID,
               case when n_nationkey = 24 and slot = 4 then 99 else n_nationkey end as HospitalID,
               n_nationkey as LocationID, 'D' || slot as DepartmentCode,
               (['Emergency Medicine','Internal Medicine','Surgery','Cardiology','Telemedicine'])[slot + 1] as DepartmentName,
               'Clinical' as DepartmentType, case when slot % 2 = 0 then '08:00:00' end as OpensAt,
               case slot when 0 then '18:00:00' when 2 then '17:00:00' end as ClosesAt, true as IsActive
        from nation, range(5) as slots(slot)""",
    "hospital_specialty": """
        select ascii(p_type) as SpecialtyID, p_type as SpecialtyCode, 'Specialty ' || p_type as SpecialtyName
        from (select distinct p_type from part)""",
    "hospital_provider": f"""
        select s_suppkey as ProviderID, {hospital_of('s_suppkey')} as HospitalID,
               {department_of('s_suppkey')} as DepartmentID, s_name as ProviderCode,
               case when s_suppkey % 43 = 9 then null when s_suppkey % 41 = 7 then 'NPI' || s_suppkey
                    else (1000000000 + s_suppkey)::varchar end as NPINumber,
               'Dr' as FirstName, s_name as LastName, case when s_suppkey % 2 = 0 then 'M' else 'F' end as Gender,
               {pick('s_suppkey % 3', 'Physician', 'Nurse Practitioner', 'Specialist')} as ProviderType,
               case when s_suppkey % 61 = 4 then 'Retired' else 'Full-Time' end as EmploymentStatus,
               (s_suppkey % 90)::integer as YearsExperience,
               date '1980-01-01' + (s_suppkey % 5000)::integer as HireDate,
               case when s_suppkey % 20 = 9 then date '1980-01-01' + (s_suppkey % 5000 + 900)::integer
                    when s_suppkey % 10 = 9 then date '1980-01-01' + (s_suppkey % 5000 - 1)::integer end as TerminationDate,
               s_suppkey % 10 <> 9 as IsActive,
               case when s_suppkey % 67 = 5 then date '1899-12-31' else date '2030-01-01' end as LicenseExpirationDate,
               case when s_suppkey % 31 <> 4 then 'LIC-' || (s_suppkey % 900) end as MedicalLicenseNumber,
               case when s_suppkey % 29 <> 6 then 'NY' end as LicenseState,
               case when s_suppkey % 17 <> 3 then 'DEA-' || (case when s_suppkey % 71 = 9 then s_suppkey - 1 else s_suppkey end) end as DEANumber
        from supplier""",
    "hospital_providerspecialty": """
        select s_suppkey as ProviderSpecialtyID, s_suppkey as ProviderID, (65 + s_suppkey % 20)::integer as SpecialtyID,
               true as IsPrimary, true as IsActive,
               date '2000-01-01' + (s_suppkey % 100)::integer as CertificationDate,
               case when s_suppkey % 53 = 7 then date '1999-01-01' else date '2010-01-01' end as CertificationExpiryDate
        from supplier""",
    "clinical_patient": f"""
        select c_custkey as PatientID,
               case when c_custkey % 333 = 5 then '   ' when c_custkey % 500 = 499 then {code('MRN', 'c_custkey - 1')}
                    else {code('MRN', 'c_custkey')} end as MedicalRecordNumber,
               case when c_custkey % 401 <> 17 then c_mktsegment end as FirstName, c_name as LastName,
               case when c_custkey % 777 = 6 then date '2010-01-01' when c_custkey % 778 = 7 then date '1870-05-05'
                    else date '1920-01-01' + ((c_custkey * 37) % 28000)::integer end as DateOfBirth,
               case when c_custkey % 50 = 49 then null when c_custkey % 2 = 0 then 'M' else 'F' end as Gender,
               {pick('c_custkey % 5', 'Single', 'Married', 'Divorced', 'Widowed', 'Partnered')} as MaritalStatus,
               case when c_custkey % 6 = 0 then 'Spanish' else 'English' end as PreferredLanguage,
               case when c_custkey % 211 = 3 then 'C+'
                    else {pick('c_custkey % 8', 'O+', 'A+', 'B+', 'AB+', 'O-', 'A-', 'B-', 'AB-')} end as BloodType,
               null::date as DeceasedDate, c_custkey % 60 <> 59 as IsActive
        from customer""",
    "clinical_patientaddress": """
        select c_custkey as PatientAddressID, c_custkey as PatientID,
               case when c_custkey % 500 = 20 then 'Cabin' else 'Home' end as AddressType,
               n_name as City, r_name as StateProvince, lpad((c_custkey % 100000)::varchar, 5, '0') as PostalCode,
               true as IsPrimary, c_custkey % 20 <> 3 as IsActive,
               (case when c_custkey % 90 <> 4 then c_custkey % 100 - 5 end)::decimal(9,6) as Latitude,
               (case when c_custkey % 45 <> 4 then c_custkey % 200 end)::decimal(9,6) as Longitude,
               date '1990-01-01' as EffectiveStartDate, case when c_custkey % 150 = 7 then date '1989-01-01' end as EffectiveEndDate
        from customer join nation on c_nationkey = n_nationkey join region on n_regionkey = r_regionkey""",
    "clinical_encounter": f"""
        select o_orderkey as EncounterID, {PATIENT} as PatientID, {hospital_of(P)} as HospitalID,
               {hospital_of(P)} as LocationID,
               case when o_orderkey % 211 = 0 then null when {LOW} then {hospital_of(P)} * 5 + 4
                    else {department_of(P)} end as DepartmentID,
               case when o_orderkey % 97 <> 0 then {P} end as ProviderID,
               {code('ENC', 'o_orderkey')} as EncounterNumber,
               case o_orderpriority when '1-URGENT' then 'Emergency' when '2-HIGH' then 'Inpatient'
                    when '3-MEDIUM' then 'Outpatient' when '4-NOT SPECIFIED' then 'Observation' else 'Telehealth' end as EncounterType,
               case when o_orderkey % 41 = 0 then 'In Progress'
                    when o_orderpriority in ('2-HIGH', '4-NOT SPECIFIED') then 'Discharged' else 'Completed' end as EncounterStatus,
               {ADMITTED} as AdmissionDateTimeUTC, {DISCHARGED} as DischargeDateTimeUTC,
               'Reason ' || (o_orderkey % 8) as ReasonForVisit,
               case when o_orderpriority in ('2-HIGH', '4-NOT SPECIFIED') then 'Home' else 'Routine' end as Disposition,
               {LOW} as IsTelehealth
        from orders""",
    "clinical_diagnosis": f"""
        select {LINE_ID} as DiagnosisID, l_orderkey as EncounterID, {PATIENT} as PatientID,
               'D' || (l_partkey % 12) as DiagnosisCode,
               case when l_linenumber = 1 then 'Primary' when l_partkey % 97 = 0 then 'Rumoured' else 'Secondary' end as DiagnosisType,
               l_shipdate as DiagnosisDateUTC, l_linenumber = 1 as IsPrimary,
               case l_linenumber % 4 when 1 then 'Y' when 2 then 'N' when 3 then (case when l_partkey % 89 = 0 then 'X' else 'U' end) end as PresentOnAdmission
        from lineitem join orders on l_orderkey = o_orderkey where l_returnflag = 'A'""",
    "clinical_procedure": f"""
        select {LINE_ID} as ProcedureID, l_orderkey as EncounterID, {PATIENT} as PatientID,
               'P' || (l_partkey % 50) as ProcedureCode, l_shipdate as ProcedureDateTimeUTC,
               'Completed' as ProcedureStatus, l_quantity::integer - 1 as Quantity,
               {provider('l_orderkey')} + case when l_partkey % 499 = 0 then 1000000000 else 0 end as ProviderID
        from lineitem join orders on l_orderkey = o_orderkey where l_returnflag = 'N'""",
    "clinical_medicationorder": f"""
        select {LINE_ID} as MedicationOrderID, {PATIENT} as PatientID, l_orderkey as EncounterID,
               l_partkey as MedicationID, l_shipdate as OrderDateTimeUTC, l_shipdate::date as StartDate,
               l_shipdate::date + (l_partkey % 40 - 2)::integer as EndDate, l_quantity::decimal(10,3) as Dose,
               l_quantity::decimal(10,2) as Quantity, (l_partkey % 4)::integer as Refills,
               case when l_partkey % 5 = 0 then 'Completed' else 'Active' end as OrderStatus,
               {provider('l_orderkey')} + case when l_partkey % 501 = 0 then 1000000000 else 0 end as ProviderID
        from lineitem join orders on l_orderkey = o_orderkey where l_returnflag = 'R'""",
    "clinical_medication": f"""
        select p_partkey as MedicationID, {code('MED', 'p_partkey')} as MedicationCode, p_name as MedicationName,
               p_type as DrugClass, p_size % 10 = 0 as IsControlledSubstance, true as IsActive
        from part""",
    "clinical_vitals": f"""
        select o_orderkey as VitalID, {PATIENT} as PatientID, o_orderkey as EncounterID, {ADMITTED} as RecordedDateTimeUTC,
               (140 + o_orderkey % 60)::decimal(5,2) as HeightCM, (o_orderkey % 120)::decimal(6,2) as WeightKG,
               (35 + o_orderkey % 7)::decimal(4,1) as TemperatureCelsius, (50 + o_orderkey % 253)::integer as HeartRateBPM,
               (90 + o_orderkey % 80)::integer as SystolicBloodPressure,
               (50 + o_orderkey % 70)::integer as DiastolicBloodPressure,
               (80 + o_orderkey % 22)::decimal(5,2) as OxygenSaturationPercent, (o_orderkey % 11)::integer as PainScore,
               (10 + o_orderkey % 95)::integer as RespiratoryRate, (8 + o_orderkey % 300)::integer as BloodGlucoseMgDL,
               case when o_orderkey % 61 = 0 then -1 else {P} end as RecordedByProviderID
        from orders""",
    "telehealth_virtualvisit": f"""
        with v as (
            select *, {ADMITTED} as sched, o_orderkey % 11 = 0 as absent,
                   {ADMITTED} + to_minutes(o_orderkey % 7) + to_seconds(59) as begun
            from orders where {LOW})
        select o_orderkey as VirtualVisitID, o_orderkey as EncounterID, {PATIENT} as PatientID, {P} as ProviderID,
               {hospital_of(P)} as HospitalID, {hospital_of(P)} * 5 + 4 as DepartmentID,
               {code('VV', 'o_orderkey')} as VisitNumber, sched as ScheduledStartDateTimeUTC,
               sched + to_minutes(30) as ScheduledEndDateTimeUTC,
               case when not absent then begun end as ActualStartDateTimeUTC,
               case when not absent then begun + to_minutes(10 + o_orderkey % 40) + to_seconds(o_orderkey % 60) end as ActualEndDateTimeUTC,
               case when absent then 'No Show' when o_orderkey % 17 = 0 then 'Disconnected' else 'Completed' end as VisitStatus,
               {pick('o_orderkey % 3', 'Video', 'Audio', 'Chat')} as VisitType,
               case when o_orderkey % 53 = 0 then null when o_orderkey % 59 = 0 then ''
                    else {pick('o_orderkey % 3', 'CareLink', 'VideoMed', 'TeleOne')} end as PlatformName,
               {pick('o_orderkey % 4', 'Desktop', 'Mobile', 'Tablet', 'Laptop')} as PatientDeviceType,
               case when o_orderkey % 2 = 0 then 'Wi-Fi' else 'Cellular' end as PatientConnectionMethod,
               case when not absent then sched - to_minutes(3) end as PatientJoinedDateTimeUTC,
               case when not absent then sched + to_minutes(o_orderkey % 7) end as ProviderJoinedDateTimeUTC,
               o_orderkey % 12 = 0 as IsInterpreterRequired,
               case when o_orderkey % 24 = 12 then 'Spanish' end as InterpreterLanguage
        from v""",
    "telehealth_sessionevent": f"""
        with first as (
            select {PATIENT} as pid, arg_min(o_orderkey, ({ADMITTED}, o_orderkey)) as visit
            from orders where {LOW} group by all)
        select event_id as SessionEventID, visit as VirtualVisitID, event_id as EventSequenceNumber,
               case event_type when 'view' then 'Session Started' when 'signup' then 'Session Created'
                    when 'click' then 'Patient Joined' when 'purchase' then 'Session Ended' else 'Technical Error' end as EventType,
               ts as EventDateTimeUTC,
               case when event_type = 'error' and event_id % 31 <> 0 then 'ERR-' || (event_id % 5) end as TechnicalErrorCode,
               null::varchar as TechnicalErrorMessage,
               case when event_id % 500 = 3 then 'Robot' else 'Patient' end as ParticipantType
        from events join first on user_id = pid""",
    "telehealth_device": f"""
        select c_custkey as DeviceID, c_custkey as PatientID, {code('DEV', 'c_custkey')} as DeviceIdentifier,
               case when c_custkey % 90 = 0 then 'Abacus' else 'Glucose Meter' end as DeviceType,
               'SN-' || (c_custkey % 1400) as SerialNumber, 'Active' as DeviceStatus, true as IsActive,
               date '1997-01-01' as AssignedDate, case when c_custkey % 70 = 0 then date '1996-01-01' else date '1997-02-01' end as ActivatedDate,
               case when c_custkey % 110 = 0 then date '1996-06-01' end as DeactivatedDate
        from customer where c_custkey % 10 = 0""",
    "telehealth_devicereading": """
        select event_id as DeviceReadingID, user_id - user_id % 10 as DeviceID, user_id - user_id % 10 as PatientID,
               ts as ReadingDateTimeUTC, 'Blood Glucose' as ReadingType,
               (case when event_id % 77 <> 0 then value end)::decimal(12,3) as NumericValue,
               null::decimal(12,3) as SecondaryNumericValue, null::varchar as TextValue, value > 90 as IsAbnormal,
               ts - to_minutes(event_id % 7) as ReceivedDateTimeUTC,
               case when event_id % 333 = 4 then 'mmHg' end as SecondaryUnitOfMeasure,
               case when event_id % 444 = 5 then 'Telepathy' else 'API' end as DataSource, case when event_id % 100 = 1 then event_id end as EncounterID
        from events""",
    "telehealth_waitlistqueue": f"""
        select o_orderkey as WaitlistQueueID, o_orderkey as VirtualVisitID, {PATIENT} as PatientID, {P} as ProviderID,
               {ADMITTED} - to_minutes(5) as QueueEnteredDateTimeUTC,
               {ADMITTED} - to_minutes(o_orderkey % 8) as QueueCalledDateTimeUTC,
               case when o_orderkey % 11 = 0 then 'No Show' else 'Completed' end as QueueStatus,
               case when o_orderkey % 100 = 1 then 'Asap' else 'Normal' end as PriorityLevel,
               case when o_orderkey % 9 <> 0 then {ADMITTED} - to_minutes(o_orderkey % 7) end as QueueExitedDateTimeUTC,
               {hospital_of(P)} * 5 + case when o_orderkey % 211 = 9 then 5 else 4 end as DepartmentID
        from orders where {LOW}""",
    "insurance_payer": """
        select r_regionkey as PayerID, 'PAY-' || r_regionkey as PayerCode,
               case when r_regionkey = 3 then '  ' else r_name end as PayerName,
               (['Commercial','Medicare','Medicaid','Employer','Government'])[r_regionkey + 1] as PayerType,
               case when r_regionkey <> 4 then 'EIN-' || (r_regionkey % 3) end as TaxIdentifier, true as IsActive
        from region""",
    "insurance_insuranceplan": """
        select n_nationkey as InsurancePlanID, case when n_nationkey = 17 then 77 else n_regionkey end as PayerID,
               'PLAN-' || n_nationkey as PlanCode, 'Plan ' || n_name as PlanName,
               (['Medical','Dental','Vision','Pharmacy'])[n_nationkey % 4 + 1] as PlanType,
               (['HMO','PPO','EPO','POS'])[n_nationkey % 4 + 1] as NetworkType,
               date '1990-01-01' as EffectiveStartDate, date '1989-12-20' + n_nationkey as EffectiveEndDate,
               true as IsActive
        from nation""",
    "insurance_patientcoverage": """
        select c_custkey * 2 + slot as PatientCoverageID, c_custkey as PatientID,
               ((c_nationkey + slot * 3) % 25)::integer as InsurancePlanID,
               'M' || (c_custkey // (1 + slot)) as MemberNumber, null::bigint as SubscriberPatientID,
               case when c_custkey % 300 = 2 then 'Child' else 'Self' end as RelationshipToSubscriber,
               case when slot = 0 then 'Primary' else 'Secondary' end as CoveragePriority,
               date '1995-01-01' as EffectiveStartDate, 'Active' as CoverageStatus, c_custkey % 25 <> 7 as IsActive,
               case when c_custkey % 140 = 9 then date '1994-01-01' end as EffectiveEndDate
        from customer join range(2) as slots(slot) on slot = 0 or c_custkey % 4 = 1""",
    "insurance_claim": f"""
        select o_orderkey as ClaimID, {code('CLM', 'o_orderkey')} as ClaimNumber, {PATIENT} as PatientID,
               {PATIENT} * 2 as PatientCoverageID, o_orderkey as EncounterID, {P} as ProviderID,
               {hospital_of(P)} as HospitalID,
               {pick('o_orderkey % 4', 'Professional', 'Institutional', 'Pharmacy', 'Other')} as ClaimType,
               {ADMITTED}::date as ServiceStartDate, {SERVICE_END} as ServiceEndDate,
               case when o_orderkey % 71 <> 0 then ({SERVICE_END} + 2)::timestamp end as SubmissionDateTimeUTC,
               ({SERVICE_END} + (12 + o_orderkey % 7)::integer)::timestamp as AdjudicationDateTimeUTC,
               case when o_orderkey % 17 = 3 then 'Denied' when o_orderstatus = 'F' then 'Approved'
                    when o_orderstatus = 'O' then 'Partially Approved' else 'Submitted' end as ClaimStatus,
               case when o_orderkey % 800 = 7 then o_orderkey end as OriginalClaimID
        from orders where {claimed('o_orderkey')}""",
    "insurance_claimline": f"""
        select {LINE_ID} as ClaimLineID, l_orderkey as ClaimID, l_linenumber as LineNumber,
               'P' || (l_partkey % 50) as ProcedureCode, l_shipdate::date as ServiceDate,
               l_quantity::decimal(12,3) as Units, {CHARGE} as ChargeAmount,
               {share(CHARGE, '0.90')} as AllowedAmount,
               case when {DENIED} then 0::decimal(18,2) when l_partkey % 211 = 0 then {share(CHARGE, '1.10')}
                    else {share(CHARGE, '0.70')} end as PaidAmount,
               {share(CHARGE, '0.20')} as PatientResponsibilityAmount, {share(CHARGE, '0.10')} as AdjustmentAmount,
               case when {DENIED} then 'Denied' else 'Paid' end as LineStatus,
               case when {DENIED} and l_partkey % 13 <> 0
                    then {pick('l_linenumber % 3', 'CO-16', 'CO-45', 'PR-204')} end as DenialReasonCode
        from lineitem where {claimed('l_orderkey')}""",
    "billing_patientaccount": f"""
        select c_custkey as PatientAccountID, {code('ACC', 'c_custkey')} as AccountNumber, c_custkey as PatientID,
               case when c_custkey % 70 = 1 then 'Closed' else 'Active' end as AccountStatus,
               case when c_custkey % 2 = 0 then 'Paper' else 'Electronic' end as BillingPreference,
               c_custkey % 8 = 0 as IsFinancialAssistanceEligible, true as IsActive,
               case when c_custkey % 130 = 11 then 'Fax' else 'Email' end as PreferredCommunicationMethod
        from customer""",
    "billing_invoice": f"""
        select o_orderkey as InvoiceID, {code('INV', 'o_orderkey')} as InvoiceNumber, {PATIENT} as PatientAccountID,
               {PATIENT} as PatientID, o_orderkey as EncounterID, o_orderkey as ClaimID,
               {SERVICE_END} + 1 as InvoiceDate,
               case when o_orderkey % 29 <> 0 then {SERVICE_END} + 31 end as DueDate,
               case when o_orderkey % 58 = 0 then 'Overdue' else 'Issued' end as InvoiceStatus,
               'Initial' as StatementCycle, null::bigint as OriginalInvoiceID
        from orders where {invoiced('o_orderkey')}""",
    "billing_invoiceline": f"""
        select {LINE_ID} as InvoiceLineID, l_orderkey as InvoiceID, l_linenumber as LineNumber, {LINE_ID} as ClaimLineID,
               case when {CREDIT} then 'Credit' else 'Charge' end as LineType,
               (case when l_partkey % 600 = 0 then 0 else 1 end)::decimal(12,3) as Quantity,
               case when {CREDIT} then -{CHARGE} else {CHARGE} end as UnitAmount,
               case when {CREDIT} then -{CHARGE} else {CHARGE} end as LineAmount,
               l_orderkey + case when l_partkey % 997 = 1 then 1 else 0 end as EncounterID
        from lineitem where {invoiced('l_orderkey')}""",
    "billing_payment": f"""
        select o_orderkey as PaymentID, {code('PMT', 'o_orderkey')} as PaymentNumber, {PATIENT} as PatientAccountID,
               {PATIENT} as PatientID, null::integer as PayerID, ({SERVICE_END} + 11)::timestamp as PaymentDateTimeUTC,
               {ALLOCATED} as PaymentAmount,
               case when o_orderkey % 90 = 1 then 'Insurance' else 'Patient' end as PaymentSource,
               {pick('o_orderkey % 4', 'Credit Card', 'Debit Card', 'ACH', 'Check')} as PaymentMethod,
               'Posted' as PaymentStatus,
               case when o_orderkey % 19 <> 0
                    then 'TXN-' || (case when o_orderkey % 701 = 1 then o_orderkey - 1 else o_orderkey end) end as TransactionReference,
               case when o_orderkey % 8 = 7 then 'CHK' || o_orderkey end as CheckNumber
        from orders where {invoiced('o_orderkey')} and o_orderkey % 5 <> 4""",
    "billing_paymentallocation": f"""
        select o_orderkey * 10 + part as PaymentAllocationID, o_orderkey as PaymentID, o_orderkey as InvoiceID,
               part::integer as AllocationSequenceNumber, {ALLOCATED} as AllocatedAmount,
               case when o_orderkey % 11 = 0 then 'Reversed' else 'Posted' end as AllocationStatus,
               case when o_orderkey % 22 = 0 then ' ' when o_orderkey % 11 = 0 then 'Duplicate' end as ReversalReason
        from orders join range(1, 3) as parts(part) on part = 1 or o_orderkey % 6 = 1
        where {invoiced('o_orderkey')} and o_orderkey % 5 <> 4""",
    "marketing_campaign": """
        select r_regionkey as CampaignID, 'CMP-' || r_regionkey as CampaignCode, 'Campaign ' || r_name as CampaignName,
               (['Awareness','Acquisition','Retention','Education','Referral'])[r_regionkey + 1] as CampaignType,
               'Lead Generation' as CampaignObjective, date '1996-01-01' + r_regionkey * 100 as StartDate,
               date '1996-01-01' + r_regionkey * 100 + case when r_regionkey = 2 then -10 else 365 end as EndDate,
               (10000 + 5000 * r_regionkey)::decimal(18,2) as BudgetAmount, 'Active' as CampaignStatus,
               case when r_regionkey <> 4 then r_regionkey end as HospitalID,
               r_regionkey::bigint as OwnerProviderID
        from region""",
    "marketing_campaignchannel": """
        select (r_regionkey * 2 + slot)::integer as CampaignChannelID, r_regionkey as CampaignID,
               case when slot = 0 then 'Email' else 'SMS' end as ChannelType, 'Channel ' || slot as ChannelName,
               5000::decimal(18,2) as PlannedSpendAmount, (4500 + 100 * slot)::decimal(18,2) as ActualSpendAmount,
               'TRK-' || (r_regionkey * slot) as TrackingCode
        from region, range(2) as slots(slot) where r_regionkey <> 3""",
    "marketing_campaigninteraction": """
        select event_id as CampaignInteractionID, (user_id % 5)::integer as CampaignID,
               ((user_id % 5) * 2 + event_id % 2)::integer as CampaignChannelID, user_id as PatientID,
               case event_type when 'view' then 'Delivered' when 'signup' then 'Opened' when 'click' then 'Clicked'
                    when 'purchase' then 'Converted' else 'Bounced' end as InteractionType,
               ts as InteractionDateTimeUTC,
               case when event_id % 900 = 8 then 'Maybe' else 'Success' end as InteractionStatus,
               case when event_id % 50 <> 0
                    then 'MSG-' || (case when event_id % 601 = 1 then event_id - 1 else event_id end) end as ExternalMessageID,
               'CRM' as SourceSystem,
               case when event_id % 200 = 2 then event_id end as EncounterID
        from events""",
    "marketing_patientacquisition": """
        select user_id as PatientAcquisitionID, user_id as PatientID, (user_id % 7)::integer as ReferralSourceID,
               (case when user_id % 10 <> 0 then user_id % 5 end)::integer as CampaignID,
               event_id as CampaignInteractionID, ts::date as AcquisitionDate, 'Email' as AcquisitionChannel,
               'First Touch' as AttributionModel, 'Converted' as AcquisitionStatus,
               (25 + user_id % 75)::decimal(18,2) as AcquisitionCost, 'LEAD-' || user_id as ExternalLeadID,
               case when user_id % 25 = 0 then user_id end as FirstEncounterID
        from events where event_type = 'purchase'
        qualify row_number() over (partition by user_id order by ts, event_id) = 1""",
    "marketing_patientcommunicationpreference": """
        select c_custkey as PatientCommunicationPreferenceID, c_custkey as PatientID, 'Email' as ChannelType,
               (['Opted In','Opted Out','Pending','Revoked'])[(c_custkey % 4)::integer + 1] as ConsentStatus,
               case when c_custkey % 40 <> 0 then timestamp '1998-01-01' end as ConsentDateTimeUTC,
               case when c_custkey % 4 = 3 then timestamp '1998-06-01' end as RevokedDateTimeUTC,
               c_custkey % 4 in (0, 2) or c_custkey % 44 = 1 as IsActive,
               case when c_custkey % 160 = 3 then 'Pigeon' else 'Web Portal' end as ConsentSource,
               case when c_custkey % 170 = 4 then 'Midnight' end as PreferredContactTime
        from customer""",
    "marketing_referralsource": """
        select r_regionkey as ReferralSourceID, 'REF-' || r_regionkey as ReferralSourceCode,
               'Referral ' || r_name as ReferralSourceName,
               (['Provider','Hospital','Employer','Digital','Community'])[r_regionkey + 1] as ReferralSourceType,
               r_regionkey as ReferringHospitalID,
               (case when r_regionkey = 2 then 7 else r_regionkey end)::bigint as ReferringProviderID
        from region""",
    "marketing_audiencesegment": """
        select ascii(c_mktsegment) as AudienceSegmentID, c_mktsegment as SegmentCode,
               'Segment ' || c_mktsegment as SegmentName, 'Demographic' as SegmentType,
               case when c_mktsegment = 'FURNITURE' then '{x' else '{"segment":"' || c_mktsegment || '"}' end as DefinitionJSON,
               count(*)::integer as EstimatedMemberCount,
               case when c_mktsegment = 'MACHINERY' then 'Hourly' else 'Daily' end as RefreshFrequency
        from customer group by c_mktsegment""",
    "ai_model": """
        select r_regionkey as ModelID, 'MODEL-' || r_regionkey as ModelCode,
               case when r_regionkey = 2 then '' else 'Model ' || r_name end as ModelName,
               'Machine Learning' as ModelType, 'Binary Classification' as ProblemType, 'Production' as ModelStatus,
               case when r_regionkey = 1 then 'Extreme' else 'High' end as RiskLevel,
               r_regionkey::bigint as OwnerProviderID, case when r_regionkey <> 3 then r_regionkey end as OwningHospitalID
        from region""",
    "ai_modelversion": """
        select r_regionkey as ModelVersionID, case when r_regionkey = 4 then 9 else r_regionkey end as ModelID,
               '1.' || r_regionkey as VersionNumber,
               case when r_regionkey % 2 = 0 then 'Gradient Boosting' else 'Random Forest' end as AlgorithmName,
               date '1994-01-01' as TrainingDataStartDate, date '1994-12-31' - r_regionkey * 100 as TrainingDataEndDate,
               'Approved' as ApprovalStatus, '{"trees":100}' as HyperparametersJSON, null::varchar as ModelHash,
               timestamp '1995-01-01' as EffectiveStartDateTimeUTC, case when r_regionkey = 1 then timestamp '1994-06-01' end as EffectiveEndDateTimeUTC,
               case when r_regionkey = 2 then -5 else 1000 end as TrainingRecordCount, r_regionkey - 1 as FeatureCount,
               (case when r_regionkey <> 3 then r_regionkey end)::bigint as ApprovedByProviderID,
               case when r_regionkey <> 4 then timestamp '1995-01-01' end as ApprovedDateTimeUTC
        from region""",
    "ai_featuredefinition": """
        select substr(p_brand, 7)::integer as FeatureDefinitionID, p_brand as FeatureCode,
               'Feature ' || p_brand as FeatureName, 'Decimal' as DataType, 'Clinical' as SourceSchema,
               'Encounter' as SourceTable,
               case when p_brand = 'Brand#13' then 'Astral' else 'Clinical' end as FeatureCategory
        from (select distinct p_brand from part)""",
    "ai_modelfeature": """
        select n_nationkey as ModelFeatureID, n_nationkey % 6 as ModelVersionID, n_nationkey + 3 as FeatureDefinitionID,
               'Input' as FeatureRole, n_nationkey as FeatureOrder
        from nation""",
    "ai_prediction": f"""
        select o_orderkey as PredictionID, (o_orderkey % 5)::integer as ModelVersionID, {PATIENT} as PatientID,
               o_orderkey as EncounterID, coalesce({DISCHARGED}, {ADMITTED}) + to_hours(1) as PredictionDateTimeUTC,
               'Classification' as PredictionType,
               case when o_orderkey % 173 = 0 then null when o_orderkey % 179 = 0 then ' '
                    when o_orderkey % 100 >= 50 then 'High Risk' else 'Low Risk' end as PredictedClass,
               null::decimal(19,6) as PredictedValue,
               case when o_orderkey % 83 = 0 then null when o_orderkey % 307 = 5 then 1.25::decimal(9,8)
                    else ((o_orderkey % 100)::decimal(4,0) * 0.01)::decimal(9,8) end as ProbabilityScore,
               case when o_orderkey % 311 = 6 then 150::decimal(9,6)
                    else ((o_orderkey % 100)::decimal(4,0) * 0.1)::decimal(9,6) end as RiskScore,
               0.5::decimal(9,8) as ThresholdUsed,
               case when o_orderkey % 401 = 0 then 'Lost' else 'Generated' end as PredictionStatus,
               case when o_orderkey % 7 = 0 then null when o_orderkey % 101 = 1 then '{{x' when o_orderkey % 103 = 2 then '1'
                    when o_orderkey % 11 = 0 then '[1]' else '{{"k":' || o_orderkey || '}}' end as InputSnapshotJSON,
               case when o_orderkey % 2 = 0 then '{{"k":' || o_orderkey || '}}' end as ExplanationJSON,
               (case when o_orderkey % 997 = 1 then o_orderkey - 1 else o_orderkey end)::varchar as CorrelationID
        from orders""",
    "ai_predictionoutcome": f"""
        select o_orderkey as PredictionOutcomeID, o_orderkey as PredictionID, 'Confirmed' as OutcomeType,
               case when o_orderkey % 143 = 0 then null
                    when (o_orderkey % 100 >= case when o_orderkey % 5 = 1 then 70 else 50 end) <> (o_orderkey % 3 = 0)
                    then 'High Risk' else 'Low Risk' end as ActualClass,
               null::decimal(19,6) as ActualValue, {ADMITTED} + to_days(30) as OutcomeDateTimeUTC,
               case when o_orderkey % 409 = 0 then 'Guess' else 'EHR' end as OutcomeSource,
               o_orderkey % 9 <> 0 as IsFinalOutcome,
               case when o_orderkey % 10 <> 0 then {P} end as VerifiedByProviderID, case when o_orderkey % 11 <> 0 then {ADMITTED} end as VerifiedDateTimeUTC
        from orders where o_orderkey % 7 <> 0""",
    "insurance_priorauthorization": f"""
        select o_orderkey as PriorAuthorizationID, {PATIENT} as PatientID, (o_orderkey % 26)::integer as InsurancePlanID,
               o_orderkey + case when o_orderkey % 77 = 1 then 1 else 0 end as EncounterID, {P} as ProviderID,
               case when o_orderkey % 13 <> 0 then 'AUTH-' || (case when o_orderkey % 91 = 1 then 1 else o_orderkey end) end as AuthorizationNumber,
               case when o_orderkey % 83 = 1 then 'Lost' when o_orderkey % 5 = 1 then 'Denied' else 'Approved' end as AuthorizationStatus,
               {ADMITTED} as RequestedDateTimeUTC, {ADMITTED} + to_hours(o_orderkey % 50 - 1) as DecisionDateTimeUTC,
               {ADMITTED}::date as ApprovedStartDate, {ADMITTED}::date + (o_orderkey % 30 - 1)::integer as ApprovedEndDate,
               (o_orderkey % 40)::decimal(12,3) as AuthorizedUnits,
               case when o_orderkey % 15 = 1 then ' ' when o_orderkey % 5 = 1 then 'Not covered' end as DenialReason
        from orders where o_orderkey % 6 = 1""",
    "insurance_claimstatushistory": f"""
        select o_orderkey * 10 + part as ClaimStatusHistoryID,
               o_orderkey + case when o_orderkey % 301 = 1 then 1 else 0 end as ClaimID,
               case when o_orderkey % 403 = 7 then 1 when o_orderkey % 401 = 5 then part - 1 else part end as StatusSequenceNumber,
               case when part = 1 then 'Submitted' when o_orderkey % 307 = 2 then 'Unknown' else 'Paid' end as ClaimStatus
        from orders, range(1, 3) as parts(part) where {claimed('o_orderkey')}""",
    "billing_adjustment": f"""
        select o_orderkey as AdjustmentID,
               case when o_orderkey % 211 = 1 then 'ADJ-1' else {code('ADJ', 'o_orderkey')} end as AdjustmentNumber,
               o_orderkey as InvoiceID, case when o_orderkey % 50 = 1 then o_orderkey end as InvoiceLineID, o_orderkey as ClaimID,
               case when o_orderkey % 10 <> 1 then {P} end as ApprovedByProviderID,
               (o_orderkey % 40)::decimal(18,2) as AdjustmentAmount,
               case when o_orderkey % 93 = 4 then 'Mystery' else 'Courtesy' end as AdjustmentType,
               case when o_orderkey % 95 = 4 then 'Gone' else 'Posted' end as AdjustmentStatus,
               case when o_orderkey % 43 = 1 then ' ' else 'AR-1' end as AdjustmentReasonCode
        from orders where {invoiced('o_orderkey')}""",
    "billing_refund": f"""
        select o_orderkey as RefundID, case when o_orderkey % 113 = 1 then 'REF-1' else {code('REF', 'o_orderkey')} end as RefundNumber,
               o_orderkey as PaymentID, {PATIENT} + case when o_orderkey % 119 = 1 then 1 else 0 end as PatientAccountID,
               {PATIENT} as PatientID, {P} as ApprovedByProviderID, (o_orderkey % 30)::decimal(18,2) as RefundAmount,
               case when o_orderkey % 71 = 1 then 'Barter' else 'Check' end as RefundMethod,
               case when o_orderkey % 73 = 1 then 'Lost' else 'Issued' end as RefundStatus,
               case when o_orderkey % 41 = 1 then '  ' else 'Overpaid' end as Reason,
               case when o_orderkey % 3 <> 1 then 'RTX-' || (case when o_orderkey % 89 = 1 then 1 else o_orderkey end) end as TransactionReference
        from orders where {invoiced('o_orderkey')} and o_orderkey % 5 <> 4 and o_orderkey % 7 = 1""",
    "billing_accountbalancehistory": """
        select c_custkey * 2 + part as AccountBalanceHistoryID, c_custkey as PatientAccountID,
               c_custkey + case when c_custkey % 131 = 1 then 1 else 0 end as PatientID,
               date '1998-01-01' + (case when c_custkey % 137 = 3 then 1 else part end)::integer as SnapshotDate,
               c_acctbal::decimal(18,2) as CurrentBalance, 0::decimal(18,2) as Balance0To30Days,
               0::decimal(18,2) as Balance31To60Days, 0::decimal(18,2) as Balance61To90Days, 0::decimal(18,2) as Balance91To120Days,
               (c_custkey % 100 - 1)::decimal(18,2) as BalanceOver120Days, 0::decimal(18,2) as InsurancePendingAmount,
               0::decimal(18,2) as PatientResponsibilityAmount, 0::decimal(18,2) as CollectionsAmount
        from customer, range(1, 3) as parts(part)""",
    "marketing_campaignaudience": """
        select r_regionkey * 2 + slot as CampaignAudienceID,
               case when r_regionkey = 4 and slot = 1 then 50 else r_regionkey end as CampaignID,
               65 + r_regionkey as AudienceSegmentID, case when r_regionkey = 2 then 'Guest' else 'Target' end as AudienceRole,
               slot as PriorityRank, r_regionkey - 1 as ExpectedReach
        from region, range(2) as slots(slot)""",
    "ai_modelperformancemetric": """
        select n_nationkey as ModelPerformanceMetricID, n_nationkey % 6 as ModelVersionID,
               case n_nationkey % 8 when 3 then 'Vibes' when 4 then 'Other' else 'AUROC' end as MetricName,
               case when n_nationkey % 16 = 12 then 'Lift' end as MetricDescription,
               case when n_nationkey = 9 then 'Dream' else 'Test' end as EvaluationDataset,
               date '1995-01-01' as EvaluationStartDate, date '1994-12-30' + n_nationkey % 12 as EvaluationEndDate,
               (n_nationkey * 0.05)::decimal(9,8) as ThresholdValue, n_nationkey - 1 as SampleSize,
               case when n_nationkey % 2 = 1 then 'All' end as PatientPopulationSegment
        from nation""",
    "ai_modelmonitoringevent": """
        select n_nationkey as ModelMonitoringEventID, n_nationkey % 5 as ModelVersionID,
               case when n_nationkey = 3 then 'Boredom' else 'Data Drift' end as EventType,
               case when n_nationkey = 5 then 'Meh' else 'High' end as Severity,
               case when n_nationkey % 3 = 0 then 'Resolved' when n_nationkey = 7 then 'Limbo' else 'Open' end as ResolutionStatus,
               (case when n_nationkey % 6 = 0 then n_nationkey end)::bigint as ResolvedByProviderID,
               case when n_nationkey % 3 = 0 then timestamp '1996-01-01' end as ResolvedDateTimeUTC,
               n_nationkey::decimal(19,6) as ExpectedMinimum, 20::decimal(19,6) as ExpectedMaximum
        from nation""",
}
