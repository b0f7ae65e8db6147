"""Hospital tables derived from order, customer and event tables.

The rules use key arithmetic only, so almost every table is a plain projection
of one source table: the scan keeps its filters and column pruning and no
shuffle is spent on building test data. Rows that break a rule are planted on
fixed remainders, so that no check is trivially empty.
"""

from __future__ import annotations

from functools import lru_cache

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from caremesa.sources.tables import Reader, Tables

AS_OF = "1999-06-30"

# Labels picked by remainder.
HOSPITAL_TYPES = ("General", "Teaching", "Community", "Specialty", "Childrens")
DEPARTMENT_NAMES = ("Emergency Medicine", "Internal Medicine", "Surgery", "Cardiology", "Telemedicine")
PROVIDER_TYPES = ("Physician", "Nurse Practitioner", "Specialist")
MARITAL = ("Single", "Married", "Divorced", "Widowed", "Partnered")
BLOOD_TYPES = ("O+", "A+", "B+", "AB+", "O-", "A-", "B-", "AB-")
CLAIM_TYPES = ("Professional", "Institutional", "Pharmacy", "Other")
DENIAL_CODES = ("CO-16", "CO-45", "PR-204")
PLATFORMS = ("CareLink", "VideoMed", "TeleOne")
DEVICES = ("Desktop", "Mobile", "Tablet", "Laptop")
VISIT_TYPES = ("Video", "Audio", "Chat")
PLAN_TYPES = ("Medical", "Dental", "Vision", "Pharmacy")
NETWORKS = ("HMO", "PPO", "EPO", "POS")
PAYER_TYPES = ("Commercial", "Medicare", "Medicaid", "Employer", "Government")
CAMPAIGN_TYPES = ("Awareness", "Acquisition", "Retention", "Education", "Referral")
PAYMENT_METHODS = ("Credit Card", "Debit Card", "ACH", "Check")
CONSENT = ("Opted In", "Opted Out", "Pending", "Revoked")
REFERRAL_TYPES = ("Provider", "Hospital", "Employer", "Digital", "Community")


def _pick(index: str, labels: tuple[str, ...]) -> str:
    cases = " ".join(f"when {i} then '{label}'" for i, label in enumerate(labels))
    return f"case cast({index} as int) {cases} end"


class _Rules:
    """SQL fragments over the order key ``k`` and provider number ``p``."""

    def __init__(self, providers: int):
        self.n = providers

    def provider(self, k: str) -> str:
        return f"(({k} * 7 + {k} div 13) % {self.n})"

    @staticmethod
    def hospital_of(p: str) -> str:
        return f"cast(if({p} % 97 = 53, 99, {p} % 25) as int)"

    @staticmethod
    def department_of(p: str) -> str:
        slot = f"({p} div 25) % 5"
        return f"cast(if({p} % 37 = 11, ({p} + 1) % 25, {p} % 25) * 5 + {slot} as int)"

    def claimed(self, k: str) -> str:
        return f"{k} % 3 <> 0 and {k} % 97 <> 0 and {self.provider(k)} % 10 <> 4"

    def invoiced(self, k: str) -> str:
        return f"{self.claimed(k)} and {k} % 5 <> 0"


PATIENT = "o_custkey + if(o_custkey % 50 = 0, 1, 0)"
TELEHEALTH = "o_orderpriority = '5-LOW'"
ADMITTED = "o_orderdate + make_dt_interval(0, cast(o_orderkey % 24 as int))"
DISCHARGED = (
    "case when o_orderkey % 41 = 0 then null "
    f"when o_orderkey % 509 = 100 then {ADMITTED} - make_dt_interval(0, 2) "
    f"else {ADMITTED} + make_dt_interval(0, cast(1 + o_orderkey % 96 as int), 0, cast(o_orderkey % 60 as int)) end"
)
SERVICE_END = f"cast(coalesce({DISCHARGED}, {ADMITTED}) as date)"
ENCOUNTER_TYPE = (
    "case o_orderpriority when '1-URGENT' then 'Emergency' when '2-HIGH' then 'Inpatient' "
    "when '3-MEDIUM' then 'Outpatient' when '4-NOT SPECIFIED' then 'Observation' else 'Telehealth' end"
)
LINE_ID = (
    "(l_orderkey * 8 + l_linenumber) * 4194304 "
    "+ (l_partkey * 1009 + l_suppkey * 31 + cast(l_quantity as bigint)) % 4194304"
)
CHARGE = "cast(l_extendedprice as decimal(18,2))"
LINE_DENIED = "(l_orderkey % 17 = 3 or (l_linestatus = 'F' and l_linenumber = 7))"


def _project(frame: DataFrame, wanted: tuple[str, ...], *expressions: str) -> DataFrame:
    """The wanted output columns ("<expression> as <name>"), or all of them."""
    by_name = {text.rpartition(" as ")[2]: text for text in expressions}
    return frame.selectExpr(*(by_name[name] for name in wanted or by_name))


def _code(prefix: str, key: str) -> str:
    return f"concat('{prefix}-', lpad(cast({key} as string), 12, '0'))"


def _share(amount: str, factor: str) -> str:
    return f"cast({amount} * cast({factor} as decimal(3,2)) as decimal(18,2))"


class DerivedTables:
    def __init__(self, spark: SparkSession, folder: str):
        self.spark = spark
        self.folder = folder.rstrip("/")
        self._opened: dict[str, DataFrame] = {}
        # Row count from the parquet footers; it only fixes the provider assignment.
        self.rules = _Rules(self.raw("supplier").count())

    def raw(self, name: str) -> DataFrame:
        if name not in self._opened:
            self._opened[name] = self.spark.read.parquet(f"{self.folder}/{name}.parquet")
        return self._opened[name]

    def tables(self) -> Tables:
        prefix = "build_"
        readers: dict[str, Reader] = {
            method[len(prefix):]: getattr(self, method) for method in dir(self) if method.startswith(prefix)
        }
        return Tables(self.spark, readers)

    # -- hospital -------------------------------------------------------------

    def build_hospital_hospital(self, columns) -> DataFrame:
        return _project(
            self.raw("nation"), columns,
            "n_nationkey as HospitalID",
            "concat('HOSP-', lpad(cast(n_nationkey as string), 2, '0')) as HospitalCode",
            "n_name as HospitalName",
            "concat('TX-', cast(n_nationkey % 24 as string)) as TaxID",
            f"{_pick('n_regionkey', HOSPITAL_TYPES)} as HospitalType",
            "if(n_nationkey % 6 = 1, 'Level I', cast(null as string)) as TraumaLevel",
            "50 + 25 * n_nationkey as NumberOfBeds",
            "n_nationkey % 3 = 0 as IsTeachingHospital",
            "n_nationkey % 4 <> 0 as HasEmergencyDepartment",
            "date_add(date'1950-01-01', n_nationkey * 400) as OpenedDate",
            "true as IsActive",
        )

    def build_hospital_location(self, columns) -> DataFrame:
        return _project(
            self.raw("nation"), columns,
            "n_nationkey as LocationID",
            "n_nationkey as HospitalID",
            "concat('LOC-', cast(n_nationkey as string)) as LocationCode",
            "if(n_nationkey = 11, 'Tent', 'Hospital Campus') as LocationType",
            "n_name as City",
            "cast(if(n_nationkey % 5 = 0, null, n_nationkey) as decimal(9,6)) as Latitude",
            "cast(if(n_nationkey % 10 = 0, null, n_nationkey * 2) as decimal(9,6)) as Longitude",
            "true as IsPrimary",
            "true as IsActive",
        )

    def build_hospital_department(self, columns) -> DataFrame:
        slots = self.raw("nation").select("n_nationkey", F.explode(F.array(*map(F.lit, range(5)))).alias("slot"))
        return _project(
            slots, columns,
            "n_nationkey * 5 + slot as DepartmentID",
            "if(n_nationkey = 24 and slot = 4, 99, n_nationkey) as HospitalID",
            "n_nationkey as LocationID",
            "concat('D', cast(slot as string)) as DepartmentCode",
            f"{_pick('slot', DEPARTMENT_NAMES)} as DepartmentName",
            "'Clinical' as DepartmentType",
            "if(slot % 2 = 0, '08:00:00', cast(null as string)) as OpensAt",
            "if(slot = 0, '18:00:00', if(slot = 2, '17:00:00', cast(null as string))) as ClosesAt",
            "true as IsActive",
        )

    def build_hospital_specialty(self, columns) -> DataFrame:
        return _project(
            self.raw("part").groupBy("p_type").count(), columns,
            "ascii(p_type) as SpecialtyID", "p_type as SpecialtyCode", "concat('Specialty ', p_type) as SpecialtyName"
        )

    def build_hospital_provider(self, columns) -> DataFrame:
        key = "s_suppkey"
        return _project(
            self.raw("supplier"), columns,
            f"{key} as ProviderID",
            f"{_Rules.hospital_of(key)} as HospitalID",
            f"{_Rules.department_of(key)} as DepartmentID",
            "s_name as ProviderCode",
            f"case when {key} % 43 = 9 then null when {key} % 41 = 7 then concat('NPI', cast({key} as string)) "
            f"else cast(1000000000 + {key} as string) end as NPINumber",
            "'Dr' as FirstName",
            "s_name as LastName",
            f"if({key} % 2 = 0, 'M', 'F') as Gender",
            f"{_pick(f'{key} % 3', PROVIDER_TYPES)} as ProviderType",
            f"if({key} % 61 = 4, 'Retired', 'Full-Time') as EmploymentStatus",
            f"cast({key} % 90 as int) as YearsExperience",
            f"date_add(date'1980-01-01', cast({key} % 5000 as int)) as HireDate",
            f"if({key} % 10 = 9, date_add(date'1980-01-01', cast({key} % 5000 + if({key} % 20 = 9, 900, -1) as int)), "
            "cast(null as date)) as TerminationDate",
            f"{key} % 10 <> 9 as IsActive",
            f"if({key} % 67 = 5, date'1899-12-31', date'2030-01-01') as LicenseExpirationDate",
            f"if({key} % 31 = 4, cast(null as string), concat('LIC-', cast({key} % 900 as string))) as MedicalLicenseNumber",
            f"if({key} % 29 = 6, cast(null as string), 'NY') as LicenseState",
            f"if({key} % 17 = 3, cast(null as string), concat('DEA-', cast(if({key} % 71 = 9, {key} - 1, {key}) as string))) as DEANumber",
        )

    def build_hospital_providerspecialty(self, columns) -> DataFrame:
        return _project(
            self.raw("supplier"), columns,
            "s_suppkey as ProviderSpecialtyID",
            "s_suppkey as ProviderID",
            "cast(65 + s_suppkey % 20 as int) as SpecialtyID",
            "true as IsPrimary",
            "true as IsActive",
            "date_add(date'2000-01-01', cast(s_suppkey % 100 as int)) as CertificationDate",
            "if(s_suppkey % 53 = 7, date'1999-01-01', date'2010-01-01') as CertificationExpiryDate",
        )

    # -- clinical -------------------------------------------------------------

    def build_clinical_patient(self, columns) -> DataFrame:
        key = "c_custkey"
        return _project(
            self.raw("customer"), columns,
            f"{key} as PatientID",
            f"case when {key} % 333 = 5 then '   ' when {key} % 500 = 499 then {_code('MRN', f'{key} - 1')} "
            f"else {_code('MRN', key)} end as MedicalRecordNumber",
            f"if({key} % 401 = 17, cast(null as string), c_mktsegment) as FirstName",
            "c_name as LastName",
            f"case when {key} % 777 = 6 then date'2010-01-01' when {key} % 778 = 7 then date'1870-05-05' "
            f"else date_add(date'1920-01-01', cast(({key} * 37) % 28000 as int)) end as DateOfBirth",
            f"case when {key} % 50 = 49 then null when {key} % 2 = 0 then 'M' else 'F' end as Gender",
            f"{_pick(f'{key} % 5', MARITAL)} as MaritalStatus",
            f"if({key} % 6 = 0, 'Spanish', 'English') as PreferredLanguage",
            f"if({key} % 211 = 3, 'C+', {_pick(f'{key} % 8', BLOOD_TYPES)}) as BloodType",
            "cast(null as date) as DeceasedDate",
            f"{key} % 60 <> 59 as IsActive",
        )

    def build_clinical_patientaddress(self, columns) -> DataFrame:
        places = self.raw("nation").join(self.raw("region"), F.expr("n_regionkey = r_regionkey"))
        return _project(
            self.raw("customer").join(places, F.expr("c_nationkey = n_nationkey")), columns,
            "c_custkey as PatientAddressID",
            "c_custkey as PatientID",
            "if(c_custkey % 500 = 20, 'Cabin', 'Home') as AddressType",
            "n_name as City",
            "r_name as StateProvince",
            "lpad(cast(c_custkey % 100000 as string), 5, '0') as PostalCode",
            "true as IsPrimary",
            "c_custkey % 20 <> 3 as IsActive",
            "cast(if(c_custkey % 90 = 4, null, c_custkey % 100 - 5) as decimal(9,6)) as Latitude",
            "cast(if(c_custkey % 45 = 4, null, c_custkey % 200) as decimal(9,6)) as Longitude",
            "date'1990-01-01' as EffectiveStartDate",
            "if(c_custkey % 150 = 7, date'1989-01-01', cast(null as date)) as EffectiveEndDate",
        )

    def build_clinical_encounter(self, columns) -> DataFrame:
        k, p = "o_orderkey", self.rules.provider("o_orderkey")
        hospital = _Rules.hospital_of(p)
        return _project(
            self.raw("orders"), columns,
            f"{k} as EncounterID",
            f"{PATIENT} as PatientID",
            f"{hospital} as HospitalID",
            f"{hospital} as LocationID",
            f"case when {k} % 211 = 0 then null when {TELEHEALTH} then {hospital} * 5 + 4 "
            f"else {_Rules.department_of(p)} end as DepartmentID",
            f"if({k} % 97 = 0, null, {p}) as ProviderID",
            f"{_code('ENC', k)} as EncounterNumber",
            f"{ENCOUNTER_TYPE} as EncounterType",
            f"case when {k} % 41 = 0 then 'In Progress' when o_orderpriority in ('2-HIGH', '4-NOT SPECIFIED') "
            "then 'Discharged' else 'Completed' end as EncounterStatus",
            f"{ADMITTED} as AdmissionDateTimeUTC",
            f"{DISCHARGED} as DischargeDateTimeUTC",
            f"concat('Reason ', cast({k} % 8 as string)) as ReasonForVisit",
            "if(o_orderpriority in ('2-HIGH', '4-NOT SPECIFIED'), 'Home', 'Routine') as Disposition",
            f"{TELEHEALTH} as IsTelehealth",
        )

    def _lines_of(self, flag: str, columns: tuple[str, ...]) -> DataFrame:
        """Lines with one return flag; the patient costs a join and is added on demand."""
        lines = self.raw("lineitem").where(F.col("l_returnflag") == flag)
        if not columns or "PatientID" in columns:
            orders = self.raw("orders").selectExpr("o_orderkey", f"{PATIENT} as PatientID")
            return lines.join(orders, F.expr("l_orderkey = o_orderkey"))
        return lines.withColumn("PatientID", F.lit(None).cast("bigint"))

    def build_clinical_diagnosis(self, columns) -> DataFrame:
        return _project(
            self._lines_of("A", columns), columns,
            f"{LINE_ID} as DiagnosisID",
            "l_orderkey as EncounterID",
            "PatientID",
            "concat('D', cast(l_partkey % 12 as string)) as DiagnosisCode",
            "case when l_linenumber = 1 then 'Primary' when l_partkey % 97 = 0 then 'Rumoured' "
            "else 'Secondary' end as DiagnosisType",
            "l_shipdate as DiagnosisDateUTC",
            "l_linenumber = 1 as IsPrimary",
            "case cast(l_linenumber % 4 as int) when 1 then 'Y' when 2 then 'N' when 3 then if(l_partkey % 89 = 0, 'X', 'U') end as PresentOnAdmission",
        )

    def build_clinical_procedure(self, columns) -> DataFrame:
        return _project(
            self._lines_of("N", columns), columns,
            f"{LINE_ID} as ProcedureID",
            "l_orderkey as EncounterID",
            "PatientID",
            "concat('P', cast(l_partkey % 50 as string)) as ProcedureCode",
            "l_shipdate as ProcedureDateTimeUTC",
            "'Completed' as ProcedureStatus",
            "cast(l_quantity as int) - 1 as Quantity",
            f"{self.rules.provider('l_orderkey')} + if(l_partkey % 499 = 0, 1000000000, 0) as ProviderID",
        )

    def build_clinical_medicationorder(self, columns) -> DataFrame:
        return _project(
            self._lines_of("R", columns), columns,
            f"{LINE_ID} as MedicationOrderID",
            "PatientID",
            "l_orderkey as EncounterID",
            "l_partkey as MedicationID",
            "l_shipdate as OrderDateTimeUTC",
            "cast(l_shipdate as date) as StartDate",
            "date_add(cast(l_shipdate as date), cast(l_partkey % 40 - 2 as int)) as EndDate",
            "cast(l_quantity as decimal(10,3)) as Dose",
            "cast(l_quantity as decimal(10,2)) as Quantity",
            "cast(l_partkey % 4 as int) as Refills",
            "if(l_partkey % 5 = 0, 'Completed', 'Active') as OrderStatus",
            f"{self.rules.provider('l_orderkey')} + if(l_partkey % 501 = 0, 1000000000, 0) as ProviderID",
        )

    def build_clinical_medication(self, columns) -> DataFrame:
        return _project(
            self.raw("part"), columns,
            "p_partkey as MedicationID",
            f"{_code('MED', 'p_partkey')} as MedicationCode",
            "p_name as MedicationName",
            "p_type as DrugClass",
            "p_size % 10 = 0 as IsControlledSubstance",
            "true as IsActive",
        )

    def build_clinical_vitals(self, columns) -> DataFrame:
        k = "o_orderkey"
        return _project(
            self.raw("orders"), columns,
            f"{k} as VitalID",
            f"{PATIENT} as PatientID",
            f"{k} as EncounterID",
            f"{ADMITTED} as RecordedDateTimeUTC",
            f"cast(140 + {k} % 60 as decimal(5,2)) as HeightCM",
            f"cast({k} % 120 as decimal(6,2)) as WeightKG",
            f"cast(35 + {k} % 7 as decimal(4,1)) as TemperatureCelsius",
            f"cast(50 + {k} % 253 as int) as HeartRateBPM",
            f"cast(90 + {k} % 80 as int) as SystolicBloodPressure",
            f"cast(50 + {k} % 70 as int) as DiastolicBloodPressure",
            f"cast(80 + {k} % 22 as decimal(5,2)) as OxygenSaturationPercent",
            f"cast({k} % 11 as int) as PainScore",
            f"cast(10 + {k} % 95 as int) as RespiratoryRate",
            f"cast(8 + {k} % 300 as int) as BloodGlucoseMgDL",
            f"if({k} % 61 = 0, cast(-1 as bigint), {self.rules.provider(k)}) as RecordedByProviderID",
        )

    # -- telehealth -----------------------------------------------------------

    def _visits(self) -> DataFrame:
        return self.raw("orders").where(TELEHEALTH)

    def build_telehealth_virtualvisit(self, columns) -> DataFrame:
        k, p = "o_orderkey", self.rules.provider("o_orderkey")
        hospital = _Rules.hospital_of(p)
        started = f"{ADMITTED} + make_dt_interval(0, 0, cast({k} % 7 as int), 59)"
        ended = f"{started} + make_dt_interval(0, 0, cast(10 + {k} % 40 as int), cast({k} % 60 as int))"
        absent = f"{k} % 11 = 0"
        return _project(
            self._visits(), columns,
            f"{k} as VirtualVisitID",
            f"{k} as EncounterID",
            f"{PATIENT} as PatientID",
            f"{p} as ProviderID",
            f"{hospital} as HospitalID",
            f"{hospital} * 5 + 4 as DepartmentID",
            f"{_code('VV', k)} as VisitNumber",
            f"{ADMITTED} as ScheduledStartDateTimeUTC",
            f"{ADMITTED} + make_dt_interval(0, 0, 30) as ScheduledEndDateTimeUTC",
            f"if({absent}, null, {started}) as ActualStartDateTimeUTC",
            f"if({absent}, null, {ended}) as ActualEndDateTimeUTC",
            f"case when {absent} then 'No Show' when {k} % 17 = 0 then 'Disconnected' "
            "else 'Completed' end as VisitStatus",
            f"{_pick(f'{k} % 3', VISIT_TYPES)} as VisitType",
            f"case when {k} % 53 = 0 then null when {k} % 59 = 0 then '' "
            f"else {_pick(f'{k} % 3', PLATFORMS)} end as PlatformName",
            f"{_pick(f'{k} % 4', DEVICES)} as PatientDeviceType",
            f"if({k} % 2 = 0, 'Wi-Fi', 'Cellular') as PatientConnectionMethod",
            f"if({absent}, null, {ADMITTED} - make_dt_interval(0, 0, 3)) as PatientJoinedDateTimeUTC",
            f"if({absent}, null, {ADMITTED} + make_dt_interval(0, 0, cast({k} % 7 as int))) as ProviderJoinedDateTimeUTC",
            f"{k} % 12 = 0 as IsInterpreterRequired",
            f"if({k} % 12 = 0 and {k} % 24 <> 0, 'Spanish', cast(null as string)) as InterpreterLanguage",
        )

    def build_telehealth_sessionevent(self, columns) -> DataFrame:
        first = (
            self._visits()
            .selectExpr(f"{PATIENT} as PatientID", f"{ADMITTED} as At", "o_orderkey")
            .groupBy("PatientID")
            .agg(F.min(F.struct("At", "o_orderkey")).alias("first"))
            .selectExpr("PatientID", "first.o_orderkey as VirtualVisitID")
        )
        return _project(
            self.raw("events").join(first, F.expr("user_id = PatientID")), columns,
            "event_id as SessionEventID",
            "VirtualVisitID",
            "cast(event_id as bigint) as EventSequenceNumber",
            "case event_type when 'view' then 'Session Started' when 'signup' then 'Session Created' "
            "when 'click' then 'Patient Joined' when 'purchase' then 'Session Ended' else 'Technical Error' end as EventType",
            "ts as EventDateTimeUTC",
            "if(event_type = 'error' and event_id % 31 <> 0, concat('ERR-', cast(event_id % 5 as string)), "
            "cast(null as string)) as TechnicalErrorCode",
            "cast(null as string) as TechnicalErrorMessage",
            "if(event_id % 500 = 3, 'Robot', 'Patient') as ParticipantType",
        )

    def build_telehealth_device(self, columns) -> DataFrame:
        return _project(
            self.raw("customer").where("c_custkey % 10 = 0"), columns,
            "c_custkey as DeviceID",
            "c_custkey as PatientID",
            f"{_code('DEV', 'c_custkey')} as DeviceIdentifier",
            "if(c_custkey % 90 = 0, 'Abacus', 'Glucose Meter') as DeviceType",
            "concat('SN-', cast(c_custkey % 1400 as string)) as SerialNumber",
            "'Active' as DeviceStatus",
            "true as IsActive",
            "date'1997-01-01' as AssignedDate",
            "if(c_custkey % 70 = 0, date'1996-01-01', date'1997-02-01') as ActivatedDate",
            "if(c_custkey % 110 = 0, date'1996-06-01', cast(null as date)) as DeactivatedDate",
        )

    def build_telehealth_devicereading(self, columns) -> DataFrame:
        return _project(
            self.raw("events"), columns,
            "event_id as DeviceReadingID",
            "user_id - user_id % 10 as DeviceID",
            "user_id - user_id % 10 as PatientID",
            "ts as ReadingDateTimeUTC",
            "'Blood Glucose' as ReadingType",
            "cast(if(event_id % 77 = 0, null, value) as decimal(12,3)) as NumericValue",
            "cast(null as decimal(12,3)) as SecondaryNumericValue",
            "cast(null as string) as TextValue",
            "value > 90 as IsAbnormal",
            "ts - make_dt_interval(0, 0, cast(event_id % 7 as int)) as ReceivedDateTimeUTC",
            "if(event_id % 333 = 4, 'mmHg', cast(null as string)) as SecondaryUnitOfMeasure",
            "if(event_id % 444 = 5, 'Telepathy', 'API') as DataSource",
            "if(event_id % 100 = 1, event_id, cast(null as bigint)) as EncounterID",
        )

    def build_telehealth_waitlistqueue(self, columns) -> DataFrame:
        k = "o_orderkey"
        return _project(
            self._visits(), columns,
            f"{k} as WaitlistQueueID",
            f"{k} as VirtualVisitID",
            f"{PATIENT} as PatientID",
            f"{self.rules.provider(k)} as ProviderID",
            f"{ADMITTED} - make_dt_interval(0, 0, 5) as QueueEnteredDateTimeUTC",
            f"{ADMITTED} - make_dt_interval(0, 0, cast({k} % 8 as int)) as QueueCalledDateTimeUTC",
            f"if({k} % 11 = 0, 'No Show', 'Completed') as QueueStatus",
            f"if({k} % 100 = 1, 'Asap', 'Normal') as PriorityLevel",
            f"if({k} % 9 = 0, cast(null as timestamp_ntz), {ADMITTED} - make_dt_interval(0, 0, cast({k} % 7 as int))) as QueueExitedDateTimeUTC",
            f"{_Rules.hospital_of(self.rules.provider(k))} * 5 + if({k} % 211 = 9, 5, 4) as DepartmentID",
        )

    # -- insurance ------------------------------------------------------------

    def build_insurance_payer(self, columns) -> DataFrame:
        return _project(
            self.raw("region"), columns,
            "r_regionkey as PayerID",
            "concat('PAY-', cast(r_regionkey as string)) as PayerCode",
            "if(r_regionkey = 3, '  ', r_name) as PayerName",
            f"{_pick('r_regionkey', PAYER_TYPES)} as PayerType",
            "if(r_regionkey = 4, cast(null as string), concat('EIN-', cast(r_regionkey % 3 as string))) as TaxIdentifier",
            "true as IsActive",
        )

    def build_insurance_insuranceplan(self, columns) -> DataFrame:
        return _project(
            self.raw("nation"), columns,
            "n_nationkey as InsurancePlanID",
            "if(n_nationkey = 17, 77, n_regionkey) as PayerID",
            "concat('PLAN-', cast(n_nationkey as string)) as PlanCode",
            "concat('Plan ', n_name) as PlanName",
            f"{_pick('n_nationkey % 4', PLAN_TYPES)} as PlanType",
            f"{_pick('n_nationkey % 4', NETWORKS)} as NetworkType",
            "date'1990-01-01' as EffectiveStartDate",
            "date_add(date'1989-12-20', n_nationkey) as EffectiveEndDate",
            "true as IsActive",
        )

    def build_insurance_patientcoverage(self, columns) -> DataFrame:
        ranked = self.raw("customer").selectExpr(
            "c_custkey", "c_nationkey", "explode(sequence(0, if(c_custkey % 4 = 1, 1, 0))) as slot"
        )
        return _project(
            ranked, columns,
            "c_custkey * 2 + slot as PatientCoverageID",
            "c_custkey as PatientID",
            "(c_nationkey + slot * 3) % 25 as InsurancePlanID",
            "concat('M', cast(c_custkey div (1 + slot) as string)) as MemberNumber",
            "cast(null as bigint) as SubscriberPatientID",
            "if(c_custkey % 300 = 2, 'Child', 'Self') as RelationshipToSubscriber",
            "if(slot = 0, 'Primary', 'Secondary') as CoveragePriority",
            "date'1995-01-01' as EffectiveStartDate",
            "'Active' as CoverageStatus",
            "c_custkey % 25 <> 7 as IsActive",
            "if(c_custkey % 140 = 9, date'1994-01-01', cast(null as date)) as EffectiveEndDate",
        )

    def build_insurance_claim(self, columns) -> DataFrame:
        k, p = "o_orderkey", self.rules.provider("o_orderkey")
        return _project(
            self.raw("orders").where(self.rules.claimed(k)), columns,
            f"{k} as ClaimID",
            f"{_code('CLM', k)} as ClaimNumber",
            f"{PATIENT} as PatientID",
            f"({PATIENT}) * 2 as PatientCoverageID",
            f"{k} as EncounterID",
            f"{p} as ProviderID",
            f"{_Rules.hospital_of(p)} as HospitalID",
            f"{_pick(f'{k} % 4', CLAIM_TYPES)} as ClaimType",
            f"cast({ADMITTED} as date) as ServiceStartDate",
            f"{SERVICE_END} as ServiceEndDate",
            f"if({k} % 71 = 0, null, cast(date_add({SERVICE_END}, 2) as timestamp_ntz)) as SubmissionDateTimeUTC",
            f"cast(date_add({SERVICE_END}, cast(12 + {k} % 7 as int)) as timestamp_ntz) as AdjudicationDateTimeUTC",
            f"case when {k} % 17 = 3 then 'Denied' when o_orderstatus = 'F' then 'Approved' "
            "when o_orderstatus = 'O' then 'Partially Approved' else 'Submitted' end as ClaimStatus",
            f"if({k} % 800 = 7, {k}, cast(null as bigint)) as OriginalClaimID",
        )

    def build_insurance_claimline(self, columns) -> DataFrame:
        charge, denied = CHARGE, LINE_DENIED
        paid = (
            f"case when {denied} then cast(0 as decimal(18,2)) "
            f"when l_partkey % 211 = 0 then {_share(charge, '1.10')} else {_share(charge, '0.70')} end"
        )
        return _project(
            self.raw("lineitem").where(self.rules.claimed("l_orderkey")), columns,
            f"{LINE_ID} as ClaimLineID",
            "l_orderkey as ClaimID",
            "l_linenumber as LineNumber",
            "concat('P', cast(l_partkey % 50 as string)) as ProcedureCode",
            "cast(l_shipdate as date) as ServiceDate",
            "cast(l_quantity as decimal(12,3)) as Units",
            f"{charge} as ChargeAmount",
            f"{_share(charge, '0.90')} as AllowedAmount",
            f"{paid} as PaidAmount",
            f"{_share(charge, '0.20')} as PatientResponsibilityAmount",
            f"{_share(charge, '0.10')} as AdjustmentAmount",
            f"if({denied}, 'Denied', 'Paid') as LineStatus",
            f"case when not {denied} or l_partkey % 13 = 0 then null "
            f"else {_pick('l_linenumber % 3', DENIAL_CODES)} end as DenialReasonCode",
        )

    # -- billing --------------------------------------------------------------

    def build_billing_patientaccount(self, columns) -> DataFrame:
        return _project(
            self.raw("customer"), columns,
            "c_custkey as PatientAccountID",
            f"{_code('ACC', 'c_custkey')} as AccountNumber",
            "c_custkey as PatientID",
            "if(c_custkey % 70 = 1, 'Closed', 'Active') as AccountStatus",
            "if(c_custkey % 2 = 0, 'Paper', 'Electronic') as BillingPreference",
            "c_custkey % 8 = 0 as IsFinancialAssistanceEligible",
            "true as IsActive",
            "if(c_custkey % 130 = 11, 'Fax', 'Email') as PreferredCommunicationMethod",
        )

    def _invoices(self) -> DataFrame:
        return self.raw("orders").where(self.rules.invoiced("o_orderkey"))

    def build_billing_invoice(self, columns) -> DataFrame:
        k = "o_orderkey"
        return _project(
            self._invoices(), columns,
            f"{k} as InvoiceID",
            f"{_code('INV', k)} as InvoiceNumber",
            f"{PATIENT} as PatientAccountID",
            f"{PATIENT} as PatientID",
            f"{k} as EncounterID",
            f"{k} as ClaimID",
            f"date_add({SERVICE_END}, 1) as InvoiceDate",
            f"if({k} % 29 = 0, null, date_add({SERVICE_END}, 31)) as DueDate",
            f"if({k} % 29 = 0 and {k} % 2 = 0, 'Overdue', 'Issued') as InvoiceStatus",
            "'Initial' as StatementCycle",
            "cast(null as bigint) as OriginalInvoiceID",
        )

    def build_billing_invoiceline(self, columns) -> DataFrame:
        amount = f"if(l_partkey % 499 = 0 and l_linenumber = 1, -{CHARGE}, {CHARGE})"
        return _project(
            self.raw("lineitem").where(self.rules.invoiced("l_orderkey")), columns,
            f"{LINE_ID} as InvoiceLineID",
            "l_orderkey as InvoiceID",
            "l_linenumber as LineNumber",
            f"{LINE_ID} as ClaimLineID",
            "if(l_partkey % 499 = 0 and l_linenumber = 1, 'Credit', 'Charge') as LineType",
            "cast(if(l_partkey % 600 = 0, 0, 1) as decimal(12,3)) as Quantity",
            f"{amount} as UnitAmount",
            f"{amount} as LineAmount",
            "l_orderkey + if(l_partkey % 997 = 1, 1, 0) as EncounterID",
        )

    def _payments(self) -> DataFrame:
        return self._invoices().where("o_orderkey % 5 <> 4")

    @staticmethod
    def _allocated() -> str:
        total = "cast(o_totalprice as decimal(18,2))"
        return (
            f"case cast(o_orderkey % 4 as int) when 0 then {_share(total, '0.10')} when 1 then {_share(total, '0.25')} "
            f"when 2 then {_share(total, '0.50')} else {_share(total, '1.10')} end"
        )

    def build_billing_payment(self, columns) -> DataFrame:
        k = "o_orderkey"
        return _project(
            self._payments(), columns,
            f"{k} as PaymentID",
            f"{_code('PMT', k)} as PaymentNumber",
            f"{PATIENT} as PatientAccountID",
            f"{PATIENT} as PatientID",
            "cast(null as int) as PayerID",
            f"cast(date_add({SERVICE_END}, 11) as timestamp_ntz) as PaymentDateTimeUTC",
            f"{self._allocated()} as PaymentAmount",
            f"if({k} % 90 = 1, 'Insurance', 'Patient') as PaymentSource",
            f"{_pick(f'{k} % 4', PAYMENT_METHODS)} as PaymentMethod",
            "'Posted' as PaymentStatus",
            f"if({k} % 19 = 0, cast(null as string), concat('TXN-', cast(if({k} % 701 = 1, {k} - 1, {k}) as string))) as TransactionReference",
            f"if({k} % 4 = 3 and {k} % 8 <> 3, concat('CHK', cast({k} as string)), cast(null as string)) as CheckNumber",
        )

    def build_billing_paymentallocation(self, columns) -> DataFrame:
        k = "o_orderkey"
        parts = self._payments().selectExpr("*", f"explode(sequence(1, if({k} % 6 = 1, 2, 1))) as part")
        return _project(
            parts, columns,
            f"{k} * 10 + part as PaymentAllocationID",
            f"{k} as PaymentID",
            f"{k} as InvoiceID",
            "part as AllocationSequenceNumber",
            f"{self._allocated()} as AllocatedAmount",
            f"if({k} % 11 = 0, 'Reversed', 'Posted') as AllocationStatus",
            f"case when {k} % 22 = 0 then ' ' when {k} % 11 = 0 then 'Duplicate' end as ReversalReason",
        )

    # -- marketing ------------------------------------------------------------

    def build_marketing_campaign(self, columns) -> DataFrame:
        start = "date_add(date'1996-01-01', r_regionkey * 100)"
        return _project(
            self.raw("region"), columns,
            "r_regionkey as CampaignID",
            "concat('CMP-', cast(r_regionkey as string)) as CampaignCode",
            "concat('Campaign ', r_name) as CampaignName",
            f"{_pick('r_regionkey', CAMPAIGN_TYPES)} as CampaignType",
            "'Lead Generation' as CampaignObjective",
            f"{start} as StartDate",
            f"if(r_regionkey = 2, date_add({start}, -10), date_add({start}, 365)) as EndDate",
            "cast(10000 + 5000 * r_regionkey as decimal(18,2)) as BudgetAmount",
            "'Active' as CampaignStatus",
            "if(r_regionkey = 4, null, r_regionkey) as HospitalID",
            "cast(r_regionkey as bigint) as OwnerProviderID",
        )

    def build_marketing_campaignchannel(self, columns) -> DataFrame:
        slots = self.raw("region").where("r_regionkey <> 3").select(
            "r_regionkey", F.explode(F.array(F.lit(0), F.lit(1))).alias("slot")
        )
        return _project(
            slots, columns,
            "r_regionkey * 2 + slot as CampaignChannelID",
            "r_regionkey as CampaignID",
            "if(slot = 0, 'Email', 'SMS') as ChannelType",
            "concat('Channel ', cast(slot as string)) as ChannelName",
            "cast(5000 as decimal(18,2)) as PlannedSpendAmount",
            "cast(4500 + 100 * slot as decimal(18,2)) as ActualSpendAmount",
            "concat('TRK-', cast(r_regionkey * slot as string)) as TrackingCode",
        )

    def build_marketing_campaigninteraction(self, columns) -> DataFrame:
        return _project(
            self.raw("events"), columns,
            "event_id as CampaignInteractionID",
            "cast(user_id % 5 as int) as CampaignID",
            "cast((user_id % 5) * 2 + event_id % 2 as int) as CampaignChannelID",
            "user_id as PatientID",
            "case event_type when 'view' then 'Delivered' when 'signup' then 'Opened' when 'click' then 'Clicked' "
            "when 'purchase' then 'Converted' else 'Bounced' end as InteractionType",
            "ts as InteractionDateTimeUTC",
            "if(event_id % 900 = 8, 'Maybe', 'Success') as InteractionStatus",
            "if(event_id % 50 = 0, cast(null as string), concat('MSG-', cast(if(event_id % 601 = 1, event_id - 1, event_id) as string))) "
            "as ExternalMessageID",
            "'CRM' as SourceSystem",
            "if(event_id % 200 = 2, event_id, cast(null as bigint)) as EncounterID",
        )

    def build_marketing_patientacquisition(self, columns) -> DataFrame:
        first = (
            self.raw("events")
            .where("event_type = 'purchase'")
            .groupBy("user_id")
            .agg(F.min(F.struct("ts", "event_id")).alias("first"))
        )
        return _project(
            first, columns,
            "user_id as PatientAcquisitionID",
            "user_id as PatientID",
            "cast(user_id % 7 as int) as ReferralSourceID",
            "cast(if(user_id % 10 = 0, null, user_id % 5) as int) as CampaignID",
            "first.event_id as CampaignInteractionID",
            "cast(first.ts as date) as AcquisitionDate",
            "'Email' as AcquisitionChannel",
            "'First Touch' as AttributionModel",
            "'Converted' as AcquisitionStatus",
            "cast(25 + user_id % 75 as decimal(18,2)) as AcquisitionCost",
            "concat('LEAD-', cast(user_id as string)) as ExternalLeadID",
            "if(user_id % 25 = 0, user_id, cast(null as bigint)) as FirstEncounterID",
        )

    def build_marketing_patientcommunicationpreference(self, columns) -> DataFrame:
        return _project(
            self.raw("customer"), columns,
            "c_custkey as PatientCommunicationPreferenceID",
            "c_custkey as PatientID",
            "'Email' as ChannelType",
            f"{_pick('c_custkey % 4', CONSENT)} as ConsentStatus",
            "if(c_custkey % 40 = 0, null, timestamp_ntz'1998-01-01 00:00:00') as ConsentDateTimeUTC",
            "if(c_custkey % 4 = 3, timestamp_ntz'1998-06-01 00:00:00', null) as RevokedDateTimeUTC",
            "c_custkey % 4 in (0, 2) or c_custkey % 44 = 1 as IsActive",
            "if(c_custkey % 160 = 3, 'Pigeon', 'Web Portal') as ConsentSource",
            "if(c_custkey % 170 = 4, 'Midnight', cast(null as string)) as PreferredContactTime",
        )

    def build_marketing_referralsource(self, columns) -> DataFrame:
        return _project(
            self.raw("region"), columns,
            "r_regionkey as ReferralSourceID",
            "concat('REF-', cast(r_regionkey as string)) as ReferralSourceCode",
            "concat('Referral ', r_name) as ReferralSourceName",
            f"{_pick('r_regionkey', REFERRAL_TYPES)} as ReferralSourceType",
            "r_regionkey as ReferringHospitalID",
            "cast(if(r_regionkey = 2, 7, r_regionkey) as bigint) as ReferringProviderID",
        )

    def build_marketing_audiencesegment(self, columns) -> DataFrame:
        return _project(
            self.raw("customer").groupBy("c_mktsegment").agg(F.count(F.lit(1)).alias("n")), columns,
            "ascii(c_mktsegment) as AudienceSegmentID",
            "c_mktsegment as SegmentCode",
            "concat('Segment ', c_mktsegment) as SegmentName",
            "'Demographic' as SegmentType",
            "if(c_mktsegment = 'FURNITURE', '{x', concat('{\"segment\":\"', c_mktsegment, '\"}')) as DefinitionJSON",
            "cast(n as int) as EstimatedMemberCount",
            "if(c_mktsegment = 'MACHINERY', 'Hourly', 'Daily') as RefreshFrequency",
        )

    # -- models ---------------------------------------------------------------

    def build_ai_model(self, columns) -> DataFrame:
        return _project(
            self.raw("region"), columns,
            "r_regionkey as ModelID",
            "concat('MODEL-', cast(r_regionkey as string)) as ModelCode",
            "if(r_regionkey = 2, '', concat('Model ', r_name)) as ModelName",
            "'Machine Learning' as ModelType",
            "'Binary Classification' as ProblemType",
            "'Production' as ModelStatus",
            "if(r_regionkey = 1, 'Extreme', 'High') as RiskLevel",
            "cast(r_regionkey as bigint) as OwnerProviderID",
            "if(r_regionkey = 3, null, r_regionkey) as OwningHospitalID",
        )

    def build_ai_modelversion(self, columns) -> DataFrame:
        return _project(
            self.raw("region"), columns,
            "r_regionkey as ModelVersionID",
            "if(r_regionkey = 4, 9, r_regionkey) as ModelID",
            "concat('1.', cast(r_regionkey as string)) as VersionNumber",
            "if(r_regionkey % 2 = 0, 'Gradient Boosting', 'Random Forest') as AlgorithmName",
            "date'1994-01-01' as TrainingDataStartDate",
            "date_add(date'1994-12-31', -r_regionkey * 100) as TrainingDataEndDate",
            "'Approved' as ApprovalStatus",
            "'{\"trees\":100}' as HyperparametersJSON",
            "cast(null as string) as ModelHash",
            "timestamp_ntz'1995-01-01 00:00:00' as EffectiveStartDateTimeUTC",
            "if(r_regionkey = 1, timestamp_ntz'1994-06-01 00:00:00', null) as EffectiveEndDateTimeUTC",
            "if(r_regionkey = 2, -5, 1000) as TrainingRecordCount",
            "r_regionkey - 1 as FeatureCount",
            "cast(if(r_regionkey = 3, null, r_regionkey) as bigint) as ApprovedByProviderID",
            "if(r_regionkey = 4, null, timestamp_ntz'1995-01-01 00:00:00') as ApprovedDateTimeUTC",
        )

    def build_ai_featuredefinition(self, columns) -> DataFrame:
        return _project(
            self.raw("part").groupBy("p_brand").count(), columns,
            "cast(substring(p_brand, 7) as int) as FeatureDefinitionID",
            "p_brand as FeatureCode",
            "concat('Feature ', p_brand) as FeatureName",
            "'Decimal' as DataType",
            "'Clinical' as SourceSchema",
            "'Encounter' as SourceTable",
            "if(p_brand = 'Brand#13', 'Astral', 'Clinical') as FeatureCategory",
        )

    def build_ai_modelfeature(self, columns) -> DataFrame:
        return _project(
            self.raw("nation"), columns,
            "n_nationkey as ModelFeatureID",
            "n_nationkey % 6 as ModelVersionID",
            "n_nationkey + 3 as FeatureDefinitionID",
            "'Input' as FeatureRole",
            "n_nationkey as FeatureOrder",
        )

    def build_ai_prediction(self, columns) -> DataFrame:
        k = "o_orderkey"
        score = f"cast({k} % 100 as decimal(4,0))"
        payload = f"concat('{{\"k\":', cast({k} as string), '}}')"
        return _project(
            self.raw("orders"), columns,
            f"{k} as PredictionID",
            f"cast({k} % 5 as int) as ModelVersionID",
            f"{PATIENT} as PatientID",
            f"{k} as EncounterID",
            f"coalesce({DISCHARGED}, {ADMITTED}) + make_dt_interval(0, 1) as PredictionDateTimeUTC",
            "'Classification' as PredictionType",
            f"case when {k} % 173 = 0 then null when {k} % 179 = 0 then ' ' when {k} % 100 >= 50 then 'High Risk' "
            "else 'Low Risk' end as PredictedClass",
            "cast(null as decimal(19,6)) as PredictedValue",
            f"case when {k} % 83 = 0 then null when {k} % 307 = 5 then cast(1.25 as decimal(9,8)) "
            f"else cast({score} * 0.01 as decimal(9,8)) end as ProbabilityScore",
            f"if({k} % 311 = 6, cast(150 as decimal(9,6)), cast({score} * 0.1 as decimal(9,6))) as RiskScore",
            "cast(0.5 as decimal(9,8)) as ThresholdUsed",
            f"if({k} % 401 = 0, 'Lost', 'Generated') as PredictionStatus",
            f"case when {k} % 7 = 0 then null when {k} % 101 = 1 then '{{x' when {k} % 103 = 2 then '1' "
            f"when {k} % 11 = 0 then '[1]' else {payload} end as InputSnapshotJSON",
            f"if({k} % 2 = 0, {payload}, cast(null as string)) as ExplanationJSON",
            f"cast(if({k} % 997 = 1, {k} - 1, {k}) as string) as CorrelationID",
        )

    def build_ai_predictionoutcome(self, columns) -> DataFrame:
        k = "o_orderkey"
        return _project(
            self.raw("orders").where(f"{k} % 7 <> 0"), columns,
            f"{k} as PredictionOutcomeID",
            f"{k} as PredictionID",
            "'Confirmed' as OutcomeType",
            f"case when {k} % 143 = 0 then null when ({k} % 100 >= if({k} % 5 = 1, 70, 50)) <> ({k} % 3 = 0) then 'High Risk' "
            "else 'Low Risk' end as ActualClass",
            "cast(null as decimal(19,6)) as ActualValue",
            f"{ADMITTED} + make_dt_interval(30) as OutcomeDateTimeUTC",
            f"if({k} % 409 = 0, 'Guess', 'EHR') as OutcomeSource",
            f"{k} % 9 <> 0 as IsFinalOutcome",
            f"if({k} % 10 = 0, cast(null as bigint), {self.rules.provider(k)}) as VerifiedByProviderID",
            f"if({k} % 11 = 0, null, {ADMITTED}) as VerifiedDateTimeUTC",
        )

    # -- tables that only the declared rules read --------------------------------

    def build_insurance_priorauthorization(self, columns) -> DataFrame:
        k = "o_orderkey"
        return _project(
            self.raw("orders").where(f"{k} % 6 = 1"), columns,
            f"{k} as PriorAuthorizationID",
            f"{PATIENT} as PatientID",
            f"cast({k} % 26 as int) as InsurancePlanID",
            f"{k} + if({k} % 77 = 1, 1, 0) as EncounterID",
            f"{self.rules.provider(k)} as ProviderID",
            f"if({k} % 13 = 0, cast(null as string), concat('AUTH-', cast(if({k} % 91 = 1, 1, {k}) as string))) as AuthorizationNumber",
            f"case when {k} % 83 = 1 then 'Lost' when {k} % 5 = 1 then 'Denied' else 'Approved' end as AuthorizationStatus",
            f"{ADMITTED} as RequestedDateTimeUTC",
            f"{ADMITTED} + make_dt_interval(0, cast({k} % 50 - 1 as int)) as DecisionDateTimeUTC",
            f"cast({ADMITTED} as date) as ApprovedStartDate",
            f"date_add(cast({ADMITTED} as date), cast({k} % 30 - 1 as int)) as ApprovedEndDate",
            f"cast({k} % 40 as decimal(12,3)) as AuthorizedUnits",
            f"case when {k} % 15 = 1 then ' ' when {k} % 5 = 1 then 'Not covered' end as DenialReason",
        )

    def build_insurance_claimstatushistory(self, columns) -> DataFrame:
        k = "o_orderkey"
        steps = self.raw("orders").where(self.rules.claimed(k)).selectExpr("*", "explode(array(1, 2)) as part")
        return _project(
            steps, columns,
            f"{k} * 10 + part as ClaimStatusHistoryID",
            f"{k} + if({k} % 301 = 1, 1, 0) as ClaimID",
            f"case when {k} % 403 = 7 then 1 when {k} % 401 = 5 then part - 1 else part end as StatusSequenceNumber",
            f"case when part = 1 then 'Submitted' when {k} % 307 = 2 then 'Unknown' else 'Paid' end as ClaimStatus",
        )

    def build_billing_adjustment(self, columns) -> DataFrame:
        k = "o_orderkey"
        return _project(
            self._invoices(), columns,
            f"{k} as AdjustmentID",
            f"if({k} % 211 = 1, 'ADJ-1', {_code('ADJ', k)}) as AdjustmentNumber",
            f"{k} as InvoiceID",
            f"if({k} % 50 = 1, {k}, cast(null as bigint)) as InvoiceLineID",
            f"{k} as ClaimID",
            f"if({k} % 10 = 1, cast(null as bigint), {self.rules.provider(k)}) as ApprovedByProviderID",
            f"cast({k} % 40 as decimal(18,2)) as AdjustmentAmount",
            f"if({k} % 93 = 4, 'Mystery', 'Courtesy') as AdjustmentType",
            f"if({k} % 95 = 4, 'Gone', 'Posted') as AdjustmentStatus",
            f"if({k} % 43 = 1, ' ', 'AR-1') as AdjustmentReasonCode",
        )

    def build_billing_refund(self, columns) -> DataFrame:
        k = "o_orderkey"
        return _project(
            self._payments().where(f"{k} % 7 = 1"), columns,
            f"{k} as RefundID",
            f"if({k} % 113 = 1, 'REF-1', {_code('REF', k)}) as RefundNumber",
            f"{k} as PaymentID",
            f"{PATIENT} + if({k} % 119 = 1, 1, 0) as PatientAccountID",
            f"{PATIENT} as PatientID",
            f"{self.rules.provider(k)} as ApprovedByProviderID",
            f"cast({k} % 30 as decimal(18,2)) as RefundAmount",
            f"if({k} % 71 = 1, 'Barter', 'Check') as RefundMethod",
            f"if({k} % 73 = 1, 'Lost', 'Issued') as RefundStatus",
            f"if({k} % 41 = 1, '  ', 'Overpaid') as Reason",
            f"if({k} % 3 = 1, cast(null as string), concat('RTX-', cast(if({k} % 89 = 1, 1, {k}) as string))) as TransactionReference",
        )

    def build_billing_accountbalancehistory(self, columns) -> DataFrame:
        snapshots = self.raw("customer").selectExpr("*", "explode(array(1, 2)) as part")
        none = "cast(0 as decimal(18,2))"
        return _project(
            snapshots, columns,
            "c_custkey * 2 + part as AccountBalanceHistoryID",
            "c_custkey as PatientAccountID",
            "c_custkey + if(c_custkey % 131 = 1, 1, 0) as PatientID",
            "date_add(date'1998-01-01', if(c_custkey % 137 = 3, 1, part)) as SnapshotDate",
            "cast(c_acctbal as decimal(18,2)) as CurrentBalance",
            f"{none} as Balance0To30Days",
            f"{none} as Balance31To60Days",
            f"{none} as Balance61To90Days",
            f"{none} as Balance91To120Days",
            "cast(c_custkey % 100 - 1 as decimal(18,2)) as BalanceOver120Days",
            f"{none} as InsurancePendingAmount",
            f"{none} as PatientResponsibilityAmount",
            f"{none} as CollectionsAmount",
        )

    def build_marketing_campaignaudience(self, columns) -> DataFrame:
        slots = self.raw("region").select("r_regionkey", F.explode(F.array(F.lit(0), F.lit(1))).alias("slot"))
        return _project(
            slots, columns,
            "r_regionkey * 2 + slot as CampaignAudienceID",
            "if(r_regionkey = 4 and slot = 1, 50, r_regionkey) as CampaignID",
            "65 + r_regionkey as AudienceSegmentID",
            "if(r_regionkey = 2, 'Guest', 'Target') as AudienceRole",
            "slot as PriorityRank",
            "r_regionkey - 1 as ExpectedReach",
        )

    def build_ai_modelperformancemetric(self, columns) -> DataFrame:
        n = "n_nationkey"
        return _project(
            self.raw("nation"), columns,
            f"{n} as ModelPerformanceMetricID",
            f"{n} % 6 as ModelVersionID",
            f"case when {n} % 8 = 3 then 'Vibes' when {n} % 8 = 4 then 'Other' else 'AUROC' end as MetricName",
            f"if({n} % 16 = 12, 'Lift', cast(null as string)) as MetricDescription",
            f"if({n} = 9, 'Dream', 'Test') as EvaluationDataset",
            "date'1995-01-01' as EvaluationStartDate",
            f"date_add(date'1994-12-30', {n} % 12) as EvaluationEndDate",
            f"cast({n} * 0.05 as decimal(9,8)) as ThresholdValue",
            f"{n} - 1 as SampleSize",
            f"if({n} % 2 = 0, cast(null as string), 'All') as PatientPopulationSegment",
        )

    def build_ai_modelmonitoringevent(self, columns) -> DataFrame:
        n = "n_nationkey"
        return _project(
            self.raw("nation"), columns,
            f"{n} as ModelMonitoringEventID",
            f"{n} % 5 as ModelVersionID",
            f"if({n} = 3, 'Boredom', 'Data Drift') as EventType",
            f"if({n} = 5, 'Meh', 'High') as Severity",
            f"case when {n} % 3 = 0 then 'Resolved' when {n} = 7 then 'Limbo' else 'Open' end as ResolutionStatus",
            f"cast(if({n} % 6 = 0, {n}, null) as bigint) as ResolvedByProviderID",
            f"if({n} % 3 = 0, timestamp_ntz'1996-01-01 00:00:00', null) as ResolvedDateTimeUTC",
            f"cast({n} as decimal(19,6)) as ExpectedMinimum",
            "cast(20 as decimal(19,6)) as ExpectedMaximum",
        )


@lru_cache(maxsize=8)
def derived_tables(spark: SparkSession, folder: str) -> Tables:
    """Tables over one read-only folder, whose files are listed once per session."""
    return DerivedTables(spark, folder).tables()
