"""DuckDB text of the report and library queries over the view expressions."""

from __future__ import annotations

from oracle.views import cents, half_up, mean, mean_micro, mean_money, money, month, pct, tally

REPORTS: dict[str, str] = {
    "P01": "select * from v11",
    "P02": "select * from v01 where PatientID = 1",
    "P03": "select * from v12 where HospitalID = 1",
    "P03a": "select * from v12 where HospitalID = 1 and KPI_Month between date '1994-02-01' and date '1997-09-01'",
    "P04": "select * from v13 where TotalEncounters >= 1",
    "P04a": "select * from v13 where HospitalID = 2 and DepartmentID = 11",
    "P05": """select * from v16 where KPI_Month between date '1996-03-01' and date '1998-07-01'
              and coalesce(DenialRatePercent, 0) >= 5""",
    "P06": "select * from v15 where KPI_Month >= date '1996-03-01'",
    "P07": "select * from v14 where KPI_Month <= date '1999-12-01' and HospitalID = 1",
    "P08": """select * from v17 where DerivedPatientRiskTier = 'High' and EstimatedOutstandingAmount >= 0
              and NeedsCareManagementReview = 1""",
    "P09": "select * from v18 where TotalPredictions >= 1",
    "P10": "select * from v02 where PatientID = 1",
    "P11": "select * from v07 where PatientID = 1",
    "P12a": """select 'High Outstanding Balance' as ExceptionType, PatientID as EntityID, MedicalRecordNumber as EntityCode,
                      EstimatedOutstandingAmount::decimal(18,2) as ExceptionValue, DerivedPatientRiskTier as AdditionalContext
               from v17 where EstimatedOutstandingAmount > 0
               order by EstimatedOutstandingAmount desc, PatientID limit 20""",
    "P12b": """select 'Claim Denial' as ExceptionType, ClaimID as EntityID, ClaimNumber as EntityCode,
                      TotalChargeAmount::decimal(18,2) as ExceptionValue,
                      coalesce(PrimaryDenialReasonCode, 'Unknown') as AdditionalContext
               from v06 where IsDeniedClaim = 1 order by TotalChargeAmount desc, ClaimID limit 20""",
    "P12c": """select 'Telehealth No Show' as ExceptionType, VirtualVisitID as EntityID, VisitNumber as EntityCode,
                      coalesce(PatientJoinDelayMinutes, 0)::decimal(18,2) as ExceptionValue, HospitalName as AdditionalContext
               from v04 where IsNoShow = 1 order by ScheduledStartDateTimeUTC desc, VirtualVisitID limit 20""",
}

REPORTS["P12"] = " union all ".join(f"select * from ({REPORTS[key]})" for key in ("P12a", "P12b", "P12c"))

LIBRARY: dict[str, str] = {
    "Q01": f"""
        with m as (select {month('AdmissionDateTimeUTC')} as EncounterMonth, count(*) as TotalEncounters from v02 group by 1),
             g as (select *, lag(TotalEncounters) over (order by EncounterMonth) as PreviousMonthEncounters from m)
        select *, TotalEncounters - PreviousMonthEncounters as EncounterChange,
               {pct('(TotalEncounters - PreviousMonthEncounters)', 'PreviousMonthEncounters', 10)} as MonthOverMonthGrowthPercent
        from g""",
    "Q02": """select *, rank() over (order by TotalEncounters desc) as HospitalRank
              from (select HospitalID, HospitalName, count(*) as TotalEncounters from v02 group by 1, 2)""",
    "Q03": """select HospitalID, HospitalName, ProviderID, ProviderName, ProviderType, TotalEncounters,
                     row_number() over (partition by HospitalID order by TotalEncounters desc, ProviderID, DepartmentID) as ProviderRank
              from v13 qualify ProviderRank <= 3""",
    "Q04": f"""select a.KPI_Month, a.TotalCollectedAmount, {money('sum(b.TotalCollectedAmount)')} as RunningCollectedAmount
              from v15 a join v15 b on b.KPI_Month <= a.KPI_Month group by 1, 2""",
    "Q05": f"""select KPI_Month, TotalCollectedAmount,
                     cast({half_up(f"sum({cents('TotalCollectedAmount')}) over w", 'count(*) over w')} / 100.0 as decimal(18,2)) as ThreeMonthMovingAverage
              from v15 window w as (order by KPI_Month rows between 2 preceding and current row)""",
    "Q06": f"""select PatientID, MedicalRecordNumber, FirstName, LastName, EmergencyEncounters, TotalEncounters,
                     {pct('EmergencyEncounters', 'TotalEncounters', 10)} as EmergencyEncounterRatePercent
              from v01 where EmergencyEncounters >= 2""",
    "Q07": f"""select DerivedPatientRiskTier, count(*) as PatientCount, {mean('TotalEncounters')} as AverageEncounters,
                     {mean('EmergencyEncounters')} as AverageEmergencyEncounters,
                     {mean_money('EstimatedOutstandingAmount', 22)} as AverageOutstandingAmount
              from v17 group by 1""",
    "Q08": """select PatientID, MedicalRecordNumber, FirstName, LastName from v01
              where PatientID not in (select PatientID from v02)""",
    "Q09": """select p.PatientID, p.MedicalRecordNumber, FirstName, LastName, EncounterID, EncounterType,
                     AdmissionDateTimeUTC, HospitalName, ProviderName
              from v01 p join v02 e on e.PatientID = p.PatientID
              qualify row_number() over (partition by p.PatientID order by AdmissionDateTimeUTC desc nulls last, EncounterID desc) = 1""",
    "Q10": """select p.PatientID, p.MedicalRecordNumber, FirstName, LastName, EncounterID, EncounterType, AdmissionDateTimeUTC
              from v01 p left join v02 e on e.PatientID = p.PatientID
              qualify row_number() over (partition by p.PatientID order by AdmissionDateTimeUTC desc nulls last, EncounterID desc) = 1""",
    "Q11": f"""select KPI_Month, TotalChargeAmount, InsurancePaidAmount, PatientPaidAmount, TotalCollectedAmount,
                     {pct('TotalCollectedAmount', 'TotalChargeAmount', 10)} as TotalCollectionRatePercent from v15""",
    "Q12": f"""select *, rank() over (order by DeniedChargeAmount desc) as PayerDenialRank
              from (select PayerName, count(*) as TotalClaims, sum(IsDeniedClaim)::bigint as DeniedClaims,
                           {money('coalesce(sum(TotalChargeAmount) filter (where IsDeniedClaim = 1), 0)')} as DeniedChargeAmount
                    from v05 group by 1)""",
    "Q13": f"""select KPI_Month, HospitalName, PayerName, TotalClaims, DeniedClaims, DenialRatePercent,
                     (select {pct('sum(IsDeniedClaim)', 'count(*)', 10)} from v05) as EnterpriseDenialRatePercent
              from v16""",
    "Q14": f"""select DerivedPatientRiskTier, count(*) as PatientCount,
                     {money('sum(EstimatedOutstandingAmount)')} as TotalOutstandingAmount,
                     {mean_money('EstimatedOutstandingAmount')} as AverageOutstandingAmount,
                     max(EstimatedOutstandingAmount) as MaximumOutstandingAmount
              from v17 group by 1""",
    "Q15": f"""with o as (select * from v07 where DerivedPaymentStatus = 'Overdue')
              select PatientID, MedicalRecordNumber, InvoiceID, InvoiceDate, OutstandingAmount, DerivedPaymentStatus
              from o where {cents('OutstandingAmount')} * (select count(*) from o) > (select sum({cents('OutstandingAmount')}) from o)""",
    "Q16": f"""select {month('AdmissionDateTimeUTC')} as KPI_Month, count(*) as TotalEncounters,
                     {tally('IsTelehealth')} as TelehealthEncounters,
                     {pct(tally('IsTelehealth'), 'count(*)', 10)} as TelehealthAdoptionRatePercent
              from v02 group by 1""",
    "Q17": f"""select PlatformName, sum(TotalVirtualVisits)::bigint as TotalVirtualVisits,
                     sum(CompletedVisits)::bigint as CompletedVisits, sum(NoShowVisits)::bigint as NoShowVisits,
                     sum(DisconnectedVisits)::bigint as DisconnectedVisits,
                     {mean_micro('AverageVisitDurationMinutes')} as AverageVisitDurationMinutes
              from v14 group by 1""",
    "Q18": f"""select *, dense_rank() over (order by NoShowRatePercent desc nulls last) as NoShowRank
              from (select DepartmentID, DepartmentName, count(*) as TotalVirtualVisits, sum(IsNoShow)::bigint as NoShowVisits,
                           {pct('sum(IsNoShow)', 'count(*)', 10)} as NoShowRatePercent from v04 group by 1, 2)""",
    "Q19": """select VirtualVisitID, VisitNumber, HospitalName, DepartmentName, PlatformName, PatientDeviceType,
                     TechnicalErrorCount, IsDisconnected, ScheduledStartDateTimeUTC
              from v04 where TechnicalErrorCount > 0 or IsDisconnected = 1""",
    "Q20": """select ModelCode, ModelName, VersionNumber, TotalPredictions, AccuracyPercent, PrecisionPercent, RecallPercent,
                     rank() over (order by AccuracyPercent desc nulls last) as AccuracyRank from v18""",
    "Q21": """select ModelCode, ModelName, VersionNumber, PrecisionPercent, RecallPercent,
                     RecallPercent - PrecisionPercent as RecallPrecisionGap from v18 where PrecisionPercent < RecallPercent""",
    "Q22": f"""select ModelName, VersionNumber, count(*) as TotalPredictions,
                     {tally("PredictedClass = 'High Risk'")} as HighRiskPredictions,
                     {pct(tally("PredictedClass = 'High Risk'"), 'count(*)', 10)} as HighRiskPredictionRatePercent
              from v09 group by 1, 2""",
    "Q23": """select PredictionID, PatientID, ModelName, VersionNumber, PredictedClass, ActualClass, ProbabilityScore,
                     RiskScore, PredictionDateTimeUTC from v09 where ConfusionMatrixCategory = 'False Negative'""",
    "Q24": f"""select {month('PredictionDateTimeUTC')} as PredictionMonth, ModelName, count(*) as PredictionCount
              from v09 group by 1, 2""",
    "Q25": """select ProviderID, ProviderName, HospitalName, TotalEncounters,
                     (ntile(4) over (order by TotalEncounters desc, ProviderID, DepartmentID))::integer as ProductivityQuartile
              from v13""",
    "Q26": f"""with m as (select HospitalID as hid, {mean('TotalEncounters')} as a from v13 group by 1)
              select ProviderID, ProviderName, HospitalName, TotalEncounters, a::decimal(18,2) as HospitalAverageEncounters,
                     (TotalEncounters - a)::decimal(18,2) as DifferenceFromHospitalAverage
              from v13 join m on hid = HospitalID""",
    "Q27": """select PatientID, min(AdmissionDateTimeUTC) as FirstEncounterDate, max(AdmissionDateTimeUTC) as MostRecentEncounterDate
              from v02 group by 1""",
    "Q28": """select PatientID, EncounterID, AdmissionDateTimeUTC,
                     lag(AdmissionDateTimeUTC) over (partition by PatientID order by AdmissionDateTimeUTC, EncounterID) as PreviousEncounterDate,
                     (AdmissionDateTimeUTC::date - PreviousEncounterDate::date)::integer as DaysSincePreviousEncounter
              from v02 qualify PreviousEncounterDate is not null""",
    "Q29": """select PatientID, EncounterID, HospitalName, AdmissionDateTimeUTC,
                     lag(AdmissionDateTimeUTC) over (partition by PatientID order by AdmissionDateTimeUTC, EncounterID) as PreviousEncounterDate,
                     (AdmissionDateTimeUTC::date - PreviousEncounterDate::date)::integer as DaysBetweenEncounters
              from v02 qualify DaysBetweenEncounters between 1 and 30""",
    "Q30": f"""select {month('AdmissionDateTimeUTC')} as EncounterMonth, {tally("EncounterType = 'Emergency'")} as Emergency,
                     {tally("EncounterType = 'Inpatient'")} as Inpatient, {tally("EncounterType = 'Outpatient'")} as Outpatient,
                     {tally("EncounterType = 'Telehealth'")} as Telehealth
              from v02 group by 1""",
    "Q31": """select KPIName, KPIValue from (
                select TotalEncounters::decimal(18,2) as "Total Encounters", UniquePatients::decimal(18,2) as "Unique Patients",
                       TotalClaims::decimal(18,2) as "Total Claims", DeniedClaims::decimal(18,2) as "Denied Claims",
                       TotalPredictions::decimal(18,2) as "Total Predictions",
                       PredictionAccuracyPercent::decimal(18,2) as "Prediction Accuracy Percent"
                from v11) unpivot include nulls (KPIValue for KPIName in (columns(*)))""",
    "Q32": f"""select d::date as CalendarMonth, {money('coalesce(TotalCollectedAmount, 0)')} as TotalCollectedAmount
              from (select unnest(range(lo, hi + interval 1 month, interval 1 month)) as d
                    from (select min(KPI_Month)::timestamp as lo, max(KPI_Month)::timestamp as hi from v15))
              left join v15 on KPI_Month = d::date""",
    "Q33": """select ProviderID, ProviderName, HospitalName, TotalEncounters from v13
              where ProviderID not in (select ProviderID from v05)""",
    "Q34": f"""with h as (select HospitalName, count(*) as TotalClaims, sum(IsDeniedClaim)::bigint as DeniedClaims,
                                {pct('sum(IsDeniedClaim)', 'count(*)', 10)} as HospitalDenialRatePercent from v05 group by 1)
              select h.*, (select {pct('sum(IsDeniedClaim)', 'count(*)', 10)} from v05) as EnterpriseDenialRatePercent
              from h where HospitalDenialRatePercent > EnterpriseDenialRatePercent""",
    "Q35": """select ProviderID, ProviderName, TotalEncounters from v13
              qualify dense_rank() over (order by TotalEncounters desc) = 2""",
    "Q36": "select MedicalRecordNumber, count(*) as DuplicateCount from v01 group by 1 having count(*) > 1",
    "Q37": """select PatientID, MedicalRecordNumber, FirstName, LastName, DerivedPatientRiskTier, EstimatedOutstandingAmount,
                     row_number() over (partition by DerivedPatientRiskTier order by EstimatedOutstandingAmount desc, PatientID) as BalanceRank
              from v17 qualify BalanceRank = 1""",
    "Q38": f"""select HospitalID, HospitalName, count(*) as HospitalEncounters,
                     {pct('count(*)', '(select count(*) from v02)', 10)} as EnterpriseEncounterSharePercent
              from v02 group by 1, 2""",
    "Q39": """select PatientID, MedicalRecordNumber, DerivedPatientRiskTier, EmergencyEncounters, EstimatedOutstandingAmount,
                     LatestProbabilityScore,
                     (case DerivedPatientRiskTier when 'High' then 50 when 'Medium' then 25 else 5 end
                      + ([0, 5, 15, 25])[least(EmergencyEncounters, 3) + 1]
                      + case when EstimatedOutstandingAmount >= 5000 then 25 when EstimatedOutstandingAmount >= 1000 then 10 else 0 end
                     )::integer as ExecutiveExceptionScore
              from v17""",
}
