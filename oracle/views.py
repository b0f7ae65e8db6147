"""DuckDB text of the views, written from the base tables with plain joins."""

from __future__ import annotations

AS_OF = "date '1999-06-30'"


def cents(x: str) -> str:
    return f"cast(cast({x} as decimal(24,2)) * 100 as hugeint)"


def half_up(num: str, den: str) -> str:
    """num/den in whole numbers, halves away from zero."""
    return f"(sign({num}) * ((2 * abs({num}) + ({den})) // nullif(2 * ({den}), 0)))"


def pct(n: str, d: str, width: int = 9) -> str:
    """100*n/d to two places; counts and money alike."""
    ratio = half_up(f"({cents(n)} * 10000)", cents(d))
    return f"cast({ratio} / 100.0 as decimal({width},2))"


def mean(x: str) -> str:
    """Average of a whole-number column to six places."""
    return f"cast({half_up(f'(sum({x})::hugeint * 1000000)', f'count({x})')} / 1000000.0 as decimal(22,6))"


def mean_money(x: str, width: int = 28) -> str:
    return f"cast({half_up(f'(sum({cents(x)}) * 10000)', f'count({x})')} / 1000000.0 as decimal({width},6))"


def mean_micro(x: str, width: int = 28, scale: int = 6) -> str:
    """Average of a column that already has ``scale`` places."""
    unit = 10 ** scale
    total = f"sum(cast({x} * {unit} as hugeint))"
    return f"cast({half_up(total, f'count({x})')} / {unit}.0 as decimal({width},{scale}))"


def tally(cond: str) -> str:
    return f"(count(*) filter (where {cond}))"


def mins(a: str, b: str) -> str:
    return f"date_diff('minute', {a}, {b})::integer"


def money(x: str) -> str:
    return f"({x})::decimal(38,2)"


def month(x: str) -> str:
    return f"date_trunc('month', {x})::date"


STAY = mins("AdmissionDateTimeUTC", "DischargeDateTimeUTC")

VIEWS: dict[str, str] = {
    "v01": f"""
        select p.PatientID, MedicalRecordNumber, FirstName, LastName, DateOfBirth,
               (date_diff('year', DateOfBirth, {AS_OF})
                 - (DateOfBirth + to_years(date_diff('year', DateOfBirth, {AS_OF})::integer) > {AS_OF})::integer)::integer as AgeYears,
               Gender, MaritalStatus, PreferredLanguage, BloodType, a.City, a.StateProvince, a.PostalCode,
               coalesce(e.n, 0) as TotalEncounters, coalesce(e.tele, 0) as TelehealthEncounters,
               coalesce(e.emer, 0) as EmergencyEncounters, e.last as MostRecentEncounterDateUTC,
               coalesce(d.n, 0) as TotalDiagnoses, coalesce(d.codes, 0) as DistinctDiagnosisCount,
               coalesce(cv.n, 0) as ActiveCoverageCount, cv.payer as PrimaryPayerName, cv.plan as PrimaryPlanName,
               {money('coalesce(b.billed, 0)')} as TotalBilledAmount, {money('coalesce(b.paid, 0)')} as TotalPaidAmount,
               {money('coalesce(b.billed, 0) - coalesce(b.paid, 0)')} as EstimatedOutstandingAmount,
               coalesce(m.n, 0) as PredictionCount, m.prob as MaximumProbabilityScore, m.last as MostRecentPredictionDateUTC,
               p.IsActive
        from clinical_patient p
        left join clinical_patientaddress a on a.PatientID = p.PatientID and a.IsPrimary and a.IsActive
        left join (select PatientID, count(*) as n, {tally('IsTelehealth')} as tele,
                          {tally("EncounterType = 'Emergency'")} as emer, max(AdmissionDateTimeUTC) as last
                   from clinical_encounter group by 1) e on e.PatientID = p.PatientID
        left join (select PatientID, count(*) as n, count(distinct DiagnosisCode) as codes
                   from clinical_diagnosis group by 1) d on d.PatientID = p.PatientID
        left join (select PatientID, count(*) as n, max(PayerName) filter (where CoveragePriority = 'Primary') as payer,
                          max(PlanName) filter (where CoveragePriority = 'Primary') as plan
                   from insurance_patientcoverage pc
                   join insurance_insuranceplan ip using (InsurancePlanID) join insurance_payer py using (PayerID)
                   where pc.IsActive group by 1) cv on cv.PatientID = p.PatientID
        left join (select i.PatientID, sum(LineAmount) as billed, sum(coalesce(alloc, 0)) as paid
                   from billing_invoice i join billing_invoiceline l using (InvoiceID)
                   left join (select InvoiceID, sum(AllocatedAmount) as alloc from billing_paymentallocation
                              where AllocationStatus = 'Posted' group by 1) s using (InvoiceID)
                   group by 1) b on b.PatientID = p.PatientID
        left join (select PatientID, count(*) as n, max(ProbabilityScore) as prob, max(PredictionDateTimeUTC) as last
                   from ai_prediction group by 1) m on m.PatientID = p.PatientID""",
    "v02": f"""
        select e.EncounterID, e.EncounterNumber, e.PatientID, p.MedicalRecordNumber,
               p.FirstName || ' ' || p.LastName as PatientName, e.HospitalID, h.HospitalCode, h.HospitalName,
               e.DepartmentID, d.DepartmentCode, d.DepartmentName, e.ProviderID, pr.ProviderCode,
               pr.FirstName || ' ' || pr.LastName as ProviderName, pr.ProviderType, e.EncounterType, e.EncounterStatus,
               e.AdmissionDateTimeUTC, e.DischargeDateTimeUTC, {STAY} as LengthOfStayMinutes,
               cast({half_up(f'({STAY}::hugeint * 100)', '60')} / 100.0 as decimal(12,2)) as LengthOfStayHours,
               e.ReasonForVisit, e.Disposition, e.IsTelehealth, count(distinct dg.DiagnosisID) as DiagnosisCount,
               count(distinct pc.ProcedureID) as ProcedureCount, count(distinct mo.MedicationOrderID) as MedicationOrderCount
        from clinical_encounter e
        join clinical_patient p on p.PatientID = e.PatientID
        join hospital_hospital h on h.HospitalID = e.HospitalID
        join hospital_department d on d.DepartmentID = e.DepartmentID
        join hospital_provider pr on pr.ProviderID = e.ProviderID
        left join clinical_diagnosis dg on dg.EncounterID = e.EncounterID
        left join clinical_procedure pc on pc.EncounterID = e.EncounterID
        left join clinical_medicationorder mo on mo.EncounterID = e.EncounterID
        group by all""",
    "v03": f"""
        select {month('AdmissionDateTimeUTC')} as EncounterMonth, e.HospitalID, HospitalName, e.DepartmentID, DepartmentName,
               EncounterType, count(*) as EncounterCount, count(distinct PatientID) as UniquePatientCount,
               {tally('IsTelehealth')} as TelehealthEncounterCount, {mean(STAY)} as AverageLengthOfStayMinutes
        from clinical_encounter e join hospital_hospital h on h.HospitalID = e.HospitalID
        join hospital_department d on d.DepartmentID = e.DepartmentID
        group by 1, 2, 3, 4, 5, 6""",
    "v04": f"""
        select v.VirtualVisitID, VisitNumber, EncounterID, v.PatientID, MedicalRecordNumber, v.ProviderID,
               pr.FirstName || ' ' || pr.LastName as ProviderName, v.HospitalID, HospitalName, v.DepartmentID,
               DepartmentName, VisitType, VisitStatus, PlatformName, PatientDeviceType, PatientConnectionMethod,
               ScheduledStartDateTimeUTC, ActualStartDateTimeUTC, ActualEndDateTimeUTC,
               {mins('ScheduledStartDateTimeUTC', 'PatientJoinedDateTimeUTC')} as PatientJoinDelayMinutes,
               {mins('ScheduledStartDateTimeUTC', 'ProviderJoinedDateTimeUTC')} as ProviderJoinDelayMinutes,
               {mins('ActualStartDateTimeUTC', 'ActualEndDateTimeUTC')} as ActualVisitDurationMinutes,
               (VisitStatus = 'Completed')::integer as IsCompleted, (VisitStatus = 'No Show')::integer as IsNoShow,
               (VisitStatus = 'Disconnected')::integer as IsDisconnected,
               coalesce(s.n, 0) as SessionEventCount, coalesce(s.errors, 0) as TechnicalErrorCount,
               IsInterpreterRequired, InterpreterLanguage
        from telehealth_virtualvisit v
        join clinical_patient p on p.PatientID = v.PatientID
        join hospital_provider pr on pr.ProviderID = v.ProviderID
        join hospital_hospital h on h.HospitalID = v.HospitalID
        join hospital_department d on d.DepartmentID = v.DepartmentID
        left join (select VirtualVisitID, count(*) as n, {tally('TechnicalErrorCode is not null')} as errors
                   from telehealth_sessionevent group by 1) s on s.VirtualVisitID = v.VirtualVisitID""",
    "v05": f"""
        select c.ClaimID, ClaimNumber, c.PatientID, MedicalRecordNumber, EncounterID, c.ProviderID,
               pr.FirstName || ' ' || pr.LastName as ProviderName, c.HospitalID, HospitalName, py.PayerID, PayerName,
               ip.InsurancePlanID, PlanName, PlanType, ClaimType, ServiceStartDate, ServiceEndDate,
               SubmissionDateTimeUTC, AdjudicationDateTimeUTC,
               (SubmissionDateTimeUTC::date - ServiceEndDate)::integer as SubmissionLagDays,
               (AdjudicationDateTimeUTC::date - SubmissionDateTimeUTC::date)::integer as AdjudicationDays,
               ClaimStatus, coalesce(n, 0) as ClaimLineCount, coalesce(charge, 0)::decimal(28,2) as TotalChargeAmount,
               coalesce(allowed, 0)::decimal(28,2) as TotalAllowedAmount, coalesce(paid, 0)::decimal(28,2) as TotalPaidAmount,
               coalesce(resp, 0)::decimal(28,2) as TotalPatientResponsibilityAmount,
               coalesce(adj, 0)::decimal(28,2) as TotalAdjustmentAmount, coalesce(denied, 0) as DeniedLineCount,
               (ClaimStatus = 'Denied' or coalesce(denied, 0) > 0)::integer as IsDeniedClaim,
               {pct('paid', 'charge')} as PaidToChargePercent
        from insurance_claim c
        join clinical_patient p on p.PatientID = c.PatientID
        join hospital_provider pr on pr.ProviderID = c.ProviderID
        join hospital_hospital h on h.HospitalID = c.HospitalID
        join insurance_patientcoverage pc on pc.PatientCoverageID = c.PatientCoverageID
        join insurance_insuranceplan ip on ip.InsurancePlanID = pc.InsurancePlanID
        join insurance_payer py on py.PayerID = ip.PayerID
        left join (select ClaimID, count(*) as n, sum(ChargeAmount) as charge, sum(AllowedAmount) as allowed,
                          sum(PaidAmount) as paid, sum(PatientResponsibilityAmount) as resp, sum(AdjustmentAmount) as adj,
                          {tally("LineStatus = 'Denied'")} as denied
                   from insurance_claimline group by 1) s on s.ClaimID = c.ClaimID""",
    "v06": """
        select v.ClaimID, ClaimNumber, PatientID, MedicalRecordNumber, HospitalName, ProviderName, PayerName, PlanName,
               ClaimType, ServiceStartDate, ClaimStatus, TotalChargeAmount, TotalAllowedAmount, TotalPaidAmount,
               TotalPatientResponsibilityAmount, DeniedLineCount, IsDeniedClaim,
               max(DenialReasonCode) as PrimaryDenialReasonCode,
               count(distinct case when LineStatus = 'Denied' then ClaimLineID end) as DeniedClaimLineCount
        from v05 v left join insurance_claimline l on l.ClaimID = v.ClaimID
        group by all""",
    "v07": f"""
        with t as (
            select i.*, (select sum(LineAmount) from billing_invoiceline l where l.InvoiceID = i.InvoiceID) as amount,
                   coalesce((select sum(AllocatedAmount) from billing_paymentallocation a
                             where a.InvoiceID = i.InvoiceID and AllocationStatus = 'Posted'), 0) as paid
            from billing_invoice i
            where exists (select 1 from billing_invoiceline l where l.InvoiceID = i.InvoiceID))
        select InvoiceID, InvoiceNumber, t.PatientAccountID, AccountNumber, t.PatientID, MedicalRecordNumber,
               p.FirstName || ' ' || p.LastName as PatientName, InvoiceDate, DueDate, InvoiceStatus,
               amount::decimal(28,2) as InvoiceAmount, paid::decimal(28,2) as PaidAmount,
               (amount - paid)::decimal(29,2) as OutstandingAmount,
               case when amount <= paid then 'Paid' when DueDate < {AS_OF} then 'Overdue'
                    when paid > 0 then 'Partially Paid' else 'Open' end as DerivedPaymentStatus,
               case when amount <= paid then 0 when DueDate >= {AS_OF} then 0
                    else ({AS_OF} - DueDate) end::integer as DaysPastDue,
               IsFinancialAssistanceEligible
        from t join billing_patientaccount ac on ac.PatientAccountID = t.PatientAccountID
        join clinical_patient p on p.PatientID = t.PatientID""",
    "v08": f"""
        select c.CampaignID, CampaignCode, CampaignName, CampaignType, CampaignObjective, StartDate, EndDate,
               CampaignStatus, c.HospitalID, HospitalName, BudgetAmount, coalesce(s.n, 0) as ChannelCount,
               coalesce(planned, 0)::decimal(28,2) as PlannedSpendAmount, coalesce(actual, 0)::decimal(28,2) as ActualSpendAmount,
               coalesce(i.n, 0) as TotalInteractions, coalesce(reached, 0) as ReachedPatients,
               coalesce(delivered, 0) as DeliveredCount, coalesce(opened, 0) as OpenedCount,
               coalesce(clicked, 0) as ClickedCount, coalesce(converted, 0) as ConvertedCount,
               coalesce(a.n, 0) as AcquiredPatientCount, coalesce(a.cost, 0)::decimal(28,2) as AcquisitionCost,
               {pct('opened', 'delivered')} as OpenRatePercent, {pct('clicked', 'opened')} as ClickThroughRatePercent,
               {pct('converted', 'i.n')} as ConversionRatePercent,
               cast({half_up(cents('coalesce(actual, 0)'), 'converted')} / 100.0 as decimal(18,2)) as CostPerConversion
        from marketing_campaign c
        left join hospital_hospital h on h.HospitalID = c.HospitalID
        left join (select CampaignID, count(*) as n, sum(PlannedSpendAmount) as planned, sum(ActualSpendAmount) as actual
                   from marketing_campaignchannel group by 1) s on s.CampaignID = c.CampaignID
        left join (select CampaignID, count(*) as n, count(distinct PatientID) as reached,
                          {tally("InteractionType = 'Delivered'")} as delivered, {tally("InteractionType = 'Opened'")} as opened,
                          {tally("InteractionType = 'Clicked'")} as clicked, {tally("InteractionType = 'Converted'")} as converted
                   from marketing_campaigninteraction group by 1) i on i.CampaignID = c.CampaignID
        left join (select CampaignID, count(*) as n, sum(AcquisitionCost) as cost from marketing_patientacquisition
                   where CampaignID is not null group by 1) a on a.CampaignID = c.CampaignID""",
    "v09": """
        select pr.PredictionID, m.ModelID, ModelCode, ModelName, mv.ModelVersionID, VersionNumber, AlgorithmName,
               PatientID, EncounterID, PredictionDateTimeUTC, PredictionType, PredictedClass, PredictedValue,
               ProbabilityScore, RiskScore, ThresholdUsed, PredictionStatus, PredictionOutcomeID, OutcomeType, ActualClass,
               ActualValue, OutcomeDateTimeUTC, IsFinalOutcome,
               case when PredictionOutcomeID is not null
                    then coalesce((PredictedClass = ActualClass)::integer, 0) end as IsCorrectPrediction,
               case when PredictionOutcomeID is null then null
                    when PredictedClass = 'High Risk' and ActualClass is not null
                    then if(ActualClass = 'High Risk', 'True Positive', 'False Positive')
                    when PredictedClass <> 'High Risk' and ActualClass = 'High Risk' then 'False Negative'
                    else 'True Negative' end as ConfusionMatrixCategory
        from ai_prediction pr join ai_modelversion mv on mv.ModelVersionID = pr.ModelVersionID
        join ai_model m on m.ModelID = mv.ModelID
        left join ai_predictionoutcome po on po.PredictionID = pr.PredictionID and po.IsFinalOutcome""",
    "v10": f"""
        select h.HospitalID, HospitalCode, HospitalName, HospitalType, NumberOfBeds, IsTeachingHospital,
               HasEmergencyDepartment, coalesce(pm.n, 0) as ActiveProviderCount, coalesce(em.n, 0) as TotalEncounters,
               coalesce(patients, 0) as UniquePatients, coalesce(tele, 0) as TelehealthEncounters,
               coalesce(emer, 0) as EmergencyEncounters, stay as AverageEncounterDurationMinutes,
               coalesce(cm.n, 0) as TotalClaims, coalesce(denied, 0) as DeniedClaims,
               {pct('denied', 'cm.n')} as ClaimDenialRatePercent, {money('coalesce(charge, 0)')} as TotalChargeAmount,
               {money('coalesce(paid, 0)')} as TotalPaidAmount, {pct('paid', 'charge')} as CollectionRatePercent,
               coalesce(tm.n, 0) as TotalVirtualVisits, coalesce(done, 0) as CompletedVirtualVisits,
               coalesce(absent, 0) as NoShowVirtualVisits, {pct('absent', 'tm.n')} as TelehealthNoShowRatePercent
        from hospital_hospital h
        left join (select HospitalID, count(*) as n, count(distinct PatientID) as patients, {tally('IsTelehealth')} as tele,
                          {tally("EncounterType = 'Emergency'")} as emer, {mean(STAY)} as stay
                   from clinical_encounter group by 1) em on em.HospitalID = h.HospitalID
        left join (select HospitalID, count(*) as n, {tally("ClaimStatus = 'Denied'")} as denied,
                          sum(ChargeAmount) as charge, sum(PaidAmount) as paid
                   from insurance_claim c left join insurance_claimline l on l.ClaimID = c.ClaimID group by 1) cm
               on cm.HospitalID = h.HospitalID
        left join (select HospitalID, count(*) as n, {tally("VisitStatus = 'Completed'")} as done,
                          {tally("VisitStatus = 'No Show'")} as absent
                   from telehealth_virtualvisit group by 1) tm on tm.HospitalID = h.HospitalID
        left join (select HospitalID, count(*) as n from hospital_provider where IsActive group by 1) pm
               on pm.HospitalID = h.HospitalID""",
    "v11": f"""
        select * exclude (one),
               {pct('TelehealthEncounters', 'TotalEncounters')} as TelehealthAdoptionRatePercent,
               {pct('CompletedVirtualVisits', 'TotalVirtualVisits')} as TelehealthCompletionRatePercent,
               {pct('NoShowVirtualVisits', 'TotalVirtualVisits')} as TelehealthNoShowRatePercent,
               {pct('DeniedClaims', 'TotalClaims')} as ClaimDenialRatePercent,
               {pct('TotalPaidAmount', 'TotalChargeAmount')} as CollectionRatePercent,
               {pct('OverdueInvoices', 'TotalInvoices')} as OverdueInvoiceRatePercent,
               {pct('CorrectPredictions', 'PredictionsWithOutcome')} as PredictionAccuracyPercent
        from (select 1 as one, count(*) as TotalEncounters, count(distinct PatientID) as UniquePatients,
                     {tally('IsTelehealth')} as TelehealthEncounters,
                     {tally("EncounterType = 'Emergency'")} as EmergencyEncounters,
                     {mean('LengthOfStayMinutes')} as AverageEncounterDurationMinutes from v02) e
        join (select 1 as one, count(*) as TotalVirtualVisits, sum(IsCompleted)::bigint as CompletedVirtualVisits,
                     sum(IsNoShow)::bigint as NoShowVirtualVisits, sum(IsDisconnected)::bigint as DisconnectedVirtualVisits,
                     {mean('ActualVisitDurationMinutes')} as AverageVirtualVisitMinutes from v04) t using (one)
        join (select 1 as one, count(*) as TotalClaims, sum(IsDeniedClaim)::bigint as DeniedClaims,
                     {money('sum(TotalChargeAmount)')} as TotalChargeAmount, {money('sum(TotalAllowedAmount)')} as TotalAllowedAmount,
                     {money('sum(TotalPaidAmount)')} as TotalPaidAmount,
                     {money('sum(TotalPatientResponsibilityAmount)')} as TotalPatientResponsibilityAmount from v05) c using (one)
        join (select 1 as one, count(*) as TotalInvoices, {money('sum(InvoiceAmount)')} as TotalInvoiceAmount,
                     {money('sum(PaidAmount)')} as TotalInvoicePaidAmount, {money('sum(OutstandingAmount)')} as TotalOutstandingAmount,
                     {tally("DerivedPaymentStatus = 'Overdue'")} as OverdueInvoices from v07) b using (one)
        join (select 1 as one, count(*) as TotalPredictions, count(PredictionOutcomeID) as PredictionsWithOutcome,
                     {tally('IsCorrectPrediction = 1')} as CorrectPredictions from v09) a using (one)""",
    "v12": f"""
        select e.*, coalesce(c.n, 0) as TotalClaims, coalesce(denied, 0) as DeniedClaims,
               {money('coalesce(charge, 0)')} as TotalChargeAmount, {money('coalesce(paid, 0)')} as TotalPaidAmount,
               {pct('denied', 'c.n')} as ClaimDenialRatePercent, {pct('paid', 'charge')} as CollectionRatePercent,
               coalesce(t.n, 0) as TotalVirtualVisits, coalesce(done, 0) as CompletedVirtualVisits,
               coalesce(absent, 0) as NoShowVirtualVisits, {pct('absent', 't.n')} as TelehealthNoShowRatePercent
        from (select {month('AdmissionDateTimeUTC')} as KPI_Month, HospitalID, HospitalName, count(*) as TotalEncounters,
                     count(distinct PatientID) as UniquePatients, {tally('IsTelehealth')} as TelehealthEncounters,
                     {tally("EncounterType = 'Emergency'")} as EmergencyEncounters,
                     {mean('LengthOfStayMinutes')} as AverageEncounterDurationMinutes
              from v02 group by 1, 2, 3) e
        left join (select {month('ServiceStartDate')} as mon, HospitalID, count(*) as n, sum(IsDeniedClaim)::bigint as denied,
                          sum(TotalChargeAmount) as charge, sum(TotalPaidAmount) as paid from v05 group by 1, 2) c
               on c.mon = e.KPI_Month and c.HospitalID = e.HospitalID
        left join (select {month('ScheduledStartDateTimeUTC')} as mon, HospitalID, count(*) as n,
                          sum(IsCompleted)::bigint as done, sum(IsNoShow)::bigint as absent from v04 group by 1, 2) t
               on t.mon = e.KPI_Month and t.HospitalID = e.HospitalID""",
    "v13": f"""
        select e.*, coalesce(n, 0) as TotalClaims, coalesce(denied, 0) as DeniedClaims,
               {money('coalesce(charge, 0)')} as TotalChargeAmount, {money('coalesce(paid, 0)')} as TotalPaidAmount,
               {pct('denied', 'n')} as ClaimDenialRatePercent,
               cast({half_up(cents('coalesce(paid, 0)'), 'TotalEncounters')} / 100.0 as decimal(18,2)) as PaidAmountPerEncounter
        from (select ProviderID, ProviderCode, ProviderName, ProviderType, HospitalID, HospitalName, DepartmentID,
                     DepartmentName, count(*) as TotalEncounters, count(distinct PatientID) as UniquePatients,
                     {tally('IsTelehealth')} as TelehealthEncounters, {tally("EncounterType = 'Emergency'")} as EmergencyEncounters,
                     {mean('LengthOfStayMinutes')} as AverageEncounterDurationMinutes,
                     sum(DiagnosisCount)::bigint as TotalDiagnosesDocumented,
                     sum(ProcedureCount)::bigint as TotalProceduresDocumented,
                     sum(MedicationOrderCount)::bigint as TotalMedicationOrders
              from v02 group by 1, 2, 3, 4, 5, 6, 7, 8) e
        left join (select ProviderID as pid, count(*) as n, sum(IsDeniedClaim)::bigint as denied,
                          sum(TotalChargeAmount) as charge, sum(TotalPaidAmount) as paid from v05 group by 1) c on pid = e.ProviderID""",
    "v14": f"""
        select {month('ScheduledStartDateTimeUTC')} as KPI_Month, HospitalID, HospitalName, DepartmentID, DepartmentName,
               PlatformName, PatientDeviceType, count(*) as TotalVirtualVisits, sum(IsCompleted)::bigint as CompletedVisits,
               sum(IsNoShow)::bigint as NoShowVisits, sum(IsDisconnected)::bigint as DisconnectedVisits,
               {mean('PatientJoinDelayMinutes')} as AveragePatientJoinDelayMinutes,
               {mean('ProviderJoinDelayMinutes')} as AverageProviderJoinDelayMinutes,
               {mean('ActualVisitDurationMinutes')} as AverageVisitDurationMinutes,
               sum(TechnicalErrorCount)::bigint as TotalTechnicalErrors,
               {tally('IsInterpreterRequired')} as InterpreterRequiredVisits,
               {pct('sum(IsCompleted)', 'count(*)')} as CompletionRatePercent,
               {pct('sum(IsNoShow)', 'count(*)')} as NoShowRatePercent,
               {pct('sum(IsDisconnected)', 'count(*)')} as DisconnectionRatePercent
        from v04 group by 1, 2, 3, 4, 5, 6, 7""",
    "v15": f"""
        select c.*, {pct('DeniedClaims', 'TotalClaims')} as ClaimDenialRatePercent,
               {pct('InsurancePaidAmount', 'TotalChargeAmount')} as InsuranceCollectionRatePercent,
               coalesce(n, 0) as TotalInvoices, {money('coalesce(amount, 0)')} as TotalInvoiceAmount,
               {money('coalesce(paid, 0)')} as PatientPaidAmount, {money('coalesce(owed, 0)')} as OutstandingAmount,
               coalesce(late, 0) as OverdueInvoices, {pct('late', 'n')} as OverdueInvoiceRatePercent,
               {money('InsurancePaidAmount + coalesce(paid, 0)')} as TotalCollectedAmount
        from (select {month('ServiceStartDate')} as KPI_Month, count(*) as TotalClaims, sum(IsDeniedClaim)::bigint as DeniedClaims,
                     {money('sum(TotalChargeAmount)')} as TotalChargeAmount, {money('sum(TotalAllowedAmount)')} as TotalAllowedAmount,
                     {money('sum(TotalPaidAmount)')} as InsurancePaidAmount,
                     {money('sum(TotalPatientResponsibilityAmount)')} as PatientResponsibilityAmount,
                     {mean('SubmissionLagDays')} as AverageSubmissionLagDays, {mean('AdjudicationDays')} as AverageAdjudicationDays
              from v05 group by 1) c
        left join (select {month('InvoiceDate')} as mon, count(*) as n, sum(InvoiceAmount) as amount, sum(PaidAmount) as paid,
                          sum(OutstandingAmount) as owed, {tally("DerivedPaymentStatus = 'Overdue'")} as late
                   from v07 group by 1) i on mon = KPI_Month""",
    "v16": f"""
        select *, {pct('DeniedClaims', 'TotalClaims')} as DenialRatePercent,
               {pct('DeniedChargeAmount', 'TotalChargeAmount')} as DeniedChargeRatePercent
        from (select {month('ServiceStartDate')} as KPI_Month, HospitalName, PayerName, PlanName, ClaimType,
                     PrimaryDenialReasonCode, count(*) as TotalClaims, sum(IsDeniedClaim)::bigint as DeniedClaims,
                     {money('sum(v06.TotalChargeAmount)')} as TotalChargeAmount,
                     {money('coalesce(sum(v06.TotalChargeAmount) filter (where IsDeniedClaim = 1), 0)')} as DeniedChargeAmount,
                     {money('sum(v06.TotalPaidAmount)')} as TotalPaidAmount
              from v06 group by 1, 2, 3, 4, 5, 6)""",
    "v17": """
        select p.PatientID, MedicalRecordNumber, FirstName, LastName, AgeYears, Gender, City, StateProvince, TotalEncounters,
               TelehealthEncounters, EmergencyEncounters, TotalDiagnoses, DistinctDiagnosisCount, TotalBilledAmount,
               TotalPaidAmount, EstimatedOutstandingAmount, ModelName, PredictedClass as LatestPredictedClass,
               ProbabilityScore as LatestProbabilityScore, RiskScore as LatestRiskScore,
               PredictionDateTimeUTC as LatestPredictionDateUTC,
               case when PredictedClass = 'High Risk' then 'High'
                    when EmergencyEncounters >= 2 or DistinctDiagnosisCount >= 5 then 'Medium' else 'Low' end as DerivedPatientRiskTier,
               coalesce((PredictedClass = 'High Risk' or EmergencyEncounters >= 2 or DistinctDiagnosisCount >= 5)::integer, 0) as NeedsCareManagementReview
        from v01 p
        left join (select * from v09
                   qualify row_number() over (partition by PatientID order by PredictionDateTimeUTC desc nulls last, PredictionID desc) = 1) l
               on l.PatientID = p.PatientID""",
    "v18": f"""
        with t as (
            select ModelID, ModelCode, ModelName, ModelVersionID, VersionNumber, AlgorithmName, count(*) as TotalPredictions,
                   count(PredictionOutcomeID) as PredictionsWithOutcome, {tally('IsCorrectPrediction = 1')} as CorrectPredictions,
                   {tally("ConfusionMatrixCategory = 'True Positive'")} as TruePositives,
                   {tally("ConfusionMatrixCategory = 'False Positive'")} as FalsePositives,
                   {tally("ConfusionMatrixCategory = 'True Negative'")} as TrueNegatives,
                   {tally("ConfusionMatrixCategory = 'False Negative'")} as FalseNegatives,
                   {mean_micro('ProbabilityScore', 18, 8)} as AverageProbabilityScore,
                   {mean_micro('RiskScore', 18, 6)} as AverageRiskScore
            from v09 group by 1, 2, 3, 4, 5, 6)
        select *, {pct('CorrectPredictions', 'PredictionsWithOutcome')} as AccuracyPercent,
               {pct('TruePositives', '(TruePositives + FalsePositives)')} as PrecisionPercent,
               {pct('TruePositives', '(TruePositives + FalseNegatives)')} as RecallPercent
        from t""",
}
