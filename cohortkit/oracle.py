"""Independent DuckDB SQL for every registered query (the correctness oracle).

This is a second, separate implementation of the cohort rules written
directly in DuckDB SQL over the fixture text: ordinary ``PARTITION BY``
windows, the literal five-part in-care test, the cascade as successive
overwrites, and so on. It shares only the fixture text and the output names
with the Spark code. Differences between the engines are handled here:
DuckDB's ``CAST(double AS INT)`` rounds (so ``trunc`` first), date
subtraction is BIGINT, ``floor`` is DOUBLE and ``row_number`` is BIGINT.
"""

from __future__ import annotations

from cohortkit import vocab
from cohortkit.sources.fixture import OTHER_MAPPED, fixture_sql

RP = "DATE '2024-03-13'"

# fixture column -> output spelling
CANONICAL = {
    "patientid": "PatientID", "source": "source", "artnumber": "ARTNumber", "nupn": "NUPN",
    "owningguid": "OwningGuid", "patient_guid": "patient_guid", "firstname": "FirstName",
    "lastname": "LastName", "facilityname": "FacilityName", "artfacilityname": "ArtFacilityName",
    "sex": "Sex", "dob": "DOB", "artstartdate": "ARTStartDate", "hivtestdate": "HivTestDate",
    "lastinteraction_date": "Lastinteraction_date",
    "firstinteraction_date": "FirstInteraction_date",
    "nextappointmentdate": "NextAppointmentDate",
    "currentartregimendispensationdate": "CurrentARTRegimenDispensationDate",
    "patient_status": "Patient_status", "patient_status_date": "Patient_status_date",
    "ancvisitdate": "ANCVisitDate", "estimateddateofdelivery": "EstimatedDateOfDelivery",
    "current_vl_date": "Current_VL_date", "current_vl_copies": "Current_VL_copies",
    "baseline_cd4": "baseline_cd4", "baseline_cd4_perc": "baseline_cd4_perc",
    "patientheight": "patientheight", "patientweight": "patientweight",
    "hivtestresults": "HIVTestResults", "currentartregimen": "CurrentARTRegimen",
    "dsdmodel": "DSDModel", "current_cd4_countdate": "Current_CD4_countDate",
    "prescriptiondate": "Prescriptiondate",
}

# the mapped columns no rule reads, under their mapped names
OTHERS = {c.lower(): c for c in vocab.COLUMN_MAPPING if c.lower() in OTHER_MAPPED}
CANONICAL.update(OTHERS)

# configured spelling of each parsed date column (fixture name -> output name)
DATES = [
    ("dob", "DOB"), ("hivtestdate", "HivTestDate"), ("artstartdate", "ARTStartDate"),
    ("currentartregimendispensationdate", "CurrentARTRegimenDispensationDate"),
    ("current_cd4_countdate", "Current_CD4_countdate"), ("current_vl_date", "Current_VL_date"),
    ("patient_status_date", "Patient_status_date"), ("ancvisitdate", "ANCVisitDate"),
    ("firstinteraction_date", "FirstInteraction_date"),
    ("lastinteraction_date", "LastInteraction_date"),
    ("nextappointmentdate", "NextAppointmentDate"), ("prescriptiondate", "Prescriptiondate"),
    ("estimateddateofdelivery", "estimateddateofdelivery"), ("report_period", "report_period"),
]


def _int(x: str) -> str:
    """Text as INT the way Spark's implicit cast truncates it (a lone point is 0)."""
    return (f"(CASE WHEN regexp_matches({x}, '^\\s*[+-]?(\\d+\\.?\\d*|\\.\\d*)\\s*$') "
            f"THEN (CASE WHEN TRY_CAST({x} AS DOUBLE) IS NULL THEN 0 "
            f"ELSE TRY_CAST(trunc(TRY_CAST({x} AS DOUBLE)) AS INTEGER) END) END)")


def _dbl(x: str) -> str:
    return f"TRY_CAST({x} AS DOUBLE)"


def _date(x: str) -> str:
    """Legacy yyyy-MM-dd reading: digit runs of any length, blanks/tabs before
    a field, trailing text ignored, out-of-range fields give NULL."""
    pat = "'^[ \\t]*(\\d+)-[ \\t]*(\\d+)-[ \\t]*(\\d+)'"
    y, m, d = (f"TRY_CAST(regexp_extract({x}, {pat}, {i}) AS INTEGER)" for i in (1, 2, 3))
    return (f"(CASE WHEN {y} BETWEEN 1 AND 294247 AND {m} BETWEEN 1 AND 12 THEN "
            f"(CASE WHEN {d} BETWEEN 1 AND day(last_day(make_date({y}, {m}, 1))) "
            f"THEN make_date({y}, {m}, {d}) END) END)")


def _days(a: str, b: str) -> str:
    return f"CAST(({a} - {b}) AS INTEGER)"


def _years(later: str, earlier: str) -> str:
    def ymd(d):
        return f"(year({d}) * 10000 + month({d}) * 100 + day({d}))"
    return (f"(CASE WHEN year({later}) <= 9999 AND year({earlier}) <= 9999 THEN "
            f"CAST(trunc(({ymd(later)} - {ymd(earlier)}) / 10000.0) AS INTEGER) END)")


def _age_group(a: str) -> str:
    return (f"CASE WHEN {a} > 0 AND {a} <= 0.999 THEN '0<1' "
            f"WHEN {a} >= 1 AND {a} <= 4 THEN '1-4' "
            f"WHEN {a} >= 5 AND {a} <= 9 THEN '5-9' "
            f"WHEN {a} >= 10 AND {a} <= 14 THEN '10-14' "
            f"WHEN {a} >= 15 AND {a} <= 19 THEN '15-19' "
            f"WHEN {a} >= 20 AND {a} <= 24 THEN '20-24' "
            f"WHEN {a} >= 25 AND {a} <= 29 THEN '25-29' "
            f"WHEN {a} >= 30 AND {a} <= 34 THEN '30-34' "
            f"WHEN {a} >= 35 AND {a} <= 39 THEN '35-39' "
            f"WHEN {a} >= 40 AND {a} <= 44 THEN '40-44' "
            f"WHEN {a} >= 45 AND {a} <= 49 THEN '45-49' "
            f"WHEN {a} >= 50 AND {a} <= 54 THEN '50-54' "
            f"WHEN {a} >= 55 AND {a} <= 59 THEN '55-59' "
            f"WHEN {a} >= 60 AND {a} <= 64 THEN '60-64' "
            f"WHEN {a} >= 65 THEN '65+' WHEN {a} >= -50 AND {a} <= -1 THEN 'BIF' END")


def _art_cohort(m: str) -> str:
    return (f"CASE "
            f"WHEN {m} BETWEEN 0 AND 3 THEN '(0<3)' "
            f"WHEN {m} BETWEEN 4 AND 6 THEN '(4-6)' "
            f"WHEN {m} BETWEEN 7 AND 12 THEN '(7-12)' "
            f"WHEN {m} BETWEEN 13 AND 24 THEN '(13-24)' "
            f"WHEN {m} BETWEEN 25 AND 36 THEN '(25-36)' "
            f"WHEN {m} BETWEEN 37 AND 48 THEN '(37-48)' "
            f"WHEN {m} BETWEEN 49 AND 60 THEN '(49-60)' "
            f"WHEN {m} BETWEEN 61 AND 72 THEN '(61-72)' "
            f"WHEN {m} BETWEEN 73 AND 84 THEN '(73-84)' "
            f"WHEN {m} BETWEEN 85 AND 96 THEN '(85-96)' "
            f"WHEN {m} BETWEEN 97 AND 108 THEN '(97-108)' "
            f"WHEN {m} BETWEEN 109 AND 120 THEN '(109-120)' "
            f"WHEN {m} BETWEEN 121 AND 132 THEN '(121-132)' "
            f"WHEN {m} BETWEEN 133 AND 144 THEN '(133-144)' "
            f"ELSE '(145+)' END")


def _quarter(m: str) -> str:
    return (f"CASE WHEN {m} IN ('October','November','December') THEN 'Q1' "
            f"WHEN {m} IN ('January','February','March') THEN 'Q2' "
            f"WHEN {m} IN ('April','May','June') THEN 'Q3' "
            f"WHEN {m} IN ('July','August','September') THEN 'Q4' END")


# The five OR-ed groups exactly as the rule states them (not simplified).
IN_CARE = ("((dm <= 30 OR da <= 30 OR dd <= 30) "
           "OR (dd IS NULL AND (da <= 90 OR dm IS NULL)) "
           "OR (dd IS NULL AND (da <= 90 OR dm <= 30)) "
           "OR (dm IS NULL AND (da <= 90 OR dd IS NULL)) "
           "OR (dm IS NULL AND (da <= 90 OR dd <= 90)))")


def chain_sql() -> str:
    """CTEs ``fx`` ... ``k``; ``k`` holds every derived column (DuckDB names, any case)."""
    parse = ", ".join(f"{_date(f)} AS {f}" for f, _ in DATES if f != "report_period")
    parts = ", ".join(
        f"dayname({f}) AS {f}_day, monthname({f}) AS {f}_month, "
        f"CAST(year({f}) AS INTEGER) AS {f}_year" for f, _ in DATES)
    return f"""
WITH fx AS ({fixture_sql()}),
p AS (SELECT * REPLACE ({parse}), {RP} AS report_period FROM fx),
a AS (
  SELECT p.*, {parts},
    TRY_CAST(patientheight AS DOUBLE) / 100.0 AS height_m,
    CASE WHEN hivtestresults <> 'Positive' AND hivtestresults <> 'Negative' THEN 'Missing'
         ELSE hivtestresults END AS hivtest_results_r,
    CASE WHEN sex = 'F' THEN 'Female' WHEN sex = 'M' THEN 'Male' ELSE '99' END AS sex_r,
    CASE WHEN ancvisitdate IS NOT NULL THEN 'Yes' ELSE 'No' END AS pmtct_tx,
    CASE WHEN artnumber IS NOT NULL OR artstartdate IS NOT NULL OR currentartregimen IS NOT NULL
         THEN 'Yes' ELSE 'No' END AS onart,
    {_years('artstartdate', 'dob')} AS age_at_art_initiation,
    {_years('firstinteraction_date', 'dob')} AS age_at_first_visit,
    {_years(RP, 'dob')} AS current_age,
    {_int('patientweight')} AS w_int, {_dbl('patientweight')} AS w_dbl,
    {_int('baseline_cd4')} AS cd4_int, {_int('baseline_cd4_perc')} AS cd4p_int,
    {_int('current_vl_copies')} AS vl_int
  FROM p),
b AS (
  SELECT a.*,
    CASE WHEN height_m IS NULL OR w_dbl IS NULL OR height_m * height_m = 0 THEN NULL
         ELSE format('{{:,.1f}}', w_dbl / (height_m * height_m)) END AS bmi_txt,
    {_age_group('age_at_art_initiation')} AS age_group_r,
    CASE WHEN w_int >= 0 AND w_dbl <= 2.999 THEN '0<3' WHEN w_int >= 3 AND w_dbl <= 5.99 THEN '3-5.9'
         WHEN w_int >= 6 AND w_dbl <= 9.99 THEN '6-9.9' WHEN w_int >= 10 AND w_dbl <= 19.99 THEN '10-19.9'
         WHEN w_int >= 20 AND w_dbl <= 29.99 THEN '20-29.9' WHEN w_int >= 30 THEN '30+' END AS weight_cat,
    {_days('artstartdate', 'hivtestdate')} AS link_days,
    CAST(floor({_days('report_period', 'artstartdate')} / 30.437) AS BIGINT) AS months_art,
    {_quarter('artstartdate_month')} AS art_start_quart,
    {_quarter('report_period_month')} AS reporting_quarter,
    CASE WHEN cd4_int <= 50 THEN '<=50' WHEN cd4_int > 50 AND cd4_int <= 200 THEN '51-200'
         WHEN cd4_int > 200 AND cd4_int <= 350 THEN '201-350' WHEN cd4_int > 350 AND cd4_int <= 500 THEN '351-500'
         WHEN cd4_int > 500 AND cd4_int <= 1000 THEN '501-1000' WHEN cd4_int > 1000 THEN '>1000' END AS cd4_grp,
    CASE WHEN cd4p_int < 15 THEN '<15%' WHEN cd4p_int >= 15 AND cd4p_int <= 24 THEN '15-24%'
         ELSE '>=25%' END AS cd4_perc_grp
  FROM a),
c AS (
  SELECT b.*,
    CASE WHEN TRY_CAST(bmi_txt AS DOUBLE) < 18.5 THEN '<18.5'
         WHEN TRY_CAST(bmi_txt AS DOUBLE) >= 18.5 AND {_int('bmi_txt')} < 25 THEN '18.5-24.9'
         WHEN {_int('bmi_txt')} >= 25 AND {_int('bmi_txt')} < 30 THEN '25-29.9'
         WHEN {_int('bmi_txt')} >= 30 AND {_int('bmi_txt')} < 35 THEN '30-34.9'
         WHEN {_int('bmi_txt')} >= 35 AND {_int('bmi_txt')} < 40 THEN '35-39.9'
         WHEN {_int('bmi_txt')} >= 40 THEN '40+' END AS bmi_cat,
    CASE WHEN link_days BETWEEN 0 AND 7 THEN '<7' WHEN link_days BETWEEN 8 AND 14 THEN '8-14'
         WHEN link_days BETWEEN 15 AND 30 THEN '15-30' WHEN link_days BETWEEN 31 AND 90 THEN '31-90'
         WHEN link_days >= 90 THEN '90+' END AS linkage,
    {_art_cohort('months_art')} AS art_cohort,
    CASE WHEN (months_art >= 6 AND ancvisitdate IS NULL)
           OR (months_art >= 3 AND ancvisitdate IS NOT NULL)
           OR ({_days('report_period', 'estimateddateofdelivery')} / 30.437 <= 27)
         THEN 'Yes' ELSE 'No' END AS vl_elig,
    MIN(lastinteraction_date) OVER (PARTITION BY artnumber, dob, sex_r, current_age, artstartdate,
                                    lastinteraction_date) AS old_visit,
    MAX(lastinteraction_date) OVER (PARTITION BY artnumber, dob, sex_r, current_age, artstartdate,
                                    lastinteraction_date) AS new_visit
  FROM b),
d AS (
  SELECT c.*,
    {_days('new_visit', 'lastinteraction_date')} AS visit_diff_days,
    {_days('report_period', 'nextappointmentdate')} AS dm,
    {_days('report_period', 'new_visit')} AS da,
    {_days('report_period', 'currentartregimendispensationdate')} AS dd
  FROM c),
s AS (
  SELECT d.*, {IN_CARE} AS in_care_v,
    CASE WHEN (patient_status IS NULL
               OR (patient_status IN ('died','stoppedART','reactivated','made_inactive','transout')
                   AND (patient_status_date < lastinteraction_date OR patient_status_date IS NULL)))
              AND {IN_CARE} THEN 'Active'
         WHEN patient_status = 'died' AND patient_status_date >= lastinteraction_date THEN 'Died'
         WHEN patient_status = 'reactived' AND patient_status_date >= lastinteraction_date THEN 'Reactivated'
         WHEN patient_status = 'stoppedART' AND patient_status_date >= lastinteraction_date THEN 'Stopped ART'
         WHEN patient_status = 'transout' AND patient_status_date >= lastinteraction_date THEN 'Transferred-out'
         WHEN patient_status = 'made_inative' AND patient_status_date >= lastinteraction_date THEN 'Made_inactive'
    END AS status_r
  FROM d),
o AS (
  SELECT s.*,
    CASE WHEN status_r = 'Active'
           OR ((status_r = 'Reactivated' OR status_r = 'Transferred-out') AND {IN_CARE})
         THEN 'retention in care' ELSE 'attrition' END AS outcome
  FROM s),
i1 AS (
  SELECT o.*,
    CASE WHEN outcome = 'retention in care' AND patient_status_date IS NOT NULL THEN 'Active on ART'
         WHEN outcome = 'retention in care' AND patient_status_date < lastinteraction_date THEN 'TX_RTT'
         WHEN outcome = 'attrition'
              OR ((status_r IN ('Died','Stopped ART','Transferred-out','Made_inactive') OR status_r IS NULL)
                  AND patient_status_date < lastinteraction_date) THEN 'TX_ML'
         WHEN outcome = 'attrition' AND status_r = 'Transferred-out' AND {IN_CARE} THEN 'IIT'
         WHEN outcome = 'retention in care' AND art_start_quart = reporting_quarter
              AND artstartdate_year = report_period_year THEN 'NET_NEW'
    END AS outcome_1,
    CASE WHEN outcome = 'retention in care' AND vl_elig = 'Yes'
              AND {_days('report_period', 'current_vl_date')} / 30.437 <= 12
         THEN 'Yes' ELSE 'No' END AS vl_coverage,
    CASE WHEN vl_int < 1000 THEN '(<1000)' WHEN vl_int >= 1000 AND vl_int <= 2500 THEN '(1000-2500)'
         WHEN vl_int > 2500 THEN '(>2500)' END AS vl_category,
    CASE WHEN status_r = 'Died' THEN 'Died'
         WHEN outcome = 'attrition' AND months_art < 3 AND NOT (status_r IN ('Died','Stopped ART'))
           THEN 'IIT <3 months TX'
         WHEN outcome = 'attrition' AND months_art >= 3 AND NOT (status_r IN ('Died','Stopped ART'))
           THEN 'IIT 3>= months TX'
         WHEN outcome = 'attrition' AND status_r = 'Stopped ART' THEN 'Stopped TX'
         WHEN outcome = 'retention in care' THEN 'TX_CURR' END AS tx_ml,
    CASE WHEN artfacilityname <> facilityname AND artfacilityname <> '' AND facilityname <> ''
              AND status_r <> 'Transferred-out' THEN 'Yes' ELSE 'No' END AS silent_transfer,
    CAST(trunc(CASE WHEN nextappointmentdate IS NOT NULL AND currentartregimendispensationdate IS NOT NULL
                    THEN {_days('nextappointmentdate', 'currentartregimendispensationdate')} / 30.44
                    WHEN currentartregimendispensationdate IS NULL
                    THEN {_days('nextappointmentdate', 'lastinteraction_date')} / 30.44 END)
         AS INTEGER) AS mmd_mo,
    CASE WHEN dsdmodel = 'Multi Month Scriptiing ' THEN 'Multi Month Scriptiing' ELSE dsdmodel END AS dsd_new
  FROM o),
h1 AS (SELECT i1.*, CASE WHEN onart = 'Yes' AND hivtest_results_r IN ('Positive','Negative','Missing')
                         THEN 'HIV positive' END AS hc1 FROM i1),
h2 AS (SELECT h1.*, CASE WHEN onart = 'Yes' AND outcome = 'retention in care' THEN 'Actively on ART'
                         ELSE hc1 END AS hc2 FROM h1),
h3 AS (SELECT h2.*, CASE WHEN onart = 'Yes' AND outcome = 'retention in care' AND vl_elig = 'Yes'
                         THEN 'VL eligible' ELSE hc2 END AS hc3 FROM h2),
h4 AS (SELECT h3.*, CASE WHEN onart = 'Yes' AND outcome = 'retention in care' AND vl_coverage = 'Yes'
                         THEN 'VL coverage' ELSE hc3 END AS hc4 FROM h3),
i2 AS (
  SELECT h4.*,
    CASE WHEN onart = 'Yes' AND outcome = 'retention in care' AND vl_coverage = 'Yes'
              AND vl_category = '(<1000)' THEN 'VL suppression' ELSE hc4 END AS hiv_cascade,
    CASE WHEN lastinteraction_date = artstartdate AND silent_transfer = 'Yes' THEN 'Yes' ELSE 'No'
    END AS re_initiated,
    CASE WHEN mmd_mo > 0 AND mmd_mo < 3 THEN '<3MMD' WHEN mmd_mo >= 3 AND mmd_mo <= 5 THEN '3-5MMD'
         WHEN mmd_mo = 6 THEN '6MMD' WHEN mmd_mo >= 7 AND mmd_mo <= 11 THEN '7-11MMD'
         WHEN mmd_mo >= 12 THEN '12+MMD' END AS mmd_type,
    CASE dsd_new WHEN 'Community ART Distribution Points' THEN 1 WHEN 'Community Adherance Groups' THEN 2
         WHEN 'Fast Track' THEN 3 WHEN 'Health Post' THEN 4 WHEN 'Mobile ART distritbution model' THEN 5
         WHEN 'Multi Month Scriptiing' THEN 6 WHEN 'Rural Adherance Group' THEN 7
         WHEN 'Urban Adherance Group' THEN 8 END AS dsd_code
  FROM h4),
k AS (
  SELECT i2.*,
    CAST(ROW_NUMBER() OVER (PARTITION BY owningguid, dob, sex_r, current_age, artstartdate
                            ORDER BY patientid) AS INTEGER) AS rn_guid,
    CAST(ROW_NUMBER() OVER (PARTITION BY owningguid, dob, sex_r, current_age, artstartdate,
                                         firstname, lastname ORDER BY patientid) AS INTEGER) AS rn_guid_name,
    CAST(ROW_NUMBER() OVER (PARTITION BY artnumber, dob, sex_r, current_age, artstartdate
                            ORDER BY patientid) AS INTEGER) AS rn_art,
    CAST(ROW_NUMBER() OVER (PARTITION BY nupn, dob, sex_r, current_age, artstartdate
                            ORDER BY patientid) AS INTEGER) AS rn_nupn
  FROM i2)"""


def _flag(rn: str) -> str:
    return f"CAST(({rn} = 1) AS INTEGER)"


def _unique(rn: str) -> str:
    return f"CASE WHEN {rn} = 1 THEN 'Unique' ELSE 'Duplicate' END"


# output name -> DuckDB expression over CTE ``k``
OUTPUTS: dict[str, str] = {}
OUTPUTS.update({f"{out}": f for f, out in DATES})
OUTPUTS.update({f"{out}_{part}": f"{f}_{part}" for f, out in DATES for part in ("day", "month", "year")})
OUTPUTS.update({
    "patientheight": "height_m",
    "BMI": "bmi_txt",
    "HIVtest_results": "hivtest_results_r",
    "sex": "sex_r",
    "PMTCT_TX": "pmtct_tx",
    "OnART": "onart",
    "age_at_art_initiation": "age_at_art_initiation",
    "age_at_first_visit": "age_at_first_visit",
    "current_age": "current_age",
    "age_groupt_Art_initiation": "age_group_r",
    "weight_category": "weight_cat",
    "BMI_category": "bmi_cat",
    "linkage_to_care_category": "linkage",
    "months_since_art_start": "months_art",
    "ART_cohort": "art_cohort",
    "ART_start_quart": "art_start_quart",
    "reporting_quarter": "reporting_quarter",
    "VL_eligibility": "vl_elig",
    "basecd4group": "cd4_grp",
    "basecd4_perc": "cd4_perc_grp",
    "old_visit": "old_visit",
    "new_visit": "new_visit",
    "visit_diff_days": "visit_diff_days",
    "Days_missed": "dm",
    "Days_Away": "da",
    "Days_Away_Dispense": "dd",
    "in_care": "in_care_v",
    "patient_status": "status_r",
    "outcome": "outcome",
    "outcome_1": "outcome_1",
    "VL_coverage": "vl_coverage",
    "VL_category": "vl_category",
    "hiv_cascade": "hiv_cascade",
    "TX_ML": "tx_ml",
    "silent_transfer": "silent_transfer",
    "re_initiated": "re_initiated",
    "MMD_proxy_Mo": "mmd_mo",
    "MMD_type": "mmd_type",
    "DSD_new": "dsd_new",
    "MMS": ("CASE WHEN mmd_mo = 6 OR dsd_code = 6 THEN 'MMS6' WHEN mmd_mo = 3 OR dsd_code = 3 THEN 'MMS3' "
            "WHEN dsd_code = 1 THEN 'Community ART Distribution Points' "
            "WHEN dsd_code = 2 THEN 'Community Adherance Groups' WHEN dsd_code = 3 THEN 'Fast Track' "
            "WHEN dsd_code = 4 THEN 'Health Post' WHEN dsd_code = 5 THEN 'Mobile ART distritbution model' "
            "WHEN dsd_code = 7 THEN 'Rural Adherance Group' WHEN dsd_code = 8 THEN 'Urban Adherance Group' END"),
    "_patient_guid": "CAST(patient_guid AS VARCHAR)",
    "pt_GUID": "owningguid",
    "distinct_guid": _flag("rn_guid"),
    "distinct_GUID": _flag("rn_guid_name"),
    "distinct_ART": _flag("rn_art"),
    "distinct_NUPN": _flag("rn_nupn"),
    "distinct_GUID_n": _flag("rn_guid"),
    "distinct_GUID_label": _unique("rn_guid_name"),
    "distinct_ART_label": _unique("rn_art"),
    "distinct_NUPN_label": _unique("rn_nupn"),
    "Pt_GUID_dups": "CAST(rn_guid_name - 1 AS INTEGER)",
    "Pt_GUID_dups_label": ("CASE rn_guid_name - 1 WHEN 0 THEN 'No duplicate' WHEN 1 THEN 'Duplicated once' "
                           "WHEN 2 THEN 'Duplicated twice' WHEN 3 THEN 'Duplicated thrice' END"),
})

# Raw text columns that pass through the derivation unchanged.
PASS_THROUGH = {
    "PatientID": "patientid", "source": "source", "ARTNumber": "artnumber", "NUPN": "nupn",
    "OwningGuid": "owningguid", "patient_guid": "patient_guid", "FirstName": "firstname",
    "LastName": "lastname", "FacilityName": "facilityname", "ArtFacilityName": "artfacilityname",
    "Current_VL_copies": "current_vl_copies", "baseline_cd4": "baseline_cd4",
    "baseline_cd4_perc": "baseline_cd4_perc", "patientweight": "patientweight",
    "HIVTestResults": "hivtestresults", "CurrentARTRegimen": "currentartregimen",
    "DSDModel": "dsdmodel",
}

PASS_THROUGH.update({c: f for f, c in OTHERS.items() if f != "bmi"})  # the rule's BMI replaces the extract's

# Every column of the finished frame, in no particular order.
PIPELINE_COLUMNS = (list(PASS_THROUGH) + [o for _, o in DATES]
                    + [f"{o}_{p}" for _, o in DATES for p in ("day", "month", "year")]
                    + ["patientheight", "sex", "patient_status", "BMI", "HIVtest_results",
                       "PMTCT_TX", "OnART", "age_at_art_initiation", "age_at_first_visit",
                       "current_age", "age_groupt_Art_initiation", "weight_category",
                       "BMI_category", "linkage_to_care_category", "months_since_art_start",
                       "ART_start_quart", "reporting_quarter", "basecd4group", "basecd4_perc",
                       "ART_cohort", "VL_eligibility", "old_visit", "new_visit",
                       "visit_diff_days", "Days_missed", "Days_Away", "Days_Away_Dispense",
                       "outcome", "outcome_1", "VL_coverage", "VL_category", "TX_ML",
                       "silent_transfer", "MMD_proxy_Mo", "DSD_new", "hiv_cascade",
                       "re_initiated", "MMD_type", "_patient_guid", "pt_GUID", "distinct_GUID",
                       "distinct_ART", "distinct_NUPN", "distinct_GUID_n", "Pt_GUID_dups",
                       "distinct_GUID_label", "distinct_ART_label", "distinct_NUPN_label",
                       "Pt_GUID_dups_label"])


def select_sql(columns: list[str], id_name: str = "patientid") -> str:
    """``patientid`` plus the named outputs from the full chain."""
    exprs = [f"patientid AS {id_name}"] if id_name else []
    for c in columns:
        expr = PASS_THROUGH.get(c) or OUTPUTS[c]
        exprs.append(f'{expr} AS "{c}"')
    return chain_sql() + "\nSELECT " + ",\n  ".join(exprs) + "\nFROM k"


def cohort_frame_sql() -> str:
    return select_sql(PIPELINE_COLUMNS, id_name="")


def harmonised_sql(where: str | None = None, with_source: bool = True,
                   via_csv: bool = False) -> str:
    """The fixture under canonical names (what harmonisation must produce).

    ``via_csv``: a header CSV read with default options cannot tell an empty
    field from a missing one, so empty text comes back as NULL.
    """
    def val(f):
        return f"NULLIF({f}, '')" if via_csv and f != "patientid" else f
    cols = [f'{val(f)} AS "{c}"' for f, c in CANONICAL.items() if with_source or f != "source"]
    sql = f"WITH fx AS ({fixture_sql()})\nSELECT " + ", ".join(cols) + "\nFROM fx"
    return sql + (f"\nWHERE {where}" if where else "")


def harmonised_sql_cols(exprs: list[str]) -> str:
    return f"WITH fx AS ({fixture_sql()})\nSELECT " + ", ".join(exprs) + "\nFROM fx"


def ordinal_hot_sql() -> str:
    """Plain row numbers where a third of the rows are one group."""
    return f"""WITH fx AS ({fixture_sql()}),
g AS (SELECT patientid, CASE WHEN patientid % 3 = 0 THEN 'hot' ELSE owningguid END AS hot_guid FROM fx)
SELECT patientid, row_number() OVER (PARTITION BY hot_guid ORDER BY patientid) AS ordinal FROM g"""


def visit_patient_sql() -> str:
    """Visit window keyed per patient (the reference key without the visit date)."""
    key = "artnumber, dob, sex_r, current_age, artstartdate"
    return (chain_sql() + f"""
, vp AS (
  SELECT patientid, lastinteraction_date,
    MIN(lastinteraction_date) OVER (PARTITION BY {key}) AS old_v,
    MAX(lastinteraction_date) OVER (PARTITION BY {key}) AS new_v
  FROM k)
SELECT patientid, old_v AS "old_visit", new_v AS "new_visit",
  {_days('new_v', 'lastinteraction_date')} AS "visit_diff_days"
FROM vp""")
