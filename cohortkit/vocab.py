"""Fixed values the outputs must reproduce exactly.

Everything here is data: labels, code words, bounds and names that the
derived columns are defined by. The logic that uses them lives in
``cohortkit.functions``.
"""

from __future__ import annotations

# --- Fixed values: harmonisation map, canonical name -> second-extract name.
# 78 lines in natural order; "OwningGuid" is listed twice with the same target.
COLUMN_MAPPING_LINES: list[tuple[str, str]] = [
    ("PatientID", "patientid"),
    ("ARTNumber", "artnumber"),
    ("NUPN", "nupn"),
    ("FacilityID", "facilityid"),
    ("FirstName", "firstname"),
    ("LastName", "lastname"),
    ("DOB", "dob"),
    ("Age", "age"),
    ("Sex", "sex"),
    ("patient_guid", "mappedguid"),
    ("FacilityName", "facilityname"),
    ("ArtFacilityName", "artfacilityname"),
    ("OwningGuid", "owningguid"),
    ("District", "district"),
    ("Province", "province"),
    ("HivTestDate", "hivtestdate"),
    ("patientheight", "currentpatientheight"),
    ("patientweight", "currentpatientweight"),
    ("Bmi", "currentbmi"),
    ("SystolicPressure", "currentsystolic"),
    ("DiastolicPressure", "currentdiastolic"),
    ("Temperature", "currenttemperature"),
    ("PulseRate", "currentpulse"),
    ("DateOfDeath", "dateofdeath"),
    ("UnderlyingCauseOfDeath", "causeofdeath"),
    ("UnderlyingCauseOfDeathICPC", "causeofdeathicpc2id"),
    ("UnderlyingCauseOfDeathICD", "causeofdeathpathologyaxisid"),
    ("WhereDeathOccured", "placeofdeath"),
    ("HIVTestResults", "hivtestresults"),
    ("WHOStagingBaseline", "whostagingbaseline"),
    ("WHOStagingBaselineDate", "whostagingbaselinedate"),
    ("WHOStagingCurrent", "whostagingcurrent"),
    ("WHOStagingCurrentDate", "whostagingcurrentdate"),
    ("ARTStartDate", "artstartdate"),
    ("ARTRegimenBaseline", "artregimenbaseline"),
    ("Prescription", "prescription"),
    ("Prescriptiondate", "prescriptiondate"),
    ("Creatinine", "creatinine"),
    ("ALT", "alt"),
    ("MalariaRDT", "malariardt"),
    ("MalariaRDTDate", "malariardtdate"),
    ("GlucoseRBS", "rbs"),
    ("UrineDpstkProtein", "proteinuria"),
    ("UrineDpstkProteinDate", "proteinuriadate"),
    ("GeneExpert", "geneexpertmtbrif"),
    ("GeneExpertDate", "geneexpertmtbrifdate"),
    ("TbPatientType", "tbpresent"),
    ("TBInitiatedOnART", "onantitb"),
    ("DotStartDate", "datestartedontbtreatment"),
    ("DoTCompleted", "attcompleted"),
    ("DiabetesMellitus", "diabetes"),
    ("syphilis", "screenedforsyphilis"),
    ("hepatitis", "hepatitisb"),
    ("hepatitisDate", "hepatitisbdate"),
    ("Hypertension", "hypertension"),
    ("CurrentARTRegimen", "currentartregimen"),
    ("CurrentARTRegimenDispensationDate", "currentartregimendispensationdate"),
    ("DispensedDuration", "dispensationduration"),
    ("DSDModel", "dsd"),
    ("OwningGuid", "owningguid"),
    ("Baseline_CD4_countDate", "baseline_cd4_countdate"),
    ("baseline_cd4", "baseline_cd4"),
    ("baseline_cd4_perc", "baseline_cd4_perc"),
    ("Current_CD4_countDate", "current_cd4_countdate"),
    ("current_cd4", "current_cd4"),
    ("current_cd4_perc", "current_cd4_perc"),
    ("Baseline_VL_date", "baseline_vl_date"),
    ("Baseline_VL_copies", "baseline_vl_copies"),
    ("Current_VL_date", "current_vl_date"),
    ("Current_VL_copies", "current_vl_copies"),
    ("Patient_status_date", "patient_status_date"),
    ("Patient_status", "patient_status"),
    ("FirstInteraction_date", "firstinteraction_date"),
    ("Lastinteraction_date", "lastinteraction_date"),
    ("LastInteractionService", "lastinteractionservice"),
    ("NextAppointmentDate", "nextappointmentdate"),
    ("ANCVisitDate", "ancvisitdate"),
    ("EstimatedDateOfDelivery", "estimateddateofdelivery"),
]

# A YAML mapping keeps one value per key; the repeat above is identical.
COLUMN_MAPPING: dict[str, str] = dict(COLUMN_MAPPING_LINES)

# --- Fixed values: date columns parsed in place, spelled as configured.
DATE_COLUMNS: list[str] = [
    "DOB",
    "HivTestDate",
    "ARTStartDate",
    "CurrentARTRegimenDispensationDate",
    "Current_CD4_countdate",
    "Current_VL_date",
    "Patient_status_date",
    "ANCVisitDate",
    "FirstInteraction_date",
    "LastInteraction_date",
    "NextAppointmentDate",
    "Prescriptiondate",
    "estimateddateofdelivery",
    "report_period",
]

REPORT_PERIOD = "2024-03-13"

# --- Fixed values: source lineage labels.
SOURCE_PLUS = "SmartCare Plus"
SOURCE_LEGACY = "SmartCare Legacy"

# --- Fixed values: fiscal quarters by month name (October starts Q1).
QUARTER_MONTHS: list[tuple[str, list[str]]] = [
    ("Q1", ["October", "November", "December"]),
    ("Q2", ["January", "February", "March"]),
    ("Q3", ["April", "May", "June"]),
    ("Q4", ["July", "August", "September"]),
]

# --- Fixed values: weight bands (whole-number lower bound, decimal upper bound).
WEIGHT_BANDS: list[tuple[int, float, str]] = [
    (0, 2.999, "0<3"),
    (3, 5.99, "3-5.9"),
    (6, 9.99, "6-9.9"),
    (10, 19.99, "10-19.9"),
    (20, 29.99, "20-29.9"),
]
WEIGHT_TOP = (30, "30+")

# --- Fixed values: BMI bands, [low, high) on the formatted BMI text.
BMI_BANDS: list[tuple[float | None, float | None, str]] = [
    (None, 18.5, "<18.5"),
    (18.5, 25, "18.5-24.9"),
    (25, 30, "25-29.9"),
    (30, 35, "30-34.9"),
    (35, 40, "35-39.9"),
    (40, None, "40+"),
]

# --- Fixed values: days from HIV test to ART start, inclusive ranges.
LINKAGE_BANDS: list[tuple[int, int | None, str]] = [
    (0, 7, "<7"),
    (8, 14, "8-14"),
    (15, 30, "15-30"),
    (31, 90, "31-90"),
    (90, None, "90+"),
]

# --- Fixed values: CD4 count bands, (low, high] with an open first and last band.
CD4_BANDS: list[tuple[int | None, int | None, str]] = [
    (None, 50, "<=50"),
    (50, 200, "51-200"),
    (200, 350, "201-350"),
    (350, 500, "351-500"),
    (500, 1000, "501-1000"),
    (1000, None, ">1000"),
]

# --- Fixed values: CD4 percentage labels (below 15, 15 to 24, fallback).
CD4_PERC_LOW, CD4_PERC_MID, CD4_PERC_REST = "<15%", "15-24%", ">=25%"

# --- Fixed values: viral-load copies labels (below 1000, 1000 to 2500, above 2500).
VL_LOW, VL_MID, VL_HIGH = "(<1000)", "(1000-2500)", "(>2500)"

# --- Fixed values: month lengths used to turn days into months.
DAYS_PER_MONTH = 30.437      # cohort months, VL windows, delivery window
DAYS_PER_MONTH_MMD = 30.44   # dispensing months

# --- Fixed values: multi-month dispensing labels.
MMD_LABELS = {"lt3": "<3MMD", "3to5": "3-5MMD", "6": "6MMD", "7to11": "7-11MMD", "12plus": "12+MMD"}

# --- Fixed values: differentiated service delivery labels, in code order 1..8.
# The raw data also carries "Multi Month Scriptiing " with a trailing space.
DSD_LABELS: list[str] = [
    "Community ART Distribution Points",
    "Community Adherance Groups",
    "Fast Track",
    "Health Post",
    "Mobile ART distritbution model",
    "Multi Month Scriptiing",
    "Rural Adherance Group",
    "Urban Adherance Group",
]
DSD_RAW_FIXES: dict[str, str] = {"Multi Month Scriptiing ": "Multi Month Scriptiing"}

# --- Fixed values: patient status vocabulary.
# Raw codes that can still be "Active" when the status predates the last visit.
STATUS_STALE_CODES: list[str] = ["died", "stoppedART", "reactivated", "made_inactive", "transout"]
# Raw code -> final label when the status is current. Spellings are the
# source system's as matched by the reference rules.
STATUS_CURRENT_LABELS: list[tuple[str, str]] = [
    ("died", "Died"),
    ("reactived", "Reactivated"),
    ("stoppedART", "Stopped ART"),
    ("transout", "Transferred-out"),
    ("made_inative", "Made_inactive"),
]
# The same table with the codes spelled as in STATUS_STALE_CODES.
STATUS_CURRENT_LABELS_FIXED: list[tuple[str, str]] = [
    ("died", "Died"),
    ("reactivated", "Reactivated"),
    ("stoppedART", "Stopped ART"),
    ("transout", "Transferred-out"),
    ("made_inactive", "Made_inactive"),
]
ACTIVE = "Active"
DIED, REACTIVATED, STOPPED_ART, TRANSFERRED_OUT, MADE_INACTIVE = (
    "Died", "Reactivated", "Stopped ART", "Transferred-out", "Made_inactive")

# --- Fixed values: outcomes and indicators.
RETENTION, ATTRITION = "retention in care", "attrition"
OUTCOME1_ACTIVE, OUTCOME1_RTT, OUTCOME1_ML, OUTCOME1_IIT, OUTCOME1_NEW = (
    "Active on ART", "TX_RTT", "TX_ML", "IIT", "NET_NEW")
CASCADE_LABELS = {
    "positive": "HIV positive",
    "active": "Actively on ART",
    "eligible": "VL eligible",
    "coverage": "VL coverage",
    "suppression": "VL suppression",
}
TX_ML_LABELS = {
    "died": "Died",
    "iit_short": "IIT <3 months TX",
    "iit_long": "IIT 3>= months TX",
    "stopped": "Stopped TX",
    "curr": "TX_CURR",
}
HIV_RESULTS_KEPT = ["Positive", "Negative"]
HIV_RESULT_MISSING = "Missing"
SEX_CODES: list[tuple[str, str]] = [("F", "Female"), ("M", "Male")]
SEX_OTHER = "99"
YES, NO = "Yes", "No"
UNIQUE, DUPLICATE = "Unique", "Duplicate"
DUP_LABELS: list[str] = ["No duplicate", "Duplicated once", "Duplicated twice", "Duplicated thrice"]
MMS6, MMS3 = "MMS6", "MMS3"

# --- Fixed values: age bands. "0<1" is (0, 0.999]; "BIF" is -50..-1.
AGE_INFANT = (0, 0.999, "0<1")
AGE_BANDS: list[tuple[int, int, str]] = [
    (1, 4, "1-4"),
    (5, 9, "5-9"),
    (10, 14, "10-14"),
    (15, 19, "15-19"),
    (20, 24, "20-24"),
    (25, 29, "25-29"),
    (30, 34, "30-34"),
    (35, 39, "35-39"),
    (40, 44, "40-44"),
    (45, 49, "45-49"),
    (50, 54, "50-54"),
    (55, 59, "55-59"),
    (60, 64, "60-64"),
]
AGE_TOP = (65, "65+")
AGE_BEFORE_BIRTH = (-50, -1, "BIF")

# --- Fixed values: ART cohort months; "(145+)" is everything else (NULL included).
ART_COHORT_BANDS: list[tuple[int, int, str]] = [
    (0, 3, "(0<3)"),
    (4, 6, "(4-6)"),
    (7, 12, "(7-12)"),
    (13, 24, "(13-24)"),
    (25, 36, "(25-36)"),
    (37, 48, "(37-48)"),
    (49, 60, "(49-60)"),
    (61, 72, "(61-72)"),
    (73, 84, "(73-84)"),
    (85, 96, "(85-96)"),
    (97, 108, "(97-108)"),
    (109, 120, "(109-120)"),
    (121, 132, "(121-132)"),
    (133, 144, "(133-144)"),
]
ART_COHORT_REST = "(145+)"
