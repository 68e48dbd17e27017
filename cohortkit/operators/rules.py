"""The cohort rules as DataFrame transforms, one projection per step.

Each transform adds (or replaces) the columns of one step of the cohort
derivation and reads only columns that earlier steps produced. Inside a step
every new column reads the step's *input*, so a step is one ``withColumns``
and Catalyst collapses consecutive steps into few projections.

Column names are the final spellings (``NAMES``); ``normalise_names`` maps
any case variant of an input name onto them first, so no rule depends on
``spark.sql.caseSensitive``.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cohortkit import vocab
from cohortkit.functions import clinical as cl
from cohortkit.functions import status as st
from cohortkit.functions.coerce import days_between, parse_date
from cohortkit.functions.dates import completed_years, date_literal, date_parts, fiscal_quarter
from cohortkit.operators import windows

# Final spelling of every input column a rule may read or replace: the
# canonical names, with date columns spelled as configured and the three
# recoded columns in lower case.
NAMES: dict[str, str] = {k.lower(): k for k in vocab.COLUMN_MAPPING}
NAMES.update({c.lower(): c for c in vocab.DATE_COLUMNS})
NAMES.update({c: c for c in ("sex", "patient_status", "patientheight", "source")})
NAMES["bmi"] = "BMI"  # the rule's own output replaces the extract's

REQUIRED_INPUTS = [
    "patientheight", "patientweight", "HIVTestResults", "sex", "ANCVisitDate", "ARTNumber",
    "ARTStartDate", "CurrentARTRegimen", "DOB", "FirstInteraction_date", "HivTestDate",
    "estimateddateofdelivery", "LastInteraction_date", "NextAppointmentDate",
    "CurrentARTRegimenDispensationDate", "patient_status", "Patient_status_date",
    "Current_VL_date", "Current_VL_copies", "ArtFacilityName", "FacilityName", "DSDModel",
    "patient_guid", "OwningGuid", "NUPN", "FirstName", "LastName", "baseline_cd4",
    "baseline_cd4_perc",
]

# Key of the reference visit window; it contains its own measure.
VISIT_KEY = ["ARTNumber", "DOB", "sex", "current_age", "ARTStartDate", "LastInteraction_date"]
VISIT_MEASURE = "LastInteraction_date"


def _q(name: str) -> str:
    return f"`{name.replace('`', '``')}`"


def normalise_names(df: DataFrame) -> DataFrame:
    """Respell input columns to ``NAMES`` (case-insensitive match), one projection."""
    targets = [NAMES.get(c.lower(), c) for c in df.columns]
    if len({t.lower() for t in targets}) != len(targets):
        raise ValueError(f"input columns collide ignoring case: {df.columns}")
    return df.select([F.col(_q(c)).alias(t) for c, t in zip(df.columns, targets)])


def resolve(df: DataFrame, name: str) -> str:
    """The column of ``df`` whose name equals ``name`` ignoring case."""
    hits = [c for c in df.columns if c.lower() == name.lower()]
    if len(hits) != 1:
        raise ValueError(f"column {name!r} not found once in {df.columns}")
    return hits[0]


def check_inputs(df: DataFrame, date_columns: Sequence[str]) -> None:
    have = set(df.columns)
    need = set(REQUIRED_INPUTS) | {c for c in date_columns if c != "report_period"}
    missing = sorted(need - have)
    if missing:
        raise ValueError(f"missing input columns: {missing}")


# ------------------------------------------------------------------ dates
def convert_dates(df: DataFrame, date_columns: Sequence[str] = vocab.DATE_COLUMNS,
                  report_period=vocab.REPORT_PERIOD) -> DataFrame:
    cols = {"report_period": date_literal(report_period)}
    cols.update({c: parse_date(c) for c in date_columns if c != "report_period"})
    return df.withColumns(cols)


def month_year(df: DataFrame, date_columns: Sequence[str] = vocab.DATE_COLUMNS) -> DataFrame:
    cols: dict = {}
    for c in date_columns:
        cols.update(date_parts(c))
    return df.withColumns(cols)


# Date parts that later rules read.
PARTS_READ = ["ARTStartDate_month", "ARTStartDate_year", "report_period_month", "report_period_year"]


class Packed:
    """Columns that no rule reads, carried as arrays from the first rule to the last.

    A step of the rules copies its whole input row. As an array, the text
    columns that only pass through and the date parts are one field to copy
    each, and one of the 100 fields that whole-stage code may have, however
    many they are.
    """
    TEXT, NAMES, YEARS = "__text_columns", "__date_names", "__date_years"

    def __init__(self, df: DataFrame, read: Sequence[str], date_columns: Sequence[str]):
        read = {c.lower() for c in read}
        self.columns = list(df.columns)
        self.text = [f.name for f in df.schema if f.name.lower() not in read and f.dataType.simpleString() == "string"]
        parts = [p for c in date_columns for p in date_parts(c) if p not in PARTS_READ]
        self.names = [p for p in parts if not p.endswith("_year")]
        self.years = [p for p in parts if p.endswith("_year")]
        self.parts = [p for c in date_columns for p in date_parts(c)]

    def _array(self, values: list, kind: str):
        return F.array(*values) if values else F.array().cast(f"array<{kind}>")

    def pack(self, df: DataFrame) -> DataFrame:
        """The text columns that pass through become one."""
        kept = [F.col(_q(c)) for c in df.columns if c not in set(self.text)]
        return df.select(*kept, self._array([F.col(_q(c)) for c in self.text], "string").alias(self.TEXT))

    def month_year(self, df: DataFrame, date_columns: Sequence[str]) -> DataFrame:
        """``month_year``, as two arrays but for the parts that rules read."""
        cols = {k: v for c in date_columns for k, v in date_parts(c).items()}
        arrays = {self.NAMES: self._array([cols[p] for p in self.names], "string"),
                  self.YEARS: self._array([cols[p] for p in self.years], "int")}
        return df.withColumns(arrays | {p: cols[p] for p in PARTS_READ if p in cols})

    def unpack(self, df: DataFrame) -> DataFrame:
        """Every column under its own name, in the order the steps alone would give."""
        packed = {c: F.get(F.col(self.TEXT), F.lit(i)) for i, c in enumerate(self.text)}
        packed |= {c: F.get(F.col(self.NAMES), F.lit(i)) for i, c in enumerate(self.names)}
        packed |= {c: F.get(F.col(self.YEARS), F.lit(i)) for i, c in enumerate(self.years)}
        made = {c.lower(): c for c in df.columns if c not in (self.TEXT, self.NAMES, self.YEARS)}
        # a rule's output replaces an input column of its name, whatever the case
        order = [made.get(c.lower(), c) for c in self.columns]
        for c in ["report_period", *self.parts, *made.values()]:
            if c not in order:
                order.append(c)
        return df.select([F.col(_q(c)) if c.lower() in made else packed[c].alias(c) for c in order])


# -------------------------------------------------------------- patients
def normalise_patient(df: DataFrame, as_of=vocab.REPORT_PERIOD) -> DataFrame:
    """Height in metres, BMI text, test result, sex, PMTCT, on-ART and ages."""
    h_m = cl.height_m("patientheight")
    return df.withColumns({
        "patientheight": h_m,
        "BMI": cl.bmi_text("patientweight", h_m),
        "HIVtest_results": cl.hivtest_results("HIVTestResults"),
        "sex": cl.sex_recode("sex"),
        "PMTCT_TX": cl.pmtct_tx("ANCVisitDate"),
        "OnART": cl.on_art("ARTNumber", "ARTStartDate", "CurrentARTRegimen"),
        "age_at_art_initiation": completed_years("ARTStartDate", "DOB"),
        "age_at_first_visit": completed_years("FirstInteraction_date", "DOB"),
        "current_age": completed_years(date_literal(as_of), "DOB"),
    })


def buckets(df: DataFrame) -> DataFrame:
    return df.withColumns({
        "age_groupt_Art_initiation": cl.age_group("age_at_art_initiation"),
        "weight_category": cl.weight_category("patientweight"),
        "BMI_category": cl.bmi_category("BMI"),
        "linkage_to_care_category": cl.linkage_category("ARTStartDate", "HivTestDate"),
        "months_since_art_start": cl.months_since("report_period", "ARTStartDate"),
        "ART_start_quart": fiscal_quarter("ARTStartDate_month"),
        "reporting_quarter": fiscal_quarter("report_period_month"),
        "basecd4group": cl.cd4_group("baseline_cd4"),
        "basecd4_perc": cl.cd4_percentage("baseline_cd4_perc"),
    })


def cohort_and_eligibility(df: DataFrame) -> DataFrame:
    return df.withColumns({
        "ART_cohort": cl.art_cohort("months_since_art_start"),
        "VL_eligibility": st.vl_eligibility("months_since_art_start", "ANCVisitDate",
                                            "report_period", "estimateddateofdelivery"),
    })


# ---------------------------------------------------------------- visits
def visit_window(df: DataFrame, key: Sequence[str] | None = None, row_id: str | None = None) -> DataFrame:
    """First and last visit of each visit group and the days since the last one.

    The reference key contains the visit date itself, so both ends equal the
    row's own visit date (no shuffle). Any other key, e.g. the key without
    the visit date, aggregates over the group (needs ``row_id``).
    """
    key = list(VISIT_KEY if key is None else key)
    if VISIT_MEASURE not in key and row_id is None:
        raise ValueError("a visit key without the visit date needs a unique row_id")
    out = windows.group_extent(df, key, VISIT_MEASURE, row_id or "", "old_visit", "new_visit")
    return out.withColumn("visit_diff_days", days_between("new_visit", VISIT_MEASURE))


def tx_curr_days(df: DataFrame) -> DataFrame:
    return df.withColumns({
        "Days_missed": days_between("report_period", "NextAppointmentDate"),
        "Days_Away": days_between("report_period", "new_visit"),
        "Days_Away_Dispense": days_between("report_period", "CurrentARTRegimenDispensationDate"),
    })


# -------------------------------------------------------------- outcomes
IN_CARE = "in_care"


def status(df: DataFrame, vocabulary: str = "reference") -> DataFrame:
    """``in_care`` flag, then the recoded ``patient_status`` (replaces the raw one)."""
    df = df.withColumn(IN_CARE, st.in_care("Days_missed", "Days_Away", "Days_Away_Dispense"))
    return df.withColumn("patient_status", st.patient_status(
        "patient_status", "Patient_status_date", "LastInteraction_date", F.col(IN_CARE),
        vocabulary))


def outcome(df: DataFrame) -> DataFrame:
    return df.withColumn("outcome", st.clinical_outcome("patient_status", F.col(IN_CARE)))


def indicators(df: DataFrame) -> DataFrame:
    df = df.withColumns({
        "outcome_1": st.outcome_1("outcome", "patient_status", "Patient_status_date",
                                  "LastInteraction_date", F.col(IN_CARE), "ART_start_quart",
                                  "reporting_quarter", "ARTStartDate_year", "report_period_year"),
        "VL_coverage": st.vl_coverage("outcome", "VL_eligibility", "report_period",
                                      "Current_VL_date"),
        "VL_category": cl.vl_category("Current_VL_copies"),
        "TX_ML": st.tx_ml("patient_status", "outcome", "months_since_art_start"),
        "silent_transfer": st.silent_transfer("ArtFacilityName", "FacilityName", "patient_status"),
        "MMD_proxy_Mo": cl.mmd_proxy_months("NextAppointmentDate",
                                            "CurrentARTRegimenDispensationDate",
                                            "LastInteraction_date"),
        "DSD_new": cl.dsd_new("DSDModel"),
    })
    return df.withColumns({
        "hiv_cascade": st.hiv_cascade("OnART", "HIVtest_results", "outcome", "VL_eligibility",
                                      "VL_coverage", "VL_category"),
        "re_initiated": st.re_initiated("LastInteraction_date", "ARTStartDate", "silent_transfer"),
        "MMD_type": cl.mmd_type("MMD_proxy_Mo"),
    })


def mms(df: DataFrame) -> DataFrame:
    """Multi-month scripting class (not part of the default frame)."""
    return df.withColumn("MMS", st.mms("MMD_proxy_Mo", cl.dsd_code("DSD_new")))


def row_rules(df: DataFrame, *, date_columns: Sequence[str] = vocab.DATE_COLUMNS,
              report_period=vocab.REPORT_PERIOD, as_of=None, vocabulary: str = "reference",
              visit_key: Sequence[str] | None = None, row_id: str | None = None,
              upto: str | None = None, packed: Packed | None = None) -> DataFrame:
    """Every per-row rule, in dependency order. ``upto`` stops after a step.
    With ``packed``, ``df`` comes from its ``pack`` and the result is for its ``unpack``."""
    as_of = report_period if as_of is None else as_of
    steps = [
        ("convert_dates", lambda d: convert_dates(d, date_columns, report_period)),
        ("month_year", lambda d: (packed.month_year if packed else month_year)(d, date_columns)),
        ("normalise_patient", lambda d: normalise_patient(d, as_of)),
        ("buckets", buckets),
        ("cohort_and_eligibility", cohort_and_eligibility),
        ("visit_window", lambda d: visit_window(d, visit_key, row_id)),
        ("tx_curr_days", tx_curr_days),
        ("status", lambda d: status(d, vocabulary)),
        ("outcome", outcome),
        ("indicators", indicators),
    ]
    for name, step in steps:
        df = step(df)
        if name == upto:
            return df
    if upto is not None and upto != "all":
        raise ValueError(f"unknown step {upto!r}")
    return df
