"""One Spark query per operator, each over the fixture derived from the
driver tables. Every query returns ``patientid`` plus that operator's
outputs (harmonisation queries return whole harmonised rows)."""

from __future__ import annotations

from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cohortkit import session, vocab
from cohortkit.operators import dedup, harmonise as hz, rules, windows
from cohortkit.plans.cohort import cohort
from cohortkit.session import scratch_path
from cohortkit.sources import csv as csv_io
from cohortkit.sources.fixture import cohort_fixture, legacy_shape, plus_shape

ROW_ID = "PatientID"
SPARSE_STEP = 4194304001  # ids this far apart share no bucket
Query = Callable[[SparkSession, str], DataFrame]


def _base(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rules.normalise_names(cohort_fixture(spark, sf_dir))


def _rows(spark: SparkSession, sf_dir: str, upto: str, **kw) -> DataFrame:
    return rules.row_rules(_base(spark, sf_dir), upto=upto, row_id=ROW_ID, **kw)


def _out(df: DataFrame, cols: list[str]) -> DataFrame:
    return df.select(F.col(ROW_ID).alias("patientid"), *cols)


def _outputs(*cols: str):
    """Record the columns a query returns besides ``patientid``."""
    def mark(q):
        q.outputs = list(cols)
        return q
    return mark


def _step(upto: str, cols: list[str]) -> Query:
    def q(spark: SparkSession, sf_dir: str) -> DataFrame:
        return _out(_rows(spark, sf_dir, upto), cols)
    q.__doc__ = f"{', '.join(cols)} after step {upto!r}"
    return _outputs(*cols)(q)


def _date_cols() -> list[str]:
    return list(vocab.DATE_COLUMNS)


def _part_cols() -> list[str]:
    return [f"{c}_{p}" for c in vocab.DATE_COLUMNS for p in ("day", "month", "year")]


# ------------------------------------------------------------ harmonise
def q_tag_source(spark, sf_dir):
    fx = cohort_fixture(spark, sf_dir)
    plus = hz.tag_source(plus_shape(fx), vocab.SOURCE_PLUS)
    legacy = hz.tag_source(legacy_shape(fx), vocab.SOURCE_LEGACY)
    return (plus.select(F.col("patientid"), "source")
            .unionByName(legacy.select(F.col("PatientID").alias("patientid"), "source")))


def q_rename_columns(spark, sf_dir):
    return hz.rename_columns(plus_shape(cohort_fixture(spark, sf_dir)))


def q_common_columns(spark, sf_dir):
    fx = cohort_fixture(spark, sf_dir)
    left = hz.rename_columns(hz.tag_source(plus_shape(fx), vocab.SOURCE_PLUS))
    right = hz.tag_source(legacy_shape(fx), vocab.SOURCE_LEGACY)
    common = hz.common_columns(left, right)
    return left.select(common).unionByName(right.select(common))


def q_union_sources(spark, sf_dir):
    fx = cohort_fixture(spark, sf_dir)
    return hz.harmonise(plus_shape(fx), legacy_shape(fx))


def q_src_csv(spark, sf_dir):
    """Write both extract shapes as header CSV, read them back as text and harmonise."""
    fx = cohort_fixture(spark, sf_dir)
    plus_path, legacy_path = scratch_path(spark, "plus-csv"), scratch_path(spark, "legacy-csv")
    with ThreadPoolExecutor(2) as pool:  # two jobs side by side
        for done in [pool.submit(csv_io.write_extract, plus_shape(fx), plus_path),
                     pool.submit(csv_io.write_extract, legacy_shape(fx), legacy_path)]:
            done.result()
    plus, legacy = csv_io.read_extract(spark, plus_path), csv_io.read_extract(spark, legacy_path)
    out = hz.harmonise(plus, legacy)
    return out.withColumn("PatientID", F.col("PatientID").cast("bigint"))


# ---------------------------------------------------------------- windows
@_outputs("old_visit", "new_visit", "visit_diff_days")
def q_visit_window(spark, sf_dir):
    return _out(_rows(spark, sf_dir, "visit_window"), ["old_visit", "new_visit", "visit_diff_days"])


@_outputs("old_visit", "new_visit", "visit_diff_days")
def q_visit_window_patient(spark, sf_dir):
    """The visit window keyed per patient (without the visit date): real min/max."""
    key = [k for k in rules.VISIT_KEY if k != rules.VISIT_MEASURE]
    df = _rows(spark, sf_dir, "visit_window", visit_key=key)
    return _out(df, ["old_visit", "new_visit", "visit_diff_days"])


def _keys(spark, sf_dir):
    return dedup.dedup_keys(_base(spark, sf_dir), ROW_ID)


def _flag_query(family: str, name: str) -> Query:
    def q(spark, sf_dir):
        flags = dedup.first_flag(_keys(spark, sf_dir), family, ROW_ID, name)
        return flags.select(F.col(ROW_ID).alias("patientid"), name)
    q.__doc__ = f"{name}: first row of its {family} group"
    return _outputs(name)(q)


@_outputs("distinct_GUID")
def q_distinct_guid_names(spark, sf_dir):
    flags = dedup.first_flag(_keys(spark, sf_dir), "guid_name", ROW_ID, "distinct_GUID")
    return flags.select(F.col(ROW_ID).alias("patientid"), "distinct_GUID")


@_outputs("Pt_GUID_dups")
def q_guid_dups(spark, sf_dir):
    r = dedup.dup_ordinal(_keys(spark, sf_dir), ROW_ID)
    return r.select(F.col(ROW_ID).alias("patientid"),
                    (F.col(dedup.RANK) - 1).cast("int").alias("Pt_GUID_dups"))


@_outputs("Pt_GUID_dups")
def q_guid_dups_small_buckets(spark, sf_dir):
    """``guid_dups`` with buckets of 64 ids: groups are numbered across buckets."""
    r = dedup.dup_ordinal(_keys(spark, sf_dir), ROW_ID, bucket_rows=64)
    return r.select(F.col(ROW_ID).alias("patientid"),
                    (F.col(dedup.RANK) - 1).cast("int").alias("Pt_GUID_dups"))


def q_ordinal_hot_sparse(spark, sf_dir):
    """Ordinals where one group has a third of the rows and every id its own bucket."""
    rows = cohort_fixture(spark, sf_dir).select(
        "patientid", (F.col("patientid") * F.lit(SPARSE_STEP)).alias("sparse_id"),
        F.when(F.col("patientid") % 3 == 0, "hot").otherwise(F.col("owningguid")).alias("hot_guid"))
    r = windows.group_ordinal(rows.select("sparse_id", "hot_guid"), ["hot_guid"], "sparse_id", "ordinal")
    return r.select(F.expr(f"sparse_id div {SPARSE_STEP}").alias("patientid"), "ordinal")


@_outputs("distinct_GUID_label", "distinct_ART_label", "distinct_NUPN_label",
          "Pt_GUID_dups_label")
def q_dedup_labels(spark, sf_dir):
    r = dedup.label_flags(dedup.family_flags(_keys(spark, sf_dir), ROW_ID))
    return r.select(F.col(ROW_ID).alias("patientid"), "distinct_GUID_label", "distinct_ART_label",
                    "distinct_NUPN_label", "Pt_GUID_dups_label")


@_outputs("_patient_guid", "pt_GUID")
def q_guid_unify(spark, sf_dir):
    return _out(dedup.guid_unify(_base(spark, sf_dir)), ["_patient_guid", "pt_GUID"])


# --------------------------------------------------------------- outcomes
@_outputs("in_care")
def q_in_care(spark, sf_dir):
    df = _rows(spark, sf_dir, "status")
    return _out(df, [F.col(rules.IN_CARE).alias("in_care")])


@_outputs("MMS")
def q_mms(spark, sf_dir):
    return _out(rules.mms(_rows(spark, sf_dir, "indicators")), ["MMS"])


def q_cohort_frame(spark, sf_dir):
    session.compiled(spark)
    return cohort(cohort_fixture(spark, sf_dir), "patientid")


QUERIES: dict[str, Query] = {
    # sources, harmonisation
    "src_csv": q_src_csv,
    "tag_source": q_tag_source,
    "rename_columns": q_rename_columns,
    "common_columns": q_common_columns,
    "union_sources": q_union_sources,
    # dates
    "convert_dates": _step("convert_dates", _date_cols()),
    "month_year": _step("month_year", _part_cols()),
    "completed_years": _step("normalise_patient",
                             ["age_at_art_initiation", "age_at_first_visit", "current_age"]),
    "quarters": _step("buckets", ["ART_start_quart", "reporting_quarter"]),
    # patient normalisation
    "height_m": _step("normalise_patient", ["patientheight"]),
    "bmi": _step("normalise_patient", ["BMI"]),
    "hivtest_results": _step("normalise_patient", ["HIVtest_results"]),
    "sex_recode": _step("normalise_patient", ["sex"]),
    "pmtct_tx": _step("normalise_patient", ["PMTCT_TX"]),
    "on_art": _step("normalise_patient", ["OnART"]),
    "age_at_art_initiation": _step("normalise_patient", ["age_at_art_initiation"]),
    "age_at_first_visit": _step("normalise_patient", ["age_at_first_visit"]),
    "current_age": _step("normalise_patient", ["current_age"]),
    # buckets
    "age_group": _step("buckets", ["age_groupt_Art_initiation"]),
    "weight_category": _step("buckets", ["weight_category"]),
    "bmi_category": _step("buckets", ["BMI_category"]),
    "linkage_to_care": _step("buckets", ["linkage_to_care_category"]),
    "months_since_art_start": _step("buckets", ["months_since_art_start"]),
    "art_cohort": _step("cohort_and_eligibility", ["ART_cohort"]),
    "cd4_group": _step("buckets", ["basecd4group"]),
    "cd4_percentage": _step("buckets", ["basecd4_perc"]),
    "vl_category": _step("indicators", ["VL_category"]),
    "mmd_proxy_mo": _step("indicators", ["MMD_proxy_Mo"]),
    "mmd_type": _step("indicators", ["MMD_type"]),
    "dsd_new": _step("indicators", ["DSD_new"]),
    # windows
    "visit_window": q_visit_window,
    "visit_window_patient": q_visit_window_patient,
    "distinct_guid": _flag_query("guid", "distinct_guid"),
    "distinct_art": _flag_query("art", "distinct_ART"),
    "distinct_nupn": _flag_query("nupn", "distinct_NUPN"),
    "distinct_guid_names": q_distinct_guid_names,
    "distinct_guid_n": _flag_query("guid", "distinct_GUID_n"),
    "guid_dups": q_guid_dups,
    "guid_dups_small_buckets": q_guid_dups_small_buckets,
    "ordinal_hot_sparse": q_ordinal_hot_sparse,
    "dedup_labels": q_dedup_labels,
    "guid_unify": q_guid_unify,
    # predicates and indicators
    "vl_eligibility": _step("cohort_and_eligibility", ["VL_eligibility"]),
    "tx_curr_days": _step("tx_curr_days", ["Days_missed", "Days_Away", "Days_Away_Dispense"]),
    "in_care": q_in_care,
    "patient_status": _step("status", ["patient_status"]),
    "clinical_outcome": _step("outcome", ["outcome"]),
    "outcome_1": _step("indicators", ["outcome_1"]),
    "vl_coverage": _step("indicators", ["VL_coverage"]),
    "hiv_cascade": _step("indicators", ["hiv_cascade"]),
    "tx_ml": _step("indicators", ["TX_ML"]),
    "silent_transfer": _step("indicators", ["silent_transfer"]),
    "re_initiated": _step("indicators", ["re_initiated"]),
    "mms": q_mms,
    # everything
    "cohort_frame": q_cohort_frame,
}
