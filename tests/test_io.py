"""CSV extracts in, Parquet out, the end-to-end ``run`` and the JDBC writer."""

import os
import tempfile

import pytest

from pyspark.sql import functions as F

from conftest import SF_SMALL
from cohortkit import run
from cohortkit.plans.cohort import cohort
from cohortkit.sources import csv as csv_io
from cohortkit.sources import sinks
from cohortkit.sources.fixture import cohort_fixture, legacy_shape, plus_shape


def _write_shapes(spark):
    d = tempfile.mkdtemp(prefix="cohortkit-io-")
    fx = cohort_fixture(spark, SF_SMALL)
    csv_io.write_extract(plus_shape(fx), f"{d}/plus")
    csv_io.write_extract(legacy_shape(fx), f"{d}/legacy")
    return d, fx


def test_csv_reads_all_text_and_keeps_trailing_blanks(spark):
    d, _ = _write_shapes(spark)
    df = csv_io.read_extract(spark, f"{d}/plus")
    assert {t for _, t in df.dtypes} == {"string"}
    assert df.where(F.col("dsd") == "Multi Month Scriptiing ").count() > 0


def test_run_end_to_end_matches_cohort_on_the_fixture(spark):
    d, fx = _write_shapes(spark)
    out = run(spark, f"{d}/plus", f"{d}/legacy", row_id="PatientID")
    ref = cohort(fx, "patientid")
    cols = ["PatientID", "patient_status", "outcome", "hiv_cascade", "Pt_GUID_dups",
            "distinct_ART", "MMD_type", "BMI_category"]
    got = out.withColumn("PatientID", F.col("PatientID").cast("long")).select(*cols)
    # CSV has no empty-vs-missing distinction; that only touches ArtFacilityName
    assert sorted(got.collect()) == sorted(ref.select(*cols).collect())


def test_run_without_row_id_materialises_a_stable_id(spark):
    d, _ = _write_shapes(spark)
    out = run(spark, f"{d}/plus", f"{d}/legacy")
    assert out.count() == 1500
    assert "__row_id" not in out.columns
    assert out.groupBy("OwningGuid", "DOB", "sex", "current_age", "ARTStartDate") \
              .agg(F.sum("distinct_GUID_n").alias("n")).where("n <> 1").count() == 0


def test_parquet_sink_partitions_by_report_period(spark):
    d = tempfile.mkdtemp(prefix="cohortkit-out-")
    df = cohort(cohort_fixture(spark, SF_SMALL), "patientid")
    sinks.write_parquet(df, f"{d}/cohort")
    assert os.path.isdir(f"{d}/cohort/report_period=2024-03-13")
    back = spark.read.parquet(f"{d}/cohort")
    assert back.count() == 1500


def test_a_second_period_leaves_the_first(spark):
    d = tempfile.mkdtemp(prefix="cohortkit-out-")
    df = cohort_fixture(spark, SF_SMALL).select("patientid")
    for period, rows in (("2024-02-29", 10), ("2024-03-31", 20), ("2024-03-31", 30)):
        sinks.write_parquet(df.limit(rows).withColumn("report_period", F.lit(period).cast("date")), f"{d}/p")
    back = spark.read.parquet(f"{d}/p").groupBy(F.col("report_period").cast("string")).count()
    assert sorted(map(tuple, back.collect())) == [("2024-02-29", 10), ("2024-03-31", 30)]


def test_paths_with_other_column_orders(spark):
    d = tempfile.mkdtemp(prefix="cohortkit-io-")
    for name, text in (("x", "a,b\n1,2\n"), ("y", "b,a\n3,4\n"), ("z", "a,c\n5,6\n")):
        os.makedirs(f"{d}/{name}")
        with open(f"{d}/{name}/f.csv", "w") as f:
            f.write(text)
    got = csv_io.read_extract(spark, [f"{d}/x", f"{d}/y", f"{d}/z"])
    assert sorted(map(tuple, got.select("a", "b", "c").collect())) == [("1", "2", None), ("4", "3", None), ("5", None, "6")]


def test_a_file_with_another_header_fails_the_read(spark):
    d = tempfile.mkdtemp(prefix="cohortkit-io-")
    for name, text in (("x", "a,b\n1,2\n"), ("y", "b,a\n3,4\n")):
        with open(f"{d}/{name}.csv", "w") as f:
            f.write(text)
    with pytest.raises(Exception, match="(?i)header"):
        csv_io.read_extract(spark, d).collect()


def test_repeated_ids_across_extracts_keep_their_rows(spark):
    """PatientID repeats within and across the two systems."""
    d, fx = _write_shapes(spark)
    both = f"{d}/twice"
    csv_io.read_extract(spark, f"{d}/plus").write.option("header", True).csv(both)
    out = run(spark, [f"{d}/plus", both], f"{d}/legacy", row_id="PatientID")
    plus = csv_io.read_extract(spark, f"{d}/plus").count()
    assert out.count() == 1500 + plus
    labels = {r[0]: r[1] for r in out.groupBy("distinct_GUID_label").count().collect()}
    once = run(spark, f"{d}/plus", f"{d}/legacy", row_id="PatientID").groupBy("distinct_GUID_label").count()
    assert labels["Unique"] == {r[0]: r[1] for r in once.collect()}["Unique"]


def test_bad_ids_end_the_job_in_cohort(spark):
    fx = cohort_fixture(spark, SF_SMALL).where("patientid < 500")
    with pytest.raises(Exception, match="not unique"):
        cohort(fx.unionByName(fx.limit(1)), "patientid").collect()
    with pytest.raises(Exception, match="is NULL"):
        cohort(fx.withColumn("patientid", F.when(F.col("patientid") > 100, F.col("patientid"))), "patientid").collect()


def test_ids_that_are_null_or_no_numbers_are_rows_like_others(spark):
    d, _ = _write_shapes(spark)
    odd = f"{d}/odd"
    (csv_io.read_extract(spark, f"{d}/plus")
     .withColumn("patientid", F.when(F.col("patientid").cast("long") % 2 == 0, F.lit("x")))
     .write.option("header", True).csv(odd))
    out = run(spark, odd, f"{d}/legacy", row_id="PatientID")
    rows = out.select("distinct_GUID", "distinct_GUID_label", "Pt_GUID_dups").collect()
    assert len(rows) == 1500
    assert all((r[0] == 1) == (r[1] == "Unique") == (r[2] == 0) for r in rows)


def test_left_out_columns_are_named(spark):
    d, _ = _write_shapes(spark)
    more = f"{d}/more"
    csv_io.read_extract(spark, f"{d}/legacy").withColumn("LocalNote", F.lit("x")).write.option("header", True).csv(more)
    with pytest.warns(UserWarning, match="LocalNote"):
        run(spark, f"{d}/plus", more)


def test_scratch_is_the_callers(spark):
    from cohortkit.session import drop_scratch, scratch_path

    d, _ = _write_shapes(spark)
    out = run(spark, f"{d}/plus", f"{d}/legacy", scratch=f"{d}/kept")
    assert out.count() == 1500 and os.path.isdir(f"{d}/kept")
    path = scratch_path(spark, "some")
    spark.range(3).write.parquet(path)
    local = path.removeprefix("file:")
    assert os.path.isdir(local)
    drop_scratch(spark)
    assert not os.path.isdir(local) and os.path.isdir(f"{d}/kept")


def test_report_period_is_checked_before_any_job(spark):
    fx = cohort_fixture(spark, SF_SMALL)
    for bad in ("13/03/2024", "20240313", "2024-02-30", ""):
        with pytest.raises(ValueError):
            cohort(fx, "patientid", report_period=bad)


def test_mapped_bmi_gives_way_to_the_rule_in_either_case_mode(spark):
    fx = cohort_fixture(spark, SF_SMALL).withColumn("Bmi", F.lit("raw"))
    for mode in ("false", "true"):
        spark.conf.set("spark.sql.caseSensitive", mode)
        try:
            out = cohort(fx, "patientid")
            assert [c for c in out.columns if c.lower() == "bmi"] == ["BMI"]
            assert out.where("BMI = 'raw'").count() == 0
        finally:
            spark.conf.unset("spark.sql.caseSensitive")


def test_jdbc_writer_is_configured_not_run(spark):
    # No database is started here; the writer is only built.
    df = spark.range(1)
    w = sinks.jdbc_writer(df, "jdbc:example://host/db", "cohort", user="u", password="p",
                          driver="org.example.Driver", batchsize="1000")
    assert type(w).__name__ == "DataFrameWriter"


def test_command_line_runner(spark):
    from cohortkit.__main__ import main
    d, _ = _write_shapes(spark)
    assert main(["--plus", f"{d}/plus", "--legacy", f"{d}/legacy", "--out", f"{d}/cli-out",
                 "--row-id", "PatientID"]) == 0
    back = spark.read.parquet(f"{d}/cli-out")
    assert back.count() == 1500 and "Pt_GUID_dups_label" in back.columns
