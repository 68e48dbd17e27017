"""Plan shape: no Python in any plan, filters and columns pushed to the
scan, no shuffle where a rule is per-row."""

import re

import pytest

from conftest import SF_LARGE, SF_SMALL
from cohortkit.plans.catalog import QUERIES



def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", sorted(set(QUERIES) - {"src_csv"}))
def test_no_python_udf(spark, name):
    p = plan(QUERIES[name](spark, SF_SMALL))
    for node in ("BatchEvalPython", "ArrowEvalPython", "PythonUDF", "MapInPandas",
                 "FlatMapGroupsInPandas"):
        assert node not in p


def test_scan_reads_only_needed_columns(spark):
    p = plan(QUERIES["sex_recode"](spark, SF_SMALL))
    orders_scan = [line for line in p.splitlines() if "orders.parquet" in line][0]
    assert "ReadSchema: struct<o_orderkey:bigint,o_custkey:bigint>" in orders_scan


def test_per_row_rules_add_no_shuffle(spark):
    # only the fixture's own spread of the order keys
    p = plan(QUERIES["patient_status"](spark, SF_SMALL))
    assert p.count("Exchange hashpartitioning") == 1


def test_reference_visit_window_needs_no_shuffle(spark):
    p = plan(QUERIES["visit_window"](spark, SF_SMALL))
    assert p.count("Exchange hashpartitioning") == 1


def test_cohort_shuffles_wide_rows_once(spark):
    p = plan(QUERIES["cohort_frame"](spark, SF_SMALL))
    # the row-id join: the wide rows, which come in no order of the id, and the narrow flags
    wide = [line for line in p.splitlines() if "Exchange hashpartitioning(PatientID" in line]
    assert 1 <= len(wide) <= 2
    assert "CartesianProduct" not in p and "BroadcastNestedLoopJoin" not in p


def shape(df):
    """The plan's operators without ids and sizes."""
    return re.findall(r"[+:*() -]*([A-Z][A-Za-z]+(?: hashpartitioning| Inner| LeftOuter)?)", plan(df))


@pytest.mark.parametrize("name", ["cohort_frame", "guid_dups", "patient_status"])
def test_same_plan_at_any_size(spark, name):
    assert shape(QUERIES[name](spark, SF_SMALL)) == shape(QUERIES[name](spark, SF_LARGE))


def test_input_is_not_partitioned_by_the_row_id(spark):
    from cohortkit.sources.fixture import cohort_fixture
    p = plan(cohort_fixture(spark, SF_SMALL))
    assert "hashpartitioning(o_custkey" in p and "hashpartitioning(o_orderkey" not in p


def test_run_parses_each_extract_once(spark, tmp_path):
    from cohortkit import run
    from cohortkit.sources import csv as csv_io
    from cohortkit.sources.fixture import cohort_fixture, legacy_shape, plus_shape
    fx = cohort_fixture(spark, SF_SMALL)
    csv_io.write_extract(plus_shape(fx), str(tmp_path / "plus"))
    csv_io.write_extract(legacy_shape(fx), str(tmp_path / "legacy"))
    for row_id in (None, "PatientID"):
        out = run(spark, str(tmp_path / "plus"), str(tmp_path / "legacy"), row_id=row_id)
        # the frame reads the copy written at the call, never the text
        assert "FileScan csv" not in plan(out) and "FileScan parquet" in plan(out)


def test_the_frame_runs_with_methods_that_hotspot_compiles(spark):
    from cohortkit.session import METHOD_LIMIT
    before = spark.conf.get(METHOD_LIMIT)
    try:
        spark.conf.set(METHOD_LIMIT, "65535")
        QUERIES["cohort_frame"](spark, SF_SMALL)
        assert int(spark.conf.get(METHOD_LIMIT)) <= 8000
        spark.conf.set(METHOD_LIMIT, "500")
        QUERIES["cohort_frame"](spark, SF_SMALL)
        assert spark.conf.get(METHOD_LIMIT) == "500"
    finally:
        spark.conf.set(METHOD_LIMIT, before)
