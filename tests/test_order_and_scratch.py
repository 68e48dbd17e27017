"""Ordering by any id column, unique ids under pruning, scratch files, the catalog without operators."""

import glob
import os
import shutil
import subprocess
import sys
import tempfile

import pytest
from pyspark.sql import functions as F

from conftest import ROOT, SF_SMALL
from cohortkit import cohort, run
from cohortkit.operators import dedup, rules
from cohortkit.plans.catalog import QUERIES
from cohortkit.plans.cohort import ORDER, ROW_ID, ordered, with_row_id
from cohortkit.session import Scratch, scratch_path, scratch_paths
from cohortkit.sources import csv as csv_io
from cohortkit.sources.fixture import cohort_fixture, legacy_shape, plus_shape

FLAGS = ["distinct_GUID", "distinct_GUID_n", "distinct_ART", "distinct_NUPN", "Pt_GUID_dups"]


@pytest.fixture(scope="module")
def extracts(spark):
    """Extracts whose ids are texts, a third of them NULL, some repeated."""
    d = tempfile.mkdtemp(prefix="cohortkit-order-")
    fx = cohort_fixture(spark, SF_SMALL)
    text_id = F.when(F.expr("patientid % 3 = 0"), F.lit(None)).otherwise(
        F.concat(F.lit("G"), (F.col("patientid") % 400).cast("string")))
    fx = fx.withColumn("patient_guid", text_id)
    for name, shape in (("plus", plus_shape(fx)), ("legacy", legacy_shape(fx))):
        shape.coalesce(1).write.option("header", True).csv(f"{d}/{name}-1")
        shape.repartition(5).write.option("header", True).csv(f"{d}/{name}-5")
    return d


def test_text_ids_are_spread_over_all_partitions(spark, extracts):
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        rows = with_row_id(spark, csv_io.read_extract(spark, f"{extracts}/legacy-5").withColumn("source", F.lit("s")))
        order = ordered(spark, rows, "patient_guid")
        sizes = [r["count"] for r in order.groupBy(F.input_file_name()).count().collect()]
    finally:
        spark.conf.unset("spark.sql.adaptive.enabled")
    n = rows.count()
    assert sum(sizes) == n and len(sizes) == 8 and max(sizes) < n / 4
    got = [r[0] for r in rows.join(order, ROW_ID).orderBy(ORDER).select("patient_guid").collect()]
    assert got == sorted(got, key=lambda t: (t is not None, t or ""))


@pytest.mark.parametrize("row_id", ["patient_guid", "PatientID"])
def test_flags_do_not_depend_on_input_splits(spark, extracts, row_id):
    def flags(n):
        out = run(spark, f"{extracts}/plus-{n}", f"{extracts}/legacy-{n}", row_id=row_id)
        return sorted(map(repr, out.select("PatientID", "patient_guid", *FLAGS).collect()))
    assert flags(1) == flags(5)


def test_the_first_of_a_group_has_the_smallest_id(spark, extracts):
    out = run(spark, f"{extracts}/plus-5", f"{extracts}/legacy-5", row_id="PatientID")
    key = [c for c in dedup.FAMILIES["art"]]
    firsts = out.groupBy(*key).agg(F.min(F.col("PatientID").cast("long")).alias("least"),
                                   F.max(F.when(F.col("distinct_ART") == 1, F.col("PatientID").cast("long"))).alias("first"))
    assert firsts.where(~F.col("least").eqNullSafe(F.col("first"))).count() == 0


def wide_shuffles(df):
    """Exchanges of the executed plan that move the carried text columns."""
    plan = df._jdf.queryExecution().executedPlan().toString()
    lines = plan.splitlines()
    return sum("Exchange" in line and any(rules.Packed.TEXT in below for below in lines[i + 1:i + 3])
               for i, line in enumerate(lines))


def test_wide_rows_are_shuffled_once_with_any_order(spark, extracts):
    settings = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.debug.maxToStringFields": "1000"}
    for k, v in settings.items():
        spark.conf.set(k, v)
    try:
        for row_id in (None, "patient_guid"):
            out = run(spark, f"{extracts}/plus-1", f"{extracts}/legacy-1", row_id=row_id)
            assert wide_shuffles(out) == 1
    finally:
        for k in settings:
            spark.conf.unset(k)


@pytest.mark.parametrize("columns", [["distinct_ART"], ["Pt_GUID_dups_label"], ["distinct_GUID", "sex"]])
def test_repeated_ids_end_the_job_however_few_columns_are_read(spark, columns):
    fx = cohort_fixture(spark, SF_SMALL).where("patientid < 500")
    with pytest.raises(Exception, match="not unique"):
        cohort(fx.unionByName(fx.limit(1)), "patientid").select(columns).collect()


def test_repeated_ids_multiply_no_row_of_the_other_columns(spark):
    fx = cohort_fixture(spark, SF_SMALL).where("patientid < 500")
    twice = fx.unionByName(fx.limit(1))
    assert len(cohort(twice, "patientid").select("sex", "patient_status").collect()) == twice.count()


def test_carried_columns_equal_the_steps_alone(spark):
    fx = cohort_fixture(spark, SF_SMALL).withColumn("n_visits", F.lit(3)).withColumn("OUTCOME", F.lit("raw"))
    out = cohort(fx, "patientid")
    steps = rules.row_rules(rules.normalise_names(fx), row_id="PatientID")
    shared = [c for c in steps.columns if c in out.columns]
    assert set(steps.columns) - set(shared) == {rules.IN_CARE}
    assert "outcome" in shared and len(shared) > 150
    assert out.select(shared).exceptAll(steps.select(shared)).count() == 0
    assert out.count() == steps.count()


def test_the_command_line_runs_twice_and_leaves_nothing(spark, extracts):
    from cohortkit.__main__ import main
    scratch = tempfile.mkdtemp(prefix="cohortkit-cli-")
    before = scratch_paths()
    args = ["--plus", f"{extracts}/plus-1", "--legacy", f"{extracts}/legacy-1", "--scratch", scratch,
            "--row-id", "patient_guid"]
    for out in ("a", "b"):
        assert main([*args, "--out", f"{scratch}-out/{out}"]) == 0
        assert os.listdir(scratch) == [] and scratch_paths() == before
    with pytest.raises(ValueError):
        main([*args, "--out", f"{scratch}-out/c", "--report-period", "never"])
    assert os.listdir(scratch) == [] and scratch_paths() == before


def test_a_scratch_owns_what_is_made_in_it(spark):
    with Scratch(spark) as outer:
        n = QUERIES["src_csv"](spark, SF_SMALL).count()
        assert n == 1500 and len(outer.paths()) == 2
        made = outer.paths() + [scratch_path(spark, "kept")]
        spark.range(3).write.parquet(made[-1])
        outer.keep(made[-1])
    assert [os.path.isdir(p.removeprefix("file:")) for p in made] == [False, False, True]
    with pytest.raises(ZeroDivisionError), Scratch(spark) as inner:
        spark.range(3).write.parquet(scratch_path(spark, "lost"))
        paths = inner.paths()
        1 / 0
    assert not os.path.isdir(paths[0].removeprefix("file:"))


def test_scratch_files_go_when_python_ends():
    d = tempfile.mkdtemp(prefix="cohortkit-exit-")
    code = f"""
import sys
sys.path.insert(0, {ROOT!r})
from pyspark.sql import SparkSession
s = (SparkSession.builder.master("local[2]").config("spark.ui.enabled", "false").config("spark.driver.host", "127.0.0.1")
     .config("spark.driver.bindAddress", "127.0.0.1").config("spark.checkpoint.dir", {d!r}).getOrCreate())
from cohortkit.session import scratch_path
s.range(3).write.parquet(scratch_path(s, "some"))
import glob
assert glob.glob({d!r} + "/cohortkit/some-*")
s.stop()
"""
    subprocess.run([sys.executable, "-c", code], check=True, capture_output=True, timeout=300)
    assert glob.glob(f"{d}/cohortkit/*") == []


@pytest.mark.parametrize("missing", ["public_tokenizers", "corpus_pipeline", "cohortkit.llm", "tokenizers"])
def test_the_catalog_stands_without_the_operators(missing):
    code = f"""
import sys, warnings
sys.path.insert(0, {ROOT!r})
class Absent:
    def find_spec(self, name, path=None, target=None):
        if name == {missing!r}:
            raise ModuleNotFoundError("no " + name, name=name)
sys.meta_path.insert(0, Absent())
warnings.simplefilter("ignore")
import __spark_entry__ as e
print(len(e.queries()), len(e.oracle_sql()), "op1_nearest_neighbours" in e.queries())
"""
    out = subprocess.run([sys.executable, "-c", code], capture_output=True, text=True, timeout=300)
    n, sql, operators = out.stdout.split()
    assert int(n) >= 55 and int(sql) >= 55
    if missing != "tokenizers":  # loaded inside tasks only
        assert operators == "False"


@pytest.fixture(scope="module", autouse=True)
def _clean(extracts):
    yield
    shutil.rmtree(extracts, ignore_errors=True)
