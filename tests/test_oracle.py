"""Every registered query against its independent DuckDB oracle."""

import pytest

from conftest import SF_MID, SF_SMALL, assert_same

import __spark_entry__ as entry
from cohortkit.plans.catalog import QUERIES

ORACLE = {name: sql for name, sql in entry.oracle_sql().items() if name in QUERIES}


def test_every_query_has_an_oracle():
    assert set(QUERIES) == set(ORACLE)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_oracle_small(spark, duck, name):
    assert_same(QUERIES[name](spark, SF_SMALL), duck(SF_SMALL), ORACLE[name])


@pytest.mark.parametrize("name", ["cohort_frame", "dedup_labels", "visit_window_patient",
                                  "patient_status", "src_csv"])
def test_query_matches_oracle_mid(spark, duck, name):
    assert_same(QUERIES[name](spark, SF_MID), duck(SF_MID), ORACLE[name])


def test_entry_smoke(spark):
    df = entry.entry(spark)
    assert df.count() == 1500
    assert len(df.columns) == len(set(c.lower() for c in df.columns))
