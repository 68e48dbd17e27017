"""Renames, common columns and the union of two differently named extracts."""

import pytest

from cohortkit import vocab
from cohortkit.operators import harmonise as hz


def test_rename_maps_case_insensitively_and_ignores_absent_names(spark):
    df = spark.createDataFrame([("1", "x", "y", "z")], "PatientId string, MappedGuid string, dsd string, extra string")
    out = hz.rename_columns(df)
    assert out.columns == ["PatientID", "patient_guid", "DSDModel", "extra"]


def test_rename_collision_fails_early(spark):
    df = spark.createDataFrame([("1", "2")], "dsd string, DSDModel string")
    with pytest.raises(ValueError):
        hz.rename_columns(df)


def test_conflicting_mapping_fails(spark):
    df = spark.createDataFrame([("1",)], "a string")
    with pytest.raises(ValueError):
        hz.rename_columns(df, {"A1": "a", "A2": "a"})


def test_common_columns_exact_case_in_left_order(spark):
    left = spark.createDataFrame([("1", "2", "3")], "b string, a string, Sex string")
    right = spark.createDataFrame([("1", "2", "3")], "a string, sex string, b string")
    assert hz.common_columns(left, right) == ["b", "a"]
    assert hz.dropped_columns(left, right) == {"left": ["Sex"], "right": ["sex"]}


def test_union_by_name_with_different_orders_keeps_duplicates(spark):
    plus = spark.createDataFrame([("1", "F", "dup"), ("1", "F", "dup")],
                                 "patientid string, sex string, onlyplus string")
    legacy = spark.createDataFrame([("M", "2", "x")], "Sex string, PatientID string, onlylegacy string")
    out = hz.harmonise(plus, legacy)
    assert sorted(out.columns) == ["PatientID", "Sex", "source"]
    rows = sorted(tuple(r) for r in out.select("PatientID", "Sex", "source").collect())
    assert rows == [("1", "F", vocab.SOURCE_PLUS), ("1", "F", vocab.SOURCE_PLUS),
                    ("2", "M", vocab.SOURCE_LEGACY)]


def test_mapping_has_78_lines_and_77_names():
    assert len(vocab.COLUMN_MAPPING_LINES) == 78
    assert len(vocab.COLUMN_MAPPING) == 77
