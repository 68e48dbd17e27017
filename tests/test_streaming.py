"""The per-row rules on a file stream equal the batch rules."""

import tempfile

from conftest import SF_SMALL
from cohortkit.operators import rules
from cohortkit.sources import csv as csv_io
from cohortkit.sources.fixture import cohort_fixture
from cohortkit.streaming import read_extract_stream, stream_row_rules


def test_stream_row_rules_equal_batch(spark):
    d = tempfile.mkdtemp(prefix="cohortkit-stream-")
    fx = cohort_fixture(spark, SF_SMALL)
    csv_io.write_extract(fx, f"{d}/in")
    stream = read_extract_stream(spark, f"{d}/in", fx.columns)
    out = stream_row_rules(stream).select("PatientID", "patient_status", "hiv_cascade", "TX_ML")
    q = (out.writeStream.format("memory").queryName("cohort_stream_test")
            .option("checkpointLocation", f"{d}/ckpt").outputMode("append").start())
    q.processAllAvailable()
    q.stop()
    got = spark.sql("SELECT * FROM cohort_stream_test").collect()
    batch = rules.row_rules(rules.normalise_names(csv_io.read_extract(spark, f"{d}/in")))
    want = batch.select("PatientID", "patient_status", "hiv_cascade", "TX_ML").collect()
    assert sorted(map(tuple, got)) == sorted(map(tuple, want))
    assert len(got) > 0
