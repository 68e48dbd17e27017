"""Command line: derive the cohort frame from two CSV extracts and write it.

    spark-submit cohortkit/__main__.py --plus 's3://in/plus/*.csv' \\
        --legacy s3://in/legacy.csv --out s3://out/cohort --report-period 2024-03-13

(or ``python -m cohortkit ...`` with ``pyspark`` installed).

Any scheduler can run this (or call ``main``); the Spark session, cluster
sizing and ``spark.checkpoint.dir`` come from the submitting environment.
"""

from __future__ import annotations

import argparse
import json
import sys
import uuid

from pyspark.sql import SparkSession

from cohortkit import vocab
from cohortkit.plans.cohort import run
from cohortkit.session import Scratch, drop_scratch
from cohortkit.sources.sinks import write_parquet


def parse_args(argv: list[str] | None = None) -> argparse.Namespace:
    p = argparse.ArgumentParser(prog="cohortkit", description=__doc__.splitlines()[0])
    p.add_argument("--plus", nargs="+", required=True, help="second-system extract path(s)")
    p.add_argument("--legacy", nargs="+", required=True, help="legacy extract path(s)")
    p.add_argument("--out", required=True, help="output folder (Parquet)")
    p.add_argument("--report-period", default=vocab.REPORT_PERIOD)
    p.add_argument("--as-of", default=None, help="date ages are counted to (default: report period)")
    p.add_argument("--row-id", default=None, help="id column of the extracts that orders duplicates")
    p.add_argument("--mapping", default=None, help="JSON file: canonical column name -> second-system name")
    p.add_argument("--date-columns", default=None, help="JSON file: list of the date columns")
    p.add_argument("--scratch", default=None, help="folder under which the harmonised input is kept during the run")
    p.add_argument("--vocabulary", choices=["reference", "fixed"], default="reference")
    return p.parse_args(argv)


def load_json(path: str | None, default):
    if path is None:
        return default
    with open(path, encoding="utf-8") as f:
        return json.load(f)


def main(argv: list[str] | None = None) -> int:
    args = parse_args(argv)
    spark = SparkSession.builder.appName("cohortkit").getOrCreate()
    scratch = args.scratch and f"{args.scratch.rstrip('/')}/cohort-input-{uuid.uuid4().hex}"
    try:
        with Scratch(spark):
            write_parquet(run(
                spark, args.plus, args.legacy, report_period=args.report_period, as_of=args.as_of,
                row_id=args.row_id, vocabulary=args.vocabulary, scratch=scratch,
                mapping=load_json(args.mapping, vocab.COLUMN_MAPPING),
                date_columns=load_json(args.date_columns, vocab.DATE_COLUMNS)), args.out)
    finally:
        if scratch:
            drop_scratch(spark, [scratch])
    return 0


if __name__ == "__main__":
    sys.exit(main())
