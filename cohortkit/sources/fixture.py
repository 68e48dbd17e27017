"""Cohort-shaped input derived from the driver tables ``orders`` and ``customer``.

One SQL text runs in Spark and in DuckDB and yields identical rows: one
patient record per order, all columns text like a CSV extract, with the
edge cases the rules care about (bad numbers, bad dates, NULLs, misspelled
status codes). ``patientid`` (the order key) is unique and non-NULL.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cohortkit import vocab

REPORT_PERIOD = "2024-03-13"

_FIXTURE_BODY = """
SELECT o_orderkey AS patientid,
 CASE WHEN o_custkey % 2 = 0 THEN 'SmartCare Plus' ELSE 'SmartCare Legacy' END AS source,
 CASE WHEN o_custkey % 7 = 0 THEN NULL ELSE 'ART-' || CAST(o_custkey % 600 AS VARCHAR(20)) END AS artnumber,
 CASE WHEN o_custkey % 5 = 0 THEN NULL ELSE 'NUPN-' || CAST(o_custkey AS VARCHAR(20)) END AS nupn,
 'G-' || CAST(o_custkey AS VARCHAR(20)) AS owningguid,
 'P-' || CAST(o_orderkey AS VARCHAR(20)) AS patient_guid,
 CASE WHEN o_orderkey % 3 = 0 THEN c_mktsegment ELSE c_name END AS firstname,
 c_mktsegment AS lastname,
 'Fac-' || CAST(c_nationkey AS VARCHAR(20)) AS facilityname,
 CASE o_orderkey % 8 WHEN 0 THEN NULL WHEN 1 THEN '' WHEN 2 THEN 'Fac-X' ELSE 'Fac-' || CAST(c_nationkey AS VARCHAR(20)) END AS artfacilityname,
 CASE o_custkey % 4 WHEN 0 THEN 'F' WHEN 1 THEN 'M' WHEN 2 THEN 'Unknown' ELSE NULL END AS sex,
 CASE WHEN o_custkey % 97 = 0 THEN '13/05/1990' ELSE CAST(DATE '1940-01-01' + CAST((o_custkey * 7919) % 30500 AS INT) AS VARCHAR(20)) END AS dob,
 CASE WHEN o_orderkey % 13 = 0 THEN NULL WHEN o_orderkey % 29 = 0 THEN CAST(DATE '2024-03-13' - CAST((o_orderkey * 31) % 211 AS INT) AS VARCHAR(20)) ELSE CAST(DATE '2024-03-01' - CAST((o_custkey * 37) % 4900 AS INT) - CAST(o_orderkey % 2 AS INT) * 30 AS VARCHAR(20)) END AS artstartdate,
 CAST(DATE '2024-03-01' - CAST((o_custkey * 37) % 4900 AS INT) - CAST(o_orderkey % 2 AS INT) * 30 - (CAST(o_orderkey % 131 AS INT) - 10) AS VARCHAR(20)) AS hivtestdate,
 CAST(DATE '2024-03-13' - CAST((o_orderkey * 31) % 211 AS INT) AS VARCHAR(20)) AS lastinteraction_date,
 CAST(DATE '2019-01-01' - CAST((o_orderkey * 17) % 900 AS INT) AS VARCHAR(20)) AS firstinteraction_date,
 CASE WHEN o_orderkey % 7 = 0 THEN NULL ELSE CAST(DATE '2024-03-13' - CAST((o_orderkey * 31) % 211 AS INT) + (CAST((o_orderkey * 29) % 430 AS INT) - 15) AS VARCHAR(20)) END AS nextappointmentdate,
 CASE WHEN o_orderkey % 11 < 3 THEN NULL ELSE CAST(DATE '2024-03-13' - CAST((o_orderkey * 31) % 211 AS INT) - CAST(o_orderkey % 5 AS INT) AS VARCHAR(20)) END AS currentartregimendispensationdate,
 CASE o_orderkey % 9 WHEN 0 THEN NULL WHEN 1 THEN 'died' WHEN 2 THEN 'stoppedART' WHEN 3 THEN 'reactivated' WHEN 4 THEN 'reactived' WHEN 5 THEN 'made_inactive' WHEN 6 THEN 'made_inative' WHEN 7 THEN 'transout' ELSE 'other' END AS patient_status,
 CASE WHEN (o_orderkey * 23) % 17 < 4 THEN NULL ELSE CAST(DATE '2024-03-13' - CAST((o_orderkey * 31) % 211 AS INT) + (CAST((o_orderkey * 23) % 17 AS INT) - 10) AS VARCHAR(20)) END AS patient_status_date,
 CASE WHEN o_orderkey % 10 = 0 THEN CAST(DATE '2024-02-01' - CAST(o_orderkey % 300 AS INT) AS VARCHAR(20)) ELSE NULL END AS ancvisitdate,
 CASE WHEN o_orderkey % 10 = 0 THEN CAST(DATE '2024-09-01' - CAST((o_orderkey * 7) % 1500 AS INT) AS VARCHAR(20)) ELSE NULL END AS estimateddateofdelivery,
 CASE WHEN o_orderkey % 6 = 0 THEN NULL ELSE CAST(DATE '2024-03-13' - CAST((o_orderkey * 41) % 700 AS INT) AS VARCHAR(20)) END AS current_vl_date,
 CASE o_orderkey % 6 WHEN 0 THEN NULL WHEN 1 THEN '2500.5' WHEN 2 THEN '3000000000' WHEN 3 THEN 'TND' ELSE CAST((o_orderkey * 53) % 4000 AS VARCHAR(20)) END AS current_vl_copies,
 CASE o_orderkey % 12 WHEN 0 THEN NULL WHEN 1 THEN '50.7' WHEN 2 THEN 'n/a' ELSE CAST((o_orderkey * 19) % 1300 AS VARCHAR(20)) END AS baseline_cd4,
 CASE o_orderkey % 12 WHEN 0 THEN NULL WHEN 1 THEN '24.5' ELSE CAST((o_orderkey * 19) % 60 AS VARCHAR(20)) END AS baseline_cd4_perc,
 CASE WHEN o_orderkey % 19 = 0 THEN '0' WHEN o_orderkey % 19 = 1 THEN NULL ELSE CAST(100 + (o_orderkey * 3) % 90 AS VARCHAR(20)) END AS patientheight,
 CASE o_orderkey % 23 WHEN 0 THEN NULL WHEN 1 THEN '2.9995' WHEN 2 THEN '-0.5' WHEN 3 THEN '2.5' WHEN 4 THEN '4.2' WHEN 5 THEN '7' WHEN 6 THEN '15.5' WHEN 7 THEN 'bad' ELSE CAST(20 + (o_orderkey * 11) % 100 AS VARCHAR(20)) END AS patientweight,
 CASE o_orderkey % 4 WHEN 0 THEN 'Positive' WHEN 1 THEN 'Negative' WHEN 2 THEN 'Indeterminate' ELSE NULL END AS hivtestresults,
 CASE WHEN o_custkey % 3 = 0 THEN NULL ELSE 'TLD' END AS currentartregimen,
 CASE o_orderkey % 5 WHEN 0 THEN NULL WHEN 1 THEN 'Fast Track' WHEN 2 THEN 'Multi Month Scriptiing ' WHEN 3 THEN 'Health Post' ELSE 'Home Delivery' END AS dsdmodel
FROM {orders} JOIN {customer} ON o_custkey = c_custkey
"""

# Two configured date columns the body lacks, filled from sibling dates so
# every configured date column exists and parses.
_SIBLING_DATES = {"current_cd4_countdate": "current_vl_date",
                  "prescriptiondate": "currentartregimendispensationdate"}


def _other_mapped() -> list[str]:
    """The mapped columns that no rule reads (one, ``bmi``, that a rule replaces), lower case."""
    have = set(re.findall(r" AS (\w+),?\n", _FIXTURE_BODY)) | set(_SIBLING_DATES)
    return [c.lower() for c in vocab.COLUMN_MAPPING if c.lower() not in have]


#: Columns that give the fixture the width of a real extract: text, some of it NULL.
OTHER_MAPPED = _other_mapped()
FIXTURE_TEMPLATE = "SELECT fx.*, " + ", ".join(
    [f"fx.{src} AS {name}" for name, src in _SIBLING_DATES.items()]
    + [f"CASE WHEN fx.patientid % {3 + i % 7} = 0 THEN NULL ELSE '{name} ' || "
       f"CAST((fx.patientid * {i + 2}) % 89 AS VARCHAR(20)) END AS {name}"
       for i, name in enumerate(OTHER_MAPPED)]) + " FROM (" + _FIXTURE_BODY + ") fx"


def fixture_sql(orders: str = "orders", customer: str = "customer") -> str:
    """The fixture text with the given table names (DuckDB uses the plain names)."""
    return FIXTURE_TEMPLATE.replace("{orders}", orders).replace("{customer}", customer)


def load_tables(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    orders = spark.read.parquet(f"{sf_dir}/orders.parquet")
    customer = spark.read.parquet(f"{sf_dir}/customer.parquet")
    return orders, customer


def cohort_fixture(spark: SparkSession, sf_dir: str, partitions: int | None = None) -> DataFrame:
    """The fixture over ``{sf_dir}/orders.parquet`` and ``customer.parquet``.

    The two order columns it needs are dealt by customer over ``partitions``
    tasks (default: two per task slot) at any input size: the rules cost far
    more CPU than their bytes suggest, and extracts come in no useful order.
    """
    orders, customer = load_tables(spark, sf_dir)
    partitions = partitions or 2 * spark.sparkContext.defaultParallelism
    orders = orders.select("o_orderkey", "o_custkey").repartition(partitions, "o_custkey")
    return spark.sql(FIXTURE_TEMPLATE, orders=orders, customer=customer)


# ------------------------------------------------------ extract-shaped splits
def _mapping_lower() -> dict[str, str]:
    return {k.lower(): k for k in vocab.COLUMN_MAPPING}


def legacy_shape(fixture: DataFrame) -> DataFrame:
    """Legacy-extract rows: canonical column names, no ``source`` column."""
    canon = _mapping_lower()
    rows = fixture.where(F.col("source") == vocab.SOURCE_LEGACY).drop("source")
    return rows.select([F.col(c).alias(canon.get(c, c)) for c in rows.columns])


def plus_shape(fixture: DataFrame) -> DataFrame:
    """Second-system rows: that system's column names, no ``source`` column."""
    canon = _mapping_lower()
    rows = fixture.where(F.col("source") == vocab.SOURCE_PLUS).drop("source")
    return rows.select([F.col(c).alias(vocab.COLUMN_MAPPING[canon[c]] if c in canon else c)
                        for c in rows.columns])
