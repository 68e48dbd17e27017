"""The per-row cohort rules on a streaming source.

Every per-row rule is a Column expression, so it applies unchanged to a
streaming DataFrame (``spark.readStream.csv``): new extract files are
derived as they land. The duplicate flags need the whole table (a row's
flag depends on rows that may arrive later), so they are not computed on a
stream; run ``cohortkit.cohort`` over the accumulated output for those.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StringType, StructField, StructType

from cohortkit import vocab
from cohortkit.operators import rules


def read_extract_stream(spark: SparkSession, path: str, columns: Sequence[str]) -> DataFrame:
    """Header CSV files arriving under ``path``, every column text.

    A file stream needs its schema up front; ``columns`` is the header.
    """
    schema = StructType([StructField(c, StringType(), True) for c in columns])
    return spark.readStream.option("header", True).schema(schema).csv(path)


def stream_row_rules(df: DataFrame, *, date_columns: Sequence[str] = vocab.DATE_COLUMNS,
                     report_period=vocab.REPORT_PERIOD, as_of=None,
                     vocabulary: str = "reference") -> DataFrame:
    """All per-row outputs (reference visit key: no aggregation) on a stream."""
    base = rules.normalise_names(df)
    rules.check_inputs(base, date_columns)
    return rules.row_rules(base, date_columns=date_columns, report_period=report_period,
                           as_of=as_of, vocabulary=vocabulary).drop(rules.IN_CARE)
