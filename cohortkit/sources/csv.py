"""Header CSV extracts read as all-text DataFrames."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession


def read_extract(spark: SparkSession, paths: str | Sequence[str]) -> DataFrame:
    """Every column is a nullable string named by the file header.

    No schema inference (it would cost a second pass over the data) and no
    positional schema: the header, not the column position, carries meaning.
    Each path is read under its own header, and the paths are stacked by
    column name: columns may be in another order, one that a path lacks is
    NULL for its rows. The files that one path matches must share a header;
    a file whose header differs fails the read (``enforceSchema`` is off)
    instead of being misread by position.
    """
    if isinstance(paths, str):
        paths = [paths]
    parts = [spark.read
             .option("header", True)
             .option("inferSchema", False)
             .option("enforceSchema", False)
             .option("mode", "PERMISSIVE")
             .csv(path) for path in paths]
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part, allowMissingColumns=True)
    return out


def write_extract(df: DataFrame, path: str) -> None:
    """Write a DataFrame as header CSV (used to build extract-shaped inputs)."""
    (df.write.mode("overwrite")
       .option("header", True)
       # keep blanks: the writer trims them by default
       .option("ignoreLeadingWhiteSpace", False)
       .option("ignoreTrailingWhiteSpace", False)
       .csv(path))
