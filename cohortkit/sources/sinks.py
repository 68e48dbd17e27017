"""Writers for the finished cohort frame."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame


def jdbc_writer(df: DataFrame, url: str, table: str, *, user: str | None = None,
                password: str | None = None, driver: str | None = None,
                mode: str = "overwrite", **options: str):
    """A configured ``DataFrameWriter`` for a JDBC table (call ``.save()``).

    Connection details are arguments, never embedded. Each partition opens
    its own connection, so size ``numPartitions``/``batchsize`` for the
    target database.
    """
    w = df.write.mode(mode).format("jdbc").option("url", url).option("dbtable", table)
    for key, value in (("user", user), ("password", password), ("driver", driver)):
        if value is not None:
            w = w.option(key, value)
    for key, value in options.items():
        w = w.option(key, value)
    return w


def write_jdbc(df: DataFrame, url: str, table: str, **kwargs) -> None:
    """Overwrite ``table`` at ``url`` with ``df``."""
    jdbc_writer(df, url, table, **kwargs).save()


def write_parquet(df: DataFrame, path: str, partition_by: Sequence[str] = ("report_period",),
                  mode: str = "overwrite") -> None:
    """Parquet output partitioned by report period, so readers of one period
    prune to its directory. Overwriting replaces only the partitions that
    ``df`` has rows for: earlier periods stay."""
    w = df.write.mode(mode)
    if partition_by:
        w = w.option("partitionOverwriteMode", "dynamic").partitionBy(*partition_by)
    w.parquet(path)
