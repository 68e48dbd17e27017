"""The whole cohort derivation as one Spark plan.

Plan shape (per run):

1. read both extracts as text, harmonise, UNION ALL, and write that input
   once, with a generated row id, to the shared checkpoint folder: the text
   is parsed once, and the branches below read only the columns they need;
2. narrow branch: row id + the dedup key columns -> three first-of-group
   flags and one duplicate ordinal (skew-safe, see ``operators.dedup``);
3. wide branch: the input rows joined to those on the row id (the only
   shuffle of wide rows), then every per-row rule as a few collapsed
   projections, then labels. Columns that no rule reads travel as one array
   (``rules.Packed``) from the scan to the last projection.

Every rule is a built-in Column expression: no Python runs per row.
"""

from __future__ import annotations

import warnings
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cohortkit import vocab
from cohortkit.operators import dedup, harmonise as hz, rules
from cohortkit.session import scratch_path
from cohortkit.sources.csv import read_extract

ROW_ID = "__row_id"


def with_row_id(spark: SparkSession, df: DataFrame, name: str = ROW_ID, path: str | None = None) -> DataFrame:
    """Materialise ``df`` with a unique id at ``path`` (default: a new one in the
    shared checkpoint folder, removed by ``session.drop_scratch``).

    The id comes from the partition and position of each row and is written
    out once, so every later read sees the same ids (recomputing it from an
    unmaterialised plan could renumber rows after a lost executor).
    """
    path = path or scratch_path(spark, "cohort-input")
    df.withColumn(name, F.monotonically_increasing_id()).write.parquet(path)
    return spark.read.parquet(path)


def _unique(flags: DataFrame, row_id: str) -> DataFrame:
    """One row per id. A repeated id would multiply rows in the join that follows,
    so it ends the job: in a filter, which stays in the plan whichever flag is read.
    The aggregate uses the shuffle that the join needs."""
    names = [c for c in flags.columns if c != row_id]
    one = flags.groupBy(row_id).agg(*[F.min(c).alias(c) for c in names], F.count(F.lit(1)).alias("__n"))
    repeated = F.raise_error(F.concat(F.lit(f"row id {row_id} is not unique: "), F.col(row_id).cast("string")))
    return one.where(F.when(F.col("__n") > 1, repeated.cast("boolean")).otherwise(F.lit(True))).select(row_id, *names)


ORDER = "__order"


def ordered(spark: SparkSession, rows: DataFrame, by: str) -> DataFrame:
    """``ROW_ID`` and ``ORDER``, a number that follows the ids in column ``by``, written once.

    Rows are sorted by the id's integer value (other texts first), its text, the
    source, a hash of the whole row and last their written position, so no two
    rows tie, equal ids and NULLs are spread over all partitions of the range,
    and which of several rows with one id comes first depends on what they
    hold, not on how the files were split. Only these columns are shuffled.
    """
    content = F.xxhash64(*[F.col(f"`{c}`") for c in rows.columns if c != ROW_ID])
    keys = rows.select(F.col(by).try_cast("bigint").alias("whole"), F.col(by).cast("string").alias("text"),
                       F.col("source"), content.alias("content"), F.col(ROW_ID))
    path = scratch_path(spark, "cohort-order")
    # ids of later partitions are larger, so a sorted frame is numbered in its order
    (keys.orderBy(*keys.columns).select(ROW_ID, F.monotonically_increasing_id().alias(ORDER))
     .write.parquet(path))
    return spark.read.parquet(path)


def cohort(df: DataFrame, row_id: str, *, date_columns: Sequence[str] = vocab.DATE_COLUMNS,
           report_period=vocab.REPORT_PERIOD, as_of=None, vocabulary: str = "reference",
           visit_key: Sequence[str] | None = None, bucket_rows: int | None = None,
           keep_in_care: bool = False, order: DataFrame | None = None) -> DataFrame:
    """All derived columns for harmonised text rows.

    ``row_id`` names a unique, non-NULL integer column (it orders rows
    within duplicate groups); a repeated or NULL id ends with an error any job
    that reads a duplicate flag or label, the columns that depend on ids, and
    never multiplies or drops rows of the others. ``order`` (from ``ordered``)
    gives rows another order within their groups. ``as_of`` (default: the
    report period) is the date ages are counted to.
    """
    base = rules.normalise_names(df)
    rules.check_inputs(base, date_columns)
    row_id = rules.resolve(base, row_id)
    opts = dict(date_columns=date_columns, report_period=report_period, as_of=as_of,
                vocabulary=vocabulary, visit_key=visit_key, row_id=row_id)
    keys = dedup.dedup_keys(base, row_id, report_period if as_of is None else as_of)
    if order is None:
        flags = dedup.family_flags(keys, row_id, bucket_rows)
    else:
        flags = dedup.family_flags(keys.join(order, row_id).drop(row_id), ORDER, bucket_rows)
        flags = flags.join(order, ORDER).drop(ORDER)
    flags = _unique(flags, row_id)
    known = F.when(F.col(row_id).isNull(), F.raise_error(F.lit(f"row id {row_id} is NULL"))).otherwise(F.col(row_id))
    read = [*rules.REQUIRED_INPUTS, *date_columns, *(visit_key or ()), row_id]
    packed = rules.Packed(base, read, date_columns)
    rows = packed.pack(base).withColumn(row_id, known).join(flags, row_id, "left")
    out = dedup.label_flags(dedup.guid_unify(rules.row_rules(rows, packed=packed, **opts)))
    return packed.unpack(out if keep_in_care else out.drop(rules.IN_CARE))


def run(spark: SparkSession, plus_paths: str | Sequence[str], legacy_paths: str | Sequence[str],
        *, report_period=vocab.REPORT_PERIOD, as_of=None,
        mapping: dict[str, str] = vocab.COLUMN_MAPPING, row_id: str | None = None,
        scratch: str | None = None, **kwargs) -> DataFrame:
    """Read both CSV extracts and derive the cohort frame.

    The harmonised input is written at the call, to ``scratch`` or else to a
    new path in the shared checkpoint folder; the frame itself is lazy and
    reads that copy. ``session.Scratch`` around the call removes it when the
    frame is done with. Columns that only one extract has are left out, with a
    warning that names them.

    Rows are told apart by a generated id, so no input row is lost or
    repeated whatever the extracts' ids look like; it follows the order in
    which Spark reads the extracts, and the first row of a duplicate group is
    the one with the smallest. With ``row_id``, an id column of theirs of any
    kind, groups are ordered by it instead (see ``ordered``): its narrow sort is
    the only other shuffle, the wide rows are moved once either way.
    """
    plus, legacy = read_extract(spark, plus_paths), read_extract(spark, legacy_paths)
    lost = hz.dropped_columns(hz.rename_columns(plus, mapping), legacy)
    for side, columns in lost.items():
        if columns:
            warnings.warn(f"columns of the {'plus' if side == 'left' else 'legacy'} extract left out: {columns}",
                          stacklevel=2)
    combined = hz.harmonise(plus, legacy, mapping)
    name = None if row_id is None else rules.resolve(combined, row_id)
    combined = with_row_id(spark, combined, path=scratch)
    order = None if name is None else ordered(spark, combined, name)
    return cohort(combined, ROW_ID, report_period=report_period, as_of=as_of, order=order, **kwargs).drop(ROW_ID)
