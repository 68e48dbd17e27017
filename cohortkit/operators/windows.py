"""Group-wise window results that stay parallel when one group is huge.

``Window.partitionBy(keys)`` sends every row of a key group to one task, so a
group holding a third of the table becomes a third of the job in one task.
The operators here never do that:

* ``group_first_ids`` / ``mark_first`` / ``first_in_group`` (``row_number() = 1``):
  the first row is the one with the group's smallest id, a map-side-combined
  ``min`` (a hot group costs one partial row per input partition), matched
  back by a join on the id itself.
* ``group_ordinal`` (``row_number()``) numbers rows within *id buckets*,
  ``floor(id / bucket_rows)``, and adds the rows of the group's earlier
  buckets. Those sums go through two levels, buckets within *spans* of
  ``SPAN`` buckets and spans within the group, so no task gets more than
  ``bucket_rows`` rows of a group, ``SPAN`` buckets of a span, or as many
  spans as 64-bit ids allow (under ``SPAN`` at the default width) - however
  the ids are spread: dense, hash-like or clustered.
* ``group_extent`` (``min``/``max`` over the group) combines map-side, and
  matches the result back to the rows on (group, salt); a group's result is
  repeated only for salts that its rows have.

Buckets are monotone in the id, so ordering a group by (bucket, id) is
ordering it by id: results do not depend on ``bucket_rows``.

Key columns are packed into one struct so NULL key parts group together in
windows and joins alike (struct equality treats NULL fields as equal).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

DEFAULT_BUCKET_ROWS = 1 << 20
BUCKET_ROWS_CONF = "cohortkit.window.bucketRows"

SPAN = 1 << 22
DEFAULT_SALTS = 256

_GK, _B, _S, _LOC, _N, _OFF, _SOFF, _MIN, _MAX, _FIRST = (
    "__gk", "__bucket", "__span", "__local_rn", "__n", "__offset", "__span_offset", "__gmin", "__gmax", "__first_id")


def bucket_rows_for(df: DataFrame, bucket_rows: int | None) -> int:
    if bucket_rows is not None:
        return int(bucket_rows)
    return int(df.sparkSession.conf.get(BUCKET_ROWS_CONF, str(DEFAULT_BUCKET_ROWS)))


def _bucket(value: Column, width: int) -> Column:
    """Number of the range of ``width`` values that a BIGINT lies in, exact over
    all of BIGINT (a quotient in DOUBLE is not): towards minus infinity."""
    w = F.lit(width).cast("bigint")
    return F.call_function("div", value, w) - (F.call_function("mod", value, w) < 0).cast("bigint")


def group_ordinal(df: DataFrame, keys: Sequence[str], row_id: str, out: str,
                  bucket_rows: int | None = None, span: int = SPAN) -> DataFrame:
    """``row_id`` and ``row_number() OVER (PARTITION BY keys ORDER BY row_id)``
    as ``out`` (BIGINT), one row per input row; join it back on ``row_id``.

    ``row_id`` must be a unique, non-NULL integer column.
    """
    width = bucket_rows_for(df, bucket_rows)
    keyed = df.select(F.col(row_id), F.struct(*[F.col(k) for k in keys]).alias(_GK),
                      _bucket(F.col(row_id).cast("bigint"), width).alias(_B))
    local = keyed.withColumn(_LOC, F.row_number().over(Window.partitionBy(_GK, _B).orderBy(row_id)))
    # rows per (group, bucket), in the partitioning the window has: its shuffle of the keys is read again
    sizes = local.groupBy(_GK, _B).agg(F.max(_LOC).cast("bigint").alias(_N)).withColumn(_S, _bucket(F.col(_B), span))

    def earlier(order: str, *by: str) -> Column:
        before = Window.partitionBy(*by).orderBy(order).rowsBetween(Window.unboundedPreceding, -1)
        return F.coalesce(F.sum(_N).over(before), F.lit(0))

    spans = (sizes.groupBy(_GK, _S).agg(F.sum(_N).alias(_N))
             .select(_GK, _S, earlier(_S, _GK).alias(_SOFF)))
    # only buckets after a group's first one carry an offset
    offsets = (sizes.withColumn(_OFF, earlier(_B, _GK, _S)).join(spans, [_GK, _S])
               .select(_GK, _B, (F.col(_OFF) + F.col(_SOFF)).alias(_OFF)).where(F.col(_OFF) > 0))
    return (local.join(offsets, [_GK, _B], "left")
            .select(row_id, (F.col(_LOC) + F.coalesce(F.col(_OFF), F.lit(0))).alias(out)))


def group_first_ids(df: DataFrame, keys: Sequence[str], row_id: str) -> DataFrame:
    """The smallest ``row_id`` of every key group (one column, ``__first_id``).

    A map-side-combined aggregate: a huge group costs one partial row per
    input partition, never one task holding the group.
    """
    return df.groupBy(*keys).agg(F.min(row_id).alias(_FIRST)).select(_FIRST)


def mark_first(rows: DataFrame, first_ids: DataFrame, row_id: str, out: str) -> DataFrame:
    """``rows`` plus INT ``out``: 1 where the row id is a group's first id.

    The match is a join on the row id itself, which no key skew can unbalance.
    """
    joined = rows.join(first_ids, rows[row_id] == first_ids[_FIRST], "left")
    return joined.withColumn(out, F.col(_FIRST).isNotNull().cast("int")).drop(_FIRST)


def first_in_group(df: DataFrame, keys: Sequence[str], row_id: str, out: str) -> DataFrame:
    """``row_id`` and ``(row_number() OVER (PARTITION BY keys ORDER BY row_id) = 1)``
    as INT ``out``, one row per input row."""
    return mark_first(df.select(row_id), group_first_ids(df, keys, row_id), row_id, out)


def group_extent(df: DataFrame, keys: Sequence[str], measure: str, row_id: str,
                 min_out: str, max_out: str, salts: int = DEFAULT_SALTS) -> DataFrame:
    """``df`` plus ``min(measure)`` and ``max(measure)`` over each key group.

    The group work runs on a narrow projection (row id, group, salt,
    measure): partial min/max per (group, salt), combined per group over
    those, matched back to row ids on (group, salt). A group of any size is
    spread over ``salts`` tasks. The wide rows then meet the result on the
    row id.

    When the measure is itself a key, every group holds one value of it and
    both results equal the measure; that case needs no shuffle at all.
    """
    if measure in keys:
        return df.withColumn(min_out, F.col(measure)).withColumn(max_out, F.col(measure))
    salt = F.pmod(F.xxhash64(F.col(row_id)), F.lit(salts)).cast("int").alias(_B)
    x = df.select(F.col(row_id), F.struct(*[F.col(k) for k in keys]).alias(_GK), salt, F.col(measure))
    partial = x.groupBy(_GK, _B).agg(F.min(measure).alias(_MIN), F.max(measure).alias(_MAX))
    # at most ``salts`` small rows per group meet here
    whole = partial.groupBy(_GK).agg(F.min(_MIN).alias(min_out), F.max(_MAX).alias(max_out),
                                     F.collect_list(_B).alias(_S))
    per_salt = whole.select(_GK, min_out, max_out, F.explode(_S).alias(_B))
    extents = x.join(per_salt, [_GK, _B]).select(row_id, min_out, max_out)
    return df.join(extents, row_id, "left")
