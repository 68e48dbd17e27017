"""Duplicate tagging: first-of-group flags and 0-based duplicate ordinals.

Rows are never removed. Four key families share the demographic core
(DOB, sex, current_age, ARTStartDate) and add one identifier:

=========  ==============================================  ==========================
family     key                                             outputs
=========  ==============================================  ==========================
guid       OwningGuid + core                               distinct_guid, distinct_GUID_n
guid_name  pt_GUID + core + FirstName, LastName            distinct_GUID, Pt_GUID_dups
art        ARTNumber + core                                distinct_ART
nupn       NUPN + core                                     distinct_NUPN
=========  ==============================================  ==========================

``pt_GUID`` is ``OwningGuid``, so ``distinct_guid`` and ``distinct_GUID_n``
share a family. Within a group rows are ordered by the unique row id, so
"first" and the ordinals are deterministic.

Plan: the key columns are derived once into a narrow frame (row id + keys).
Three families only need "is this the group's first row": the smallest id
per group (map-side combined) matched back on the row id. ``guid_name``
needs full ordinals: the bucketed row number of ``windows.group_ordinal``.
All four results meet on the row id, and the wide rows join them once.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cohortkit import vocab
from cohortkit.functions import clinical as cl
from cohortkit.functions.coerce import parse_date
from cohortkit.functions.dates import completed_years, date_literal
from cohortkit.operators import windows

CORE = ["DOB", "sex", "current_age", "ARTStartDate"]
FAMILIES: dict[str, list[str]] = {
    "guid": ["OwningGuid", *CORE],
    "guid_name": ["pt_GUID", *CORE, "FirstName", "LastName"],
    "art": ["ARTNumber", *CORE],
    "nupn": ["NUPN", *CORE],
}
# family -> flag column in the finished frame (the guid family's first flag
# appears there only as distinct_GUID_n: the reference's later distinct_GUID
# replaces its distinct_guid, names being case-insensitive)
FLAG_FAMILIES = {"guid": "distinct_GUID_n", "art": "distinct_ART", "nupn": "distinct_NUPN"}
RANK = "__rn_guid_name"


def dedup_keys(base: DataFrame, row_id: str, as_of=vocab.REPORT_PERIOD) -> DataFrame:
    """Row id and every family key column, derived from the raw text columns
    with the same builders the row rules use."""
    dob = parse_date("DOB")
    return base.select(
        F.col(row_id), F.col("OwningGuid"), F.col("OwningGuid").alias("pt_GUID"),
        F.col("ARTNumber"), F.col("NUPN"), F.col("FirstName"), F.col("LastName"),
        dob.alias("DOB"), cl.sex_recode("sex").alias("sex"),
        completed_years(date_literal(as_of), dob).alias("current_age"),
        parse_date("ARTStartDate").alias("ARTStartDate"))


def guid_unify(df: DataFrame) -> DataFrame:
    return df.withColumns({"_patient_guid": F.col("patient_guid").cast("string"),
                           "pt_GUID": F.col("OwningGuid")})


def first_flag(keys: DataFrame, family: str, row_id: str, out: str) -> DataFrame:
    """``row_id`` and the family's first-of-group flag."""
    return windows.first_in_group(keys, FAMILIES[family], row_id, out)


def dup_ordinal(keys: DataFrame, row_id: str, bucket_rows: int | None = None) -> DataFrame:
    """``row_id`` and its 1-based position in its ``guid_name`` group."""
    return windows.group_ordinal(keys, FAMILIES["guid_name"], row_id, RANK, bucket_rows)


def first_flags(keys: DataFrame, row_id: str) -> DataFrame:
    """First-of-group flags of the guid, art and nupn families in one pass.

    Those families differ only in their identifier column, so each row is
    emitted once per family as (family, identifier, core keys, row id) and a
    single map-side-combined ``min(row id)`` finds every group's first row.
    The first ids are then pivoted to one row per id with a 0/1 column per
    family. Output: ``__first_id`` and the flag columns, first rows only.
    """
    fam, ident, first = "__family", "__ident", "__first_id"
    # identifiers as text so the three families share one struct type
    per_family = F.explode(F.array(*[
        F.struct(F.lit(f).alias(fam), F.col(FAMILIES[f][0]).cast("string").alias(ident))
        for f in FLAG_FAMILIES]))
    exploded = keys.select(F.col(row_id), *CORE, per_family.alias("__e"))
    firsts = (exploded.groupBy(F.col(f"__e.{fam}").alias(fam), F.col(f"__e.{ident}").alias(ident),
                               *CORE)
                      .agg(F.min(row_id).alias(first)))
    return firsts.groupBy(first).agg(*[
        F.max((F.col(fam) == f).cast("int")).alias(name) for f, name in FLAG_FAMILIES.items()])


def family_flags(keys: DataFrame, row_id: str, bucket_rows: int | None = None) -> DataFrame:
    """``row_id``, the three first-of-group flags and the ``guid_name`` ordinal."""
    ordinal = dup_ordinal(keys, row_id, bucket_rows)
    firsts = first_flags(keys, row_id)
    joined = ordinal.join(firsts, ordinal[row_id] == firsts["__first_id"], "left")
    return joined.select(row_id, RANK,
                         *[F.coalesce(F.col(n), F.lit(0)).alias(n) for n in FLAG_FAMILIES.values()])


def _label_unique(flag: str):
    return F.when(F.col(flag) == 1, vocab.UNIQUE).otherwise(vocab.DUPLICATE)


def _label_dups(dups: str):
    out = None
    for n, label in enumerate(vocab.DUP_LABELS):
        cond = F.col(dups) == n
        out = F.when(cond, label) if out is None else out.when(cond, label)
    return out


def label_flags(df: DataFrame) -> DataFrame:
    """Final flag and label columns from ``family_flags`` output."""
    df = df.withColumns({
        "distinct_GUID": (F.col(RANK) == 1).cast("int"),
        "Pt_GUID_dups": (F.col(RANK) - 1).cast("int"),
    }).drop(RANK)
    return df.withColumns({
        "distinct_GUID_label": _label_unique("distinct_GUID"),
        "distinct_ART_label": _label_unique("distinct_ART"),
        "distinct_NUPN_label": _label_unique("distinct_NUPN"),
        "Pt_GUID_dups_label": _label_dups("Pt_GUID_dups"),
    })


def deduplication(rows: DataFrame, row_id: str, bucket_rows: int | None = None) -> DataFrame:
    """Every dedup output on a frame the per-row rules already derived
    (parsed dates, recoded sex, ``current_age``), the way the reference
    applies its dedup step last. ``row_id`` must be unique and non-NULL."""
    rows = guid_unify(rows)
    keys = rows.select(row_id, *sorted({k for f in FAMILIES.values() for k in f}))
    flags = family_flags(keys, row_id, bucket_rows)
    return label_flags(rows.join(flags, row_id, "left"))
