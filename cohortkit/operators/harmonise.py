"""Bring two extracts onto one schema: lineage tag, renames, common columns, union."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cohortkit import vocab


def _q(name: str) -> str:
    return f"`{name.replace('`', '``')}`"


def tag_source(df: DataFrame, label: str) -> DataFrame:
    """Constant lineage column ``source``."""
    return df.withColumn("source", F.lit(label))


def rename_plan(columns: list[str], mapping: dict[str, str] = vocab.COLUMN_MAPPING) -> list[str]:
    """Target name for each column: a column whose name matches a mapped
    source name (ignoring case) takes the canonical name; others keep theirs.
    Raises when two columns would end up with the same name."""
    by_source: dict[str, str] = {}
    for canonical, source in mapping.items():
        key = source.lower()
        if by_source.get(key, canonical) != canonical:
            raise ValueError(f"{source!r} maps to both {by_source[key]!r} and {canonical!r}")
        by_source[key] = canonical
    targets = [by_source.get(c.lower(), c) for c in columns]
    seen: dict[str, str] = {}
    for src, dst in zip(columns, targets):
        key = dst.lower()
        if key in seen:
            raise ValueError(f"renaming {src!r} to {dst!r} collides with {seen[key]!r}")
        seen[key] = src
    return targets


def rename_columns(df: DataFrame, mapping: dict[str, str] = vocab.COLUMN_MAPPING) -> DataFrame:
    """All renames in one projection."""
    targets = rename_plan(df.columns, mapping)
    return df.select([F.col(_q(c)).alias(t) for c, t in zip(df.columns, targets)])


def common_columns(left: DataFrame, right: DataFrame) -> list[str]:
    """Names present in both, exact case, in ``left``'s order."""
    right_names = set(right.columns)
    return [c for c in left.columns if c in right_names]


def union_sources(left: DataFrame, right: DataFrame) -> DataFrame:
    """UNION ALL over the common columns; duplicates are kept."""
    cols = common_columns(left, right)
    return left.select([_q(c) for c in cols]).unionByName(right.select([_q(c) for c in cols]))


def dropped_columns(left: DataFrame, right: DataFrame) -> dict[str, list[str]]:
    """Columns each side loses in ``union_sources``."""
    common = set(common_columns(left, right))
    return {"left": [c for c in left.columns if c not in common],
            "right": [c for c in right.columns if c not in common]}


def harmonise(plus: DataFrame, legacy: DataFrame,
              mapping: dict[str, str] = vocab.COLUMN_MAPPING) -> DataFrame:
    """Tag both extracts, rename the second-system one to canonical names and
    stack them on their common columns."""
    p = rename_columns(tag_source(plus, vocab.SOURCE_PLUS), mapping)
    lg = tag_source(legacy, vocab.SOURCE_LEGACY)
    return union_sources(p, lg)
