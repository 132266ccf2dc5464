"""Tag roll-up and canonical-tag filtering (SCL4, FLT2, PIP3)."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerlake import fixed
from ledgerlake.functions.scalars import parse_date


def child_to_parent(hierarchy: Mapping[str, Sequence[str]]) -> dict[str, str]:
    """Invert parent -> children; a later parent wins a child listed twice."""
    out: dict[str, str] = {}
    for parent, children in hierarchy.items():
        for child in children:
            out[child] = parent
    return out


def roll_up_tag(c: Column | str, hierarchy: Mapping[str, Sequence[str]] = fixed.TAG_HIERARCHY) -> Column:
    """SCL4 as an expression: child tag -> parent; unknown tags pass through.

    The dictionary is a literal map inside the plan (tens of entries): the
    lookup is evaluated per row inside whole-stage codegen, with no join and
    no shuffle.  A dictionary of thousands of entries belongs in a table
    joined on the tag instead.
    """
    col = F.col(c) if isinstance(c, str) else c
    mapping = child_to_parent(hierarchy)
    # One SQL literal instead of one JVM call per entry.
    entries = ", ".join(f"{_sql_str(k)}, {_sql_str(v)}" for k, v in mapping.items())
    lookup = F.expr(f"map({entries})")
    return F.coalesce(F.try_element_at(lookup, col), col)


def _sql_str(value: str) -> str:
    return "'" + value.replace("\\", "\\\\").replace("'", "\\'") + "'"


def map_tags(
    df: DataFrame,
    tag_col: str = "finType",
    hierarchy: Mapping[str, Sequence[str]] = fixed.TAG_HIERARCHY,
    out_col: str | None = None,
) -> DataFrame:
    """SCL4: replace (or add as ``out_col``) the rolled-up tag."""
    return df.withColumn(out_col or tag_col, roll_up_tag(tag_col, hierarchy))


def keep_canonical(
    df: DataFrame, tag_col: str = "finType", tags: Sequence[str] | None = None
) -> DataFrame:
    """FLT2: keep rows whose tag is one of the canonical metrics."""
    tags = list(fixed.TAG_HIERARCHY) if tags is None else list(tags)
    return df.filter(F.col(tag_col).isin(tags))


def raw_tag_allow_list(hierarchy: Mapping[str, Sequence[str]] = fixed.TAG_HIERARCHY) -> list[str]:
    """Raw tags whose roll-up is canonical.  Every parent of the dictionary is
    canonical, so: rolled-up tag canonical <=> raw tag is a listed child or a
    canonical name.  As an ``isin`` on the raw column this reaches the scan."""
    return sorted(set(child_to_parent(hierarchy)) | set(hierarchy))


def keep_rollup_canonical(
    df: DataFrame, tag_col: str = "finType", hierarchy: Mapping[str, Sequence[str]] = fixed.TAG_HIERARCHY
) -> DataFrame:
    """SCL4 + FLT2 in the cheap order: filter the raw tags (pushed down to the
    Parquet reader), then roll up only the rows that survive."""
    return map_tags(df.filter(F.col(tag_col).isin(raw_tag_allow_list(hierarchy))), tag_col, hierarchy)


def clean_facts(
    df: DataFrame,
    tag_col: str = "finType",
    date_key_col: str = "yearMonthDay",
    columns: Sequence[str] = ("finType", "end", "val", "accn", "fp", "filed", "start", "ticker", "frame"),
    tags: Sequence[str] | None = None,
    check_tags: bool = True,
) -> DataFrame:
    """PIP3: canonical tags only, ``endDate`` parsed from the ``yyyyMMdd`` key,
    fixed column subset.  The original sort by (key, val) only steered a
    'first' aggregate that is a max here, so no sort is needed.
    ``check_tags=False`` when the rows were already restricted by
    ``keep_rollup_canonical``."""
    kept = keep_canonical(df, tag_col, tags) if check_tags else df
    present = [c for c in columns if c in df.columns]
    return kept.select(*present, parse_date(date_key_col, "yyyyMMdd").alias("endDate"))
