"""Projections, renames, null filters and set operations
(PRJ1-PRJ6, FLT1, FLT5-FLT7, SET1, AGG5)."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerlake.functions.scalars import any_null, join_list


def clean_name(name: str) -> str:
    """PRJ1 rule: strip, then space and '-' become '_'."""
    return name.strip().replace(" ", "_").replace("-", "_")


def clean_names(names: Sequence[str], on_collision: str = "fail") -> list[str]:
    """PRJ1 over a header.  Names that clean to the same one (Spark compares
    them without case) fail, listing them; with ``on_collision='number'`` the
    second and later ones get ``_2``, ``_3`` ..., skipping names in use."""
    if on_collision not in ("fail", "number"):
        raise ValueError(f"on_collision is 'fail' or 'number', not {on_collision!r}")
    cleaned = [clean_name(n) for n in names]
    groups: dict[str, list[str]] = {}
    for raw, name in zip(names, cleaned):
        groups.setdefault(name.lower(), []).append(raw)
    clashes = {k: v for k, v in groups.items() if len(v) > 1}
    if clashes and on_collision == "fail":
        raise ValueError(f"columns clean to the same name: {clashes}")
    used, out = set(groups), []
    seen: set[str] = set()
    for name in cleaned:
        if name.lower() in seen:
            n = 2
            while f"{name}_{n}".lower() in used:
                n += 1
            name = f"{name}_{n}"
            used.add(name.lower())
        seen.add(name.lower())
        out.append(name)
    return out


def clean_column_names(df: DataFrame, on_collision: str = "fail") -> DataFrame:
    """PRJ1: rename every column by ``clean_names`` (metadata only)."""
    return df.toDF(*clean_names(df.columns, on_collision))


def rename(df: DataFrame, mapping: Mapping[str, str]) -> DataFrame:
    """PRJ3: rename columns that exist."""
    return df.withColumnsRenamed({k: v for k, v in mapping.items() if k in df.columns})


def flatten_lists(df: DataFrame, sep: str = ", ") -> DataFrame:
    """PRJ4: every array<...> column becomes a ``sep``-joined string."""
    cols = []
    for field in df.schema.fields:
        if field.dataType.typeName() == "array":
            cols.append(join_list(field.name, sep).alias(field.name))
        else:
            cols.append(F.col(field.name))
    return df.select(*cols)


def keep_members(df: DataFrame, col: str, members: Sequence | DataFrame, member_col: str | None = None) -> DataFrame:
    """FLT1: allow-list filter.

    A Python list becomes an ``isin`` predicate (pushed to the Parquet scan);
    a DataFrame of members becomes a left-semi join, which Spark broadcasts
    only when its measured size is under the broadcast threshold.
    """
    if isinstance(members, DataFrame):
        right = members.select(F.col(member_col or col).alias("_member")).distinct()
        return df.join(right, F.col(col) == F.col("_member"), "left_semi")
    return df.filter(F.col(col).isin(list(members)))


def rows_with_nulls(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """FLT5: rows with a null in any of ``cols``."""
    return df.filter(any_null(list(cols)))


def drop_incomplete(df: DataFrame, cols: Sequence[str] | None = None) -> DataFrame:
    """FLT6: drop rows with any null (in ``cols`` or in all columns)."""
    return df.dropna(how="any", subset=list(cols) if cols else None)


def union_all_by_name(*dfs: DataFrame) -> DataFrame:
    """SET1: union by column name; a column absent from an input is null."""
    out = dfs[0]
    for other in dfs[1:]:
        out = out.unionByName(other, allowMissingColumns=True)
    return out


def distinct_rows(df: DataFrame, cols: Sequence[str] | None = None) -> DataFrame:
    """AGG5: distinct rows (map-side partial dedup, one shuffle)."""
    return df.dropDuplicates(list(cols)) if cols else df.distinct()
