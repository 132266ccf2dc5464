"""Joins: filings x pivoted facts (JON2 + FLT4), facts x transcripts (JON3),
the request grid (JON6)."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def null_safe_join(left: DataFrame, right: DataFrame, keys: Sequence[str], how: str = "left") -> DataFrame:
    """Equi-join on ``keys`` where null matches null (pandas merge semantics).

    Spark rewrites ``<=>`` keys into ordinary hash keys, so this stays a
    sort-merge / broadcast hash join; output keeps the left key columns.
    """
    r = right.select(*[F.col(k).alias(f"_rk_{k}") for k in keys], *[c for c in right.columns if c not in keys])
    cond = reduce(lambda a, b: a & b, [left[k].eqNullSafe(r[f"_rk_{k}"]) for k in keys])
    return left.join(r, cond, how).drop(*[f"_rk_{k}" for k in keys])


FILING_COLUMNS = ("accessionNumber", "reportDate", "form", "filingDate", "primaryDocDescription", "fileURL")


def merge_filings(
    pivot: DataFrame,
    filings: DataFrame,
    keys: Sequence[str] = ("accessionNumber", "filingDate"),
    end_col: str = "endDate",
    report_col: str = "reportDate",
    filing_columns: Sequence[str] = FILING_COLUMNS,
    same_year: bool = True,
) -> DataFrame:
    """JON2 + FLT4: inner join on the accession and filing date, then keep rows
    whose period end lies in the report year.  The ticker comes from the facts.

    The filing side keeps its list position (``filing_pos``) and its list's
    ticker (``filing_ticker``) when present: together they are the row order
    the quarter normalisation needs, one list after the other.
    """
    cols = [F.col(c) for c in filing_columns if c in filings.columns]
    if "filing_pos" in filings.columns:
        cols.append(F.col("filing_pos"))
        if "ticker" in filings.columns:
            cols.append(F.col("ticker").alias("filing_ticker"))
    joined = filings.select(*cols).join(pivot, list(keys), "inner")
    if same_year:
        joined = joined.filter(F.year(F.col(end_col)) == F.year(F.col(report_col)))
    return joined


def attach_transcripts(facts: DataFrame, transcripts: DataFrame, key: str = "transcriptID") -> DataFrame:
    """JON3: left join of the transcript measures on the transcript key.
    Null keys match each other; duplicate right keys multiply left rows."""
    return null_safe_join(facts, transcripts, [key], "left")


def request_grid(keys: DataFrame, years: Sequence[int] | Column, quarters: Sequence[int] = (1, 2, 3, 4)) -> DataFrame:
    """JON6: every key x year x quarter.

    Written as two generators over arrays, so it is a narrow per-row expansion
    (no cross join and no shuffle); output size is rows(keys) * len(years) *
    len(quarters).  ``years`` may be a column of a small array, such as a
    scalar subquery over the years that occur.
    """
    listed = years if isinstance(years, Column) else F.array(*[F.lit(int(y)) for y in years])
    return keys.withColumn("year", F.explode(listed.cast("array<int>"))).withColumn(
        "quarter", F.explode(F.array(*[F.lit(int(q)) for q in quarters]))
    )


def years_of(df: DataFrame, date_col: str) -> Column:
    """The distinct years of a date column as a scalar subquery: an array of
    calendar years, found when the plan runs and not while it is built."""
    return df.agg(F.array_sort(F.collect_set(F.year(date_col)))).scalar()
