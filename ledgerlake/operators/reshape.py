"""Pivot of long facts to one row per filing and period (AGG1, SCL20, FLT3)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerlake import fixed
from ledgerlake.functions.scalars import fill_period, null_count, parse_date

_AGGS = {"max": F.max, "min": F.min, "sum": F.sum, "avg": F.avg, "first": F.max}


def pivot_wide(
    df: DataFrame,
    keys: Sequence[str],
    pivot_col: str,
    value_col: str,
    values: Sequence[str],
    agg: str = "max",
) -> DataFrame:
    """AGG1: one column per pivot value, aggregated per key.

    Written as conditional aggregates over an explicit value list: a single
    hash aggregate with a map-side partial step and one shuffle on ``keys``
    (``groupBy().pivot()`` would aggregate on keys + pivot value first and
    shuffle twice).  Every listed value yields a column even if absent.
    'first' after the original descending sort equals 'max' in a cell.
    """
    if agg not in _AGGS:
        raise ValueError(f"unsupported aggregate {agg!r}")
    fn = "max" if agg == "first" else agg
    pv, val = _quote(pivot_col), _quote(value_col)
    # Each aggregate is one SQL expression (one JVM call rather than six).
    return df.groupBy(*keys).agg(
        *[F.expr(f"{fn}(CASE WHEN {pv} = {_sql_str(v)} THEN {val} END)").alias(v) for v in values]
    )


def _quote(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def _sql_str(value: str) -> str:
    return "'" + value.replace("\\", "\\\\").replace("'", "\\'") + "'"


def drop_sparse(
    df: DataFrame,
    columns: Sequence[str] = fixed.COUNTED_METRICS,
    max_nulls_exclusive: int = fixed.MAX_NULLS_EXCLUSIVE,
) -> DataFrame:
    """FLT3: keep rows with fewer than ``max_nulls_exclusive`` nulls in ``columns``."""
    return df.filter(null_count(list(columns)) < max_nulls_exclusive)


def pivot_facts(
    facts: DataFrame,
    ticker_col: str = "ticker",
    accession_col: str = "accn",
    period_col: str = "fp",
    filed_col: str = "filed",
    end_col: str = "endDate",
    tag_col: str = "finType",
    value_col: str = "val",
    metrics: Sequence[str] | None = None,
    counted: Sequence[str] = fixed.COUNTED_METRICS,
    max_nulls_exclusive: int = fixed.MAX_NULLS_EXCLUSIVE,
) -> DataFrame:
    """AGG1 + SCL20 + FLT3 on filing facts.

    Output: ticker, accessionNumber, financialPeriod, filingDate, endDate and
    one double column per metric.
    """
    metrics = list(fixed.TAG_HIERARCHY) if metrics is None else list(metrics)
    prepared = facts.select(
        F.col(ticker_col).alias("ticker"),
        F.col(accession_col).alias("accessionNumber"),
        fill_period(period_col).alias("financialPeriod"),
        parse_date(filed_col).alias("filingDate"),
        F.to_date(F.col(end_col)).alias("endDate"),
        F.col(tag_col).alias("_tag"),
        F.col(value_col).cast("double").alias("_val"),
    )
    keys = ["ticker", "accessionNumber", "financialPeriod", "filingDate", "endDate"]
    wide = pivot_wide(prepared, keys, "_tag", "_val", metrics)
    return drop_sparse(wide, counted, max_nulls_exclusive)
