"""Dimension builds (PIP4) and the price profile (PIP5)."""

from __future__ import annotations

from collections.abc import Sequence
from importlib import resources

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerlake import fixed
from ledgerlake.functions.scalars import date_key, month_label, pad_cik, quarter_label
from ledgerlake.operators.periods import period_means
from ledgerlake.operators.projections import keep_members
from ledgerlake.sources.calendar import calendar_dim
from ledgerlake.sources.files import read_price_change_dim
from ledgerlake.operators.versions import newest
from ledgerlake.sources.filings_json import LANDED_TIE, LANDED_TIME, company_descriptions


def calendar_dimension(spark: SparkSession, start: str = fixed.CALENDAR_START, end: str = fixed.CALENDAR_END) -> DataFrame:
    return calendar_dim(spark, start, end)


def industry_dimension(constituents: DataFrame, tickers: Sequence[str] | DataFrame, symbol_col: str = "Symbol") -> DataFrame:
    """Constituents of the chosen tickers (FLT1)."""
    return keep_members(constituents, symbol_col, tickers, "ticker")


def company_dimension(
    submissions: DataFrame,
    constituents: DataFrame,
    tickers: Sequence[str] | DataFrame,
    symbol_col: str = "Symbol",
    cik_col: str = "CIK",
) -> DataFrame:
    """Descriptions of the companies whose constituent row is in ``tickers``:
    one semi-join on the padded CIK instead of one request per company.

    Documents that carry their landing order (``read_json_documents(...,
    versions=True)``) are reduced to the newest one of each company."""
    chosen = industry_dimension(constituents, tickers, symbol_col).select(F.col(cik_col).alias("_cik"))
    kept = [c for c in [*fixed.COMPANY_KEYS, LANDED_TIME, LANDED_TIE] if c in submissions.columns]
    docs = submissions.select(*kept, pad_cik("cik").alias("_cik")).join(chosen, "_cik", "left_semi")
    if LANDED_TIME in kept:
        docs = newest(docs, ["_cik"], LANDED_TIME, LANDED_TIE)
    return company_descriptions(docs)


def price_change_dimension(spark: SparkSession, path: str | None = None) -> DataFrame:
    """The seven-row price-change dimension shipped with the package."""
    if path is None:
        path = str(resources.files("ledgerlake") / "resources" / "price_change_dim.csv")
    return read_price_change_dim(spark, path)


def price_profile(chart: DataFrame, decimal_scale: int | None = None, keep_labels: bool = False) -> DataFrame:
    """PIP5: daily adjusted closes with the quarter and month means of the
    ticker (AGG2) and the ``yyyyMMdd`` key (SCL3).  The period labels (SCL9)
    are the grouping keys of the original; they are dropped from its output,
    and kept here only with ``keep_labels``."""
    means = period_means(chart, ["ticker"], "date", "adjClose", "quarter_meanADJclose", "month_meanADJclose", decimal_scale)
    cols = [
        "adjClose", "ticker", "quarter_meanADJclose", "month_meanADJclose",
        date_key("date", "date").alias("yearMonthDay"),
    ]
    if keep_labels:
        cols += [quarter_label("date").alias("Quarter"), month_label("date").alias("Month")]
    return means.select(*cols)
