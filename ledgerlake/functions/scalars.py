"""Scalar functions as Spark Column expressions (SCL1-SCL15, SCL19-SCL21).

All of them stay inside whole-stage codegen: no Python runs per row.
Arguments accept a column name or a Column.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ledgerlake import fixed

ColumnOrName = Column | str


def _c(c: ColumnOrName) -> Column:
    return F.col(c) if isinstance(c, str) else c


# SCL1 ------------------------------------------------------------------------
def pad_cik(c: ColumnOrName, width: int = fixed.CIK_WIDTH) -> Column:
    """Left-pad with '0' to ``width``; longer values pass through unchanged
    (plain ``lpad`` would truncate them)."""
    s = _c(c).cast("string")
    return F.when(F.length(s) <= width, F.lpad(s, width, "0")).otherwise(s)


# SCL5 / SCL2 -------------------------------------------------------------------
def days_between(end: ColumnOrName, start: ColumnOrName) -> Column:
    """Whole days from ``start`` to ``end`` (null if either is not a date)."""
    return F.datediff(parse_date(end), parse_date(start))


def month_steps(days: ColumnOrName) -> Column:
    """Completed 30-day steps; below 30, negative or null gives 0."""
    d = _c(days)
    return F.when(d >= 30, F.floor(d / 30)).otherwise(F.lit(0)).cast("bigint")


# SCL3 / SCL21 ------------------------------------------------------------------
def parse_date(c: ColumnOrName, fmt: str | None = None) -> Column:
    """Tolerant date parse: malformed, empty or null input gives null.
    Without a pattern a DATE passes through and a timestamp is truncated;
    under ANSI mode a plain ``to_date`` would raise on malformed text."""
    col = _c(c)
    if fmt is None:
        return F.try_to_date(col)
    return F.try_to_date(col.cast("string"), fmt)


def date_key(primary: ColumnOrName, fallback: ColumnOrName) -> Column:
    """``yyyyMMdd`` of ``primary``, else of ``fallback``, else null."""
    return F.date_format(F.coalesce(parse_date(primary), parse_date(fallback)), "yyyyMMdd")


# SCL6 ------------------------------------------------------------------------
def minus_months(c: ColumnOrName, months: int = fixed.PRICE_WINDOW_MONTHS) -> Column:
    """Date ``months`` earlier; the day is clamped to the length of the target month."""
    return F.add_months(F.to_date(_c(c)), -months)


# SCL9 ------------------------------------------------------------------------
def quarter_label(c: ColumnOrName) -> Column:
    d = F.to_date(_c(c))
    return F.concat(F.lit("Q"), F.quarter(d).cast("string"), F.lit("-"), F.year(d).cast("string"))


def month_label(c: ColumnOrName) -> Column:
    d = F.to_date(_c(c))
    return F.concat(F.lit("Month"), F.month(d).cast("string"), F.lit("-"), F.year(d).cast("string"))


# SCL10 -----------------------------------------------------------------------
def filing_url(
    cik: ColumnOrName,
    accession: ColumnOrName,
    document: ColumnOrName,
    base: str = fixed.FILING_URL_BASE,
) -> Column:
    """base + CIK + '/' + accession without dashes + '/' + document."""
    return F.concat(
        F.lit(base),
        _c(cik).cast("string"),
        F.lit("/"),
        F.replace(_c(accession).cast("string"), F.lit("-"), F.lit("")),
        F.lit("/"),
        _c(document).cast("string"),
    )


# SCL11 / SCL12 -----------------------------------------------------------------
def fact_transcript_key(ticker: ColumnOrName, period: ColumnOrName, year: ColumnOrName) -> Column:
    """Fact-side key: ticker + period code + year text (``report_year`` of the
    report date in the fact build).  A null part gives a null key."""
    return F.concat(_c(ticker).cast("string"), _c(period).cast("string"), _c(year).cast("string"))


def transcript_key(ticker: ColumnOrName, quarter: ColumnOrName, year: ColumnOrName) -> Column:
    """Transcript-side key: ticker + 'Q' + quarter + year."""
    return F.concat(
        _c(ticker).cast("string"),
        F.lit("Q"),
        _c(quarter).cast("int").cast("string"),
        _c(year).cast("int").cast("string"),
    )


# SCL13 -----------------------------------------------------------------------
def calendar_parts(c: ColumnOrName) -> dict[str, Column]:
    """Calendar attributes of a date: Monday = 0, ISO week, English names."""
    d = F.to_date(_c(c))
    dow = F.weekday(d)  # Monday = 0 .. Sunday = 6
    return {
        "date": F.date_format(d, "yyyy-MM-dd"),
        "day": F.dayofmonth(d).cast("bigint"),
        "month": F.month(d).cast("bigint"),
        "year": F.year(d).cast("bigint"),
        "day_of_week": dow.cast("bigint"),
        "day_name": F.date_format(d, "EEEE"),
        "month_name": F.date_format(d, "MMMM"),
        "week": F.weekofyear(d).cast("bigint"),
        "quarter": F.quarter(d).cast("bigint"),
        "is_weekend": dow >= 5,
    }


# SCL14 -----------------------------------------------------------------------
def epoch_to_date(c: ColumnOrName, zone: str = "UTC") -> Column:
    """Epoch seconds -> date in ``zone``, independent of the session's zone."""
    utc = F.lit("1970-01-01 00:00:00").cast("timestamp_ntz") + F.make_dt_interval(secs=_c(c))
    return F.convert_timezone(F.lit("UTC"), F.lit(zone), utc).cast("date")


# SCL15 -----------------------------------------------------------------------
def default_range(years: int, today: ColumnOrName | None = None) -> tuple[Column, Column]:
    """(start, end) = (today - 366*years days, today); ``today`` is the current date by default."""
    end = F.current_date() if today is None else F.to_date(_c(today))
    return F.date_sub(end, 366 * years), end


# SCL19 / SCL20 -----------------------------------------------------------------
def full_year_as_q4(c: ColumnOrName) -> Column:
    col = _c(c)
    return F.when(col == F.lit(fixed.FULL_YEAR), F.lit(fixed.FOURTH_QUARTER)).otherwise(col)


def fill_period(c: ColumnOrName) -> Column:
    return F.coalesce(_c(c), F.lit(fixed.MISSING_PERIOD))


# AGG4 / FLT5 -----------------------------------------------------------------
def null_count(cols: list[str]) -> Column:
    """Number of nulls across ``cols`` in one row (no shuffle)."""
    if not cols:
        return F.lit(0)
    return F.expr(" + ".join(f"CAST(`{n.replace('`', '``')}` IS NULL AS INT)" for n in cols))


def any_null(cols: list[str]) -> Column:
    if not cols:
        return F.lit(False)
    return F.expr(" OR ".join(f"`{n.replace('`', '``')}` IS NULL" for n in cols))


# PRJ4 ------------------------------------------------------------------------
def join_list(c: ColumnOrName, sep: str = ", ") -> Column:
    """Join an array as text; a null element prints as 'None' (array_join alone
    would drop it); an empty array gives ''."""
    return F.array_join(F.transform(_c(c), lambda x: F.coalesce(x.cast("string"), F.lit("None"))), sep)


# SRC1 helpers ------------------------------------------------------------------
def first_key(m: ColumnOrName) -> Column:
    """Key of the first entry of a map (document order is kept by from_json /
    the JSON reader); null for an empty or null map."""
    return F.get(F.map_keys(_c(m)), 0)


def first_value(m: ColumnOrName) -> Column:
    """Value of the first entry of a map; null for an empty or null map."""
    return F.get(F.map_values(_c(m)), 0)


# SCL11 helper ------------------------------------------------------------------
def report_year(c: ColumnOrName) -> Column:
    """Four-digit year text of a date (the first four characters of its ISO form)."""
    return F.date_format(F.to_date(_c(c)), "yyyy")
