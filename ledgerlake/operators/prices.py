"""Price change over the quarter before each report (JON4, AGG3, SCL6-SCL8, PIP2).

The original job downloads prices once per fact row.  Here it is one range
join: report windows [reportDate - 3 months, reportDate) against a price
table.  Scale shape:

* facts are reduced to distinct (ticker, reportDate) windows first;
* bars are dealt by (ticker, month) over more partitions than AQE would leave
  (``session.spread``), collapsed to one per (ticker, day), and those to one
  summary per (ticker, month): first and last day with their closes.  Both are
  hash aggregates over fixed-width values, and the summary reads the shuffle
  of the bars again, so prices are scanned and shuffled once;
* each window is expanded to the (at most four) calendar months it touches:
  the months at its edges meet the daily bars, whole months in between meet
  one summary row.  The join is an equi-join on (ticker, month, kind) with the
  date range as a residual -- a ticker with a long history is spread over many
  join keys instead of one sort-merge group, and the keys over more partitions
  than AQE would leave (``session.spread``);
* first and last close of a window are ``min_by`` / ``max_by`` on a date: hash
  aggregates again, combined before the shuffle;
* the classes join back to the facts on (ticker, reportDate).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerlake import fixed
from ledgerlake.functions.classify import change_class, percent_change
from ledgerlake.functions.scalars import minus_months
from ledgerlake.session import spread


def window_closes(
    windows: DataFrame,
    prices: DataFrame,
    ticker_col: str = "ticker",
    report_col: str = "reportDate",
    price_ticker_col: str = "ticker",
    price_date_col: str = "date",
    price_col: str = "close",
    months: int = fixed.PRICE_WINDOW_MONTHS,
) -> DataFrame:
    """JON4 + AGG3: first and last close in [report - months, report).

    ``windows`` holds (ticker, report date) pairs; output is one row per
    distinct pair that has at least one price: ticker, report date,
    first_close, last_close.  Of several bars of a day the smallest close is
    the first and the largest the last; a null close counts as the smallest.
    """
    month_of_window = F.sequence(
        F.trunc(F.col("_start"), "month"), F.trunc(F.date_sub(F.col("_rd"), 1), "month"), F.expr("INTERVAL 1 MONTH")
    )
    w = (
        windows.select(F.col(ticker_col).alias("_t"), F.to_date(F.col(report_col)).alias("_rd"))
        .dropna()
        .distinct()
        .withColumn("_start", minus_months("_rd", months))
        .withColumn("_mb", F.explode(month_of_window))
        .withColumn("_whole", (F.col("_mb") >= F.col("_start")) & (F.add_months("_mb", 1) <= F.col("_rd")))
    )
    # One row per window and month, and nearly all bars, meet in this join: it
    # sorts small partitions.  Without the hint the size of the pruned file,
    # before the months are listed, would pass for a table small enough to broadcast.
    w = spread(w, "_t", "_mb", "_whole").hint("merge")
    bars = prices.select(
        F.col(price_ticker_col).alias("_pt"),
        F.to_date(F.col(price_date_col)).alias("_pd"),
        F.col(price_col).cast("double").alias("_close"),
    )
    # Said in full, so that the join infers the same filters below both kinds
    # of row and their common shuffle is read again.  Dealt by month: a month's
    # summary is made where its days are, in small partitions.
    bars = bars.withColumn("_pmb", F.trunc("_pd", "month"))
    bars = spread(bars.filter(F.col("_pt").isNotNull() & F.col("_pd").isNotNull() & F.col("_pmb").isNotNull()), "_pt", "_pmb")
    p = daily_and_monthly(bars)
    cond = (
        (w["_t"] == p["_pt"])
        & (w["_mb"] == p["_pmb"])
        & (w["_whole"] == p["_month"])
        & (p["_from"] >= w["_start"])
        & (p["_to"] < w["_rd"])
    )
    return (
        w.join(p, cond, "inner")
        .groupBy("_t", "_rd")
        .agg(F.min_by("_lo", "_from").alias("first_close"), F.max_by("_hi", "_to").alias("last_close"))
        .withColumnsRenamed({"_t": ticker_col, "_rd": report_col})
    )


def daily_and_monthly(bars: DataFrame) -> DataFrame:
    """Bars (_pt, _pmb, _pd, _close) as one row per day and one per month: ticker,
    month, kind (_month), first and last day, the close of each."""
    daily = bars.groupBy("_pt", "_pmb", "_pd").agg(
        F.when(F.count("_close") == F.count(F.lit(1)), F.min("_close")).alias("_lo"), F.max("_close").alias("_hi")
    )
    monthly = daily.groupBy("_pt", "_pmb").agg(
        F.min("_pd").alias("_from"), F.max("_pd").alias("_to"), F.min_by("_lo", "_pd").alias("_lo"), F.max_by("_hi", "_pd").alias("_hi")
    )
    days = daily.select("_pt", "_pmb", F.lit(False).alias("_month"), F.col("_pd").alias("_from"), F.col("_pd").alias("_to"), "_lo", "_hi")
    return days.unionByName(monthly.withColumn("_month", F.lit(True)))


def add_price_change_class(
    facts: DataFrame,
    prices: DataFrame,
    ticker_col: str = "ticker",
    report_col: str = "reportDate",
    price_ticker_col: str = "ticker",
    price_date_col: str = "date",
    price_col: str = "close",
    out_col: str = "stockPriceChange",
    months: int = fixed.PRICE_WINDOW_MONTHS,
    orientation: str = "reference",
    windows: DataFrame | None = None,
) -> DataFrame:
    """PIP2 core: attach the price-change class of the window before each
    report date.  A report with no price in its window gets a null class.

    ``windows``: a cheaper frame with the same (ticker, report date) pairs as
    ``facts`` -- e.g. a written table ``facts`` was derived from -- so the
    window branch does not recompute the plan of ``facts``."""
    source = facts if windows is None else windows
    closes = window_closes(
        source.select(ticker_col, report_col), prices, ticker_col, report_col,
        price_ticker_col, price_date_col, price_col, months,
    )
    classes = closes.select(
        F.col(ticker_col),
        F.col(report_col).alias("_rd_key"),
        change_class(percent_change("first_close", "last_close", orientation)).alias(out_col),
    )
    keyed = facts.withColumn("_rd_key", F.to_date(F.col(report_col)))
    # The class table never holds a null key (null windows are dropped), so a
    # plain equi-join equals the null-safe one and keeps the aggregate's
    # partitioning on (ticker, report date): no second shuffle of the classes.
    return keyed.join(classes, [ticker_col, "_rd_key"], "left").drop("_rd_key")
