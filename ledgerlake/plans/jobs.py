"""Batch jobs over a landing zone, runnable with ``spark-submit``.

The original work runs as four scheduled task chains (fact build, calendar,
company and industry dimensions, price-change dimension).  Here each chain is
one Spark job over landed files; the scheduler only has to start it.

Landing layout (any of the inputs may be absent where noted)::

    <landing>/companyfacts/ticker=<T>/*.json     company facts (SRC1)
    <landing>/submissions/ticker=<T>/*.json      filings + descriptions (SRC2, SRC4)
    <landing>/prices/ticker=<T>/*.parquet        daily bars: Date, Close, ... (SRC6)
    <landing>/transcripts/ticker=<T>/*.csv       transcripts (SRC8), optional
    <landing>/constituents.csv                   index constituents (SRC7), optional

Output (the star schema): ``<out>/FillingsFact``, ``<out>/ValidationMissingData``,
``<out>/dimCalendar``, ``<out>/dimCompany``, ``<out>/dimIndustry``,
``<out>/dimStockPriceChange``; and ``<out>/TranscriptProblems``, the report of
unreadable transcript files.
"""

from __future__ import annotations

import argparse
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession

from ledgerlake.session import apply_scale_defaults
from ledgerlake.plans.dims import calendar_dimension, company_dimension, industry_dimension, price_change_dimension
from ledgerlake.plans.filings import build_filings_fact, measure_scan, run_filings_job
from ledgerlake.sinks.tables import write_table
from ledgerlake.sources.filings_json import SUBMISSIONS_SCHEMA, read_company_facts, read_filings, read_json_documents
from ledgerlake.sources.files import read_constituents, read_prices, scan_transcripts


def _exists(spark: SparkSession, path: str) -> bool:
    """Path test through the Hadoop FileSystem of the session (works for
    local, HDFS and object-store paths alike)."""
    jvm = spark.sparkContext._jvm
    hpath = jvm.org.apache.hadoop.fs.Path(path)
    return hpath.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(hpath)


def fact_job(
    spark: SparkSession, landing: str, out: str, tickers: Sequence[str] | None = None, validation_mode: str = "overwrite",
    skip_bad_transcripts: bool = True,
) -> DataFrame:
    """Fact chain: facts + filings + prices + transcripts -> validated fact
    table and missing-data table.  Returns the rule report.

    Unreadable transcript files are left out, as in the original, and listed
    with their problem in ``<out>/TranscriptProblems``; with
    ``skip_bad_transcripts=False`` the first one fails the job."""
    facts = read_company_facts(spark, f"{landing}/companyfacts")
    filings = read_filings(spark, f"{landing}/submissions")
    if tickers:
        facts = facts.filter(facts["ticker"].isin(list(tickers)))
        filings = filings.filter(filings["ticker"].isin(list(tickers)))
    prices = read_prices(spark, f"{landing}/prices", tickers)
    measured = None
    if _exists(spark, f"{landing}/transcripts"):
        measured, problems = measure_scan(scan_transcripts(spark, f"{landing}/transcripts"))
        write_table(problems, f"{out}/TranscriptProblems")
        first = None if skip_bad_transcripts else problems.first()
        if first is not None:
            raise ValueError(f"{first['problem']} in {first['source_path']}")
    fact = build_filings_fact(facts, filings, prices, None, measured=measured)
    return run_filings_job(fact, f"{out}/FillingsFact", f"{out}/ValidationMissingData", validation_mode)


def dimension_job(spark: SparkSession, landing: str, out: str, tickers: Sequence[str] | None = None) -> None:
    """Dimension chains: calendar, price-change classes, and -- when the
    constituents file is landed -- industry and company dimensions for the
    given tickers (default: every landed ticker, as a semi-join)."""
    write_table(calendar_dimension(spark), f"{out}/dimCalendar")
    write_table(price_change_dimension(spark), f"{out}/dimStockPriceChange")
    constituents_path = f"{landing}/constituents.csv"
    if _exists(spark, constituents_path):
        constituents = read_constituents(spark, constituents_path)
        submissions = read_json_documents(spark, f"{landing}/submissions", SUBMISSIONS_SCHEMA, versions=True)
        members = list(tickers) if tickers else submissions.select("ticker").distinct()
        write_table(industry_dimension(constituents, members), f"{out}/dimIndustry")
        write_table(company_dimension(submissions, constituents, members), f"{out}/dimCompany")


def main(argv: Sequence[str] | None = None) -> None:
    parser = argparse.ArgumentParser(description="Build the filings star schema from a landing zone.")
    parser.add_argument("landing")
    parser.add_argument("out")
    parser.add_argument("--tickers", default="", help="comma-separated allow-list (default: all landed)")
    parser.add_argument("--skip-dimensions", action="store_true")
    args = parser.parse_args(argv)
    spark = SparkSession.builder.appName("ledgerlake-filings").getOrCreate()
    apply_scale_defaults(spark)
    tickers = [t for t in args.tickers.split(",") if t] or None
    fact_job(spark, args.landing, args.out, tickers)
    if not args.skip_dimensions:
        dimension_job(spark, args.landing, args.out, tickers)


if __name__ == "__main__":
    main()
