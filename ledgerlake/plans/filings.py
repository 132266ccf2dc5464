"""The filings fact build (PIP1) and its parts (PIP2, PIP3).

``build_filings_fact`` chains tag roll-up -> canonical filter -> pivot ->
filings join | written once | quarter normalisation -> price class ->
transcript measures.  The filing-level table is written once to the shared
checkpoint folder because three branches read it.  Shuffles: the pivot aggregate, the filings join, the
normalisation window, the price range join and its aggregate, the transcript
join.  ``run_filings_job`` cuts the lineage once (a table in the shared folder) and
then runs validation and the two writes from that table, so the three
actions never recompute the plan.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerlake import fixed
from ledgerlake.functions.scalars import fact_transcript_key, full_year_as_q4, parse_date, report_year, transcript_key
from ledgerlake.functions.text import add_text_measures
from ledgerlake.operators.joins import attach_transcripts, merge_filings
from ledgerlake.operators.periods import decumulate
from ledgerlake.operators.prices import add_price_change_class
from ledgerlake.operators.quality import missing_data_flags, raise_if_failed, validate
from ledgerlake.operators.reshape import pivot_facts
from ledgerlake.operators.tags import clean_facts, keep_rollup_canonical
from ledgerlake.session import materialize
from ledgerlake.sinks.tables import write_fact_table, write_validation_table
from ledgerlake.sources.files import bad_files, good_transcripts
from ledgerlake.streaming.landing import transcript_measures


def prepare_facts(facts_long: DataFrame) -> DataFrame:
    """SCL4 + PIP3 + AGG1 + FLT3: long facts -> one row per filing and period.

    The canonical-tag filter is applied to the raw tag before the roll-up
    (an equivalent ``isin`` that reaches the Parquet scan), so the lookup runs
    only on kept rows."""
    return pivot_facts(clean_facts(keep_rollup_canonical(facts_long, "finType"), check_tags=False))


def add_stock_price_dim(
    df: DataFrame, prices: DataFrame, price_ticker_col: str = "ticker", price_date_col: str = "Date", price_col: str = "Close",
    orientation: str = "reference", windows: DataFrame | None = None,
) -> DataFrame:
    """PIP2: price class of the quarter before the report, then the fact
    column order (``windows`` as in ``add_price_change_class``)."""
    classed = add_price_change_class(
        df, prices, "ticker", "reportDate", price_ticker_col, price_date_col, price_col, orientation=orientation, windows=windows
    )
    return classed.select(*fixed.FACT_COLUMNS)


def measure_scan(scan: DataFrame, scorer_factory=None) -> tuple[DataFrame, DataFrame]:
    """Measures and problems of a transcript folder from one pass over its
    texts: (transcriptID + measures of the good files, report of the bad ones).

    ``scan`` is ``scan_transcripts``.  Both results are read from one written
    table of a few numbers per transcript, so no text is read twice."""
    key = transcript_key("ticker", "quarter", "year").alias("transcriptID")
    measured = add_text_measures(scan, "transcript", scorer_factory)
    table = materialize(measured.select(key, *fixed.TRANSCRIPT_MEASURES, "source_path", "problem"), "transcript_measures")
    return good_transcripts(table), bad_files(table)


def build_filings_fact(
    facts_long: DataFrame,
    filings: DataFrame,
    prices: DataFrame,
    transcripts: DataFrame | None,
    scorer_factory=None,
    price_cols: tuple[str, str, str] = ("ticker", "Date", "Close"),
    bucket: Column | str | None = "auto",
    bucket_ascending: bool = True,
    orientation: str = "reference",
    cut_lineage: bool = True,
    measured: DataFrame | None = None,
) -> DataFrame:
    """PIP1: the 25-column fact table.

    ``facts_long``: rows of ``company_facts_rows``; ``filings``: rows of
    ``filings_rows``; ``prices``: daily bars (ticker, Date, Close);
    ``transcripts``: rows of ``read_transcripts`` (or None: all measures null);
    ``measured``: transcripts that are measured already (``measure_scan``).
    ``bucket``: split of a ticker for the normalisation window (see
    ``periods.decumulate``); "auto" splits by the filing list position in
    blocks of 256, or by the filing month when there is no list position.
    ``cut_lineage``: write the filing-level table once (pivot joined to the
    filings) into the shared checkpoint folder.  Three later branches read it
    (price windows, the normalisation window, its bucket heads); without the
    cut each would recompute the pivot over the raw facts, since differently
    pruned branches do not share shuffles.
    """
    pivot = prepare_facts(facts_long)
    filings = filings.select(
        "accessionNumber",
        parse_date("reportDate").alias("reportDate"),  # '' for e.g. 8-K: null, not an error
        "form",
        parse_date("filingDate").alias("filingDate"),
        "primaryDocDescription",
        "fileURL",
        *(["filing_pos", *(["ticker"] if "ticker" in filings.columns else [])] if "filing_pos" in filings.columns else []),
    )
    joined = merge_filings(pivot, filings)
    if cut_lineage:
        joined = materialize(joined, "filings_level")
    normalized = decumulate(joined, bucket=bucket, bucket_ascending=bucket_ascending)
    # The class depends only on (ticker, reportDate), which the normalisation
    # does not change: the price windows are read from the written table, so
    # neither branch recomputes the other.
    fact = add_stock_price_dim(normalized, prices, *price_cols, orientation=orientation, windows=joined)
    fact = fact.withColumn("transcriptID", fact_transcript_key("ticker", "financialPeriod", report_year("reportDate")))
    if measured is not None:
        return attach_transcripts(fact, measured, "transcriptID")
    if transcripts is None:
        return fact.withColumns({m: F.lit(None).cast("double" if m == "SentimentScore" else "bigint") for m in fixed.TRANSCRIPT_MEASURES})
    if scorer_factory is None:
        # Measured where the texts are read: only a few numbers per transcript
        # cross the join, no text does.
        return attach_transcripts(fact, transcript_measures(transcripts, None), "transcriptID")
    # A model costs more per text than its shuffle, so only transcripts whose
    # key occurs in the fact table are scored: a null-safe semi-join on the
    # distinct fact keys comes first.  The keys come from the written
    # filing-level table: the normalisation changes no ticker, report date or
    # row, only FY -> Q4.
    keyed = transcripts.withColumn("_tid", transcript_key("ticker", "quarter", "year"))
    wanted = joined.select(
        fact_transcript_key("ticker", full_year_as_q4("financialPeriod"), report_year("reportDate")).alias("_want")
    ).distinct()
    needed = keyed.join(wanted, keyed["_tid"].eqNullSafe(wanted["_want"]), "left_semi").drop("_tid")
    return attach_transcripts(fact, transcript_measures(needed, scorer_factory), "transcriptID")


def run_filings_job(fact: DataFrame, fact_path: str, validation_path: str, validation_mode: str = "overwrite") -> DataFrame:
    """Validate -> store validation table -> write fact (the original order:
    a failed validation blocks both writes).  Returns the rule report."""
    table = materialize(fact, "fact")
    report = validate(table)
    raise_if_failed(report)
    write_validation_table(missing_data_flags(table), validation_path, validation_mode)
    write_fact_table(table, fact_path)
    return report
