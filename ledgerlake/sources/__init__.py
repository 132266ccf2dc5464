"""Sources: landed JSON/CSV/Parquet files and generated spines."""

from ledgerlake.sources.calendar import calendar_dim, calendar_for, date_spine
from ledgerlake.sources.files import (
    bad_files,
    constituents_from_lines,
    good_transcripts,
    harvest_transcripts,
    lookup_cik,
    prices_for_windows,
    read_constituents,
    read_price_change_dim,
    read_prices,
    read_transcripts,
    scan_transcripts,
    select_prices,
)
from ledgerlake.sources.filings_json import (
    chart_rows,
    company_descriptions,
    company_facts_rows,
    explode_parallel,
    filings_misaligned,
    filings_rows,
    misaligned,
    parse_json_documents,
    read_chart,
    read_company_descriptions,
    read_company_facts,
    read_filings,
    read_json_documents,
    read_ticker_list,
    ticker_list_rows,
)
from ledgerlake.sources.incremental import file_manifest, ingest

__all__ = [name for name in dir() if not name.startswith("_")]
