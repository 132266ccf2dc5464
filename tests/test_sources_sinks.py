"""Sources, sinks, streaming and the end-to-end fact build on small landed files."""

from __future__ import annotations

import datetime as dt
import json
import os

import pytest


from ledgerlake.plans.dims import calendar_dimension, company_dimension, industry_dimension, price_change_dimension, price_profile
from ledgerlake.plans.filings import build_filings_fact, run_filings_job
from ledgerlake.sinks import export_csv, write_table, write_transcripts
from ledgerlake.sources import (
    harvest_transcripts,
    lookup_cik,
    read_chart,
    read_company_descriptions,
    read_company_facts,
    read_constituents,
    read_filings,
    read_prices,
    read_ticker_list,
    read_transcripts,
)
from ledgerlake.streaming import transcript_measures_stream


def _write(path: str, text: str) -> str:
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "w", encoding="utf-8") as fh:
        fh.write(text)
    return path


def _rec(start, end, val, accn, fp, filed):
    r = {"end": end, "val": val, "accn": accn, "fy": int(end[:4]), "fp": fp, "form": "10-Q", "filed": filed, "frame": None}
    if start is not None:
        r["start"] = start
    return r


def _facts_doc(ticker_records):
    return {"cik": 1, "entityName": "X", "facts": {"us-gaap": ticker_records}}


def test_company_facts_first_unit_and_month_window(spark, scratch):
    doc = _facts_doc(
        {
            "SharesOutstanding": {"label": "S", "description": "d", "units": {
                "shares": [_rec(None, "2024-03-31", 100.0, "A1", "Q1", "2024-05-01")],
                "USD": [_rec(None, "2024-03-31", 999.0, "A1", "Q1", "2024-05-01")]}},
            "Revenues": {"label": "R", "description": "d", "units": {"USD": [
                _rec("2024-01-01", "2024-03-31", 5.0, "A1", "Q1", "2024-05-01"),
                _rec(None, "2024-03-31", 6.0, "A1", "Q1", "2024-05-01")]}},
            "Empty": {"label": "E", "description": "d", "units": {"USD": []}},
        }
    )
    _write(f"{scratch}/facts/ticker=T/CIK1.json", json.dumps(doc))
    rows = read_company_facts(spark, f"{scratch}/facts").collect()
    by = {(r.finType, r.val): r for r in rows}
    assert set(by) == {("SharesOutstanding", 100.0), ("Revenues", 5.0), ("Revenues", 6.0)}
    assert by[("SharesOutstanding", 100.0)].monthWindow is None  # tag without any start
    assert by[("Revenues", 5.0)].monthWindow == 3  # 90 days
    assert by[("Revenues", 6.0)].monthWindow == 0  # record without start in a tag that has one
    assert by[("Revenues", 5.0)].yearMonthDay == "20240331" and by[("Revenues", 5.0)].ticker == "T"


def _submissions_doc(cik, filings):
    keys = ["accessionNumber", "filingDate", "reportDate", "acceptanceDateTime", "act", "form", "fileNumber",
            "filmNumber", "items", "primaryDocument", "primaryDocDescription"]
    recent = {k: [f.get(k, "") for f in filings] for k in keys}
    for k in ["size", "isXBRL", "isInlineXBRL"]:
        recent[k] = [1 for _ in filings]
    return {"cik": cik, "entityType": "operating", "sicDescription": "s", "ownerOrg": "o", "name": "N",
            "tickers": ["T", "TT"], "exchanges": ["Nasdaq", None], "description": "", "website": "", "investorWebsite": "",
            "category": "c", "fiscalYearEnd": "0630", "stateOfIncorporation": "WA", "filings": {"recent": recent}}


def test_filings_rows_positions_and_url(spark, scratch):
    doc = _submissions_doc("320193", [
        {"accessionNumber": "0000320193-24-000002", "filingDate": "2024-08-01", "reportDate": "2024-06-30", "form": "10-Q", "primaryDocument": "b.htm"},
        {"accessionNumber": "0000320193-24-000001", "filingDate": "2024-05-01", "reportDate": "", "form": "10-Q", "primaryDocument": "a.htm"},
    ])
    _write(f"{scratch}/sub/ticker=T/CIK0000320193.json", json.dumps(doc))
    rows = sorted(read_filings(spark, f"{scratch}/sub").collect(), key=lambda r: r.filing_pos)
    assert [r.filing_pos for r in rows] == [0, 1]
    assert rows[0].fileURL == "https://www.sec.gov/Archives/edgar/data/0000320193/000032019324000002/b.htm"
    assert rows[1].yearMonthDay == "20240501"  # empty report date falls back to the filing date
    desc = read_company_descriptions(spark, f"{scratch}/sub").first()
    assert desc.tickers == "T, TT" and desc.exchanges == "Nasdaq, None"


def test_ticker_list_and_lookup(spark, scratch):
    _write(f"{scratch}/tickers.json", json.dumps({"0": {"cik_str": 320193, "ticker": "AAPL", "title": "Apple"},
                                                 "1": {"cik_str": 789019, "ticker": "MSFT", "title": "Microsoft"}}))
    tl = read_ticker_list(spark, f"{scratch}/tickers.json")
    assert {r.ticker: r.cik10D for r in tl.collect()} == {"AAPL": "0000320193", "MSFT": "0000789019"}
    q = spark.createDataFrame([("MSFT",), ("NONE",)], "ticker string")
    assert {r.ticker: r.cik10D for r in lookup_cik(q, tl).collect()} == {"MSFT": "0000789019", "NONE": None}


def test_chart_rows_and_profile(spark, scratch):
    ts = [int(dt.datetime(2024, 1, d, 15, tzinfo=dt.timezone.utc).timestamp()) for d in (2, 3)]
    doc = {"chart": {"result": [{"timestamp": ts, "indicators": {"adjclose": [{"adjclose": [1.0, 3.0]}]}}]}}
    _write(f"{scratch}/chart/ticker=T/c.json", json.dumps(doc))
    rows = read_chart(spark, f"{scratch}/chart")
    assert sorted((r.date, r.adjClose) for r in rows.collect()) == [("2024-01-02", 1.0), ("2024-01-03", 3.0)]
    assert price_profile(rows).columns == ["adjClose", "ticker", "quarter_meanADJclose", "month_meanADJclose", "yearMonthDay"]
    prof = price_profile(rows, keep_labels=True).collect()
    assert {r.quarter_meanADJclose for r in prof} == {2.0} and {r.Quarter for r in prof} == {"Q1-2024"}
    assert {r.Month for r in prof} == {"Month1-2024"} and {r.yearMonthDay for r in prof} == {"20240102", "20240103"}


def test_transcripts_roundtrip_multiline(spark, scratch):
    text = 'Line one, with comma\nline "two" growth'
    df = spark.createDataFrame([("T", 2024, 1, "2024-Q1-T", text, "2024-04-30")],
                               "ticker string, year int, quarter int, transcriptID string, transcript string, date string")
    write_transcripts(df, f"{scratch}/tr")
    back = read_transcripts(spark, f"{scratch}/tr").collect()
    assert len(back) == 1 and back[0].transcript == text and back[0].ticker == "T"
    assert back[0].source_file.endswith(".csv")


def test_price_change_dim(spark):
    df = price_change_dimension(spark)
    rows = df.orderBy("ID").collect()
    assert df.columns[0] == "ID" and len(rows) == 7
    assert rows[3].Intensity is None and rows[6]["Full Category Name"] == "Large positive change"


def test_calendar_spine(spark):
    cal = calendar_dimension(spark)
    assert cal.count() == 7670
    assert cal.filter("is_weekend").count() == 2192


def test_constituents_and_dims(spark, scratch):
    _write(f"{scratch}/spx.csv", "Symbol,Security, GICS Sub-Industry ,CIK\nMSFT,Microsoft,Software,789019\nXOM,Exxon,Oil,34088\n")
    cons = read_constituents(spark, f"{scratch}/spx.csv")
    assert "GICS_Sub_Industry" in cons.columns
    ind = industry_dimension(cons, ["MSFT"]).collect()
    assert [(r.Symbol, r.CIK) for r in ind] == [("MSFT", "0000789019")]
    _write(f"{scratch}/sub2/ticker=MSFT/c.json", json.dumps(_submissions_doc("789019", [])))
    _write(f"{scratch}/sub2/ticker=XOM/c.json", json.dumps(_submissions_doc("34088", [])))
    from ledgerlake.sources.filings_json import SUBMISSIONS_SCHEMA, read_json_documents

    subs = read_json_documents(spark, f"{scratch}/sub2", SUBMISSIONS_SCHEMA)
    comp = company_dimension(subs, cons, ["MSFT"]).collect()
    assert [r.cik for r in comp] == ["789019"]


def test_transcripts_with_many_extra_columns(spark, scratch):
    head, row = "year,quarter,transcriptID,transcript,date", "2024,1,2024-Q1-T,hello,2024-04-30"
    names = "".join(f",x{i}" for i in range(40))
    _write(f"{scratch}/wide/a.csv", f"{head}{names},ticker\n{row}{names},T\n")
    assert [r.ticker for r in read_transcripts(spark, f"{scratch}/wide").collect()] == ["T"]


def test_harvest_drops_list_replies(spark):
    tickers = spark.createDataFrame([("T",)], "ticker string")
    replies = spark.createDataFrame(
        [("T", 2024, 1, json.dumps({"transcript": "hello", "date": "2024-04-30"})), ("T", 2024, 2, "[]")],
        "ticker string, year int, quarter int, reply string",
    )
    out = harvest_transcripts(tickers, replies, [2024]).collect()
    assert [(r.transcriptID, r.transcript) for r in out] == [("2024-Q1-T", "hello")]


def test_read_prices_filters(spark, scratch):
    df = spark.createDataFrame([("T", dt.date(2024, 1, 1), 1.0), ("T", dt.date(2024, 2, 1), 2.0), ("U", dt.date(2024, 1, 1), 3.0)],
                               "ticker string, Date date, Close double")
    write_table(df, f"{scratch}/prices", partition_by=["ticker"])
    got = read_prices(spark, f"{scratch}/prices", ["T"], "2024-01-01", "2024-02-01").collect()
    assert [(r.ticker, r.Close) for r in got] == [("T", 1.0)]
    assert read_prices(spark, f"{scratch}/missing").count() == 0
    recent = spark.createDataFrame([("T", dt.date.today() - dt.timedelta(days=3), 5.0), ("T", dt.date(1990, 1, 1), 6.0)],
                                   "ticker string, Date date, Close double")
    write_table(recent, f"{scratch}/prices2", partition_by=["ticker"])
    assert [r.Close for r in read_prices(spark, f"{scratch}/prices2", years=1).collect()] == [5.0]
    export_csv(df, f"{scratch}/csv")
    assert spark.read.option("header", True).csv(f"{scratch}/csv").count() == 3


def test_streaming_transcripts(spark, scratch):
    land = f"{scratch}/landing"
    _write(f"{land}/a.csv", 'ticker,year,quarter,transcriptID,transcript,date\nT,2024,1,2024-Q1-T,"strong growth",2024-04-30\n')
    q = transcript_measures_stream(spark, land, f"{scratch}/out", checkpoint=f"{scratch}/ckpt")
    q.awaitTermination(120)
    _write(f"{land}/b.csv", 'ticker,year,quarter,transcriptID,transcript,date\nT,2024,2,2024-Q2-T,"risk",2024-07-30\n')
    q = transcript_measures_stream(spark, land, f"{scratch}/out", checkpoint=f"{scratch}/ckpt")
    q.awaitTermination(120)
    out = {r.transcriptID: (r.PositiveWordCount, r.NegativeWordCount) for r in spark.read.parquet(f"{scratch}/out").collect()}
    assert out == {"TQ12024": (2, 0), "TQ22024": (0, 1)}  # each file processed exactly once


def test_fact_build_end_to_end(spark, scratch):
    """Landed facts + submissions + prices + transcripts -> the 25-column fact
    table, validated and written."""
    recs = {
        "Revenues": [("2024-01-01", "2024-06-30", 30.0, "A2", "Q2", "2024-08-01"), ("2024-01-01", "2024-03-31", 10.0, "A1", "Q1", "2024-05-01")],
        "AssetsCurrent": [(None, "2024-06-30", 100.0, "A2", "Q2", "2024-08-01"), (None, "2024-03-31", 90.0, "A1", "Q1", "2024-05-01")],
    }
    tags = {}
    for tag, rs in recs.items():
        tags[tag] = {"label": tag, "description": "", "units": {"USD": [_rec(*r) for r in rs]}}
    for tag in ["Liabilities", "StockholdersEquity", "CashAndCashEquivalents", "EarningsPerShareBasic", "SharesOutstanding"]:
        tags[tag] = {"label": tag, "description": "", "units": {"USD": [_rec(None, "2024-06-30", 1.0, "A2", "Q2", "2024-08-01"),
                                                                    _rec(None, "2024-03-31", 1.0, "A1", "Q1", "2024-05-01")]}}
    _write(f"{scratch}/facts/ticker=T/c.json", json.dumps(_facts_doc(tags)))
    _write(f"{scratch}/sub/ticker=T/c.json", json.dumps(_submissions_doc("1", [
        {"accessionNumber": "A2", "filingDate": "2024-08-01", "reportDate": "2024-06-30", "form": "10-Q", "primaryDocument": "b.htm"},
        {"accessionNumber": "A1", "filingDate": "2024-05-01", "reportDate": "2024-03-31", "form": "10-Q", "primaryDocument": "a.htm"},
        {"accessionNumber": "A0", "filingDate": "2024-04-02", "reportDate": "", "form": "8-K", "primaryDocument": "k.htm"}])))
    prices = spark.createDataFrame(
        [("T", dt.date(2024, 1, 2), 10.0), ("T", dt.date(2024, 3, 28), 12.0), ("T", dt.date(2024, 4, 1), 12.0), ("T", dt.date(2024, 6, 28), 12.0)],
        "ticker string, Date date, Close double",
    )
    tr = spark.createDataFrame([("T", 2024, 2, "strong growth", "2024-08-01")], "ticker string, year int, quarter int, transcript string, date string")
    fact = build_filings_fact(read_company_facts(spark, f"{scratch}/facts"), read_filings(spark, f"{scratch}/sub"), prices, tr)
    rows = {r.financialPeriod: r for r in fact.collect()}
    assert len(fact.columns) == 25
    assert rows["Q2"].Revenues == 20.0 and rows["Q1"].Revenues == 10.0  # year-to-date -> quarter
    assert rows["Q2"].Assets == 100.0
    assert rows["Q1"].stockPriceChange == 1 and rows["Q2"].stockPriceChange == 4
    assert rows["Q2"].transcriptID == "TQ22024" and rows["Q2"].PositiveWordCount == 2
    assert rows["Q1"].TransLength is None
    report = run_filings_job(fact, f"{scratch}/out/fact", f"{scratch}/out/validation")
    assert all(r.passed for r in report.collect())
    assert spark.read.parquet(f"{scratch}/out/fact").count() == 2


def test_jobs_over_landing_zone(spark, scratch):
    """The spark-submit job: landing zone -> fact, validation and dimensions."""
    from ledgerlake.plans.jobs import fact_job, main

    land, out = f"{scratch}/landing", f"{scratch}/star"
    tags = {}
    for tag in ["Revenues", "AssetsCurrent", "Liabilities", "StockholdersEquity", "CashAndCashEquivalents", "EarningsPerShareBasic", "SharesOutstanding"]:
        tags[tag] = {"label": tag, "description": "", "units": {"USD": [_rec(None, "2024-03-31", 2.0, "A1", "Q1", "2024-05-01")]}}
    _write(f"{land}/companyfacts/ticker=MSFT/c.json", json.dumps(_facts_doc(tags)))
    _write(f"{land}/submissions/ticker=MSFT/c.json", json.dumps(_submissions_doc("789019", [
        {"accessionNumber": "A1", "filingDate": "2024-05-01", "reportDate": "2024-03-31", "form": "10-Q", "primaryDocument": "a.htm"}])))
    prices = spark.createDataFrame([("MSFT", dt.date(2024, 1, 2), 10.0), ("MSFT", dt.date(2024, 3, 1), 10.0)], "ticker string, Date date, Close double")
    write_table(prices, f"{land}/prices", partition_by=["ticker"])
    tr = spark.createDataFrame([("MSFT", 2024, 1, "2024-Q1-MSFT", "record growth", "2024-04-30")],
                               "ticker string, year int, quarter int, transcriptID string, transcript string, date string")
    write_transcripts(tr, f"{land}/transcripts")
    _write(f"{land}/transcripts/ticker=MSFT/bad.csv", "year,quarter\n2024,1\n")
    _write(f"{land}/constituents.csv", "Symbol,Security,CIK\nMSFT,Microsoft,789019\nXOM,Exxon,34088\n")
    main([land, out])
    problems = spark.read.parquet(f"{out}/TranscriptProblems").collect()
    assert [(r.source_path.rsplit("/", 1)[1], r.problem) for r in problems] == [("bad.csv", "missing columns: transcriptID, transcript, date")]
    with pytest.raises(ValueError, match="missing columns.*bad.csv"):
        fact_job(spark, land, out, skip_bad_transcripts=False)
    fact = spark.read.parquet(f"{out}/FillingsFact").collect()
    assert len(fact) == 1 and fact[0].stockPriceChange == 4 and fact[0].PositiveWordCount == 2
    assert spark.read.parquet(f"{out}/dimCalendar").count() == 7670
    assert spark.read.parquet(f"{out}/dimStockPriceChange").count() == 7
    assert [r.Symbol for r in spark.read.parquet(f"{out}/dimIndustry").collect()] == ["MSFT"]
    assert [r.cik for r in spark.read.parquet(f"{out}/dimCompany").collect()] == ["789019"]


def test_transcripts_header_layouts_combined_by_name(spark, scratch):
    """D20: files with another column order are aligned by header name."""
    d = f"{scratch}/mixed"
    _write(f"{d}/a.csv", 'ticker,year,quarter,transcriptID,transcript,date\nAAA,2024,1,2024-Q1-AAA,"one, two",2024-04-30\n')
    _write(f"{d}/b.csv", 'transcript,date,ticker,quarter,year,transcriptID\n"three\nfour",2024-07-30,BBB,2,2024,2024-Q2-BBB\n')
    rows = {r.ticker: r for r in read_transcripts(spark, d).collect()}
    assert rows["AAA"].transcript == "one, two" and rows["AAA"].year == 2024
    assert rows["BBB"].transcript == "three\nfour" and rows["BBB"].quarter == 2 and rows["BBB"].source_file == "b.csv"


def test_transcripts_flat_file_of_the_original_shape(spark, scratch):
    d = f"{scratch}/flat"
    _write(f"{d}/a.csv", 'ticker,year,quarter,transcriptID,transcript,date\nAAA,2024,1,2024-Q1-AAA,"one\ntwo",2024-04-30\n')
    rows = read_transcripts(spark, d).collect()
    assert [(r.ticker, r.year, r.transcript, r.source_file) for r in rows] == [("AAA", 2024, "one\ntwo", "a.csv")]


def test_transcripts_without_header_fail(spark, scratch):
    d = f"{scratch}/bare"
    _write(f"{d}/a.csv", 'AAA,2024,1,2024-Q1-AAA,"one",2024-04-30\n')
    with pytest.raises(Exception, match="no transcript header"):
        read_transcripts(spark, d).collect()


def test_truncated_json_is_reported(spark, scratch):
    _write(f"{scratch}/sub/ticker=T/a.json", '{"cik": "1", "filings": {"recent": {"accessionNumber": ["x"')
    with pytest.raises(Exception, match="a.json|MALFORMED"):
        read_filings(spark, f"{scratch}/sub").collect()


def test_price_tickers_stay_text(spark, scratch):
    df = spark.createDataFrame([("0700", 1.0), ("0005", 2.0)], "ticker string, Close double")
    df.write.partitionBy("ticker").parquet(f"{scratch}/px")
    assert {r.ticker for r in read_prices(spark, f"{scratch}/px").collect()} == {"0700", "0005"}


def test_lookup_takes_the_first_entry(spark, scratch):
    _write(f"{scratch}/t.json", '{"0": {"cik_str": 9, "ticker": "A", "title": "x"}, "1": {"cik_str": 3, "ticker": "A", "title": "y"}}')
    out = lookup_cik(spark.createDataFrame([("A",)], "ticker string"), read_ticker_list(spark, f"{scratch}/t.json")).first()
    assert out.cik10D == "0000000009"


def test_stream_fails_on_reordered_header(spark, scratch):
    land = f"{scratch}/land"
    _write(f"{land}/a.csv", 'year,ticker,quarter,transcriptID,transcript,date\n2024,T,1,2024-Q1-T,"x",2024-04-30\n')
    with pytest.raises(Exception):
        transcript_measures_stream(spark, land, f"{scratch}/out", checkpoint=f"{scratch}/ckpt").awaitTermination()


def test_transcript_white_space_survives(spark, scratch):
    df = spark.createDataFrame([("T", 2024, 1, "2024-Q1-T", "  padded ", "2024-04-30")],
                               "ticker string, year int, quarter int, transcriptID string, transcript string, date string")
    write_transcripts(df, f"{scratch}/tr")
    assert read_transcripts(spark, f"{scratch}/tr").first().transcript == "  padded "
