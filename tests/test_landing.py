"""Landed files, versions, publishing: round trips on small files."""

from __future__ import annotations

import csv
import glob
import io
import json
import os
import random

import pytest
from pyspark.sql import functions as F

from ledgerlake.operators import clean_column_names, newest
from ledgerlake.operators.projections import clean_names
from ledgerlake.plans import catalog_sources as cs
from ledgerlake.plans.dims import company_dimension
from ledgerlake.sinks import PublishError, current, export_csv, publish, read_published, remove_unpublished, write_transcripts
from ledgerlake.sources import (
    bad_files,
    chart_rows,
    company_facts_rows,
    constituents_from_lines,
    file_manifest,
    filings_misaligned,
    filings_rows,
    good_transcripts,
    ingest,
    parse_json_documents,
    prices_for_windows,
    read_company_facts,
    read_transcripts,
    scan_transcripts,
)
from ledgerlake.sources.filings_json import CHART_SCHEMA, COMPANY_FACTS_SCHEMA, SUBMISSIONS_SCHEMA, read_json_documents
from tests.conftest import SF001

HEADER = ["ticker", "year", "quarter", "transcriptID", "transcript", "date"]


def _write(path, text):
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "w", encoding="utf-8", newline="") as fh:
        fh.write(text)


def _csv(rows, header=HEADER, end="\n"):
    out = io.StringIO()
    csv.writer(out, lineterminator=end).writerows([header, *rows])
    return out.getvalue()


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


# --- SRC8 -----------------------------------------------------------------------

def test_one_scan_gives_good_rows_and_a_report(spark, scratch):
    """1,000 files, three bad ones: the rows of 997, and three named problems."""
    for i in range(1000):
        _write(f"{scratch}/t/ticker=T{i % 7}/{i}.csv", _csv([["X", 2024, 1 + i % 4, f"k{i}", f'one, "two"\nthree {i}', "2024-04-30"]]))
    _write(f"{scratch}/t/ticker=T0/0.csv", "no header here\n1,2,3\n")
    _write(f"{scratch}/t/ticker=T1/1.csv", _csv([["X", 2024, 1, "k", "cut", "d"]])[:-8] + '"open')
    _write(f"{scratch}/t/ticker=T2/2.csv", _csv([["X", "soon", 1, "k", "t", "d"]]))
    scan = scan_transcripts(spark, f"{scratch}/t")
    rows, bad = good_transcripts(scan).collect(), {r.source_path.rsplit("/", 1)[1]: r.problem for r in bad_files(scan).collect()}
    assert len(rows) == 997 and {r.transcript for r in rows} == {f'one, "two"\nthree {i}' for i in range(3, 1000)}
    assert bad == {"0.csv": "no transcript header", "1.csv": "unclosed quote", "2.csv": "year or quarter is no number"}
    assert "Exchange" not in _plan(good_transcripts(scan)) and "Join" not in _plan(good_transcripts(scan))
    with pytest.raises(Exception, match=r"(no transcript header|unclosed quote|no number) in .*[012]\.csv"):
        read_transcripts(spark, f"{scratch}/t").collect()


def test_cells_equal_a_csv_reader(spark, scratch):
    draw = random.Random(3)
    rows = [["T", 2020 + i % 5, 1 + i % 4, f"k{i}", "".join(draw.choice(['a', ',', '"', '\n', 'é', ' ', '\x1e', '\x1f', '\x1f1', '""']) for _ in range(30)) + "z", "d"] for i in range(300)]
    for n, end in enumerate(("\n", "\r\n")):
        _write(f"{scratch}/c/{n}.csv", ("﻿" if n else "") + _csv(rows, end=end))
    got = sorted((r.source_file, r.transcriptID, r.transcript) for r in read_transcripts(spark, f"{scratch}/c").collect())
    assert got == sorted((f"{n}.csv", r[3], r[4]) for n in range(2) for r in rows)


def test_other_problems_and_layouts(spark, scratch):
    d = f"{scratch}/p"
    _write(f"{d}/blank.csv", "\n")
    _write(f"{d}/only.csv", ",".join(HEADER))
    _write(f"{d}/missing.csv", _csv([[2024, 1]], ["year", "quarter"]))
    _write(f"{d}/wide.csv", _csv([["T", 2024, 1, "k", "t", "d", "more"]]))
    _write(f"{d}/short.csv", _csv([["T", 2024, 1, "k", "t"]]))
    _write(f"{d}/many.csv", _csv([[*range(30), 2024, 1, "k", "t", "d"]], [*(f"x{i}" for i in range(30)), *HEADER[1:]]))
    scan = scan_transcripts(spark, d)
    assert {r.source_path.rsplit("/", 1)[1]: r.problem for r in bad_files(scan).collect()} == {
        "blank.csv": "no transcript header", "missing.csv": "missing columns: transcriptID, transcript, date", "wide.csv": "more cells than the header"}
    assert sorted((r.source_file, r.ticker, r.date) for r in good_transcripts(scan).collect()) == [("many.csv", None, "d"), ("short.csv", "T", None)]


def test_long_transcript(spark, scratch):
    text = 'a "b", c\n' * 300_000
    _write(f"{scratch}/l/a.csv", _csv([["T", 2024, 1, "k", text, "d"]]))
    assert [r.transcript == text for r in read_transcripts(spark, f"{scratch}/l").collect()] == [True]


# --- SNK4, SNK5 --------------------------------------------------------------------

def test_hot_ticker_is_split_and_small_ones_are_not(spark, scratch):
    kind = "ticker string, year int, quarter int, transcriptID string, transcript string, date string"
    rows = [("HOT" if i % 2 else f"S{i % 6}", 2024, 1, f"k{i}", f'text "{i}",\n' + "x" * 500, "d") for i in range(2000)]
    write_transcripts(spark.createDataFrame(rows, kind).repartition(8), f"{scratch}/o", rows_per_file=300)
    count = {t: len(glob.glob(f"{scratch}/o/ticker={t}/*.csv")) for t in ("HOT", "S0", "S2", "S4")}
    assert count["HOT"] >= 4 and all(count[t] <= 3 for t in ("S0", "S2", "S4"))
    back = read_transcripts(spark, f"{scratch}/o").select("ticker", "year", "quarter", "transcriptID", "transcript", "date")
    assert sorted(map(tuple, back.collect())) == sorted(rows)


def test_csv_export_files_and_round_trip(spark, scratch):
    df = spark.range(5000).select("id", F.concat(F.lit(' a "'), F.col("id").cast("string"), F.lit('",\n')).alias("t"))
    export_csv(df.repartition(50), f"{scratch}/e", rows_per_file=2000)
    assert 3 <= len(glob.glob(f"{scratch}/e/*.csv")) <= 6
    back = spark.read.schema(df.schema).options(header=True, multiLine=True, escape='"', ignoreLeadingWhiteSpace=False).csv(f"{scratch}/e")
    assert sorted(map(tuple, back.collect())) == sorted(map(tuple, df.collect()))


# --- SNK1-SNK3 ---------------------------------------------------------------------

def test_publish_switches_whole_versions(spark, scratch):
    root = f"{scratch}/pub"
    assert current(spark, root).number == 0
    publish(spark, root, {"fact": spark.range(10), "dim": spark.range(3)})
    first = read_published(spark, root, "fact")
    publish(spark, root, {"fact": spark.range(5)})
    assert read_published(spark, root, "fact").count() == 5 and read_published(spark, root, "dim").count() == 3
    assert first.count() == 10  # a reader of the old version keeps it
    publish(spark, root, {"fact": spark.range(7)}, append=True)
    now = current(spark, root)
    assert now.number == 3 and now.rows == {"fact": 12, "dim": 3} and read_published(spark, root, "fact").count() == 12


def test_a_write_that_fails_leaves_the_old_rows(spark, scratch):
    root = f"{scratch}/pub"
    publish(spark, root, {"fact": spark.range(10)})
    broken = spark.range(100).select(F.when(F.col("id") == 99, F.raise_error(F.lit("midway")).cast("bigint")).otherwise(F.col("id")).alias("id"))
    with pytest.raises(Exception, match="midway"):
        publish(spark, root, {"dim": spark.range(2), "fact": broken})
    with pytest.raises(PublishError, match="expected"):
        publish(spark, root, {"fact": spark.range(4)}, expect={"fact": 5})
    assert current(spark, root).number == 1 and read_published(spark, root, "fact").count() == 10
    with pytest.raises(PublishError, match="no published table"):
        read_published(spark, root, "dim")
    assert remove_unpublished(spark, root) == []
    assert len(remove_unpublished(spark, root, older_than_hours=-1)) >= 2
    assert read_published(spark, root, "fact").count() == 10


# --- SRC12 --------------------------------------------------------------------------

def _facts(ticker, values):
    rec = [{"end": "2024-03-31", "val": v, "accn": "A", "fy": 2024, "fp": "Q1", "form": "10-Q", "filed": "2024-05-01"} for v in values]
    return json.dumps({"cik": 1, "entityName": ticker, "facts": {"us-gaap": {"Assets": {"label": "a", "description": "d", "units": {"USD": rec}}}}})


def test_rerun_reads_only_new_documents(spark, scratch):
    land, root, read = f"{scratch}/land", f"{scratch}/pub", []

    def to_rows(docs):
        read.append(sorted(os.path.basename(p) for p in docs.inputFiles()))
        return company_facts_rows(docs, keep=["source_path"])

    def check():
        want = sorted(map(tuple, read_company_facts(spark, land).collect()), key=str)
        assert sorted(map(tuple, read_published(spark, root, "rows").drop("source_path").collect()), key=str) == want

    for i in range(5):
        _write(f"{land}/ticker=T{i}/f {i}.json", _facts(f"T{i}", range(i + 1)))
    first = ingest(spark, land, root, COMPANY_FACTS_SCHEMA, to_rows, files_per_read=2)
    assert [len(r) for r in read] == [2, 2, 1] and first.rows["rows"] == 15
    check()
    assert ingest(spark, land, root, COMPANY_FACTS_SCHEMA, to_rows) == first and len(read) == 3
    _write(f"{land}/ticker=T9/f 9.json", _facts("T9", [1, 2]))
    second = ingest(spark, land, root, COMPANY_FACTS_SCHEMA, to_rows)
    assert [p.replace("%20", " ") for p in read[3]] == ["f 9.json"]
    assert second.folders["rows"][:1] == first.folders["rows"] and len(second.folders["rows"]) == 2
    check()
    _write(f"{land}/ticker=T1/f 1.json", _facts("T1", [7, 8, 9, 10]))  # changed
    os.rename(f"{land}/ticker=T9/f 9.json", f"{scratch}/moved.json")  # vanished
    ingest(spark, land, root, COMPANY_FACTS_SCHEMA, to_rows)
    assert [p.replace("%20", " ") for p in read[4]] == ["f 1.json"]
    check()
    assert read_published(spark, root, "files").count() == 5 == file_manifest(spark, land).count()


# --- SRC4, PIP4 -----------------------------------------------------------------------

def test_newest_version_of_a_landed_company(spark, scratch):
    for name, kind, at in (("a", "old", 1_000_000), ("b", "new", 2_000_000), ("c", "older", 500_000)):
        path = f"{scratch}/sub/ticker=T/{name}.json"
        _write(path, json.dumps({"cik": "7", "name": kind, "tickers": ["T", None]}))
        os.utime(path, (at, at))
    docs = read_json_documents(spark, f"{scratch}/sub", SUBMISSIONS_SCHEMA, versions=True)
    cons = spark.createDataFrame([("T", "0000000007")], "Symbol string, CIK string")
    got = company_dimension(docs, cons, ["T"]).collect()
    assert [(r.name, r.tickers) for r in got] == [("new", "T, None")] and len(got[0]) == 13


def test_newest_is_a_hash_aggregate(spark):
    rows = [("k", "2024-01-01", 5, "a"), ("k", "2024-01-02", -1, "b"), ("k", "2024-01-02", -2, "c"), (None, None, None, "d"), (None, None, 1, "e"), ("m", "1960-05-05", 0, "f")]
    df = spark.createDataFrame(rows, "k string, t string, tie bigint, v string").withColumn("t", F.to_timestamp("t"))
    out = newest(df, ["k"], "t", "tie")
    assert sorted(r.v for r in out.collect()) == ["b", "e", "f"]
    assert "SortAggregate" not in _plan(out) and "Window" not in _plan(out) and "HashAggregate" in _plan(out)


# --- SRC1, SRC2, SRC5 --------------------------------------------------------------------

def test_no_shuffle_after_a_facts_document_is_built(spark):
    docs = parse_json_documents(cs.facts_documents(spark, SF001), "doc", COMPANY_FACTS_SCHEMA, ["ticker"])
    assert _plan(company_facts_rows(docs)).count("Exchange") == _plan(docs).count("Exchange") > 0


def test_query_documents_have_every_case(spark):
    rows = cs.q_company_facts(spark, SF001)
    got = rows.agg(F.expr("count_if(start is null and monthWindow is not null)"), F.expr("count_if(monthWindow is null)"), F.expr("count_if(monthWindow > 0)")).first()
    assert min(got) > 0
    filings = cs.q_filings_rows(spark, SF001).agg(F.expr("count_if(aligned)"), F.expr("count_if(not aligned)"), F.expr("count_if(reportDate = '')")).first()
    assert min(filings) > 0
    docs = cs.chart_documents(spark, SF001)
    absent = docs.filter(~F.col("doc").contains("adjclose")).count()
    assert 0 < absent < docs.count()


def test_unequal_arrays_fail_or_are_reported(spark):
    docs = [("T", json.dumps({"cik": "1", "filings": {"recent": {"accessionNumber": ["a", "b"], "filingDate": ["2024-01-01"], "form": ["x", "y"]}}})),
            ("U", json.dumps({"cik": "2", "filings": {"recent": {"accessionNumber": ["c"], "filingDate": ["2024-01-01"], "reportDate": ["2023-12-31"]}}})),
            ("V", json.dumps({"cik": "3"})), ("W", None)]
    df = parse_json_documents(spark.createDataFrame(docs, "ticker string, doc string"), "doc", SUBMISSIONS_SCHEMA, ["ticker"])
    with pytest.raises(Exception, match="different lengths: 0000000001, T"):
        filings_rows(df).collect()
    assert [(r.ticker, r.longest, r.shorter) for r in filings_misaligned(df).collect()] == [("T", 2, {"filingDate": 1})]
    rows = filings_rows(df, on_mismatch="pad", flag_col="ok").orderBy("ticker", "filing_pos").collect()
    assert [(r.accessionNumber, r.filingDate, r.form, r.ok) for r in rows] == [
        ("a", "2024-01-01", "x", False), ("b", None, "y", False), ("c", "2024-01-01", None, True)]


def test_chart_dates_do_not_follow_the_session_zone(spark):
    def doc(times, closes):
        return json.dumps({"chart": {"result": [{"timestamp": times, "indicators": {"adjclose": [{"adjclose": closes}] if closes else []}}]}})

    docs = [("A", doc([1704151800, 1704238200], [1.5, None])), ("B", doc([0], None)), ("C", json.dumps({"chart": {"result": []}}))]
    df = parse_json_documents(spark.createDataFrame(docs, "ticker string, doc string"), "doc", CHART_SCHEMA, ["ticker"])
    for zone in ("UTC", "Asia/Tokyo", "America/Los_Angeles"):
        spark.conf.set("spark.sql.session.timeZone", zone)
        try:
            utc = sorted(map(tuple, chart_rows(df).collect()), key=str)
            new_york = {r.date for r in chart_rows(df, zone="America/New_York").collect()}
        finally:
            spark.conf.set("spark.sql.session.timeZone", "UTC")
        assert utc == [(1.5, "2024-01-01", "A"), (None, "1970-01-01", "B"), (None, "2024-01-02", "A")]
        assert new_york == {"2024-01-01", "2024-01-02", "1969-12-31"} or new_york == {"2024-01-01", "1969-12-31", "2024-01-02"}


# --- SRC6 ---------------------------------------------------------------------------------

def test_report_windows_prune_price_partitions(spark, scratch):
    bars = spark.range(4000).select(F.concat(F.lit("T"), (F.col("id") % 20).cast("string")).alias("ticker"), F.expr("date'2020-01-01' + cast(id div 20 as int)").alias("Date"), F.col("id").cast("double").alias("Close"))
    bars.write.partitionBy("ticker").parquet(f"{scratch}/px")
    spark.createDataFrame([("T3", "2020-06-15", 1), ("T5", "2020-07-01", 1), ("T6", "2020-07-01", 0)], "ticker string, reportDate string, ok int").write.parquet(f"{scratch}/r")
    reports = spark.read.parquet(f"{scratch}/r").filter("ok = 1")
    out = prices_for_windows(spark.read.parquet(f"{scratch}/px"), reports)
    assert "dynamicpruning" in _plan(out)
    got = out.agg(F.min("Date").cast("string"), F.max("Date").cast("string"), F.collect_set("ticker")).first()
    assert (got[0], got[1], sorted(got[2])) == ("2020-03-15", "2020-06-30", ["T3", "T5"])


# --- SRC7, PRJ1 -----------------------------------------------------------------------------

def test_header_collisions_fail_or_are_numbered(spark):
    raw = ["A b", " A-b", "a_B", "A_b_2", "c"]
    with pytest.raises(ValueError, match="same name.*A-b"):
        clean_names(raw)
    assert clean_names(raw, "number") == ["A_b", "A_b_3", "a_B_4", "A_b_2", "c"]
    assert clean_column_names(spark.range(1).toDF(" x y ")).columns == ["x_y"]


def test_constituent_lines(spark):
    lines = spark.createDataFrame([('MSFT,"Soft, ""ware""",789019',), ("XOM,,34088",), (None,)], "value string")
    got = sorted(map(tuple, constituents_from_lines(lines, ["Symbol", "GICS Sector", "CIK"]).collect()))
    assert got == [("MSFT", 'Soft, "ware"', "0000789019"), ("XOM", None, "0000034088")]
    for line in ("a,b", "a,b,c,d"):
        with pytest.raises(Exception, match="not 3 fields: a,b"):
            constituents_from_lines(spark.createDataFrame([(line,)], "value string"), ["x", "y", "CIK"]).count()
