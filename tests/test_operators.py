"""Operators against hand-computed edge rows (FIXTURES.md part B) and
property checks (SURVEY §5 c)."""

from __future__ import annotations

import datetime as dt
import random

import pytest

from pyspark.sql import functions as F

from ledgerlake.operators import (
    add_price_change_class,
    attach_transcripts,
    decumulate,
    drop_sparse,
    keep_canonical,
    map_tags,
    merge_filings,
    missing_data_flags,
    month_window,
    next_values,
    period_means,
    pivot_facts,
    request_grid,
    union_all_by_name,
    validate,
    window_closes,
)
from ledgerlake.operators.quality import raise_if_failed

D = dt.date


def test_map_tags(spark):
    df = spark.createDataFrame([("AssetsCurrent",), ("ProfitLoss",), ("Goodwill",), (None,)], "finType string")
    assert [r[0] for r in map_tags(df).collect()] == ["Assets", "NetIncomeLoss", "Goodwill", None]


def test_keep_canonical(spark):
    df = spark.createDataFrame([("Assets",), ("EBITDA",), ("Goodwill",)], "finType string")
    assert [r[0] for r in keep_canonical(df).collect()] == ["Assets", "EBITDA"]


def test_pivot_first_is_max_and_missing_period(spark):
    rows = [
        ("t", "a1", "Q1", "2024-05-01", D(2024, 3, 31), "Assets", 5.0),
        ("t", "a1", "Q1", "2024-05-01", D(2024, 3, 31), "Assets", 9.0),
        ("t", "a1", "Q1", "2024-05-01", D(2024, 3, 31), "Revenues", 1.0),
        ("t", "a1", None, "2024-05-01", D(2024, 3, 31), "Assets", 7.0),
    ]
    df = spark.createDataFrame(rows, "ticker string, accn string, fp string, filed string, endDate date, finType string, val double")
    out = pivot_facts(df, max_nulls_exclusive=11)
    got = {r.financialPeriod: (r.Assets, r.Revenues) for r in out.collect()}
    assert got == {"Q1": (9.0, 1.0), "NotAvailable": (7.0, None)}
    assert "EBITDA" in out.columns and "StockholdersEquity" in out.columns


def test_drop_sparse(spark):
    from ledgerlake import fixed

    metrics = fixed.COUNTED_METRICS

    def row(n_null, ebitda=1.0):
        return tuple([None] * n_null + [1.0] * (10 - n_null) + [ebitda])

    schema = ", ".join(f"{m} double" for m in metrics + ["EBITDA"])
    df = spark.createDataFrame([row(3), row(4), row(5), row(3, None)], schema)
    got = [sum(v is None for v in r[:10]) for r in drop_sparse(df).collect()]
    assert sorted(got) == [3, 3]


def test_merge_filings_keys_and_same_year(spark):
    filings = spark.createDataFrame(
        [("A1", D(2024, 3, 31), "10-Q", D(2024, 5, 1), "d", "u")],
        "accessionNumber string, reportDate date, form string, filingDate date, primaryDocDescription string, fileURL string",
    )
    pivot = spark.createDataFrame(
        [("t", "A1", "Q1", D(2024, 5, 2), D(2024, 3, 31)),  # other filing date: no match
         ("t", "A1", "Q1", D(2024, 5, 1), D(2023, 12, 31)),  # other year: dropped
         ("t", "A1", "Q1", D(2024, 5, 1), D(2024, 3, 31))],
        "ticker string, accessionNumber string, financialPeriod string, filingDate date, endDate date",
    )
    out = merge_filings(pivot, filings).collect()
    assert [(r.endDate, r.filingDate) for r in out] == [(D(2024, 3, 31), D(2024, 5, 1))]


def _win1(spark, rows, bucket=None):
    df = spark.createDataFrame(rows, "ticker string, pos int, financialPeriod string, Revenues double")
    order = [F.col("pos").asc()]
    out = decumulate(df, ["ticker"], order, value_cols=["Revenues"], bucket=bucket, bucket_ascending=True)
    return [(r.financialPeriod, r.Revenues) for r in out.orderBy("ticker", "pos").collect()]


@pytest.mark.parametrize("bucketed", [False, True])
def test_decumulate_cases(spark, bucketed):
    bucket = F.col("pos") if bucketed else None
    # newest first: FY 10, Q3 7, Q2 4, Q1 1 -> Q4 3, Q3 3, Q2 3, Q1 1
    assert _win1(spark, [("t", 0, "FY", 10.0), ("t", 1, "Q3", 7.0), ("t", 2, "Q2", 4.0), ("t", 3, "Q1", 1.0)], bucket) == [
        ("Q4", 3.0), ("Q3", 3.0), ("Q2", 3.0), ("Q1", 1.0)]
    # same-period neighbours are subtracted
    assert _win1(spark, [("t", 0, "Q2", 5.0), ("t", 1, "Q2", 3.0), ("t", 2, "Q1", 1.0)], bucket) == [
        ("Q2", 2.0), ("Q2", 2.0), ("Q1", 1.0)]
    # FY after FY: nothing subtracted
    assert _win1(spark, [("t", 0, "FY", 10.0), ("t", 1, "FY", 8.0)], bucket) == [("Q4", 10.0), ("Q4", 8.0)]
    # a null neighbour leaves the value
    assert _win1(spark, [("t", 0, "Q2", 5.0), ("t", 1, "Q1", None)], bucket) == [("Q2", 5.0), ("Q1", None)]
    # no subtraction across tickers
    assert _win1(spark, [("a", 0, "Q2", 5.0), ("b", 0, "Q1", 1.0)], bucket) == [("Q2", 5.0), ("Q1", 1.0)]


def test_next_values_bucketed_equals_plain(spark):
    """Bucketed lead must equal one window per partition, including null keys,
    empty buckets in between and ties broken by a second order column."""
    rnd = random.Random(7)
    rows = []
    for i in range(600):
        key = rnd.choice(["a", "b", None, "hot", "hot", "hot"])
        rows.append((key, rnd.randint(0, 40), i, rnd.random()))
    df = spark.createDataFrame(rows, "k string, t int, id int, v double")
    order = [F.col("t").desc(), F.col("id").asc()]
    plain = next_values(df, ["k"], order, ["v", "id"])
    bucketed = next_values(df, ["k"], order, ["v", "id"], bucket=F.floor(F.col("t") / 7), bucket_ascending=False)
    cols = ["id", "_next_v", "_next_id", "_has_next"]
    assert sorted(plain.select(cols).collect()) == sorted(bucketed.select(cols).collect())


def test_decumulate_telescopes(spark):
    """Four clean quarterly rows of one year: the quarters sum to the FY value."""
    rows = [("t", 0, "FY", 40.0), ("t", 1, "Q3", 27.0), ("t", 2, "Q2", 16.0), ("t", 3, "Q1", 7.0)]
    got = _win1(spark, rows, F.col("pos"))
    assert sum(v for _, v in got) == 40.0


def test_price_window_bounds(spark):
    facts = spark.createDataFrame([("T", D(2024, 3, 31))], "ticker string, reportDate date")
    prices = spark.createDataFrame(
        [("T", D(2023, 12, 30), 1.0), ("T", D(2023, 12, 31), 10.0), ("T", D(2024, 3, 28), 12.0), ("T", D(2024, 3, 31), 99.0)],
        "ticker string, date date, close double",
    )
    r = window_closes(facts, prices).first()
    assert (r.first_close, r.last_close) == (10.0, 12.0)
    cls = add_price_change_class(facts, prices, "ticker", "reportDate", "ticker", "date", "close").first()
    assert cls.stockPriceChange == 1


def test_price_window_null_edge_and_empty(spark):
    facts = spark.createDataFrame([("T", D(2024, 3, 31)), ("U", D(2024, 3, 31))], "ticker string, reportDate date")
    prices = spark.createDataFrame([("T", D(2024, 1, 2), None), ("T", D(2024, 2, 2), 5.0)], "ticker string, date date, close double")
    out = {r.ticker: r.stockPriceChange for r in add_price_change_class(facts, prices, "ticker", "reportDate", "ticker", "date", "close").collect()}
    assert out == {"T": None, "U": None}


def test_period_means_skip_nulls(spark):
    rows = [("T", D(2024, 1, 5), 1.0), ("T", D(2024, 2, 5), None), ("T", D(2024, 3, 5), 3.0), ("T", D(2024, 4, 5), 8.0)]
    df = spark.createDataFrame(rows, "ticker string, date date, v double")
    out = {r.date: (r.quarter_mean, r.month_mean) for r in period_means(df, ["ticker"], "date", "v").collect()}
    assert out[D(2024, 1, 5)] == (2.0, 1.0)
    assert out[D(2024, 2, 5)] == (2.0, None)
    assert out[D(2024, 4, 5)] == (8.0, 8.0)


def test_month_window(spark):
    days = [0, 29, 30, 59, 60, 90, -5, None]
    start = D(2024, 1, 1)
    rows = [("t", "A", str(start) if d is not None else None, str(start + dt.timedelta(days=d if d is not None else 10))) for d in days]
    rows.append(("t", "B", None, "2024-02-01"))
    df = spark.createDataFrame(rows, "ticker string, finType string, start string, end string")
    out = month_window(df, ["ticker", "finType"])
    got_a = [r.monthWindow for r in out.filter("finType = 'A'").collect()]
    assert sorted(got_a) == sorted([0, 0, 1, 1, 2, 3, 0, 0])
    assert [r.monthWindow for r in out.filter("finType = 'B'").collect()] == [None]


def test_attach_transcripts_duplicates_and_nulls(spark):
    facts = spark.createDataFrame([(1, "K"), (2, None), (3, "Z")], "id int, transcriptID string")
    tr = spark.createDataFrame([("K", 10), ("K", 11), (None, 5)], "transcriptID string, TransLength int")
    got = sorted((r.id, r.TransLength) for r in attach_transcripts(facts, tr).collect())
    assert got == [(1, 10), (1, 11), (2, 5), (3, None)]


def test_validate_rules(spark):
    rows = [("t", D(2024, 3, 31), D(2024, 5, 1), "Q1", None), ("t", D(2024, 6, 30), D(2024, 8, 1), "Q2", 8),
            ("t", D(2024, 6, 30), D(2024, 8, 2), "Q2", 3)]
    df = spark.createDataFrame(rows, "ticker string, reportDate date, filingDate date, financialPeriod string, stockPriceChange int")
    report = {r.rule: r.violations for r in validate(df).collect()}
    assert report["not_null:stockPriceChange"] == 1
    assert report["allowed_values:stockPriceChange"] == 2
    assert report["unique:ticker,financialPeriod,reportDate"] == 1
    with pytest.raises(ValueError, match="allowed_values"):
        raise_if_failed(validate(df))


def test_missing_data_flags(spark):
    from ledgerlake import fixed

    cols = fixed.VALIDATION_KEYS + fixed.VALIDATION_FLAGS
    vals = ["t", "2024-03-31", "2024-05-01", "A1", 4] + [None] + [1.0] * 9
    schema = ", ".join(f"{c} {'int' if c == 'stockPriceChange' else ('double' if c in fixed.VALIDATION_FLAGS else 'string')}" for c in cols)
    df = spark.createDataFrame([tuple(vals), tuple(vals), tuple(["t", "2024-03-31", "2024-05-02", "A2", 4] + [1.0] * 10)], schema)
    out = missing_data_flags(df).collect()
    assert len(out) == 1
    assert out[0].Assets is True and out[0].stockPriceChange is False and out[0].Revenues is False


def test_union_by_name_counts(spark):
    a = spark.createDataFrame([(1, "x")], "k int, s string")
    b = spark.createDataFrame([(2,), (3,)], "k int")
    u = union_all_by_name(a, b)
    assert u.count() == 3 and u.filter("s is null").count() == 2


def test_request_grid(spark):
    t = spark.createDataFrame([("A",), ("B",)], "ticker string")
    g = request_grid(t, [2024, 2025], [1, 2, 3, 4])
    assert g.count() == 16
    assert g.select("year", "quarter").distinct().count() == 8


def test_classification_total_and_monotone(spark):
    vals = [x / 10 for x in range(-100, 101)]
    df = spark.createDataFrame([(v,) for v in vals], "p double")
    from ledgerlake.functions import change_class

    got = [r[1] for r in sorted(df.select("p", change_class("p")).collect())]
    assert all(c in range(1, 8) for c in got)
    assert got == sorted(got)


def test_raw_tag_prefilter_equals_rollup_then_filter(spark):
    from ledgerlake.operators import keep_rollup_canonical

    tags = ["Assets", "AssetsCurrent", "ProfitLoss", "Goodwill", "EBITDA", "OperatingIncomeLossBeforeDepreciationAndAmortization", None, "Revenues"]
    df = spark.createDataFrame([(t, i) for i, t in enumerate(tags)], "finType string, id int")
    slow = keep_canonical(map_tags(df))
    fast = keep_rollup_canonical(df)
    assert sorted(slow.collect()) == sorted(fast.collect())


def test_decumulate_keeps_shared_submissions_apart(spark):
    """Two tickers' lists hold the same filings: one list follows the other."""
    rows = [(t, "G", p, period, float(v), "2024-01-01", "2024-01-01", f"a{p}")
            for t in ("GOOG", "GOOGL") for p, period, v in ((0, "Q3", 60), (1, "Q2", 30), (2, "Q1", 10))]
    df = spark.createDataFrame(
        rows, "filing_ticker string, ticker string, filing_pos int, financialPeriod string, NetIncome double, filingDate string, endDate string, accessionNumber string"
    )
    for bucket in ("auto", None):
        out = decumulate(df, value_cols=["NetIncome"], bucket=bucket).where("financialPeriod <> 'Q1'").collect()
        assert sorted(r.NetIncome for r in out) == [20.0, 20.0, 30.0, 30.0]
