"""Scalar functions against the hand-computed edge rows of FIXTURES.md part B."""

from __future__ import annotations

import math

import pytest
from pyspark.sql import functions as F

from ledgerlake.functions import (
    calendar_parts,
    change_class,
    date_key,
    fact_transcript_key,
    join_list,
    minus_months,
    pad_cik,
    percent_change,
    report_year,
    softmax_margin,
    text_measures,
    transcript_key,
)
from ledgerlake.functions.text import EDGE_SPACE, add_text_measures
from ledgerlake.operators.projections import clean_name


def test_pad_cik(spark):
    df = spark.createDataFrame([("320193",), ("0000320193",), ("12345678901",), (None,)], "c string")
    got = [r[0] for r in df.select(pad_cik("c")).collect()]
    assert got == ["0000320193", "0000320193", "12345678901", None]


def test_clean_name():
    assert clean_name(" GICS Sub-Industry ") == "GICS_Sub_Industry"


def test_date_key(spark):
    rows = [("2024-03-31", "x"), ("", "2024-02-01"), ("garbage", "2024-02-01"), ("", ""), (None, None)]
    df = spark.createDataFrame(rows, "a string, b string")
    got = [r[0] for r in df.select(date_key("a", "b")).collect()]
    assert got == ["20240331", "20240201", "20240201", None, None]


def test_minus_months(spark):
    rows = [("2024-05-31",), ("2024-02-29",), ("2023-02-28",), ("2024-01-15",)]
    df = spark.createDataFrame(rows, "d string")
    got = [str(r[0]) for r in df.select(minus_months("d")).collect()]
    assert got == ["2024-02-29", "2023-11-29", "2022-11-28", "2023-10-15"]


def test_change_class_bounds(spark):
    vals = [-5.01, -5.0, -2.01, -2.0, -0.01, 0.0, 0.01, 2.0, 2.01, 5.0, 5.01]
    df = spark.createDataFrame([(v,) for v in vals], "p double")
    assert [r[0] for r in df.select(change_class("p")).collect()] == [1, 2, 2, 3, 3, 4, 5, 5, 6, 6, 7]


def test_change_class_special(spark):
    df = spark.createDataFrame([(float("nan"),), (float("inf"),), (float("-inf"),), (None,)], "p double")
    assert [r[0] for r in df.select(change_class("p")).collect()] == [None, 7, 1, None]


def test_percent_change_reference_sign(spark):
    df = spark.createDataFrame([(10.0, 12.0)], "f double, l double")
    pct, cls = df.select(percent_change("f", "l").alias("p"), change_class(percent_change("f", "l"))).first()
    assert pct == pytest.approx(-16.6666666, rel=1e-6)
    assert cls == 1  # the price rose: the stored sign is inverted


def test_percent_change_zero_divisor(spark):
    df = spark.createDataFrame([(1.0, 0.0), (-1.0, 0.0), (0.0, 0.0)], "f double, l double")
    assert [r[0] for r in df.select(change_class(percent_change("f", "l"))).collect()] == [7, 1, None]


def test_percent_change_return_orientation(spark):
    df = spark.createDataFrame([(10.0, 12.0)], "f double, l double")
    assert df.select(percent_change("f", "l", "return")).first()[0] == pytest.approx(20.0)


def test_transcript_keys_agree(spark):
    df = spark.createDataFrame([("MSFT", "Q2", "2024-06-30", 2, 2024)], "t string, fp string, rd string, q int, y int")
    a, b = df.select(fact_transcript_key("t", "fp", report_year("rd")), transcript_key("t", "q", "y")).first()
    assert a == b == "MSFTQ22024"


def test_transcript_key_null_date(spark):
    df = spark.createDataFrame([("MSFT", "Q2", None)], "t string, fp string, rd string")
    assert df.select(fact_transcript_key("t", "fp", report_year("rd"))).first()[0] is None


def test_text_measures_example(spark):
    df = spark.createDataFrame([("  Strong growth, RISK! ",)], "t string")
    r = df.select(*[c.alias(n) for n, c in text_measures("t").items()]).first()
    assert (r.TransLength, r.TotalTokens, r.PositiveWordCount, r.NegativeWordCount) == (20, 3, 2, 1)


def test_text_measures_blank(spark):
    df = spark.createDataFrame([(None,), ("",), ("   ",), ("　\x1c\t",)], "transcript string")
    rows = add_text_measures(df, "transcript").collect()
    for r in rows:
        assert (r.TransLength, r.TotalTokens, r.PositiveWordCount, r.NegativeWordCount, r.SentimentScore) == (0, 0, 0, 0, 0.0)


def test_text_measures_unicode_words(spark):
    # Accented letters and combining marks stay inside a token; punctuation splits.
    df = spark.createDataFrame([("Croissance forte: l'été, été growth_rate",)], "t string")
    r = df.select(*[c.alias(n) for n, c in text_measures("t").items()]).first()
    assert r.TotalTokens == 6
    assert r.PositiveWordCount == 0  # growth_rate is one token, not "growth"


def test_text_measures_match_python(spark):
    import regex

    texts = ["Record profit and strong growth; risk of decline.", "LOSS loss Loss weakness weak", "  increase "]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    got = df.select(*[c.alias(n) for n, c in text_measures("t").items()]).collect()
    pos = {"growth", "profit", "strong", "increase", "record", "improvement", "innovation"}
    neg = {"decline", "loss", "weak", "decrease", "problem", "challenge", "risk"}
    for t, r in zip(texts, got):
        clean = t.lower().strip()
        words = regex.findall(r"\b\w+\b", clean)
        expect = (len(clean), len(words), sum(w in pos for w in words), sum(w in neg for w in words))
        assert (r.TransLength, r.TotalTokens, r.PositiveWordCount, r.NegativeWordCount) == expect


def test_edge_space_is_python_isspace():
    assert set(EDGE_SPACE) == {chr(c) for c in range(0x110000) if chr(c).isspace()}


def test_join_list(spark):
    df = spark.createDataFrame([(["A", "B"],), ([],), (["A", None],)], "a array<string>")
    assert [r[0] for r in df.select(join_list("a")).collect()] == ["A, B", "", "A, None"]


def test_calendar_parts_first_day(spark):
    df = spark.createDataFrame([("2010-01-01",)], "d string")
    r = df.select(*[c.alias(n) for n, c in calendar_parts("d").items()]).first()
    assert (r.day_of_week, r.day_name, r.month_name, r.week, r.quarter, r.is_weekend) == (4, "Friday", "January", 53, 1, False)


def test_softmax_margin(spark):
    df = spark.createDataFrame([([1.0, 2.0, 0.5],)], "l array<double>")
    got = df.select(softmax_margin("l")).first()[0]
    e = [math.exp(x) for x in (1.0, 2.0, 0.5)]
    assert got == pytest.approx((e[0] - e[1]) / sum(e))


def test_softmax_margin_of_large_logits(spark):
    df = spark.createDataFrame([([800.0, 1.0, 0.0],)], "l array<double>")
    assert df.select(softmax_margin("l")).first()[0] == pytest.approx(1.0)


def test_sentiment_with_injected_scorer(spark):
    """The injected scorer runs in an iterator pandas UDF; blank text stays 0.0."""

    def factory():
        return lambda texts: [[len(t), 0.0, 0.0] for t in texts]

    df = spark.createDataFrame([("abc",), ("",)], "transcript string")
    out = add_text_measures(df, "transcript", scorer_factory=factory).orderBy(F.desc("TransLength")).collect()
    e = [math.exp(3.0), 1.0, 1.0]
    assert out[0].SentimentScore == pytest.approx((e[0] - e[1]) / sum(e))
    assert out[1].SentimentScore == 0.0
