"""Registered queries on the driver's test tables, each with a DuckDB oracle.

Every query reads whole tables (or frames Spark derives from them) and runs
the engine's operators in a role mapping: events play tagged facts, orders
and lineitem play filings, facts and prices, documents play transcripts.
Output columns are DOUBLE / BIGINT / VARCHAR / BOOLEAN with identical names on
both sides; dates are written as ``yyyy-MM-dd`` text.

The oracle SQL restates the *semantics* independently (plain window / join /
CASE SQL), so it checks the Spark plans rather than mirroring them.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerlake.functions.classify import percent_change
from ledgerlake.functions.scalars import (
    date_key,
    days_between,
    fact_transcript_key,
    filing_url,
    first_key,
    first_value,
    join_list,
    pad_cik,
    transcript_key,
)
from ledgerlake.functions.text import sentiment_score, softmax_margin, text_measures
from ledgerlake.operators.joins import attach_transcripts, merge_filings, years_of
from ledgerlake.operators.periods import decumulate, month_window, period_means
from ledgerlake.operators.prices import add_price_change_class, window_closes
from ledgerlake.operators.projections import distinct_rows, rows_with_nulls, union_all_by_name
from ledgerlake.operators.quality import duplicate_keys, missing_data_flags, null_counts, validate
from ledgerlake.operators.reshape import drop_sparse, pivot_wide
from ledgerlake.operators.tags import keep_rollup_canonical, map_tags
from ledgerlake import fixed
from ledgerlake.plans.catalog_sources import CATALOG_SOURCES
from ledgerlake.plans.dims import price_change_dimension, price_profile
from ledgerlake.plans.filings import build_filings_fact
from ledgerlake.plans.tables import date_text as _ds
from ledgerlake.plans.tables import table as _t
from ledgerlake.session import spread
from ledgerlake.operators.projections import keep_members
from ledgerlake.sources.calendar import calendar_for
from ledgerlake.sources.files import harvest_transcripts, lookup_cik
from ledgerlake.sources.filings_json import explode_parallel

Query = Callable[[SparkSession, str], DataFrame]


# Role mapping of event types to a two-parent tag hierarchy (SCL4 / FLT2).
EVENT_HIERARCHY = {"engagement": ["click", "view"], "revenue": ["purchase"]}
EVENT_TYPES = ["click", "error", "purchase", "signup", "view"]
# Word lists for the text measures on the invented multi-language prose.
TEST_POSITIVE = ["the", "la", "der"]
TEST_NEGATIVE = ["and", "le", "die"]


# -- SCL4 -------------------------------------------------------------------
def q_tag_rollup(spark, sf):
    ev = _t(spark, sf, "events")
    return map_tags(ev, "event_type", EVENT_HIERARCHY, out_col="tag").select("event_id", "event_type", "tag")


SQL_TAG_ROLLUP = """
SELECT event_id, event_type,
       CASE WHEN event_type IN ('click', 'view') THEN 'engagement'
            WHEN event_type = 'purchase' THEN 'revenue'
            ELSE event_type END AS tag
FROM events
"""


# -- SCL4 + FLT2 -------------------------------------------------------------
def q_canonical_tags(spark, sf):
    ev = keep_rollup_canonical(_t(spark, sf, "events"), "event_type", EVENT_HIERARCHY)
    return ev.select("event_id", F.col("event_type").alias("tag"), "value")


SQL_CANONICAL_TAGS = """
SELECT event_id,
       CASE WHEN event_type IN ('click', 'view') THEN 'engagement' ELSE 'revenue' END AS tag,
       value
FROM events WHERE event_type IN ('click', 'view', 'purchase')
"""


# -- AGG1 --------------------------------------------------------------------
def _event_pivot(spark, sf):
    ev = _t(spark, sf, "events").withColumn("day", _ds("ts"))
    return pivot_wide(ev, ["user_id", "day"], "event_type", "value", EVENT_TYPES, "max")


def q_pivot_max(spark, sf):
    return _event_pivot(spark, sf)


SQL_EVENT_PIVOT = """
SELECT user_id, strftime(ts, '%Y-%m-%d') AS day,
       max(CASE WHEN event_type = 'click' THEN value END) AS click,
       max(CASE WHEN event_type = 'error' THEN value END) AS error,
       max(CASE WHEN event_type = 'purchase' THEN value END) AS purchase,
       max(CASE WHEN event_type = 'signup' THEN value END) AS signup,
       max(CASE WHEN event_type = 'view' THEN value END) AS view
FROM events GROUP BY 1, 2
"""


# -- FLT3 / AGG4 -------------------------------------------------------------
def q_missing_lt(spark, sf):
    return drop_sparse(_event_pivot(spark, sf), EVENT_TYPES, 4)


SQL_MISSING_LT = f"""
SELECT * FROM ({SQL_EVENT_PIVOT}) p
WHERE (CAST(click IS NULL AS INT) + CAST(error IS NULL AS INT) + CAST(purchase IS NULL AS INT)
       + CAST(signup IS NULL AS INT) + CAST(view IS NULL AS INT)) < 4
"""


# -- DQ2 / FLT5 / AGG5 ---------------------------------------------------------
def q_missing_flags(spark, sf):
    return missing_data_flags(_event_pivot(spark, sf), ["user_id"], ["click", "view", "purchase"])


SQL_MISSING_FLAGS = f"""
SELECT DISTINCT user_id, click IS NULL AS click, view IS NULL AS view, purchase IS NULL AS purchase
FROM ({SQL_EVENT_PIVOT}) p
WHERE click IS NULL OR view IS NULL OR purchase IS NULL
"""


# -- JON2 + FLT4 -------------------------------------------------------------
def q_filing_merge(spark, sf):
    filings = _t(spark, sf, "orders").select(
        F.col("o_orderkey").alias("orderkey"), "o_orderdate", "o_orderpriority"
    )
    facts = _t(spark, sf, "lineitem").select(
        F.col("l_orderkey").alias("orderkey"), "l_linenumber", "l_shipdate", "l_extendedprice"
    )
    m = merge_filings(facts, filings, ["orderkey"], "l_shipdate", "o_orderdate", ["orderkey", "o_orderdate", "o_orderpriority"])
    return m.select(
        "orderkey", _ds("o_orderdate").alias("report_date"), "o_orderpriority",
        F.col("l_linenumber").cast("bigint").alias("l_linenumber"), _ds("l_shipdate").alias("end_date"), "l_extendedprice",
    )


SQL_FILING_MERGE = """
SELECT o.o_orderkey AS orderkey, strftime(o.o_orderdate, '%Y-%m-%d') AS report_date, o.o_orderpriority,
       CAST(l.l_linenumber AS BIGINT) AS l_linenumber, strftime(l.l_shipdate, '%Y-%m-%d') AS end_date, l.l_extendedprice
FROM orders o JOIN lineitem l ON o.o_orderkey = l.l_orderkey
WHERE year(l.l_shipdate) = year(o.o_orderdate)
"""


# -- WIN1 + SCL19 ------------------------------------------------------------
def _order_periods(spark, sf):
    o = _t(spark, sf, "orders")
    q = F.quarter("o_orderdate")
    return o.select(
        "o_orderkey",
        "o_custkey",
        F.col("o_orderdate"),
        F.when(q == 4, F.lit("FY")).otherwise(F.concat(F.lit("Q"), q.cast("string"))).alias("fp"),
        F.col("o_totalprice").alias("v"),
        (F.col("o_totalprice") / 100).alias("w"),
    )


def q_decumulate(spark, sf):
    d = decumulate(
        _order_periods(spark, sf),
        partition_cols=["o_custkey"],
        order=[F.col("o_orderdate").desc(), F.col("o_orderkey").desc()],
        period_col="fp",
        value_cols=["v", "w"],
        bucket=F.trunc("o_orderdate", "month"),
        bucket_ascending=False,
    )
    return d.select("o_orderkey", "o_custkey", "fp", "v", "w")


SQL_DECUMULATE = """
WITH b AS (
  SELECT o_orderkey, o_custkey, o_orderdate,
         CASE WHEN quarter(o_orderdate) = 4 THEN 'FY' ELSE 'Q' || quarter(o_orderdate) END AS fp,
         o_totalprice AS v, o_totalprice / 100 AS w
  FROM orders),
n AS (
  SELECT *, lead(fp) OVER win AS nfp, lead(v) OVER win AS nv, lead(w) OVER win AS nw,
         lead(1) OVER win IS NOT NULL AS has_next
  FROM b WINDOW win AS (PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey DESC))
SELECT o_orderkey, o_custkey,
       CASE WHEN fp = 'FY' THEN 'Q4' ELSE fp END AS fp,
       CASE WHEN has_next AND fp IN ('Q2','Q3','FY') AND nfp IN ('Q1','Q2','Q3') AND v IS NOT NULL AND nv IS NOT NULL
            THEN v - nv ELSE v END AS v,
       CASE WHEN has_next AND fp IN ('Q2','Q3','FY') AND nfp IN ('Q1','Q2','Q3') AND w IS NOT NULL AND nw IS NOT NULL
            THEN w - nw ELSE w END AS w
FROM n
"""


# -- WIN1 along filing lists ------------------------------------------------------
# A nation is a company with the lists of all its customers, one list after the
# other; the position in a list counts days back from 2100 (newest first).
# Urgent orders are on a second list of the customer, too, so accessions repeat.
def q_decumulate_lists(spark, sf):
    c = _t(spark, sf, "customer").select("c_custkey", "c_nationkey")
    o = _t(spark, sf, "orders").join(c, F.col("o_custkey") == F.col("c_custkey"), "inner")
    q = F.quarter("o_orderdate")
    listed = o.select(
        F.concat(F.lit("N"), F.col("c_nationkey").cast("string")).alias("ticker"),
        F.explode(F.when(F.col("o_orderpriority") == "1-URGENT", F.array(F.lit("C"), F.lit("Z"))).otherwise(F.array(F.lit("C")))).alias("list"),
        "o_custkey", F.datediff(F.lit("2100-01-01"), F.to_date("o_orderdate")).cast("bigint").alias("filing_pos"),
        F.when(q == 4, F.lit("FY")).otherwise(F.concat(F.lit("Q"), q.cast("string"))).alias("financialPeriod"),
        F.to_date("o_orderdate").alias("filingDate"), F.to_date("o_orderdate").alias("endDate"),
        F.concat(F.lit("A"), F.lpad(F.col("o_orderkey").cast("string"), 10, "0")).alias("accessionNumber"), F.col("o_totalprice").alias("v"),
    )
    listed = listed.withColumn("filing_ticker", F.concat("list", F.col("o_custkey").cast("string"))).drop("list", "o_custkey")
    out = decumulate(listed, value_cols=["v"])
    return out.select("ticker", "filing_ticker", "filing_pos", "accessionNumber", "financialPeriod", "v")


SQL_DECUMULATE_LISTS = """
WITH l AS (
  SELECT 'N' || c_nationkey AS ticker, unnest(CASE WHEN o_orderpriority = '1-URGENT' THEN ['C', 'Z'] ELSE ['C'] END) || o_custkey AS filing_ticker,
         CAST(DATE '2100-01-01' - CAST(o_orderdate AS DATE) AS BIGINT) AS filing_pos, CASE WHEN quarter(o_orderdate) = 4 THEN 'FY' ELSE 'Q' || quarter(o_orderdate) END AS fp,
         'A' || lpad(CAST(o_orderkey AS VARCHAR), 10, '0') AS accession, o_totalprice AS v
  FROM orders JOIN customer ON o_custkey = c_custkey
), n AS (
  SELECT *, lead(fp) OVER w AS nfp, lead(v) OVER w AS nv FROM l
  WINDOW w AS (PARTITION BY ticker ORDER BY filing_ticker, filing_pos, fp, accession)
)
SELECT ticker, filing_ticker, filing_pos, accession AS "accessionNumber", CASE WHEN fp = 'FY' THEN 'Q4' ELSE fp END AS "financialPeriod",
       CASE WHEN fp IN ('Q2', 'Q3', 'FY') AND nfp IN ('Q1', 'Q2', 'Q3') AND v IS NOT NULL AND nv IS NOT NULL THEN v - nv ELSE v END AS v
FROM n
"""


# -- JON4 + AGG3 + SCL6 ------------------------------------------------------
def _supplier_prices(spark, sf):
    # Nearly every line has a day and a month of its own, so aggregating before
    # the shuffle would hold a whole split in memory and save nothing.
    li = _t(spark, sf, "lineitem")
    lines = li.select(F.col("l_suppkey").alias("ticker"), F.to_date("l_shipdate").alias("date"), "l_extendedprice")
    prices = spread(lines, "ticker", "date").groupBy("ticker", "date").agg(F.max("l_extendedprice").alias("close"))
    ends = li.select(F.col("l_suppkey").alias("ticker"), F.last_day(F.to_date("l_shipdate")).alias("reportDate"))
    facts = spread(ends, "ticker", "reportDate").distinct()
    return facts, prices


def q_price_window(spark, sf):
    facts, prices = _supplier_prices(spark, sf)
    closes = window_closes(facts, prices)  # never a null key: plain equi-join keeps its partitioning
    out = facts.join(closes, ["ticker", "reportDate"], "left")
    return out.select(
        "ticker", _ds("reportDate").alias("report_date"), "first_close", "last_close",
        percent_change("first_close", "last_close").alias("pct"),
    )


_SQL_SUPPLIER_WINDOWS = """
WITH p AS (SELECT l_suppkey AS t, CAST(l_shipdate AS DATE) AS d, max(l_extendedprice) AS c FROM lineitem GROUP BY 1, 2),
f AS (SELECT DISTINCT l_suppkey AS t, last_day(CAST(l_shipdate AS DATE)) AS rd FROM lineitem),
j AS (SELECT f.t, f.rd, arg_min(p.c, p.d) AS first_close, arg_max(p.c, p.d) AS last_close
      FROM f JOIN p ON p.t = f.t AND p.d >= CAST(f.rd - INTERVAL 3 MONTH AS DATE) AND p.d < f.rd
      GROUP BY 1, 2),
w AS (SELECT f.t, f.rd, j.first_close, j.last_close,
             (j.first_close - j.last_close) * 100 / j.last_close AS pct
      FROM f LEFT JOIN j ON f.t = j.t AND f.rd = j.rd)
"""
SQL_PRICE_WINDOW = _SQL_SUPPLIER_WINDOWS + """
SELECT t AS ticker, strftime(rd, '%Y-%m-%d') AS report_date, first_close, last_close, pct FROM w
"""


# -- SCL7 + SCL8 (PIP2 core) --------------------------------------------------
def q_classify(spark, sf):
    facts, prices = _supplier_prices(spark, sf)
    out = add_price_change_class(facts, prices, "ticker", "reportDate", "ticker", "date", "close")
    return out.select("ticker", _ds("reportDate").alias("report_date"), F.col("stockPriceChange").cast("bigint").alias("stockPriceChange"))


SQL_CLASSIFY = _SQL_SUPPLIER_WINDOWS + """
SELECT t AS ticker, strftime(rd, '%Y-%m-%d') AS report_date,
       CAST(CASE WHEN pct IS NULL OR isnan(pct) THEN NULL
            WHEN pct < -5 THEN 1 WHEN pct < -2 THEN 2 WHEN pct < 0 THEN 3 WHEN pct = 0 THEN 4
            WHEN pct <= 2 THEN 5 WHEN pct <= 5 THEN 6 ELSE 7 END AS BIGINT) AS stockPriceChange
FROM w
"""


# -- AGG2 --------------------------------------------------------------------
def q_period_means(spark, sf):
    li = _t(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_suppkey", "l_shipdate", "l_extendedprice")
    out = period_means(li, ["l_suppkey"], "l_shipdate", "l_extendedprice", decimal_scale=2)
    return out.select(
        "l_orderkey", F.col("l_linenumber").cast("bigint").alias("l_linenumber"), "l_suppkey",
        _ds("l_shipdate").alias("ship_date"), "quarter_mean", "month_mean",
    )


SQL_PERIOD_MEANS = """
SELECT l_orderkey, CAST(l_linenumber AS BIGINT) AS l_linenumber, l_suppkey, strftime(l_shipdate, '%Y-%m-%d') AS ship_date,
  CAST(sum(CAST(l_extendedprice AS DECIMAL(18,2))) OVER (PARTITION BY l_suppkey, year(l_shipdate), quarter(l_shipdate)) AS DOUBLE)
    / count(l_extendedprice) OVER (PARTITION BY l_suppkey, year(l_shipdate), quarter(l_shipdate)) AS quarter_mean,
  CAST(sum(CAST(l_extendedprice AS DECIMAL(18,2))) OVER (PARTITION BY l_suppkey, year(l_shipdate), month(l_shipdate)) AS DOUBLE)
    / count(l_extendedprice) OVER (PARTITION BY l_suppkey, year(l_shipdate), month(l_shipdate)) AS month_mean
FROM lineitem
"""


# -- PIP5 (SCL9 + AGG2 + SCL3) ------------------------------------------------
def q_price_profile(spark, sf):
    li = _t(spark, sf, "lineitem")
    chart = li.select(
        F.col("l_suppkey").cast("string").alias("ticker"), _ds("l_shipdate").alias("date"),
        F.col("l_extendedprice").alias("adjClose"),
    )
    return price_profile(chart, decimal_scale=2, keep_labels=True)


SQL_PRICE_PROFILE = """
SELECT l_extendedprice AS adjClose, CAST(l_suppkey AS VARCHAR) AS ticker,
  CAST(sum(CAST(l_extendedprice AS DECIMAL(18,2))) OVER (PARTITION BY l_suppkey, year(l_shipdate), quarter(l_shipdate)) AS DOUBLE)
    / count(l_extendedprice) OVER (PARTITION BY l_suppkey, year(l_shipdate), quarter(l_shipdate)) AS quarter_meanADJclose,
  CAST(sum(CAST(l_extendedprice AS DECIMAL(18,2))) OVER (PARTITION BY l_suppkey, year(l_shipdate), month(l_shipdate)) AS DOUBLE)
    / count(l_extendedprice) OVER (PARTITION BY l_suppkey, year(l_shipdate), month(l_shipdate)) AS month_meanADJclose,
  strftime(l_shipdate, '%Y%m%d') AS yearMonthDay,
  'Q' || quarter(l_shipdate) || '-' || year(l_shipdate) AS Quarter,
  'Month' || month(l_shipdate) || '-' || year(l_shipdate) AS Month
FROM lineitem
"""


# -- SCL16 -------------------------------------------------------------------
def q_text_stats(spark, sf):
    docs = _t(spark, sf, "documents")
    return docs.select("doc_id", *[c.alias(n) for n, c in text_measures("text", TEST_POSITIVE, TEST_NEGATIVE).items()])


# Python str.strip() white space, and Unicode word characters, in RE2 syntax.
_RE2_SPACE = r"[\s\x0b\x1c-\x1f\x85\xa0\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]"
_RE2_WORD = r"[\p{L}\p{M}\p{Nd}\p{Nl}\p{Pc}\x{200c}\x{200d}]+"
_SQL_CLEAN = f"regexp_replace(lower(text), '^{_RE2_SPACE}+|{_RE2_SPACE}+$', '', 'g')"


def _sql_text_measures(text_expr: str, pos: list[str], neg: list[str]) -> str:
    clean = _SQL_CLEAN.replace("text", text_expr)
    toks = f"regexp_extract_all({clean}, '{_RE2_WORD}')"
    plist = ", ".join(f"'{w}'" for w in pos)
    nlist = ", ".join(f"'{w}'" for w in neg)
    blank = f"({text_expr} IS NULL OR length({clean}) = 0)"
    return f"""
       CAST(CASE WHEN {blank} THEN 0 ELSE length({clean}) END AS BIGINT) AS TransLength,
       CAST(CASE WHEN {blank} THEN 0 ELSE len({toks}) END AS BIGINT) AS TotalTokens,
       CAST(CASE WHEN {blank} THEN 0 ELSE len(list_filter({toks}, lambda x: x IN ({plist}))) END AS BIGINT) AS PositiveWordCount,
       CAST(CASE WHEN {blank} THEN 0 ELSE len(list_filter({toks}, lambda x: x IN ({nlist}))) END AS BIGINT) AS NegativeWordCount"""


SQL_TEXT_STATS = f"SELECT doc_id, {_sql_text_measures('text', TEST_POSITIVE, TEST_NEGATIVE)} FROM documents"


# -- JON3 + SCL11 + SCL12 + SCL18 ---------------------------------------------
def q_transcript_join(spark, sf):
    docs = _t(spark, sf, "documents")
    labels = _t(spark, sf, "labels")
    # Transcripts: labelled documents; quarter from the quality label, year from the id.
    # Texts are measured where they are read, so only the measures cross the join.
    measures = text_measures("text", TEST_POSITIVE, TEST_NEGATIVE)
    measured = docs.select(
        "doc_id", "lang", *[c.alias(n) for n, c in measures.items()], sentiment_score("text", None).alias("SentimentScore")
    )
    tr = measured.join(labels, "doc_id", "inner").select(
        transcript_key("lang", F.col("quality") + 1, "doc_id").alias("transcriptID"), *measures, "SentimentScore"
    )
    facts = docs.select("doc_id", fact_transcript_key("lang", F.lit("Q1"), F.col("doc_id")).alias("transcriptID"))
    return attach_transcripts(facts, tr, "transcriptID")


SQL_TRANSCRIPT_JOIN = f"""
WITH tr AS (
  SELECT d.lang || 'Q' || CAST(l.quality + 1 AS VARCHAR) || CAST(d.doc_id AS VARCHAR) AS transcriptID,
         {_sql_text_measures('d.text', TEST_POSITIVE, TEST_NEGATIVE)},
         CASE WHEN d.text IS NULL OR length({_SQL_CLEAN.replace('text', 'd.text')}) = 0 THEN CAST(0.0 AS DOUBLE) END AS SentimentScore
  FROM documents d JOIN labels l ON d.doc_id = l.doc_id),
f AS (SELECT doc_id, lang || 'Q1' || CAST(doc_id AS VARCHAR) AS transcriptID FROM documents)
SELECT f.doc_id, f.transcriptID, tr.TransLength, tr.TotalTokens, tr.PositiveWordCount, tr.NegativeWordCount, tr.SentimentScore
FROM f LEFT JOIN tr ON f.transcriptID IS NOT DISTINCT FROM tr.transcriptID
"""


# -- DQ1 + AGG7 --------------------------------------------------------------
def q_validation(spark, sf):
    li = _t(spark, sf, "lineitem")
    return validate(
        li,
        required=["l_orderkey", "l_shipdate", "l_returnflag"],
        date_cols=["l_shipdate"],
        class_col="l_linenumber",
        allowed=[1, 2, 3, 4, 5, 6],
        key=["l_orderkey", "l_linenumber"],
    )


SQL_VALIDATION = """
WITH c AS (
  SELECT count(*) FILTER (WHERE l_orderkey IS NULL) AS a, count(*) FILTER (WHERE l_shipdate IS NULL) AS b,
         count(*) FILTER (WHERE l_returnflag IS NULL) AS c, 0 AS d,
         count(*) FILTER (WHERE l_linenumber IS NULL OR l_linenumber NOT IN (1,2,3,4,5,6)) AS e
  FROM lineitem),
dup AS (SELECT coalesce(sum(n - 1), 0) AS v FROM (SELECT count(*) AS n FROM lineitem GROUP BY l_orderkey, l_linenumber) WHERE n > 1),
r AS (
  SELECT 'not_null:l_orderkey' AS rule, a AS violations FROM c UNION ALL
  SELECT 'not_null:l_shipdate', b FROM c UNION ALL
  SELECT 'not_null:l_returnflag', c FROM c UNION ALL
  SELECT 'date_parses:l_shipdate', d FROM c UNION ALL
  SELECT 'allowed_values:l_linenumber', e FROM c UNION ALL
  SELECT 'unique:l_orderkey,l_linenumber', v FROM dup)
SELECT rule, CAST(violations AS BIGINT) AS violations, violations = 0 AS passed FROM r
"""


def q_null_counts(spark, sf):
    cols = ["c_custkey", "c_name", "c_nationkey", "c_acctbal", "c_mktsegment"]
    return null_counts(_t(spark, sf, "customer"), cols)


SQL_NULL_COUNTS = """
SELECT count(*) FILTER (WHERE c_custkey IS NULL) AS c_custkey, count(*) FILTER (WHERE c_name IS NULL) AS c_name,
       count(*) FILTER (WHERE c_nationkey IS NULL) AS c_nationkey, count(*) FILTER (WHERE c_acctbal IS NULL) AS c_acctbal,
       count(*) FILTER (WHERE c_mktsegment IS NULL) AS c_mktsegment
FROM customer
"""


# -- AGG6 --------------------------------------------------------------------
def q_duplicate_keys(spark, sf):
    li = _t(spark, sf, "lineitem")
    d = duplicate_keys(li, ["l_orderkey", "l_linenumber"])
    return d.select("l_orderkey", F.col("l_linenumber").cast("bigint").alias("l_linenumber"), F.col("count").alias("n"))


SQL_DUPLICATE_KEYS = """
SELECT l_orderkey, CAST(l_linenumber AS BIGINT) AS l_linenumber, count(*) AS n
FROM lineitem GROUP BY l_orderkey, l_linenumber HAVING count(*) > 1
"""


# -- SRC13 + SCL13 -------------------------------------------------------------
def q_calendar(spark, sf):
    return calendar_for(_t(spark, sf, "lineitem"), "l_shipdate")


SQL_CALENDAR = """
WITH s AS (SELECT CAST(unnest(generate_series(min(l_shipdate), max(l_shipdate), INTERVAL 1 DAY)) AS DATE) AS d FROM lineitem)
SELECT strftime(d, '%Y-%m-%d') AS date, CAST(day(d) AS BIGINT) AS day, CAST(month(d) AS BIGINT) AS month,
       CAST(year(d) AS BIGINT) AS year, CAST(isodow(d) - 1 AS BIGINT) AS day_of_week, dayname(d) AS day_name,
       monthname(d) AS month_name, CAST(week(d) AS BIGINT) AS week, CAST(quarter(d) AS BIGINT) AS quarter,
       isodow(d) >= 6 AS is_weekend
FROM s
"""


# -- SCL1 --------------------------------------------------------------------
def q_cik_pad(spark, sf):
    c = _t(spark, sf, "customer")
    return c.select("c_custkey", pad_cik("c_custkey").alias("cik"), pad_cik(F.concat(F.col("c_custkey").cast("string"), F.lit("0000000"))).alias("cik_long"))


SQL_CIK_PAD = """
SELECT c_custkey,
       CASE WHEN length(CAST(c_custkey AS VARCHAR)) <= 10 THEN lpad(CAST(c_custkey AS VARCHAR), 10, '0') ELSE CAST(c_custkey AS VARCHAR) END AS cik,
       CASE WHEN length(CAST(c_custkey AS VARCHAR) || '0000000') <= 10 THEN lpad(CAST(c_custkey AS VARCHAR) || '0000000', 10, '0')
            ELSE CAST(c_custkey AS VARCHAR) || '0000000' END AS cik_long
FROM customer
"""


# -- SCL10 -------------------------------------------------------------------
def q_file_url(spark, sf):
    o = _t(spark, sf, "orders")
    url = filing_url(pad_cik("o_custkey"), "o_orderpriority", F.concat(F.col("o_orderkey").cast("string"), F.lit(".htm")))
    return o.select("o_orderkey", url.alias("fileURL"))


SQL_FILE_URL = """
SELECT o_orderkey,
       'https://www.sec.gov/Archives/edgar/data/' || lpad(CAST(o_custkey AS VARCHAR), 10, '0') || '/'
       || replace(o_orderpriority, '-', '') || '/' || CAST(o_orderkey AS VARCHAR) || '.htm' AS fileURL
FROM orders
"""


# -- SRC1 pattern: first entry of a JSON object ---------------------------------
def q_json_first_key(spark, sf):
    ev = _t(spark, sf, "events").withColumn("m", F.from_json("props", "map<string,string>"))
    return ev.select("event_id", first_key("m").alias("first_key"), first_value("m").alias("first_value"))


SQL_JSON_FIRST_KEY = """
SELECT event_id, json_keys(props)[1] AS first_key,
       json_extract_string(props, '$."' || json_keys(props)[1] || '"') AS first_value
FROM events
"""


# -- SRC2 / SRC5 pattern: parallel arrays -> rows with position ----------------
def q_zip_explode(spark, sf):
    e = _t(spark, sf, "embeddings")
    rows = explode_parallel(e, ["vec_id"], ["embedding"], pos_col="pos")
    return rows.select("vec_id", F.col("pos").cast("bigint").alias("pos"), F.col("embedding").cast("double").alias("value"))


SQL_ZIP_EXPLODE = """
SELECT vec_id, CAST(generate_subscripts(embedding, 1) - 1 AS BIGINT) AS pos, CAST(unnest(embedding) AS DOUBLE) AS value
FROM embeddings
"""


# -- SCL5 + SCL2 under WIN2 -----------------------------------------------------
def q_month_window(spark, sf):
    o = _t(spark, sf, "orders").select(
        "o_orderkey", F.when(F.col("o_orderstatus") == "P", F.col("o_orderdate")).alias("start")
    )
    li = _t(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_suppkey", "l_returnflag", F.col("l_shipdate").alias("end"))
    j = li.join(o, li["l_orderkey"] == o["o_orderkey"], "inner")
    out = month_window(j, ["l_suppkey", "l_returnflag"], "start", "end", "monthWindow")
    return out.select(
        "l_orderkey", F.col("l_linenumber").cast("bigint").alias("l_linenumber"), "l_suppkey", "l_returnflag",
        days_between("end", "start").cast("bigint").alias("days"), "monthWindow",
    )


SQL_MONTH_WINDOW = """
WITH j AS (
  SELECT l.l_orderkey, l.l_linenumber, l.l_suppkey, l.l_returnflag, l.l_shipdate AS e,
         CASE WHEN o.o_orderstatus = 'P' THEN o.o_orderdate END AS s
  FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey),
g AS (SELECT *, bool_or(s IS NOT NULL) OVER (PARTITION BY l_suppkey, l_returnflag) AS has_start,
             CAST(date_diff('day', CAST(s AS DATE), CAST(e AS DATE)) AS BIGINT) AS days FROM j)
SELECT l_orderkey, CAST(l_linenumber AS BIGINT) AS l_linenumber, l_suppkey, l_returnflag, days,
       CASE WHEN has_start THEN CAST(CASE WHEN days >= 30 THEN days // 30 ELSE 0 END AS BIGINT) END AS monthWindow
FROM g
"""


# -- PRJ4 --------------------------------------------------------------------
def q_list_join(spark, sf):
    li = _t(spark, sf, "lineitem")
    flags = li.groupBy("l_orderkey").agg(F.array_sort(F.collect_set("l_returnflag")).alias("flags"))
    return flags.select("l_orderkey", join_list("flags").alias("flags"))


SQL_LIST_JOIN = """
SELECT l_orderkey, array_to_string(list_sort(list_distinct(list(l_returnflag))), ', ') AS flags
FROM lineitem GROUP BY l_orderkey
"""


# -- SCL17 scoring stage ------------------------------------------------------
def q_softmax_diff(spark, sf):
    e = _t(spark, sf, "embeddings")
    return e.select("vec_id", F.round(softmax_margin("embedding"), 12).alias("score"))


SQL_SOFTMAX_DIFF = """
SELECT vec_id,
       round((exp(CAST(embedding[1] AS DOUBLE) - m) - exp(CAST(embedding[2] AS DOUBLE) - m))
             / list_sum(list_transform(embedding, lambda x: exp(CAST(x AS DOUBLE) - m))), 12) AS score
FROM (SELECT vec_id, embedding, CAST(list_max(embedding) AS DOUBLE) AS m FROM embeddings)
"""


# -- SET1 --------------------------------------------------------------------
def q_union_all(spark, sf):
    c = _t(spark, sf, "customer").select(
        F.col("c_custkey").alias("key"), F.col("c_name").alias("name"), F.col("c_nationkey").cast("bigint").alias("nationkey"),
        F.col("c_acctbal").alias("acctbal"), F.col("c_mktsegment").alias("segment"),
    )
    s = _t(spark, sf, "supplier").select(
        F.col("s_suppkey").alias("key"), F.col("s_name").alias("name"), F.col("s_nationkey").cast("bigint").alias("nationkey"),
        F.col("s_acctbal").alias("acctbal"),
    )
    return union_all_by_name(c, s)


SQL_UNION_ALL = """
SELECT c_custkey AS key, c_name AS name, CAST(c_nationkey AS BIGINT) AS nationkey, c_acctbal AS acctbal, c_mktsegment AS segment FROM customer
UNION ALL
SELECT s_suppkey, s_name, CAST(s_nationkey AS BIGINT), s_acctbal, NULL FROM supplier
"""


# -- SCL3 --------------------------------------------------------------------
def q_date_key(spark, sf):
    ev = _t(spark, sf, "events")
    primary = F.when(F.col("event_type") == "error", F.lit("n/a")).otherwise(_ds("ts"))
    fallback = F.when(F.col("event_type") == "signup", F.lit("")).otherwise(F.lit("2024-02-01"))
    return ev.select("event_id", date_key(primary, fallback).alias("yearMonthDay"))


SQL_DATE_KEY = """
SELECT event_id,
       strftime(coalesce(
         CASE WHEN event_type = 'error' THEN NULL ELSE CAST(ts AS DATE) END,
         CASE WHEN event_type = 'signup' THEN NULL ELSE DATE '2024-02-01' END), '%Y%m%d') AS yearMonthDay
FROM events
"""



# -- FLT1: allow-list as a semi-join against a derived member table ------------
def q_member_filter(spark, sf):
    orders = _t(spark, sf, "orders")
    members = _t(spark, sf, "customer").filter(F.col("c_mktsegment") == "BUILDING")
    kept = keep_members(orders, "o_custkey", members, "c_custkey")
    return kept.select("o_orderkey", "o_custkey", "o_totalprice")


SQL_MEMBER_FILTER = """
SELECT o_orderkey, o_custkey, o_totalprice FROM orders
WHERE o_custkey IN (SELECT c_custkey FROM customer WHERE c_mktsegment = 'BUILDING')
"""


# -- SRC11 + JON6 + FLT6: request grid left-joined to landed replies -----------
# Role mapping: every customer is a ticker; the "reply" for a (customer, year,
# quarter) is built from its orders of that quarter -- a JSON object, or a
# JSON list (no transcript) when any of those orders is still pending ('P').
# The grid's years are those of the orders.


def q_harvest(spark, sf):
    tickers = _t(spark, sf, "customer").select(F.concat(F.lit("C"), F.col("c_custkey").cast("string")).alias("ticker"))
    o = _t(spark, sf, "orders")
    replies = o.groupBy(
        F.concat(F.lit("C"), F.col("o_custkey").cast("string")).alias("ticker"),
        F.year("o_orderdate").alias("year"),
        F.quarter("o_orderdate").alias("quarter"),
    ).agg(
        F.when(F.max(F.col("o_orderstatus") == "P"), F.lit("[]"))
        .otherwise(F.to_json(F.struct(F.max("o_orderpriority").alias("transcript"), _ds(F.max("o_orderdate")).alias("date"))))
        .alias("reply")
    )
    out = harvest_transcripts(tickers, replies, years_of(o, "o_orderdate"))
    return out.select("ticker", F.col("year").cast("bigint").alias("year"), F.col("quarter").cast("bigint").alias("quarter"),
                      "transcriptID", "transcript", "date")


SQL_HARVEST = """
WITH g AS (
  SELECT 'C' || CAST(c_custkey AS VARCHAR) AS ticker, y AS year, q AS quarter
  FROM customer, (SELECT DISTINCT year(o_orderdate) AS y FROM orders WHERE o_orderdate IS NOT NULL), range(1, 5) s(q)),
r AS (
  SELECT 'C' || CAST(o_custkey AS VARCHAR) AS ticker, year(o_orderdate) AS year, quarter(o_orderdate) AS quarter,
         bool_or(o_orderstatus = 'P') AS pending, max(o_orderpriority) AS transcript,
         strftime(max(o_orderdate), '%Y-%m-%d') AS date
  FROM orders GROUP BY 1, 2, 3)
SELECT g.ticker, CAST(g.year AS BIGINT) AS year, CAST(g.quarter AS BIGINT) AS quarter,
       CAST(g.year AS VARCHAR) || '-Q' || CAST(g.quarter AS VARCHAR) || '-' || g.ticker AS transcriptID,
       r.transcript, r.date
FROM g JOIN r ON g.ticker = r.ticker AND g.year = r.year AND g.quarter = r.quarter
WHERE NOT r.pending
"""


# -- SRC10: ticker -> CIK lookup, first match ----------------------------------
def q_cik_lookup(spark, sf):
    c = _t(spark, sf, "customer")
    ticker_list = c.select(F.col("c_custkey").alias("cik_str"), F.col("c_mktsegment").alias("ticker"))
    out = lookup_cik(c.select("c_custkey", F.col("c_mktsegment").alias("ticker")), ticker_list)
    return out.select("c_custkey", "ticker", "cik10D")


SQL_CIK_LOOKUP = """
SELECT c_custkey, c_mktsegment AS ticker,
       lpad(CAST(min(c_custkey) OVER (PARTITION BY c_mktsegment) AS VARCHAR), 10, '0') AS cik10D
FROM customer
"""


# -- PIP1: the whole fact build ------------------------------------------------
# Role mapping: a customer is a company ("C<custkey>"), an order is a filing
# ("A-<orderkey>"), each line item reports two raw tags chosen by its line
# number; the period is the order quarter (Q4 reported as FY; status 'P' has
# no period); the period end is the last day of the previous quarter.  Prices
# are the daily max extended price of a customer's shipped lines.
# Transcripts are documents assigned to a customer, quarter and year.
LINE_TAGS_PRICE = [
    "AssetsCurrent", "Liabilities", "ProfitLoss", "Revenues", "GrossProfit",
    "NetCashProvidedByUsedInOperatingActivities", "CommonStockSharesOutstanding",
]
LINE_TAGS_QUANTITY = [
    "CashAndCashEquivalentsAtCarryingValue", "BasicEarningsLossPerShare", "StockholdersEquity",
    "SalesRevenueNet", "EBITDA", "AssetsNoncurrent", "DeferredRevenue",
]


def _filings_inputs(spark, sf):
    orders = _t(spark, sf, "orders")
    lo = _t(spark, sf, "lineitem").join(orders, F.col("l_orderkey") == F.col("o_orderkey"), "inner")
    ticker = F.concat(F.lit("C"), F.col("o_custkey").cast("string"))
    q = F.quarter("o_orderdate")
    fp = (
        F.when(F.col("o_orderstatus") == "P", F.lit(None).cast("string"))
        .when(q == 4, F.lit("FY"))
        .otherwise(F.concat(F.lit("Q"), q.cast("string")))
    )
    end = F.date_sub(F.trunc("o_orderdate", "quarter"), 1)
    pairs = F.array(
        F.struct(F.element_at(F.array(*map(F.lit, LINE_TAGS_PRICE)), F.col("l_linenumber")).alias("finType"), F.col("l_extendedprice").alias("val")),
        F.struct(F.element_at(F.array(*map(F.lit, LINE_TAGS_QUANTITY)), F.col("l_linenumber")).alias("finType"), F.col("l_quantity").alias("val")),
    )
    facts_long = lo.select(
        ticker.alias("ticker"),
        F.concat(F.lit("A-"), F.col("o_orderkey").cast("string")).alias("accn"),
        fp.alias("fp"),
        _ds("o_orderdate").alias("filed"),
        _ds(end).alias("end"),
        F.lit(None).cast("string").alias("start"),
        F.lit(None).cast("string").alias("frame"),
        F.inline(pairs),
    ).withColumn("yearMonthDay", date_key("end", "start"))
    accession = F.concat(F.lit("A-"), F.col("o_orderkey").cast("string"))
    filings = orders.select(
        accession.alias("accessionNumber"),
        _ds("o_orderdate").alias("filingDate"),
        _ds("o_orderdate").alias("reportDate"),
        F.col("o_orderpriority").alias("form"),
        F.col("o_orderstatus").alias("primaryDocDescription"),
        filing_url(pad_cik("o_custkey"), accession, F.concat(F.col("o_orderkey").cast("string"), F.lit(".htm"))).alias("fileURL"),
    )
    # as in _supplier_prices: nearly one line per company and day
    days = lo.select(ticker.alias("ticker"), F.to_date("l_shipdate").alias("Date"), "l_extendedprice")
    prices = spread(days, "ticker", "Date").groupBy("ticker", "Date").agg(F.max("l_extendedprice").alias("Close"))
    docs = _t(spark, sf, "documents")
    transcripts = docs.select(
        F.concat(F.lit("C"), F.col("doc_id").cast("string")).alias("ticker"),
        (F.col("doc_id") % 4 + 1).alias("quarter"),
        (F.col("doc_id") % 7 + 1995).alias("year"),
        F.col("text").alias("transcript"),
    )
    return facts_long, filings, prices, transcripts


def q_filings_fact(spark, sf):
    fact = build_filings_fact(*_filings_inputs(spark, sf))
    return fact.withColumns({c: _ds(c) for c in ("reportDate", "filingDate", "endDate")}).withColumn(
        "stockPriceChange", F.col("stockPriceChange").cast("bigint")
    )


def _sql_filings_fact() -> str:
    pairs = ", ".join(f"('{child}', '{parent}')" for parent, kids in fixed.TAG_HIERARCHY.items() for child in kids)
    metrics = list(fixed.TAG_HIERARCHY)
    canon = ", ".join(f"'{m}'" for m in metrics)
    pivots = ",\n         ".join(f"max(CASE WHEN fin = '{m}' THEN val END) AS {m}" for m in metrics)
    nulls = " + ".join(f"CAST({m} IS NULL AS INT)" for m in fixed.COUNTED_METRICS)
    flows = fixed.FLOW_METRICS
    leads = ", ".join(f"lead({m}) OVER w AS n_{m}" for m in flows)
    cond = "has_next AND financialPeriod IN ('Q2','Q3','FY') AND n_fp IN ('Q1','Q2','Q3')"
    normed = ",\n         ".join(
        f"CASE WHEN {cond} AND {m} IS NOT NULL AND n_{m} IS NOT NULL THEN {m} - n_{m} ELSE {m} END AS {m}" for m in flows
    )
    stock = [m for m in metrics if m not in flows]
    tags_a = ", ".join(f"'{t}'" for t in LINE_TAGS_PRICE)
    tags_b = ", ".join(f"'{t}'" for t in LINE_TAGS_QUANTITY)
    out_metrics = [m for m in fixed.FACT_COLUMNS if m in metrics]
    return f"""
WITH lo AS (SELECT l.*, o.o_custkey, o.o_orderdate, o.o_orderstatus FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey),
base AS (
  SELECT 'C' || CAST(o_custkey AS VARCHAR) AS ticker, 'A-' || CAST(l_orderkey AS VARCHAR) AS accn,
         CASE WHEN o_orderstatus = 'P' THEN NULL WHEN quarter(o_orderdate) = 4 THEN 'FY' ELSE 'Q' || quarter(o_orderdate) END AS fp,
         CAST(o_orderdate AS DATE) AS filed,
         CAST(CAST(date_trunc('quarter', o_orderdate) AS DATE) - INTERVAL 1 DAY AS DATE) AS end_date,
         l_linenumber, l_extendedprice, l_quantity
  FROM lo),
facts AS (
  SELECT ticker, accn, fp, filed, end_date, [{tags_a}][l_linenumber] AS tag, l_extendedprice AS val FROM base
  UNION ALL
  SELECT ticker, accn, fp, filed, end_date, [{tags_b}][l_linenumber] AS tag, l_quantity AS val FROM base),
m AS (SELECT * FROM (VALUES {pairs}) t(child, parent)),
canon AS (
  SELECT f.*, coalesce(m.parent, f.tag) AS fin FROM facts f LEFT JOIN m ON f.tag = m.child
  WHERE coalesce(m.parent, f.tag) IN ({canon})),
pv AS (
  SELECT ticker, accn AS accessionNumber, coalesce(fp, 'NotAvailable') AS financialPeriod, filed AS filingDate, end_date AS endDate,
         {pivots}
  FROM canon GROUP BY 1, 2, 3, 4, 5),
sparse AS (SELECT * FROM pv WHERE {nulls} < 4),
filings AS (
  SELECT 'A-' || CAST(o_orderkey AS VARCHAR) AS accessionNumber, CAST(o_orderdate AS DATE) AS reportDate,
         o_orderpriority AS form, CAST(o_orderdate AS DATE) AS filingDate,
         o_orderstatus AS primaryDocDescription,
         '{fixed.FILING_URL_BASE}' || lpad(CAST(o_custkey AS VARCHAR), 10, '0') || '/A' || CAST(o_orderkey AS VARCHAR)
           || '/' || CAST(o_orderkey AS VARCHAR) || '.htm' AS fileURL
  FROM orders),
joined AS (
  SELECT f.accessionNumber, f.reportDate, f.form, f.filingDate, f.primaryDocDescription, f.fileURL,
         p.ticker, p.financialPeriod, p.endDate, {", ".join("p." + m for m in metrics)}
  FROM filings f JOIN sparse p ON f.accessionNumber = p.accessionNumber AND f.filingDate = p.filingDate
  WHERE year(p.endDate) = year(f.reportDate)),
nx AS (
  SELECT *, lead(financialPeriod) OVER w AS n_fp, {leads}, lead(1) OVER w IS NOT NULL AS has_next
  FROM joined
  WINDOW w AS (PARTITION BY ticker ORDER BY filingDate DESC, accessionNumber DESC, financialPeriod ASC, filingDate ASC, endDate ASC)),
norm AS (
  SELECT accessionNumber, ticker, reportDate, filingDate, endDate, form,
         CASE WHEN financialPeriod = 'FY' THEN 'Q4' ELSE financialPeriod END AS financialPeriod,
         {", ".join(stock)},
         {normed},
         fileURL
  FROM nx),
prices AS (SELECT 'C' || CAST(o_custkey AS VARCHAR) AS ticker, CAST(l_shipdate AS DATE) AS d, max(l_extendedprice) AS c FROM lo GROUP BY 1, 2),
win AS (SELECT DISTINCT ticker, reportDate FROM norm),
cl AS (
  SELECT w.ticker, w.reportDate, (arg_min(p.c, p.d) - arg_max(p.c, p.d)) * 100 / arg_max(p.c, p.d) AS pct
  FROM win w JOIN prices p ON p.ticker = w.ticker AND p.d >= CAST(w.reportDate - INTERVAL 3 MONTH AS DATE) AND p.d < w.reportDate
  GROUP BY 1, 2),
cls AS (
  SELECT ticker, reportDate,
         CAST(CASE WHEN pct IS NULL OR isnan(pct) THEN NULL
              WHEN pct < -5 THEN 1 WHEN pct < -2 THEN 2 WHEN pct < 0 THEN 3 WHEN pct = 0 THEN 4
              WHEN pct <= 2 THEN 5 WHEN pct <= 5 THEN 6 ELSE 7 END AS BIGINT) AS stockPriceChange
  FROM cl),
fact AS (
  SELECT n.*, c.stockPriceChange, n.ticker || n.financialPeriod || strftime(n.reportDate, '%Y') AS transcriptID
  FROM norm n LEFT JOIN cls c ON n.ticker = c.ticker AND n.reportDate = c.reportDate),
tr AS (
  SELECT 'C' || CAST(doc_id AS VARCHAR) || 'Q' || CAST(doc_id % 4 + 1 AS VARCHAR) || CAST(doc_id % 7 + 1995 AS VARCHAR) AS transcriptID,
         {_sql_text_measures('text', fixed.POSITIVE_WORDS, fixed.NEGATIVE_WORDS)},
         CASE WHEN text IS NULL OR length({_SQL_CLEAN}) = 0 THEN CAST(0.0 AS DOUBLE) END AS SentimentScore
  FROM documents)
SELECT f.accessionNumber, f.ticker, strftime(f.reportDate, '%Y-%m-%d') AS reportDate,
       strftime(f.filingDate, '%Y-%m-%d') AS filingDate, strftime(f.endDate, '%Y-%m-%d') AS endDate,
       f.form, f.financialPeriod, f.stockPriceChange, {", ".join("f." + m for m in out_metrics)}, f.fileURL,
       f.transcriptID, tr.TransLength, tr.TotalTokens, tr.PositiveWordCount, tr.NegativeWordCount, tr.SentimentScore
FROM fact f LEFT JOIN tr ON f.transcriptID IS NOT DISTINCT FROM tr.transcriptID
"""


SQL_FILINGS_FACT = _sql_filings_fact()


# -- SRC9 with SCL8: classes named by the static dimension -----------------------
def q_class_names(spark, sf):
    names = price_change_dimension(spark).select(
        F.col("ID").cast("bigint").alias("stockPriceChange"), F.col("Intensity").alias("intensity"), F.col("Full Category Name").alias("category")
    )
    # The shipped dimension has seven rows.
    return q_classify(spark, sf).join(F.broadcast(names), "stockPriceChange", "left").groupBy("category", "intensity").agg(
        F.count(F.lit(1)).alias("reports"), F.countDistinct("ticker").alias("tickers")
    )


SQL_CLASS_NAMES = f"""
WITH k AS ({SQL_CLASSIFY}), n(id, intensity, category) AS (VALUES
  (1, 'Large', 'Large negative change'), (2, 'Medium', 'Medium negative change'), (3, 'Small', 'Small negative change'), (4, NULL, 'No change'),
  (5, 'Small', 'Small positive change'), (6, 'Medium', 'Medium positive change'), (7, 'Large', 'Large positive change'))
SELECT category, intensity, count(*) AS reports, count(DISTINCT ticker) AS tickers FROM k LEFT JOIN n ON id = "stockPriceChange" GROUP BY ALL
"""


# -- JON2 + FLT4 on two keys -----------------------------------------------------
# A customer's filings share an accession, so the filing date decides.  Lines
# returned ('R') were filed on their ship date, the others with the order.
def q_filing_merge_keys(spark, sf):
    o = _t(spark, sf, "orders")
    filings = o.select(
        F.col("o_custkey").alias("accessionNumber"), F.to_date("o_orderdate").alias("filingDate"), F.col("o_orderkey").alias("filing"),
        F.add_months(F.to_date("o_orderdate"), 1).alias("reportDate"),
    )
    lines = _t(spark, sf, "lineitem").join(o, F.col("l_orderkey") == F.col("o_orderkey"), "inner")
    facts = lines.select(
        F.col("o_custkey").alias("accessionNumber"),
        F.when(F.col("l_returnflag") == "R", F.to_date("l_shipdate")).otherwise(F.to_date("o_orderdate")).alias("filingDate"),
        "l_orderkey", F.col("l_linenumber").cast("bigint").alias("l_linenumber"), F.to_date("l_shipdate").alias("endDate"), "l_quantity",
    )
    m = merge_filings(facts, filings, filing_columns=("accessionNumber", "filingDate", "filing", "reportDate"))
    return m.select("accessionNumber", _ds("filingDate").alias("filingDate"), "filing", "l_orderkey", "l_linenumber", _ds("endDate").alias("endDate"), "l_quantity")


SQL_FILING_MERGE_KEYS = """
WITH f AS (
  SELECT o_custkey AS a, CAST(CASE WHEN l_returnflag = 'R' THEN l_shipdate ELSE o_orderdate END AS DATE) AS d, l_orderkey, l_linenumber, l_shipdate, l_quantity
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey)
SELECT o_custkey AS "accessionNumber", strftime(d, '%Y-%m-%d') AS "filingDate", o_orderkey AS filing, l_orderkey, CAST(l_linenumber AS BIGINT) AS l_linenumber,
       strftime(l_shipdate, '%Y-%m-%d') AS "endDate", l_quantity
FROM orders JOIN f ON o_custkey = a AND CAST(o_orderdate AS DATE) = d
WHERE year(l_shipdate) = year(CAST(o_orderdate AS DATE) + INTERVAL 1 MONTH)
"""


# -- AGG7, FLT5, AGG5 on columns that do have nulls --------------------------------
def q_pivot_nulls(spark, sf):
    return null_counts(_event_pivot(spark, sf), EVENT_TYPES)


SQL_PIVOT_NULLS = f"""
SELECT {", ".join(f"count(*) FILTER (WHERE {c} IS NULL) AS {c}" for c in EVENT_TYPES)} FROM ({SQL_EVENT_PIVOT}) p
"""


def q_null_rows(spark, sf):
    rows = rows_with_nulls(_event_pivot(spark, sf), ["click", "purchase"])
    flags = rows.select("user_id", F.col("click").isNull().alias("no_click"), F.col("purchase").isNull().alias("no_purchase"), F.col("view").isNull().alias("no_view"))
    return distinct_rows(flags)


SQL_NULL_ROWS = f"""
SELECT DISTINCT user_id, click IS NULL AS no_click, purchase IS NULL AS no_purchase, view IS NULL AS no_view
FROM ({SQL_EVENT_PIVOT}) p WHERE click IS NULL OR purchase IS NULL
"""


CATALOG: dict[str, tuple[Query, str | None]] = {
    "tag_rollup": (q_tag_rollup, SQL_TAG_ROLLUP),
    "canonical_tags": (q_canonical_tags, SQL_CANONICAL_TAGS),
    "pivot_max": (q_pivot_max, SQL_EVENT_PIVOT),
    "missing_lt": (q_missing_lt, SQL_MISSING_LT),
    "missing_flags": (q_missing_flags, SQL_MISSING_FLAGS),
    "filing_merge": (q_filing_merge, SQL_FILING_MERGE),
    "decumulate": (q_decumulate, SQL_DECUMULATE),
    "price_window": (q_price_window, SQL_PRICE_WINDOW),
    "classify": (q_classify, SQL_CLASSIFY),
    "period_means": (q_period_means, SQL_PERIOD_MEANS),
    "price_profile": (q_price_profile, SQL_PRICE_PROFILE),
    "text_stats": (q_text_stats, SQL_TEXT_STATS),
    "transcript_join": (q_transcript_join, SQL_TRANSCRIPT_JOIN),
    "validation": (q_validation, SQL_VALIDATION),
    "null_counts": (q_null_counts, SQL_NULL_COUNTS),
    "duplicate_keys": (q_duplicate_keys, SQL_DUPLICATE_KEYS),
    "calendar": (q_calendar, SQL_CALENDAR),
    "cik_pad": (q_cik_pad, SQL_CIK_PAD),
    "file_url": (q_file_url, SQL_FILE_URL),
    "json_first_key": (q_json_first_key, SQL_JSON_FIRST_KEY),
    "zip_explode": (q_zip_explode, SQL_ZIP_EXPLODE),
    "month_window": (q_month_window, SQL_MONTH_WINDOW),
    "list_join": (q_list_join, SQL_LIST_JOIN),
    "softmax_diff": (q_softmax_diff, SQL_SOFTMAX_DIFF),
    "union_all": (q_union_all, SQL_UNION_ALL),
    "date_key": (q_date_key, SQL_DATE_KEY),
    "filings_fact": (q_filings_fact, SQL_FILINGS_FACT),
    "member_filter": (q_member_filter, SQL_MEMBER_FILTER),
    "harvest": (q_harvest, SQL_HARVEST),
    "cik_lookup": (q_cik_lookup, SQL_CIK_LOOKUP),
    "decumulate_lists": (q_decumulate_lists, SQL_DECUMULATE_LISTS),
    "class_names": (q_class_names, SQL_CLASS_NAMES),
    "filing_merge_keys": (q_filing_merge_keys, SQL_FILING_MERGE_KEYS),
    "pivot_nulls": (q_pivot_nulls, SQL_PIVOT_NULLS),
    "null_rows": (q_null_rows, SQL_NULL_ROWS),
}
CATALOG |= CATALOG_SOURCES
