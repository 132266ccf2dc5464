"""Registered queries of the sources and dimensions, with their oracles.

Landed documents are built from the driver's tables inside the plan, turned
into text (JSON, CSV lines) and read back by the library's own readers, so the
queries exercise the whole path and their work grows with the tables.  The
oracles state the rows directly, without documents.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerlake import fixed
from ledgerlake.plans.dims import company_dimension, industry_dimension
from ledgerlake.plans.tables import date_text, table
from ledgerlake.session import spread
from ledgerlake.sources.files import constituents_from_lines, lookup_cik, select_prices
from ledgerlake.sources.filings_json import (
    CHART_SCHEMA,
    COMPANY_FACTS_SCHEMA,
    LANDED_TIE,
    LANDED_TIME,
    SUBMISSIONS_SCHEMA,
    chart_rows,
    company_facts_rows,
    filings_rows,
    parse_json_documents,
    ticker_list_rows,
)

# -- SRC1 + JON1: company facts, from nested map documents ----------------------
# A document is an order; its tags are its line numbers.  Each tag has a map of
# units: 'USD' (two values a line) and 'shares' (one); lines returned ('R')
# name 'shares' first.  A tag all of whose lines lack a discount names an empty
# unit first, so it has no rows.  (order, line number) repeats: the repeated
# lines are the records of one tag.


def facts_documents(spark, sf) -> DataFrame:
    """(ticker, doc): one company-facts document per order, as JSON text.

    Plain lines are dealt by order once, in partitions whose records and tags
    fit in memory; both aggregates follow without a shuffle of records."""
    li = spread(table(spark, sf, "lineitem"), "l_orderkey")
    o = table(spark, sf, "orders").select("o_orderkey", "o_orderdate", "o_orderstatus")
    j = li.join(o, F.col("l_orderkey") == F.col("o_orderkey"), "inner")

    def record(val, start, fp):
        return F.struct(
            start.alias("start"), date_text("l_shipdate").alias("end"), val.alias("val"),
            F.concat(F.lit("A-"), F.col("o_orderkey").cast("string")).alias("accn"), F.year("o_orderdate").alias("fy"), fp.alias("fp"),
            F.lit("10-Q").alias("form"), date_text("o_orderdate").alias("filed"), F.lit(None).cast("string").alias("frame"),
        )

    fp = F.concat(F.lit("Q"), F.quarter("o_orderdate").cast("string"))
    none = F.lit(None).cast("string")
    start = F.when(F.col("l_linestatus") == "F", date_text("o_orderdate"))
    usd = F.flatten(F.collect_list(F.array(record(F.col("l_extendedprice"), start, fp), record(F.col("l_tax"), none, F.lit("FY")))))
    shares = F.collect_list(record(F.col("l_quantity"), start, fp))
    tags = j.groupBy("l_orderkey", "l_linenumber").agg(
        usd.alias("usd"), shares.alias("shares"), F.max(F.col("l_returnflag") == "R").alias("returned"), F.max("l_discount").alias("discount")
    )
    empty = F.filter("shares", lambda _x: F.lit(False))
    units = F.map_from_arrays(
        F.when(F.col("discount") == 0, F.array(F.lit("pure"), F.lit("USD"), F.lit("shares")))
        .when(F.col("returned"), F.array(F.lit("shares"), F.lit("USD"), F.lit("pure")))
        .otherwise(F.array(F.lit("USD"), F.lit("shares"), F.lit("pure"))),
        F.when(F.col("discount") == 0, F.array(empty, F.col("usd"), F.col("shares")))
        .when(F.col("returned"), F.array(F.col("shares"), F.col("usd"), empty))
        .otherwise(F.array(F.col("usd"), F.col("shares"), empty)),
    )
    line = F.col("l_linenumber").cast("string")
    entry = F.struct(
        F.concat(F.lit("Line"), line).alias("name"),
        F.struct(F.concat(F.lit("Label "), line).alias("label"), F.concat(F.lit("Values of line "), line).alias("description"), units.alias("units")).alias("tag"),
    )
    docs = tags.groupBy("l_orderkey").agg(F.map_from_entries(F.collect_list(entry)).alias("gaap"))
    facts = F.struct(F.col("l_orderkey").alias("cik"), F.lit("X").alias("entityName"), F.struct(F.col("gaap").alias("us-gaap")).alias("facts"))
    return docs.select(F.concat(F.lit("O"), F.col("l_orderkey").cast("string")).alias("ticker"), F.to_json(facts).alias("doc"))


def q_company_facts(spark, sf):
    docs = parse_json_documents(facts_documents(spark, sf), "doc", COMPANY_FACTS_SCHEMA, ["ticker"])
    return company_facts_rows(docs)


SQL_COMPANY_FACTS = """
WITH j AS (
  SELECT l.*, o.o_orderdate, o.o_orderkey, bool_or(l_returnflag = 'R') OVER g AS returned, max(l_discount) OVER g AS discount,
         bool_or(l_linestatus = 'F') OVER g AS has_start
  FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey
  WINDOW g AS (PARTITION BY l_orderkey, l_linenumber)
), r AS (
  SELECT j.*, l_quantity AS val, true AS first_value, 'Q' || quarter(o_orderdate) AS fp FROM j WHERE discount <> 0 AND returned
  UNION ALL SELECT j.*, l_extendedprice, true, 'Q' || quarter(o_orderdate) FROM j WHERE discount <> 0 AND NOT returned
  UNION ALL SELECT j.*, l_tax, false, 'FY' FROM j WHERE discount <> 0 AND NOT returned
), s AS (
  SELECT *, CASE WHEN first_value AND l_linestatus = 'F' THEN CAST(o_orderdate AS DATE) END AS st, CAST(l_shipdate AS DATE) AS en FROM r
)
SELECT 'Line' || l_linenumber AS "finType", 'Label ' || l_linenumber AS label, 'Values of line ' || l_linenumber AS description,
       strftime(en, '%Y-%m-%d') AS "end", val, 'A-' || o_orderkey AS accn, fp, '10-Q' AS form, strftime(o_orderdate, '%Y-%m-%d') AS filed,
       CAST(NULL AS VARCHAR) AS frame, strftime(st, '%Y-%m-%d') AS start,
       CASE WHEN has_start THEN CAST(CASE WHEN en - st >= 30 THEN (en - st) // 30 ELSE 0 END AS BIGINT) END AS "monthWindow",
       strftime(en, '%Y%m%d') AS "yearMonthDay", 'O' || o_orderkey AS ticker
FROM s
"""

# -- SRC2 (+ SCL10, SCL3): filings from parallel arrays -------------------------
# A document is the filings of a customer in a year, newest first.  The array
# of descriptions leaves out pending orders, so those documents are misaligned;
# finished orders have no report date, so their key falls back on the filing
# date.


def submission_documents(spark, sf) -> DataFrame:
    o = table(spark, sf, "orders")
    entry = F.struct(
        F.unix_micros(F.col("o_orderdate").cast("timestamp")).alias("at"), F.col("o_orderkey").alias("key"), date_text("o_orderdate").alias("day"),
        F.col("o_orderstatus").alias("status"), F.col("o_orderpriority").alias("priority"), F.col("o_totalprice").alias("price"),
    )
    docs = o.groupBy("o_custkey", F.year("o_orderdate").alias("year")).agg(F.reverse(F.array_sort(F.collect_list(entry))).alias("f"))
    accession = F.transform("f", lambda x: F.concat_ws("-", F.lit("A"), F.lpad(x["key"].cast("string"), 10, "0"), F.lit("x")))
    recent = F.struct(
        accession.alias("accessionNumber"),
        F.transform("f", lambda x: x["day"]).alias("filingDate"),
        F.transform("f", lambda x: F.when(x["status"] == "F", "").otherwise(x["day"])).alias("reportDate"),
        F.transform("f", lambda x: x["priority"]).alias("form"),
        F.transform("f", lambda x: F.concat(x["key"].cast("string"), F.lit(".htm"))).alias("primaryDocument"),
        F.transform(F.filter("f", lambda x: x["status"] != "P"), lambda x: x["status"]).alias("primaryDocDescription"),
        F.transform("f", lambda x: F.floor(x["price"]).cast("bigint")).alias("size"),
    )
    doc = F.struct(F.col("o_custkey").cast("string").alias("cik"), F.struct(recent.alias("recent")).alias("filings"))
    return docs.select(F.concat(F.lit("C"), F.col("o_custkey").cast("string")).alias("ticker"), F.to_json(doc).alias("doc"))


def q_filings_rows(spark, sf):
    docs = parse_json_documents(submission_documents(spark, sf), "doc", SUBMISSIONS_SCHEMA, ["ticker"])
    rows = filings_rows(docs, on_mismatch="pad", flag_col="aligned")
    return rows.select(
        "accessionNumber", "filingDate", "reportDate", "form", "items", "size", "primaryDocument", "primaryDocDescription", "fileURL",
        "yearMonthDay", "ticker", F.col("filing_pos").cast("bigint").alias("filing_pos"), "aligned",
    )


SQL_FILINGS_ROWS = f"""
WITH o AS (
  SELECT *, year(o_orderdate) AS y, row_number() OVER w - 1 AS pos, bool_or(o_orderstatus = 'P') OVER (PARTITION BY o_custkey, year(o_orderdate)) AS short
  FROM orders WINDOW w AS (PARTITION BY o_custkey, year(o_orderdate) ORDER BY o_orderdate DESC, o_orderkey DESC)
), d AS (
  SELECT o_custkey, y, o_orderstatus AS status, row_number() OVER (PARTITION BY o_custkey, y ORDER BY o_orderdate DESC, o_orderkey DESC) - 1 AS pos
  FROM o WHERE o_orderstatus <> 'P'
)
SELECT 'A-' || lpad(CAST(o_orderkey AS VARCHAR), 10, '0') || '-x' AS "accessionNumber", strftime(o_orderdate, '%Y-%m-%d') AS "filingDate",
       CASE WHEN o_orderstatus = 'F' THEN '' ELSE strftime(o_orderdate, '%Y-%m-%d') END AS "reportDate", o_orderpriority AS form,
       CAST(NULL AS VARCHAR) AS items, CAST(floor(o_totalprice) AS BIGINT) AS size, o_orderkey || '.htm' AS "primaryDocument",
       d.status AS "primaryDocDescription",
       '{fixed.FILING_URL_BASE}' || lpad(CAST(o_custkey AS VARCHAR), 10, '0') || '/A' || lpad(CAST(o_orderkey AS VARCHAR), 10, '0') || 'x/' || o_orderkey || '.htm' AS "fileURL",
       strftime(o_orderdate, '%Y%m%d') AS "yearMonthDay", 'C' || o_custkey AS ticker, CAST(pos AS BIGINT) AS filing_pos, NOT short AS aligned
FROM o LEFT JOIN d USING (o_custkey, y, pos)
"""

# -- SRC5 + SCL14: price charts ---------------------------------------------------
# A document is a supplier's month of daily bars, stamped at 23:30 in New York
# (the next day in UTC).  Bars without a line accepted ('A') have a null close;
# a month without any has no series at all.

CHART_ZONE = "America/New_York"


def chart_documents(spark, sf) -> DataFrame:
    day = F.to_date("l_shipdate")
    bars = table(spark, sf, "lineitem").groupBy("l_suppkey", day.alias("day")).agg(
        F.max(F.when(F.col("l_returnflag") == "A", F.col("l_extendedprice"))).alias("close")
    )
    local = F.col("day").cast("timestamp_ntz") + F.expr("INTERVAL '23:30' HOUR TO MINUTE")
    utc = F.convert_timezone(F.lit(CHART_ZONE), F.lit("UTC"), local)
    seconds = F.floor(F.expr("timestampdiff(SECOND, TIMESTAMP_NTZ'1970-01-01 00:00:00', utc)")).cast("bigint")
    bars = bars.withColumn("utc", utc).withColumn("at", seconds)
    docs = bars.groupBy("l_suppkey", F.trunc("day", "month").alias("month")).agg(
        F.array_sort(F.collect_list(F.struct("at", "close"))).alias("b"), F.count("close").alias("closes")
    )
    series = F.array(F.struct(F.transform("b", lambda x: x["close"]).alias("adjclose")))
    kind = T.ArrayType(T.StructType([T.StructField("adjclose", T.ArrayType(T.DoubleType()))]))
    indicators = F.struct(F.when(F.col("closes") > 0, series).otherwise(F.lit(None).cast(kind)).alias("adjclose"))
    result = F.struct(F.transform("b", lambda x: x["at"]).alias("timestamp"), indicators.alias("indicators"))
    doc = F.struct(F.struct(F.array(result).alias("result")).alias("chart"))
    return docs.select(
        F.concat(F.lit("S"), F.col("l_suppkey").cast("string")).alias("ticker"), F.to_json(doc, {"ignoreNullFields": "true"}).alias("doc")
    )


def q_chart_rows(spark, sf):
    docs = parse_json_documents(chart_documents(spark, sf), "doc", CHART_SCHEMA, ["ticker"])
    return chart_rows(docs, zone=CHART_ZONE)


SQL_CHART_ROWS = """
SELECT max(CASE WHEN l_returnflag = 'A' THEN l_extendedprice END) AS "adjClose", strftime(l_shipdate, '%Y-%m-%d') AS date, 'S' || l_suppkey AS ticker
FROM lineitem GROUP BY l_suppkey, strftime(l_shipdate, '%Y-%m-%d')
"""

# -- SRC3: ticker list; SRC10: first match by list position ------------------------
# The list comes in pages of 1,000 customers; a page is an object of objects.
# The market segment is the ticker, so tickers repeat, and the order in the
# list (page, then position) decides: it runs by falling account balance, not by key.

LIST_PAGE = 1000


def list_pages(spark, sf) -> DataFrame:
    c = table(spark, sf, "customer")
    entry = F.struct(
        (-F.col("c_acctbal")).alias("o"), F.col("c_custkey").alias("k"), F.col("c_mktsegment").alias("t"), F.col("c_name").alias("n")
    )
    pages = c.groupBy(F.floor(F.col("c_custkey") / LIST_PAGE).cast("bigint").alias("page")).agg(F.array_sort(F.collect_list(entry)).alias("e"))
    keys = F.transform("e", lambda _x, i: i.cast("string"))
    values = F.transform("e", lambda x: F.struct(x["k"].alias("cik_str"), x["t"].alias("ticker"), x["n"].alias("title")))
    return pages.select("page", F.to_json(F.map_from_arrays(keys, values)).alias("doc"))


def q_ticker_list(spark, sf):
    rows = ticker_list_rows(list_pages(spark, sf), "doc", ["page"])
    return rows.withColumn("list_pos", F.col("list_pos").cast("bigint"))


SQL_TICKER_LIST = f"""
SELECT c_custkey // {LIST_PAGE} AS page, c_custkey AS cik_str, c_mktsegment AS ticker, c_name AS title, lpad(CAST(c_custkey AS VARCHAR), 10, '0') AS "cik10D",
       CAST(row_number() OVER (PARTITION BY c_custkey // {LIST_PAGE} ORDER BY c_acctbal DESC, c_custkey) - 1 AS BIGINT) AS list_pos
FROM customer
"""


def q_cik_first_match(spark, sf):
    listed = ticker_list_rows(list_pages(spark, sf), "doc", ["page"])
    listed = listed.withColumn("list_pos", F.col("page") * LIST_PAGE + F.col("list_pos"))
    asked = table(spark, sf, "customer").select("c_custkey", "c_acctbal", F.col("c_mktsegment").alias("ticker"))
    unlisted = asked.withColumn("ticker", F.when(F.col("c_acctbal") < 0, F.lower("ticker")).otherwise(F.col("ticker")))
    return lookup_cik(unlisted, listed).select("c_custkey", "ticker", "cik10D")


SQL_CIK_FIRST_MATCH = f"""
WITH f AS (SELECT c_mktsegment AS t, first(c_custkey ORDER BY c_custkey // {LIST_PAGE}, c_acctbal DESC, c_custkey) AS k FROM customer GROUP BY 1
), q AS (SELECT c_custkey, CASE WHEN c_acctbal < 0 THEN lower(c_mktsegment) ELSE c_mktsegment END AS ticker FROM customer)
SELECT c_custkey, ticker, lpad(CAST(k AS VARCHAR), 10, '0') AS "cik10D" FROM q LEFT JOIN f ON ticker = t
"""

# -- SRC7 + PRJ1 + SCL1: constituents from CSV lines -------------------------------
CONSTITUENT_HEADER = ["Symbol", " Security", "GICS Sector", "GICS-Sector", "Headquarters Location ", "CIK"]


def _quoted(c) -> F.Column:
    return F.concat(F.lit('"'), F.replace(c, F.lit('"'), F.lit('""')), F.lit('"'))


def constituent_lines(spark, sf) -> DataFrame:
    c, n = table(spark, sf, "customer"), table(spark, sf, "nation")
    j = c.join(F.broadcast(n), F.col("c_nationkey") == F.col("n_nationkey"), "left")
    security = F.concat(F.col("c_name"), F.lit(', "'), F.col("c_mktsegment"), F.lit('"'))
    cells = [
        F.concat(F.lit("C"), F.col("c_custkey").cast("string")), _quoted(security), F.col("c_mktsegment"),
        F.floor(F.col("c_acctbal")).cast("bigint").cast("string"), _quoted(F.coalesce(F.col("n_name"), F.lit("?"))), F.col("c_custkey").cast("string"),
    ]
    return j.select(F.concat_ws(",", *cells).alias("value"))


def q_constituents(spark, sf):
    return constituents_from_lines(constituent_lines(spark, sf), CONSTITUENT_HEADER, on_collision="number")


SQL_CONSTITUENTS = """
SELECT 'C' || c_custkey AS "Symbol", c_name || ', "' || c_mktsegment || '"' AS "Security", c_mktsegment AS "GICS_Sector",
       CAST(CAST(floor(c_acctbal) AS BIGINT) AS VARCHAR) AS "GICS_Sector_2", coalesce(n_name, '?') AS "Headquarters_Location",
       lpad(CAST(c_custkey AS VARCHAR), 10, '0') AS "CIK"
FROM customer LEFT JOIN nation ON c_nationkey = n_nationkey
"""

# -- PIP4: industry and company dimensions ------------------------------------------
# Members are the customers with an urgent order.  Every order of a customer
# lands a version of its description; the newest one counts.


def _members(spark, sf) -> DataFrame:
    o = table(spark, sf, "orders").filter(F.col("o_orderpriority") == "1-URGENT")
    return o.select(F.concat(F.lit("C"), F.col("o_custkey").cast("string")).alias("ticker"))


def q_industry_dim(spark, sf):
    return industry_dimension(q_constituents(spark, sf), _members(spark, sf))


SQL_INDUSTRY_DIM = f"""
SELECT * FROM ({SQL_CONSTITUENTS}) WHERE "Symbol" IN (SELECT 'C' || o_custkey FROM orders WHERE o_orderpriority = '1-URGENT')
"""


def landed_descriptions(spark, sf) -> DataFrame:
    """Descriptions of companies as landed: one document per order."""
    o = table(spark, sf, "orders")
    doc = F.struct(
        F.col("o_custkey").cast("string").alias("cik"), F.lit("operating").alias("entityType"), F.col("o_orderpriority").alias("sicDescription"),
        F.concat(F.lit("C"), F.col("o_custkey").cast("string")).alias("name"),
        F.array(F.concat(F.lit("C"), F.col("o_custkey").cast("string")), F.col("o_orderstatus")).alias("tickers"),
        F.array(F.lit("X"), F.when(F.col("o_orderstatus") == "F", F.lit("Y"))).alias("exchanges"),
        date_text("o_orderdate").alias("fiscalYearEnd"),
    )
    landed = o.select(F.to_json(doc, {"ignoreNullFields": "false"}).alias("doc"), F.col("o_orderdate").cast("timestamp").alias(LANDED_TIME), F.col("o_orderkey").alias(LANDED_TIE))
    return parse_json_documents(landed, "doc", SUBMISSIONS_SCHEMA, [LANDED_TIME, LANDED_TIE])


def q_company_dim(spark, sf):
    return company_dimension(landed_descriptions(spark, sf), q_constituents(spark, sf), _members(spark, sf))


SQL_COMPANY_DIM = """
WITH v AS (
  SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey DESC) AS r FROM orders
  WHERE o_custkey IN (SELECT o_custkey FROM orders WHERE o_orderpriority = '1-URGENT') AND o_custkey IN (SELECT c_custkey FROM customer)
)
SELECT CAST(o_custkey AS VARCHAR) AS cik, 'operating' AS "entityType", o_orderpriority AS "sicDescription", CAST(NULL AS VARCHAR) AS "ownerOrg",
       'C' || o_custkey AS name, 'C' || o_custkey || ', ' || o_orderstatus AS tickers, CASE WHEN o_orderstatus = 'F' THEN 'X, Y' ELSE 'X, None' END AS exchanges,
       CAST(NULL AS VARCHAR) AS description, CAST(NULL AS VARCHAR) AS website, CAST(NULL AS VARCHAR) AS "investorWebsite", CAST(NULL AS VARCHAR) AS category,
       strftime(o_orderdate, '%Y-%m-%d') AS "fiscalYearEnd", CAST(NULL AS VARCHAR) AS "stateOfIncorporation"
FROM v WHERE r = 1
"""

# -- SRC6 + SCL15: price reads by ticker and range -----------------------------------
# Bars are a supplier's daily maximum; tickers are the suppliers of nation 3 and 7.
PRICE_TODAY, PRICE_YEARS = "1998-06-30", 2


def _bars(spark, sf) -> DataFrame:
    li = table(spark, sf, "lineitem")
    return li.groupBy(F.concat(F.lit("S"), F.col("l_suppkey").cast("string")).alias("ticker"), F.to_date("l_shipdate").alias("Date")).agg(
        F.max("l_extendedprice").alias("Close")
    )


def q_price_reads(spark, sf):
    members = table(spark, sf, "supplier").filter(F.col("s_nationkey").isin(3, 7))
    members = members.select(F.concat(F.lit("S"), F.col("s_suppkey").cast("string")).alias("ticker"))
    recent = select_prices(_bars(spark, sf), members, years=PRICE_YEARS, today=PRICE_TODAY).withColumn("read", F.lit("years"))
    spring = select_prices(_bars(spark, sf), members, start="1996-02-29", end="1996-05-31").withColumn("read", F.lit("range"))
    return recent.unionByName(spring).withColumn("Date", F.col("Date").cast("string"))


SQL_PRICE_READS = f"""
WITH b AS (SELECT 'S' || l_suppkey AS ticker, CAST(l_shipdate AS DATE) AS d, max(l_extendedprice) AS c FROM lineitem
  WHERE l_suppkey IN (SELECT s_suppkey FROM supplier WHERE s_nationkey IN (3, 7)) GROUP BY ALL)
SELECT ticker, strftime(d, '%Y-%m-%d') AS "Date", c AS "Close", 'years' AS read FROM b
WHERE d >= DATE '{PRICE_TODAY}' - {366 * PRICE_YEARS} AND d < DATE '{PRICE_TODAY}'
UNION ALL SELECT ticker, strftime(d, '%Y-%m-%d'), c, 'range' FROM b WHERE d >= DATE '1996-02-29' AND d < DATE '1996-05-31'
"""

CATALOG_SOURCES = {
    "company_facts": (q_company_facts, SQL_COMPANY_FACTS),
    "filings_rows": (q_filings_rows, SQL_FILINGS_ROWS),
    "chart_rows": (q_chart_rows, SQL_CHART_ROWS),
    "ticker_list": (q_ticker_list, SQL_TICKER_LIST),
    "cik_first_match": (q_cik_first_match, SQL_CIK_FIRST_MATCH),
    "constituents": (q_constituents, SQL_CONSTITUENTS),
    "industry_dim": (q_industry_dim, SQL_INDUSTRY_DIM),
    "company_dim": (q_company_dim, SQL_COMPANY_DIM),
    "price_reads": (q_price_reads, SQL_PRICE_READS),
}
