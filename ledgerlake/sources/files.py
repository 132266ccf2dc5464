"""File sources: CSV landing files, price tables, transcript replies
(SRC6-SRC12).  Explicit schemas, no inference."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerlake import fixed
from ledgerlake.functions.scalars import default_range, minus_months, pad_cik
from ledgerlake.operators.joins import null_safe_join, request_grid
from ledgerlake.operators.projections import clean_column_names, clean_names, drop_incomplete, keep_members

TRANSCRIPT_FIELDS = [
    T.StructField("year", T.IntegerType()),
    T.StructField("quarter", T.IntegerType()),
    T.StructField("transcriptID", T.StringType()),
    T.StructField("transcript", T.StringType()),
    T.StructField("date", T.StringType()),
]
TRANSCRIPT_SCHEMA_FLAT = T.StructType([T.StructField("ticker", T.StringType()), *TRANSCRIPT_FIELDS])
PRICE_CHANGE_DIM_SCHEMA = T.StructType(
    [
        T.StructField("ID", T.IntegerType()),
        T.StructField("Change Direction", T.StringType()),
        T.StructField("Intensity", T.StringType()),
        T.StructField("Full Category Name", T.StringType()),
        T.StructField("Percentage Change Range (%)", T.StringType()),
    ]
)
PRICE_BARS_SCHEMA = T.StructType(
    [
        T.StructField("Date", T.DateType()),
        T.StructField("Open", T.DoubleType()),
        T.StructField("High", T.DoubleType()),
        T.StructField("Low", T.DoubleType()),
        T.StructField("Close", T.DoubleType()),
        T.StructField("Volume", T.LongType()),
        T.StructField("ticker", T.StringType()),
    ]
)


# SRC8 -----------------------------------------------------------------------
#: A transcript file has these columns; the ticker may also be a folder name.
TRANSCRIPT_NEEDED = [f.name for f in TRANSCRIPT_FIELDS]


def _records(text: Column) -> Column:
    """The records of a CSV text as arrays of lines' text: line ends outside
    quotes separate records.  Every second piece between quotes is quoted text
    (a doubled quote ends and begins one), so only the others are cut."""
    safe = F.replace(F.replace(text, F.lit("\x1f"), F.lit("\x1f0")), F.lit("\x1e"), F.lit("\x1f1"))
    pieces = F.split(safe, '"', -1)
    cut = F.transform(pieces, lambda p, i: F.when(i % 2 == 0, F.regexp_replace(p, r"\r?\n", "\x1e")).otherwise(p))
    return F.filter(F.split(F.array_join(cut, '"'), "\x1e", -1), lambda r: F.length(r) > 0)


def _cells(record: Column) -> Column:
    """The cells of a record: text between commas outside quotes, unquoted."""
    pieces = F.split(record, '"', -1)
    cut = F.transform(pieces, lambda p, i: F.when(i % 2 == 0, F.replace(p, F.lit(","), F.lit("\x1e"))).otherwise(p))
    cells = F.split(F.array_join(cut, '"'), "\x1e", -1)

    def bare(c: Column) -> Column:
        quoted = F.length(c) >= 2
        quoted = quoted & c.startswith('"') & c.endswith('"')
        inner = F.replace(F.substring(c, F.lit(2), F.length(c) - 2), F.lit('""'), F.lit('"'))
        plain = F.when(quoted, inner).otherwise(c)
        return F.replace(F.replace(plain, F.lit("\x1f1"), F.lit("\x1e")), F.lit("\x1f0"), F.lit("\x1f"))

    return F.transform(cells, lambda c: F.when(c == "", F.lit(None).cast("string")).otherwise(bare(c)))


def scan_transcripts(spark: SparkSession, path: str) -> DataFrame:
    """SRC8, one scan with two results: every transcript CSV under ``path``,
    by header name, plus ``source_file`` and ``problem``.

    A good file gives its rows, with a null ``problem``.  A bad file gives one
    row that holds only its name and the problem: no header, a missing column,
    an unclosed quote, a record with more cells than the header, or a year or
    quarter that is no number.  ``good_transcripts`` and ``bad_files`` split
    the two.

    A file is one row of the scan, so its header is at hand where its records
    are cut: no join by file, no shuffle under the text, and no Python.  Files
    may differ in column order and in extra columns; empty cells are null.  A
    file of no bytes at all is left out by Spark's reader.
    """
    files = (
        spark.read.text(path, wholetext=True, recursiveFileLookup=True, pathGlobFilter="*.csv")
        .select(F.col("_metadata.file_path").alias("_file"), F.regexp_replace("value", "^\ufeff", "").alias("_text"))
    )
    open_quote = (F.length("_text") - F.length(F.replace(F.col("_text"), F.lit('"'), F.lit("")))) % 2 == 1
    parsed = files.select("_file", open_quote.alias("_open"), F.transform(_records(F.col("_text")), _cells).alias("_rows"))
    names = F.transform(F.coalesce(F.get("_rows", F.lit(0)), F.array()), lambda c: F.trim(F.coalesce(c, F.lit(""))))
    parsed = parsed.select("_file", "_open", names.alias("_names"), F.expr("slice(_rows, 2, greatest(size(_rows) - 1, 0))").alias("_rows"))

    def cell(name: str, row: Column) -> Column:
        return F.get(row, F.nullif(F.array_position("_names", name).cast("int"), F.lit(0)) - 1)

    needed = F.array(*[F.lit(n) for n in TRANSCRIPT_NEEDED])
    missing = F.array_except(needed, "_names")
    numbers = [f.name for f in TRANSCRIPT_FIELDS if isinstance(f.dataType, T.IntegerType)]

    def no_number(row: Column) -> Column:
        wrong = F.lit(False)
        for n in numbers:
            wrong = wrong | (cell(n, row).isNotNull() & cell(n, row).try_cast("int").isNull())
        return wrong

    problem = (
        F.when(F.col("_open"), F.lit("unclosed quote"))
        .when(F.size(missing) == len(TRANSCRIPT_NEEDED), F.lit("no transcript header"))
        .when(F.size(missing) > 0, F.concat(F.lit("missing columns: "), F.array_join(missing, ", ")))
        .when(F.exists("_rows", lambda r: F.size(r) > F.size("_names")), F.lit("more cells than the header"))
        .when(F.exists("_rows", no_number), F.lit("year or quarter is no number"))
    )
    folder = F.nullif(F.regexp_extract("_file", r"ticker=([^/]+)/", 1), F.lit(""))
    checked = parsed.select("_file", "_names", "_rows", problem.alias("problem"))
    one = F.array(F.expr("cast(null as array<string>)"))
    rows = checked.select("_file", "_names", "problem", F.explode(F.when(F.col("problem").isNull(), F.col("_rows")).otherwise(one)).alias("_row"))
    bad, row = F.col("problem").isNotNull(), F.col("_row")
    typed = [F.when(~bad, cell(f.name, row)).try_cast(f.dataType).alias(f.name) for f in TRANSCRIPT_FIELDS]
    return rows.select(
        F.when(~bad, F.coalesce(cell("ticker", row), folder)).alias("ticker"), *typed,
        F.regexp_extract("_file", r"([^/]+)$", 1).alias("source_file"), F.col("_file").alias("source_path"), "problem",
    )


def good_transcripts(scan: DataFrame) -> DataFrame:
    """The rows of the readable files of a scan."""
    return scan.filter("problem is null").drop("problem", "source_path")


def bad_files(scan: DataFrame) -> DataFrame:
    """The report of a scan: one row per bad file, (source_path, problem)."""
    return scan.filter("problem is not null").select("source_path", "problem")


def read_transcripts(spark: SparkSession, path: str) -> DataFrame:
    """SRC8, all or nothing: the rows of ``scan_transcripts``; a bad file
    fails the read, naming the file and the problem."""
    scan = scan_transcripts(spark, path)
    wrong = F.raise_error(F.concat(F.col("problem"), F.lit(" in "), F.col("source_path"))).cast("boolean")
    return scan.filter(F.when(F.col("problem").isNotNull(), wrong).otherwise(F.lit(True))).drop("problem", "source_path")


# SRC9 -----------------------------------------------------------------------
def read_price_change_dim(spark: SparkSession, path: str) -> DataFrame:
    """SRC9: the static price-change dimension; the UTF-8 BOM is dropped by
    the reader and the text 'None' is read as null."""
    return (
        spark.read.schema(PRICE_CHANGE_DIM_SCHEMA)
        .option("header", True)
        .option("nullValue", "None")
        .option("encoding", "UTF-8")
        .csv(path)
    )


# SRC7 -----------------------------------------------------------------------
def read_constituents(spark: SparkSession, path: str, cik_col: str = "CIK", on_collision: str = "fail") -> DataFrame:
    """SRC7: index constituents landed as CSV (all columns text), names cleaned
    (PRJ1) and the CIK padded to ten digits (SCL1)."""
    df = clean_column_names(spark.read.option("header", True).option("inferSchema", False).csv(path), on_collision)
    return df.withColumn(cik_col, pad_cik(cik_col))


def constituents_from_lines(
    lines: DataFrame, header: Sequence[str], line_col: str = "value", cik_col: str = "CIK", on_collision: str = "fail", keep: Sequence[str] = ()
) -> DataFrame:
    """SRC7 over CSV lines in a text column (one record each, without the
    header line): fields by ``header``, names cleaned (PRJ1), CIK padded (SCL1).

    Parsed inside the plan by ``from_csv``; a record with more or fewer fields
    than the header fails, showing the line.  A null line gives no row."""
    names = clean_names(header, on_collision)
    schema = ", ".join([f"_c{i} string" for i in range(len(names))] + ["_bad string"])
    fields = F.from_csv(F.col(line_col), schema, {"escape": '"', "columnNameOfCorruptRecord": "_bad"})
    rows = lines.filter(F.col(line_col).isNotNull()).select(*keep, fields.alias("_r"))
    wrong = F.raise_error(F.concat(F.lit(f"not {len(names)} fields: "), F.col("_r._bad"))).cast("boolean")
    rows = rows.filter(F.when(F.col("_r._bad").isNotNull(), wrong).otherwise(F.lit(True)))
    out = rows.select(*keep, *[F.col(f"_r._c{i}").alias(n) for i, n in enumerate(names)])
    return out.withColumn(cik_col, pad_cik(cik_col))


# SRC10 ----------------------------------------------------------------------
def lookup_cik(
    df: DataFrame,
    ticker_list: DataFrame,
    ticker_col: str = "ticker",
    out_col: str = "cik10D",
    pad: bool = True,
) -> DataFrame:
    """SRC10: CIK of each ticker from the ticker list; a ticker listed twice
    takes its first entry (``list_pos``; of a list without positions, the
    smallest CIK)."""
    first = F.min_by("cik_str", "list_pos") if "list_pos" in ticker_list.columns else F.min("cik_str")
    first = ticker_list.groupBy(F.col("ticker").alias("_lt")).agg(first.alias("_cik"))
    cik = pad_cik(F.col("_cik")) if pad else F.col("_cik").cast("string")
    joined = df.join(first, F.col(ticker_col) == F.col("_lt"), "left")
    return joined.withColumn(out_col, cik).drop("_lt", "_cik")


# SRC6 -----------------------------------------------------------------------
def read_prices(
    spark: SparkSession,
    path: str,
    tickers: Sequence[str] | None = None,
    start: str | None = None,
    end: str | None = None,
    years: int | None = None,
) -> DataFrame:
    """SRC6: daily bars from a Parquet table partitioned by ticker.

    The ticker list prunes partitions and the date bounds ([start, end),
    end exclusive) are pushed to the Parquet scan.  ``years`` without bounds
    is the default range of the original download (SCL15: the last
    366 * years days up to today).  An absent path gives an empty frame, as
    the original download did; any other error is raised.
    """
    try:
        df = spark.read.schema(PRICE_BARS_SCHEMA).parquet(path)
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], PRICE_BARS_SCHEMA)
    return select_prices(df, tickers, start, end, years)


def select_prices(
    bars: DataFrame, tickers: Sequence[str] | DataFrame | None = None, start: str | None = None, end: str | None = None,
    years: int | None = None, today: str | None = None, ticker_col: str = "ticker", date_col: str = "Date",
) -> DataFrame:
    """Bars of the tickers in [start, end).  A list of tickers prunes
    partitions and the bounds reach the Parquet scan.  ``years`` without
    bounds is the last 366 * years days up to ``today`` (SCL15)."""
    if tickers is not None:
        bars = keep_members(bars, ticker_col, tickers if isinstance(tickers, DataFrame) else list(tickers))
    lo, hi = (F.to_date(F.lit(x)) if x is not None else None for x in (start, end))
    if years is not None and start is None and end is None:
        lo, hi = default_range(years, None if today is None else F.lit(today))
    if lo is not None:
        bars = bars.filter(F.col(date_col) >= lo)
    if hi is not None:
        bars = bars.filter(F.col(date_col) < hi)
    return bars


def prices_for_windows(
    bars: DataFrame, reports: DataFrame, ticker_col: str = "ticker", date_col: str = "Date", report_ticker_col: str = "ticker",
    report_col: str = "reportDate", months: int = fixed.PRICE_WINDOW_MONTHS,
) -> DataFrame:
    """The bars that some report's window [report - months, report) can hold,
    from a table partitioned by ticker.

    The tickers of the reports prune the table's partitions at run time
    (dynamic partition pruning of the semi-join).  The first and last day that
    any window needs are scalar subqueries on the date, so no job runs while
    the plan is built; ``window_closes`` tests the windows themselves."""
    windows = reports.select(F.col(report_ticker_col).alias("_t"), F.to_date(F.col(report_col)).alias("_rd")).dropna()
    first = windows.agg(F.min(minus_months("_rd", months))).scalar()
    last = windows.agg(F.max("_rd")).scalar()
    tickers = windows.groupBy("_t").agg(F.count(F.lit(1)).alias("_n")).filter("_n > 0")
    kept = bars.filter((F.col(date_col) >= first) & (F.col(date_col) < last))
    return kept.join(tickers, F.col(ticker_col) == F.col("_t"), "left_semi")


# SRC11 ----------------------------------------------------------------------
def harvest_transcripts(
    tickers: DataFrame,
    replies: DataFrame,
    years: Sequence[int] | Column,
    quarters: Sequence[int] = (1, 2, 3, 4),
    ticker_col: str = "ticker",
) -> DataFrame:
    """SRC11 (+ JON6, FLT6): ticker x year x quarter grid, left-joined to the
    landed replies ``(ticker, year, quarter, reply)``; a reply that is a JSON
    list (no transcript) gives nulls; rows with any null are dropped.
    Key: ``YYYY-Qn-TICKER``."""
    grid = request_grid(tickers.select(F.col(ticker_col).alias("ticker")).distinct(), years, quarters)
    body = F.ltrim(F.col("reply"))
    parsed = F.when(body.startswith("{"), F.from_json(F.col("reply"), "struct<transcript: string, date: string>"))
    r = replies.select("ticker", "year", "quarter", parsed.alias("_r"))
    joined = null_safe_join(grid, r, ["ticker", "year", "quarter"], "left")
    out = joined.select(
        "ticker",
        "year",
        "quarter",
        F.concat(F.col("year").cast("string"), F.lit("-Q"), F.col("quarter").cast("string"), F.lit("-"), F.col("ticker")).alias("transcriptID"),
        F.col("_r.transcript").alias("transcript"),
        F.col("_r.date").alias("date"),
    )
    return drop_incomplete(out)
