"""JSON sources of the filings domain (SRC1-SRC5).

HTTP responses are replaced by a landing zone of files; each reader declares
its schema (no inference pass over the data) and turns nested JSON into rows
with generators (``explode`` / ``posexplode`` / ``inline``), never with
driver-side loops.  One JSON document per company is read as a multi-line
file; many companies are many files and therefore many tasks.

The ticker of a company file comes from outside the document: by default from
a ``ticker=<T>`` directory level of the landing path (partition discovery),
or from a column added by the caller.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerlake.functions.scalars import date_key, days_between, epoch_to_date, filing_url, first_value, month_steps, pad_cik
from ledgerlake.operators.projections import flatten_lists
from ledgerlake import fixed

FACT_RECORD = T.StructType(
    [
        T.StructField("start", T.StringType()),
        T.StructField("end", T.StringType()),
        T.StructField("val", T.DoubleType()),
        T.StructField("accn", T.StringType()),
        T.StructField("fy", T.IntegerType()),
        T.StructField("fp", T.StringType()),
        T.StructField("form", T.StringType()),
        T.StructField("filed", T.StringType()),
        T.StructField("frame", T.StringType()),
    ]
)
TAG_ENTRY = T.StructType(
    [
        T.StructField("label", T.StringType()),
        T.StructField("description", T.StringType()),
        T.StructField("units", T.MapType(T.StringType(), T.ArrayType(FACT_RECORD))),
    ]
)
COMPANY_FACTS_SCHEMA = T.StructType(
    [
        T.StructField("cik", T.LongType()),
        T.StructField("entityName", T.StringType()),
        T.StructField("facts", T.StructType([T.StructField("us-gaap", T.MapType(T.StringType(), TAG_ENTRY))])),
    ]
)

_RECENT_STRING = [
    "accessionNumber", "filingDate", "reportDate", "acceptanceDateTime", "act", "form",
    "fileNumber", "filmNumber", "items", "primaryDocument", "primaryDocDescription",
]
_RECENT_LONG = ["size", "isXBRL", "isInlineXBRL"]
SUBMISSIONS_SCHEMA = T.StructType(
    [
        T.StructField("cik", T.StringType()),
        T.StructField("entityType", T.StringType()),
        T.StructField("sicDescription", T.StringType()),
        T.StructField("ownerOrg", T.StringType()),
        T.StructField("name", T.StringType()),
        T.StructField("tickers", T.ArrayType(T.StringType())),
        T.StructField("exchanges", T.ArrayType(T.StringType())),
        T.StructField("description", T.StringType()),
        T.StructField("website", T.StringType()),
        T.StructField("investorWebsite", T.StringType()),
        T.StructField("category", T.StringType()),
        T.StructField("fiscalYearEnd", T.StringType()),
        T.StructField("stateOfIncorporation", T.StringType()),
        T.StructField(
            "filings",
            T.StructType(
                [
                    T.StructField(
                        "recent",
                        T.StructType(
                            [T.StructField(n, T.ArrayType(T.StringType())) for n in _RECENT_STRING]
                            + [T.StructField(n, T.ArrayType(T.LongType())) for n in _RECENT_LONG]
                        ),
                    )
                ]
            ),
        ),
    ]
)
TICKER_LIST_SCHEMA = "map<string, struct<cik_str: bigint, ticker: string, title: string>>"
CHART_SCHEMA = T.StructType(
    [
        T.StructField(
            "chart",
            T.StructType(
                [
                    T.StructField(
                        "result",
                        T.ArrayType(
                            T.StructType(
                                [
                                    T.StructField("timestamp", T.ArrayType(T.LongType())),
                                    T.StructField(
                                        "indicators",
                                        T.StructType(
                                            [
                                                T.StructField(
                                                    "adjclose",
                                                    T.ArrayType(
                                                        T.StructType([T.StructField("adjclose", T.ArrayType(T.DoubleType()))])
                                                    ),
                                                )
                                            ]
                                        ),
                                    ),
                                ]
                            )
                        ),
                    )
                ]
            ),
        )
    ]
)


def _with_ticker(schema: T.StructType) -> T.StructType:
    return T.StructType(schema.fields + [T.StructField("ticker", T.StringType())])


#: Order of the landed versions of a document, from the file's own metadata; the file's path.
LANDED_TIME, LANDED_TIE, SOURCE_PATH = "landedAt", "landedFile", "source_path"


def read_json_documents(
    spark: SparkSession, path: str | Sequence[str], schema: T.StructType, versions: bool = False, base_path: str | None = None,
    source_path: bool = False,
) -> DataFrame:
    """One JSON document per file; a ``ticker=`` directory level becomes a
    column (below ``base_path``, where single files are given).  A truncated or
    malformed document fails the read, naming its file.

    With ``versions`` each document also has the modification time of its file
    and a hash of its path, the order in which ``newest`` picks one; with
    ``source_path`` the path itself."""
    reader = spark.read.schema(_with_ticker(schema)).option("multiLine", True).option("mode", "FAILFAST")
    if base_path is not None:
        reader = reader.option("basePath", base_path)
    docs = reader.json(path if isinstance(path, str) else list(path))
    extra = []
    if versions:
        extra += [F.col("_metadata.file_modification_time").alias(LANDED_TIME), F.xxhash64("_metadata.file_path").alias(LANDED_TIE)]
    if source_path:
        extra.append(F.col("_metadata.file_path").alias(SOURCE_PATH))
    return docs.select("*", *extra) if extra else docs


def parse_json_documents(df: DataFrame, text_col: str, schema: T.StructType, keep: Sequence[str] = ()) -> DataFrame:
    """Documents landed as a text column of a table: the fields of ``schema``
    beside the ``keep`` columns.  A malformed document fails the read."""
    parsed = F.from_json(F.col(text_col), schema, {"mode": "FAILFAST"})
    return df.select(*keep, parsed.alias("_doc")).select(*keep, "_doc.*")


def same_lengths(arrays: Sequence[str]) -> Column:
    """Whether the arrays of a row that are present have one length.  A null
    array is an absent one (its fields are null in every row), not a short one."""
    sizes = F.array_compact(F.array(*[F.when(F.col(a).isNotNull(), F.size(a)) for a in arrays]))
    return F.coalesce(F.array_min(sizes) == F.array_max(sizes), F.lit(True))


def misaligned(df: DataFrame, keep: list[str], arrays: list[str]) -> DataFrame:
    """Report of the documents whose parallel arrays differ in length:
    ``keep``, the longest length, and the shorter arrays with their lengths."""
    sizes = F.array(*[F.struct(F.lit(a.split(".")[-1]).alias("name"), F.size(a).cast("bigint").alias("size")) for a in arrays])
    bad = df.filter(~same_lengths(arrays)).select(*keep, F.filter(sizes, lambda x: x["size"] >= 0).alias("_s"))
    longest = F.array_max(F.transform("_s", lambda x: x["size"]))
    return bad.select(
        *keep, longest.alias("longest"), F.map_from_entries(F.filter("_s", lambda x: x["size"] < longest)).alias("shorter")
    )


def explode_parallel(
    df: DataFrame, keep: list[str], arrays: list[str], pos_col: str | None = None, on_mismatch: str = "fail", flag_col: str | None = None
) -> DataFrame:
    """Parallel arrays (a column-oriented JSON block) -> one row per position.

    ``arrays_zip`` pairs the i-th elements; ``posexplode`` keeps the position
    when ``pos_col`` is given.  Array fields keep their names.  Arrays of
    different lengths fail the read, naming the ``keep`` values; with
    ``on_mismatch='pad'`` the missing places are null, ``flag_col`` (if given)
    is false in every row of such a document, and ``misaligned`` lists them.
    """
    if on_mismatch not in ("fail", "pad"):
        raise ValueError(f"on_mismatch is 'fail' or 'pad', not {on_mismatch!r}")
    # arrays_zip is null where any array is: an absent one counts as empty and is padded.
    zipped = F.arrays_zip(*[F.coalesce(F.col(a), F.array()).alias(a.split(".")[-1]) for a in arrays])
    aligned = same_lengths(arrays)
    if on_mismatch == "fail":
        names = F.concat_ws(", ", *[F.col(k).cast("string") for k in keep])
        zipped = F.when(aligned, zipped).otherwise(F.raise_error(F.concat(F.lit("parallel arrays of different lengths: "), names)))
    flag = [aligned.alias(flag_col)] if flag_col else []
    cols = [*keep, *([flag_col] if flag_col else [])]
    if pos_col is None:
        return df.select(*keep, *flag, F.inline(zipped))
    return df.select(*keep, *flag, F.posexplode(zipped).alias(pos_col, "_z")).select(*cols, pos_col, "_z.*")


# SRC1 -----------------------------------------------------------------------
def company_facts_rows(docs: DataFrame, ticker_col: str = "ticker", keep: Sequence[str] = ()) -> DataFrame:
    """SRC1 (+ JON1, WIN2, SCL2, SCL3): company-facts documents -> one row per
    reported value of namespace us-gaap, first unit of each tag only.
    Narrow: generators and array functions only, no shuffle.

    Columns: finType, label, description, end, val, accn, fp, form, filed,
    frame, start, monthWindow, yearMonthDay, ticker, and the ``keep`` columns of
    the document.  A tag whose first unit list is empty yields no rows.
    """
    tags = docs.select(
        *keep,
        F.col(ticker_col).alias("ticker"),
        F.explode(F.col("facts").getField("us-gaap")).alias("finType", "tag"),
    ).withColumn("_records", first_value("tag.units"))
    # WIN2 without a shuffle: a tag's records are one array in one row here, so
    # "some record of the tag has a start" is a higher-order test on it.
    records = tags.select(
        *keep,
        "ticker",
        "finType",
        F.col("tag.label").alias("label"),
        F.col("tag.description").alias("description"),
        F.exists("_records", lambda r: r.getField("start").isNotNull()).alias("_has_start"),
        F.explode("_records").alias("r"),
    ).select(*keep, "ticker", "finType", "label", "description", "_has_start", "r.*")
    steps = month_steps(days_between("end", "start"))
    return records.select(
        "finType", "label", "description", "end", "val", "accn", "fp", "form", "filed", "frame", "start",
        F.when(F.col("_has_start"), steps).alias("monthWindow"),
        date_key("end", "start").alias("yearMonthDay"), "ticker", *keep,
    )


def read_company_facts(spark: SparkSession, path: str) -> DataFrame:
    return company_facts_rows(read_json_documents(spark, path, COMPANY_FACTS_SCHEMA))


# SRC2 -----------------------------------------------------------------------
def filings_rows(
    docs: DataFrame, ticker_col: str = "ticker", url_base: str = fixed.FILING_URL_BASE, on_mismatch: str = "fail", flag_col: str | None = None
) -> DataFrame:
    """SRC2 (+ SCL10, SCL3): submissions documents -> one row per recent
    filing.  ``filing_pos`` is the position in the list (newest first), the
    order the quarter normalisation relies on.  Field arrays of different
    lengths fail the read, as in the original, or are padded and flagged
    (``on_mismatch``, ``flag_col`` as in ``explode_parallel``)."""
    names = _RECENT_STRING + _RECENT_LONG
    docs = docs.select(
        pad_cik(F.col("cik")).alias("_cik10"),
        F.col(ticker_col).alias("ticker"),
        *[F.col(f"filings.recent.{n}").alias(n) for n in names],
    )
    rows = explode_parallel(docs, ["_cik10", "ticker"], names, "filing_pos", on_mismatch, flag_col)
    return rows.select(
        *names[:3], "acceptanceDateTime", "act", "form", "fileNumber", "filmNumber", "items",
        "size", "isXBRL", "isInlineXBRL", "primaryDocument", "primaryDocDescription",
        filing_url(F.col("_cik10"), F.col("accessionNumber"), F.col("primaryDocument"), url_base).alias("fileURL"),
        date_key("reportDate", "filingDate").alias("yearMonthDay"),
        "ticker",
        "filing_pos",
        *([flag_col] if flag_col else []),
    )


def filings_misaligned(docs: DataFrame, ticker_col: str = "ticker") -> DataFrame:
    """Submissions documents whose field arrays differ in length."""
    names = _RECENT_STRING + _RECENT_LONG
    docs = docs.select(F.col("cik"), F.col(ticker_col).alias("ticker"), *[F.col(f"filings.recent.{n}").alias(n) for n in names])
    return misaligned(docs, ["cik", "ticker"], names)


def read_filings(spark: SparkSession, path: str) -> DataFrame:
    return filings_rows(read_json_documents(spark, path, SUBMISSIONS_SCHEMA))


# SRC3 -----------------------------------------------------------------------
def read_ticker_list(spark: SparkSession, path: str) -> DataFrame:
    """SRC3: the exchange ticker list (an object of objects) -> cik_str,
    ticker, title, cik10D and the position in the list."""
    return ticker_list_rows(spark.read.text(path, wholetext=True), "value")


def ticker_list_rows(docs: DataFrame, text_col: str, keep: Sequence[str] = ()) -> DataFrame:
    """SRC3 over list documents in a text column, beside their ``keep`` columns."""
    listed = F.map_values(F.from_json(F.col(text_col), TICKER_LIST_SCHEMA, {"mode": "FAILFAST"}))
    entries = docs.select(*keep, F.posexplode(listed).alias("list_pos", "e"))
    return entries.select(*keep, "e.cik_str", "e.ticker", "e.title", pad_cik(F.col("e.cik_str")).alias("cik10D"), "list_pos")


# SRC4 -----------------------------------------------------------------------
def company_descriptions(docs: DataFrame, keys=fixed.COMPANY_KEYS) -> DataFrame:
    """SRC4 + PRJ4: the kept description keys, list fields joined with ', '."""
    return flatten_lists(docs.select(*[k for k in keys if k in docs.columns]))


def read_company_descriptions(spark: SparkSession, path: str) -> DataFrame:
    return company_descriptions(read_json_documents(spark, path, SUBMISSIONS_SCHEMA))


# SRC5 -----------------------------------------------------------------------
def chart_rows(docs: DataFrame, ticker_col: str = "ticker", zone: str = "UTC") -> DataFrame:
    """SRC5 (+ SCL14): price-chart documents -> (adjClose, date, ticker);
    timestamps and adjusted closes are zipped position by position, epoch
    seconds become dates in ``zone``, whatever the session's zone is.

    A document whose close series is absent gives its dates with null closes;
    one without timestamps (or without a result) gives no rows.  Series of
    different lengths fail the read, naming the ticker."""
    result = F.get(F.col("chart.result"), 0)
    closes = F.get(result.getField("indicators").getField("adjclose"), 0).getField("adjclose")
    flat = docs.select(F.col(ticker_col).alias("ticker"), closes.alias("adjClose"), result.getField("timestamp").alias("time"))
    return explode_parallel(flat.filter("time is not null"), ["ticker"], ["adjClose", "time"]).select(
        "adjClose", epoch_to_date("time", zone).cast("string").alias("date"), "ticker"
    )


def read_chart(spark: SparkSession, path: str) -> DataFrame:
    return chart_rows(read_json_documents(spark, path, CHART_SCHEMA))
