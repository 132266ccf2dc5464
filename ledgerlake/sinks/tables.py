"""Table writers (SNK1-SNK5).

Parquet is the default target; a JDBC target is available through
``write_jdbc`` with batched inserts.  Overwrites are whole-table, as the
original loads were; every writer takes the mode as a parameter.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, DataFrameWriter
from pyspark.sql import functions as F


def write_table(
    df: DataFrame,
    path: str,
    mode: str = "overwrite",
    fmt: str = "parquet",
    partition_by: Sequence[str] | None = None,
    options: dict[str, str] | None = None,
) -> None:
    """SNK3: generic table write (dimension loads)."""
    writer = df.write.mode(mode).format(fmt).options(**(options or {}))
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.save(path)


def write_fact_table(df: DataFrame, path: str, mode: str = "overwrite", date_cols: Sequence[str] = ("reportDate", "filingDate")) -> None:
    """SNK1: fact table with its date columns cast to DATE first."""
    write_table(df.withColumns({c: F.to_date(F.col(c)) for c in date_cols if c in df.columns}), path, mode)


def write_validation_table(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    """SNK2: missing-data flags; ``mode='append'`` keeps a history."""
    write_table(df, path, mode)


def export_csv(df: DataFrame, path: str, mode: str = "overwrite", rows_per_file: int = 1_000_000) -> None:
    """SNK4: CSV export with a header; white space is kept, quotes are doubled.

    Rows are rebalanced by size (adaptive execution merges small partitions
    and splits large ones), and no file has more than ``rows_per_file`` rows."""
    _csv(df.hint("rebalance").write.mode(mode)).option("maxRecordsPerFile", rows_per_file).csv(path)


def write_transcripts(df: DataFrame, path: str, mode: str = "overwrite", rows_per_file: int = 5_000) -> None:
    """SNK5: one CSV directory per ticker (``ticker=<T>``), every field quoted
    so multi-line text survives; ``read_transcripts`` reads it back.

    Rows are rebalanced by ticker and size: small tickers share a task, so each
    gets one file, and a hot ticker is split over tasks by its size, and over
    files of ``rows_per_file`` rows."""
    by_ticker = df.hint("rebalance", F.col("ticker"))
    writer = _csv(by_ticker.write.mode(mode).partitionBy("ticker")).option("quoteAll", True)
    writer.option("maxRecordsPerFile", rows_per_file).csv(path)


def _csv(writer: DataFrameWriter) -> DataFrameWriter:
    return (
        writer.option("header", True)
        .option("escape", '"')
        .option("ignoreLeadingWhiteSpace", False)
        .option("ignoreTrailingWhiteSpace", False)
    )


def write_jdbc(df: DataFrame, url: str, table: str, mode: str = "overwrite", properties: dict[str, str] | None = None, batchsize: int = 10000) -> None:
    """SNK1-SNK3 to a database: batched inserts, one connection per task."""
    props = {"batchsize": str(batchsize), **(properties or {})}
    df.write.mode(mode).jdbc(url, table, properties=props)
