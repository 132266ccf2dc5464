"""Incremental ingest of many companies' landed documents (SRC12).

A manifest lists the landed files (path, length, time).  What a published
version holds is anti-joined with it, so a rerun reads only new or changed
documents.  Rows and manifest become visible together.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from itertools import islice

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerlake.sinks.publish import Version, current, publish, read_published
from ledgerlake.sources.filings_json import SOURCE_PATH, read_json_documents

ROWS, FILES = "rows", "files"
_KEY = [SOURCE_PATH, "length", "modified"]


def file_manifest(spark: SparkSession, path: str, glob: str = "*.json") -> DataFrame:
    """(source_path, path, length, modified) of the files below ``path``; no
    content is read."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", glob).load(path)
    return files.select(F.col("_metadata.file_path").alias(SOURCE_PATH), "path", "length", F.col("modificationTime").alias("modified"))


def _batches(paths: DataFrame, size: int) -> Iterator[list[str]]:
    """The paths, ``size`` at a time; the driver holds one batch."""
    rows = paths.orderBy("path").toLocalIterator()
    while batch := [r["path"] for r in islice(rows, size)]:
        yield batch


def ingest(
    spark: SparkSession, landing: str, root: str, schema: T.StructType, to_rows: Callable[[DataFrame], DataFrame], glob: str = "*.json",
    files_per_read: int = 10_000,
) -> Version:
    """Bring the published rows of ``root`` up to the landed documents.

    ``to_rows`` turns documents into rows and must keep their ``source_path``
    column.  New files are read and appended.  Where files changed or
    vanished, the folders that hold their rows are written again without them;
    other folders stay.  Without any difference nothing is written.  The
    published rows always equal a full read of the landing folder.
    """
    now, before = file_manifest(spark, landing, glob), current(spark, root)
    if FILES in before.folders:
        held = read_published(spark, root, FILES, before)
        new = now.join(held, _KEY, "left_anti").select("path")
        gone = held.join(now, _KEY, "left_anti").select(SOURCE_PATH)
        if new.isEmpty() and gone.isEmpty():
            return before
    else:
        new, gone = now.select("path"), None
    made: DataFrame | None = None
    for paths in _batches(new, files_per_read):
        rows = to_rows(read_json_documents(spark, paths, schema, base_path=landing, source_path=True))
        made = rows if made is None else made.unionByName(rows)
    replaced: list[str] = []
    if gone is not None and not gone.isEmpty():
        rows = read_published(spark, root, ROWS, before).withColumn("_folder", F.regexp_extract("_metadata.file_path", r"(data/[^/]+)/[^/]+$", 1))
        replaced = [r["_folder"] for r in rows.join(gone, SOURCE_PATH, "left_semi").select("_folder").distinct().collect()]
        if replaced:
            left = rows.filter(F.col("_folder").isin(replaced)).drop("_folder").join(gone, SOURCE_PATH, "left_anti")
            made = left if made is None else made.unionByName(left)
    tables = {FILES: now} if made is None else {ROWS: made, FILES: now}
    return publish_rows(spark, root, tables, replaced)


def publish_rows(spark: SparkSession, root: str, tables: dict[str, DataFrame], replaced: list[str]) -> Version:
    """Rows join the folders that stay, the manifest replaces the old one; both
    become visible together."""
    old = current(spark, root).folders.get(FILES, [])
    return publish(spark, root, tables, append=True, replaced={ROWS: replaced, FILES: old})
