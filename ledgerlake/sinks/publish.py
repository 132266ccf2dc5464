"""Versioned publishing of tables (SNK1-SNK3).

A version is written into folders of its own, checked, and becomes visible by
one switch of a small pointer file, which readers follow.  A write that fails
midway, or whose counts do not agree, leaves the published rows as they were.

Layout below ``root``::

    CURRENT.json                the pointer: version, folders and rows of each table
    data/<table>-<id>/          Parquet folders, never changed once written

A version may keep folders of the one before (``append``), so an incremental
run writes only its new rows.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

POINTER = "CURRENT.json"


class PublishError(RuntimeError):
    """A version that must not become visible."""


@dataclass(frozen=True)
class Version:
    number: int = 0
    folders: dict[str, list[str]] = field(default_factory=dict)
    rows: dict[str, int] = field(default_factory=dict)


def _files(spark: SparkSession, path: str):
    """Hadoop file context and path: works for local, HDFS and object-store paths."""
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    hpath = jvm.org.apache.hadoop.fs.Path(path)
    hpath = hpath.getFileSystem(conf).makeQualified(hpath)
    return jvm.org.apache.hadoop.fs.FileContext.getFileContext(hpath.toUri(), conf), hpath


def current(spark: SparkSession, root: str) -> Version:
    """The published version; number 0 where nothing is published yet."""
    context, path = _files(spark, f"{root}/{POINTER}")
    if not context.util().exists(path):
        return Version()
    text = "".join(r["value"] for r in spark.read.text(f"{root}/{POINTER}", wholetext=True).collect())
    got = json.loads(text)
    return Version(got["version"], got["folders"], got["rows"])


def _switch(spark: SparkSession, root: str, version: Version) -> None:
    """Put the pointer in place: a whole file, renamed over the old one."""
    jvm = spark.sparkContext._jvm
    context, final = _files(spark, f"{root}/{POINTER}")
    _, part = _files(spark, f"{root}/{POINTER}.{uuid.uuid4().hex}")
    text = json.dumps({"version": version.number, "folders": version.folders, "rows": version.rows}, indent=1)
    filesystem = part.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    out = filesystem.create(part, False)
    try:
        out.write(bytearray(text.encode()))
    finally:
        out.close()
    rename = jvm.org.apache.hadoop.fs.Options.Rename
    options = spark.sparkContext._gateway.new_array(rename, 1)
    options[0] = rename.OVERWRITE
    context.rename(part, final, options)


def write_folder(df: DataFrame, root: str, table: str) -> tuple[str, int]:
    """Write one folder and check that its files hold the rows that the write
    produced; the folder (relative to ``root``) and its rows."""
    spark, folder = df.sparkSession, f"data/{table}-{uuid.uuid4().hex}"
    seen = Observation()
    df.observe(seen, F.count(F.lit(1)).alias("rows")).write.mode("error").parquet(f"{root}/{folder}")
    held = spark.read.schema(df.schema).parquet(f"{root}/{folder}").count()
    if held != seen.get["rows"]:
        raise PublishError(f"{folder} holds {held} rows, {seen.get['rows']} were written")
    return folder, held


def publish(
    spark: SparkSession, root: str, tables: Mapping[str, DataFrame], append: bool = False, expect: Mapping[str, int] | None = None,
    replaced: Mapping[str, Sequence[str]] | None = None,
) -> Version:
    """Write ``tables`` and make them visible together.

    Each replaces the table of that name; with ``append`` its folder joins
    those of the version before, but for the ones in ``replaced``.  Tables that
    are not given stay as they are.  ``expect`` holds row counts that the
    written folders must have.  If another version became visible meanwhile,
    nothing is switched.
    """
    before = current(spark, root)
    folders, rows = {k: list(v) for k, v in before.folders.items()}, dict(before.rows)
    for name, df in tables.items():
        folder, count = write_folder(df, root, name)
        if expect is not None and name in expect and expect[name] != count:
            raise PublishError(f"{name}: {count} rows written, {expect[name]} expected")
        gone = set((replaced or {}).get(name, ())) if append else set(folders.get(name, ()))
        kept = [f for f in folders.get(name, ()) if f not in gone]
        folders[name] = [*kept, folder]
        rows[name] = sum(spark.read.parquet(f"{root}/{f}").count() for f in kept) + count
    if current(spark, root).number != before.number:
        raise PublishError(f"version {before.number} of {root} was replaced meanwhile")
    version = Version(before.number + 1, folders, rows)
    _switch(spark, root, version)
    return version


def read_published(spark: SparkSession, root: str, table: str, version: Version | None = None) -> DataFrame:
    """A table of the published version, as it is now: a later version does
    not change what this DataFrame reads."""
    version = version or current(spark, root)
    if table not in version.folders:
        raise PublishError(f"{root} has no published table {table!r}")
    return spark.read.parquet(*[f"{root}/{f}" for f in version.folders[table]])


def remove_unpublished(spark: SparkSession, root: str, older_than_hours: float = 168.0) -> list[str]:
    """Delete the folders below ``root``/data that the published version does
    not name and that are older than given (of failed or replaced versions;
    a write in progress is young).  The names of the deleted ones."""
    import time

    context, data = _files(spark, f"{root}/data")
    if not context.util().exists(data):
        return []
    live = {f for names in current(spark, root).folders.values() for f in names}
    limit, gone = (time.time() - older_than_hours * 3600) * 1000, []
    for status in context.util().listStatus(data):
        name = f"data/{status.getPath().getName()}"
        if name not in live and status.getModificationTime() < limit:
            context.delete(status.getPath(), True)
            gone.append(name)
    return sorted(gone)
