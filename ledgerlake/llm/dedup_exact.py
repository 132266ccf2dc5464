"""Exact dedup by content sort (operator 6), DataFrame functions only.

Sampled splitters cut the order of the normalised texts into ranges, each
range is sorted externally, and a row is compared in full with its neighbour:
equal texts are adjacent, and of each run one row stays.

The order is (leading characters, digest, identifier).  Splitters carry the
identifier too, so a text that a third of all rows share is spread over as
many ranges as its share of the rows; the few texts that reach a splitter are
summed over their ranges afterwards (at most two run rows a range).
"""

from __future__ import annotations

import json
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerlake.llm.common import ascii_lower, keep, load, partitions, range_of, text_or_empty

#: Characters of a text that a splitter carries at most.
LEAD = 64


def exact_duplicates(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", stays: str = "max", ranges: int | None = None,
    sample_per_range: int = 20,
) -> DataFrame:
    """One row per input row: id, keep_id, group_size, kept, text_sha256.

    ``stays``: "max" or "min" identifier of a group stays.  Null texts equal
    the empty text.  A null id sorts before all others ("max") or after them
    ("min"), so it stays only in a group of null ids.  Rows that share both id
    and text are one group, of which exactly one row is kept.  An empty table
    gives no rows.

    ``sample_per_range``: rows sampled for each range (bounded: at most
    ``ranges * sample_per_range`` keys reach the driver); the sample only
    shapes the ranges, never the result.
    """
    ranges = ranges or partitions(docs.sparkSession)

    def keyed(rows: DataFrame) -> DataFrame:
        rows = rows.select(F.col(id_col).alias("id"), ascii_lower(text_or_empty(text_col)).alias("norm"))
        rows = rows.withColumn("sha", F.sha2(F.encode("norm", "UTF-8"), 256))
        return rows.withColumn("key", F.struct(F.substring("norm", 1, LEAD).alias("lead"), "sha", "id"))

    rows = keyed(docs)
    splitters = _splitters(docs, keyed, ranges, sample_per_range)
    count = len(splitters)
    if count:
        # One constant array of bounded values; JSON keeps the literal small in the plan.
        cuts = F.from_json(F.lit(_json(splitters)), T.ArrayType(rows.schema["key"].dataType))
        part = range_of(F.col("key"), cuts, count)
        border = F.col("sha").isin(sorted({s["sha"] for s in splitters}))
    else:
        part, border = F.lit(0), F.lit(False)
    ordered = rows.withColumn("part", part.cast("int")).withColumn("border", border).drop("key")
    ordered = ordered.repartitionById(max(1, count + 1), F.col("part"))
    best_first = F.col("id").desc_nulls_last() if stays == "max" else F.col("id").asc_nulls_last()
    near = Window.partitionBy("part").orderBy("norm", best_first)
    runs = ordered.withColumn("first", F.lag("norm").over(near).eqNullSafe(F.col("norm")) == F.lit(False))
    runs = runs.withColumn("run", F.sum(F.col("first").cast("int")).over(near.rowsBetween(Window.unboundedPreceding, 0)))
    runs = runs.select("id", "sha", "part", "run", "first", "border", F.when(F.col("first") & F.col("border"), F.col("norm")).alias("norm"))
    run = Window.partitionBy("part", "run")
    found = runs.withColumn("best", F.max(F.when(F.col("first"), F.struct(F.col("id").alias("v")))).over(run)["v"])
    found = keep(found.withColumn("n", F.count("*").over(run)), "exact-runs")
    # Runs of one text in several ranges: one row for each run, then for each text.
    edge = F.max("best") if stays == "max" else F.min("best")
    text = Window.partitionBy("norm")
    homes = found.where("first and border").select("part", "run", "norm", "best", "n")
    homes = homes.withColumn("all_best", edge.over(text)).withColumn("all_n", F.sum("n").over(text))
    own = F.when(F.col("best").eqNullSafe(F.col("all_best")), F.col("part"))
    homes = homes.withColumn("home", F.min(own).over(text) == F.col("part")).drop("norm", "best", "n")
    out = found.drop("norm").join(homes, ["part", "run"], "left")
    spread = F.col("all_n").isNotNull()
    return out.select(
        F.col("id").alias(id_col),
        F.when(spread, F.col("all_best")).otherwise(F.col("best")).alias("keep_id"),
        F.coalesce("all_n", "n").alias("group_size"),
        (F.col("first") & F.coalesce("home", F.lit(True))).alias("kept"),
        F.col("sha").alias("text_sha256"),
    )


def _splitters(docs: DataFrame, keyed: Callable[[DataFrame], DataFrame], ranges: int, per_range: int) -> list:
    """Quantiles of the keys of a bounded random sample of rows, without repeats."""
    total, want = docs.count(), ranges * per_range
    if total == 0 or ranges < 2:
        return []
    sample = docs if total <= want else docs.sample(False, want / total, seed=7)
    got = sorted(
        (r["key"] for r in keyed(sample).select("key").collect()),
        key=lambda k: (k["lead"].encode(), k["sha"], k["id"] is not None, k["id"]),
    )
    picks = [got[len(got) * i // ranges] for i in range(1, ranges)] if got else []
    return list(dict.fromkeys(picks))


def _json(rows: list) -> str:
    return json.dumps([r.asDict() for r in rows], ensure_ascii=False)


def op6_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_duplicates(load(spark, sf_dir, "documents"))


OP6_SQL = """
WITH t AS (
  SELECT doc_id, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS norm FROM documents
), g AS (
  SELECT doc_id, norm, max(doc_id) OVER (PARTITION BY norm) AS keep_id, count(*) OVER (PARTITION BY norm) AS group_size FROM t
)
SELECT doc_id, keep_id, group_size, doc_id = keep_id AS kept, sha256(norm) AS text_sha256 FROM g
"""
