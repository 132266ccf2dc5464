"""Sharding on a consistent-hash ring with virtual nodes and bounded loads
(operator 4), DataFrame functions only.

Every shard owns ``vnodes`` points of a ring; a document's key belongs to the
shard of the next point clockwise.  A shard takes rows up to its capacity;
what overflows continues clockwise to the next point whose shard has room.
Rows are ranked within each arc of the ring, so a decision about an arc is a
handful of rank intervals.  Arcs are cut into ranges of about equal row counts,
rows are ranked in each range, and the ranges before give the offset.  The
driver handles one number per range and arc that meet (``shards * vnodes`` plus
the number of shuffle partitions at most), never rows.
"""

from __future__ import annotations

import hashlib
import json
from bisect import bisect_right

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ledgerlake.llm.common import keep, load, partitions, range_of, text_or_empty


def ring(shards: int, vnodes: int) -> list[tuple[int, int]]:
    """(position, shard) of the ring's points in clockwise order; positions
    are signed 64-bit numbers, the range of ``xxhash64``."""

    def place(shard: int, v: int) -> int:
        return int.from_bytes(hashlib.blake2b(f"{shard}/{v}".encode(), digest_size=8).digest(), "little", signed=True)

    return sorted((place(s, v), s) for s in range(shards) for v in range(vnodes))


def bounded_loads(counts: dict[tuple[int, int], int], owners: list[int], caps: list[int]) -> list[tuple]:
    """Fill shards clockwise: rows as (arc, block, first rank, end rank, shard,
    first slot).  All arcs try their own point first; only what overflows
    moves on, one point at a time, so a row whose shard has room never moves."""
    load, out = [0] * len(caps), []
    waiting = [(arc, block, 0, n, arc) for (arc, block), n in sorted(counts.items())]
    while waiting:
        later = []
        for arc, block, low, high, at in waiting:
            shard = owners[at]
            took = min(caps[shard] - load[shard], high - low)
            if took:
                out.append((arc, block, low, low + took, shard, load[shard]))
                load[shard] += took
            if low + took < high:
                later.append((arc, block, low + took, high, (at + 1) % len(owners)))
        waiting = later
    return out


def capacities(rows: int, shards: int, slack: float) -> list[int]:
    """Most rows of each shard.  ``slack`` 0: counts at most one apart."""
    if slack:
        return [-(-int(rows * (1 + slack)) // shards) + 1] * shards
    return [rows // shards + (s < rows % shards) for s in range(shards)]


def shard_rows(
    docs: DataFrame, shards: int = 16, vnodes: int = 64, slack: float = 0.0, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """One row per input row: id, size (UTF-8 bytes of the text plus 1),
    text_crc32, shard, slot (gapless from 0 in each shard).

    A null text has no bytes.  Null ids are one key.
    Rows that agree in id and text are interchangeable and only their number
    counts.  An empty table gives no rows.
    """
    spark = docs.sparkSession
    points = ring(shards, vnodes)
    raw = F.encode(text_or_empty(text_col), "UTF-8")
    rows = docs.select(F.col(id_col).alias("id"), (F.length(raw) + F.lit(1)).cast("bigint").alias("size"), F.crc32(raw).alias("crc"))
    rows = rows.withColumn("pos", F.xxhash64(F.coalesce(F.col("id").cast("string"), F.lit("null"))))
    # An arc ends at its point; what lies behind the last point wraps to the first.
    cuts = F.from_json(F.lit(json.dumps([p for p, _ in points])), "array<bigint>")
    rows = rows.withColumn("arc", F.pmod(range_of(F.col("pos"), cuts, len(points)), F.lit(len(points))).cast("int"))
    # The salt splits rows that agree in all else; it decides nothing but their order.
    order = ["arc", "pos", "crc", "size", "salt"]
    rows = rows.withColumn("salt", F.xxhash64(F.monotonically_increasing_id()))
    rows = rows.repartitionByRange(partitions(spark), *order).withColumn("range", F.spark_partition_id())
    inside = Window.partitionBy("arc", "range").orderBy(*order[1:])
    ranked = keep(rows.withColumn("rank", (F.row_number().over(inside) - 1).cast("bigint")).drop("pos", "salt"), "ring-ranks")
    offsets, counts = [], {}
    for r in ranked.groupBy("arc", "range").agg(F.count("*").alias("n")).orderBy("arc", "range").collect():
        offsets.append((r["arc"], r["range"], counts.get((r["arc"], 0), 0)))
        counts[r["arc"], 0] = offsets[-1][2] + r["n"]
    moves = bounded_loads(counts, [s for _, s in points], capacities(sum(counts.values()), shards, slack))
    plan = spark.createDataFrame([(m[0], *m[2:]) for m in moves], "arc int, low bigint, high bigint, shard int, slot0 bigint")
    # The plan has at most one row per point passed; its size is bounded by the ring.
    home = F.broadcast(plan.groupBy("arc").agg(F.sort_array(F.collect_list(F.struct("low", "high", "shard", "slot0"))).alias("parts")))
    before = F.broadcast(spark.createDataFrame(offsets, "arc int, range int, before bigint"))
    placed = ranked.join(before, ["arc", "range"]).withColumn("rank", F.col("rank") + F.col("before")).join(home, "arc")
    part = F.element_at(F.filter("parts", lambda p: (p["low"] <= F.col("rank")) & (F.col("rank") < p["high"])), 1)
    return placed.withColumn("part", part).select(
        F.col("id").alias(id_col), "size", F.col("crc").alias("text_crc32"), F.col("part.shard").alias("shard"),
        (F.col("part.slot0") + F.col("rank") - F.col("part.low")).alias("slot"),
    )


def shard_of_keys(keys: list[int], shards: int, vnodes: int = 64) -> list[int]:
    """Owners of ring positions before any bound: a small reference form."""
    points = ring(shards, vnodes)
    places = [p for p, _ in points]
    return [points[bisect_right(places, k) % len(points)][1] for k in keys]


def op4_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    """16 shards under the law ``rows``: with no slack the bound makes counts
    differ by at most one."""
    placed = shard_rows(load(spark, sf_dir, "documents"))
    return placed.select(
        "doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard")
    )
