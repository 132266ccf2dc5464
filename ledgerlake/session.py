"""Session construction and lineage cutting.

On a cluster the session is created by the platform; ``build_session`` is for
local runs and tests.  ``materialize`` cuts lineage with a *reliable*
checkpoint into the shared folder named by ``spark.checkpoint.dir`` so a lost
executor never forces a recompute of a long plan.
"""

from __future__ import annotations

import os
import uuid

from pyspark.sql import DataFrame, SparkSession

CHECKPOINT_CONF = "spark.checkpoint.dir"


def build_session(
    master: str | None = None,
    shuffle_partitions: int = 8,
    app_name: str = "ledgerlake",
    extra: dict[str, str] | None = None,
) -> SparkSession:
    """Local session with the settings the engine assumes (UTC, AQE, no UI)."""
    master = master or f"local[{os.environ.get('BENCH_CPUS', '8')}]"
    builder = (
        SparkSession.builder.master(master)
        .appName(app_name)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.sql.files.maxPartitionBytes", "16m")
        .config("spark.sql.files.openCostInBytes", "1m")
        .config("spark.driver.memory", "16g")
    )
    for key, value in (extra or {}).items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


# Sizing for the ~100 TB target (1000 executors).  Scans split at 256 MB; the
# first shuffle of a stage starts wide and AQE coalesces it to ~256 MB
# partitions, splits skewed ones (a key may hold a third of the rows) and
# turns a join into a broadcast only when the *measured* side is under 64 MB.
SCALE_DEFAULTS: dict[str, str] = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.initialPartitionNum": "16384",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "256m",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "5",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "256m",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "64m",
    "spark.sql.files.maxPartitionBytes": "256m",
    "spark.sql.session.timeZone": "UTC",
}


def apply_scale_defaults(spark: SparkSession, defaults: dict[str, str] = SCALE_DEFAULTS) -> None:
    """Apply ``defaults`` for every SQL setting the launch configuration did
    not set; settings given at submit time always win."""
    sc = _context(spark)
    for key, value in defaults.items():
        if sc is not None and sc.getConf().contains(key):
            continue
        if sc is None and spark.conf.get(key, None) not in (None, ""):
            continue
        spark.conf.set(key, value)


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared checkpoint folder of the cluster: ``spark.checkpoint.dir``
    as the session has it.  Where it is unset (tests), a folder below the SQL
    warehouse is set, which is shared by all executors too."""
    current = spark.conf.get(CHECKPOINT_CONF, None)
    if not current:
        current = os.path.join(spark.conf.get("spark.sql.warehouse.dir"), "_checkpoints")
        spark.conf.set(CHECKPOINT_CONF, current)
    return current


def _context(spark: SparkSession):
    """The SparkContext, or None where the session has none (Spark Connect)."""
    try:
        return spark.sparkContext
    except Exception:  # noqa: BLE001
        return None


#: ``spread`` multiplies the session's shuffle partitions by so much, up to
#: so many.
SPREAD, SPREAD_MOST = 4, 400


def spread(df: DataFrame, *cols: str) -> DataFrame:
    """Deal rows by the hash of ``cols`` over a number of partitions that AQE
    does not lower.

    AQE merges shuffle partitions up to a size in compressed bytes.  Sorting
    or hashing narrow rows with nearly as many keys as rows takes a multiple of
    that in memory, so such steps keep all partitions of the session, and
    some more where it has few.  Aggregates on ``cols`` (or more) that follow
    need no further shuffle."""
    conf = df.sparkSession.conf
    own = int(conf.get("spark.sql.shuffle.partitions"))
    initial = int(conf.get("spark.sql.adaptive.coalescePartitions.initialPartitionNum", None) or 0)
    return df.repartition(max(own, initial, min(SPREAD * own, SPREAD_MOST)), *cols)


def materialize(df: DataFrame, name: str = "table") -> DataFrame:
    """Cut lineage: write ``df`` once as a Parquet table in the shared
    checkpoint folder and return a reader of it.

    One job computes and writes the rows (an RDD checkpoint of an unpersisted
    plan would compute it twice); later branches read the files, with column
    pruning and filter pushdown, and a lost executor re-reads them instead of
    recomputing the plan above.
    """
    spark = df.sparkSession
    path = os.path.join(checkpoint_dir(spark), "ledgerlake", f"{name}-{uuid.uuid4().hex}")
    df.write.mode("error").parquet(path)
    return spark.read.parquet(path)
