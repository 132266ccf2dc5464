"""Session helpers: scale defaults and lineage cutting."""

from __future__ import annotations

import os

from ledgerlake.session import SCALE_DEFAULTS, apply_scale_defaults, checkpoint_dir, materialize


def test_scale_defaults_respect_launch_settings(spark):
    # shuffle partitions were set at launch by the test session; an unset key gets the default
    launched = spark.sparkContext.getConf()
    key = "spark.sql.adaptive.advisoryPartitionSizeInBytes"
    before = spark.conf.get(key)
    apply_scale_defaults(spark, {key: "256m", "spark.sql.shuffle.partitions": "999"})
    try:
        assert spark.conf.get("spark.sql.shuffle.partitions") == launched.get("spark.sql.shuffle.partitions")
        if not launched.contains(key):
            assert spark.conf.get(key) == "256m"
    finally:
        spark.conf.set(key, before)
    assert "spark.sql.adaptive.skewJoin.enabled" in SCALE_DEFAULTS


def test_materialize_writes_into_checkpoint_dir(spark):
    root = checkpoint_dir(spark)
    df = spark.range(10).withColumnRenamed("id", "x")
    out = materialize(df, "unit")
    assert sorted(r.x for r in out.collect()) == list(range(10))
    files = out.inputFiles()
    assert files and all(root.rstrip("/") in f for f in files)
    assert "LogicalRDD" not in out._jdf.queryExecution().analyzed().toString()
