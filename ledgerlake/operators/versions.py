"""The newest of several landed versions of a document or row."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def newest(df: DataFrame, keys: Sequence[str], time_col: str, tie_col: str) -> DataFrame:
    """Rows of the newest version of each key: largest ``time_col``
    (timestamp), then largest ``tie_col`` (bigint); nulls count as oldest.

    Time and tie are packed into one DECIMAL(38,0).  That is a fixed-width
    value, so the maximum per key is a hash aggregate, combined before the
    shuffle, and only (key, order) pairs are grouped: no window, no sort and no
    document in an aggregation buffer.  The rows of the winning order then come
    back through a semi-join.  Null keys are a key.  Rows that share key, time
    and tie are one version and all stay.
    """
    time = F.coalesce(F.unix_micros(F.col(time_col).cast("timestamp")), F.lit(-(1 << 62)))
    tie = F.coalesce(F.col(tie_col).cast("bigint"), F.lit(-(1 << 63)))
    order = time.cast("decimal(19,0)") * F.expr("18446744073709551616BD") + tie.cast("decimal(19,0)")
    ordered = df.withColumn("_order", order.cast("decimal(38,0)"))
    best = ordered.groupBy(*[F.col(k).alias(f"_k{i}") for i, k in enumerate(keys)]).agg(F.max("_order").alias("_best"))
    same = [F.col(k).eqNullSafe(F.col(f"_k{i}")) for i, k in enumerate(keys)]
    return ordered.join(best, reduce(lambda a, b: a & b, same, F.col("_order") == F.col("_best")), "left_semi").drop("_order")
