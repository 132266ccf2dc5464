"""Data-quality operators (DQ1, DQ2, AGG6, AGG7).

DQ1 is one aggregation pass for the per-column rules plus one grouped count
for the duplicate-key rule; the report is a handful of rows, so only the
report (never the data) reaches the driver in ``raise_if_failed``.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerlake import fixed
from ledgerlake.functions.scalars import any_null


def null_counts(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """AGG7: one row with the null count of each column."""
    return df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in cols])


def duplicate_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """AGG6: keys that occur more than once (nulls compare equal), with counts."""
    return df.groupBy(*keys).count().filter(F.col("count") > 1)


def validate(
    df: DataFrame,
    required: Sequence[str] = fixed.REQUIRED_COLUMNS,
    date_cols: Sequence[str] = ("reportDate", "filingDate"),
    class_col: str | None = "stockPriceChange",
    allowed: Sequence[int] = fixed.ALLOWED_CLASSES,
    key: Sequence[str] = fixed.DUPLICATE_KEY,
) -> DataFrame:
    """DQ1: rule report ``(rule, violations, passed)``.

    Rules: each required column non-null; each date column parses; the class
    column is in ``allowed`` (null fails); no duplicate of ``key`` (rows after
    the first occurrence are counted).
    """
    checks: list[tuple[str, object]] = []
    for c in required:
        checks.append((f"not_null:{c}", F.count_if(F.col(c).isNull())))
    for c in date_cols:
        bad = F.col(c).isNotNull() & F.try_to_date(F.col(c).cast("string")).isNull()
        checks.append((f"date_parses:{c}", F.count_if(bad)))
    if class_col is not None:
        ok = F.coalesce(F.col(class_col).isin(list(allowed)), F.lit(False))
        checks.append((f"allowed_values:{class_col}", F.count_if(~ok)))
    names = [name for name, _ in checks]
    one_row = df.agg(*[expr.alias(f"_c{i}") for i, (_, expr) in enumerate(checks)])
    stacked = one_row.select(
        F.explode(
            F.array(*[F.struct(F.lit(n).alias("rule"), F.col(f"_c{i}").cast("bigint").alias("violations")) for i, n in enumerate(names)])
        ).alias("r")
    ).select("r.rule", "r.violations")
    dup = (
        duplicate_keys(df, key)
        .agg(F.coalesce(F.sum(F.col("count") - 1), F.lit(0)).cast("bigint").alias("violations"))
        .select(F.lit("unique:" + ",".join(key)).alias("rule"), "violations")
    )
    return stacked.unionByName(dup).withColumn("passed", F.col("violations") == 0)


def raise_if_failed(report: DataFrame) -> None:
    """Raise ValueError listing every failed rule (the report is a few rows)."""
    failed = [r for r in report.collect() if not r["passed"]]
    if failed:
        lines = [f"{r['rule']}: {r['violations']} rows" for r in failed]
        raise ValueError("validation failed:\n" + "\n".join(lines))


def missing_data_flags(
    df: DataFrame,
    keys: Sequence[str] = fixed.VALIDATION_KEYS,
    flags: Sequence[str] = fixed.VALIDATION_FLAGS,
) -> DataFrame:
    """DQ2: rows with any null in ``flags``; keys plus one is-null flag per
    column; distinct."""
    return (
        df.filter(any_null(list(flags)))
        .select(*keys, *[F.col(c).isNull().alias(c) for c in flags])
        .dropDuplicates()
    )
