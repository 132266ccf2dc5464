"""Date spine and calendar dimension (SRC13 + SCL13)."""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerlake import fixed
from ledgerlake.functions.scalars import calendar_parts


def date_spine(spark: SparkSession, start: str = fixed.CALENDAR_START, end: str = fixed.CALENDAR_END) -> DataFrame:
    """Every day in [start, end] as column ``d``, generated by ``spark.range``
    (split over tasks, no driver-side list)."""
    n_days = (date.fromisoformat(end) - date.fromisoformat(start)).days + 1
    return spark.range(n_days).select(F.date_add(F.to_date(F.lit(start)), F.col("id").cast("int")).alias("d"))


def calendar_dim(spark: SparkSession, start: str = fixed.CALENDAR_START, end: str = fixed.CALENDAR_END) -> DataFrame:
    """The calendar dimension: date text, day, month, year, day_of_week
    (Monday 0), day_name, month_name, ISO week, quarter, is_weekend."""
    spine = date_spine(spark, start, end)
    return spine.select(*[c.alias(n) for n, c in calendar_parts("d").items()])


def calendar_for(df: DataFrame, date_col: str) -> DataFrame:
    """Calendar dimension spanning the dates of ``df[date_col]``.

    The bounds come from one aggregate; the span is generated from them with
    ``sequence`` -- its size is the number of days between the bounds, not
    the number of rows.
    """
    bounds = df.agg(F.min(F.to_date(F.col(date_col))).alias("lo"), F.max(F.to_date(F.col(date_col))).alias("hi"))
    spine = bounds.select(F.explode(F.sequence("lo", "hi", F.expr("INTERVAL 1 DAY"))).alias("d"))
    return spine.select(*[c.alias(n) for n, c in calendar_parts("d").items()])
