"""Order- and period-dependent operators (WIN1, SCL19, AGG2, WIN2).

Scale notes
-----------
WIN1 needs the *next* row of each row within a ticker.  A plain
``lead().over(partitionBy(ticker))`` sends a whole ticker to one task, so a
ticker holding a third of the data would run in one task.  ``next_values``
therefore splits each partition into ordered buckets: ``lead`` runs inside
(partition, bucket) windows, and the last row of a bucket takes the first row
of the following bucket from a small table of bucket heads (one row per
partition and bucket).  The big side is shuffled once; the join that brings
in the heads reuses that partitioning.

AGG2 aggregates before it joins: one row per key and quarter with the sums and
counts of its three months (one hash aggregate, combined map-side), then one
join of the detail rows to that table on the same key.  The statistics are
shuffled once and the detail once, or not at all where the table is measured
small; a hot key is split by AQE's skew join.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerlake import fixed
from ledgerlake.functions.scalars import full_year_as_q4, month_steps, days_between
from ledgerlake.operators.joins import null_safe_join


def next_values(
    df: DataFrame,
    partition_cols: Sequence[str],
    order: Sequence[Column],
    cols: Sequence[str],
    bucket: Column | None = None,
    bucket_ascending: bool = True,
    prefix: str = "_next_",
    has_next_col: str = "_has_next",
) -> DataFrame:
    """Add ``prefix + c``: the value of ``c`` on the next row in ``order``
    within ``partition_cols``, and ``has_next_col``.

    ``bucket`` must be monotone along ``order`` (e.g. the year of the leading
    order date) and ``bucket_ascending`` must state its direction; the order
    must be total for the result to be deterministic.

    Plan: the rows are shuffled once on (partition, bucket) and the heads
    join reuses that partitioning.  The heads branch reads the input a second
    time and shuffles a narrow projection of it; callers with an expensive
    input write it once first (``session.materialize``), as the fact build does.
    """
    if bucket is None:
        w = Window.partitionBy(*partition_cols).orderBy(*order)
        return df.withColumns(
            {**{prefix + c: F.lead(c).over(w) for c in cols}, has_next_col: F.lead(F.lit(True)).over(w).isNotNull()}
        )

    # Struct keys: a struct is never null and compares null fields as equal,
    # so a plain equi-join on them keeps null partition values together and
    # reuses the window's hash partitioning (no second shuffle of the rows).
    keys = ["_p", "_bucket"]
    d = df.withColumns({"_p": F.struct(*partition_cols), "_bucket": F.struct(bucket.alias("b"))})
    w = Window.partitionBy(*keys).orderBy(*order)
    d = d.withColumns(
        {
            # lag-based flag rather than row_number() == 1: a rank filter would be
            # rewritten into a group limit and stop the two branches sharing the shuffle.
            "_first": F.lag(F.lit(True)).over(w).isNull(),
            "_in_bucket_next": F.lead(F.lit(True)).over(w).isNotNull(),
            **{f"_lead_{c}": F.lead(c).over(w) for c in cols},
        }
    )
    heads = d.filter(F.col("_first")).select(*keys, *[F.col(c).alias(f"_head_{c}") for c in cols])
    bo = F.col("_bucket").asc() if bucket_ascending else F.col("_bucket").desc()
    wb = Window.partitionBy("_p").orderBy(bo)
    next_heads = heads.select(
        *keys,
        F.lead(F.lit(True)).over(wb).isNotNull().alias("_next_bucket"),
        *[F.lead(f"_head_{c}").over(wb).alias(f"_nh_{c}") for c in cols],
    )
    joined = d.join(next_heads, keys, "left")
    inside = F.col("_in_bucket_next")
    out = joined.withColumns(
        {
            **{prefix + c: F.when(inside, F.col(f"_lead_{c}")).otherwise(F.col(f"_nh_{c}")) for c in cols},
            has_next_col: inside | F.coalesce(F.col("_next_bucket"), F.lit(False)),
        }
    )
    drop = [*keys, "_first", "_in_bucket_next", "_next_bucket"]
    drop += [f"_lead_{c}" for c in cols] + [f"_nh_{c}" for c in cols]
    return out.drop(*drop)


def decumulate(
    df: DataFrame,
    partition_cols: Sequence[str] = ("ticker",),
    order: Sequence[Column] | None = None,
    period_col: str = "financialPeriod",
    value_cols: Sequence[str] = fixed.FLOW_METRICS,
    bucket: Column | str | None = "auto",
    bucket_ascending: bool = True,
    cumulative_periods: Sequence[str] = fixed.CUMULATIVE_PERIODS,
    prior_periods: Sequence[str] = fixed.PRIOR_PERIODS,
    rename_full_year: bool = True,
) -> DataFrame:
    """WIN1 + SCL19: year-to-date values -> quarter values.

    In row order within each partition, a row reporting Q2/Q3/FY followed by a
    row reporting Q1/Q2/Q3 gets ``value - next value`` for every value column
    where both are non-null (the next row's *original* value).  No same-year
    check is made, as in the original job.  Then FY becomes Q4.

    Default order when none is given: the filing list's ticker and position if present,
    else filing date and accession descending; then period, filing date and
    period end ascending.  ``bucket="auto"`` splits each partition along that
    default order (list position in blocks of 256, else the filing month), so
    no company runs in one task; with a custom ``order`` it means no split --
    pass a bucket that is monotone along the custom order instead.
    """
    auto = isinstance(bucket, str) and bucket == "auto"
    if auto:
        bucket = None
    if order is None:
        if "filing_pos" in df.columns:
            lead = [F.col("filing_pos").asc()]
            block = F.floor(F.col("filing_pos") / 256)
            if "filing_ticker" in df.columns:  # a submission listed by two tickers: one list after the other
                lead = [F.col("filing_ticker").asc(), *lead]
                block = F.struct(F.col("filing_ticker").alias("t"), block.alias("b"))
            if auto:
                bucket, bucket_ascending = block, True
        else:
            lead = [F.col("filingDate").desc(), F.col("accessionNumber").desc()]
            if auto:
                bucket, bucket_ascending = F.trunc("filingDate", "month"), False
        order = [*lead, F.col(period_col).asc(), F.col("filingDate").asc(), F.col("endDate").asc()]
        if "filing_pos" in df.columns:
            order.append(F.col("accessionNumber").asc())
    cols = [period_col, *value_cols]
    d = next_values(df, partition_cols, order, cols, bucket, bucket_ascending)
    applies = (
        F.col("_has_next")
        & F.col(period_col).isin(list(cumulative_periods))
        & F.col(f"_next_{period_col}").isin(list(prior_periods))
    )
    updates = {}
    for c in value_cols:
        nxt = F.col(f"_next_{c}")
        updates[c] = F.when(applies & F.col(c).isNotNull() & nxt.isNotNull(), F.col(c) - nxt).otherwise(F.col(c))
    if rename_full_year:
        updates[period_col] = full_year_as_q4(period_col)
    return d.withColumns(updates).drop("_has_next", *[f"_next_{c}" for c in cols])


def period_means(
    df: DataFrame,
    key_cols: Sequence[str],
    date_col: str,
    value_col: str,
    quarter_out: str = "quarter_mean",
    month_out: str = "month_mean",
    decimal_scale: int | None = None,
) -> DataFrame:
    """AGG2: mean of ``value_col`` per key and calendar quarter and per key and
    calendar month, attached to every row.  Nulls are skipped.

    ``decimal_scale`` sums exactly in fixed point: each value is scaled by
    10**scale, rounded to a BIGINT and summed as an integer, so the mean is
    independent of how rows are split across tasks (for values with at most
    that many decimals).  It equals a DECIMAL(18, scale) sum but stays on
    primitive longs instead of arbitrary-precision decimals.
    """
    d = F.to_date(F.col(date_col))
    # Struct key: never null, null fields compare as equal, and the aggregate's
    # partitioning on it serves the join.
    key = F.struct(*key_cols, F.year(d).alias("_y"), F.quarter(d).alias("_q"))
    base = df.withColumns({"_k": key, "_slot": F.coalesce((F.month(d) - 1) % 3, F.lit(0))})  # rows without a date are a group
    v = F.col(value_col).cast("double")
    unit = 1.0
    if decimal_scale is not None:
        unit = float(10**decimal_scale)
        v = F.round(v * unit).cast("bigint")
    # One row per quarter, with sum and count of each of its three months.
    months = range(3)
    of_month = [F.when(F.col("_slot") == i, v) for i in months]
    stats = base.groupBy("_k").agg(
        *[F.sum(of_month[i]).alias(f"_s{i}") for i in months], *[F.count(of_month[i]).alias(f"_n{i}") for i in months]
    )

    def mean(total: Column, n: Column) -> Column:
        return F.when(n > 0, total.cast("double") / unit / n)

    zero = F.lit(0)
    whole = sum((F.coalesce(F.col(f"_s{i}"), zero) for i in months), zero)
    stats = stats.select(
        "_k",
        F.array(*[mean(F.col(f"_s{i}"), F.col(f"_n{i}")) for i in months]).alias("_months"),
        mean(whole, sum((F.col(f"_n{i}") for i in months), zero)).alias(quarter_out),
    )
    out = base.join(stats, "_k", "left").withColumn(month_out, F.get("_months", F.col("_slot")))
    return out.select(*df.columns, month_out, quarter_out)


def start_presence(df: DataFrame, group_cols: Sequence[str], start_col: str = "start", out_col: str = "_has_start") -> DataFrame:
    """WIN2: whether any row of the group has a non-null start.

    Aggregate-then-join instead of a window so a hot group is pre-aggregated
    map-side rather than buffered in one task.
    """
    flags = df.groupBy(*group_cols).agg(F.max(F.col(start_col).isNotNull()).alias(out_col))
    return null_safe_join(df, flags, list(group_cols), "left")


def month_window(
    df: DataFrame,
    group_cols: Sequence[str],
    start_col: str = "start",
    end_col: str = "end",
    out_col: str = "monthWindow",
) -> DataFrame:
    """SCL5 + SCL2 under WIN2: 30-day steps between start and end; a record
    without start gives 0, and a group where no record has a start gives null."""
    flagged = start_presence(df, group_cols, start_col)
    steps = month_steps(days_between(end_col, start_col))
    return flagged.withColumn(out_col, F.when(F.col("_has_start"), steps)).drop("_has_start")
