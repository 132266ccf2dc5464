"""Plan-shape checks: the plans the engine relies on at scale."""

from __future__ import annotations

import re

from pyspark.sql import functions as F

from ledgerlake.operators import keep_canonical, next_values, pivot_wide, window_closes


def _plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def _parquet(spark, scratch, rows, schema, name="t"):
    path = f"{scratch}/{name}"
    spark.createDataFrame(rows, schema).write.parquet(path)
    return spark.read.parquet(path)


def test_canonical_filter_reaches_scan(spark, scratch):
    df = _parquet(spark, scratch, [("Assets", 1.0), ("Goodwill", 2.0)], "finType string, val double")
    plan = _plan(keep_canonical(df).select("val"))
    assert re.search(r"PushedFilters: \[[^\]]*In\(finType", plan)
    assert "ReadSchema: struct<finType:string,val:double>" in plan


def test_pivot_is_one_shuffle_with_partial_aggregate(spark, scratch):
    df = _parquet(spark, scratch, [("t", "a", 1.0), ("t", "b", 2.0)], "k string, tag string, v double")
    plan = _plan(pivot_wide(df, ["k"], "tag", "v", ["a", "b", "c"]))
    assert len(re.findall(r"Exchange hashpartitioning", plan)) == 1
    assert "partial_max" in plan


def test_bucketed_lead_shuffles_rows_once(spark, scratch):
    """The main rows go through one shuffle on (partition, bucket); the heads
    join must not re-partition them (struct keys keep the partitioning)."""
    df = _parquet(spark, scratch, [(i % 3, i, float(i)) for i in range(50)], "k int, t int, v double")
    out = next_values(df, ["k"], [F.col("t").asc()], ["v"], bucket=F.floor(F.col("t") / 10))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = _plan(out)
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert "hashpartitioning(coalesce(" not in plan  # no null-safe re-keying of the rows
    # rows (1) + heads input (1) + heads before the join (1); none between window and join
    assert len(re.findall(r"Exchange hashpartitioning\(_p#\d+, _bucket#\d+", plan)) == 3
    assert re.search(r"SortMergeJoin \[_p#\d+, _bucket#\d+\]", plan)


def test_price_window_joins_on_month_bucket(spark, scratch):
    facts = _parquet(spark, scratch, [("T", "2024-03-31")], "ticker string, reportDate string", "f")
    prices = _parquet(spark, scratch, [("T", "2024-01-02", 1.0)], "ticker string, date string, close double", "p")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = _plan(window_closes(facts, prices))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert re.search(r"SortMergeJoin \[_t#\d+, _mb#\d+, _whole#\d+\], \[_pt#\d+, _pmb#\d+, _month#\d+\], Inner", plan)
    assert "partial_min_by" in plan or "partial_min" in plan


def test_raw_tag_prefilter_reaches_scan(spark, scratch):
    from ledgerlake.operators import keep_rollup_canonical

    df = _parquet(spark, scratch, [("AssetsCurrent", 1.0), ("Goodwill", 2.0)], "finType string, val double", "raw")
    plan = _plan(keep_rollup_canonical(df))
    assert re.search(r"PushedFilters: \[[^\]]*In\(finType", plan)


def test_harvest_takes_the_years_of_the_orders(spark, tmp_path):
    from ledgerlake.plans.catalog import q_harvest

    spark.createDataFrame([(1,), (2,)], "c_custkey bigint").write.parquet(f"{tmp_path}/customer.parquet")
    orders = spark.createDataFrame(
        [(1, "1994-02-03", "O", "1-URGENT"), (1, "1998-05-06", "F", "2-HIGH"), (2, "2005-11-12", "O", "5-LOW"), (2, "2005-03-01", "P", "5-LOW"), (2, None, "O", "5-LOW")],
        "o_custkey bigint, o_orderdate string, o_orderstatus string, o_orderpriority string",
    ).withColumn("o_orderdate", F.col("o_orderdate").cast("date"))
    orders.write.parquet(f"{tmp_path}/orders.parquet")
    assert {r.transcriptID for r in q_harvest(spark, str(tmp_path)).collect()} == {"1994-Q1-C1", "1998-Q2-C1", "2005-Q4-C2"}
    orders.limit(0).write.mode("overwrite").parquet(f"{tmp_path}/orders.parquet")
    spark.catalog.clearCache()
    assert q_harvest(spark, str(tmp_path)).count() == 0


def test_price_windows_use_hash_aggregates_and_one_scan(spark, scratch):
    """Daily bars and monthly summaries come from one scan and one shuffle of
    the prices; no aggregate sorts."""
    bars = spark.range(3000).select(
        (F.col("id") % 3).cast("string").alias("ticker"), F.expr("date'2020-01-01' + cast(id div 3 % 700 as int)").alias("date"), F.col("id").cast("double").alias("close")
    )
    bars.write.parquet(f"{scratch}/bars")
    bars.select("ticker", F.last_day("date").alias("reportDate")).distinct().write.parquet(f"{scratch}/windows")
    out = window_closes(spark.read.parquet(f"{scratch}/windows"), spark.read.parquet(f"{scratch}/bars"))
    rows = out.collect()
    plan = _plan(out)
    plan = plan[plan.index("Final Plan") : plan.index("Initial Plan")]
    assert "SortAggregate" not in plan and "ReusedExchange" in plan
    assert len(re.findall(r"FileScan parquet \[ticker[^\]]*,close", plan)) == 1
    by_day = {}
    for r in bars.collect():
        by_day.setdefault((r.ticker, r.date), []).append(r.close)
    import datetime as dt

    for r in rows:
        m = r.reportDate.month - 3
        first = dt.date(r.reportDate.year - (m < 1), (m - 1) % 12 + 1, 1)
        last_of = (first.replace(day=28) + dt.timedelta(days=4)).replace(day=1) - dt.timedelta(days=1)
        start = min(first.replace(day=min(r.reportDate.day, last_of.day)), last_of)
        days = sorted(d for (t, d) in by_day if t == r.ticker and start <= d < r.reportDate)
        assert (r.first_close, r.last_close) == (min(by_day[r.ticker, days[0]]), max(by_day[r.ticker, days[-1]]))


def test_building_harvest_and_transcript_queries_runs_no_job(spark):
    """Building a query is planning only; no text crosses an exchange."""
    from ledgerlake.plans.catalog import CATALOG
    from tests.conftest import SF001

    tracker = spark.sparkContext.statusTracker()
    spark.sparkContext.setJobGroup("building", "building")
    for name in ("harvest", "transcript_join", "price_window", "company_facts"):
        CATALOG[name][0](spark, SF001)
    assert not tracker.getJobIdsForGroup("building")
    spark.sparkContext.setJobGroup("other", "other")
    plan = _plan(CATALOG["transcript_join"][0](spark, SF001))
    for block in plan.split("Exchange")[1:]:
        assert not re.match(r"[^\n]*text#", block)


def test_period_means_shuffle_statistics_and_detail_once(spark, scratch):
    from ledgerlake.operators import period_means

    rows = [(None if i % 5 == 0 else f"T{i % 4}", f"2024-{1 + i % 12:02d}-11", None if i % 7 == 0 else float(i)) for i in range(400)] + [("T1", None, 5.0)]
    df = _parquet(spark, scratch, rows, "ticker string, date string, v double")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        out = period_means(df, ["ticker"], "date", "v")
        plan = _plan(out)
        got = [tuple(r) for r in out.collect()]
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert plan.count("Exchange") == 2 and "Window" not in plan and "SortAggregate" not in plan and "partial_sum" in plan

    def mean(ticker, months):
        own = [v for t, d, v in rows if t == ticker and v is not None and (int(d[5:7]) if d else None) in months]
        return sum(own) / len(own) if own else None

    for t, d, _v, month, quarter in got:
        m = int(d[5:7]) if d else None
        assert month == mean(t, {m})
        want = mean(t, set(range((m - 1) // 3 * 3 + 1, (m - 1) // 3 * 3 + 4)) if m else {None})
        assert quarter == want or abs(quarter - want) < 1e-9
    assert len(got) == len(rows)


def test_steps_on_narrow_rows_keep_many_partitions(spark):
    """AQE does not merge the partitions in which nearly unique rows are sorted
    and hashed, and records of a document are built after the lines are dealt."""
    from ledgerlake.plans.catalog import CATALOG
    from tests.conftest import SF001

    for name, least in (("company_facts", 1), ("price_window", 3), ("classify", 3), ("class_names", 3), ("filings_fact", 2)):
        plan = _plan(CATALOG[name][0](spark, SF001))
        dealt = re.findall(r"hashpartitioning\(.*, (\d+)\), REPARTITION_BY_NUM", plan)
        assert len(dealt) >= least and set(dealt) == {"16"}, name
    assert CATALOG["price_window"][0](spark, SF001).rdd.getNumPartitions() == 16


def test_windows_are_not_broadcast(spark, scratch):
    """A small file of windows lists four rows a window: it is not broadcast."""
    windows = _parquet(spark, scratch, [("a", "2024-03-31")], "ticker string, reportDate string", "windows")
    bars = _parquet(spark, scratch, [("a", "2024-01-02", 1.0), ("a", "2024-03-05", 2.0), ("a", "2024-03-31", 3.0)], "ticker string, date string, close double", "bars")
    out = window_closes(windows, bars)
    assert [(r.ticker, r.first_close, r.last_close) for r in out.collect()] == [("a", 1.0, 2.0)]
    assert "Broadcast" not in _plan(out)
