"""Property tests with generated inputs."""

from __future__ import annotations

import math

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from ledgerlake.functions import change_class, percent_change
from ledgerlake.operators import next_values, union_all_by_name

SETTINGS = settings(max_examples=15, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])


def _expected_class(p):
    if p is None or math.isnan(p):
        return None
    if p < -5:
        return 1
    if p < -2:
        return 2
    if p < 0:
        return 3
    if p == 0:
        return 4
    if p <= 2:
        return 5
    if p <= 5:
        return 6
    return 7


@SETTINGS
@given(st.lists(st.one_of(st.none(), st.floats(allow_nan=True, allow_infinity=True, width=64)), min_size=1, max_size=40))
def test_class_matches_rule(spark, values):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, p double")
    got = {r.i: r.c for r in df.select("i", change_class("p").alias("c")).collect()}
    assert got == {i: _expected_class(v) for i, v in enumerate(values)}


@SETTINGS
@given(st.lists(st.tuples(st.floats(-1e6, 1e6), st.floats(-1e6, 1e6)), min_size=1, max_size=30))
def test_percent_change_matches_python(spark, pairs):
    df = spark.createDataFrame([(i, a, b) for i, (a, b) in enumerate(pairs)], "i int, f double, l double")
    got = {r.i: r.p for r in df.select("i", percent_change("f", "l").alias("p")).collect()}
    for i, (a, b) in enumerate(pairs):
        if b != 0:
            assert math.isclose(got[i], (a - b) * 100 / b, rel_tol=1e-12, abs_tol=1e-12)
        elif a == 0:
            assert math.isnan(got[i])
        else:
            assert got[i] == math.copysign(math.inf, a)


@SETTINGS
@given(
    st.lists(st.tuples(st.sampled_from(["a", "b", None]), st.integers(0, 30)), min_size=1, max_size=60),
    st.integers(1, 9),
)
def test_bucketed_lead_equals_window(spark, rows, width):
    data = [(k, t, i) for i, (k, t) in enumerate(rows)]
    df = spark.createDataFrame(data, "k string, t int, id int")
    order = [F.col("t").asc(), F.col("id").desc()]
    plain = next_values(df, ["k"], order, ["id"]).select("id", "_next_id", "_has_next")
    bucketed = next_values(df, ["k"], order, ["id"], bucket=F.floor(F.col("t") / width)).select("id", "_next_id", "_has_next")
    assert sorted(plain.collect()) == sorted(bucketed.collect())


@SETTINGS
@given(st.integers(0, 20), st.integers(0, 20))
def test_union_count_is_sum(spark, n, m):
    a = spark.range(n).select(F.col("id").alias("k"), F.lit("x").alias("s"))
    b = spark.range(m).select(F.col("id").alias("k"))
    assert union_all_by_name(a, b).count() == n + m
