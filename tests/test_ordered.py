from __future__ import annotations

import math
import random

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from driftwell.operators.ordered import (
    dense_index,
    pair_counts,
    pair_facts,
    pair_walk,
    quantiles,
    rank_values,
    running_counts,
)


def numbers(n, seed, hot=0.0):
    rng = random.Random(seed)
    return [7.0 if rng.random() < hot else round(rng.gauss(0, 100), 2) for _ in range(n)]


@pytest.mark.parametrize("walk_limit", [10**6, 50])
@pytest.mark.parametrize("hot", [0.0, 0.4])
def test_ranks_equal_sorting(spark, walk_limit, hot):
    xs = numbers(3000, 1, hot)
    df = spark.createDataFrame([(x,) for x in xs], "x double").repartition(5)
    ranks = [1, 2, 31, 1500, 2971, 2999, 3000]
    got = rank_values(df, {"x": (F.col("x"), ranks)}, walk_limit=walk_limit)["x"]
    want = sorted(xs)
    assert got == {k: want[k - 1] for k in ranks}


def test_ranks_out_of_bounds_and_missing(spark):
    df = spark.createDataFrame(
        [(1.0,), (None,), (float("nan"),), (2.0,)], "x double"
    )
    got = rank_values(df, {"x": (F.col("x"), [0, 1, 2, 3])})["x"]
    assert got == {1: 1.0, 2: 2.0}


@pytest.mark.parametrize("walk_limit", [10**6, 20])
def test_ranks_with_extreme_spread(spark, walk_limit):
    xs = [1e-300 * i for i in range(200)] + [1e300, -1e300, 0.0, 5e200]
    df = spark.createDataFrame([(x,) for x in xs], "x double")
    want = sorted(xs)
    ranks = [1, 2, 120, 203, 204]
    got = rank_values(df, {"x": (F.col("x"), ranks)}, walk_limit=walk_limit)["x"]
    assert got == {k: want[k - 1] for k in ranks}


def test_even_median_is_the_midpoint(spark):
    df = spark.createDataFrame([(x,) for x in (1.0, 2.0, 3.0, 4.0)], "x double")
    assert quantiles(df, {"x": (F.col("x"), [0.5])})["x"] == [2.5]


def brute_pair(a, b):
    values = sorted(set(a) | set(b))
    d = max(
        abs(sum(x <= v for x in a) / len(a) - sum(x <= v for x in b) / len(b)) for v in values
    )
    u = sum((x > y) + 0.5 * (x == y) for x in a for y in b)
    return d, u


small = st.lists(st.integers(-5, 5).map(float), min_size=1, max_size=25)


@settings(max_examples=5, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(a=small, b=small, buckets=st.sampled_from([1, 3, 8]))
def test_walk_equals_brute_force(spark, a, b, buckets):
    df = spark.createDataFrame([(x, True) for x in a] + [(x, False) for x in b], "x double, side boolean")
    side = F.col("side")
    facts = pair_facts(df, ["x"], side, buckets)
    # Any cuts must give the same answer, the sampled ones as well as these.
    for cuts in (facts.cuts["x"], [-2.0, 0.0, 3.0]):
        facts.cuts["x"] = cuts
        row = pair_walk(pair_counts(df, ["x"], side, facts), facts).first()
        d, u = brute_pair(a, b)
        assert math.isclose(row["d"], d, abs_tol=1e-12)
        assert math.isclose(row["u"], u, abs_tol=1e-9)
        assert (row["distinct_a"], row["distinct_b"]) == (len(set(a)), len(set(b)))


def test_walk_ignores_missing_in_order_but_counts_it_as_a_value(spark):
    rows = [(1.0, True), (None, True), (2.0, False), (float("nan"), False)]
    df = spark.createDataFrame(rows, "x double, side boolean")
    facts = pair_facts(df, ["x"], F.col("side"))
    row = pair_walk(pair_counts(df, ["x"], F.col("side"), facts), facts).first()
    assert (row["n_a"], row["n_b"], row["d"]) == (1, 1, 1.0)
    assert (row["distinct_a"], row["distinct_b"]) == (2, 2)


def test_hot_value_is_one_row_of_the_walk(spark):
    df = spark.range(60000).select(
        F.when(F.col("id") % 3 == 0, 5.0).otherwise(F.col("id").cast("double")).alias("x"),
        (F.col("id") % 2 == 0).alias("side"),
    )
    facts = pair_facts(df, ["x"], F.col("side"), 8)
    counts = pair_counts(df, ["x"], F.col("side"), facts)
    assert counts.where("value = 5.0").count() == 1
    widest = counts.groupBy("slot").count().agg(F.max("count")).first()[0]
    assert widest < counts.count() / 3


@pytest.mark.parametrize("descending", [True, False])
def test_running_counts(spark, descending):
    rng = random.Random(3)
    rows = [(float(v), rng.randrange(5), rng.randrange(5)) for v in range(40)]
    df = spark.createDataFrame(
        [(int(v // 7), v, a, b) for v, a, b in rows], "range int, value double, n_a long, n_b long"
    )
    got = {r["value"]: r for r in running_counts(df, descending).collect()}
    order = sorted(rows, reverse=descending)
    a = b = 0
    for i, (v, n_a, n_b) in enumerate(order):
        a, b = a + n_a, b + n_b
        nxt = order[i + 1][1:] if i + 1 < len(order) else (None, None)
        r = got[v]
        assert (r["run_a"], r["run_b"]) == (a, b)
        assert (r["next_a"], r["next_b"]) == nxt
        assert r["first"] == (i == 0)


def test_dense_index_is_a_permutation(spark):
    df = spark.range(1000).withColumn("u", F.rand(5))
    df = spark.createDataFrame(df.collect(), df.schema)
    rows = dense_index(df, "u", ["id"], "k", 16).orderBy("k").collect()
    assert [r["k"] for r in rows] == list(range(1, 1001))
    draws = [r["u"] for r in rows]
    assert draws == sorted(draws)


def test_plans_have_no_single_partition_window_over_rows(spark):
    df = spark.range(1000).select(F.rand(1).alias("x"), (F.col("id") % 2 == 0).alias("side"))
    facts = pair_facts(df, ["x"], F.col("side"))
    plan = pair_walk(pair_counts(df, ["x"], F.col("side"), facts), facts)
    text = plan._jdf.queryExecution().executedPlan().toString()
    assert "SinglePartition" not in text
    assert "CartesianProduct" not in text and "BroadcastNestedLoopJoin" not in text
