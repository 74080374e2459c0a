from __future__ import annotations

import math
import random
from math import comb

import numpy as np
import pytest
from pyspark.sql import functions as F

from driftwell.functions.pvalues import chi_square_p, ks_exact_p, log_gamma, normal_two_sided_p
from driftwell.operators import drift
from driftwell.operators import counts
from driftwell.operators.counts import count_sides

SF = "/root/testdata/sf0.01"


def frame(spark, ref, cur, kind="double"):
    rows = [(x, True) for x in ref] + [(x, False) for x in cur]
    return spark.createDataFrame(rows, f"x {kind}, is_reference boolean")


def test_known_values_on_order_lines(spark):
    lines = spark.read.parquet(f"{SF}/lineitem.parquet")
    df = drift.mark(lines, F.col("l_shipdate") < F.lit("1999-01-01").cast("timestamp_ntz"))
    psi = drift.psi(df, ["l_extendedprice"]).first()["psi"]
    ks = drift.ks_two_sample(df, ["l_extendedprice"], p_method="asymptotic").first()
    assert round(psi, 6) == 0.000421
    assert round(ks["d"], 6) == 0.011911
    assert round(ks["p_value"], 4) == 0.0325


def test_identical_inputs_do_not_drift(spark):
    xs = [float(i) for i in range(100)]
    df = frame(spark, xs, xs)
    assert drift.psi(df, ["x"]).first()["psi"] == 0.0
    row = drift.ks_two_sample(df, ["x"], p_method="exact").first()
    assert (row["d"], row["p_value"], row["p_method"]) == (0.0, 1.0, "exact")
    report = drift.drift_report(df)
    assert not report.first()["drift"]
    rollup = drift.drift_rollup(report).first()
    assert (rollup["n_columns"], rollup["n_drift"], rollup["status"]) == (1, 0, "ESTABLE")


def test_constant_column_has_no_index(spark):
    assert drift.psi(frame(spark, [3.0] * 50, [3.0] * 20), ["x"]).first()["psi"] == 0.0


def test_disjoint_samples(spark):
    df = frame(spark, [float(i) for i in range(50)], [float(i) for i in range(100, 150)])
    row = drift.ks_two_sample(df, ["x"], p_method="exact").first()
    assert row["d"] == 1.0
    # Both orders of complete separation out of all arrangements.
    assert math.isclose(row["p_value"], 2 / comb(100, 50), rel_tol=1e-9)
    report = drift.drift_report(df)
    assert report.first()["drift"]
    assert drift.drift_rollup(report).first()["status"] == "CRÍTICO"


def test_index_by_value_matches_the_formula(spark):
    ref, cur = ["a"] * 6 + ["b"] * 4, ["a"] * 2 + ["b"] * 6 + ["c"] * 2
    got = drift.psi(frame(spark, ref, cur, "string"), ["x"]).first()
    shares = {"a": (0.6, 0.2), "b": (0.4, 0.6), "c": (1e-4, 0.2)}
    want = sum((c - b) * math.log(c / b) for b, c in shares.values())
    assert math.isclose(got["psi"], want, rel_tol=1e-12)
    assert got["classes"] == 3


def test_missing_is_a_class(spark):
    got = drift.psi(frame(spark, ["a", None], ["a", "a"], "string"), ["x"]).first()["psi"]
    want = (1.0 - 0.5) * math.log(2.0) + (1e-4 - 0.5) * math.log(1e-4 / 0.5)
    assert math.isclose(got, want, rel_tol=1e-12)


def test_unwidened_edges_send_outsiders_to_the_missing_class(spark):
    rng = random.Random(1)
    ref = [rng.random() for _ in range(500)]
    cur = [x + 0.5 for x in ref]
    df = frame(spark, ref, cur)
    wide = drift.psi(df, ["x"]).first()
    narrow = drift.psi(df, ["x"], widen_edges=False, binned="numeric").first()
    assert narrow["classes"] == wide["classes"] + 1
    lost = sum(x > max(ref) for x in cur) / 500
    assert lost > 0.4 and narrow["psi"] != wide["psi"]


@pytest.mark.parametrize("distinct,kind", [(20, "discrete"), (21, "continuous")])
def test_rule_is_more_than_twenty_values_with_missing_as_one(spark, distinct, kind):
    values = [float(i) for i in range(distinct - 1)] + [None]
    df = frame(spark, values * 3, values)
    assert drift.drift_report(df).first()["kind"] == kind
    counted = count_sides(df, ["x"], [], F.col("is_reference"))
    assert counted.facts["x"].distinct_a == distinct


def test_rule_by_type_and_typed_comparison(spark):
    ref = spark.createDataFrame([(1, "u"), (2, "v")] * 30, "code int, name string")
    cur = spark.createDataFrame([(1.0, "u"), (2.0, "v")] * 30, "code double, name string")
    df = drift.pair(ref, cur)
    rows = {r["column"]: r for r in drift.drift_report(df, rule="dtype").collect()}
    assert rows["code"]["metric"] == "ks_p_value" and rows["name"]["metric"] == "psi"
    by_value = {r["column"]: r for r in drift.drift_report(df).collect()}
    assert by_value["code"]["value"] == 0.0 and not by_value["code"]["drift"]


def test_report_equals_single_operators(spark):
    rng = random.Random(2)
    rows = [
        (rng.gauss(0, 1) + (i % 2), rng.randrange(4), "ab"[rng.randrange(2)], i % 2 == 0)
        for i in range(600)
    ]
    df = spark.createDataFrame(rows, "x double, k int, s string, is_reference boolean")
    report = {r["column"]: r["value"] for r in drift.drift_report(df).collect()}
    ks = drift.ks_two_sample(df, ["x"]).first()["p_value"]
    psi = {r["column"]: r["psi"] for r in drift.psi(df, ["k", "s"]).collect()}
    assert math.isclose(report["x"], ks, rel_tol=1e-9)
    assert math.isclose(report["k"], psi["k"], rel_tol=1e-9)
    assert math.isclose(report["s"], psi["s"], rel_tol=1e-9)


def test_report_of_text_columns_only(spark):
    df = frame(spark, ["a"] * 5, ["b"] * 5, "string")
    row = drift.drift_report(df).first()
    assert row["metric"] == "psi" and row["drift"]


def test_prediction_drift_flags_either(spark):
    rng = random.Random(5)
    ref = [rng.random() for _ in range(400)]
    same = drift.prediction_drift(frame(spark, ref, ref), "x").first()
    moved = drift.prediction_drift(frame(spark, ref, [x * x for x in ref]), "x").first()
    assert not same["drift"] and moved["drift_psi"] and moved["drift_ks"] and moved["drift"]


def test_non_numeric_ks_is_not_applicable(spark):
    row = drift.ks_two_sample(frame(spark, ["a"], ["b"], "string"), ["x"]).first()
    assert (row["d"], row["p_value"]) == (0.0, 1.0)


def test_empty_side(spark):
    row = drift.ks_two_sample(frame(spark, [1.0, 2.0], []), ["x"]).first()
    assert (row["d"], row["p_value"]) == (0.0, 1.0)


def all_paths(m, n, d):
    """Share of lattice paths that reach the distance, by listing them."""
    from itertools import combinations

    hit = 0
    for ups in combinations(range(m + n), m):
        x = y = 0
        for t in range(m + n):
            if t in ups:
                x += 1
            else:
                y += 1
            if abs(x / m - y / n) >= d - 1e-12:
                hit += 1
                break
    return hit / comb(m + n, m)


@pytest.mark.parametrize("m,n", [(3, 4), (5, 5), (2, 6)])
def test_exact_p_counts_paths(spark, m, n):
    steps = [(m, n, step / (m * n)) for step in range(1, m * n + 1)]
    df = spark.createDataFrame(steps, "m long, n long, d double")
    for r in df.withColumn("p", ks_exact_p(F.col("m"), F.col("n"), F.col("d"))).collect():
        assert math.isclose(r["p"], all_paths(m, n, r["d"]), abs_tol=1e-12)


def test_exact_p_of_nothing(spark):
    df = spark.createDataFrame([(None, 3, 0.5), (3, 3, None), (4, 5, 0.0)], "m long, n long, d double")
    assert [r[0] for r in df.select(ks_exact_p(F.col("m"), F.col("n"), F.col("d"))).collect()] == [None, None, 1.0]


def chi_tail(x, dof):
    """Finite sums that hold for even and for odd degrees of freedom."""
    half = x / 2
    odd = dof % 2
    terms = [(i + odd / 2) * math.log(half) - math.lgamma(i + 1 + odd / 2) - half for i in range((dof - odd) // 2)]
    return (math.erfc(math.sqrt(half)) if odd else 0.0) + sum(map(math.exp, terms))


def test_tails_by_other_formulas(spark):
    cases = [(x * dof, dof) for dof in (1, 2, 3, 5, 10, 51, 400, 3001) for x in (0.01, 0.5, 0.9, 1.0, 1.1, 1.5, 4.0)]
    cases += [(3.841458820694124, 1), (18.307038053275146, 10)]
    df = spark.createDataFrame([(float(x), k) for x, k in cases], "x double, k long")
    for r in df.withColumn("p", chi_square_p(F.col("x"), F.col("k"))).collect():
        assert math.isclose(r["p"], chi_tail(r["x"], r["k"]), rel_tol=1e-9, abs_tol=1e-11), r
    edge = spark.createDataFrame([(0.0, 3), (5.0, 0), (None, 2)], "x double, k long")
    assert [r[0] for r in edge.select(chi_square_p(F.col("x"), F.col("k"))).collect()] == [1.0, 1.0, None]
    z = spark.createDataFrame([(v,) for v in (0.0, 1e-9, 0.3, 1.96, 5.0, -8.0, 30.0)], "z double")
    for r in z.withColumn("p", normal_two_sided_p(F.col("z"))).collect():
        assert math.isclose(r["p"], math.erfc(abs(r["z"]) / math.sqrt(2)), rel_tol=1e-9, abs_tol=1e-14)
    a = spark.createDataFrame([(v,) for v in (0.5, 1.0, 3.7, 50.0, 1e5)], "a double")
    for r in a.withColumn("g", log_gamma(F.col("a"))).collect():
        assert math.isclose(r["g"], math.lgamma(r["a"]), rel_tol=1e-12, abs_tol=1e-12)


def test_series_agrees_with_exact_for_large_samples(spark):
    rng = random.Random(8)
    df = frame(spark, [rng.random() for _ in range(400)], [rng.random() ** 1.1 for _ in range(400)])
    exact = drift.ks_two_sample(df, ["x"], p_method="exact").first()["p_value"]
    series = drift.ks_two_sample(df, ["x"], p_method="asymptotic").first()["p_value"]
    assert abs(exact - series) < 0.06


@pytest.mark.parametrize("range_values", [3, 40, 10**6])
def test_one_count_in_ranges_of_any_size(spark, monkeypatch, range_values):
    """Quantiles, PSI and KS from the counts don't depend on how values are cut."""
    monkeypatch.setattr(counts, "RANGE_VALUES", range_values)
    rng = np.random.default_rng(5)
    ref, cur = np.round(rng.normal(0, 1, 400), 2), np.round(rng.normal(0.3, 1.2, 300), 2)
    rows = [(float(x), float(x) * 2 if i % 3 else None, "t", True) for i, x in enumerate(ref)]
    rows += [(float(x), None, "u", False) for x in cur]
    df = spark.createDataFrame(rows, "x double, y double, z string, is_reference boolean").repartition(4)
    side = F.col("is_reference")
    counted = count_sides(df, ["x", "y"], ["z"], side)
    if range_values < 100:
        assert len(counted.cuts["x"]) > 3
    got = counts.reference_quantiles(counted, ["x", "y"], [0.0, 0.1, 0.5, 0.77, 1.0])
    y = [float(x) * 2 for i, x in enumerate(ref) if i % 3]
    assert np.allclose(got["x"], np.quantile(ref, [0.0, 0.1, 0.5, 0.77, 1.0]))
    assert np.allclose(got["y"], np.quantile(y, [0.0, 0.1, 0.5, 0.77, 1.0]))
    tested = {r["column"]: r for r in drift.ks_two_sample(df, ["x", "y", "z"]).collect()}
    grid = np.unique(np.concatenate([ref, cur]))
    d = max(abs((ref <= g).mean() - (cur <= g).mean()) for g in grid)
    assert abs(tested["x"]["d"] - d) < 1e-12 and tested["y"]["d"] == 0.0 and tested["z"]["p_value"] == 1.0
    index = {r["column"]: r for r in drift.psi(df, ["x", "z"]).collect()}
    edges = np.quantile(ref, np.arange(11) / 10)
    bins = [np.bincount(np.searchsorted(edges[1:-1], v), minlength=10) / len(v) for v in (ref, cur)]
    b, c = (np.where(x > 0, x, 1e-4) for x in bins)
    assert abs(index["x"]["psi"] - ((c - b) * np.log(c / b)).sum()) < 1e-9
    assert index["z"]["classes"] == 2


def test_widest_range_follows_the_rows(spark, monkeypatch):
    """With few shuffle tasks, ranges are as many as the rows ask for."""
    from driftwell.operators import ordered

    monkeypatch.setattr(ordered, "RANGE_ROWS", 2_000)
    monkeypatch.setattr(ordered, "ONE_RANGE_ROWS", 1_000)
    df = spark.range(60_000).select(F.rand(3).alias("x"), (F.col("id") % 2 == 0).alias("is_reference"))
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "2")
    try:
        facts = ordered.pair_facts(df, ["x"], F.col("is_reference"))
        sizes = ordered.pair_counts(df, ["x"], F.col("is_reference"), facts).groupBy("slot").agg(F.sum(F.col("n_a") + F.col("n_b")).alias("n"))
        widest = sizes.agg(F.max("n")).first()[0]
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
    assert len(facts.cuts["x"]) == 29 and widest < 4_500
