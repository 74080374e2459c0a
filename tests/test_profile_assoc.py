from __future__ import annotations

import math
import random

import pytest
from pyspark.sql import functions as F

from driftwell.operators import assoc, profile


def rows_of(df, key="column"):
    return {r[key]: r for r in df.collect()}


def test_null_profile_counts_nan_as_missing(spark):
    df = spark.createDataFrame([(1.0, "a"), (float("nan"), None), (None, "b")], "x double, s string")
    got = rows_of(profile.null_profile(df))
    assert (got["x"]["non_null"], got["x"]["nulls"]) == (1, 2)
    assert (got["s"]["non_null"], got["s"]["dtype"]) == (2, "string")


def test_value_counts_keep_missing(spark):
    df = spark.createDataFrame([("a",), ("a",), (None,), ("b",)], "s string")
    got = {r["value"]: (r["n"], r["share"]) for r in profile.value_counts(df).collect()}
    assert got == {"a": (2, 0.5), None: (1, 0.25), "b": (1, 0.25)}
    assert profile.distinct_counts(df).first()["distinct_values"] == 3


def test_describe(spark):
    df = spark.createDataFrame([(1.0,), (2.0,), (4.0,), (None,), (9.0,)], "x double")
    row = profile.describe_numeric(df, ["x"]).first()
    assert (row["count"], row["mean"], row["min"], row["max"]) == (4, 4.0, 1.0, 9.0)
    assert (row["q25"], row["q50"], row["q75"]) == (1.75, 3.0, 5.25)
    assert math.isclose(row["std"], math.sqrt(38 / 3))


def test_comparisons_keep_columns_of_either_side(spark):
    a = spark.createDataFrame([(1, "x")], "k int, only_a string")
    b = spark.createDataFrame([(1, 2.0)], "k int, only_b double")
    got = rows_of(profile.compare_schemas(a, b))
    assert set(got) == {"k", "only_a", "only_b"}
    assert got["only_b"]["dtype_original"] is None and got["only_b"]["dtype_modified"] == "double"


def test_histogram_covers_every_row(spark):
    df = spark.createDataFrame([(float(i * i),) for i in range(101)], "x double")
    rows = sorted(profile.histogram(df, ["x"], 20).collect(), key=lambda r: r["bin"])
    assert len(rows) == 20 and sum(r["n"] for r in rows) == 101
    assert rows[0]["lo"] == 0.0 and rows[-1]["hi"] == 10000.0
    assert rows[0]["n"] == sum(i * i < 500 for i in range(101))


def test_histogram_of_a_constant_and_of_nothing(spark):
    df = spark.createDataFrame([(3.0, None), (3.0, None)], "x double, y double")
    rows = profile.histogram(df, ["x", "y"]).collect()
    assert [(r["column"], r["n"]) for r in rows] == [("x", 2)]


def test_correlation_is_pairwise_complete(spark):
    df = spark.createDataFrame(
        [(1.0, 2.0, 5.0), (2.0, 4.0, None), (3.0, 6.0, 5.0), (4.0, None, 5.0)],
        "a double, b double, c double",
    )
    got = {(r["column_a"], r["column_b"]): r["r"] for r in profile.correlation_matrix(df, ["a", "b", "c"]).collect()}
    assert math.isclose(got["a", "b"], 1.0) and got["b", "a"] == got["a", "b"]
    assert got["a", "a"] == 1.0 and got["a", "c"] is None and got["c", "c"] is None
    assert len(got) == 9


def test_crosstab_shares_add_up(spark):
    df = spark.createDataFrame([("a", 0), ("a", 1), ("a", 1), ("b", 0)], "c string, y int")
    got = {(r["value"], r["label"]): r["row_share"] for r in profile.crosstab(df, ["c"], "y").collect()}
    assert math.isclose(got["a", "1"], 2 / 3) and got["b", "0"] == 1.0
    wide = rows_of(profile.crosstab_wide(df, "c", "y", [0, 1]), "c")
    assert (wide["b"]["n_1"], wide["b"]["share_0"]) == (0, 1.0)


def test_box_numbers(spark):
    xs = [1.0, 2.0, 3.0, 4.0, 100.0]
    df = spark.createDataFrame([(x, 1) for x in xs] + [(5.0, 0)], "x double, y int")
    got = rows_of(profile.box_stats(df, ["x"], "y", [0, 1]), "label")
    one = got["1"]
    assert (one["q25"], one["q50"], one["q75"]) == (2.0, 3.0, 4.0)
    assert (one["whisker_lo"], one["whisker_hi"], one["outliers"]) == (1.0, 4.0, 1)
    assert got["0"]["n"] == 1


@pytest.mark.parametrize("limit", [profile.BROADCAST_ROWS, 1])
def test_decoding_by_broadcast_and_by_shuffle(spark, monkeypatch, limit):
    monkeypatch.setattr(profile, "BROADCAST_ROWS", limit)
    book = spark.createDataFrame(
        [("status", "1", "low"), ("status", "2", "high"), ("job", "1", "none")],
        "column string, code string, label string",
    )
    df = spark.createDataFrame([(1, 1), (2, 9)], "status int, job int")
    out = profile.decode_labels(df, book, {"status": "status_label", "job": "job_label"}, "N/A")
    got = {r["status"]: (r["status_label"], r["job_label"]) for r in out.collect()}
    assert got == {1: ("low", "none"), 2: ("high", "N/A")}


def test_unpivot(spark):
    df = spark.createDataFrame([(0.1, 0.9)], "a double, b double")
    got = {tuple(r) for r in profile.unpivot_scores(df, {"a": "Referencia", "b": "Actual"}).collect()}
    assert got == {("Referencia", 0.1), ("Actual", 0.9)}


def test_mann_whitney_by_hand(spark):
    ones, zeros = [3.0, 5.0, 5.0, 8.0, 9.0], [1.0, 3.0, 4.0, 5.0]
    df = spark.createDataFrame([(x, 1) for x in ones] + [(x, 0) for x in zeros], "x double, y int")
    row = assoc.mann_whitney(df, ["x"], "y").first()
    u = sum((a > b) + 0.5 * (a == b) for a in ones for b in zeros)
    assert row["u"] == u
    ties = (2**3 - 2) + (3**3 - 3)
    spread = math.sqrt(5 * 4 / 12 * (10 - ties / (9 * 8)))
    z = (max(u, 20 - u) - 10 - 0.5) / spread
    assert math.isclose(row["z"], z)
    assert math.isclose(row["p_value"], math.erfc(z / math.sqrt(2)))


def test_mann_whitney_of_equal_samples_has_p_one(spark):
    df = spark.createDataFrame([(1.0, 1), (1.0, 0), (2.0, 1), (2.0, 0)], "x double, y int")
    assert assoc.mann_whitney(df, ["x"], "y").first()["p_value"] == 1.0


def test_chi_square_matches_the_formula(spark):
    rng = random.Random(4)
    rows = [("abc"[rng.randrange(3)], rng.randrange(2)) for _ in range(200)]
    df = spark.createDataFrame(rows, "c string, y int")
    row = assoc.chi_square(df, ["c"], "y").first()
    n = len(rows)
    want = 0.0
    for c in "abc":
        for y in (0, 1):
            e = sum(r[0] == c for r in rows) * sum(r[1] == y for r in rows) / n
            want += (sum(r == (c, y) for r in rows) - e) ** 2 / e
    assert math.isclose(row["chi2"], want, rel_tol=1e-9) and row["dof"] == 2
    assert math.isclose(row["p_value"], math.exp(-want / 2), rel_tol=1e-9)


def test_chi_square_with_an_empty_cell(spark):
    rows = [("a", 0)] * 10 + [("a", 1)] * 10 + [("b", 0)] * 20 + [("c", 0)] * 5 + [("c", 1)] * 5
    df = spark.createDataFrame(rows, "c string, y int")
    totals = {"a": 20, "b": 20, "c": 10}
    cells = {("a", 0): 10, ("a", 1): 10, ("b", 0): 20, ("b", 1): 0, ("c", 0): 5, ("c", 1): 5}
    want = sum((o - totals[c] * (35, 15)[y] / 50) ** 2 / (totals[c] * (35, 15)[y] / 50) for (c, y), o in cells.items())
    assert math.isclose(assoc.chi_square(df, ["c"], "y").first()["chi2"], want, rel_tol=1e-9)


def test_yates_on_two_by_two(spark):
    rows = [("a", 0)] * 20 + [("a", 1)] * 10 + [("b", 0)] * 8 + [("b", 1)] * 22
    df = spark.createDataFrame(rows, "c string, y int")
    row = assoc.chi_square(df, ["c"], "y").first()
    want = 60 * (abs(20 * 22 - 10 * 8) - 30) ** 2 / (30 * 30 * 28 * 32)
    assert math.isclose(row["chi2"], want, rel_tol=1e-9) and row["dof"] == 1


def test_one_level_has_no_association(spark):
    df = spark.createDataFrame([("a", 0), ("a", 1)], "c string, y int")
    row = assoc.chi_square(df, ["c"], "y").first()
    assert (row["chi2"], row["dof"], row["p_value"]) == (0.0, 0, 1.0)


def test_profile_tables(spark, credit):
    got = profile.profile(credit, ["age", "amount"], ["status"])
    assert got["shape"].first()["rows"] == 100
    assert got["values"].agg(F.sum("n")).first()[0] == 100
