from __future__ import annotations

from collections import Counter

import pytest
from pyspark.sql import functions as F

from driftwell.operators import perturb as p
from driftwell.operators import split


def test_stratified_split_has_exact_sizes(spark):
    df = spark.range(991).select(F.col("id"), (F.col("id") % 10 < 7).cast("int").alias("y"))
    rows = split.stratified_split(df, "y", ["id"]).collect()
    sizes = Counter((r["y"], r["is_test"]) for r in rows)
    assert sizes[1, True] + sizes[0, True] == 199
    whole = Counter(r["y"] for r in rows)
    for y, n in whole.items():
        assert abs(sizes[y, True] - 0.2 * n) < 1
    again = split.stratified_split(df.repartition(7), "y", ["id"]).where("is_test")
    assert {r["id"] for r in again.collect()} == {r["id"] for r in rows if r["is_test"]}


def test_split_of_the_credit_table_keeps_both_classes(spark, credit):
    parts = split.stratified_split(credit, "credit_risk", ["row_key"])
    sizes = Counter((r["is_test"], r["credit_risk"]) for r in parts.collect())
    assert all(sizes[t, y] for t in (True, False) for y in (0, 1))
    assert sum(sizes.values()) == 100 and sizes[True, 0] + sizes[True, 1] == 20


def test_split_on_a_larger_table_with_a_rare_class(spark):
    df = spark.range(30000).select("id", F.when(F.col("id") % 3000 == 0, "rare").otherwise("common").alias("y"))
    rows = split.stratified_split(df, "y", ["id"]).groupBy("y", "is_test").count().collect()
    got = {(r["y"], r["is_test"]): r["count"] for r in rows}
    assert got == {("rare", True): 2, ("rare", False): 8, ("common", True): 5998, ("common", False): 23992}


def test_folds_are_even_within_classes(spark):
    df = spark.range(503).select("id", (F.col("id") % 4 == 0).cast("int").alias("y"))
    sizes = Counter((r["y"], r["fold"]) for r in split.stratified_folds(df, "y", ["id"]).collect())
    for y in (0, 1):
        each = [sizes[y, f] for f in range(5)]
        assert max(each) - min(each) <= 1


def test_class_smaller_than_folds(spark):
    df = spark.createDataFrame([(i, int(i < 2)) for i in range(20)], "id int, y int")
    sizes = Counter((r["y"], r["fold"]) for r in split.stratified_folds(df, "y", ["id"]).collect())
    assert sum(v for (y, _), v in sizes.items() if y == 1) == 2


def test_ordered_split_counts_and_ties(spark):
    df = spark.range(10).select(F.col("id").alias("t"))
    assert split.ordered_split(df, "t", 0.7).where("is_reference").count() == 7
    tied = spark.createDataFrame([(1,)] * 5 + [(2,)] * 5, "t int")
    assert split.ordered_split(tied, "t", 0.7).where("is_reference").count() == 5
    days = spark.range(10).select(F.date_add(F.lit("2024-01-01").cast("date"), F.col("id").cast("int")).alias("t"))
    assert split.ordered_split(days, "t", 0.7).where("is_reference").count() == 7


def test_ordered_split_of_timestamps_is_exact_to_the_microsecond(spark):
    df = spark.range(10).select(
        F.timestamp_micros(F.lit(1_700_000_000_000_000) + F.col("id")).alias("t")
    )
    assert split.ordered_split(df, "t", 0.5).where("is_reference").count() == 5


def test_crisis_scenario(spark, credit):
    out = p.perturb(credit, p.CRISIS, ["row_key"])
    rows = {r["row_key"]: r for r in credit.collect()}
    new = {r["row_key"]: r for r in out.collect()}
    assert out.schema == credit.schema
    for k, old in rows.items():
        assert new[k]["age"] == old["age"] + 15
        assert new[k]["savings"] == {3: 1, 4: 1, 5: 1}.get(old["savings"], old["savings"])
        assert 5 * old["amount"] - 1 <= new[k]["amount"] <= 10 * old["amount"] + 1
        assert new[k]["status"] in (1, old["status"])
        assert new[k]["purpose"] == old["purpose"]
    hit = sum(new[k]["property"] == 4 for k in rows)
    assert 55 <= hit <= 85  # share .7 of 100, values below 4 otherwise


def test_chaos_scenario(spark, credit):
    new = {r["row_key"]: r for r in p.perturb(credit, p.CHAOS, ["row_key"]).collect()}
    for r in credit.collect():
        assert new[r["row_key"]]["credit_history"] == 4 - r["credit_history"]
        assert new[r["row_key"]]["duration"] in (4, 72)
        assert 1 <= new[r["row_key"]]["status"] <= 4
    assert len({r["duration"] for r in new.values()}) == 2


def test_concept_scenario_keeps_marginals(spark, credit):
    out = p.perturb(credit, p.CONCEPT, ["row_key"]).collect()
    old = credit.collect()
    shuffled = p.CONCEPT[0].columns
    for c in credit.columns:
        assert sorted(r[c] for r in out) == sorted(r[c] for r in old)
    moved = {r["row_key"]: r for r in out}
    for c in shuffled:
        assert any(moved[r["row_key"]][c] != r[c] for r in old)
    assert all(moved[r["row_key"]]["job"] == r["job"] for r in old)


def test_draws_do_not_depend_on_layout(spark, credit):
    a = {tuple(r) for r in p.perturb(credit, p.CHAOS, ["row_key"]).collect()}
    b = {tuple(r) for r in p.perturb(credit.repartition(9), p.CHAOS, ["row_key"]).collect()}
    other = {tuple(r) for r in p.perturb(credit, p.CHAOS, ["row_key"], seed=1).collect()}
    assert a == b and a != other


def test_permuting_refuses_a_hot_key(spark):
    df = spark.range(30000).select((F.col("id") % 3).alias("k"), F.col("id").alias("x"))
    with pytest.raises(ValueError, match="identify"):
        p.permute_columns(df, ["x"], ["k"])


def test_invert_off_scale_is_missing(spark):
    df = spark.createDataFrame([(0,), (4,), (7,)], "x int")
    out = p.perturb(df, [p.Invert("x", 0, 4)], ["x"])
    assert sorted((r[0] for r in out.collect()), key=str) == [0, 4, None]


@pytest.mark.parametrize("slice_rows", [10**6, 7])
def test_many_classes_are_cut_like_few(spark, monkeypatch, slice_rows):
    """The table of bounds gives the parts that order statistics give, missing labels too."""
    rows = [(i, f"c{i * i % 13}" if i % 17 else None, i % 5) for i in range(900)] + [(5, "c1", 0)]
    df = spark.createDataFrame(rows, "id long, y string, x long").repartition(3)
    few = [
        split.stratified_split(df, "y", ["id"]),
        split.stratified_folds(df, "y", ["id"], 4),
    ]
    few = [sorted(map(str, t.collect())) for t in few]
    monkeypatch.setattr(split, "FEW_CLASSES", 3)
    monkeypatch.setattr(split, "SLICE_ROWS", slice_rows)
    many = [split.stratified_split(df, "y", ["id"]), split.stratified_folds(df, "y", ["id"], 4)]
    assert [sorted(map(str, t.collect())) for t in many] == few
