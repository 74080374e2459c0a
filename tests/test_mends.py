"""Inputs that the test tables never reach: empty sides, large whole numbers, NaN scores."""

from __future__ import annotations

import math
import time

import numpy as np
import pytest
from pyspark.sql import functions as F

from driftwell.functions import pvalues
from driftwell.operators import attribution, clean, drift, forests, models, perturb, prep, profile, quality, split
from driftwell.sources import runlog


def test_report_with_an_empty_side(spark):
    df = spark.createDataFrame([(1.0, "a"), (2.0, "b")], "x double, t string")
    report = drift.drift_report(drift.pair(df, df.limit(0)))
    rows = {r["column"]: r for r in report.collect()}
    assert set(rows) == {"x", "t"} and all(r["value"] is not None for r in rows.values())
    empty = drift.drift_rollup(report.limit(0)).first()
    assert (empty["n_columns"], empty["pct_drift"], empty["status"]) == (0, 0.0, "ESTABLE")


def test_p_method_does_not_depend_on_size(spark):
    for n in (30, 12_000):
        df = spark.range(2 * n).select(F.col("id").cast("double").alias("x"), (F.col("id") < n).alias("is_reference"))
        (r,) = drift.drift_report(df).collect()
        assert r["p_method"] == "asymptotic"


def test_repeated_keys_are_refused_at_every_size(spark):
    for n in (2_000, 400_000):
        df = spark.range(n).select((F.col("id") % 3).alias("k"), "id")
        with pytest.raises(ValueError):
            perturb.permute_columns(df, ["id"], ["k"])


def test_modes_and_fills_keep_whole_numbers(spark):
    big = 2**53
    df = spark.createDataFrame([(big,), (big + 1,), (big + 1,), (None,)], "x long")
    found = clean.modes(df, ["x"])
    assert found == {"x": big + 1}
    filled = clean.impute(df, found)
    assert dict(filled.dtypes) == {"x": "bigint"} and filled.where(F.col("x") == big + 1).count() == 3
    assert dict(clean.impute(df, {"x": 4.0}).dtypes) == {"x": "bigint"}


def test_nan_scores_are_missing(spark):
    rows = [(1, 0.9), (0, 0.2), (1, float("nan")), (None, 0.4), (0, None)]
    df = spark.createDataFrame(rows, "y int, s double")
    points = {r["threshold"]: (r["tp"], r["tpr"]) for r in quality.roc_points(df, "y", "s").collect()}
    assert points == {float("inf"): (0, 0.0), 0.9: (1, 1.0), 0.2: (1, 1.0)}
    assert max(r["recall"] for r in quality.pr_points(df, "y", "s").collect()) == 1.0
    assert quality.cost_sweep(df, "y", "s", [0.5]).first()["fn"] == 0
    assert tuple(quality.unranked_rows(df, "y", "s").first()) == (5, 2, 1, 2)


def test_order_through_a_clock_change(spark):
    rows = [("2024-03-10 01:30:00",), ("2024-03-10 02:30:00",), ("2024-03-10 03:10:00",), ("2024-03-10 04:00:00",)]
    df = spark.createDataFrame(rows, "t string").select(F.col("t").cast("timestamp_ntz").alias("t"))
    zone = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        got = [r["is_reference"] for r in split.ordered_split(df, "t", 0.5).orderBy("t").collect()]
    finally:
        spark.conf.set("spark.sql.session.timeZone", zone)
    assert got == [True, True, False, False]


def test_two_labels_of_one_code_give_one_row(spark):
    df = spark.createDataFrame([(1,)], "c int")
    book = spark.createDataFrame([("c", 1, "b"), ("c", 1, "a")], "column string, code int, label string")
    assert [r["name"] for r in profile.decode_labels(df, book, {"c": "name"}).collect()] == ["a"]


def test_histogram_of_finite_values(spark):
    df = spark.createDataFrame([(0.0,), (10.0,), (float("inf"),), (float("nan"),), (None,)], "x double")
    rows = profile.histogram(df, ["x"], 2).orderBy("bin").collect()
    assert [(r["lo"], r["hi"], r["n"]) for r in rows] == [(0.0, 5.0, 1), (5.0, 10.0, 1)]


def test_missing_labels_are_no_class(spark):
    df = spark.createDataFrame([(1,)] * 5 + [(0,)] * 4 + [(None,)] * 3, "y int")
    got = {r["y"]: r["w"] for r in models.balanced_weights(df, "y", "w").distinct().collect()}
    assert got[1] == pytest.approx(0.9) and got[0] == pytest.approx(1.125) and got[None] is None


def test_training_parts_follow_the_rows(spark):
    df = spark.range(1000).withColumn("x", F.col("id") % 7)
    def deal(d, part_rows):
        hashed = d.withColumn(models.PART_HASH, models._content(d))
        return models.spread(hashed, 1000, part_rows).select("id", F.spark_partition_id().alias("p")).collect()

    assert deal(df.repartition(3), 125) == deal(df.repartition(5), 125)
    assert {r["p"] for r in deal(df, 125)} == set(range(8)) and {r["p"] for r in deal(df, 1000)} == {0}


def test_names_in_run_logs_are_decoded(spark, tmp_path):
    folder = tmp_path / "r1" / "params"
    folder.mkdir(parents=True)
    (folder / "max depth+1").write_text("5")
    (r,) = runlog.read_param_files(spark, f"file://{tmp_path}/*/params/*").collect()
    assert (r["run_id"], r["key"], r["value"]) == ("r1", "max depth+1", "5")


def test_unparsed_lines_are_counted(spark):
    lines = spark.createDataFrame([("1 2.5 0",), ("x y z",), ("",)], "value string")
    assert tuple(runlog.unparsed_lines(lines).first()) == (3, 2)


def test_exact_p_of_large_samples():
    for n in (40, 3_000):  # equal sizes have a closed form
        k = math.ceil(1.5 * math.sqrt(2 * n))
        whole = [math.exp(2 * math.lgamma(n + 1) - math.lgamma(n + 1 - j * k) - math.lgamma(n + 1 + j * k)) for j in range(1, n // k + 1)]
        assert pvalues.path_exit(n, n, k / n) == pytest.approx(2 * sum(v * (-1) ** j for j, v in enumerate(whole)), rel=1e-8)
    began = time.perf_counter()
    p = pvalues.path_exit(31_000, 29_000, 0.0111)
    assert p == pytest.approx(0.0489, abs=0.002) and time.perf_counter() - began < 60
    assert pvalues.path_exit(31_000, 29_000, 0.4) == 0.0


def test_scores_are_computed_once(spark):
    seen = spark.sparkContext.accumulator(0)

    def count(x):
        seen.add(1)
        return None if x % 10 == 9 else (x % 500) / 500

    udf = F.udf(count, "double")
    df = spark.range(30_000).select((F.col("id") * 7 % 3 % 2).alias("y"), udf("id").alias("s"))
    row = quality.auc(df, "y", "s").first()
    assert seen.value == 30_000 and row["n_1"] + row["n_0"] == 27_000
    assert row["auc"] == pytest.approx(0.5, abs=0.02)
    assert quality.roc_points(df, "y", "s", drop_collinear=False).count() == 451


def test_many_distinct_scores_in_ranges(spark):
    df = spark.range(60_000).select((F.col("id") % 2).alias("y"), (F.col("id") * 7919 % 60_000 / 60_000).alias("s"))
    got = quality.auc(df, "y", "s").first()
    by_rank = df.toPandas()
    ranks = by_rank.s.rank()[by_rank.y == 1]
    assert got["auc"] == pytest.approx((ranks.sum() - 30_000 * 30_001 / 2) / 30_000**2, abs=1e-12)
    points = quality.roc_points(df, "y", "s", drop_collinear=False).orderBy(F.desc("threshold")).collect()
    assert [p["tp"] + p["fp"] for p in points] == list(range(60_001))


def test_boosting_counts_rows_into_cells(spark, monkeypatch):
    df = spark.range(4000).select(
        "id", (F.col("id") * 7919 % 4000 / 4000.0).alias("x"), (F.col("id") % 3).alias("k")
    ).withColumn("y", ((F.col("x") > 0.37) != (F.col("k") == 1)).cast("int"))
    ready = prep.fit_preprocessor(df, ["x", "k"])
    hashed = models._ready(df.withColumn(models.PART_HASH, models._content(df)), ready, "y")
    monkeypatch.setattr(models, "CELL_ROWS", 900)
    cells = models.weighted_cells(hashed, "y", 4000).toPandas()
    assert cells[models.WEIGHT].sum() == 4000 and cells.features.map(lambda v: v[0]).nunique() <= models.LEVELS
    assert len(cells) <= 1000 and set(cells.features.map(lambda v: v[1])) == {0.0, 1.0, 2.0}
    model = models.fit_model(df, ready, models.boosted_trees("y", maxIter=8), "y")
    assert models.add_predictions(df, model).where("prediction = y").count() > 3900
    assert attribution.leaves_of(attribution.node_table(spark, model.stages[-1]), model.stages[-1].treeWeights)
    roots = attribution.node_table(spark, model.stages[-1]).where("id = 0").toPandas()
    assert roots["cover"].between(2400, 4000).all()  # rows, of which a tree samples 80 %


def test_forests_walk_each_cell_once(spark, monkeypatch):
    df = spark.range(3000).select("id", (F.col("id") % 1000 / 1000.0).alias("x"), (F.col("id") % 2).alias("z"))
    df = df.withColumn("y", (F.col("x") > 0.4).cast("int"))
    ready = prep.fit_preprocessor(df, ["x", "z"]).transform(df)
    model = models.RandomForestClassifier(labelCol="y", featuresCol="features", numTrees=5, maxDepth=4, seed=1).fit(ready)
    forest = forests.forest_arrays(forests.node_table(spark, model))
    x = np.array([r.features.toArray() for r in ready.orderBy("id").select("features").collect()])
    want = forest.shares(x, [2, 4], [3, 5])
    points = [{"maxDepth": d, "numTrees": t} for d in (2, 4) for t in (3, 5)]
    rows = {r["id"]: r["shares"] for r in forests.nested_scores(ready, "features", forest, points, ["id"]).collect()}
    assert np.allclose([rows[i] for i in range(3000)], want.reshape(3000, 4))
    cells, place = np.unique(forest.cells(x), axis=0, return_inverse=True)
    assert len(cells) < 300
    for k in range(len(cells)):
        assert np.ptp(want[place == k], axis=0).max() == 0
