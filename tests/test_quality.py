from __future__ import annotations

import math
import random

import pytest
from pyspark.ml.evaluation import BinaryClassificationEvaluator
from pyspark.sql import functions as F

from driftwell.functions import risk_band, verdict
from driftwell.operators import quality

# The recorded test metrics, and the confusion counts they imply.
RECORDED = {
    "f1": 0.8472222222222222,
    "accuracy": 0.7788944723618091,
    "precision": 0.8133333333333334,
    "recall": 0.8840579710144928,
    "bad_rate": 0.24623115577889448,
}
COUNTS = {"tp": 122, "fp": 28, "fn": 16, "tn": 33}


def scored(spark, rows):
    return spark.createDataFrame(rows, "y int, p int, s double").repartition(3)


def test_recorded_metrics_follow_from_counts(spark):
    rows = (
        [(1, 1, 0.9)] * 122 + [(0, 1, 0.8)] * 28 + [(1, 0, 0.3)] * 16 + [(0, 0, 0.1)] * 33
    )
    df = scored(spark, rows)
    assert quality.confusion(df, "y", "p").first().asDict() == {
        k: COUNTS[k] for k in ("tn", "fp", "fn", "tp")
    }
    got = quality.class_metrics(quality.confusion(df, "y", "p")).first()
    for name, value in RECORDED.items():
        assert math.isclose(got[name], value, rel_tol=1e-12)


def test_perfect_predictions(spark):
    df = scored(spark, [(0, 0, 0.1), (1, 1, 0.9), (0, 0, 0.2), (1, 1, 0.8)])
    row = quality.metric_record(df, "y", "p", "s").first().asDict()
    assert set(row) == set(quality.METRICS)
    assert row["accuracy_test"] == row["f1_score_test"] == row["auc_test"] == 1.0


def test_one_class_has_auc_one_half(spark):
    df = scored(spark, [(1, 1, s) for s in (0.9, 0.8, 0.95, 0.85)])
    assert quality.auc(df, "y", "s").first()["auc"] == 0.5
    assert quality.metric_record(df, "y", "p", "s").first()["auc_test"] == 0.5


def test_tied_scores_count_half(spark):
    rows = list(zip((0, 1, 0, 1, 0), (0,) * 5, (0.1, 0.9, 0.2, 0.15, 0.15)))
    assert quality.auc(scored(spark, rows), "y", "s").first()["auc"] == 0.75


def test_no_rows(spark):
    df = scored(spark, [(1, 1, 0.5)]).where("y = 0")
    assert quality.auc(df, "y", "s").first()["auc"] == 0.5
    assert quality.class_metrics(quality.confusion(df, "y", "p")).first()["f1"] == 0.0


@pytest.fixture(scope="module")
def random_scores(spark):
    rng = random.Random(6)
    rows = []
    for _ in range(600):
        y = int(rng.random() < 0.4)
        s = round(min(0.999, max(0.001, rng.gauss(0.4 + 0.2 * y, 0.2))), 2)
        rows.append((y, int(s >= 0.5), s))
    return rows, scored(spark, rows).persist()


def test_auc_agrees_with_mllib_and_pairs(random_scores):
    rows, df = random_scores
    got = quality.auc(df, "y", "s").first()["auc"]
    ones = [s for y, _, s in rows if y]
    zeros = [s for y, _, s in rows if not y]
    pairs = sum((a > b) + 0.5 * (a == b) for a in ones for b in zeros) / (len(ones) * len(zeros))
    mllib = BinaryClassificationEvaluator(rawPredictionCol="s", labelCol="y", numBins=0).evaluate(
        df.withColumn("y", F.col("y").cast("double"))
    )
    assert math.isclose(got, pairs, rel_tol=1e-12) and math.isclose(got, mllib, rel_tol=1e-9)


def brute_curve(rows):
    out = []
    for t in sorted({s for _, _, s in rows}, reverse=True):
        tp = sum(y == 1 and s >= t for y, _, s in rows)
        fp = sum(y == 0 and s >= t for y, _, s in rows)
        out.append((t, fp, tp))
    return out


def test_roc_points(random_scores):
    rows, df = random_scores
    want = brute_curve(rows)
    every = quality.roc_points(df, "y", "s", drop_collinear=False).orderBy(F.desc("threshold")).collect()
    assert [(r["threshold"], r["fp"], r["tp"]) for r in every[1:]] == want
    assert (every[0]["threshold"], every[0]["fpr"], every[0]["tpr"]) == (math.inf, 0.0, 0.0)
    assert (every[-1]["fpr"], every[-1]["tpr"]) == (1.0, 1.0)
    keep = [
        i
        for i in range(len(want))
        if i in (0, len(want) - 1)
        or want[i + 1][1] - 2 * want[i][1] + want[i - 1][1]
        or want[i + 1][2] - 2 * want[i][2] + want[i - 1][2]
    ]
    short = quality.roc_points(df, "y", "s").orderBy(F.desc("threshold")).collect()
    assert [r["threshold"] for r in short[1:]] == [want[i][0] for i in keep]


def test_pr_points(random_scores):
    rows, df = random_scores
    n1 = sum(y for y, _, _ in rows)
    got = quality.pr_points(df, "y", "s").orderBy(F.desc("threshold")).collect()
    assert (got[0]["precision"], got[0]["recall"]) == (1.0, 0.0)
    for r, (t, fp, tp) in zip(got[1:], brute_curve(rows)):
        assert r["threshold"] == t
        assert math.isclose(r["precision"], tp / (tp + fp)) and math.isclose(r["recall"], tp / n1)


def test_cost_sweep_and_best(random_scores):
    rows, df = random_scores
    grid = quality.sweep_thresholds()
    assert len(grid) == 33 and grid[0] == 0.1 and grid[-1] == 0.9
    want = {
        t: 5.0 * sum(y == 1 and s < t for y, _, s in rows) + sum(y == 0 and s >= t for y, _, s in rows)
        for t in grid
    }
    sweep = quality.cost_sweep(df, "y", "s")
    assert {r["threshold"]: r["cost"] for r in sweep.collect()} == want
    best = quality.best_threshold(sweep).first()
    assert (best["threshold"], best["cost"]) == min(want.items(), key=lambda e: (e[1], e[0]))


def test_class_report(random_scores):
    rows, df = random_scores
    got = {r["class"]: r for r in quality.class_report(df, "y", "p").collect()}
    assert set(got) == {"0", "1", "macro avg", "weighted avg", "accuracy"}
    assert got["0"]["support"] + got["1"]["support"] == 600
    hit = sum(y == p for y, p, _ in rows)
    assert math.isclose(got["accuracy"]["f1"], hit / 600)
    assert math.isclose(got["macro avg"]["f1"], (got["0"]["f1"] + got["1"]["f1"]) / 2)
    assert math.isclose(got["weighted avg"]["recall"], hit / 600)


def test_bands_and_verdicts(spark):
    df = spark.createDataFrame([(0.7,), (0.69,), (0.4,), (0.39,), (None,)], "p double")
    got = {r[0]: r[1] for r in df.select("p", risk_band(F.col("p"))).collect()}
    assert got == {0.7: "BAJO", 0.69: "MEDIO", 0.4: "MEDIO", 0.39: "ALTO", None: None}
    df = spark.createDataFrame([(1,), (0,), (None,)], "p int")
    assert [r[0] for r in df.select(verdict(F.col("p"))).collect()] == ["approve", "reject", None]


def test_top_features(spark):
    df = spark.createDataFrame([(f"f{i}", float(i % 7)) for i in range(20)], "feature string, importance double")
    got = [r["feature"] for r in quality.top_features(df).collect()]
    assert len(got) == 10 and got[:2] == ["f13", "f6"]
